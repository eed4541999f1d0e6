"""CSV records with line breaks inside quotes, read from many splits."""

import csv
import random

import pytest

from harborline.sources import bundle, records

VALUES = ["x", 'a "quoted" b', "one\ntwo", 'one\r\ntwo\n\n"three",', ",", "  blanks ", "\n", "é\n" * 50, None]


@pytest.fixture()
def splits(spark):
    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield size
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(folder, files, header=("id", "v", "two\nlines"), rows=110, seed=3):
    """Rows as written, in file order; the second file ends its lines in CRLF and orders its columns differently."""
    draw, out = random.Random(seed), []
    folder.mkdir()
    for f in range(files):
        order = list(header) if f != 1 else list(header)[::-1]
        with open(folder / f"part-{f}.csv", "w", newline="", encoding="utf-8") as file:
            lines = csv.writer(file, lineterminator="\r\n" if f == 1 else "\n")
            lines.writerow(order)
            for i in range(rows):
                row = dict(zip(header, [str(len(out)), draw.choice(VALUES), draw.choice(VALUES)]))
                out.append(tuple(row.values()))
                lines.writerow([row[n] or "" for n in order])
                if i % 37 == 0:
                    file.write("\n")
    return out


@pytest.mark.parametrize("size", [400, 1 << 27])
def test_records_of_many_splits(spark, splits, tmp_path, size):
    """Equal to the values written, whatever the splits; columns are taken by name."""
    rows = written(tmp_path / "t.csv", 3)
    splits(size)
    df = records.read_records(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["id", "v", "two\nlines", "source_row", "source_line"]
    got = sorted(df.collect(), key=lambda r: r["source_row"])
    assert [tuple(r)[:3] for r in got] == rows
    assert [r["source_row"] for r in got] == list(range(2, len(rows) + 2))


def test_lines_and_rows_are_counted_apart(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n\n1,"x\ny"\n \n2,"p\n\nq"\n3,z')
    got = [tuple(r) for r in records.read_records(spark, str(tmp_path / "t.csv")).orderBy("source_row").collect()]
    assert got == [("1", "x\ny", 2, 3), ("2", "p\n\nq", 3, 6), ("3", "z", 4, 9)]


def test_no_task_reads_a_whole_file(spark, splits, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("a,b\n" + "".join(f'{i},"line\n{i}"\n' for i in range(4000)))
    splits(4096)
    df = records.read_records(spark, str(path))
    assert df.count() == 4000 and df.filter("b <> concat('line\\n', a)").count() == 0
    assert df.rdd.getNumPartitions() > 1


def test_bundle_with_breaks(spark, tmp_path):
    (tmp_path / "suppliers.csv").write_text(
        'supplier_name,supplier_id,contact_email,country,supplier_tier\n"one\ntwo",S1,NA,DE,gold\nnull,S2,e,,t\n')
    rows = bundle.read_bundle(spark, str(tmp_path), multiline=True)["suppliers"].orderBy("source_row")
    assert [tuple(r) for r in rows.collect()] == [(2, "one\ntwo", "S1", None, "DE", "gold"), (3, None, "S2", "e", None, "t")]


def test_refusals(spark, tmp_path):
    def read(name, text):
        (tmp_path / name).write_text(text)
        return records.read_records(spark, str(tmp_path / name))

    with pytest.raises(ValueError, match="inside quotes"):
        read("open.csv", 'a,b\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="no header"):
        read("empty.csv", "\n\n")
    with pytest.raises(ValueError, match="repeats"):
        read("twice.csv", "a,a\n1,2\n")
    with pytest.raises(Exception, match="alformed"):
        read("short.csv", "a,b\n1\n").collect()
    assert read("header.csv", "a,b\n").count() == 0
    folder = tmp_path / "many.csv"
    folder.mkdir()
    (folder / "p0.csv").write_text("a,b\n1,2\n")
    (folder / "p1.csv").write_text("a,c\n1,2\n")
    with pytest.raises(ValueError, match="other names"):
        records.read_records(spark, str(folder))
