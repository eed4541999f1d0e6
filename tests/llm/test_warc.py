import glob
import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from harborline.llm import warc
from harborline.llm.frames import tuned

LONG = "<p>é" * 600
ROWS = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, None), (4, "http://a b\r\nX: y", ""), (5, "u", "short"),
        (6, "v", "short"), (None, "w", LONG), (2, "other", LONG), (7, "z", "P*M\x18\0\0\0\0" * 200), (8, "y", "\r\n\r\n" * 400)]


@pytest.fixture()
def pages(spark):
    return lambda rows=ROWS, n=2: tuned(spark).createDataFrame(rows, "page_id long, url string, html string").repartition(n)


def test_round_trip(pages):
    got = warc.archive_round_trip(pages().withColumns({"payload": F.lit(1), "sha1": F.lit("x"), "kind": F.lit(None)})).collect()
    assert len(got) == len(ROWS)
    rows = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got)
    expected = []
    for page, _, html in ROWS:
        data = (html or "").encode()
        refers = 2 if html == LONG and page != 2 else None
        expected.append((str(page), len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers))
    assert rows == sorted(expected, key=lambda r: tuple(map(str, r)) and r[:4])


def test_files_follow_the_format(pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(pages(n=1), path)
    (name,) = glob.glob(f"{path}/part-*")
    data = open(name, "rb").read()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdCompressionDict(data[8:8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data[8 + size:], read_across_frames=True)
    plain = reader.read()
    assert plain.count(b"WARC/1.1\r\n") == len(ROWS)
    assert b"WARC-Refers-To: <urn:page:2:" in plain and b"http://a%20b%0D%0AX:%20y" in plain
    records = list(warc._frames(data))
    assert b"".join(records) == plain and len(records) == len(ROWS)


def test_files_roll(pages, spark, tmp_path):
    """One task writes many files of bounded size, each of which can be read on its own."""
    rows = [(i, f"http://a/{i}", hashlib.shake_256(str(i).encode()).hexdigest(4000)) for i in range(60)]
    path = str(tmp_path / "archive")
    warc.write_archives(pages(rows, 1), path, roll_bytes=20_000)
    files = [open(name, "rb").read() for name in glob.glob(f"{path}/part-*")]
    assert len(files) > 5
    sizes = [len(d) - 8 - struct.unpack_from("<II", d)[1] for d in files]
    assert max(sizes) < 20_000 + 9000
    assert all(struct.unpack_from("<II", d)[0] == warc.DICTIONARY_MAGIC for d in files)
    assert sorted(warc.parse(r)[0] for d in files for r in warc._frames(d)) == list(range(60))
    assert {(r.page_id, bytes(r.payload).decode()) for r in warc.read_archives(spark, path).collect()} == {
        (i, h) for i, _, h in rows}


def test_payloads_come_back(pages, spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archives(pages(), path)
    rows = warc.read_archives(spark, path).filter("record_type = 'response'").collect()
    assert {(r.page_id, bytes(r.payload)) for r in rows} == {
        (p, (h or "").encode()) for p, _, h in ROWS if h != LONG or p == 2}


def test_damage_is_noticed(pages, tmp_path):
    record = warc.record(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None)
    assert warc.parse(record)[:3] == (1, "u", "response")
    with pytest.raises(ValueError):
        warc.parse(record[:-1])
    with pytest.raises(ValueError):
        list(warc._frames(zstandard.compress(record * 500)[:-4]))


def test_empty_table_and_trained_dictionary(pages, spark, folder):
    assert warc.archive_round_trip(pages().limit(0)).count() == 0
    table = spark.read.parquet(f"{folder}/pages.parquet")
    assert warc.archive_round_trip(table).count() == table.count()
    assert warc.build_dictionary(warc.record_types(table), table.count())[:4] == b"\x37\xa4\x30\xec"


def test_dictionary_learns_from_all_of_a_page(pages):
    """A phrase that stands only after the first ``SAMPLE_BYTES`` of every page is in the dictionary."""
    filler = lambda i: hashlib.shake_256(str(i).encode()).hexdigest(6000)
    rows = [(i, f"http://a/{i}", filler(i) + "<footer>the same closing words of every page</footer>" * 400) for i in range(200)]
    made = warc.build_dictionary(warc.record_types(pages(rows)), len(rows))
    assert b"the same closing words of every page" in made


def test_long_payloads(pages):
    """Payloads of millions of bytes are written and read back whole, also as copies."""
    long = "".join(f"<p>{i}é</p>" for i in range(300_000))
    rows = [(1, "a", long), (2, "b", long), (3, "c", long + "x"), (4, "d", "short")]
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.refers_to) for r in warc.archive_round_trip(pages(rows)).collect()}
    assert got == {i: (len(h.encode()), hashlib.sha1(h.encode()).hexdigest(), 2 if i == 1 else None) for i, _, h in rows}
