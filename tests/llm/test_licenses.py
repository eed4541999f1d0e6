import os

import pytest
from pyspark.sql import functions as F

from harborline.llm import licenses, license_texts
from harborline.llm.frames import tuned

MIT = license_texts.MIT


@pytest.mark.parametrize("text", [
    MIT, MIT.upper(), MIT.replace("<year> <copyright holders>", "2020 Jo Doe"), MIT.replace("\n", "\r\n"),
    MIT.replace("Permission", "Copyright 2019, 2020 Somebody Else. All rights reserved.\n\nPermission"),
    MIT.replace("\n\n", "\n # \n").replace('"', "'"), MIT.replace("NONINFRINGEMENT", "NON-INFRINGEMENT"),
    MIT.replace("sublicense", "sublicence"), MIT.replace("License", "Licence")])
def test_variants_are_one_text(text):
    assert licenses.digest(text) == licenses.digest(MIT)


@pytest.mark.parametrize("text", [MIT + " more", MIT.replace("WITHOUT WARRANTY", "WITH WARRANTY"), license_texts.ISC, "MIT"])
def test_other_texts_differ(text):
    assert licenses.digest(text) != licenses.digest(MIT)


def test_scan(docs, spark):
    rows = [(1, MIT.upper()), (2, "x\r\nReleased under the MIT licence!\ny\nLicensed under CC BY-NC 4.0"), (2, license_texts.ISC),
            (None, None), (5, "..."), (6, "plain words"), (7, "Released under the MIT License."), (8, "a\n" * 50_000),
            (None, license_texts.ISC), (6, "plain words")]
    known = licenses.known_licenses(tuned(spark))
    df = docs(rows).withColumns({"digest": F.lit(1), "license_id": F.lit(2), "whole": F.lit(3)})
    got = sorted((str(r.doc_id), r.license_ids, r.notice_ids) for r in licenses.license_scan(df, known).collect())
    assert got == sorted([
        ("1", ["MIT"], []), ("2", [], ["CC-BY-NC-4.0", "MIT"]), ("2", ["ISC"], []), ("None", [], []), ("5", [], []),
        ("6", [], []), ("6", [], []), ("7", ["MIT"], ["MIT"]), ("8", [], []), ("None", ["ISC"], [])])


def test_two_licences_with_one_text(docs, spark):
    known = licenses.known_licenses(tuned(spark), [("A", "same text"), ("B", "Same text."), ("C", "...")])
    (row,) = licenses.license_scan(docs([(1, "SAME  text")]), known).collect()
    assert row.license_ids == ["A", "B"]


def test_every_line_of_a_table(spark, folder, texts):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    known = licenses.known_licenses(spark)
    names = {licenses.digest(t): n for n, t in license_texts.TEXTS}
    got = {r.doc_id: r.notice_ids for r in licenses.license_scan(table, known).collect()}
    assert got == {i: sorted({names[d] for line in t.split("\n") if (d := licenses.digest(line)) in names}) for i, t, _ in texts}


def test_empty(docs, spark):
    known = licenses.known_licenses(tuned(spark))
    assert licenses.license_scan(docs([(1, "a")]).limit(0), known).count() == 0
    assert licenses.license_scan(docs([(1, "a")]), known.limit(0)).first().license_ids == []


LOCAL = "/usr/share/common-licenses/"


@pytest.mark.skipif(not os.path.isdir(LOCAL), reason="no local licence files")
@pytest.mark.parametrize("file,name", [
    ("Apache-2.0", "Apache-2.0"), ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3", "LGPL-3.0"),
    ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"), ("GFDL-1.3", "GFDL-1.3"), ("Artistic", "Artistic-1.0-Perl"),
    ("BSD", "BSD-3-Clause")])
def test_full_texts(file, name):
    with open(LOCAL + file, encoding="utf-8") as f:
        anchor, size, own, _ = licenses.shape(f.read())
    assert (name, anchor, size, own.hex()) in license_texts.FULL_TEXTS


def test_parts_of_longer_documents(docs, spark):
    notice = license_texts.APACHE_HEADER.replace("to in writing,", "to in\nwriting,")
    comment = "\n".join(f" * {line}" for line in notice.split("\n"))
    body = MIT.partition("\n")[2]
    wrapped = "# This work is licensed under the GNU General\n# Public License, version 3.\n#\n# more"
    rows = [(1, f"/*\n{comment}\n */\nint main() {{}}\n"), (2, f"intro\n\n{MIT}\n\nmore"), (3, f"intro\n{body}\nmore"),
            (4, wrapped), (5, MIT[:-20] + "\nand more"), (6, "They said: not released under the MIT License."),
            (7, f"{notice}\n\n{license_texts.BSD_THREE}")]
    if os.path.isdir(LOCAL):
        with open(LOCAL + "MPL-2.0", encoding="utf-8") as f:
            mpl = f.read()
        rows += [(8, mpl), (9, f"first\n\n{mpl}\nlast")]
    known = licenses.known_licenses(tuned(spark))
    got = {r.doc_id: (r.license_ids, r.notice_ids) for r in licenses.license_scan(docs(rows), known).collect()}
    assert got == {k: v for k, v in {
        1: ([], ["Apache-2.0"]), 2: ([], ["MIT"]), 3: ([], ["MIT"]), 4: ([], ["GPL-3.0"]), 5: ([], []), 6: ([], []),
        7: ([], ["Apache-2.0", "BSD-3-Clause"]), 8: (["MPL-2.0"], []), 9: ([], ["MPL-2.0"])}.items() if k in got}
    assert len(got) == len(rows)
