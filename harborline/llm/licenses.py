"""Licence scan by canonical digests.

A text is brought to a canonical form: lower case; lines that are copyright notices
dropped; ``&`` read as "and"; everything but letters and digits taken as a blank; equivalent
spellings replaced by one of them. The SHA-256 of the form is joined by equality to the
digests of the known texts, which are formed in the same way. Whole texts are looked up, and
every line and paragraph as a whole, so that a notice inside a document is found as well, wrapped or
not; a paragraph ends at a line without letters and digits, in a comment block too. Known
texts of at least ``LONG`` words are found anywhere inside a document, over paragraphs and comment
marks: where the first ``ANCHOR`` words of one occur in the canonical form, the digest of the piece of its
length is looked up. A document that is a known text as a whole does not report pieces of it.

Known texts are a table; the join is left to the planner, which broadcasts it while it is
small; anchors and lengths of the long ones go to every task. Digests are formed inside the tasks that read the text and each document sends every
distinct line digest once, and other digests where a known text begins; only those that match leave their task when the table is
broadcast. Matches are folded per document by a partial aggregate.

Defined results: a null or empty text, and one of punctuation alone, matches nothing.
Rows that repeat an id keep results of their own, as long as their texts differ. Several licences of
one digest are all reported, in order. Empty tables give empty results. Very long texts are read whole. Other columns
play no part, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm.frames import staged, text_of
from harborline.llm.license_texts import EQUIVALENT, FULL_TEXTS, PHRASES, TEXTS

ANCHOR = 8  # first words of a known text that are searched for
LONG = 20  # words from which a known text is found anywhere in a line

_COPYRIGHT = re.compile(
    r"^[^\S\n]*[#*/;%>-]*[^\S\n]*(?:copyright[^\S\n]*(?:\(c\)|©|:|[0-9<\[{(])|(?:\(c\)|©)[^\S\n]*(?:copyright|[0-9<\[{])"
    r"|all rights reserved\.?[^\S\n]*$)[^\n]*", re.MULTILINE)
_SEPARATORS = re.compile(r"[\W_]+")
_PARAGRAPHS = re.compile(r"\n[\W_]*\n")
_PHRASE = re.compile(r"\b(?:" + "|".join(map(re.escape, PHRASES)) + r")\b")
_SPELLING = re.compile(r"\b(?:" + "|".join(map(re.escape, EQUIVALENT)) + r")\b")


def canonical(text: str) -> str:
    """The canonical form; equal for texts that count as the same licence."""
    low = _COPYRIGHT.sub(" ", text.lower().replace("\r\n", "\n"))
    plain = _SEPARATORS.sub(" ", low.replace("&", " and ")).strip()
    plain = _SPELLING.sub(lambda m: EQUIVALENT[m.group()], plain)
    return _PHRASE.sub(lambda m: PHRASES[m.group()], plain)


def digest(text: str) -> bytes | None:
    """The SHA-256 of the canonical form, nothing for an empty form."""
    form = canonical(text)
    return sha256(form.encode("utf-8", "surrogatepass")).digest() if form else None


def shape(text: str) -> tuple[str, int, bytes, bool] | None:
    """Anchor, length and digest of the canonical form, and whether it is long; nothing for an empty form."""
    form = canonical(text)
    words = form.split(" ")
    own = sha256(form.encode("utf-8", "surrogatepass")).digest()
    return (" ".join(words[:ANCHOR]), len(form), own, len(words) >= LONG) if form else None


def known_licenses(spark: SparkSession, texts: Iterable[tuple[str, str]] = TEXTS,
                   full: Iterable[tuple[str, str, int, str]] = FULL_TEXTS) -> DataFrame:
    """``license_id``, ``digest``, ``anchor``, ``size`` and ``long`` of known texts; each row once."""
    rows = {(name, found[2], found[0], found[1], found[3]) for name, text in texts if (found := shape(text)) is not None}
    rows |= {(name, bytes.fromhex(own), anchor, size, True) for name, anchor, size, own in full}
    return spark.createDataFrame(sorted(rows), "license_id string, digest binary, anchor string, size int, long boolean")


def passages(text: str, form: str, anchors: dict[str, set[tuple[int, bool]]]) -> set[bytes]:
    """Digests of the pieces of a text that begin like a known one; ``form`` is the text's canonical form."""
    padded, found, wrapped = f" {form} ", set(), False
    for anchor, sizes in anchors.items():
        at = padded.find(f" {anchor} ")
        while at >= 0:
            wrapped = wrapped or any(not long for _, long in sizes)
            for end in {at + 1 + size for size, long in sizes if long}:
                if padded[end:end + 1] == " ":
                    found.add(sha256(padded[at + 1:end].encode("utf-8", "surrogatepass")).digest())
            at = padded.find(f" {anchor} ", at + 1)
    if wrapped:
        found |= {d for part in _PARAGRAPHS.split(text.replace("\r\n", "\n")) if (d := digest(part)) is not None}
    return found


def digests(docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id``, ``own`` (SHA-256 of the text), ``whole`` (or a part), ``digest``, of texts, their distinct lines and passages."""
    anchors, entire = {}, set()
    for row in known.select("anchor", "size", "long", "digest").collect():
        anchors.setdefault(row.anchor, set()).add((row.size, row.long))
        entire.add(bytes(row.digest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, own, whole, found = [], [], [], []
            for i, value in enumerate(batch.column("text")):
                text = value.as_py()
                form = canonical(text)
                first = sha256(form.encode("utf-8", "surrogatepass")).digest() if form else None
                at.append(i)
                whole.append(True)
                found.append(first)
                parts = {d for line in set(re.split(r"\r?\n", text)) if (d := digest(line)) is not None}
                if first not in entire:
                    parts |= passages(text, form, anchors)
                at += [i] * len(parts)
                own += [sha256(text.encode()).digest()] * (1 + len(parts))
                whole += [False] * len(parts)
                found += sorted(parts)
            ids = batch.column("_id").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(own, pa.binary()), pa.array(whole, pa.bool_()), pa.array(found, pa.binary())],
                names=["_id", "own", "whole", "digest"])

    rows = docs.select(F.col(id_column).alias("_id"), text_of(text_column).alias("text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, own binary, whole boolean, digest binary")


def license_scan(docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``canonical_sha256``, ``license_ids`` of the entire text, ``notice_ids`` of its parts."""
    found = digests(docs, known, id_column, text_column)
    # Written, so that the planner knows how small it is and no digest has to leave its task to meet it.
    known = staged(known.select("license_id", "digest"), "known")
    found = staged(found.join(known, "digest", "left").filter(
        "whole OR license_id IS NOT NULL"), "licences")
    entire = found.filter("whole")
    matches = found.filter("license_id IS NOT NULL").groupBy("_id", "own").agg(
        F.sort_array(F.collect_set(F.when(F.col("whole"), F.col("license_id")))).alias("license_ids"),
        F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("license_id")))).alias("notice_ids"))
    matches = staged(matches.withColumnRenamed("_id", "_match").withColumnRenamed("own", "_text"), "matches")
    # A digest of several licences gives several rows for one text; the first stands for it.
    first = F.coalesce(F.col("license_id") == F.col("_least"), F.lit(True))
    least = known.groupBy("digest").agg(F.min("license_id").alias("_least"))
    rows = entire.join(least, "digest", "left").filter(first)
    none = F.array().cast("array<string>")
    same = rows["_id"].eqNullSafe(matches["_match"]) & (rows["own"] == matches["_text"])
    return rows.join(matches, same, "left").select(
        F.col("_id").alias(id_column), F.lower(F.hex("digest")).alias("canonical_sha256"),
        F.coalesce("license_ids", none).alias("license_ids"), F.coalesce("notice_ids", none).alias("notice_ids"))
