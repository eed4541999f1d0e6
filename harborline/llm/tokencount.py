"""Token counts with a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, count). A text's
content is normalised in a way the tokenizer cannot see, digested with SHA-256 and joined
to the counts stored for the tokenizer's version, which is the SHA-256 of its file and
settings. Only distinct contents without a stored count are encoded, by the
tokenizer's own library, and their counts are appended to the cache; documents then take
their count from it by a join of narrow rows.

Distinct contents are found by an aggregate that combines before its shuffle, so copies of one
text leave each task as one row. The final join reads two stored frames; adaptive
execution splits a digest that many documents share. An append is committed as
a whole; a repeated append can only add equal rows, which reading folds together.

For a tokenizer that drops blanks and never looks across them, runs of the six ASCII
blanks count as one, and within a task a text is encoded as its runs of non-blanks, each
distinct run once per worker memory. That memory holds at most ``REMEMBERED`` bytes besides the runs of the text
at hand, however long the runs are.

Defined results: a null text is empty and has 0 tokens; an empty table gives an empty result
and leaves the cache as it is; repeated rows each get their count. Very long texts are counted whole. Other columns
play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm.frames import BLANK, staged, text_of
from harborline.operators.storage import shared_path

REMEMBERED = 96 << 20  # bytes of remembered runs and counts per worker
ENTRY = 160  # bytes of an entry besides its run
LIMIT = 2048
SCHEMA = "digest binary, tokenizer string, n_tokens bigint"


@lru_cache(maxsize=4)
def _library(path: str):
    """The library's tokenizer of a file, and a function from a list of texts to their counts."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return lambda texts: [len(e.ids) for e in made.encode_batch_fast(texts, add_special_tokens=False)]


def drops_blanks(path: str) -> bool:
    """Whether the tokenizer removes blanks and splits at them, so that runs can be counted apart.

    True when its first split keeps only what its pattern matches and the pattern's
    alternatives, which are named here as the fixed value they must equal, match no blank.
    """
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = splits[0] if splits else {}
    pattern = (first.get("pattern") or {}).get("Regex")
    stripping = any(t.get("lstrip") or t.get("rstrip") or any(c in t["content"] for c in BLANK)
                    for t in spec.get("added_tokens", []))
    # Fixed value: the pattern of the vocabulary file that is known not to match blanks.
    known = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    normal = json.dumps(spec.get("normalizer"))
    only = all(n.get("type") in ("NFC", "Replace", "Lowercase") for n in (spec.get("normalizer") or {}).get(
        "normalizers", [{"type": "other"}]))
    spaces = normal.count('"Replace"') == normal.count(r'{"Regex": "\\s+"}, "content": " "')
    return (first.get("type") == "Split" and first.get("invert") is True and first.get("behavior") == "Removed"
            and pattern == known and only and spaces and not stripping)


def version(path: str) -> str:
    """Digest of everything that decides a count: the file and how it is used."""
    with open(path, "rb") as file:
        digest = hashlib.sha256(file.read())
    digest.update(b"|no special tokens added|no truncation|no padding")
    return digest.hexdigest()


def normalised(text: Column, blanks: bool) -> Column:
    """The content that is digested and encoded."""
    if not blanks:
        return text
    return F.regexp_replace(F.btrim(text, F.lit(BLANK)), r"[\x20\x09-\x0D]+", " ")


class Runs(dict):
    """Token counts by run of non-blanks, at most ``room`` bytes of them from one text to the next."""

    def __init__(self, count, room: int = REMEMBERED):
        super().__init__()
        self.count, self.room, self.held = count, room, 0

    def total(self, runs: list[bytes]) -> int:
        """Tokens of all runs."""
        missing = list({r for r in runs if r not in self})
        self.held += sum(map(len, missing)) + ENTRY * len(missing)
        self.update(zip(missing, self.count([r.decode() for r in missing])))
        found = sum(map(self.__getitem__, runs))
        if self.held > self.room:
            self.clear()
            self.held = 0
        return found


@lru_cache(maxsize=4)
def _runs(path: str) -> Runs:
    return Runs(_library(path))


def count_texts(texts: DataFrame, path: str, tokenizer: str, blanks: bool) -> DataFrame:
    """Rows of the cache for rows of ``digest`` and ``content``."""
    block = 1 << 18  # runs that are looked up together

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = batch.column("content")
            counts = []
            for i in range(len(contents)):
                text = contents[i].as_py()
                if not blanks:
                    counts += _library(path)([text])
                    continue
                known, runs, total = _runs(path), text.encode().split(), 0
                for at in range(0, len(runs), block):
                    total += known.total(runs[at:at + block])
                counts.append(total)
            names = pa.array([tokenizer] * len(counts), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), names, pa.array(counts, pa.int64())],
                                             names=["digest", "tokenizer", "n_tokens"])

    return texts.select("digest", "content").mapInArrow(run, SCHEMA)


def stored_counts(spark: SparkSession, cache: str, tokenizer: str, wanted: DataFrame) -> DataFrame:
    """Counts of one tokenizer version for the ``wanted`` digests, one row each; empty where there is no cache yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens bigint")
    rows = spark.read.schema(SCHEMA).parquet(cache).filter(F.col("tokenizer") == tokenizer)
    rows = rows.join(wanted, "digest", "left_semi")
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, cache: str | None = None, id_column: str = "doc_id",
                 text_column: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``cache`` is the folder of the cache, in a store all executors share; without one a new cache
    is begun for this call.
    """
    spark = docs.sparkSession
    cache = cache or shared_path(spark, "token-counts")
    tokenizer, blanks = version(path), drops_blanks(path)
    text = text_of(text_column)
    rows = docs.select(F.col(id_column).alias("_id"), F.octet_length(text).cast("bigint").alias("n_bytes"),
                       normalised(text, blanks).alias("content"))
    rows = rows.select("_id", "n_bytes", "content", F.unhex(F.sha2("content", 256)).alias("digest"))
    narrow = staged(rows.select("_id", "n_bytes", "digest"), "digests")
    # Of a large cache only what this batch asks for is aggregated and copied.
    wanted = staged(narrow.select("digest").distinct(), "wanted")
    known = stored_counts(spark, cache, tokenizer, wanted)
    texts = rows.select("digest", "content")
    # Copies are folded before the shuffle; what is left meets the cache where it lies.
    missing = texts.dropDuplicates(["digest"]).join(known, "digest", "left_anti")
    count_texts(missing, path, tokenizer, blanks).write.mode("append").parquet(cache)
    counts = staged(stored_counts(spark, cache, tokenizer, wanted), "counts")
    return narrow.join(counts, "digest").select(
        F.col("_id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
