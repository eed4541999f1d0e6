"""Quality rules: base rules, and the log-likelihood ratio of hashed n-grams.

Words are cut where symbols such as ``#`` or ``|`` meet other characters; the pieces and pairs of neighbouring
pieces are hashed into ``BUCKETS`` buckets. Two multinomials are counted over the buckets: the raw
corpus, which is every document, and a trusted target, a bounded sample of the documents
labelled good. The raw counts are scaled to the size of the target and both are smoothed by the
same ``SMOOTHING`` counts, so an n-gram that is too rare to tell weighs nothing, in a corpus of
two hundred documents as in one of billions. A document's score is the mean over its n-grams of
ln(p_target / p_raw), so length does not matter; documents under ``THRESHOLD`` are rejected.
Weights are rounded to whole multiples of 2**-20 and summed as whole numbers, so a
score is the same for every partitioning and the threshold is deterministic.

Everything runs as DataFrame functions. One pass counts: n-grams are summed per bucket
before the shuffle, which carries at most ``BUCKETS`` rows per task. A second pass scores:
the weights (``BUCKETS`` rows, a constant) are broadcast, each document's words are
exploded inside its task, and the partial sums leave it as one narrow row. The only ids
that are broadcast are those of the target sample: ``TRUSTED_ROWS``, give or take the few hundred by which a
hash may miss the rate.

Repeated five-word windows are found inside the row by sorting the windows' 64-bit hashes;
two different windows of one text share a hash with a probability below 1e-9 for a
million words.

Defined results: null texts have no words and fail the base rules. Without any
trusted document every weight is 0 and the base rules decide alone. Rows that repeat id and
text get one result row each; rows with a null id are scored like others and never
trusted. Repeated or null labels change nothing. Very long texts are read whole. An empty table gives an
empty result. Other columns of either table play no part, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.frames import packed, sampled, staged, text_of, unpacked, words

BUCKETS = 1 << 17
TRUSTED_ROWS = 20_000
THRESHOLD = -0.3
SMOOTHING = 20.0  # counts of the target sample
UNIT = 1 << 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_columns(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep``, the words ``_w`` and the five base counts of the text."""
    size = F.size("_w")
    step = df.select(*keep, F.col(text).alias("_t"), words(F.col(text)).alias("_w"))
    step = step.select("*", F.transform("_w", lambda w: F.xxhash64(w)).alias("_hw"))
    window = F.transform(
        F.sequence(F.lit(0), size - WINDOW),
        lambda i: F.xxhash64(*[F.get("_hw", i + k) for k in range(WINDOW)]),
    )
    step = step.select("*", F.when(size >= WINDOW, window).alias("_h"))
    place = F.sequence(F.lit(0), F.size("_h") - 1)
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    step = step.select("*", F.when(repeats, F.sort_array(F.arrays_zip(F.col("_h").alias("h"), place.alias("p"))))
                       .alias("_z"))
    # Neighbours in the order of (hash, place) with equal hashes are places of a repeated window.
    pairs = F.zip_with(
        F.slice("_z", F.lit(1), F.size("_z") - 1), F.slice("_z", F.lit(2), F.size("_z") - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])).otherwise(F.array().cast("array<int>")),
    )
    step = step.select("*", F.when(F.col("_z").isNotNull(), F.sort_array(F.array_distinct(F.flatten(pairs))))
                       .alias("_p"))
    gaps = F.zip_with(
        F.slice("_p", F.lit(1), F.size("_p") - 1), F.slice("_p", F.lit(2), F.size("_p") - 1),
        lambda a, b: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)
    step = step.select("*", F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    return step.select(
        *keep, "_w",
        size.cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        F.when(has_symbols(F.col("_t")), F.regexp_count("_t", F.lit(f"[{SYMBOLS}]"))).otherwise(0).cast("bigint")
        .alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.col("_p").isNotNull(), covered).otherwise(0).cast("bigint").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * n)


def has_symbols(text: Column) -> Column:
    """Whether any symbol occurs; plain byte searches, which most texts need no regular expression after."""
    return reduce(or_, [F.contains(text, F.lit(c)) for c in SYMBOLS])


def tokens(text: Column, found: Column) -> Column:
    """The words ``found`` in ``text``, cut where symbols begin and end, so that ``word###`` has a part ``word``."""
    return F.when(has_symbols(text), words(F.regexp_replace(text, f"([{SYMBOLS}]+)", " $1 "))).otherwise(found)


def _bucket(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")


def _grams(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per word with the buckets of the word and of it with its successor."""
    following = F.slice("_w", F.lit(2), F.greatest(F.size("_w"), F.lit(1)))
    pairs = F.arrays_zip(F.col("_w").alias("a"), following.alias("b"))
    rows = df.select(*keep, F.inline_outer(pairs))
    return rows.select(*keep, F.when(F.col("a").isNotNull(), _bucket(F.col("a"))).alias("one"),
                       F.when(F.col("b").isNotNull(), _bucket(F.col("a"), F.col("b"))).alias("two"))


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """About ``rows`` distinct ids labelled good and not toxic, chosen by the hash of the id.

    The rate follows the number of distinct ids, so labels that are listed more than once change nothing.
    """
    good = labels.filter("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"))
    good = staged(good.distinct(), "good")
    return staged(sampled(good, rows, good.count(), "_id"), "trusted")


def bucket_weights(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """``bucket`` and ``weight``, ln(p_target / p_raw) in units of 2**-20, counted over all documents."""
    trusted = F.broadcast(trusted_ids(labels).withColumn("_good", F.lit(1)))
    rows = docs.select(F.col(id_column).alias("_id"), tokens(text_of(text_column), words(text_of(text_column))).alias("_w"))
    marked = rows.join(trusted, "_id", "left")
    grams = _grams(marked, ["_good"]).select("_good", F.explode(F.array("one", "two")).alias("bucket"))
    counts = staged(grams.filter("bucket IS NOT NULL").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.count("_good").alias("good")), "ngrams")
    totals = counts.agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).first()
    raw, good = totals["raw"] or 0, totals["good"] or 0
    # Both multinomials have the size of the target and the same smoothing, so their totals cancel.
    expected = F.col("raw") * F.lit(good / max(raw, 1))
    ratio = F.log((F.col("good") + SMOOTHING) / (expected + SMOOTHING))
    weight = F.round(ratio * UNIT).cast("bigint") if good else F.lit(0).cast("bigint")
    return staged(counts.select("bucket", weight.alias("weight")), "weights")


def quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, base counts, ``base_failed``, ``score``, ``kept`` and the text's hash ``_th``."""
    weights = bucket_weights(docs, labels, id_column, text_column)
    keys = ["_id", "_th"]
    rows = docs.select(F.col(id_column).alias("_id"), text_of(text_column).alias("_text"))
    rows = rows.select("*", F.xxhash64("_text").alias("_th"))
    rows = base_columns(rows, "_text", [*keys, "_text"]).withColumn("_w", tokens(F.col("_text"), F.col("_w")))
    rows = rows.select(*keys, *BASE, F.size("_w").alias("n_tokens"), "_w")
    grams = _grams(rows, [*keys, *BASE, "n_tokens"])
    first = F.broadcast(weights.select(F.col("bucket").alias("one"), F.col("weight").alias("w1")))
    second = F.broadcast(weights.select(F.col("bucket").alias("two"), F.col("weight").alias("w2")))
    weighed = grams.join(first, "one", "left").join(second, "two", "left")
    sums = weighed.groupBy(*keys, *BASE, "n_tokens").agg(
        F.sum(F.coalesce("w1", F.lit(0)) + F.coalesce("w2", F.lit(0))).alias("sum"),
        F.count(F.lit(1)).alias("rows"))
    n = F.col("n_tokens")
    # Every token gives one row and an empty text one, so the quotient counts rows that repeat id and text.
    times = F.expr("CAST(rows DIV greatest(n_tokens, 1) AS INT)")
    grams_total = times * (F.lit(2) * n - 1)
    score = F.when(n > 0, F.col("sum") / F.lit(float(UNIT)) / grams_total)
    out = sums.select("*", score.alias("score"), base_failed().alias("base_failed"),
                      F.explode(F.sequence(F.lit(1), times)))
    kept = ~F.col("base_failed") & (F.col("score") >= F.lit(float(threshold)))
    # Stored, so that a filter on the result is not pushed down into the nested expressions of the counts.
    return staged(out.select(F.col("_id").alias(id_column), *BASE, "base_failed", "score",
                             F.coalesce(kept, F.lit(False)).alias("kept"), "_th"), "quality")


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with all their columns."""
    def key(column: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))

    passed = quality(docs, labels, id_column, text_column, threshold).filter("kept")
    passed = staged(passed.select(key(id_column).alias("_key"), "_th").distinct(), "passed")
    rows = packed(docs, _key=key(id_column), _th=F.xxhash64(text_of(text_column)))
    return unpacked(rows.join(passed, ["_key", "_th"], "left_semi"))
