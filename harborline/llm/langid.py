"""Language identification by interpolated Kneser-Ney character models.

Text is reduced to its letters in lower case, every run of other characters to one blank,
with a blank at either end. One model per language holds n-grams of up to ``ORDER``
characters. Highest-order counts are counts of occurrences, lower orders count distinct
left neighbours; each order is discounted by D = n1 / (n1 + 2 n2) and interpolated with the
next lower one, the lowest with the uniform distribution over the characters seen in any language and one
unseen. That alphabet is the same for all models, or one of few letters would find foreign ones likelier than their own does. A model is stored as sorted arrays of 64-bit hashes: n-gram to
log2 probability, and context to log2 back-off weight. The prediction is the language
with the lowest cross-entropy per character, ties by name.

Rejection is calibrated: per language, the ``REJECT`` quantile of the cross-entropy over
labelled texts that were not counted is the limit above which a prediction is marked as rejected.
A language whose labelled rows all belong to the calibrating part is learned from them and has no limit.

Fitting uses a bounded sample, about ``ROWS`` labelled rows
per language and ``SAMPLE_ROWS`` in all; what languages with few rows leave goes to the others, and each gives
one row at least, so every labelled language has a model. Models are broadcast; their size, and
the time to score a text, grow with the number of languages only. Of a text with more
than ``MAX_CHARS`` letters and blanks, ``PIECES`` pieces of that size together are counted, one from each part of
equal length at a place chosen by the row's hash. Limits are measured on whole texts. N-grams are counted by
Spark, and models are made of about ``GRAMS`` n-grams of the highest order in all, whatever the alphabet: a language with more
than its share keeps those that occur most, and of the count at its limit a part chosen by their hash; its single characters are
all kept. So neither what
reaches the driver nor what is broadcast grows with the length or variety of texts. Scoring is one pass over whole texts without a shuffle; each batch looks up
its distinct n-grams only.

Defined results: null texts and texts without a letter are ``und`` with score 0 and not
rejected; with no labelled row at all every text is ``und``. Rows with a null language are
scored but not learned from; the empty string is a language like any other. Repeated rows count as often as they occur. An empty table gives an
empty result. Very long texts are scored whole. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline.llm.frames import packed, staged, text_of

ORDER = 4
ROWS = 1500  # labelled rows per language to fit on, and as many again to calibrate on a quarter of them
MAX_CHARS = 20_000  # of longer texts, pieces of this size together are fitted on
PIECES = 4
SAMPLE_ROWS = 20_000  # over all languages; with many of them each gets fewer than ROWS, but one at least
GRAMS = 1 << 20  # n-grams of the highest order in all models together
REJECT = 0.995
CERTAIN = 64  # characters after which a score no longer sharpens
BLOCK = 1 << 21  # characters scored at once
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: the lower-case letter, or a blank."""
    points = np.full(0x110000, 32, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            points[point] = ord(low) if len(low) == 1 else point
    return points


def letters(text: str) -> np.ndarray:
    """Lower-case letters and single blanks, one blank at either end; empty if there is no letter."""
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    keep = points != 32
    if not keep.any():
        return np.empty(0, dtype=np.uint32)
    points = np.concatenate([[32], points, [32]]).astype(np.uint32)
    blank = points == 32
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    keep[0] = True
    return points[keep]


def grams(points: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit hash for the n-gram of ``order`` characters that starts at each position."""
    n = len(points) - order + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, order, dtype=np.uint64)
    wide = points.astype(np.uint64)
    for k in range(order):
        out = (out ^ wide[k:k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


@dataclass
class Model:
    """One language: by order, sorted hashes with log2 probabilities, and contexts with log2 back-off."""

    name: str
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    unseen: float
    limit: float = float("inf")


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.argsort(keys, kind="stable")
    return keys[place], values[place]


def fit(name: str, points: np.ndarray, counts: np.ndarray, singles: tuple[np.ndarray, np.ndarray] | None = None,
        alphabet: int | None = None) -> Model:
    """A model from the distinct n-grams of the highest order (a row of characters each) and their counts.

    ``singles`` are characters in ascending order with their numbers of left neighbours, if more are known than these
    n-grams show; ``alphabet`` is the number of characters that share what the lowest order leaves.
    """
    order = points.shape[1]
    levels = [(points, counts.astype(np.float64))]
    for _ in range(order - 1):  # lower orders count the distinct characters that precede
        tails, n = np.unique(levels[0][0][:, 1:], axis=0, return_counts=True)
        levels.insert(0, (tails, n.astype(np.float64)))
    if singles is not None and order > 1:
        levels[0] = (singles[0].reshape(-1, 1).astype(points.dtype), singles[1].astype(np.float64))
    alphabet = alphabet or len(levels[0][0]) + 1
    lower = None
    model = Model(name, [], [], 0.0)
    for k, (rows, n) in enumerate(levels, start=1):
        once, twice = float((n == 1).sum()), float((n == 2).sum())
        discount = once / (once + 2 * twice) if once and twice else 0.5
        heads, at, types = np.unique(rows[:, :-1], axis=0, return_inverse=True, return_counts=True) if k > 1 else (
            np.empty((1, 0), rows.dtype), np.zeros(len(rows), dtype=np.int64), np.array([len(rows)]))
        at = at.reshape(-1)
        total = np.bincount(at, weights=n, minlength=len(heads))
        back = discount * types / total
        if lower is None:
            below = np.full(len(rows), 1.0 / alphabet)
            model.unseen = float(np.log2(back[0] / alphabet))
        else:
            below = np.exp2(lower[1][np.searchsorted(lower[0], _hashed(rows[:, 1:]))])
            model.contexts.append(_sorted(_hashed(heads), np.log2(back)))
        prob = np.maximum(n - discount, 0) / total[at] + back[at] * below
        lower = _sorted(_hashed(rows), np.log2(prob))
        model.grams.append(lower)
    return model


def _hashed(rows: np.ndarray) -> np.ndarray:
    """The hash of every row of characters, as ``grams`` gives it."""
    out = np.full(len(rows), rows.shape[1], dtype=np.uint64)
    for k in range(rows.shape[1]):
        out = (out ^ rows[:, k].astype(np.uint64)) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys a sorted array holds, and their values (0 where it does not)."""
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    found = table[0][at] == keys
    return found, np.where(found, table[1][at], 0.0)


def surprise(model: Model, chars: np.ndarray) -> np.ndarray:
    """-log2 probability of the last character of each row of ``chars`` after the others."""
    order = chars.shape[1]
    out = np.zeros(len(chars))
    open_ = np.arange(len(chars))
    for k in range(order, 0, -1):
        found, value = _find(model.grams[k - 1], _hashed(chars[open_, order - k:]))
        out[open_[found]] -= value[found]
        open_ = open_[~found]
        if not len(open_):
            return out
        if k > 1:  # an unseen context has back-off weight 1
            out[open_] -= _find(model.contexts[k - 2], _hashed(chars[open_, order - k:-1]))[1]
    out[open_] -= model.unseen
    return out


def entropies(models: list[Model], texts: list[np.ndarray], order: int = ORDER) -> np.ndarray:
    """Cross-entropy in bits per character, a row per text and a column per model; texts have letters."""
    padded = [np.concatenate([np.full(order - 2, 32, np.uint32), t]) for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in padded])])
    whole = np.concatenate(padded)
    keys = grams(whole, order)
    lengths = np.array([len(p) - order + 1 for p in padded])
    own = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths)])
    distinct, first, at = np.unique(keys[own], return_index=True, return_inverse=True)
    chars = whole[own[first][:, None] + np.arange(order)]
    bounds = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    out = np.empty((len(texts), len(models)))
    for k, model in enumerate(models):
        out[:, k] = np.add.reduceat(surprise(model, chars)[at], bounds) / lengths
    return out


def _blocks(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Places and letters of texts that have letters, about ``BLOCK`` characters at a time."""
    places, found, size = [], [], 0
    for i, text in enumerate(texts):
        points = letters(text) if text else ()
        if len(points):
            places.append(i)
            found.append(points)
            size += len(points)
        if size >= BLOCK:
            yield places, found
            places, found, size = [], [], 0
    if places:
        yield places, found


def _usable(docs: DataFrame, text: Column, lang: Column, *keys: Column) -> DataFrame:
    """Labelled rows as ``lang``, ``text`` and a hash ``h``."""
    return docs.select(lang.alias("lang"), text.alias("text"), F.xxhash64(*keys).alias("h")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())


def _share(sizes: DataFrame, count: str, rows: int, total: int | None = None) -> int:
    """The rows a language may give at most, so that all give ``total`` (``SAMPLE_ROWS``); what small ones leave goes to the others.

    ``rows`` at most and 1 at least. Only the counts up to ``rows`` reach the driver, with their numbers of languages.
    """
    some = sizes.filter(F.col(count) > 0).groupBy(F.least(count, F.lit(rows)).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    left = SAMPLE_ROWS if total is None else total
    found = sorted((r["size"], r["n"]) for r in some.collect())
    langs = sum(n for _, n in found)
    for size, n in found:
        if size * langs > left:
            return max(1, left // langs)
        left, langs = left - size * n, langs - n
    return rows


def _sample(usable: DataFrame, sizes: DataFrame, count: str, rows: int) -> DataFrame:
    """About as many rows per language as its share, chosen by the hash, and at least that of the least hash."""
    share = _share(sizes, count, rows)
    cut = F.least(F.lit(share) / F.col(count), F.lit(1.0)) * F.lit(float(1 << 62))
    cuts = sizes.filter(F.col(count) > 0).select("lang", cut.alias("_cut"), F.col(f"{count}_least").alias("_least"))
    place = F.pmod(F.col("h"), F.lit(1 << 62))
    return usable.join(cuts, "lang").filter((place < F.col("_cut")) | (F.col("h") == F.col("_least"))).select(
        "lang", "text", "h")


def _frequent(counted: DataFrame, names: list[str], total: int) -> DataFrame:
    """About ``total`` of the n-grams in the stored ``counted``: the most frequent ones of each language, up to its share."""
    if counted.count() <= total:
        return counted
    # A language has few distinct counts, so its histogram is small.
    histogram = staged(counted.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("size")), "counts")
    share = _share(histogram.groupBy("lang").agg(F.sum("size").alias("size")), "size", total, total)
    share = max(share, 64)  # what the hash chooses is never empty
    above = F.sum("size").over(Window.partitionBy("lang").orderBy(F.desc("n")))
    rate = (F.lit(share) - (above - F.col("size"))) / F.col("size")
    cut = F.greatest(F.lit(0.0), F.least(F.lit(1.0), rate)) * F.lit(float(1 << 62))
    cuts = histogram.select("lang", "n", cut.alias("_cut")).filter("_cut > 0")
    place = F.pmod(F.xxhash64(*names), F.lit(1 << 62))
    return counted.join(cuts, ["lang", "n"]).filter(place < F.col("_cut")).select("lang", *names, "n")


def _pieces(points: np.ndarray, h: int) -> list[np.ndarray]:
    """A text of at most ``MAX_CHARS`` points whole, else ``PIECES`` pieces of it at places chosen by ``h``."""
    if len(points) <= MAX_CHARS:
        return [points]
    part, size = len(points) // PIECES, MAX_CHARS // PIECES
    places = np.random.default_rng(h & (1 << 64) - 1).integers(0, part - size + 1, PIECES)
    return [points[k * part + at:k * part + at + size] for k, at in enumerate(places)]


def train(fitting: DataFrame, calibrating: DataFrame, keys: list[str], text_column: str = "text",
          lang_column: str = "lang", order: int = ORDER, rows: int = ROWS) -> list[Model]:
    """Models of all languages, by name, from a bounded sample of labelled rows."""
    spark = fitting.sparkSession
    names = [f"c{i}" for i in range(order)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts, hashes = (batch.column(c).to_pylist() for c in ("lang", "text", "h"))
            for lang in sorted(set(langs)):
                own = [i for i, name in enumerate(langs) if name == lang]
                for places, found in _blocks([texts[i] for i in own]):
                    padded = [np.concatenate([np.full(order - 2, 32, np.uint32), p]) for p in found]
                    parts = [x for p, q in zip(places, padded) for x in _pieces(q, hashes[own[p]])]
                    chars = np.concatenate([np.lib.stride_tricks.sliding_window_view(x, order) for x in parts])
                    distinct, n = np.unique(chars, axis=0, return_counts=True)
                    columns = [pa.array(distinct[:, k].astype(np.int32)) for k in range(order)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n), pa.string()), *columns, pa.array(n.astype(np.int64))],
                        names=["lang", *names, "n"])

    columns = [F.col(text_column), F.col(lang_column).cast("string"), *[F.col(k) for k in keys]]
    learned, measured = _usable(fitting, *columns), _usable(calibrating, *columns)
    both = learned.withColumn("_own", F.lit(True)).unionByName(measured.withColumn("_own", F.lit(False)))
    sizes = both.groupBy("lang").agg(
        F.count(F.when(F.col("_own"), 1)).alias("own"), F.min(F.when(F.col("_own"), F.col("h"))).alias("own_least"),
        F.count(F.when(~F.col("_own"), 1)).alias("rest"), F.min(F.when(~F.col("_own"), F.col("h"))).alias("rest_least"))
    # A language without rows to fit on is learned from those that would calibrate it, and has no limit.
    alone = F.col("own") == 0
    sizes = staged(sizes.select(
        "lang", F.when(alone, F.col("rest")).otherwise(F.col("own")).alias("fit"),
        F.coalesce("own_least", "rest_least").alias("fit_least"),
        F.when(alone, 0).otherwise(F.col("rest")).alias("limit"), F.col("rest_least").alias("limit_least"),
        alone.alias("_alone")), "languages")
    few = sizes.filter("_alone").select("lang")
    source = learned if few.isEmpty() else learned.unionByName(measured.join(few, "lang", "left_semi"))

    schema = "lang string, " + ", ".join(f"{c} int" for c in names) + ", n bigint"
    counted = _sample(source, sizes, "fit", rows).mapInArrow(count, schema).groupBy("lang", *names).agg(F.sum("n").alias("n"))
    counted = staged(counted, "ngrams")
    table = _frequent(counted, names, GRAMS).toArrow()
    pairs = counted.select("lang", F.col(names[-1]).alias("c"), *names[-2:-1]).distinct()
    pairs = pairs.groupBy("lang", "c").agg(F.count(F.lit(1)).alias("n")).orderBy("lang", "c").toArrow()
    holders, single, before = (pairs.column(c).to_numpy() for c in ("lang", "c", "n"))
    alphabet = len(np.unique(single)) + 1
    langs = np.array(table.column("lang").to_pylist(), dtype=object)
    chars = np.stack([table.column(c).to_numpy().astype(np.uint32) for c in names], axis=1) if len(langs) else None
    n = table.column("n").to_numpy()
    models = []
    for lang in sorted(set(langs.tolist())):
        own, held = langs == lang, holders == lang
        place = np.lexsort(chars[own].T[::-1])  # one order for every run, since sums of floats follow it
        models.append(fit(lang, chars[own][place], n[own][place], (single[held], before[held]), alphabet))
    _calibrate(spark, models, _sample(measured, sizes, "limit", rows))
    return models


def _calibrate(spark, models: list[Model], sample: DataFrame) -> None:
    """Set each model's limit to the quantile of the cross-entropy of its own language's texts."""
    shared = spark.sparkContext.broadcast(models)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = {m.name: k for k, m in enumerate(shared.value)}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for places, found in _blocks(texts):
                h = entropies(shared.value, found)
                own = [(langs[p], float(h[i, column[langs[p]]])) for i, p in enumerate(places) if langs[p] in column]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in own], pa.string()),
                                                  pa.array([x[1] for x in own], pa.float64())], names=["lang", "h"])

    if models:
        found = sample.mapInArrow(score, "lang string, h double").toArrow()
        langs, h = np.array(found.column("lang").to_pylist(), dtype=object), found.column("h").to_numpy()
        for model in models:
            if (langs == model.name).any():
                model.limit = float(np.quantile(h[langs == model.name], REJECT))


def identify(docs: DataFrame, models: list[Model], text_column: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score``, ``cross_entropy`` and ``rejected`` to all columns; reads the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = [m.name for m in known]
        limits = np.array([m.limit for m in known])
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            entropy, rejected = [None] * len(texts), np.zeros(len(texts), dtype=bool)
            for places, found in _blocks(texts) if known else ():
                h = entropies(known, found)
                best = h.argmin(axis=1)
                low = h[np.arange(len(h)), best]
                n = np.minimum([len(f) for f in found], CERTAIN)
                weight = np.exp2(-(h - low[:, None]) * n[:, None])
                for i, p in enumerate(places):
                    lang[p], entropy[p] = names[best[i]], float(low[i])
                score[places] = 1.0 / weight.sum(axis=1)
                rejected[places] = low > limits[best]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(lang, pa.string()), pa.array(score),
                 pa.array(entropy, pa.float64()), pa.array(rejected)],
                names=["_row", "_lang", "_score", "_entropy", "_rejected"])

    rows = packed(docs, _text=text_of(text_column))
    schema = T.StructType([rows.schema["_row"]]).add("_lang", "string").add("_score", "double").add(
        "_entropy", "double").add("_rejected", "boolean")
    return rows.mapInArrow(run, schema).select(
        "_row.*", F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"),
        F.col("_entropy").alias("cross_entropy"), F.col("_rejected").alias("rejected"))


def identified_documents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out`` and the prediction for every document.

    Documents whose crc32 of the id modulo 4 is 2 are held out; 0 and 1 are fitted on, 3 calibrates. A
    null id is never held out and never fitted on.
    """
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    models = train(docs.filter(rest.isin(0, 1)), docs.filter(rest == 3), ["doc_id"])
    narrow = docs.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "text")
    return identify(narrow, models).drop("text")
