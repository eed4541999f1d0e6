"""Hard negatives by an R-tree that is packed by sort-tile-recursive and searched best first.

Rows are packed into pages of about ``PAGE`` by recursive tiling: slabs of equal count by the first coordinate, tiles
of each slab by the second, and of each tile by the third. Cuts are quantiles of the rows of a
tile, found by aggregates that merge sketches; a tile that is too large, as where a vector repeats, is dealt out over
several pages. A page knows its minimum bounding box. Up to ``PAGES`` consecutive pages of a slab make a
subtree, whose upper levels hold the boxes of ``FANOUT`` nodes each.

A box gives, coordinate by coordinate, an interval of products with an anchor, and their sum bounds the score of
everything inside. The search takes boxes from a queue, the best possible score first, opens nodes and scores pages. It
prunes boxes outside the score window and boxes strictly below the k-th score found; a box level with it may
hold a tie and is opened. So the result is exact, whatever the tiles are.

The stated anchors meet every subtree in blocks of about ``ANCHORS``: a task holds a subtree and a block. Each
leaves its k best for each search, and the k best of those are taken by a window whose limit works before the
shuffle. Positives are found first, then the windows that they set are searched. In many dimensions
boxes overlap widely and most pages are opened; the blocks bound memory, not the work.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part.
Vectors of different lengths have no product and never meet. Scores are exact; one that does
not fit 64 bits raises. Rows with a null id take part but are no anchors and come last among ties. Repeated rows are
rows of their own: each is an anchor and can be the positive or negative of its copy; ties beyond the id go by a
number that the rows have while the query runs, between rows that look alike. An anchor without
positives, and a positive without negatives, gives no row. An empty table gives an empty result.
Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harborline.llm.frames import staged

PAGE = 512
PAGES = 128
FANOUT = 8
ANCHORS = 256
AXES = 3
NO_ID = (1 << 63) - 1  # stands for a null id inside a search, and comes last
FOUND = "anchor bigint, mark bigint, number bigint, id bigint, score bigint"


class Tree(NamedTuple):
    """A subtree: its pages' rows, the boxes of all nodes (pages first) and the children of those above."""

    vectors: list[np.ndarray]
    ids: list[np.ndarray]
    numbers: list[np.ndarray]
    labels: list[np.ndarray]
    low: np.ndarray
    high: np.ndarray
    children: list[range]


def numeric(rows: np.ndarray) -> np.ndarray:
    """Whole numbers in the fastest type in which all inner products are exact."""
    if not rows.size:
        return rows.astype(np.float64)
    top = max(abs(int(rows.min())), abs(int(rows.max())))
    bound = rows.shape[1] * top * top
    return rows.astype(np.float64) if bound < 1 << 53 else rows if bound < 1 << 62 else rows.astype(object)


def packed_tree(pages: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], fanout: int = FANOUT) -> Tree:
    """The tree over pages (vectors, ids, numbers, labels) that are in tile order."""
    vectors, ids, numbers, labels = (list(x) for x in zip(*pages))
    low = [v.min(axis=0) for v in vectors]
    high = [v.max(axis=0) for v in vectors]
    children: list[range] = []
    level = range(len(vectors))
    while len(level) > 1:
        above = len(low)
        for at in range(level.start, level.stop, fanout):
            own = range(at, min(at + fanout, level.stop))
            children.append(own)
            low.append(np.min([low[i] for i in own], axis=0))
            high.append(np.max([high[i] for i in own], axis=0))
        level = range(above, len(low))
    return Tree(vectors, ids, numbers, labels, np.array(low), np.array(high), children)


def bounds(tree: Tree, anchor: np.ndarray) -> tuple[list[int], list[int]]:
    """The least and the greatest inner product with ``anchor`` that the box of every node allows."""
    plus, minus = np.maximum(anchor, 0), np.minimum(anchor, 0)
    return (tree.low @ plus + tree.high @ minus).tolist(), (tree.high @ plus + tree.low @ minus).tolist()


class Search:
    """Searches of one anchor in one subtree."""

    def __init__(self, tree: Tree, vector: np.ndarray, number: int, label: int, same: bool):
        self.tree, self.vector, self.number, self.label, self.same = tree, vector, number, label, same
        self.least, self.most = bounds(tree, vector)
        self.scored: dict[int, tuple[np.ndarray, ...]] = {}

    def page(self, node: int) -> tuple[np.ndarray, ...]:
        """Scores, ids and numbers of a page's rows that the labels admit."""
        if node not in self.scored:
            tree = self.tree
            keep = tree.numbers[node] != self.number
            keep &= (tree.labels[node] == self.label) == self.same
            self.scored[node] = ((tree.vectors[node] @ self.vector)[keep], tree.ids[node][keep], tree.numbers[node][keep])
        return self.scored[node]

    def best(self, count: int, low: float = -np.inf, high: float = np.inf) -> list[tuple[int, int, int]]:
        """The first ``count`` rows (score, id, number) with scores from ``low`` to ``high``."""
        tree, least, most = self.tree, self.least, self.most
        pages = len(tree.vectors)
        root = len(least) - 1
        found: list[tuple] = []  # (-score, id, number), ascending
        kth = -np.inf
        queue = [(-min(most[root], high), root)] if most[root] >= low and least[root] <= high else []
        heapify(queue)
        while queue:
            bound, node = heappop(queue)
            if -bound < kth:
                break
            if node >= pages:
                for child in tree.children[node - pages]:
                    if most[child] >= low and least[child] <= high and most[child] >= kth:
                        heappush(queue, (-min(most[child], high), child))
                continue
            scores, ids, numbers = self.page(node)
            inside = np.flatnonzero((scores >= max(low, kth)) & (scores <= high))
            if not len(inside):
                continue
            if len(inside) > count:  # the page's own k-th score already leaves out the rest
                kept = -np.partition(-scores[inside], count - 1)[count - 1]
                inside = inside[scores[inside] >= kept]
            found += [(-int(scores[i]), int(ids[i]), int(numbers[i])) for i in inside]
            found = sorted(found)[:count]
            if len(found) == count:
                kth = -found[-1][0]
        return [(-s, i, n) for s, i, n in found]


def _usable(df: DataFrame, id_column: str, label_column: str, vector_column: str, label: Column | None) -> DataFrame:
    """Stored rows that take part: ``number``, ``id``, ``label``, ``dim`` and whole-number ``v``."""
    x = F.col(vector_column).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = df.filter(F.col(label_column).isNotNull() & x.isNotNull() & fine)
    own = (F.col(label_column) if label is None else label).cast("bigint")
    rows = rows.select(F.monotonically_increasing_id().alias("number"), F.col(id_column).cast("bigint").alias("id"),
                       own.alias("label"), F.size(x).alias("dim"), F.transform(x, lambda c: F.floor(c * 256)).alias("v"))
    return staged(rows, "vectors")


def pages(rows: DataFrame, page: int = PAGE, per_subtree: int = PAGES) -> DataFrame:
    """Stored pages: ``dim``, ``slab``, ``part`` (a subtree is a part of a slab), ``page`` and the ``rows`` in it."""
    slices = max(1, -(-rows.count() // page))
    slices = next(s for s in range(1, slices + 1) if s ** AXES >= slices)
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)]) if slices > 1 else None
    keys, tiled = ["dim"], rows
    for axis in range(AXES):
        place = F.lit(0)
        if shares is not None:
            x = F.coalesce(F.get("v", F.lit(axis)), F.lit(0))
            cuts = staged(tiled.groupBy(*keys).agg(F.percentile_approx(x, shares, 1000).alias("cuts")), "cuts")
            tiled = tiled.join(cuts, keys)
            place = F.size(F.filter("cuts", lambda c: c < F.coalesce(F.get("v", F.lit(axis)), F.lit(0))))
        tiled = staged(tiled.select(*keys, place.alias(f"t{axis}"), "number", "id", "label", "v"), "tiled")
        keys = [*keys, f"t{axis}"]
    sizes = tiled.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / page).cast("int").alias("pages"))
    order = W.partitionBy("dim", "t0").orderBy(*keys[2:])
    sizes = sizes.select("*", (F.sum("pages").over(order) - F.col("pages")).alias("first"))
    dealt = tiled.join(staged(sizes, "tiles"), keys).select(
        "dim", F.col("t0").alias("slab"), (F.col("first") + F.pmod(F.xxhash64("number"), F.col("pages"))).alias("page"),
        F.struct("number", F.coalesce("id", F.lit(NO_ID)).alias("id"), "label", "v").alias("row"))
    made = dealt.groupBy("dim", "slab", "page").agg(F.collect_list("row").alias("rows"))
    return staged(made.select("dim", "slab", F.floor(F.col("page") / per_subtree).alias("part"), "page", "rows"), "pages")


def _searched(tree_pages: DataFrame, anchors: DataFrame, same: bool, count: int, block: int) -> DataFrame:
    """The best of every subtree for every search.

    ``anchors`` has ``dim``, ``block`` and an array ``anchors`` of number, label, v and the searches' mark, low and high.
    """
    subtrees = tree_pages.select("dim", "slab", "part").distinct()
    keys = ["dim", "slab", "part", "block"]
    with_blocks = tree_pages.join(anchors.select("dim", "block"), "dim").select(*keys, F.lit(0).alias("kind"), "page", "rows")
    with_trees = anchors.join(subtrees, "dim").select(*keys, F.lit(1).alias("kind"), "anchors")
    both = with_blocks.unionByName(with_trees, allowMissingColumns=True)

    def table(structs: pa.Array, dim: int) -> np.ndarray:
        flat = structs.field("v").flatten() if dim else pa.array([], pa.int64())
        return flat.to_numpy(zero_copy_only=False).reshape(len(structs), dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in (*keys, "kind")]
            for i, (*key, kind) in enumerate(zip(*columns)):
                if key != now:
                    now, held = key, []
                if kind == 0:
                    rows = batch.column("rows").slice(i, 1).flatten()
                    held.append((table(rows, key[0]), *(rows.field(c).to_numpy() for c in ("id", "number", "label"))))
                    continue
                some = batch.column("anchors").slice(i, 1).flatten()
                vectors = table(some, key[0])
                # Products of anchors and rows must be exact in the type that both share.
                every = numeric(np.concatenate([*(h[0] for h in held), vectors]))
                cuts = np.cumsum([len(h[0]) for h in held])
                parts = np.split(every, cuts)
                tree = packed_tree([(p, *h[1:]) for p, h in zip(parts, held)])
                found = []
                for vector, number, label, searches in zip(parts[-1], *(some.field(c).to_pylist() for c in ("number", "label", "searches"))):
                    search = Search(tree, vector, number, label, same)
                    for s in searches:
                        limits = (-np.inf, np.inf) if s["low"] is None else (s["low"], s["high"])
                        found += [(number, s["mark"], n, id_, score) for score, id_, n in search.best(count, *limits)]
                names = ["anchor", "mark", "number", "id", "score"]
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(5)], names=names)

    placed = both.repartition(*keys).sortWithinPartitions(*keys, "kind", "page")
    return placed.mapInArrow(run, FOUND)


def _first(found: DataFrame, count: int) -> DataFrame:
    """The first ``count`` of every search, with their ``rank``."""
    order = W.partitionBy("anchor", "mark").orderBy(F.col("score").desc(), "id", "number")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def hard_negatives(df: DataFrame, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding",
                   label: Column | None = None, every: int = 100, positives: int = 5, negatives: int = 10,
                   window: tuple[int, int] = (30, 90), page: int = PAGE, per_subtree: int = PAGES,
                   block: int = ANCHORS) -> DataFrame:
    """Rows ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are rows whose id is divisible by ``every``; ``label`` replaces the label column; ``window`` are
    the percentages of the positive's score between which a negative's must lie.
    """
    rows = _usable(df, id_column, label_column, vector_column, label)
    tree_pages = pages(rows, page, per_subtree)
    anchors = rows.filter(F.col("id") % every == 0)
    anchors = anchors.join(anchors.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "dim")
    anchors = staged(anchors.withColumn("block", F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int")), "anchors")

    def blocks(searches: DataFrame) -> DataFrame:
        asked = F.struct("number", "label", "v", "searches")
        return staged(searches.groupBy("dim", "block").agg(F.collect_list(asked).alias("anchors")), "blocks")

    none = F.lit(None).cast("bigint")
    one = F.array(F.struct(F.lit(0).cast("bigint").alias("mark"), none.alias("low"), none.alias("high")))
    near = staged(_first(_searched(tree_pages, blocks(anchors.withColumn("searches", one)), True, positives, block),
                         positives), "positives")
    low, high = window
    # Whole-number limits: low% of the score rounded up, high% of it rounded down.
    score = F.col("score").cast("decimal(25,0)")
    limits = F.struct(F.col("number").alias("mark"), F.ceil(score * low / 100).cast("bigint").alias("low"),
                      F.floor(score * high / 100).cast("bigint").alias("high"))
    asked = near.groupBy(F.col("anchor").alias("number")).agg(F.collect_list(limits).alias("searches"))
    far = _first(_searched(tree_pages, blocks(anchors.join(asked, "number")), False, negatives, block), negatives)
    pairs = near.select("anchor", F.col("number").alias("mark"), F.col("id").alias("positive_id"),
                        F.col("score").alias("positive_score"))
    named = anchors.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id"))
    shown = {c: F.when(F.col(c) != NO_ID, F.col(c)) for c in ("positive_id", "negative_id")}
    out = far.select("anchor", "mark", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = out.join(pairs, ["anchor", "mark"]).join(named, "anchor").withColumns(shown)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
