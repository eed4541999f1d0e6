import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.llm import simhash
from harborline.llm.components import components
from harborline.llm.frames import tuned

EDGES = ["", None, "a", "A b", "a b c", "a b c D", "É  x\x1cy z  q", "a a a a a a", "x y z w v", "y " * 3000]


def cloud(rng, n, spread):
    prints = {rng.getrandbits(64)}
    while len(prints) < n:
        x = rng.choice(sorted(prints)) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randint(1, spread)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    return sorted(prints)


def test_fingerprints(texts):
    for text in [t for _, t, _ in texts[:60]] + EDGES:
        assert simhash.fingerprint(text or "") == brute.fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7, 8, 11])
def test_cells_against_all_pairs(radius):
    rng = random.Random(radius)
    cells = [cloud(rng, n, 2 * radius + 2) for n in (2, 3, 63, 64, 65, 200)]
    edges = simhash.cell_edges([np.array(c, dtype=np.uint64) for c in cells], radius)
    for cell in cells:
        own = [e for e in edges if e[0] in cell]
        assert all((a ^ b).bit_count() <= radius for a, b in own)
        assert brute.roots(cell, own) == brute.near_groups(cell, radius)
        assert len(own) < len(cell)


@pytest.mark.parametrize("cell", [3, 1024])
def test_links_against_all_pairs(spark, cell):
    """Also where every bucket is dealt again because it exceeds the cell."""
    prints = cloud(random.Random(5), 300, 6)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = tuned(spark).createDataFrame(signed, "fp long")
    edges = [tuple(x % (1 << 64) for x in r) for r in simhash.links(df, cell=cell).collect()]
    assert brute.roots(prints, edges) == brute.near_groups(prints)


@pytest.mark.parametrize("agree", [2, 3, 4])
def test_more_blocks_against_all_pairs(spark, agree):
    """Each choice of blocks finds every link; a larger table asks for more of them."""
    prints = cloud(random.Random(6), 250, 6)
    df = tuned(spark).createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    edges = [tuple(x % (1 << 64) for x in r) for r in simhash.links(df, agree=agree).collect()]
    assert brute.roots(prints, edges) == brute.near_groups(prints)
    assert [simhash.agreeing(n, 4, 1024) for n in (0, 10 ** 6, 10 ** 10, 10 ** 12)] == [2, 2, 3, 4]


@pytest.mark.parametrize("loose", [43, 16, 7])
def test_hot_bucket_against_all_pairs(spark, loose):
    """Fingerprints that share a bucket, spread over its other bits or close together."""
    rng = random.Random(loose)
    top = rng.getrandbits(64 - loose) << loose
    prints = sorted({top | rng.getrandbits(loose) for _ in range(300)} | {top | (1 << i) for i in range(loose)})
    df = tuned(spark).createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    edges = [tuple(x % (1 << 64) for x in r) for r in simhash.links(df, cell=4).collect()]
    assert brute.roots(prints, edges) == brute.near_groups(prints)


@pytest.mark.parametrize("n", [4000, 16000])
def test_rows_of_a_hot_bucket_grow_with_its_members(spark, n):
    """At most a row for each pair of blocks and dealing, where cells alone would make n * n / 16 of them."""
    rng = random.Random(1)
    prints = sorted({(5 << 43) | rng.getrandbits(43) for _ in range(n)})
    df = tuned(spark).createDataFrame([(p,) for p in prints], "fp long")
    cells = simhash._cells(df, 4, 16)
    assert cells.count() < 2 * 15 * n < n * n / 16
    assert cells.filter("path >= 15").count() > 0


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    for n, m in ((1, 0), (30, 12), (60, 70)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        chain = [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 50)]
        df = tuned(spark).createDataFrame(edges + chain, "a long, b long")
        got = {r.node: r.root for r in components(df).collect()}
        linked = {x for e in edges + chain for x in e if e[0] != e[1]}
        assert got == {x: r for x, r in brute.roots({x for e in edges + chain for x in e}, edges + chain).items() if x in linked}


def expected_groups(rows):
    prints = [brute.fingerprint(t) for _, t in rows]
    group = brute.near_groups(prints)
    least = {}
    for (id_, _), p in zip(rows, prints):
        if id_ is not None:
            least[group[p]] = min(id_, least.get(group[p], id_))
    return sorted((str(i), f"{p:016x}", str(least.get(group[p]))) for (i, _), p in zip(rows, prints))


def test_documents(docs, texts):
    rows = [(i, t) for i, t, _ in texts] + [(1000 + k, t) for k, t in enumerate(EDGES)]
    rows += [(None, "quite alone in here with no other"), (7, texts[7][1]), (None, texts[7][1])]
    df = docs(rows).withColumns({"fp": F.lit(1), "root": F.lit(2), "_t": F.lit(3), "component_id": F.lit(4)})
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(df).collect())
    assert got == expected_groups(rows)
    kept = simhash.drop_near(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({c for _, _, c in got})


def test_empty(docs):
    df = docs([(1, "a")]).limit(0)
    assert simhash.near_duplicates(df).count() == 0 and simhash.drop_near(df).count() == 0
    assert [tuple(r) for r in simhash.near_duplicates(docs([(1, "a b")])).collect()][0][2] == 1
