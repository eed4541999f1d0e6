import random

import brute
import numpy as np
import pytest

from harborline.llm import catalog, minhash

COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def expected(rows):
    return sorted((i, n, rows[g][0], rows[g][0] == i) for (i, _), (n, g) in zip(rows, brute.similar_groups([t for _, t in rows])))


def result(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def copies(seed, groups, size, length, changes):
    draw = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{draw.randrange(5000)}" for _ in range(length)]
        for _ in range(size):
            copy = list(base)
            for _ in range(draw.randrange(changes + 1)):
                copy[draw.randrange(length)] = f"x{draw.randrange(10 ** 6)}"
            out.append(" ".join(copy))
    draw.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("cell, share", [(minhash.CELL, minhash.SHARE), (7, 3)])
def test_against_all_pairs(docs, cell, share):
    """Groups whose members are partly within reach of each other, so that centres do not settle them."""
    rows = copies(5, 12, 14, 90, 5) + [(1000 + i, t) for i, t in copies(6, 4, 30, 30, 1)]
    assert result(minhash.near_duplicates(docs(rows), cell=cell, share=share)) == expected(rows)


def test_query_against_all_pairs(spark, folder, texts):
    rows = sorted((i, t) for i, t, _ in texts)
    found = catalog.QUERIES["op12_minhash"](spark, folder)
    assert found.columns == COLUMNS
    assert result(found) == expected(rows)


def test_texts(docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A\tb"), (6, "a"), (7, "É e f g h"), (8, "é e f g h"),
            (9, "one two three four five"), (10, "ONE two  three four five"), (11, "word " * 50), (12, "word " * 70)]
    assert result(minhash.near_duplicates(docs(rows))) == expected(rows)


def test_rows(docs):
    assert minhash.near_duplicates(docs([])).count() == 0
    same = "the same few words of a text"
    rows = docs([(None, same), (4, same), (4, same), (9, same + " more"), (None, "alone in here with a null"), (None, None)])
    rows = rows.withColumnsRenamed({"lang": "node", "source": "digest", "n_chars": "key"})
    got = minhash.near_duplicates(rows).collect()
    assert sorted(((r.doc_id or 0), r.n_shingles, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, 0, True), (0, 3, 0, True), (0, 4, 4, False), (4, 4, 4, True), (4, 4, 4, True), (9, 5, 4, False)]


def test_threshold_is_exact(docs):
    """8 of 10 shingles link, 11 of 14 (0.786) do not."""
    near = [(1, "a b c d e f g h i j k l"), (2, "a b c d e f g h i j k z")]  # 8 of 9 + 1 = 10
    far = [(3, "A1 b1 c1 d1 e1 f1 g1 h1 i1"), (4, "A1 b1 c1 d1 e1 f1 g1 h1 z1 z2")]
    rows = near + far
    assert result(minhash.near_duplicates(docs(rows))) == expected(rows)


def test_long_text(docs):
    base = [f"w{i}" for i in range(60_000)]
    other = base[:30_000] + ["changed"] * 2000 + base[32_000:]
    rows = [(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(base[:30_000]))]
    assert result(minhash.near_duplicates(docs(rows))) == expected(rows)


def test_sketches_estimate_similarity():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 1 << 63, 4000).astype(np.uint64)
    for size, shared in ((1, 1), (3, 2), (40, 30), (2000, 1500)):
        a, b = pool[:size], np.concatenate([pool[:shared], pool[size:2 * size - shared]])
        rows = minhash.sketches([a, b], 1600)
        assert (rows != np.iinfo(np.uint64).max).all()
        assert abs((rows[0] == rows[1]).mean() - shared / (2 * size - shared)) < 0.06
    assert (minhash.sketches([pool[:50]], 160) == minhash.sketches([pool[:50][::-1], pool], 160)[0]).all()


def test_percent(docs):
    with pytest.raises(ValueError):
        minhash.near_duplicates(docs([]), percent=0)
