import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from harborline.llm import alignment, catalog
from harborline.llm.frames import tuned

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=B)


SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SYMBOLS = {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in SHOWN)}


def _bytes_a(token):
    return bytes(SYMBOLS[c] for c in token)


def _bytes_b(piece):
    return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece[:3] == "<0x" else piece.replace("▁", " ").encode()


def plain(texts, libraries):
    """Numbers, digest and links of every text by loops over spans."""
    one, two = libraries
    rows, corpus = [], Counter()
    for text in texts:
        data = b" " + (text or "").encode()
        spans = []
        for ids, name in ((one.encode(" " + (text or ""), add_special_tokens=False).ids, lambda i: _bytes_a(one.id_to_token(i))),
                          (two.encode(text or ""), lambda i: _bytes_b(two.id_to_piece(i)))):
            at, own = 0, []
            for i in ids:
                own.append((at, at := at + len(name(i)), i))
            spans.append((own, b"".join(map(name, ids)) == data))
        if not text or not all(ok for _, ok in spans):
            rows.append(([], [], [], ""))
            continue
        (a, _), (b, _) = spans
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        told = []
        sides = [iter(a), iter(b)]
        for end in ends:
            halves = []
            for side in sides:
                halves.append([])
                while not halves[-1] or last < end:
                    _, last, i = next(side)
                    halves[-1].append(str(i))
            told.append("|".join(map(",".join, halves)))
        owner = {k: y for y in b for k in range(y[0], y[1])}
        links = [(x[2], y[2]) for x in a for y in dict.fromkeys(owner[k] for k in range(x[0], x[1]))]
        corpus.update(links)
        rows.append((a, b, links, ";".join(told)))
    top = {}
    for (_, b), n in corpus.items():
        top[b] = max(top.get(b, 0), n)
    return [(len(a), len(b), told.count(";") + bool(told), len(links), sum(corpus[x] == top[x[1]] for x in links),
             sum(corpus[x] for x in links), hashlib.sha256(told.encode()).hexdigest() if told else "")
            for a, b, links, told in rows]


ODD = ["", None, "a", "a b", "  two  blanks ", "tab\tand\nline", "café naïve 你好世界 \U0001f600", "<|endoftext|> and <s> </s> <unk>",
       "word " * 40, "word " * 40, "x" * 700, "▁odd▁", " nbsp", "é combining", "12 345 6789", "A\u0000B"]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("block", [alignment.BLOCK, 50])
def test_against_loops(docs, libraries, texts, block):
    some = [t for _, t, _ in texts[:60]]
    rows = [*enumerate([*ODD, *some])]
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.alignment(docs(rows), A, B, block=block).collect()}
    assert [got[i] for i, _ in rows] == plain([t for _, t in rows], libraries)


def test_query_reads_the_whole_table(spark, folder, texts, libraries):
    result = catalog.QUERIES["op13_token_alignment"](spark, folder)
    assert result.columns[0] == "doc_id"
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in result.collect()}
    expected = plain([t for _, t, _ in texts], libraries)
    assert [got[i] for i, _, _ in texts] == expected


def test_rows(spark, docs):
    empty = alignment.alignment(docs([]), A, B)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = docs([(None, "one two"), (1, "one two"), (1, "one two"), (2, None)]).withColumnsRenamed({"lang": "_id", "source": "links"})
    got = sorted((str(r.doc_id), r.n_links, r.count_sum) for r in alignment.alignment(rows, A, B).collect())
    n = got[0][1]
    assert n > 0 and got == [("1", n, 3 * n), ("1", n, 3 * n), ("2", 0, 0), ("None", n, 3 * n)]


def test_long_text(docs, libraries):
    text = "lorem ipsum dolor " * 9000 + "z" * 3000
    (row,) = alignment.alignment(docs([(1, text)]), A, B).collect()
    one, two = libraries
    assert row.n_a == len(one.encode(" " + text, add_special_tokens=False).ids) and row.n_b == len(two.encode(text))


def test_links_of_both_kinds(docs):
    text = "unbelievable tokenisation xyzzy café"
    overlap = alignment.token_links(docs([(1, text)]), A, B).collect()
    assert sum(r.weight for r in overlap) == len(text.encode()) + 1
    groups = {(r.token_a, r.token_b) for r in alignment.token_links(docs([(1, text)]), A, B, "group").collect()}
    assert groups >= {(r.token_a, r.token_b) for r in overlap}
    with pytest.raises(ValueError):
        alignment.token_links(docs([]), A, B, "other")


def test_product_against_dense():
    draw = np.random.default_rng(3)
    left, right = draw.integers(0, 2, (7, 9)), draw.integers(0, 2, (9, 5))

    def sparse(m):
        rows, cols = np.nonzero(m)
        return alignment.incidence(np.searchsorted(rows, np.arange(len(m) + 1)), cols, m.shape[1])

    out = alignment.product(sparse(left), sparse(right))
    dense = np.zeros((7, 5), int)
    dense[out.rows, out.cols] = out.data
    assert (dense == left @ right).all()


def test_group_links_in_blocks(monkeypatch):
    found = alignment.align(*(np.arange(n) for n in (30, 20)), np.array([2] * 30), np.array([3] * 20))
    whole = [(int(r), int(c)) for part in [*alignment.group_links(found)] for r, c in zip(part.rows, part.cols)]
    monkeypatch.setattr(alignment, "BLOCK", 7)
    parts, first = [], 0
    for part in alignment.group_links(found):
        parts += [(int(r) + first, int(c)) for r, c in zip(part.rows, part.cols)]
        first += len(part.ptr) - 1
    assert parts == whole == [(a, b) for a in range(30) for b in range(20) if a // 3 == b // 2]


def test_ranks_stand_for_the_library(libraries):
    """The faster library gives the file's ids next to every character."""
    chars = [chr(c) for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f" a{c}a1{c}1!{c}! {c} {c}a  {c}  1'{c}" for c in chars]
    expected = [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]
    assert alignment.byte_level(A).ids(texts) == expected
