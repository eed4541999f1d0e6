"""Plain versions of the operators, for comparison on small inputs."""

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import tiktoken
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECE = re.compile(r"[#*$%&|<>]+|[^#*$%&|<>]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def fingerprint(text, n=4):
    found = words(lower(text))
    shingles = [" ".join(found[i:i + n]) for i in range(len(found) - n + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if hashes else 0


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_groups(prints, radius=4):
    """Group of every fingerprint."""
    distinct = sorted(set(prints))
    close = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= radius]
    return roots(distinct, close)


def base(text):
    text = text or ""
    found = words(text)
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(found) - 4):
        windows[tuple(found[i:i + 5])].append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered))


def buckets(text, size):
    found = [piece for word in words(text) for piece in PIECE.findall(word)]
    one = [xxhash.xxh64_intdigest(w.encode(), 42) for w in found]
    two = [xxhash.xxh64_intdigest(b.encode(), h) for h, b in zip(one, found[1:])]
    return [(h - (1 << 64) if h >> 63 else h) % size for h in one + two]


def quality(docs, trusted, size, threshold, unit=1 << 20, smoothing=20.0):
    """(n_words, ..., base_failed, kept) for (id, text) rows."""
    raw, good = Counter(), Counter()
    for id_, text in docs:
        raw.update(buckets(text, size))
        if id_ in trusted:
            good.update(buckets(text, size))
    share = sum(good.values()) / max(sum(raw.values()), 1)
    weight = {b: round(math.log((good[b] + smoothing) / (raw[b] * share + smoothing)) * unit) for b in raw}
    if not good:
        weight = dict.fromkeys(raw, 0)
    out = []
    for id_, text in docs:
        numbers, found = base(text), buckets(text, size)
        failed = numbers[0] < 10 or 100 * numbers[4] > 20 * numbers[0]
        score = sum(weight[b] for b in found) / unit / len(found) if found else None
        out.append((id_, *numbers, failed, bool(not failed and score >= threshold)))
    return out


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Target by source, from total sizes by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = Fraction(sum(sizes.values())), set(order), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * share > cap * sizes[s]}
        if not full:
            return out | {s: float(weight[s] * share) for s in open_}
        out |= {s: float(cap * sizes[s]) for s in full}
        left -= sum(cap * sizes[s] for s in full)
        open_ -= full
    return out


def uniform(id_, text, seed="mix-1"):
    key = hashlib.md5((text or "").encode()).hexdigest() if id_ is None else id_
    return int(hashlib.md5(f"{key}:{seed}".encode()).hexdigest()[:13], 16) / (1 << 52)


def mix(docs):
    """Copies of every (id, text, source) row."""
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(words(text))
    wanted = targets(sizes)
    out = []
    for id_, text, source in docs:
        rate = wanted[source] / sizes[source] if sizes[source] else 0.0
        out.append(math.floor(rate) + (uniform(id_, text) < rate - math.floor(rate)))
    return out


def encoding(path, pattern):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def shingle_set(text, n=4):
    found = words(lower(text))
    return {" ".join(found[i:i + n]) for i in range(len(found) - n + 1)} or ({" ".join(found)} if found else set())


def similar_groups(texts, percent=80):
    """Group (its least place) of every text, and the size of its set."""
    sets = [shingle_set(t) for t in texts]
    holds = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holds[x].append(i)
    edges = []
    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in holds[x] if j < i)
        edges += [(i, j) for j, n in both.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)]
    found = roots(range(len(texts)), edges)
    return [(len(s), found[i]) for i, s in enumerate(sets)]
