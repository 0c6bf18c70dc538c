"""Fingerprints of 256 bits, their groups and their classes against brute force; recall against all pairs of shingle sets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from longspan.llm import nearprints as N
from longspan.llm.words import hashes, mix, shingles

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KEYS = [sum(1 << int(b) for b in N.key_bits(t)) for t in range(N.TABLES)]


def sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(w[i:i + N.WIDTH]) for i in range(max(1, len(w) - N.WIDTH + 1))} if w else set()


def fingerprint(text):
    """Bit by bit, as a whole number whose bit 64 k + b is bit b of word k."""
    found = sets(text)
    out = 0
    values = [shingles(mix(hashes(pa.array([x.encode() for x in s], pa.binary()))), len(s)) for s in found]
    for k in range(N.PRINT_WORDS):
        h = [int(mix(v + np.array([k + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]) for v in values]
        out |= sum(1 << (64 * k + b) for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return out


def linked(x, y):
    differ = x ^ y
    return differ.bit_count() <= N.BUDGET and any(not differ & key for key in KEYS)


def classes(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if linked(prints[i], prints[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def texts(seed=0, n=40):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Ab", "cd", "É", "x\x85y", "1", "zz."]) + str(rng.randrange(300))
    out = [" ".join(word() for _ in range(rng.randrange(150))) for _ in range(n)]
    for t in out[:25]:
        w = t.split(" ")
        for edits in (1, 2, 4):
            if len(w) > 10:
                w[rng.randrange(len(w))] = word()
                out.append("\t".join(w) if edits % 2 else "\n".join(w))
    return out + out[:20] + ["", None, " \n", "one", "One", "one two three", "a " * 20_000]


def as_ints(prints):
    return [sum(int(v) << (64 * k) for k, v in enumerate(row)) for row in prints]


def test_fingerprints():
    t = texts()
    assert as_ints(N.fingerprints(pa.array(t, pa.string()))) == [fingerprint(x) for x in t]
    assert N.fingerprints(pa.array([], pa.string())).shape == (0, N.PRINT_WORDS)
    back = N._as_words(N._as_bytes(N.fingerprints(pa.array(t, pa.string()))))
    assert as_ints(back) == [fingerprint(x) for x in t]


def family(rng, n, spread):
    base, out = rng.getrandbits(256), set()
    while len(out) < n:
        x = base
        for _ in range(rng.randrange(spread + 1)):
            x ^= 1 << rng.randrange(256)
        out.add(x)
    return out


@pytest.mark.parametrize("centred", [512, 20])
def test_groups_link_like_all_pairs(monkeypatch, centred):
    monkeypatch.setattr(N, "CENTRED", centred)
    monkeypatch.setattr(N, "CHUNK", 500)
    rng = random.Random(centred)
    groups = [family(rng, 60, 70) | family(rng, 30, 30) | {rng.getrandbits(256) for _ in range(20)} for _ in range(3)] + [{5}]
    rows = [sorted(tuple((x >> (64 * k)) % (1 << 64) for k in range(N.PRINT_WORDS)) for x in g) for g in groups]
    first = np.cumsum([0, *map(len, rows)])
    label = N.group_links(np.array([r for g in rows for r in g], np.uint64), first)
    for g, a, b in zip(rows, first[:-1], first[1:], strict=True):
        root = list(range(len(g)))
        for i in range(len(g)):
            for j in range(i):
                if sum((x ^ y).bit_count() for x, y in zip(g[i], g[j], strict=True)) <= N.BUDGET:
                    low, high = sorted((root[i], root[j]))
                    root = [low if r == high else r for r in root]
        mine = (label[a:b] - a).tolist()
        assert len({(r, m) for r, m in zip(root, mine, strict=True)}) == len(set(root)) == len(set(mine))


@pytest.mark.parametrize("group_rows", [N.GROUP_ROWS, 2])
def test_one_of_each_class(spark, group_rows):
    t = texts(3)
    rows = [(k if k % 17 else None, x, "f", k) for k, x in enumerate(t)] + [(5, t[5], "f", 900), (5, t[5], "f", 900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string, place int")
    roots = classes([fingerprint(r[1]) for r in rows])
    least = {}
    for r, c in zip(rows, roots, strict=True):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    kept = N.keep_one(docs, group_rows=group_rows)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((least.get(c) for c in set(roots)), key=str)
    assert N.keep_one(docs.limit(0)).count() == 0


def test_recall_against_all_pairs_and_other_texts_stay():
    rng = random.Random(9)
    plain, pairs = [], []
    for _ in range(150):
        a = [f"w{rng.randrange(5_000)}" for _ in range(rng.randrange(80, 300))]
        b = list(a)
        for _ in range(max(1, len(b) // 60)):
            b[rng.randrange(len(b))] = "edited"
        pairs.append((len(plain), len(plain) + 1))
        plain += [" ".join(a), " ".join(b)]
    found = [sets(x) for x in plain]
    prints = as_ints(N.fingerprints(pa.array(plain)))
    near = [(a, b) for a, b in pairs if len(found[a] & found[b]) >= 0.8 * len(found[a] | found[b])]
    caught = sum(linked(prints[a], prints[b]) for a, b in near)
    assert len(near) > 100 and caught >= 0.95 * len(near)
    assert not any(linked(prints[2 * i], prints[2 * j]) for i in range(150) for j in range(i))


def test_pairs_at_the_budget_are_linked(spark):
    """Tables are enough for the farthest pairs that count as linked, not for the usual ones only."""
    rng = random.Random(12)
    pairs = []
    for _ in range(300):
        x = rng.getrandbits(256)
        pairs.append((x, x ^ sum(1 << b for b in rng.sample(range(256), N.BUDGET))))
    rows = np.array([[x >> (64 * k) & (1 << 64) - 1 for k in range(N.PRINT_WORDS)] for p in pairs for x in p], np.uint64)
    told = N._as_bytes(rows).to_pylist()
    prints = spark.createDataFrame([(bytearray(x),) for x in told], "fp binary")
    found = {frozenset((bytes(r.a), bytes(r.b))) for r in N.links(prints).collect()}
    assert found <= {frozenset(told[2 * k:2 * k + 2]) for k in range(300)}
    assert len(found) >= 0.97 * len(pairs)


def test_fingerprinting_takes_little_memory():
    """Blocks of ``TEXT_BYTES`` bound what a task holds; one more bound is on the bits that are unpacked at a time."""
    import tracemalloc
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(20_000)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(500)) for _ in range(N.TEXT_BYTES // 3000)]
    texts = pa.array(texts)
    N.fingerprints(texts.slice(0, 2))
    tracemalloc.start()
    N.fingerprints(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
