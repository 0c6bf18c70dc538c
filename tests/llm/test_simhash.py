"""SimHash fingerprints and the trie self-join against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from longspan.llm import simhash as S
from longspan.llm.components import components, local_components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    runs = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def classes(prints, budget=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def texts(seed=0, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Ab", "cd", "É", "x\x85y", "1", "zz."]) + str(rng.randrange(30))
    out = [" ".join(word() for _ in range(rng.randrange(80))) for _ in range(n)]
    for t in out[:60]:
        w = t.split(" ")
        if len(w) > 10:
            w[rng.randrange(len(w))] = word()
        out.append("\t".join(w))
    return out + out[:20] + ["", None, " \n", "one", "One", "one two three", "a " * 20_000]


def test_fingerprints():
    t = texts()
    got = S.fingerprints(pa.array(t, pa.string()))
    assert [int(x) for x in got] == [fingerprint(x) for x in t]
    assert len(S.fingerprints(pa.array([], pa.string()))) == 0


def family(rng, n, spread):
    base = rng.getrandbits(64)
    out = set()
    while len(out) < n:
        x = base
        for _ in range(rng.randrange(spread + 1)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_trie_walk_links_like_all_pairs(monkeypatch, seed):
    monkeypatch.setattr(S, "FRONTIER", 64)
    monkeypatch.setattr(S, "LINKS", 50)
    monkeypatch.setattr(S, "LEAF_PAIRS", 4)
    rng = random.Random(seed)
    groups = [sorted(family(rng, 60, 9) | family(rng, 20, 3) | {rng.getrandbits(64) for _ in range(30)}) for _ in range(3)] + [[5]]
    first = np.cumsum([0, *map(len, groups)])
    label = S.trie_links(np.array([x for g in groups for x in g], np.uint64), first)
    for g, a, b in zip(groups, first[:-1], first[1:], strict=True):
        assert (label[a:b] - a).tolist() == classes(g)


@pytest.mark.parametrize("group_rows", [50_000, 20])
def test_links_over_tables(spark, group_rows):
    rng = random.Random(4)
    prints = sorted(family(rng, 150, 8) | family(rng, 60, 4) | {rng.getrandbits(64) for _ in range(80)} | {0, 1 << 63})
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp bigint")
    got = components(S.links(df, group_rows=group_rows)).collect()
    root = {r.node % (1 << 64): r.root % (1 << 64) for r in got}
    want = classes(prints)
    mine = {}
    for i, x in enumerate(prints):
        mine.setdefault(want[i], set()).add(root.get(x, x))
    assert all(len(v) == 1 for v in mine.values()) and len({min(v) for v in mine.values()}) == len(mine)


def test_query_and_one_of_each_class(spark):
    t = texts(3)
    rows = [(k if k % 17 else None, x, "f", k) for k, x in enumerate(t)] + [(5, t[5], "f", 900), (5, t[5], "f", 900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string, component_id int")
    prints = [fingerprint(r[1]) for r in rows]
    roots = classes(prints)
    least = {}
    for r, c in zip(rows, roots, strict=True):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted(((r[0], f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, roots, strict=True)), key=str)
    assert sorted(map(tuple, S.near_duplicates(docs).collect()), key=str) == want
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert len(got) == len(set(roots))
    assert sorted((r.doc_id for r in got), key=str) == sorted((least.get(c) for c in set(roots)), key=str)
    assert S.near_duplicates(docs.limit(0)).count() == 0 and S.keep_one(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7), (None, 3)]
    root = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    nodes = sorted({x for e in real for x in e})
    place = {x: i for i, x in enumerate(nodes)}
    label = local_components(len(nodes), np.array([place[a] for a, _ in real]), np.array([place[b] for _, b in real]))
    assert root == {x: nodes[label[i]] for i, x in enumerate(nodes)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
