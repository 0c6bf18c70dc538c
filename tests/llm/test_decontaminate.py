"""Suffix-array decontamination against plain window search."""

import hashlib
import random
import re

import numpy as np
import pytest

from longspan.llm import decontaminate as D

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))


def expected(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item_id, t in items:
            i = words(t)
            n = min(window, len(i))
            windows = {tuple(i[p:p + n]) for p in range(len(i) - n + 1)} if n else set()
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in windows:
                    hit |= set(range(p, p + n))
                    if item_id is not None:
                        found.add(str(item_id))
        names = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def corpus(seed, vocabulary=6, n_docs=40, n_items=12):
    rng = random.Random(seed)
    vocab = ["a", "bb", "éc", "D", "e1", "ff"][:vocabulary]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", ".\n"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(n_items)]
    docs = [(i, text(rng.randrange(60))) for i in range(n_docs)]
    docs += [(100 + k, text(20) + " " + t.upper() + " " + text(5)) for k, t in items]
    return docs, items


def test_suffix_array_orders_to_the_wanted_depth():
    rng = np.random.default_rng(0)
    for values, n, depth in ((2, 300, 40), (1, 50, 60), (500, 300, 5)):
        ids = rng.integers(0, values, n)
        order = D.suffix_array(ids, depth)
        keys = [tuple(ids[i:i + depth].tolist()) for i in order]
        assert sorted(order.tolist()) == list(range(n))
        pad = [k + (-1,) * (depth - len(k)) for k in keys]
        zero = [tuple(0 if x < 0 else x for x in k) for k in pad]
        assert zero == sorted(zero)


@pytest.mark.parametrize("seed", range(3))
def test_windows_like_brute_force(spark, seed):
    docs, items = corpus(seed)
    docs += [(None, None), (7, ""), (8, "a bb"), (8, "a bb"), (9, "a " * 30_000)]
    items += [(None, "a bb éc D"), (3, items[3][1]), (50, None)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(map(tuple, D.digest(d, i).collect()), key=str)
    assert got == expected(docs, items)


def test_items_in_several_blocks_and_small_shards(spark):
    docs, items = corpus(9)
    d = spark.createDataFrame([(i, t, "m", 1) for i, t in docs], "doc_id bigint, text string, match string, n_words int")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    found = D.scan(d, i, item_bytes=300, shard_bytes=500)
    want = {k: (n, h, names) for k, n, h, names, *_ in expected(docs, items)}
    assert len(D.item_blocks(i, "item_id", "text", 300)) > 2
    for r in found.collect():
        hit = sum(b - a for a, b in zip(r._match.starts, r._match.ends))
        assert (r._match.n_words, hit, len(r._match["items"])) == want[r.doc_id] and r.match == "m" and r.n_words == 1
    kept = D.remove_contaminated(d, i)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, v in want.items() if not v[1]}


def test_longest_matches(spark):
    docs = [(5, "x a b c d y"), (2, "a b c z"), (1, "b c d e"), (9, "a b c d"), (None, "q")]
    items = [(1, "A b c d e"), (2, "nothing here"), (3, "q")]
    got = D.longest_matches(spark.createDataFrame(docs, "doc_id bigint, text string"),
                            spark.createDataFrame(items, "item_id bigint, text string"))
    rows = {r.item_id: (r.length, r.doc_id, r.first_word) for r in got.collect()}
    assert rows["1"] == (4, 1, 0) and "2" not in rows and rows["3"][0] == 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert D.digest(none, items).count() == 0
    assert D.digest(some, items).first().n_hit == 0


def longest_by_words(doc, item):
    """Longest match of each item suffix, and how often it stands, by comparing word by word."""
    out = []
    for i in range(len(item)):
        best = {}
        for p in range(len(doc)):
            n = 0
            while i + n < len(item) and p + n < len(doc) and doc[p + n] == item[i + n]:
                n += 1
            best.setdefault(n, []).append(p)
        top = max(best)
        out.append((top, sorted(best[top]) if top else None))
    return out


@pytest.mark.parametrize("walk", [2, 64])
def test_long_matches_are_whole(monkeypatch, walk):
    monkeypatch.setattr(D, "WALK", walk)
    rng = random.Random(walk)
    for vocab, n in ((["a"], 90), (["a", "b"], 120), ([f"w{k}" for k in range(40)], 200)):
        doc = [rng.choice(vocab) for _ in range(n)]
        item = [rng.choice(vocab) for _ in range(7)] + doc[15:85] + ["zz"] + doc[5:40] + doc[5:40]
        items = D.prepare_items([1], [" ".join(item)])
        _, _, order, _, found = D._shard(D.pa.array([" ".join(doc)]), items)
        for i, (length, places) in enumerate(longest_by_words(doc, item)):
            assert found.length[i] == length
            if length:
                assert sorted(order[found.lo[i]:found.hi[i]].tolist()) == places


def test_long_verbatim_items_take_seconds():
    import time
    rng = np.random.default_rng(3)
    for text in (" ".join(map(str, rng.integers(0, 5000, 100_000).tolist())), "same " * 20_000):
        items = D.prepare_items(["long"], [text])
        began = time.time()
        counts, hit, doc, item = D._mark(D.pa.array(["before " + text]), items)
        assert hit.sum() == counts[0] - 1 and item.tolist() == [0]
        assert time.time() - began < 60
