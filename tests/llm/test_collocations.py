import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from longspan.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string, n bigint, words string, rank int"


def plain(rows, best=2000):
    found, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        totals[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 5):
                found.setdefault(lang, Counter()).update(tuple(words[k:k + m]) for k in range(len(words) - m + 1))
    out = []
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= 30}
        kept = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[k:k + len(p)] == p for k in range(len(q) - len(p) + 1))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r + 1, p.decode(), -a, left, right, totals[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(kept)[:best])]
    return sorted(out)


def rows_of(seed=1, n=400):
    random = np.random.default_rng(seed)
    names = np.array(["of", "the", "New", "york", "straße", "日本", "o'clock", "a-b", "\x0b", "x y", "É", "red", "hot"])
    weight = 1 / np.arange(1, len(names) + 1)
    rows = []
    for i in range(n):
        words = random.choice(names, int(random.integers(0, 60)), p=weight / weight.sum())
        marks = random.choice([" ", "  ", "\t", ". ", ",", "\n", " \r\n", "!", "\x0c"], len(words), p=[0.6, 0.1, 0.05, 0.08, 0.07, 0.04, 0.02, 0.02, 0.02])
        text = "".join(w + m for w, m in zip(words, marks)) + ("Machine  Learning\tmodel rules. " * 2 if i % 4 == 0 else "")
        rows.append((i, text, [None, "en", "en", "de"][i % 4], 1, "w", 2))
    return rows + rows[:40] + [(None, None, "en", None, None, None), (1, "", None, 1, "", 1), (2, " ,. \n", "xx", 1, "", 1), (3, "in the end " * 5000, "fr", 1, "", 1)]


@pytest.mark.parametrize("best,lookup_rows", [(2000, 1 << 20), (5, 0)])
def test_equals_plain_counting(spark, best, lookup_rows):
    """With numbers in a broadcast and by joins."""
    rows = rows_of()
    got = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), best=best, lookup_rows=lookup_rows)
    want = plain(rows, best)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 8
    assert dict(got.dtypes)["rank"] == "bigint" and dict(got.dtypes)["score"] == "bigint"


def test_empty_and_rare(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, "once only here", "en", 1, "", 1)], SCHEMA)).collect() == []


def test_phrase_counts_and_ids_beyond_the_corner(spark):
    """Sparse cells: more frequent words than the dense corner has rows."""
    n = collocations.TILE * collocations.CORNER + 200
    words = [f"w{k}" for k in range(n)]
    texts = [" ".join(words[k:k + 700]) for k in range(0, n, 700)] * 30
    phrases, _, _ = collocations.phrase_counts(spark.createDataFrame([(i, t, "en", 1, "", 1) for i, t in enumerate(texts)], SCHEMA))
    got = {(r["size"], r["f"]): r["count"] for r in phrases.groupBy("size", "f").count().collect()}
    pieces = -(-n // 700)
    assert got == {(m, 30): n - pieces * (m - 1) for m in range(1, 5)}


@pytest.mark.parametrize("lookup_rows", [1 << 20, 0])
def test_many_buckets_and_groups(spark, monkeypatch, lookup_rows):
    """As many buckets, cells of known pairs and groups as a much larger input has give the same phrases."""
    for name, rows in (("SPARSE_ROWS", 500), ("KNOWN_ROWS", 100), ("HELD_ROWS", 2000)):
        monkeypatch.setattr(collocations, name, rows)
    words = [f"w{k}" for k in range(collocations.TILE * collocations.CORNER + 600)]
    texts = [" ".join(words[k:k + 700]) for k in range(0, len(words), 700)] * 30
    docs = spark.createDataFrame([(i, t, "en", 1, "", 1) for i, t in enumerate(texts)], SCHEMA).repartition(7)
    phrases, _, _ = collocations.phrase_counts(docs, lookup_rows=lookup_rows)
    pieces = -(-len(words) // 700)
    assert {(r["size"], r["f"]): r["count"] for r in phrases.groupBy("size", "f").count().collect()} == {
        (m, 30): len(words) - pieces * (m - 1) for m in range(1, 5)}


def test_rows_dealt_out_by_a_block_do_not_grow_with_the_buckets(spark):
    """Buckets are as many as the input is large: a row for each of them from each block would be the square of it."""
    random, n_blocks, buckets = np.random.default_rng(6), 12, 900
    sequences = [random.integers(0, 60_000, 20_000) for _ in range(n_blocks)]
    coded = [(k, *[bytearray(collocations.pack(x))] * 2) for k, x in enumerate(sequences)]
    blocks = spark.createDataFrame(coded, "block bigint, heads binary, tokens binary").repartition(3)
    rows = collocations._count_blocks(blocks, 1, buckets)
    assert rows.count() <= n_blocks * (collocations.CORNER ** 2 + 2 * buckets ** 0.5)
    whole = Counter()
    for r in collocations._add_up(rows, F.col("block"), 1, buckets).collect():
        steps, columns, counts = (collocations.unpack(bytes(r[c])) for c in ("rows", "columns", "counts"))
        heads = np.cumsum(steps)
        assert set(collocations._cells(heads, columns, buckets).tolist()) == {r["cell"]}
        for h, t, f in zip(heads.tolist(), columns.tolist(), counts.tolist(), strict=True):
            whole[h, t] += f
    assert whole == Counter(p for x in sequences for p in zip(x[:-1].tolist(), x[1:].tolist(), strict=True))


def test_pieces_never_join_texts():
    words, sequence = collocations.pieces(pa.array(["a b", "b,a", None, "", "!", "A"]))
    told = [None if x < 0 else words[int(x)].as_py().decode() for x in sequence]
    assert told == [None, "a", "b", None, "b", None, "a", None, "a"]


@pytest.mark.parametrize("cell", [0, 6, -1])
def test_tally_adds_up(cell):
    random = np.random.default_rng(2)
    row, column = (cell // collocations.CORNER * collocations.TILE, cell % collocations.CORNER * collocations.TILE) if cell >= 0 else (10 ** 12, 5)
    tally, want = collocations.Tally(cell), Counter()
    for n in (5, 200_000, 40):
        r, c, f = random.integers(0, 90, n) + row, random.integers(0, 1000, n) + column, random.integers(1, 9, n)
        tally.add(r, c, f)
        for x in zip(r.tolist(), c.tolist(), f.tolist()):
            want[x[:2]] += x[2]
    r, c, f = tally.result()
    assert dict(zip(zip(r.tolist(), c.tolist()), f.tolist())) == want


def test_find_pairs():
    known, ids, _ = collocations._keyed(np.array([3, 1, 3]), np.array([4, 9, 2]), np.array([70, 71, 72]))
    at = collocations.find_pairs(known, np.array([1, 3, 3, 2, 1]), np.array([9, 2, 3, 4, 9]))
    assert [None if x < 0 else ids[x] for x in at] == [71, 72, None, None, 71]
    assert collocations.find_pairs(known, np.zeros(0, int), np.zeros(0, int)).tolist() == []
    large, _, _ = collocations._keyed(np.array([3 << 40, 1, 3 << 40]), np.array([4 << 40, 9, 2]), np.arange(3))
    assert collocations.find_pairs(large, np.array([3 << 40, 5, 1]), np.array([4 << 40, 9, 9])).tolist() == [2, -1, 0]


@pytest.mark.parametrize("top", [-1, 0, 254, 255, 70_000, 1 << 40])
def test_packed_numbers_come_back(top):
    x = np.array([-1, 0, top, 5])
    assert collocations.unpack(collocations.pack(x)).tolist() == x.tolist()
    assert collocations.unpack(collocations.pack(x[:0])).tolist() == []
