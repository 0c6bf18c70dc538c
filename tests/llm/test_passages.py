"""Passage deduplication against all pairs of blocks."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from longspan.llm import passages as P
from longspan.llm.words import words
from longspan.session import shared_dir


def sentence(rng, n=None):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(4000)}" for _ in range(n or rng.randrange(4, 12))) + "."


def passage(rng, n_words=60):
    out = []
    while sum(len(s.split()) for s in out) < n_words:
        out.append(sentence(rng))
    return " ".join(out)


def text(rng, n=6):
    return "\n".join(" ".join(sentence(rng) for _ in range(rng.randrange(1, 9))) for _ in range(n))


def blocks(t):
    found, _, start, stop = P.blocks_of(pa.array([t], pa.string()))
    w = [found.dictionary[int(i)].as_py().decode() for i in found.ids]
    return {(a, b - a): " ".join(w[a:b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)}


def test_blocks_do_not_depend_on_what_stands_around():
    rng = random.Random(0)
    missed = 0
    for _ in range(100):
        p = passage(rng)
        a, b = (f"{text(rng, 2)} cut off in {p} and on it goes {text(rng, 1)}" for _ in range(2))
        missed += not set(blocks(a).values()) & set(blocks(b).values())
    assert missed == 0
    assert blocks("") == {} and blocks("too short. for that.") == {}
    assert all(n >= P.MIN_WORDS for _, n in blocks(text(rng, 20)))


def test_every_block_start_is_taken():
    sentences = [sentence(random.Random(i), 9) for i in range(12)]
    starts = {a for a, _ in blocks(" ".join(sentences))}
    assert starts >= set(range(0, 99, 9))


def wrapped(t, width):
    w = t.split()
    return "\n".join(" ".join(w[i:i + width]) for i in range(0, len(w), width))


@pytest.mark.parametrize("marks", [".", "", "\u3002", "\u061f"])
def test_passages_in_short_lines_and_without_marks(marks):
    rng = random.Random(5)
    for _ in range(50):
        p = " ".join(f"{sentence(rng, 10).rstrip('.')}{marks}" for _ in range(6))
        a, b = (f"{text(rng, 2)} cut off in {wrapped(p, n)} and on it goes {text(rng, 1)}" for n in (7, 11))
        shared = set(blocks(a).values()) & set(blocks(b).values())
        assert shared and any(s in " ".join(P.words(pa.array([p]), P.ALNUM, fold=True).dictionary.cast(pa.string()).to_pylist()) for s in shared)


def test_cuts_do_not_depend_on_other_texts():
    rng = random.Random(6)
    texts = [text(rng, 2) for _ in range(20)] + ["", "a b", "one word " * 40]
    found, _, start, stop = P.blocks_of(pa.array(texts, pa.string()))
    of, at = found.text_of[start], start - found.first[found.text_of[start]]
    for i, t in enumerate(texts):
        assert set(zip(at[of == i].tolist(), (stop - start)[of == i].tolist(), strict=True)) == set(blocks(t))


def corpus(seed):
    rng = random.Random(seed)
    shared = [passage(rng) for _ in range(4)]
    docs = [text(rng) for _ in range(30)]
    docs += [f"{text(rng, 1)} some words {p} then more {text(rng, 1)}" for p in shared for _ in range(3)]
    base = [sentence(rng, 20).rstrip(".") for _ in range(6)]
    for _ in range(25):  # near copies: one word of a line changed, in the middle or at an end
        lines = []
        for line in base:
            w = line.split()
            w[rng.choice([0, -1, 9, 10])] = f"new{rng.randrange(9)}"
            lines.append(" ".join(w) + ".")
        docs.append("\n".join(lines))
    docs += [docs[0], docs[0], docs[5], "", "x. " * 500, "der " * 3000, "der " * 3000]
    return docs


def expected(rows):
    """Classes by all pairs of contents; the rows are (doc_id, text)."""
    places = [(d is None, d if d is not None else 0, i, a, n, c, d) for i, (d, t) in enumerate(rows) for (a, n), c in blocks(t or "").items()]
    contents = sorted({p[5] for p in places})
    sets = [P.word_shingles(c) for c in contents]
    root = list(range(len(contents)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(contents)):
        for j in range(i):
            if sets[i] & sets[j] and P.similar(sets[i], sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    of = {c: find(i) for i, c in enumerate(contents)}
    groups = {}
    for p in sorted(places):
        groups.setdefault(of[p[5]], []).append(p)
    return {(p[6], p[3], p[4], g[0][6], g[0][3], p is not g[0]) for g in groups.values() if len(g) > 1 for p in g}


@pytest.mark.parametrize("chunk", [4000, 3])
def test_like_all_pairs(spark, chunk):
    docs = corpus(1)
    rows = [(i if i != 31 else None, t) for i, t in enumerate(docs)] + [(400, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, content string").coalesce(1)
    got = P.repeated_passages(df, recall=0.999999, chunk=chunk).select("doc_id", "first_word", "n_words", "first_doc_id", "first_doc_word", "removed")
    assert {tuple(r) for r in got.collect()} == expected(rows)


def test_removal(spark):
    rng = random.Random(2)
    p = passage(rng)
    rows = [(1, f"{text(rng, 2)}\n{p}", "k"), (2, f"Before. {p}\nAfter é", "k"), (3, None, "k"), (4, "", "k")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, row string")
    got = {r.doc_id: r for r in P.remove_repeats(df).collect()}
    assert got[1].text == rows[0][1] and got[3].text is None and got[4].text == "" and got[2].row == "k"
    left = got[2].text
    assert left.startswith("Before. ") and left.endswith("After é") and len(left) < len(rows[1][1]) / 2
    assert P.remove_repeats(df.limit(0)).count() == 0 and P.repeated_passages(df.limit(0)).count() == 0


def test_overlapping_blocks_are_no_repeats(spark):
    """A short sentence before a long one: two blocks that are nearly alike, and nothing stands twice."""
    rng = random.Random(4)
    rows = [(1, " ".join(f"Ab{i} {sentence(rng, 30)}".replace(" ", ". ", 1) for i in range(3)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert P.remove_repeats(df).first().text == rows[0][1]


def test_bands():
    for s, recall in ((0.8, 0.99), (0.5, 0.9)):
        b, r = P.tune_bands(s, recall)
        assert 1 - (1 - s ** r) ** b >= recall > 1 - (1 - s ** r) ** (b - 1)
    assert P.similar(frozenset("abcd"), frozenset("abcde")) and not P.similar(frozenset("abc"), frozenset("abcd"))


def test_words_helper():
    w = words(pa.array(["a b", None, "", " c "]))
    assert w.counts.tolist() == [2, 0, 0, 1] and w.start.tolist() == [0, 2, 4]


def test_little_is_stored(spark):
    """Neither the words of overlapping blocks nor rows of buckets with one content."""
    rng = random.Random(7)
    docs = [text(rng, 8) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").coalesce(1)
    folder = Path(shared_dir(spark).removeprefix("file:"))

    def stored():
        return sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    before = stored()
    P.repeated_passages(df).count()
    assert stored() - before < 2 * sum(map(len, docs))


def test_sketches_drop_no_pair_that_links():
    rng = random.Random(8)
    sets, sketches = [], []
    for _ in range(60):
        base = [f"w{rng.randrange(9 if rng.random() < 0.2 else 9000)}" for _ in range(rng.randrange(16, 80))]
        for _ in range(6):
            w = base[:len(base) - rng.randrange(4)]
            w[rng.randrange(len(w))] = rng.choice(["x", w[0]])
            found, hashed, _, _ = P.blocks_of(pa.array([" ".join(w)]))
            every = P.shingles(np.concatenate((hashed, np.zeros(P.WIDTH, np.uint64))), P.WIDTH)
            sketches.append(int(P.sketches(every, np.array([0]), np.array([len(w) - P.WIDTH + 1]))[0]))
            sets.append(P.word_shingles(" ".join(w)))
            n = sketches[-1] >> P._PARITY
            assert n == (len(sets[-1]) if len(sets[-1]) == len(w) - P.WIDTH + 1 <= P._MOST else 0)
    linked = dropped = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            may = bool(P.may_link(np.array(sketches[i]), np.array(sketches[j]))[()])
            if P.similar(a, b):
                assert may
                linked += 1
            dropped += not may
    assert linked > 30 and dropped > 10000


def test_buckets_by_all_pairs_and_by_their_first(spark):
    """Chains of near copies are one class, whether a bucket's pairs are told or its members are compared with its first content."""
    rng = random.Random(9)
    w = [f"q{rng.randrange(10 ** 6)}" for _ in range(60)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(w)))
        w[(7 * i) % 60] = f"n{i}"
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    columns = ["doc_id", "first_word", "n_words", "first_doc_id", "first_doc_word", "removed"]
    got = [{tuple(r) for r in P.repeated_passages(df, recall=0.999999, chunk=c).select(*columns).collect()} for c in (2, 4000)]
    assert got[0] == got[1] == expected(rows)
