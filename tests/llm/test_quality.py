"""Quality features against plain counting, and the label model."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from longspan.llm import quality as Q

TEXTS = ["", None, " \n\t", "one", "a b c a b c", "# x\n# x\n\n \n# x", "déjà vu déjà vu déjà\x85vu", "x|y <b> $5 50% & *", "a\nb\na\nb \na",
         "The same line.\nThe same line.\r\nThe same line.", "w " * 20_000, " ".join(f"word{i}" for i in range(60)), "q w e r t y " * 10 + "z",
         "1 2 3\x0b4\x0c5 1 2 3"]


def expected(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
        seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)), "n_dup_lines": dup,
            "n_repeat_words": len(hit), "n_distinct": len(set(w))}


def test_features():
    f = Q.features(pa.array(TEXTS, pa.string()))
    for i, t in enumerate(TEXTS):
        want = expected(t)
        assert {k: int(f[k][i]) for k in want} == want, t
    assert len(Q.features(pa.array([], pa.string()))["n_words"]) == 0


def test_accuracies_follow_agreement():
    """A rule that the others contradict loses its weight; those that agree gain."""
    v = np.array([[1, 1, -1], [-1, -1, 1], [1, 1, 1], [-1, -1, -1], [0, 0, 0]], np.int8)
    model = Q.fit(v, np.array([900.0, 700.0, 300.0, 200.0, 50.0]))
    assert model.accuracy[0] > 0.95 and model.accuracy[1] > 0.95 and model.accuracy[2] < 0.6
    assert (model.posterior(v)[:4] > 0.5).tolist() == [True, False, True, False] and model.posterior(v)[4] == 0.5
    alone = Q.fit(np.array([[-1], [0]], np.int8), np.array([500.0, 500.0]))
    assert alone.posterior(np.array([[-1]], np.int8))[0] < 0.2


def test_patterns_are_one_to_one():
    rng = np.random.default_rng(0)
    v = rng.integers(-1, 2, (200, len(Q.RULES))).astype(np.int8)
    assert (Q._unpack(Q.pattern(v), len(Q.RULES)) == v).all()


def prose(i, n=80):
    letters = "aeioulnrst"
    return " ".join(("Satz" if k % 7 == 0 else "wort") + "".join(letters[int(d)] for d in str((i * 31 + k * k) % 997))
                    + ("." if k % 9 == 8 else "") for k in range(n))


def test_query(spark):
    rows = [(i, prose(i)) for i in range(30)] + [(100 + i, " ".join(f"{w}###" for w in prose(i).split())) for i in range(4)]
    rows += [(200 + i, prose(i).upper().replace(" ", "!! ")) for i in range(4)] + [(300, "few words"), (None, None), (301, "buy now " * 60)]
    rows += [rows[0]]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, quality int")
    got = Q.digest(docs).collect()
    assert len(got) == len(rows)
    kept = Counter(r.doc_id for r in got if r.kept)
    assert kept == Counter([*range(30), 0])
    assert {r.doc_id for r in got if r.base_failed} == {300, None, 301}
    own = Q.keep_good(docs)
    assert own.columns == docs.columns and Counter(r.doc_id for r in own.collect()) == kept
    assert Q.digest(docs.limit(0)).count() == 0


def test_labelled_documents(spark, sf):
    """Held against the given labels: nothing good is lost beyond the floor, nearly all bad ones go."""
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = Q.digest(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in got}
    assert n.get((1, False), 0) == 0 and n.get((0, True), 0) <= 0.05 * (n.get((0, False), 0) + n.get((0, True), 0))


def test_verdict_equals_all_must_pass(spark, sf):
    """As the README says: votes of the given rules never conflict, so the fit changes no verdict."""
    texts = pa.array([r.text for r in spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet").select("text").collect()])
    f = Q.features(texts)
    v = Q.votes(f)
    fired = (v == Q.BAD).any(1)
    assert fired.any() and not (fired & (v == Q.GOOD).any(1)).any()
    numbers, count = np.unique(Q.pattern(v)[f["n_words"] > 0], return_counts=True)
    for model in (Q.fit(Q._unpack(numbers, len(Q.RULES)), count.astype(float)), Q.LabelModel(np.full(len(Q.RULES), Q.ACCURACY))):
        assert ((model.posterior(v) >= 0.5) == ~fired).all()
