"""License rules against plain search for the base phrases, and suppression by hand."""

import random
import re

import pyarrow as pa

from longspan.llm import licenses as L

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    places, labels = [], set()
    for phrase, label in L.BASE:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def corpus():
    rng = random.Random(5)
    parts = ["gnu", "General", "public", "LICENSE", "apache", "license", "cc", "by", "mit", "License", "é", "x-1", "version", "2.0", "sa", "\n"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(200)]
    return texts + ["", None, "Mit\nLicense", "CC-BY 4.0", "GNU General Public License, version 3", "mit license " * 9000]


def test_base_places(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)] + [(None, "mit license", "own")],
                                 "doc_id bigint, text string, labels string")
    got = L.digest(docs).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        t = "mit license" if r.doc_id is None else texts[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels.split(",") == sorted(set(r.labels.split(",")))
    assert L.digest(docs.limit(0)).count() == 0


def kept(text):
    _, found = L.Scanner()(pa.array([text]))
    return [(d.first, d.end, d.rule.label, d.rule.kind) for c in L._clusters(found.get(0, [])) for d in L.suppress(c)]


def test_contained_detections_give_way():
    assert kept("Licensed under the Apache License, Version 2.0.") == [(0, 8, "apache-2.0", "grant")]
    assert kept("the MIT License") == [(1, 3, "mit", "title")]
    assert [x[2] for x in kept("CC BY-SA 4.0 and CC-BY")] == ["cc-by-sa-4.0", "cc-by"]
    assert [x[2] for x in kept("SPDX-License-Identifier: MIT-0")] == ["mit-0"]
    assert kept("nothing of the kind: license") == []


def test_rules_are_ordered_and_gated():
    rules = L.build_rules()
    assert len(rules) > 300 and [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)
    for r in rules:
        assert r.keywords and not r.pattern.search(" ".join(["x"] * 20))
    scanner = L.Scanner(rules)
    text = "this work is released under the terms of the gnu general public license v 3 and cc by nc sa"
    every = sorted((m.start(), m.end(), r.order) for r in rules for m in r.pattern.finditer(text))
    _, found = scanner(pa.array([text]))
    starts = [0]
    for w in text.split(" "):
        starts.append(starts[-1] + len(w) + 1)
    assert sorted((starts[d.first], starts[d.end] - 1, d.rule.order) for d in found[0]) == every


def samples(parsed, rng):
    """A text that the parsed pattern matches, its choices drawn at random."""
    out = []
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out.append(chr(arg))
        elif name == "NOT_LITERAL":
            out.append(rng.choice("abc"))
        elif name == "IN":
            kinds = [a for a in arg if str(a[0]) == "LITERAL"]
            out.append(rng.choice("abc") if str(arg[0][0]) == "NEGATE" else chr(rng.choice(kinds)[1]))
        elif name == "BRANCH":
            out.append(samples(rng.choice(arg[1]), rng))
        elif name == "SUBPATTERN":
            out.append(samples(arg[3], rng))
        elif name == "MAX_REPEAT":
            low, high, inner = arg
            out += [samples(inner, rng) for _ in range(rng.randint(low, min(int(high), low + 3)))]
        else:
            assert name in ("ASSERT_NOT", "ASSERT"), name
    return "".join(out)


def test_every_rule_finds_its_samples_with_its_keywords():
    rng = random.Random(8)
    for r in L.build_rules():
        parsed = re._parser.parse(r.pattern.pattern)
        for _ in range(25):
            t = samples(parsed, rng)
            assert r.pattern.fullmatch(t), (r.label, t)
            assert r.keywords <= set(t.split(" ")), (r.label, r.kind, sorted(r.keywords - set(t.split(" "))), t)


def test_forms_that_licenses_take():
    def labels(text):
        return [(x[2], x[3]) for x in kept(text)]
    assert labels("// SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note") == [("linux-syscall-note", "identifier")]
    assert labels("SPDX-License-Identifier: MIT OR Apache-2.0") == [("mit-or-apache-2.0", "identifier")]
    assert labels("This code is not licensed under the GNU General Public License.")[0] == ("not-gpl", "negation")
    assert labels("Licensed under either of the Apache License, Version 2.0 or the MIT license")[0][0] == "mit-or-apache-2.0"
    assert labels("see http://www.gnu.org/licenses/gpl-3.0.html") == [("gpl-3.0", "url")]
    assert labels("distributed under the terms of the GNU General Public License v2 or later") == [("gpl-2.0+", "grant")]
    assert labels("with the Classpath exception") == [("classpath-exception", "exception")]
    assert labels("Creative Commons Attribution-ShareAlike 4.0") == [("cc-by-sa", "title")]
    assert labels("an MIT licence, and a BSD 3-Clause License") == [("mit", "title"), ("bsd-3-clause", "title")]
