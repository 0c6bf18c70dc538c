"""License scans by ordered signature rules.

A rule is a pattern over the words of a text (``license_rules`` has them), a label, a priority and keywords. The keywords are looked up once per
block in its word dictionary, and a rule's pattern runs only on texts that have all of its keywords. Of overlapping
detections, one that lies within another of higher priority (or of equal priority and greater length, or of an earlier rule
with the same span) is suppressed. Words are runs of digits, small letters and characters beyond ASCII after A-Z are
lower-cased, so line breaks, comment signs and punctuation never split a phrase.

Null and empty texts have no words and no label. Every place counts, also in texts that repeat. Rows are judged one by one on
whole texts, and other columns take no part, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longspan.llm import license_rules
from longspan.llm.words import ALNUM, map_blocks, words

#: The contract's phrases and labels; all their places are told, suppressed or not.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: Priority and confidence of a base phrase as a rule.
BASE_RANK = (30, 0.5)

@dataclass(frozen=True)
class Rule:
    """Lower ``order`` is tried and ranked first among equals."""

    order: int
    kind: str
    label: str
    priority: int
    confidence: float
    keywords: frozenset[str]
    pattern: re.Pattern


def build_rules() -> list[Rule]:
    """All rules, highest priority first; the base phrases come as a kind of their own."""
    found = [(*license_rules.KINDS[kind], kind, label, keywords, pattern) for kind, label, keywords, pattern in license_rules.lines()]
    found += [(*BASE_RANK, "base", label, phrase, phrase) for phrase, label in BASE]
    found.sort(key=lambda x: -x[0])
    return [Rule(order, kind, label, priority, confidence, frozenset(keywords.split()), re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])"))
            for order, (priority, confidence, kind, label, keywords, pattern) in enumerate(found)]


@dataclass(frozen=True)
class Detection:
    """Words [first, end) of a text."""

    first: int
    end: int
    rule: Rule


def suppress(found: list[Detection]) -> list[Detection]:
    """Those that lie within no detection that ranks before them: higher priority, then more words, then the earlier rule.

    Detections are taken by rank; a kept one answers for all that lie within it, so each is only held against those kept
    that begin at or before it.
    """
    kept: list[Detection] = []
    for d in sorted(found, key=lambda d: (-d.rule.priority, d.first - d.end, d.rule.order, d.first)):
        if not any(k.first <= d.first and d.end <= k.end for k in kept):
            kept.append(d)
    return sorted(kept, key=lambda d: (d.first, d.end, d.rule.order))


def _clusters(found: list[Detection]) -> list[list[Detection]]:
    """Detections whose spans are tied by overlaps; only these can lie within each other."""
    out: list[list[Detection]] = []
    end = -1
    for d in sorted(found, key=lambda d: d.first):
        if d.first >= end:
            out.append([])
        out[-1].append(d)
        end = max(end, d.end)
    return out


class Scanner:
    def __init__(self, rules: list[Rule] | None = None):
        self.rules = build_rules() if rules is None else rules
        self.keywords = sorted(frozenset().union(*(r.keywords for r in self.rules)))
        self.wanted = pa.array([k.encode() for k in self.keywords], pa.large_binary())
        self.active: dict[bytes, list[Rule]] = {}

    def _rules_for(self, present: np.ndarray) -> list[Rule]:
        key = np.packbits(present).tobytes()
        if key not in self.active:
            if len(self.active) > 50_000:
                self.active.clear()
            have = {self.keywords[i] for i in np.flatnonzero(present)}
            self.active[key] = [r for r in self.rules if r.keywords <= have]
        return self.active[key]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, dict[int, list[Detection]]]:
        """Words of each text, and all detections of the texts that have any."""
        found = words(texts, ALNUM, fold=True)
        keyword = np.asarray(pc.index_in(found.dictionary, value_set=self.wanted).fill_null(-1)).astype(np.int64)
        of_word = keyword[found.ids] if len(found.ids) else np.zeros(0, np.int64)
        at = np.flatnonzero(of_word >= 0)
        pairs = np.unique(found.text_of[at] * len(self.keywords) + of_word[at])
        doc, word = pairs // len(self.keywords), pairs % len(self.keywords)
        out: dict[int, list[Detection]] = {}
        for d in np.unique(doc).tolist():
            present = np.zeros(len(self.keywords), bool)
            present[word[np.searchsorted(doc, d):np.searchsorted(doc, d, side="right")]] = True
            rules = self._rules_for(present)
            if rules and (hits := self._scan(found, d, rules)):
                out[d] = hits
        return found.counts, out

    @staticmethod
    def _scan(found, d: int, rules: list[Rule]) -> list[Detection]:
        a, b = found.first[d], found.first[d + 1]
        size = found.end[a:b] - found.start[a:b]
        own = found.data[found.start[a]:found.end[b - 1]]
        joined = _joined(own[ALNUM[own]], size)
        text = joined.decode("utf-8", "replace")
        chars = np.frombuffer(joined, np.uint8)
        space = np.flatnonzero(chars[(chars & 0xC0) != 0x80] == 0x20)
        hits = []
        for r in rules:
            for m in r.pattern.finditer(text):
                first = int(np.searchsorted(space, m.start()))
                hits.append(Detection(first, int(np.searchsorted(space, m.end())) + 1, r))
        return hits


def _joined(kept: np.ndarray, size: np.ndarray) -> bytes:
    """Words on end, with a space between two."""
    out = np.full(len(kept) + len(size), 0x20, np.uint8)
    out[np.arange(len(kept)) + np.repeat(np.arange(len(size)), size)] = kept
    return out[:-1].tobytes()


_FOUND = T.ArrayType(T.StructType([
    T.StructField("first", T.LongType()), T.StructField("end", T.LongType()), T.StructField("label", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("priority", T.IntegerType()), T.StructField("confidence", T.DoubleType()),
    T.StructField("kept", T.BooleanType())]))


def scan(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``) plus ``n_words`` and ``detections``: words [first, end), label, kind,
    priority and confidence of each place, and whether it was kept or suppressed. Columns of these names are replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "detections")]
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(text).cast("string").alias("_text"))
    state: dict = {}

    def one(block):
        scanner = state.get("scanner") or state.setdefault("scanner", Scanner(rules))
        counts, found = scanner(block.column("_text"))
        rows = []
        for d in range(len(counts)):
            own = found.get(d, [])
            kept = {id(k) for c in _clusters(own) for k in suppress(c)}
            rows.append([{"first": x.first, "end": x.end, "label": x.rule.label, "kind": x.rule.kind, "priority": x.rule.priority,
                          "confidence": x.rule.confidence, "kept": id(x) in kept}
                         for x in sorted(own, key=lambda x: (x.first, x.end, x.rule.order))])
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("kind", pa.string()),
                                   ("priority", pa.int32()), ("confidence", pa.float64()), ("kept", pa.bool_())]))
        return pa.RecordBatch.from_arrays([block.column("_row"), pa.array(counts, pa.int64()), pa.array(rows, kind)],
                                          names=["_row", "n_words", "detections"])

    schema = source.drop("_text").schema.add("n_words", "long").add("detections", _FOUND)
    found = map_blocks(source, "_text", one, schema)
    return found.select(*[F.col("_row")[c].alias(c) for c in keep], "n_words", "detections")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: all base places, and the labels of base places and of kept detections."""
    found = scan(docs, keep=["doc_id"])
    base = F.filter("detections", lambda d: d["kind"] == "base")
    kept = F.filter("detections", lambda d: d["kept"] | (d["kind"] == "base"))

    def labels(c):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda d: d["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["first"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(kept).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda d: d["confidence"])), F.lit(0.0)).alias("score"))

