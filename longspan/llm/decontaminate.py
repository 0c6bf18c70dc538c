"""Benchmark decontamination with suffix arrays over the training words.

Every task sorts the suffixes of its documents, shard by shard, and binary-searches every suffix of the test items in each
shard: the search narrows a range of the suffix array word by word, so its last non-empty range is the longest verbatim match
and holds all its places. Matches of more than ``WALK`` words are not walked to their end: the suffix's place among the sorted ones
is found by comparing hashes of runs, in steps that grow with the logarithm of the match. No row is shuffled; the test items are sent out only in blocks of a checked size, one pass over the
documents per block.

Null and empty texts have no words: such documents are clean, such items match nothing. Repeated documents are judged one by
one; repeated items count once per ``item_id``, and an item without an id marks words but is not listed. Input columns other
than the two named ones take no part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longspan.llm.words import ALNUM, Runs, Words, map_blocks, ragged, words
from longspan.session import pin

#: Words of a window; an item with fewer words is one window of all its words.
WINDOW = 10
#: UTF-8 bytes of test items that one pass holds.
ITEM_BYTES = 16 << 20
#: UTF-8 bytes of training text in one suffix array.
SHARD_BYTES = 6 << 20
#: Words of a match that are compared one by one; longer matches are told by their hashes.
WALK = 64


@dataclass
class Items:
    """The test words of one block: ``ids`` are places in ``vocabulary``, ``stop`` is the end of each word's item."""

    vocabulary: pa.Array
    ids: np.ndarray
    item: np.ndarray
    stop: np.ndarray
    window: np.ndarray
    names: list[str | None]

    @property
    def longest(self) -> int:
        return int((self.stop - np.arange(len(self.stop))).max(initial=0))


def prepare_items(names: list, texts: list, window: int = WINDOW) -> Items:
    found = words(pa.array(texts, pa.string()), ALNUM, fold=True)
    item = found.text_of
    size = found.counts[item]
    stop = found.first[1:][item]
    span = np.minimum(window, size)
    span = np.where(np.arange(len(item)) + span <= stop, span, 0)
    return Items(found.dictionary, found.ids, item, stop, span, [None if n is None else str(n) for n in names])


def item_blocks(items: DataFrame, item_id: str, text: str, max_bytes: int = ITEM_BYTES) -> list[DataFrame]:
    """The items in blocks that are small enough to send out; sizes are counted, not assumed."""
    items = items.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = int(total // (max_bytes // 2)) + 1
    if n == 1:
        return [items]
    key = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [items.where(key == k) for k in range(n)]


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` values (values from 0; nothing sorts before 0)."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.int64)
    bits = max(1, int(ids.max()).bit_length())
    known = max(1, 62 // bits)
    padded = np.concatenate((ids, np.zeros(known, np.int64)))
    key = np.zeros(n, np.int64)
    for k in range(known):
        key = (key << bits) | padded[k:k + n]
    order = np.argsort(key, kind="stable")
    key = key[order]
    rank = np.full(n + 1, -1, np.int64)
    new = np.concatenate(([True], key[1:] != key[:-1]))
    places = np.flatnonzero(new)
    group = np.repeat(places, np.diff(np.append(places, n)))
    rank[order] = group
    while known < depth:
        tied = np.zeros(n, bool)
        size = np.diff(np.append(places, n))
        tied[ragged(places[size > 1], size[size > 1])] = True
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        at = order[slots]
        key = rank[at] * (n + 1) + rank[np.minimum(at + known, n)] + 1
        by = np.argsort(key, kind="stable")
        key, order[slots] = key[by], at[by]
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        new = np.zeros(n, bool)
        new[~tied] = True
        new[slots[fresh]] = True
        places = np.flatnonzero(new)
        rank[order] = np.repeat(places, np.diff(np.append(places, n)))
        known *= 2
    return order


def _bound(padded: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, want: np.ndarray) -> np.ndarray:
    """First place in each range [lo, hi) whose word at ``depth`` is at least the wanted one."""
    lo, hi = lo.copy(), hi.copy()
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        mid = (lo[open_] + hi[open_]) >> 1
        less = padded[order[mid] + depth] < want[open_]
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]
        open_ = open_[lo[open_] < hi[open_]]
    return lo


@dataclass
class Found:
    """For each test suffix: words of its longest match, the range of the places, and the range of its window."""

    length: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    window_lo: np.ndarray
    window_hi: np.ndarray


def search(padded: np.ndarray, order: np.ndarray, wanted: np.ndarray, items: Items) -> Found:
    m = len(wanted)
    out = Found(*(np.zeros(m, np.int64) for _ in range(5)))
    out.hi[:] = len(order)
    active, depth = np.arange(m), 0
    walk = max(WALK, int(items.window.max(initial=0)))
    while len(active) and depth < walk:
        at = active + depth
        active = active[(at < items.stop[active])]
        want = wanted[active + depth]
        active, want = active[want > 0], want[want > 0]
        lo = _bound(padded, order, out.lo[active], out.hi[active], depth, want)
        hi = _bound(padded, order, lo, out.hi[active], depth, want + 1)
        hit = lo < hi
        active = active[hit]
        out.lo[active], out.hi[active] = lo[hit], hi[hit]
        depth += 1
        out.length[active] = depth
        full = active[items.window[active] == depth]
        out.window_lo[full], out.window_hi[full] = out.lo[full], out.hi[full]
    if len(active):
        _finish(padded, order, np.where(wanted > 0, wanted, -1), items, out, active)
    return out


def _finish(padded: np.ndarray, order: np.ndarray, wanted: np.ndarray, items: Items, out: Found, active: np.ndarray) -> None:
    """The whole match of the suffixes that agree so far: its end is at one of the two neighbours of the suffix among the sorted."""
    runs = Runs(wanted, padded)
    lo, hi, limit = out.lo[active], out.hi[active], items.stop[active] - active

    def bound(limit: np.ndarray, beyond: bool) -> np.ndarray:
        """First place in each range whose suffix, cut to ``limit`` words, is not before the wanted one, or is beyond it."""
        low, high = lo.copy(), hi.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            mid = (low[open_] + high[open_]) >> 1
            i, j = active[open_], order[mid]
            n = runs.common(i, j, limit[open_])
            same = n == limit[open_]
            less = padded[j + n] < wanted[np.minimum(i + n, len(wanted) - 1)]
            less = np.where(same, beyond, less)
            low[open_[less]] = mid[less] + 1
            high[open_[~less]] = mid[~less]
            open_ = open_[low[open_] < high[open_]]
        return low

    place = bound(limit, False)
    before, after = np.maximum(place - 1, lo), np.minimum(place, hi - 1)
    out.length[active] = longest = np.maximum(runs.common(active, order[before], limit), runs.common(active, order[after], limit))
    out.lo[active], out.hi[active] = bound(longest, False), bound(longest, True)


def _shard(texts: pa.Array, items: Items) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, Found]:
    """Suffix array of the block's documents, with a 0 after each of them, and every test suffix looked up in it."""
    found = words(texts, ALNUM, fold=True)
    n, texts_n = len(found.ids), len(found.counts)
    place = np.arange(n) + found.text_of
    flat = np.zeros(n + texts_n, np.int64)
    flat[place] = found.ids + 1
    longest = items.longest
    order = suffix_array(flat, longest)
    local = pc.index_in(items.vocabulary, value_set=found.dictionary).fill_null(-1)
    wanted = np.asarray(local).astype(np.int64)[items.ids] + 1 if len(items.ids) else np.zeros(0, np.int64)
    padded = np.concatenate((flat, np.zeros(longest + 1, np.int64)))
    return found, place, order, flat, search(padded, order, wanted, items)


def _mark(texts: pa.Array, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per document, hit word by word (documents on end), and the (document, item) pairs of occurring windows."""
    found, place, order, flat, hits = _shard(texts, items)
    n_docs = len(found.counts)
    first = found.first + np.arange(n_docs + 1)
    marks = np.zeros(len(flat) + 1, np.int64)
    with_window = np.flatnonzero(hits.window_hi > hits.window_lo)
    key = hits.window_lo[with_window] * (items.window.max(initial=0) + 1) + items.window[with_window]
    _, one, which = np.unique(key, return_index=True, return_inverse=True)
    chosen = with_window[one]
    size = hits.window_hi[chosen] - hits.window_lo[chosen]
    at = order[ragged(hits.window_lo[chosen], size)]
    span = np.repeat(items.window[chosen], size)
    marks[:] = np.bincount(at, minlength=len(marks)) - np.bincount(at + span, minlength=len(marks))
    hit = (np.cumsum(marks)[:-1] > 0)[place]
    doc = np.searchsorted(first, at, side="right") - 1
    seen = np.unique(doc * max(1, len(chosen)) + np.repeat(np.arange(len(chosen)), size))
    doc, window = seen // max(1, len(chosen)), seen % max(1, len(chosen))
    by = np.argsort(which, kind="stable")
    edge = np.searchsorted(which[by], np.arange(len(chosen) + 1))
    many = edge[window + 1] - edge[window]
    of = items.item[with_window[by[ragged(edge[window], many)]]]
    pairs = np.unique(np.repeat(doc, many) * max(1, len(items.names)) + of)
    return found.counts, hit, pairs // max(1, len(items.names)), pairs % max(1, len(items.names))


def _runs(hit: np.ndarray, counts: np.ndarray) -> tuple[list[list[int]], list[list[int]]]:
    """Start and end words of the runs of hit words of each document."""
    edges = np.concatenate(([0], np.cumsum(counts)))
    starts, ends = [], []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        step = np.diff(np.concatenate(([0], hit[a:b].astype(np.int8), [0])))
        starts.append(np.flatnonzero(step == 1).tolist())
        ends.append(np.flatnonzero(step == -1).tolist())
    return starts, ends


_STATE = "_n_words bigint, _starts array<bigint>, _ends array<bigint>, _items array<string>"


def scan(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW, item_bytes: int = ITEM_BYTES, shard_bytes: int = SHARD_BYTES, keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``) plus the struct ``match``: n_words, the runs of hit words (starts, ends)
    and the items found. If a column has that name already, the struct is called ``_match``.

    A document word is hit if it lies in any occurrence of a window of the items.
    """
    spark, keep = docs.sparkSession, docs.columns if keep is None else keep
    state = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(text).cast("string").alias("_text"),
                        F.lit(0).cast("bigint").alias("_n_words"),
                        *[F.array().cast(t).alias(c) for c, t in (("_starts", "array<bigint>"), ("_ends", "array<bigint>"),
                                                                  ("_items", "array<string>"))])
    parts = item_blocks(items, item_id, item_text, item_bytes)
    for k, part in enumerate(parts):
        rows = part.collect()
        sent = spark.sparkContext.broadcast(prepare_items([r[0] for r in rows], [r[1] for r in rows], window))

        def one(block, sent=sent, later=k > 0):
            prepared = sent.value
            counts, hit, doc, item = _mark(block.column("_text"), prepared)
            if later:
                edges = np.concatenate(([0], np.cumsum(counts)))
                for i, (s, e) in enumerate(zip(block.column("_starts").to_pylist(), block.column("_ends").to_pylist(), strict=True)):
                    for a, b in zip(s, e, strict=True):
                        hit[edges[i] + a:edges[i] + b] = True
            starts, ends = _runs(hit, counts)
            names: list[set] = [set(x) for x in block.column("_items").to_pylist()]
            for d, j in zip(doc.tolist(), item.tolist(), strict=True):
                if prepared.names[j] is not None:
                    names[d].add(prepared.names[j])
            fields = [pa.field("_n_words", pa.int64()), pa.field("_starts", pa.list_(pa.int64())),
                      pa.field("_ends", pa.list_(pa.int64())), pa.field("_items", pa.list_(pa.string()))]
            values = [counts.tolist(), starts, ends, [sorted(x) for x in names]]
            return pa.RecordBatch.from_arrays(
                [block.column("_row"), block.column("_text"), *[pa.array(v, f.type) for v, f in zip(values, fields, strict=True)]],
                names=["_row", "_text", *[f.name for f in fields]])

        state = map_blocks(state, "_text", one, state.schema, shard_bytes)
        if k + 1 < len(parts):
            state = pin(state)
    columns = [F.col("_row")[c].alias(c) for c in keep]
    match = F.struct(F.col("_n_words").alias("n_words"), F.col("_starts").alias("starts"), F.col("_ends").alias("ends"),
                     F.col("_items").alias("items"))
    return state.select(*columns, match.alias("_match" if "match" in keep else "match"))


def remove_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without a single occurrence of an item's window, with their own columns."""
    name = "_match" if "match" in docs.columns else "match"
    found = scan(docs, items, **options)
    return found.where(F.size(F.col(name)["starts"]) == 0).select(*docs.columns)


def longest_matches(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                    item_text: str = "text") -> DataFrame:
    """For each item the longest verbatim match in the corpus: item_id, length, doc_id and the word it starts at.

    Of equally long matches the one in the smallest document id, then at the first word, counts.
    """
    spark, out = docs.sparkSession, None
    source = docs.select(F.col(doc_id).cast("bigint").alias("_doc"), F.col(text).cast("string").alias("_text"))
    for part in item_blocks(items, item_id, item_text):
        rows = part.collect()
        sent = spark.sparkContext.broadcast(prepare_items([r[0] for r in rows], [r[1] for r in rows]))

        def one(block, sent=sent):
            prepared = sent.value
            found, _, order, _, hits = _shard(block.column("_text"), prepared)
            first = found.first + np.arange(len(found.counts) + 1)
            best = np.zeros(len(prepared.names), np.int64)
            np.maximum.at(best, prepared.item, hits.length)
            top = np.flatnonzero((hits.length > 0) & (hits.length == best[prepared.item]))
            size = hits.hi[top] - hits.lo[top]
            at = order[ragged(hits.lo[top], size)]
            item = np.repeat(prepared.item[top], size)
            doc = np.searchsorted(first, at, side="right") - 1
            ids = block.column("_doc").take(pa.array(doc))
            table = pa.table({"item": [prepared.names[i] for i in item.tolist()], "length": best[item], "doc": ids, "at": at - first[doc]})
            table = table.sort_by([("item", "ascending"), ("doc", "ascending"), ("at", "ascending")])
            names = table.column("item").to_pylist()
            keep = [i for i, n in enumerate(names) if n is not None and (not i or names[i - 1] != n)]
            return table.take(keep).combine_chunks().to_batches()[0] if keep else None

        found = map_blocks(source, "_text", one, "item string, length bigint, doc bigint, at bigint", SHARD_BYTES)
        out = found if out is None else out.unionByName(found)
    best = F.max_by(F.struct("length", "doc", "at"), F.struct("length", -F.col("doc"), -F.col("at")))
    return out.groupBy("item").agg(best.alias("b")).select(F.col("item").alias("item_id"), "b.length", F.col("b.doc").alias("doc_id"),
                                                           F.col("b.at").alias("first_word"))


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's columns for each document, derived from ``scan``."""
    found = scan(docs, items, keep=["doc_id"])
    hit = F.aggregate(F.zip_with("match.starts", "match.ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda a, x: a + x)
    items_ = F.array_sort("match.items")
    return found.select(
        "doc_id", F.col("match.n_words").alias("n_words"), hit.alias("n_hit"), F.size("match.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items_, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("match.starts") > 0).alias("contaminated"))
