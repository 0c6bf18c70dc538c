"""SimHash near-duplicates by a self-join of binary tries.

A document's fingerprint has a bit set if more than half of its shingle hashes have it set. Different fingerprints are linked
if at most ``budget`` bits differ. Two such fingerprints agree on at least one of ``budget + 1`` bit blocks, so each block
value is the root of a trie of its own and tasks need no others; inside, node pairs are walked together from the root, the
differing bits of their prefixes add up, and a pair is left as soon as they exceed the budget. Groups that are too large for
one task are cut once more by the blocks of their remaining bits. All links of a task are told as stars, so a group of
thousands of near copies returns one row for each, and components need every document only once per fingerprint.

A null or empty text has fingerprint 0 and is linked like any other. Equal fingerprints are one class, so repeated rows and
ties share it. Documents without id take no part in the smallest id; a class of such documents alone has a null class.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longspan.llm.components import components, local_components
from longspan.llm.words import SOLID, map_batches, map_blocks, ragged, words
from longspan.session import pin

#: Words of a shingle, seed of its hash, and differing bits that still link.
WIDTH, SEED, BUDGET = 4, 42, 4
BITS = 64
#: Fingerprints that one trie of a task may hold before its group is cut by further blocks.
GROUP_ROWS = 50_000
#: Node pairs walked at a time, and links kept before they are turned into stars.
FRONTIER, LINKS = 200_000, 500_000
#: A pair of nodes with so few leaf pairs is compared leaf by leaf.
LEAF_PAIRS = 64


def fingerprints(texts: pa.Array, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each text."""
    import xxhash
    found = words(texts, SOLID, fold=True)
    n_docs, n_words = len(found.counts), len(found.ids)
    out = np.zeros(n_docs, np.uint64)
    if not n_words:
        return out
    size = found.end - found.start
    kept = found.data[SOLID[found.data]]
    joined = np.full(len(kept) + n_words, 0x20, np.uint8)
    joined[np.arange(len(kept)) + np.repeat(np.arange(n_words), size)] = kept
    ends = np.cumsum(size) + np.arange(n_words)
    starts = ends - size
    shingles = np.where(found.counts > 0, np.maximum(found.counts - width + 1, 1), 0)
    first = ragged(found.first[:-1], shingles)
    last = np.minimum(first + width, np.repeat(found.first[1:], shingles)) - 1
    data, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashed = np.fromiter((digest(data[a:b], seed) for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True)),
                         np.uint64, len(first))
    some = np.flatnonzero(shingles)
    edges = np.cumsum(shingles) - shingles
    step = 1 << 17
    ones = np.zeros((n_docs, BITS), np.int64)
    doc = np.repeat(np.arange(n_docs), shingles)
    for a in range(0, len(hashed), step):  # bounds the unpacked bits
        bits = np.unpackbits(hashed[a:a + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cut = np.concatenate(([0], np.flatnonzero(np.diff(doc[a:a + step])) + 1))
        ones[doc[a + cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    assert len(edges) == n_docs
    set_ = ones[some] * 2 > shingles[some, None]
    out[some] = np.packbits(set_, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, out: str = "fingerprint") -> DataFrame:
    """The wanted columns (all by default, but one that is called like ``out``) and the fingerprint as a signed 64-bit integer."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(text).cast("string").alias("_text"))

    def one(block):
        prints = fingerprints(block.column("_text")).view(np.int64)
        return pa.RecordBatch.from_arrays([block.column("_row"), pa.array(prints)], names=["_row", "_print"])

    schema = source.drop("_text").schema.add("_print", "long")
    return map_blocks(source, "_text", one, schema).select(*[F.col("_row")[c].alias(c) for c in keep], F.col("_print").alias(out))


def _count_ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def trie_links(prints: np.ndarray, first: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """Smallest linked place of each fingerprint within its group.

    ``prints`` are distinct and ascending in each group, ``first`` has the groups' offsets. A node is a range of fingerprints
    with the same leading bits. Longer fingerprints are rows of 64-bit words, the leading word first.
    """
    n = len(prints)
    columns = [prints] if prints.ndim == 1 else list(prints.T.copy())
    label = np.arange(n)
    ones: dict[int, np.ndarray] = {}

    def set_before(bit: int) -> np.ndarray:
        if bit not in ones:
            word = columns[len(columns) - 1 - bit // BITS]
            ones[bit] = np.concatenate(([0], np.cumsum((word >> np.uint64(bit % BITS)) & np.uint64(1), dtype=np.int32)))
        return ones[bit]

    links: list[tuple[np.ndarray, np.ndarray]] = []

    def flush() -> None:
        nonlocal label
        if links:
            a, b = (np.concatenate(x) for x in zip(*links, strict=True))
            own = np.arange(n)
            label = local_components(n, np.concatenate((a, own)), np.concatenate((b, label)))
            links.clear()

    size = np.diff(first)
    roots = size > 1
    lo, hi = first[:-1][roots], first[1:][roots]
    stack = [(lo, hi, lo, hi, np.zeros(len(lo), np.int64), BITS * len(columns) - 1)]
    while stack:
        a0, a1, b0, b1, err, bit = stack.pop()
        if len(a0) > FRONTIER:
            stack += [(*(x[k:k + FRONTIER] for x in (a0, a1, b0, b1, err)), bit) for k in range(0, len(a0), FRONTIER)]
            continue
        pairs = (a1 - a0) * (b1 - b0)
        leaf = pairs <= LEAF_PAIRS
        if leaf.any():
            width = (b1 - b0)[leaf]
            which = np.repeat(np.arange(int(leaf.sum())), pairs[leaf])
            at = ragged(np.zeros(len(width), np.int64), pairs[leaf])
            x, y = a0[leaf][which] + at // width[which], b0[leaf][which] + at % width[which]
            near = (x < y) & (sum(_count_ones(c[x] ^ c[y]) for c in columns) <= budget)
            if near.any():
                links.append((x[near], y[near]))
                if sum(len(x) for x, _ in links) > LINKS:
                    flush()
            a0, a1, b0, b1, err = (x[~leaf] for x in (a0, a1, b0, b1, err))
        if not len(a0):
            continue
        before = set_before(bit)
        am, bm = a1 - (before[a1] - before[a0]), b1 - (before[b1] - before[b0])
        twin = a0 == b0
        lone = ~twin
        children = (
            (a0, am, b0, bm, err), (am, a1, bm, b1, err), (a0, am, bm, b1, err + 1),
            (am[lone], a1[lone], b0[lone], bm[lone], err[lone] + 1))
        child = [np.concatenate(x) for x in zip(*children, strict=True)]
        keep = (child[0] < child[1]) & (child[2] < child[3]) & (child[4] <= budget)
        keep &= ~((child[0] == child[2]) & (child[1] - child[0] < 2))
        if keep.any():
            stack.append((*(x[keep] for x in child), bit - 1))
    flush()
    return label


def _blocks_of(bits: list[int], parts: int) -> list[list[int]]:
    """The bits in ``parts`` runs of about equal length."""
    edges = [len(bits) * k // parts for k in range(parts + 1)]
    return [bits[a:b] for a, b in pairwise(edges)]


def _masked(column, bits: list[int]):
    mask = sum(1 << b for b in bits)
    return column.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint"))


def _star_rows(batches, budget: int):
    """Links of whole groups as (fingerprint, smallest linked one); rows come sorted by group."""
    held: list[pa.RecordBatch] = []

    def work(table: pa.Table):
        key = [np.asarray(table.column(c)) for c in ("k1", "k2")]
        prints = np.asarray(table.column("fp")).view(np.uint64)
        order = np.lexsort((prints, key[1], key[0]))
        key, prints = [k[order] for k in key], prints[order]
        new = np.concatenate(([True], (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])))
        label = trie_links(prints, np.append(np.flatnonzero(new), len(prints)), budget)
        moved = np.flatnonzero(label != np.arange(len(label)))
        if len(moved):
            signed = prints.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < GROUP_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        k1, k2 = (np.asarray(table.column(c)) for c in ("k1", "k2"))
        last = np.flatnonzero((k1 != k1[-1]) | (k2 != k2[-1]))
        stop = int(last[-1]) + 1 if len(last) else 0
        if stop:
            yield from work(table.slice(0, stop).combine_chunks())
        held = table.slice(stop).combine_chunks().to_batches()
    if held:
        yield from work(pa.Table.from_batches(held).combine_chunks())


def links(prints: DataFrame, fp: str = "fp", budget: int = BUDGET, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Stars ``(a, b)`` whose components are those of all pairs of distinct fingerprints within the budget."""
    prints = prints.select(F.col(fp).alias("fp"))
    parts = _blocks_of(list(range(BITS)), budget + 1)
    rows = None
    for t, bits in enumerate(parts):
        one = prints.select(F.lit(t).cast("bigint").alias("k1"), _masked(F.col("fp"), bits).alias("k2"), "fp")
        rows = one if rows is None else rows.unionByName(one)
    sizes = rows.groupBy("k1", "k2").agg(F.count("*").alias("n")).where(F.col("n") > group_rows).drop("n")
    if sizes.limit(1).count():  # cut large groups once more: near pairs also agree on a block of the remaining bits
        large = rows.join(sizes, ["k1", "k2"], "left_semi")
        rows = rows.join(sizes, ["k1", "k2"], "left_anti")
        for t, bits in enumerate(parts):
            rest = [b for b in range(BITS) if b not in bits]
            for u, more in enumerate(_blocks_of(rest, budget + 1)):
                rows = rows.unionByName(large.where(F.col("k1") == t).select(
                    F.lit((budget + 1) * (t + 1) + u).cast("bigint").alias("k1"), _masked(F.col("fp"), bits + more).alias("k2"), "fp"))
    rows = rows.repartition("k1", "k2").sortWithinPartitions("k1", "k2")
    return map_batches(rows, lambda batches: _star_rows(batches, budget), "a bigint, b bigint")


def classes(docs: DataFrame, *, doc_id: str = "doc_id", fp: str = "fingerprint", budget: int = BUDGET,
            group_rows: int = GROUP_ROWS) -> DataFrame:
    """The rows plus ``component_id``, the smallest id reachable over links. ``docs`` should be a written table."""
    reps = pin(docs.groupBy(F.col(fp).alias("_fp")).agg(F.min(doc_id).alias("_least")))
    roots = components(links(reps, "_fp", budget, group_rows))
    reps = reps.join(roots, F.col("_fp") == F.col("node"), "left").select("_fp", F.coalesce("root", "_fp").alias("_root"), "_least")
    least = reps.groupBy("_root").agg(F.min("_least").alias("component_id"))
    reps = reps.join(least, "_root").select("_fp", "component_id")
    return docs.drop("component_id").join(reps, F.col(fp) == F.col("_fp")).drop("_fp")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` of each document."""
    prints = pin(with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", ["doc_id"]))
    return classes(prints).select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class with its own columns: the one with the smallest id, then the first row."""
    names = docs.columns
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text).alias("text"),
                         F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("place"))
    held = pin(with_fingerprints(source, "text", ["row", "doc_id", "place"]))
    # The order of ids (absent ones last) and places is told as one number per row, which classes() then takes as the id.
    light = held.select("fingerprint", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place").alias("order"))
    chosen = classes(light, doc_id="order").groupBy("component_id").agg(F.count("*").alias("n"))
    return held.join(chosen.select(F.col("component_id.place").alias("place")), "place", "left_semi").select(
        *[F.col("row")[c].alias(c) for c in names])
