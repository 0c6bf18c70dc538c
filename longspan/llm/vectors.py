"""Integer vectors in strips of bounded size, and query vectors brought to the strips that they need.

A strip is a run of rows in a wanted order, numbered over all partitions, so equal vectors are split like any others. It moves as a
few packed rows. ``meet`` hands one task the query rows of one strip and all rows of another, never more, so neither many queries
nor many equal rows gather in a task.

Vectors that are null or hold a null, NaN or infinite component take no part. Vectors of different lengths are compared over their
common components, so an empty one has product 0 with all. Products are exact: components so large that a product could pass
2**53 are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longspan.llm.words import map_batches
from longspan.session import pin

#: Rows of a strip, and bytes of vectors in one packed row.
STRIP_ROWS, CHUNK_BYTES = 8192, 1 << 19
#: Largest exact integer of a double.
EXACT = 2 ** 53
#: Stands in for an absent id in orders, after all others.
LAST = np.iinfo(np.int64).max


def integer_vectors(df: DataFrame, scale: int, vec_id: str, vector: str, **more: Column) -> DataFrame:
    """``place`` (of the row), ``id`` and ``known`` (absent ids come last), further integer columns, and ``v``, the scaled floors."""
    rows = df.select(F.monotonically_increasing_id().alias("place"), F.coalesce(F.col(vec_id).cast("bigint"), F.lit(int(LAST))).alias("id"),
                     F.col(vec_id).isNotNull().cast("bigint").alias("known"), *[c.cast("bigint").alias(n) for n, c in more.items()],
                     F.col(vector).cast("array<double>").alias("x"))
    whole = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    rows = rows.dropna(subset=["x", *more]).where(whole)
    return rows.select(
        "place", "id", "known", *more, F.transform("x", lambda e: F.floor(F.lit(float(scale)) * e)).alias("v"))


def numbered(df: DataFrame, order: list[Column], rows_per_task: int) -> DataFrame:
    """The rows with ``number``, their place from 0 in the wanted order, found without a window over all of them.

    Range partitions are sorted on their own; only their row counts are added up, one row for each partition.
    """
    tasks = max(1, -(-df.count() // rows_per_task))
    rows = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    rows = pin(rows.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at")))
    parts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(parts), "_part").withColumn("number", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


@dataclass
class Rows:
    """Some rows of a strip: integer columns by name, and the vectors as whole numbers in doubles."""

    columns: dict[str, np.ndarray]
    v: np.ndarray

    def __len__(self) -> int:
        return len(self.v)

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name]

    def take(self, at) -> Rows:
        return Rows({n: c[at] for n, c in self.columns.items()}, self.v[at])


def widened(v: np.ndarray, width: int) -> np.ndarray:
    """The vectors with zeros after their last component."""
    return v if v.shape[1] == width else np.pad(v, ((0, 0), (0, width - v.shape[1])))


def joined(parts: list[Rows]) -> Rows:
    width = max(p.v.shape[1] for p in parts)
    return Rows({n: np.concatenate([p[n] for p in parts]) for n in parts[0].columns}, np.concatenate([widened(p.v, width) for p in parts]))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held in doubles."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * width >= EXACT:
        raise ValueError("components are too large for exact products")
    return a @ b.T


def rows_of(batch: pa.RecordBatch, names: list[str]) -> Rows:
    """Rows from a batch that holds the vectors as a list column."""
    lists = batch.column("v")
    size = np.diff(np.asarray(lists.offsets))
    out = np.zeros((len(size), int(size.max()) if len(size) else 0))
    flat = np.asarray(lists.flatten()).astype(np.float64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return Rows({n: np.asarray(batch.column(n)).astype(np.int64) for n in names}, out)


def packed(rows: DataFrame, names: list[str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Strips as a few rows each: ``strip, chunk, n, width``, the named integer columns and ``v`` as bytes. Rows have ``number``."""
    schema = "strip bigint, chunk bigint, n bigint, width bigint, " + "".join(f"{n} binary, " for n in names) + "v binary"

    def run(batches):
        strip, chunk = None, 0
        for batch in batches:
            at = np.asarray(batch.column("strip"))
            edges = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1, [len(at)])) if len(at) else np.zeros(1, int)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                chunk, strip = (chunk, strip) if at[a] == strip else (0, at[a])
                some = rows_of(batch.slice(a, b - a), names)
                step = max(1, chunk_bytes // max(8, 8 * some.v.shape[1]))
                for c in range(0, len(some), step):
                    part = some.take(slice(c, c + step))
                    cells = [strip, chunk, len(part), part.v.shape[1]] + [part[n].tobytes() for n in names] + [part.v.astype(np.int64).tobytes()]
                    kinds = [pa.int64()] * 4 + [pa.binary()] * (len(names) + 1)
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(cells, kinds, strict=True)],
                                                     names=["strip", "chunk", "n", "width", *names, "v"])
                    chunk += 1

    source = rows.select("strip", "number", *names, "v").repartition("strip").sortWithinPartitions("strip", "number")
    return map_batches(source.drop("number"), run, schema)


def _unpacked(row: dict, names: list[str]) -> Rows:
    v = np.frombuffer(row["v"], np.int64).reshape(row["n"], row["width"]).astype(np.float64)
    return Rows({n: np.frombuffer(row[n], np.int64) for n in names}, v)


def meet(targets: DataFrame, target_names: list[str], queries: DataFrame, query_names: list[str], needs: DataFrame,
         search: Callable[[Rows, Rows], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``search(query rows, target rows)`` for each pair (``query``, ``strip``) of ``needs``; both sides are packed."""
    absent = [F.lit(None).cast("binary").alias(n) for n in query_names if n not in target_names]
    unasked = [F.lit(None).cast("binary").alias(n) for n in target_names if n not in query_names]
    side = ["strip", "query", "kind", "chunk", "n", "width", *target_names, *[n for n in query_names if n not in target_names], "v"]
    there = targets.join(needs, "strip").select("*", F.lit(1).alias("kind"), *absent).select(side)
    asked = queries.withColumnRenamed("strip", "query").join(needs, "query").select("*", F.lit(0).alias("kind"), *unasked).select(side)
    rows = there.unionByName(asked).repartition("strip", "query").sortWithinPartitions("strip", "query", "kind", "chunk")

    def run(batches):
        key, held = None, ([], [])

        def done():
            if held[0] and held[1]:
                yield from search(joined(held[0]), joined(held[1]))

        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in ("strip", "query", "kind", "n", "width")}
                if key != (row["strip"], row["query"]):
                    yield from done()
                    key, held = (row["strip"], row["query"]), ([], [])
                names = target_names if row["kind"] else query_names
                held[row["kind"]].append(_unpacked(row | {n: batch.column(n)[k].as_buffer() for n in [*names, "v"]}, names))
        yield from done()

    return map_batches(rows, run, schema)


def best_rows(query: np.ndarray, rank: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` rows with the highest score of each query, ties to the smaller rank, queries ascending."""
    order = np.lexsort((rank, -score, query))
    new = np.concatenate(([True], np.diff(query[order]) != 0)) if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return order[np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order)))) < k]
