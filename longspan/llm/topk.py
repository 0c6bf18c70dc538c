"""Exact top-k inner products by norm-bucketed retrieval.

Rows are ordered by length, the longest first, and cut into strips. A query first searches the strip that it stands in; its k-th
score there is a floor that any better row must reach, so other strips are only searched if their longest row can reach it.
Inside a strip, buckets of rows of about equal length are taken in turn. A query's floor, over its own and the bucket's greatest
length, is the cosine that a row of the bucket needs: above 1, the query is done with this and all later buckets. For low cosines
the bucket is pruned by length alone and its first rows are multiplied for all such queries at once. For high ones each of the
query's largest coordinates bounds the same coordinate of the row, since the angle to a third direction changes by no more than
the angle between the two; rows within all these ranges, found in sorted coordinate lists, are multiplied. The floor rises all along.

Products are exact and all ties at the floor are multiplied, so results don't depend on any of these parameters.

Null vectors and those with a null, NaN or infinite component take no part. Rows are told apart by their place, so a repeated row
is a candidate of its twin. An absent id is never a query, comes last among ties and is returned as null. Fewer than k candidates
are all returned; an empty table gives no rows. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longspan.llm.vectors import STRIP_ROWS, Rows, best_rows, integer_vectors, meet, numbered, packed, products, widened
from longspan.session import pin

#: Results of a query, factor before the floor, and every which id is a query.
K, SCALE, EVERY = 20, 64, 20
#: Rows of a bucket, queries multiplied at once, coordinates looked at, and the local cosine from which coordinates prune.
BUCKET, QUERIES, FOCUS, COORDINATE_COSINE = 512, 512, 3, 0.5
#: Bounds are computed in doubles and widened by this much.
SLACK = 1e-9
_FOUND = "place bigint, query_id bigint, candidate bigint, vec_id bigint, score bigint"


def lengths(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v * v).sum(axis=1)) * (1 + SLACK)


class Bucket:
    """Rows of about equal length with their coordinates, each sorted when it is first asked for."""

    def __init__(self, v: np.ndarray, length: np.ndarray, first: int):
        self.v, self.length, self.first = v, length, first
        self.unit = v / np.where(length > 0, length, 1)[:, None]
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def within(self, axis: int, low: float, high: float) -> np.ndarray:
        """Rows whose unit coordinate is in the range."""
        if axis not in self._sorted:
            order = np.argsort(self.unit[:, axis], kind="stable")
            self._sorted[axis] = order, self.unit[order, axis]
        order, values = self._sorted[axis]
        return order[np.searchsorted(values, low, "left"):np.searchsorted(values, high, "right")]

    def reachable(self, unit: np.ndarray, cosine: float, focus: int = FOCUS) -> np.ndarray:
        """Rows that may have at least this cosine with the query, by its largest coordinates."""
        axes = np.argsort(-np.abs(unit))[:focus]
        angle = np.arccos(np.clip(cosine - SLACK, -1, 1))
        own = np.arccos(np.clip(unit[axes], -1, 1))
        low = np.cos(np.minimum(own + angle, np.pi)) - 1e-6
        high = np.cos(np.maximum(own - angle, 0)) + 1e-6
        spans = [self.within(int(a), lo, hi) for a, lo, hi in zip(axes, low, high, strict=True)]
        if not spans:
            return np.arange(len(self.v))
        kept = min(spans, key=len)
        for a, lo, hi in zip(axes, low, high, strict=True):
            kept = kept[(self.unit[kept, a] >= lo) & (self.unit[kept, a] <= hi)]
        return kept


class Best:
    """The best k candidates of each query so far; the last one's score is the query's floor."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, floor.copy()
        self.query, self.rank, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.last = np.full(len(floor), np.iinfo(np.int64).max)  # rank of the k-th

    def add(self, query: np.ndarray, rank: np.ndarray, score: np.ndarray) -> None:
        worth = (score > self.floor[query]) | ((score == self.floor[query]) & (rank < self.last[query]))
        query, rank, score = query[worth], rank[worth], score[worth]
        if not len(query):
            return
        touched = np.zeros(len(self.floor), bool)
        touched[query] = True
        mine = touched[self.query]
        q, r, s = (np.concatenate(x) for x in ((self.query[mine], query), (self.rank[mine], rank), (self.score[mine], score.astype(np.int64))))
        kept = best_rows(q, r, s, self.k)
        q, r, s = q[kept], r[kept], s[kept]
        full = np.flatnonzero(np.bincount(q, minlength=len(self.floor)) == self.k)
        end = np.searchsorted(q, full, "right") - 1
        self.floor[full], self.last[full] = s[end], r[end]
        self.query, self.rank, self.score = (np.concatenate((old[~mine], new)) for old, new in ((self.query, q), (self.rank, r), (self.score, s)))


def search(queries: Rows, targets: Rows, floor: np.ndarray, k: int, cosine_from: float = COORDINATE_COSINE, bucket_rows: int = BUCKET) -> Best:
    """Best k targets of each query with at least its floor. Targets come longest first; a query's own row is left out."""
    width = max(queries.v.shape[1], targets.v.shape[1])
    asked, rows = widened(queries.v, width), widened(targets.v, width)
    length, own = lengths(rows), lengths(asked)
    unit = asked / np.where(own > 0, own, 1)[:, None]
    rank = np.empty(len(rows), np.int64)
    rank[np.lexsort((targets["place"], targets["id"]))] = np.arange(len(rows))
    best = Best(floor, k)

    def add(bucket: Bucket, who: np.ndarray, query: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        at = bucket.first + row
        other = targets["place"][at] != queries["place"][who[query]]
        best.add(who[query][other], rank[at[other]], score[other])

    for first in range(0, len(rows), bucket_rows):
        bucket = Bucket(rows[first:first + bucket_rows], length[first:first + bucket_rows], first)
        reach = own * bucket.length[0]
        open_ = np.flatnonzero((best.floor <= 0) | (reach >= best.floor))
        if not len(open_):
            break
        cosine = np.where(best.floor[open_] > 0, best.floor[open_] / np.maximum(reach[open_], 1e-300), -1.0)
        by_length = open_[cosine < cosine_from]
        for at in range(0, len(by_length), QUERIES):
            who = by_length[at:at + QUERIES]
            need = np.where(best.floor[who] > 0, best.floor[who] / np.maximum(own[who], 1e-300), 0).min()
            n = int(np.searchsorted(-bucket.length, -need, "right"))
            score = products(asked[who], bucket.v[:n])
            query, row = np.nonzero(score >= best.floor[who][:, None])
            add(bucket, who, query, row, score[query, row])
        for q, c in zip(open_[cosine >= cosine_from].tolist(), cosine[cosine >= cosine_from].tolist(), strict=True):
            row = bucket.reachable(unit[q], c)
            if len(row):
                score = products(asked[q:q + 1], bucket.v[row])[0]
                add(bucket, np.array([q]), np.zeros(len(row), np.int64), row, score)
    return best


def _searcher(k: int, options: dict):
    def run(queries: Rows, targets: Rows):
        best = search(queries, targets, queries["floor"].astype(np.float64), k, **options)
        row = np.lexsort((targets["place"], targets["id"]))[best.rank]
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries["place"][best.query]), pa.array(queries["id"][best.query]), pa.array(targets["place"][row]),
             pa.array(targets["id"][row], mask=targets["known"][row] == 0), pa.array(best.score)],
            names=["place", "query_id", "candidate", "vec_id", "score"])
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "candidate")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_products(vectors: DataFrame, k: int = K, scale: int = SCALE, every: int = EVERY, *, vec_id: str = "vec_id", vector: str = "embedding",
                 is_query: Column | None = None, strip_rows: int = STRIP_ROWS, **options) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k other rows with the highest product with each query, by default those whose id divides by ``every``."""
    asked = F.pmod(F.col(vec_id), F.lit(every)) == 0 if is_query is None else is_query
    rows = pin(integer_vectors(vectors, scale, vec_id, vector, asked=F.coalesce(asked, F.lit(False))))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))) * (1 + SLACK)
    rows = numbered(rows.withColumn("length", length), [F.col("length").desc(), F.col("id"), F.col("place")], 4 * strip_rows)
    rows = rows.withColumn("strip", F.floor(F.col("number") / strip_rows))
    targets = pin(packed(rows, ["place", "id", "known"]))
    lowest = F.lit(-(2 ** 62)).cast("bigint")
    mine = rows.where("asked = 1")
    queries = packed(mine.withColumn("floor", lowest), ["place", "id", "floor"])
    args = ["place", "id", "known"], ["place", "id", "floor"]
    own = mine.select("strip", F.col("strip").alias("query")).distinct()
    home = pin(meet(targets, args[0], queries, args[1], own, _searcher(k, options), _FOUND))
    # What another row must reach, and the length that a strip needs for it; a floor of 0 or less is reached by any strip.
    floors = home.groupBy("place").agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") == k).drop("n")
    mine = pin(mine.join(floors, "place", "left").withColumn("floor", F.coalesce("floor", lowest)))
    reach = mine.groupBy(F.col("strip").alias("query")).agg(F.min(F.when((F.col("floor") > 0) & (F.col("length") > 0), F.col("floor") / F.col("length")).otherwise(0.0)).alias("need"))
    strips = rows.groupBy("strip").agg(F.max("length").alias("longest"))
    count = strips.agg(F.max("strip")).first()[0]
    needs = reach.select("query", "need", F.explode(F.sequence(F.lit(0), F.lit(count or 0).cast("bigint"))).alias("strip")).where("strip <> query")
    needs = pin(needs.join(strips, "strip").where(F.col("longest") >= F.col("need")).select("strip", "query"))
    away = meet(targets, args[0], packed(mine, args[1]), args[1], needs, _searcher(k, options), _FOUND)
    return _best(home.unionByName(away), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
