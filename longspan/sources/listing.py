"""A sorted copy of a table for paging: files of consecutive keys and one index row a file, so a page reads the files it shows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from longspan.functions.columns import col


def after_key(order: list[str], key: tuple) -> Column:
    """Whether a row comes after ``key`` in ascending order with nulls first.

    Written column by column, with a bound on the first column of its own, so that scans can skip files and row groups by their
    minima and maxima (a comparison of structs is never pushed down). NaN, like in sorting, comes after all numbers.
    """
    if len(key) != len(order):
        raise ValueError(f"the key has {len(key)} values for {len(order)} columns")
    later, same = F.lit(False), F.lit(True)
    for name, value in zip(order, key):
        c = col(name)
        beyond, equal = (c.isNotNull(), c.isNull()) if value is None else (c > F.lit(value), c == F.lit(value))
        later, same = later | (same & beyond), same & equal
    return later if key[0] is None else later & (col(order[0]) >= F.lit(key[0]))


def _sorted(df: DataFrame, order: list[str]) -> DataFrame:
    return df.orderBy(*[col(o) for o in order])


@dataclass(frozen=True)
class Listing:
    """``path`` holds ``rows``, range-partitioned by ``order``, and ``index``: per file its key range, rows, and rows before it."""

    path: str
    order: list[str]

    def _index(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/index")

    def files(self, spark: SparkSession, size: int, offset: int = 0, after: tuple | None = None) -> list[str]:
        """The files that hold a page, in order. At most one index row a wanted row (and two) reaches the driver."""
        index = self._index(spark)
        if after is not None:
            ends = [F.col("last").getField(f"k{i}").alias(f"k{i}") for i in range(len(self.order))]
            index = index.select("file", "n_rows", "rows_before", "place", *ends).where(
                after_key([f"k{i}" for i in range(len(self.order))], after))
            # The first file may start with rows up to ``after``, which the page skips: its rows count for nothing here.
            index = _sorted(index, ["place"]).limit(offset + size + 1)
            listed, found, out = index.collect(), 0, []
            for r in listed:
                out.append(r.file)
                found += r.n_rows if len(out) > 1 else 0
                if found >= offset + size:
                    break
            return out
        wanted = index.where((F.col("rows_before") < offset + size) & (F.col("rows_before") + F.col("n_rows") > offset))
        return [r.file for r in _sorted(wanted, ["place"]).collect()]

    def page(self, spark: SparkSession, size: int, offset: int = 0, after: tuple | None = None) -> DataFrame:
        """Rows ``offset`` to ``offset + size`` of those after the key ``after`` (of all, without it), in order."""
        rows = spark.read.parquet(f"{self.path}/rows")
        skip = offset
        names = self.files(spark, size, offset, after)
        if not names:
            return rows.limit(0)
        if after is None:
            skip -= self._index(spark).where(F.col("file") == names[0]).first().rows_before
        rows = spark.read.schema(rows.schema).parquet(*names)
        if after is not None:
            rows = rows.where(after_key(self.order, after))
        return _sorted(rows, self.order).offset(skip).limit(size)


def write_listing(df: DataFrame, order: list[str], path: str, files: int | None = None) -> Listing:
    """Write the sorted copy: one shuffle by ranges of the key, then one scan of the keys for the index.

    Rows of one key stay in one file, so ``order`` should end in a column that tells rows apart. Spark samples the key to choose the
    ranges; the index holds what the files really hold. ``files`` is a wish, by default the session's shuffle partitions.
    """
    spark = df.sparkSession
    keys = [col(o) for o in order]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/rows")
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    held = spark.read.parquet(f"{path}/rows").groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("n_rows"))
    by_key = Window.orderBy("first")  # over one row a file
    index = held.withColumn("place", F.row_number().over(by_key)).withColumn(
        "rows_before", F.sum("n_rows").over(by_key.rowsBetween(Window.unboundedPreceding, -1))).fillna(0, ["rows_before"])
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")
    return Listing(path, list(order))
