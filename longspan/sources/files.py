"""Reading and writing panels, reports, samples and fitted parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longspan.operators.scale import ColumnParams, params_from_table, params_table


def _found(load, path: str) -> DataFrame:
    try:
        return load()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            raise FileNotFoundError(f"not found: {path}") from e
        raise


def file_list(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Paths and sizes of the files at a path; their contents are not read."""
    files = _found(lambda: spark.read.format("binaryFile").load(path), path)
    return [(r["path"], r["length"]) for r in files.select("path", "length").orderBy("path").collect()]


def file_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files at a path."""
    return sum(n for _, n in file_list(spark, path))


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Files by header line: the first line of each file, taken in the task that reads the file's beginning."""
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"))
    first = lines.where("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))
    found: dict[str, list[str]] = {}
    for r in first.orderBy("path").collect():  # one row per file
        found.setdefault(r["header"].removeprefix("\ufeff").rstrip("\r"), []).append(r["path"])
    return found


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column as text and nothing inferred. A missing path or an empty file is an error.

    Columns are matched by name: files whose headers list the same columns in another order are read by their own header.
    """
    listed = [(p, n) for p, n in file_list(spark, path) if n]
    if not listed:
        raise ValueError(f"raw dataset is empty: {path}")

    def read(paths: list[str]) -> DataFrame:
        return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(paths)

    if len(listed) == 1:
        return read([listed[0][0]])
    parts = [read(paths) for paths in _headers(spark, [p for p, _ in listed]).values()]
    for part in parts[1:]:
        if sorted(part.columns) != sorted(parts[0].columns):
            raise ValueError(f"files at {path} have different columns: {parts[0].columns} and {part.columns}")
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    return _found(lambda: spark.read.parquet(path), path)


def _plain(df: DataFrame) -> DataFrame:
    """Without what operators have noted on columns: a stored table may be appended to, and the notes would go stale."""
    noted = [f.name for f in df.schema.fields if f.metadata]
    return df.select(*[df[f"`{c}`"].alias(c, metadata={}) if c in noted else df[f"`{c}`"] for c in df.columns]) if noted else df


def write_panel(df: DataFrame, path: str) -> None:
    _plain(df).write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_by_split(df: DataFrame, path: str) -> None:
    """One table with a directory per split; readers filter on ``split`` and skip the other directories."""
    _plain(df).write.mode("overwrite").partitionBy("split").option("compression", "snappy").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """Long-form report rows as JSON lines."""
    report.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return _found(lambda: spark.read.schema("section string, key string, metric string, value string").json(path), path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_params(spark: SparkSession, params: dict[str, ColumnParams], path: str) -> None:
    params_table(spark, params).coalesce(1).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> dict[str, ColumnParams]:
    return params_from_table(_found(lambda: spark.read.parquet(path), path))
