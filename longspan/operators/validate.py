"""Validation and typing of a raw text panel, and the strict check before preprocessing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longspan.config import PanelSpec
from longspan.functions.columns import col, require
from longspan.functions.parsing import is_infinite, null_tokens, parse_date, parse_number, strip
from longspan.session import pin


def clean_nulls(raw: DataFrame) -> DataFrame:
    """Turn missing-value tokens into nulls in every column."""
    return raw.select(*[null_tokens(col(c)).alias(c) for c in raw.columns])


def typed(raw: DataFrame, spec: PanelSpec) -> DataFrame:
    """Known columns in schema order: stripped text, dates, doubles; what does not parse becomes null."""
    return raw.select(
        strip(col(spec.entity)).alias(spec.entity),
        parse_date(col(spec.time)).alias(spec.time),
        *[parse_number(col(c)).alias(c) for c in spec.numeric],
        strip(col(spec.category)).alias(spec.category),
    )


def sorted_panel(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.orderBy(col(spec.entity).asc_nulls_last(), col(spec.time).asc_nulls_last())


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows."""
    return df.sparkSession.createDataFrame([(repeats(df, [])["rows"],)], "n_duplicates bigint")


def duplicate_keys(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return _beyond_first(df, [spec.entity, spec.time])


def _beyond_first(df: DataFrame, columns: list[str]) -> DataFrame:
    groups = df.groupBy(*[col(c) for c in columns]).agg(F.count("*").alias("_c"))
    return groups.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("n_duplicates"))


REPEATED_SIGNATURES = 1_000_000  # signatures of 16 bytes that are broadcast


def signature(df: DataFrame, columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of some columns, in both orders; nulls count in their places, and the two zeros are one."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cells = [col(c) + F.lit(0.0) if c in floats else col(c) for c in columns]
    absent = F.array(*[col(c).isNull() for c in columns]) if columns else F.lit(0)
    return F.xxhash64(*cells, absent), F.xxhash64(absent, *reversed(cells))


def repeats(
    df: DataFrame, key: list[str], sign: Callable[[DataFrame, list[str]], tuple[Column, Column]] = signature,
    broadcast_signatures: int = REPEATED_SIGNATURES,
) -> dict[str, int]:
    """``rows`` beyond the first of equal rows and ``keys`` beyond the first of equal keys (no key: none).

    Only signatures move: hashes of the row and of its key are counted. Rows whose signature repeats are then told apart by all
    their values, so a chance collision counts for nothing; they are found by a broadcast of the repeated signatures while
    these are few, which is counted, else by a join.
    """
    (a, b), (k, _) = sign(df, df.columns), sign(df, key) if key else (F.lit(0).cast("bigint"), None)
    signed = df.select("*", a.alias("_a"), b.alias("_b"), k.alias("_k"))
    tally = pin(signed.groupBy("_k", "_a", "_b").agg(F.count("*").alias("_c")))

    def beyond_first(again: DataFrame, columns: list[str]) -> int:
        found = again.count()
        if not found:
            return 0
        held = F.broadcast(again) if found <= broadcast_signatures else again
        suspects = signed.join(held, again.columns, "left_semi").select(*[col(c) for c in columns])
        return _beyond_first(suspects, columns).first()[0]

    out = {"rows": beyond_first(tally.where("_c > 1").select("_a", "_b").distinct(), df.columns), "keys": 0}
    if key:
        again = tally.groupBy("_k").agg(F.sum("_c").alias("_n")).where("_n > 1").select("_k")
        out["keys"] = beyond_first(again, key)
    return out


def empty_key(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def bad_date(c: Column) -> Column:
    return c.isNotNull() & parse_date(c).isNull()


def bad_number(c: Column) -> Column:
    return c.isNotNull() & parse_number(c).isNull()


def bad_category(c: Column, spec: PanelSpec) -> Column:
    return F.coalesce(~strip(c).isin(*spec.categories), F.lit(False))


def invalid_date_samples(raw: DataFrame, spec: PanelSpec, limit: int = 5) -> DataFrame:
    """A few unparseable dates for the report, smallest texts first."""
    t = col(spec.time)
    return raw.where(bad_date(t)).select(t.alias("sample")).orderBy("sample").limit(limit)


def unexpected_categories(raw: DataFrame, spec: PanelSpec) -> DataFrame:
    c = col(spec.category)
    return raw.where(bad_category(c, spec)).groupBy(strip(c).alias("value")).agg(F.count("*").alias("n"))


class Check(NamedTuple):
    """One check of one column: how often it fired, how bad that is, and examples."""

    check_name: str
    column: str
    severity: str
    n: int
    detail: str = ""

    def __str__(self) -> str:
        return f"{self.check_name}: {self.n} in {self.column}{self.detail}"


@dataclass(frozen=True)
class Outcome:
    """What validation found: every check as a row, those that fired and those that did not."""

    n_rows: int
    n_columns: int
    checks: tuple[Check, ...]
    unexpected: DataFrame | None = field(default=None, compare=False, repr=False)  # every unexpected category with its count

    def fired(self, severity: str) -> list[str]:
        return [str(c) for c in self.checks if c.n and c.severity == severity]

    def count(self, check_name: str) -> dict[str, int]:
        """Findings of a check by column, where there are any."""
        return {c.column: c.n for c in self.checks if c.check_name == check_name and c.n}

    @property
    def is_valid(self) -> bool:
        return not self.fired("error")

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.checks), CHECKS_SCHEMA)


# How each check is graded.
SEVERITY = {
    "duplicate_rows": "warning", "duplicate_keys": "error", "empty_entities": "error", "invalid_dates": "error",
    "invalid_numbers": "error", "negative_values": "warning", "invalid_categories": "warning",
    "missing_column": "error", "unexpected_column": "note",
}


def check_counts(raw: DataFrame, spec: PanelSpec) -> DataFrame:
    """Validation counters in long form: (check_name, column, severity, n, n_rows). ``raw`` has its null tokens cleared.

    One scan counts without a shuffle; repeated rows and keys are counted by their signatures, so whole rows move only where they
    may repeat.
    """
    require(raw, spec.required)
    cells: list[tuple[str, str, Column]] = [
        ("empty_entities", spec.entity, empty_key(col(spec.entity))),
        ("invalid_dates", spec.time, bad_date(col(spec.time))),
        ("invalid_categories", spec.category, bad_category(col(spec.category), spec)),
    ]
    cells += [("invalid_numbers", c, bad_number(col(c))) for c in spec.numeric]
    cells += [("negative_values", c, parse_number(col(c)) < 0) for c in spec.numeric]
    counted = raw.agg(F.count("*").alias("_rows"), *[F.count_if(e).alias(f"_{i}") for i, (_, _, e) in enumerate(cells)])
    again = repeats(raw, [spec.entity, spec.time])
    entries = [_entry(name, c, F.col(f"_{i}"), F.col("_rows")) for i, (name, c, _) in enumerate(cells)]
    entries += [_entry("duplicate_rows", "*", F.lit(again["rows"]).cast("bigint"), F.col("_rows")),
                _entry("duplicate_keys", f"{spec.entity},{spec.time}", F.lit(again["keys"]).cast("bigint"), F.col("_rows"))]
    return counted.select(F.inline(F.array(*entries)))


def _entry(name: str, column: str, n: Column, n_rows: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"), F.lit(column).alias("column"), F.lit(SEVERITY[name]).alias("severity"),
        n.alias("n"), n_rows.alias("n_rows"),
    )


NAMED_CATEGORIES = 1000  # unexpected categories that a message names; the outcome's table has all

CHECKS_SCHEMA = "check_name string, column string, severity string, n bigint, detail string"


def schema_checks(raw: DataFrame, spec: PanelSpec) -> list[Check]:
    found = [Check("missing_column", c, SEVERITY["missing_column"], 1) for c in spec.required if c not in raw.columns]
    return found + [Check("unexpected_column", c, SEVERITY["unexpected_column"], 1) for c in raw.columns if c not in spec.required]


def validate_raw(raw: DataFrame, spec: PanelSpec) -> tuple[DataFrame | None, Outcome]:
    """Type the panel and report every problem; no table comes back when required columns are missing."""
    checks = schema_checks(raw, spec)
    if any(c.severity == "error" for c in checks):
        return None, Outcome(raw.count(), len(raw.columns), tuple(checks))

    width, raw, unexpected = len(raw.columns), clean_nulls(raw), None
    counted = check_counts(raw, spec).orderBy("check_name", "column").collect()
    for r in counted:
        detail = ""
        if r["n"] and r["check_name"] == "invalid_dates":
            detail = f", samples {[s['sample'] for s in invalid_date_samples(raw, spec).collect()]}"
        if r["n"] and r["check_name"] == "invalid_categories":
            unexpected = pin(unexpected_categories(raw, spec))
            named = [u["value"] for u in unexpected.orderBy(F.desc("n"), "value").limit(NAMED_CATEGORIES).collect()]
            more = unexpected.count() - len(named)
            detail = f", values {named}" + (f" and {more} more" if more else "")
        checks.append(Check(r["check_name"], r["column"], r["severity"], r["n"], detail))
    return typed(raw, spec), Outcome(counted[0]["n_rows"], width, tuple(checks), unexpected)


def strict_counts(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per numeric column: unparseable, infinite and negative values. Works on text and on typed columns."""
    def number(c: str) -> Column:
        return parse_number(col(c)) if isinstance(df.schema[c].dataType, T.StringType) else col(c).cast("double")

    wide = df.agg(*[
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(col(c).isNotNull() & number(c).isNull()).alias("n_invalid"),
            F.count_if(is_infinite(number(c))).alias("n_infinite"),
            F.count_if(number(c) < 0).alias("n_negative"),
        ).alias(f"_{i}") for i, c in enumerate(spec.numeric)
    ])
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(spec.numeric))])))


def validate_strict(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Raise on missing columns, bad dates, non-numeric or infinite values; else return the typed panel with its flag."""
    require(df, [spec.entity, spec.time, *spec.numeric])
    is_text = isinstance(df.schema[spec.time].dataType, T.StringType)
    t = parse_date(col(spec.time)) if is_text else col(spec.time)
    if is_text:
        bad = df.agg(F.count_if(t.isNull()).alias("n")).first()["n"]
        if bad:
            raise ValueError(f"{bad} invalid dates in input data")
    for r in strict_counts(df, spec).collect():
        if r["n_invalid"]:
            raise ValueError(f"column '{r['column']}' has {r['n_invalid']} non-numeric values")
        if r["n_infinite"]:
            raise ValueError(f"column '{r['column']}' has {r['n_infinite']} infinite values")
    casts = {
        c: parse_number(col(c)) if isinstance(df.schema[c].dataType, T.StringType) else col(c).cast("double")
        for c in spec.numeric
    }
    out = df.withColumns({spec.entity: strip(col(spec.entity)), spec.time: t, **casts})
    return flag_target(out, spec)


def flag_target(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Mark truly observed targets; must run before any filling."""
    return df.withColumn(spec.valid_flag, col(spec.target).isNotNull())


def panel_summary(df: DataFrame, spec: PanelSpec) -> DataFrame:
    observed = col(spec.target).isNotNull()
    return df.agg(
        F.count("*").alias("n_rows"), F.count_distinct(col(spec.entity)).alias("n_entities"),
        F.min(col(spec.time)).alias("date_min"), F.max(col(spec.time)).alias("date_max"),
        F.count_if(observed).alias("n_observed"), F.count_if(~observed).alias("n_missing"),
    )
