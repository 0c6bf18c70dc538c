"""Lookups over a panel: bands, catalogue, latest rows, snapshots, pages and data readiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longspan.config import BAND_COLOURS, BAND_LIMITS, CATEGORY_LABELS, PanelSpec
from longspan.functions.columns import col, percent
from longspan.operators.ordering import POS, with_position
from longspan.sources.listing import after_key


def _band(value: Column, names: tuple[str, ...]) -> Column:
    out = F.when(value <= BAND_LIMITS[0], names[0])
    for limit, name in zip(BAND_LIMITS[1:], names[1:]):
        out = out.when(value <= limit, name)
    return out.when(value.isNotNull(), names[-1])


def hazard_band(value: Column) -> Column:
    return _band(value, CATEGORY_LABELS)


def band_colour(value: Column) -> Column:
    return _band(value, BAND_COLOURS)


def entity_catalogue(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """First and last time, records and share of records with a target."""
    return df.groupBy(col(spec.entity)).agg(
        F.min(col(spec.time)).alias("data_start"), F.max(col(spec.time)).alias("data_end"),
        F.count("*").alias("n_records"),
        (F.count(col(spec.target)) / F.count("*")).alias("completeness"),
    )


def latest_rows(df: DataFrame, entity: str, time: str, keep: list[str]) -> DataFrame:
    """The newest row of each entity, of several at that time the largest by the columns kept; combined before the shuffle, so
    long series are no burden."""
    row = F.struct(*[col(c) for c in keep])
    newest = F.max_by(row, F.when(col(time).isNotNull(), F.struct(col(time), row)))
    return df.groupBy(col(entity)).agg(F.max(col(time)).alias(time), newest.alias("_row")).select(
        col(entity), col(time), *[F.col("_row").getField(c).alias(c) for c in keep]
    )


def snapshot(df: DataFrame, entity: str, time: str, keep: list[str], at, exact: bool = False) -> DataFrame:
    """Every entity at one moment: its row at exactly ``at``, or its newest row up to ``at``."""
    if exact:
        return df.where(col(time) == F.lit(at)).select(col(entity), col(time), *[col(c) for c in keep])
    return latest_rows(df.where(col(time) <= F.lit(at)), entity, time, keep)


#: Days that one bitmap holds at most (bits of a long, the sign left alone).
BITMAP_DAYS = 62


def lookback_pull(requests: DataFrame, df: DataFrame, spec: PanelSpec, days: int = 30) -> DataFrame:
    """Whether each requested (entity, reference_date) ends a run of ``days`` consecutive daily rows.

    The days that an entity has are one bitmap a stretch of days, made before the shuffle; a request looks up the two or so stretches
    that its days touch by an equality join and counts bits. Every request yields ``n_found`` and ``accepted``; ``lookback_rows``
    gives the rows of the accepted ones. Requests without an entity or a date find nothing; repeated rows count once.
    """
    width = min(days, BITMAP_DAYS)
    known = _dated(df.select(col(spec.entity), col(spec.time)), spec).groupBy(col(spec.entity), _stretch(F.col("_day"), width).alias("_stretch")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(_day, {width}) AS int))")).alias("_known"))
    asked = requests.select(col(spec.entity), "reference_date").distinct()
    found = _touched(asked, days, width).join(known, [spec.entity, "_stretch"])
    counted = found.groupBy(col(spec.entity), "reference_date").agg(
        F.sum(F.bit_count(F.col("_known").bitwiseAND(F.col("_wanted")))).alias("n_found"))
    return asked.join(counted, [spec.entity, "reference_date"], "left").fillna(0, ["n_found"]).withColumn(
        "accepted", F.col("n_found") == days
    )


def lookback_rows(requests: DataFrame, df: DataFrame, spec: PanelSpec, days: int = 30) -> DataFrame:
    """The rows of the accepted requests, once for each request that they belong to.

    Requests of a stretch of days are merged first: their days in one bitmap, their dates in one list (no longer than the days that
    can look back on the stretch). So each row of the panel is looked up once, however many requests overlap on it.
    """
    width = min(days, BITMAP_DAYS)
    accepted = lookback_pull(requests, df, spec, days).where("accepted").select(col(spec.entity), "reference_date")
    merged = _touched(accepted, days, width).groupBy(col(spec.entity), "_stretch").agg(
        F.bit_or("_wanted").alias("_wanted"), F.collect_list("reference_date").alias("_dates"))
    placed = _dated(df, spec).withColumn("_stretch", _stretch(F.col("_day"), width))
    needed = F.expr(f"shiftright(_wanted, cast(pmod(_day, {width}) AS int)) & 1L") == 1
    rows = placed.join(merged, [spec.entity, "_stretch"]).where(needed)
    own = F.filter("_dates", lambda r: F.unix_date(r).between(F.col("_day"), F.col("_day") + days - 1))
    rest = [col(c) for c in df.columns if c not in (spec.entity, spec.time)]
    return rows.select(col(spec.entity), col(spec.time), F.explode(own).alias("reference_date"), *rest)


def _dated(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows of whole days, with the number of the day."""
    day = col(spec.time).cast("date")
    return df.where(day == col(spec.time)).withColumn("_day", F.unix_date(day))


def _stretch(day: Column, width: int) -> Column:
    return F.floor(day / F.lit(width)).cast("bigint")


def _touched(requests: DataFrame, days: int, width: int) -> DataFrame:
    """Each request once for each stretch of days it looks back on, with a bitmap of its days there."""
    last = F.unix_date(F.col("reference_date").cast("date"))
    stretch = F.explode(F.sequence(_stretch(last - (days - 1), width), _stretch(last, width)))
    out = requests.withColumn("_stretch", stretch).withColumn("_start", F.col("_stretch") * width)
    low = F.greatest(last - (days - 1) - F.col("_start"), F.lit(0)).cast("int").alias("_low")
    high = F.least(last - F.col("_start"), F.lit(width - 1)).cast("int").alias("_high")
    bits = F.expr("(shiftleft(1L, _high + 1) - 1L) & ~(shiftleft(1L, _low) - 1L)")
    return out.select("*", low, high).withColumn("_wanted", bits).drop("_start", "_low", "_high")


def dominant_driver(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per row, the measure with the largest standardised value; the first in schema order on ties."""
    best = F.greatest(*[col(f"scaled_{m}") for m in spec.measures])
    name = F.lit(None).cast("string")
    for m in reversed(spec.measures):
        name = F.when(col(f"scaled_{m}") == best, m).otherwise(name)
    return df.select(col(spec.entity), col(spec.time), name.alias("driver"), best.alias("driver_value"))


def page(df: DataFrame, order: list[str], size: int, offset: int = 0, after: tuple | None = None) -> DataFrame:
    """One page of a sorted listing. ``after`` (the last key of the previous page) keeps deep pages as cheap as the first; where
    many pages are wanted, ``sources.listing`` stores a sorted copy, of which a page reads the files it shows."""
    if after is not None:
        df = df.where(after_key(order, after))
    return df.orderBy(*[col(o) for o in order]).offset(offset).limit(size)


def readiness(df: DataFrame, spec: PanelSpec, needed: int) -> DataFrame:
    """Rows and longest run of consecutive days per entity, and whether each suffices for ``needed`` rows."""
    placed = df if POS in df.columns else with_position(df, spec)
    run = F.date_sub(col(spec.time), F.col(POS).cast("int"))  # constant along consecutive days
    runs = placed.groupBy(col(spec.entity), run.alias("_run")).agg(F.count("*").alias("_n"))
    out = runs.groupBy(col(spec.entity)).agg(F.sum("_n").alias("n_rows"), F.max("_n").alias("longest_run"))
    return out.withColumn("enough_rows", F.col("n_rows") >= needed).withColumn("enough_consecutive", F.col("longest_run") >= needed)
