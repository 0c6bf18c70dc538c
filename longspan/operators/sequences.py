"""Look-back samples: a fixed number of rows as input, the row ``horizon`` later as target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from longspan.config import PanelSpec, SequenceConfig
from longspan.functions.columns import col
from longspan.operators.ordering import POS, ROWS, block_window, core_rows, with_blocks
from longspan.operators.split import SPLIT_POS, SPLIT_ROWS

STEPS = "x"
SPANS = (7, 14)  # lengths of the summaries of a flattened window


def candidate_windows(
    df: DataFrame, spec: PanelSpec, cfg: SequenceConfig, features: list[str] | None = None, summary_of: list[str] | None = None,
) -> DataFrame:
    """One row per window whose input and target rows both exist, whether or not the target was observed.

    With ``features`` the input itself is attached as an array of float arrays; without it only the window's metadata is
    built, which costs no copying. The window belongs to the split of its target row. ``summary_of`` attaches mean, std, min
    and max of the window's last rows of these columns as ``summary``, taken as running aggregates over rows.
    """
    isolated = cfg.boundary == "isolated_partition"
    scope = ["split"] if isolated else []
    at, length = (F.col(SPLIT_POS), F.col(SPLIT_ROWS)) if isolated else (F.col(POS), F.col(ROWS))

    carried = [spec.entity, spec.time, "split", spec.target, f"scaled_{spec.target}", spec.valid_flag]
    values = {f"_s{i}": col(c).cast("float").cast("double").alias(f"_s{i}") for i, c in enumerate(summary_of or [])}
    rows = df.select(
        *[col(c) for c in carried], POS, ROWS, SPLIT_POS, SPLIT_ROWS, *values.values(),
        *([F.array(*[col(c).cast("float") for c in features]).alias("_step")] if features else []),
    )
    rows = with_blocks(rows, spec, back=cfg.lookback - 1, ahead=cfg.horizon)
    w = block_window(spec, scope)
    frame = w.rowsBetween(-(cfg.lookback - 1), 0)

    def ahead(name: str):
        return F.lead(col(name), cfg.horizon).over(w)

    rows = rows.select(
        col(spec.entity), POS, "_core", at.alias("_at"), length.alias("_length"),
        F.first(col(spec.time)).over(frame).alias("input_start"),
        col(spec.time).alias("input_end"),
        ahead(spec.time).alias("target_time"),
        ahead(spec.target).cast("float").alias("y"),
        ahead(f"scaled_{spec.target}").cast("float").alias("y_scaled"),
        ahead(spec.valid_flag).alias("target_observed"),
        ahead("split").alias("split"),
        *([F.collect_list("_step").over(frame).alias(STEPS)] if features else []),
        *([F.array(*[e for v in values for n in SPANS for e in _summary(F.col(v), w.rowsBetween(-(min(n, cfg.lookback) - 1), 0))])
           .alias("summary")] if values else []),
    )
    fits = (F.col("_at") >= cfg.lookback) & (F.col("_at") + cfg.horizon <= F.col("_length"))
    return rows.where(F.col("_core") & fits).drop("_core", "_at", "_length")


def _summary(v: Column, last: WindowSpec) -> list[Column]:
    return [F.avg(v).over(last), F.coalesce(F.stddev_samp(v).over(last), F.lit(0.0)), F.min(v).over(last), F.max(v).over(last)]


def keep_observed(windows: DataFrame, cfg: SequenceConfig) -> DataFrame:
    return windows.where(F.col("target_observed")) if cfg.filter_missing_targets else windows


def window_counts(windows: DataFrame, cfg: SequenceConfig) -> DataFrame:
    """Candidates, skipped and kept windows per split, from unfiltered candidates."""
    observed = F.count_if(F.col("target_observed")) if cfg.filter_missing_targets else F.count("*")
    return windows.groupBy("split").agg(
        F.count("*").alias("candidates"), (F.count("*") - observed).alias("skipped"), observed.alias("kept")
    )


def integrity(windows: DataFrame, cfg: SequenceConfig, width: int) -> DataFrame:
    """Violations per split of windows that hold their input, for instance stored ones; every count of a sound dataset is
    zero. It walks every value of every window: while windows are built, ``unusable_steps`` says the same per row."""
    bad_value = F.exists(STEPS, lambda s: F.exists(s, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    checks = {
        "bad_length": F.size(STEPS) != cfg.lookback,
        "bad_width": F.exists(STEPS, lambda s: F.size(s) != width),
        "bad_value": bad_value,
        "bad_target": F.col("y").isNull() | F.isnan("y") | F.col("y_scaled").isNull() | F.isnan("y_scaled"),
        "unobserved_target": ~F.col("target_observed"),
    }
    return windows.groupBy("split").agg(*[F.count_if(c).alias(n) for n, c in checks.items()])


def unusable_steps(df: DataFrame, features: list[str]) -> DataFrame:
    """Per split, rows with a null, NaN or infinite feature: a window is sound if all its rows are."""
    values = [col(c).cast("float") for c in features]
    bad = F.exists(F.array(*values), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return df.groupBy("split").agg(F.count_if(bad).alias("bad_value"))


def dataset_summary(windows: DataFrame, cfg: SequenceConfig, features: list[str]) -> DataFrame:
    return windows.groupBy("split").agg(F.count("*").alias("n_samples")).select(
        "split", "n_samples", F.lit(cfg.lookback).alias("steps"), F.lit(len(features)).alias("width")
    )


CHUNK_ROWS = 512  # rows of an entity that are stored together


def sample_chunks(
    df: DataFrame, spec: PanelSpec, cfg: SequenceConfig, features: list[str], chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Samples without copies of their input: ``entity, split, chunk, steps, samples``.

    An entity's rows are cut into chunks of positions. A chunk holds its rows' features once, and before them the rows that its
    first samples look back on, as ``steps``; a sample is the place in ``steps`` at which its input begins, next to what
    ``candidate_windows`` tells of it. A chunk with samples of two splits is stored once for each, cut to the steps it needs.
    """
    if chunk_rows < cfg.lookback:
        raise ValueError("chunk_rows must reach the look-back")
    e, back = col(spec.entity), cfg.lookback - 1

    def chunk(shift: int) -> Column:
        return F.floor((F.col(POS) - 1 + shift) / chunk_rows)

    windows = keep_observed(candidate_windows(df, spec, cfg), cfg)
    told = [c for c in windows.columns if c not in (spec.entity, "split")]
    samples = windows.select(e, chunk(0).alias("chunk"), F.struct(POS, "split", *[c for c in told if c != POS]).alias("s")).groupBy(
        e, "chunk").agg(F.sort_array(F.collect_list("s")).alias("_samples"))
    step = F.array(*[col(c).cast("float") for c in features])
    rows = df.select(e, POS, step.alias("step"), F.explode(F.sequence(chunk(0), chunk(back))).alias("chunk"))
    steps = rows.groupBy(e, "chunk").agg(F.sort_array(F.collect_list(F.struct(POS, "step"))).alias("_steps"))
    both = samples.join(steps, [spec.entity, "chunk"])
    both = both.select("*", F.explode(F.array_distinct(F.transform("_samples", lambda s: s["split"]))).alias("split"))
    both = both.withColumn("_own", F.filter("_samples", lambda s: s["split"].eqNullSafe(F.col("split"))))
    first = F.get("_own", F.lit(0))[POS] - back
    skipped = (first - F.get("_steps", F.lit(0))[POS]).cast("int")
    length = (F.element_at("_own", -1)[POS] - first + 1).cast("int")
    both = both.select(e, "split", "chunk", "_own", first.alias("_first"), F.slice(F.col("_steps.step"), skipped + 1, length).alias("steps"))
    own = F.transform("_own", lambda s: F.struct((s[POS] - back - F.col("_first")).cast("int").alias("at"), *[s[c].alias(c) for c in told]))
    return both.select(e, "split", "chunk", "steps", own.alias("samples"))


def read_samples(chunks: DataFrame, spec: PanelSpec, cfg: SequenceConfig) -> DataFrame:
    """The samples of ``sample_chunks`` with their input as ``x``: each a slice of its chunk's steps, taken as it is read."""
    rows = chunks.select(col(spec.entity), "split", "steps", F.explode("samples").alias("s"))
    told = [f.name for f in chunks.schema["samples"].dataType.elementType.fields if f.name != "at"]
    return rows.select(col(spec.entity), *[F.col("s")[c].alias(c) for c in told], "split",
                       F.slice("steps", F.col("s.at") + 1, F.lit(cfg.lookback)).alias(STEPS))


def chunk_counts(cfg: SequenceConfig) -> dict[str, Column]:
    """Aggregates over chunks that say, as they are written, how many of their samples are broken; names as in ``integrity``."""
    def count(broken) -> Column:
        return F.sum(F.size(F.filter("samples", broken)))

    def unusable(v: Column) -> Column:
        return v.isNull() | F.isnan(v)

    return {
        "n_windows": F.sum(F.size("samples")),
        "bad_length": count(lambda s: (s["at"] < 0) | (s["at"] + cfg.lookback > F.size("steps"))),
        "bad_target": count(lambda s: unusable(s["y"]) | unusable(s["y_scaled"])),
        "unobserved_target": count(lambda s: ~s["target_observed"]),
    }


def flatten_samples(windows: DataFrame) -> DataFrame:
    """Tabular form of a window: all steps flattened, then the ``summary`` that ``candidate_windows`` attached."""
    flat = F.transform(F.flatten(STEPS), lambda v: v.cast("double"))
    vector = F.concat(flat, F.col("summary")) if "summary" in windows.columns else flat
    return windows.withColumn("flat", vector).drop(STEPS, "summary")
