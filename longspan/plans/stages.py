"""The stages a user runs end to end: ingest, explore, preprocess, build samples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from longspan.config import FeatureConfig, PanelSpec, SequenceConfig, SplitConfig
from longspan.functions.columns import col
from longspan.operators import explore, features, impute, profile, scale, sequences, split, validate
from longspan.operators.ordering import POS, ROWS
from longspan.session import pin, temporary
from longspan.sources import files

POSITIONS = [POS, ROWS, split.SPLIT_POS, split.SPLIT_ROWS]


def ingest(
    spark: SparkSession, raw_path: str, table_path: str, report_path: str, spec: PanelSpec, multi_line: bool = False
) -> validate.Outcome:
    """CSV to validated Parquet. The profile is written even when validation fails; the table only when it passes."""
    with temporary(spark):
        raw = pin(files.read_raw_csv(spark, raw_path, multi_line))  # the text is parsed once
        panel, outcome = validate.validate_raw(raw, spec)
        source = profile.Source(raw_path, files.file_bytes(spark, raw_path))
        if panel is None:
            files.write_report(profile.outcome_report(spark, outcome, source), report_path)
            raise ValueError(f"validation failed: {outcome.fired('error')}")
        panel = pin(panel)  # the profile and the table both read the typed rows
        files.write_report(profile.profile_report(panel, spec, outcome, source), report_path)
        if not outcome.is_valid:
            raise ValueError(f"validation failed: {outcome.fired('error')}")
        files.write_panel(validate.sorted_panel(panel, spec), table_path)
    return outcome


def explore_panel(spark: SparkSession, table_path: str, report_path: str, spec: PanelSpec) -> DataFrame:
    with temporary(spark):
        report = explore.explore_report(files.read_panel(spark, table_path), spec)
        files.write_report(report, report_path)
    return files.read_report(spark, report_path)


@dataclass
class Prepared:
    table: DataFrame
    params: dict[str, scale.ColumnParams]


def split_and_fill(panel: DataFrame, spec: PanelSpec, cfg: SplitConfig | None = None) -> DataFrame:
    """Strictly typed panel with flag, positions and split, forward-filled; no fitted parameter is involved yet."""
    flagged = validate.flag_target(panel, spec)
    return impute.forward_fill(split.assign_split(flagged, spec, cfg), spec)


def impute_and_scale(filled: DataFrame, spec: PanelSpec, cfg: SplitConfig | None = None) -> Prepared:
    """Fit medians and scalers on the training rows, apply them to all rows."""
    cfg = cfg or SplitConfig()
    params = scale.fit_fill_and_scale(filled, spec.numeric)
    complete = impute.fill_constants(filled, {c: p.median for c, p in params.items()})
    scaled = spec.numeric if cfg.scale_target else list(spec.measures)
    return Prepared(scale.apply_standard(complete, params, scaled), params)


def preprocess(
    spark: SparkSession, table_path: str, out_path: str, params_path: str, spec: PanelSpec, cfg: SplitConfig | None = None
) -> Prepared:
    """Validated Parquet to a split-partitioned, imputed and scaled table plus its fitted parameters.

    The forward-filled table is pinned because the fit and the write both read it.
    """
    panel = validate.validate_strict(files.read_panel(spark, table_path), spec)
    with temporary(spark):
        filled = pin(split_and_fill(panel, spec, cfg))
        leaks = split.temporal_leaks(filled, spec)
        named = leaks.limit(20).collect()
        if named:
            raise ValueError(f"splits overlap in time for {leaks.count()} entities, such as {[r[0] for r in named]}")
        done = impute_and_scale(filled, spec, cfg)
        left = Observation("left")
        counts = [F.count_if(col(c).isNull()).alias(c) for c in spec.numeric]
        files.write_by_split(done.table.observe(left, *counts), out_path)
        if missing := {c: n for c, n in left.get.items() if n}:
            raise ValueError(f"missing values remain after imputation: {missing}")
        files.save_params(spark, done.params, params_path)
    return Prepared(files.read_panel(spark, out_path), done.params)


@dataclass
class Samples:
    windows: DataFrame
    feature_names: list[str]
    params: dict[str, scale.ColumnParams]


def model_table(
    prepared: DataFrame, spec: PanelSpec, fcfg: FeatureConfig, pinned: bool = False
) -> tuple[DataFrame, list[str], dict[str, scale.ColumnParams]]:
    """Engineered, scaled features next to keys, positions, flag and target, with the ordered model feature names."""
    engineered = features.engineer(prepared, spec, fcfg)
    if pinned:
        engineered = pin(engineered)
    params = features.fit_feature_scaler(engineered, spec, fcfg) if fcfg.scale_engineered else {}
    scaled = features.scale_engineered(engineered, spec, fcfg, params)
    names = features.model_features(spec, fcfg, scaled.columns)
    keep = [spec.entity, spec.time, "split", spec.valid_flag, spec.target, *POSITIONS]
    return scaled.select(*[col(c) for c in dict.fromkeys([*keep, *names])]), names, params


def build_samples(
    spark: SparkSession, prepared_path: str, out_path: str, params_path: str, spec: PanelSpec,
    fcfg: FeatureConfig, scfg: SequenceConfig | None = None,
) -> Samples:
    """Preprocessed table to look-back samples, one directory per split.

    Each row's features are stored about once, in chunks; the windows that come back are slices of them. Rows are checked before
    that, and samples are counted as they are written.
    """
    scfg = scfg or SequenceConfig()
    prepared = files.read_panel(spark, prepared_path)
    with temporary(spark):
        table, names, params = model_table(prepared, spec, fcfg, pinned=True)
        broken = {r["split"]: r["bad_value"] for r in sequences.unusable_steps(table, names).collect() if r["bad_value"]}
        if broken:
            raise ValueError(f"sample integrity violated: rows with null or infinite features {broken}")
        counted = Observation("samples")
        checks = [e.alias(n) for n, e in sequences.chunk_counts(scfg).items()]
        files.write_by_split(sequences.sample_chunks(table, spec, scfg, names).observe(counted, *checks), out_path)
        allowed = {"n_windows"} if scfg.filter_missing_targets else {"n_windows", "unobserved_target"}
        if problems := {n: k for n, k in counted.get.items() if k and n not in allowed}:
            raise ValueError(f"sample integrity violated: {problems}")
        files.save_params(spark, params, params_path)
    return Samples(sequences.read_samples(files.read_panel(spark, out_path), spec, scfg), names, params)
