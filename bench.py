"""Times the headline stages at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from longspan.config import SequenceConfig  # noqa: E402
from longspan.operators import explore, features, profile, sequences, split  # noqa: E402
from longspan.plans import stages  # noqa: E402
from longspan.session import pin, scratch_path  # noqa: E402
from longspan.sources import files  # noqa: E402
from registry.core import FEATURES, NUMERIC, SPEC, panel  # noqa: E402


def run(spark: SparkSession, sf: str) -> dict[str, float]:
    paths = {n: scratch_path(spark, n) for n in ("panel", "raw", "typed", "profile", "prepared", "params", "samples", "sample_params")}
    seconds: dict[str, float] = {}

    def timed(name, fn):
        start = time.perf_counter()
        out = fn()
        seconds[name] = round(time.perf_counter() - start, 3)
        return out

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    timed("panel_build", lambda: files.write_panel(panel(spark, sf), paths["panel"]))
    base = files.read_panel(spark, paths["panel"])
    base.select(*[F.col(c).cast("string") for c in SPEC.required]).write.option("header", True).csv(paths["raw"])
    timed("ingest", lambda: stages.ingest(spark, paths["raw"], paths["typed"], paths["profile"], SPEC))
    timed("profile_report", lambda: drain(profile.profile_report(base, SPEC)))
    timed("chronological_split", lambda: drain(split.assign_split(base, SPEC)))
    timed("split_and_fill", lambda: drain(stages.split_and_fill(base, SPEC)))
    timed("preprocess", lambda: stages.preprocess(spark, paths["panel"], paths["prepared"], paths["params"], SPEC))
    prepared = files.read_panel(spark, paths["prepared"])
    timed("features", lambda: drain(features.engineer(prepared, SPEC, FEATURES)))

    table, names, _ = timed("feature_table", lambda: stages.model_table(prepared, SPEC, FEATURES, pinned=True))
    timed("window_index", lambda: drain(sequences.candidate_windows(table, SPEC, SequenceConfig())))
    timed("build_samples", lambda: stages.build_samples(
        spark, paths["prepared"], paths["samples"], paths["sample_params"], SPEC, FEATURES))
    timed("numeric_summary", lambda: drain(profile.numeric_summary(base, NUMERIC)))
    timed("outlier_audit", lambda: drain(explore.outlier_audit(base, NUMERIC)))
    timed("entity_statistics", lambda: drain(explore.entity_statistics(base, SPEC)))
    timed("pearson_matrix", lambda: drain(explore.pearson_matrix(base, NUMERIC)))
    timed("spearman_matrix", lambda: drain(explore.spearman_matrix(base, SPEC, NUMERIC)))
    timed("explore_report", lambda: drain(explore.explore_report(base, SPEC)))
    return seconds


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = run(spark, sf)
    print(json.dumps({"metric": "total_stage_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
