"""The compact sample store gives the same samples as windows built one by one."""

import pytest
from pyspark.sql import functions as F

from longspan.config import SequenceConfig
from longspan.operators import sequences
from longspan.sources import files
from registry.core import SPEC, model_ready


def told(df):
    cells = ["entity", "_pos", "input_start", "input_end", "target_time", "y", "y_scaled", "target_observed", "split", "x"]
    return df.select(*cells)


@pytest.mark.parametrize("cfg,chunk_rows", [
    (SequenceConfig(), 512), (SequenceConfig(lookback=7, horizon=3), 7), (SequenceConfig(lookback=5, boundary="isolated_partition"), 11),
    (SequenceConfig(lookback=4, filter_missing_targets=False), 64),
])
def test_chunks_hold_the_same_samples(spark, sf, cfg, chunk_rows):
    data, names = model_ready(spark, sf)
    names = names[:5]
    chunks = sequences.sample_chunks(data, SPEC, cfg, names, chunk_rows)
    want = sequences.keep_observed(sequences.candidate_windows(data, SPEC, cfg, names), cfg)
    got = sequences.read_samples(chunks, SPEC, cfg)
    assert got.count() == want.count() > 0
    assert told(got).exceptAll(told(want)).count() == 0
    counts = chunks.agg(*[e.alias(n) for n, e in sequences.chunk_counts(cfg).items()]).first().asDict()
    assert counts["n_windows"] == want.count() and counts["bad_length"] == 0 and counts["bad_target"] == 0


def test_broken_samples_are_counted(spark, sf):
    data, names = model_ready(spark, sf)
    cfg = SequenceConfig(lookback=5, filter_missing_targets=False)
    chunks = sequences.sample_chunks(data.withColumn("target", F.when(F.col("_pos") != 40, F.col("target"))), SPEC, cfg, names[:2])
    cut = chunks.withColumn("steps", F.slice("steps", F.lit(1), F.size("steps") - 1))
    counts = cut.agg(*[e.alias(n) for n, e in sequences.chunk_counts(cfg).items()]).first()
    assert counts["bad_target"] == data.where("_pos = 40 and _pos > 5").count() and counts["bad_length"] == chunks.count()
    with pytest.raises(ValueError, match="look-back"):
        sequences.sample_chunks(data, SPEC, cfg, names, 4)


def test_stored_bytes(spark, sf, tmp_path):
    """No more than 1.3 times the feature table's."""
    data, names = model_ready(spark, sf)
    table = data.select("entity", "d", "split", "target", "target_valid", "_pos", "_rows", "_split_pos", "_split_rows", *names)
    files.write_panel(table.repartition(1), str(tmp_path / "t"))
    files.write_by_split(sequences.sample_chunks(data, SPEC, SequenceConfig(), names).repartition(1), str(tmp_path / "s"))
    size = {d: sum(f.stat().st_size for f in (tmp_path / d).rglob("*.parquet")) for d in ("t", "s")}
    assert size["s"] <= 1.3 * size["t"], size
