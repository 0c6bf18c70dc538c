"""Block sizes and bucket widths bound task size; they must never change a result."""

from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from longspan.config import FeatureConfig, PanelSpec, SequenceConfig
from longspan.operators import features, impute, sequences, split, validate
from longspan.operators.ordering import with_blocks, with_position

SPEC = PanelSpec(entity="e", time="d", measures=("a", "b"), target="y", category="k", valid_flag="ok")
SMALL = replace(SPEC, bucket_days=3, block_rows=16)
FEATURES = FeatureConfig.of(lags=("a", "y"), rolling=("a", "y"), change=("a", "b"), volatility=("a",))


@pytest.fixture(scope="module")
def rows(spark):
    """One entity holding most rows, one short, one with irregular days."""
    out = []
    for e, n, step in (("long", 150, 1), ("gappy", 60, 5), ("short", 4, 1)):
        for i in range(n):
            day = pd.Timestamp("2020-01-01") + pd.Timedelta(days=i * step + (i % 3 if step > 1 else 0))
            out.append((e, day.date(), None if i % 7 in (0, 1) or 40 <= i < 90 else float((i * 37) % 101),
                        float(i) if i % 5 else None, None if i % 4 == 1 else float((i * 53) % 97), "Good"))
    return spark.createDataFrame(out, "e string, d date, a double, b double, y double, k string").repartition(5).cache()


def collected(df, columns=("e", "d")):
    pdf = df.toPandas()
    return pdf.sort_values(list(columns)).reset_index(drop=True)[sorted(pdf.columns)]


def both(fn):
    return collected(fn(SPEC)), collected(fn(SMALL))


def test_positions_do_not_depend_on_buckets(rows):
    wide, narrow = both(lambda s: with_position(rows, s))
    pd.testing.assert_frame_equal(wide, narrow)
    long = wide[wide.e == "long"]
    assert list(long["_pos"]) == list(range(1, 151)) and set(long["_rows"]) == {150}


def filled(rows, s):
    return impute.forward_fill(split.assign_split(validate.flag_target(rows, s), s), s)


def test_forward_fill_carries_across_blocks(rows):
    wide, narrow = both(lambda s: filled(rows, s))
    pd.testing.assert_frame_equal(wide, narrow)
    expected = collected(split.assign_split(rows, SPEC))
    expected["a"] = expected.groupby(["e", "split"])["a"].ffill()
    pd.testing.assert_series_equal(wide["a"], expected["a"])


def test_interpolation_matches_across_blocks(rows):
    wide, narrow = both(lambda s: impute.interpolate(split.assign_split(rows, s), s, ["a", "b"]))
    pd.testing.assert_frame_equal(wide, narrow)


def complete(rows, s):
    return impute.fill_constants(filled(rows, s), {"a": 50.0, "b": 30.0, "y": 48.0})


def test_features_match_across_blocks(rows):
    wide, narrow = both(lambda s: features.engineer(complete(rows, s), s, FEATURES))
    pd.testing.assert_frame_equal(wide, narrow)


def test_features_match_pandas(rows):
    got = collected(features.engineer(complete(rows, SMALL), SMALL, FEATURES))
    base = collected(complete(rows, SMALL))
    g = base.groupby(["e", "split"])
    for k in (1, 3, 7):
        want = g["a"].transform(lambda s: s.shift(k).bfill())
        pd.testing.assert_series_equal(got[f"a_lag_{k}"], want, check_names=False)
    for w in (7, 14):
        want = g["y"].transform(lambda s: s.rolling(w, min_periods=1).std().fillna(0.0))
        pd.testing.assert_series_equal(got[f"y_roll_std_{w}"], want, check_names=False, atol=1e-9)
    want = g["y"].transform(lambda s: s.rolling(14, min_periods=1).mean())
    pd.testing.assert_series_equal(got["y_roll_mean_14"], want, check_names=False)


def test_lag_with_nulls_matches_shift_and_backfill(rows):
    base = collected(split.assign_split(rows, SMALL))
    for k in (1, 3, 7):
        got = collected(features.anchored_lag(split.assign_split(rows, SMALL), SMALL, "a", k))
        want = base.groupby(["e", "split"])["a"].transform(lambda s: s.shift(k).bfill())
        pd.testing.assert_series_equal(got[f"a_lag_{k}"], want, check_names=False)


@pytest.mark.parametrize("mode", ["continuous_history", "isolated_partition"])
def test_windows_match_across_blocks(rows, mode):
    cfg = SequenceConfig(lookback=10, horizon=2, boundary=mode)

    def build(s):
        table = complete(rows, s).withColumn("scaled_y", F.col("y") / 10)
        return sequences.candidate_windows(table, s, cfg, ["a", "b"])

    wide, narrow = (collected(build(s), ("e", "input_end")) for s in (SPEC, SMALL))
    assert len(wide) > 0
    pd.testing.assert_frame_equal(wide.drop(columns="x"), narrow.drop(columns="x"))
    assert [[list(v) for v in x] for x in wide["x"]] == [[list(v) for v in x] for x in narrow["x"]]


def test_no_window_group_exceeds_a_block(rows):
    blocks = with_blocks(with_position(rows, SMALL), SMALL, back=9, ahead=2)
    assert blocks.groupBy("e", "_block").count().agg(F.max("count")).first()[0] <= SMALL.block_rows + 9 + 2


def test_block_must_exceed_reach(rows):
    with pytest.raises(ValueError):
        with_blocks(with_position(rows, SMALL), SMALL, back=16)


def test_rows_without_a_time_are_spread(spark):
    rows = spark.createDataFrame([("x", None, float(i)) for i in range(500)] + [("x", 5, 0.0)], "e string, n int, a double")
    df = rows.select("e", F.date_add(F.lit("2020-01-01").cast("date"), F.col("n")).alias("d"), "a", F.lit(1.0).alias("b"), F.lit(1.0).alias("y"))
    from longspan.operators.ordering import time_bucket
    buckets = df.select(time_bucket(df, SMALL).alias("t")).groupBy("t").count()
    assert buckets.agg(F.max("count")).first()[0] < 50
    placed = with_position(df, SMALL)
    assert sorted(r["_pos"] for r in placed.collect()) == list(range(1, 502)) and placed.where("d is not null").first()["_pos"] == 1
