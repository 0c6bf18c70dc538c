"""Validation, preprocessing and samples on small hand-made panels with the default column names."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from longspan.config import AIR_QUALITY_MEASURES, FeatureConfig, PanelSpec, SequenceConfig, SplitConfig
from longspan.functions.parsing import NULL_TOKENS, null_tokens, parse_date, parse_number, strip
from longspan.operators import features, fuzzy, impute, profile, scale, scenario, scoring, sequences, split, validate
from longspan.plans import stages
from longspan.sources import files

SPEC = PanelSpec()
COLUMNS = SPEC.required


def raw_rows():
    def row(city, day, value):
        return [city, day, *[value] * 12, "120", "Moderate"]
    return [row("Delhi", "2020-01-01", "10.5"), row("Delhi", "2020-01-02", "11"), row(" Bengaluru\t", "2020-01-01", "12")]


def raw(spark, rows, columns=COLUMNS):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def test_valid_input(spark):
    panel, report = validate.validate_raw(raw(spark, raw_rows()), SPEC)
    assert report.is_valid and report.n_rows == 3 and panel.columns == COLUMNS
    assert {r["City"] for r in panel.collect()} == {"Delhi", "Bengaluru"}
    rows = profile.profile_report(panel, SPEC, report, profile.Source("a/b.csv", 9)).collect()
    sections = {r["section"] for r in rows}
    assert {"dataset_shape", "temporal_span", "numeric_summary", "entity_profiles", "integrity_audit", "validation", "source"} <= sections
    told = {(r["section"], r["key"], r["metric"]): r["value"] for r in rows}
    assert told["validation", "", "is_valid"] == "true" and told["source", "", "name"] == "b.csv" and told["geography", "", "entity_count"] == "2"
    assert {(k, v) for (s, k, _), v in told.items() if s == "entities"} == {("Bengaluru", "Bengaluru"), ("Delhi", "Delhi")}
    assert told["integrity_audit", "invalid_dates|Date", "severity"] == "error"


def test_missing_and_unexpected_columns(spark):
    columns = ["extra" if c == "PM2.5" else c for c in COLUMNS]
    panel, report = validate.validate_raw(raw(spark, raw_rows(), columns), SPEC)
    assert panel is None and not report.is_valid
    assert report.count("missing_column") == {"PM2.5": 1} and report.count("unexpected_column") == {"extra": 1}


@pytest.mark.parametrize("column, values, check", [
    ("Date", ["invalid-date-format", "2020-02-30"], lambda r: r.count("invalid_dates") == {"Date": 2}),
    ("PM2.5", ["not_a_number"], lambda r: r.count("invalid_numbers") == {"PM2.5": 1}),
    ("NO2", ["12d"], lambda r: r.count("invalid_numbers") == {"NO2": 1}),
    ("City", ["  "], lambda r: r.count("empty_entities") == {"City": 1}),
])
def test_errors(spark, column, values, check):
    rows = raw_rows()
    for row, v in zip(rows, values):
        row[COLUMNS.index(column)] = v
    _, report = validate.validate_raw(raw(spark, rows), SPEC)
    assert not report.is_valid and check(report)


def test_warnings_keep_the_table_valid(spark):
    rows = raw_rows()
    rows[0][COLUMNS.index("PM10")] = "-15.0"
    rows[1][COLUMNS.index("AQI_Bucket")] = "Unknown"
    panel, report = validate.validate_raw(raw(spark, rows), SPEC)
    assert report.is_valid and report.count("negative_values") == {"PM10": 1} and report.count("invalid_categories") == {"AQI_Bucket": 1}
    assert panel.where("PM10 < 0").count() == 1


def test_duplicates(spark):
    def found(rows):
        _, report = validate.validate_raw(raw(spark, rows), SPEC)
        return report.count("duplicate_rows"), report.count("duplicate_keys"), report.is_valid

    rows = raw_rows()
    assert found([*rows, rows[0]]) == ({"*": 1}, {"City,Date": 1}, False)
    other = list(rows[0])
    other[2] = "99"
    assert found([*rows, other]) == ({}, {"City,Date": 1}, False)


def test_all_unexpected_categories_are_told(spark):
    rows = [[*r[:-1], f"odd {i:02d}"] for i, r in enumerate([["Delhi", f"2020-01-{d:02d}", *["1"] * 12, "120", ""] for d in range(1, 31)])]
    _, report = validate.validate_raw(raw(spark, rows), SPEC)
    assert all(f"odd {i:02d}" in report.fired("warning")[0] for i in range(30))


def test_very_many_unexpected_categories(spark):
    """The message names a bounded number of them, the outcome's table and the report have all."""
    cells = [F.lit("Delhi"), F.lit("2020-01-01"), *[F.lit("1")] * 13, F.concat(F.lit("odd "), F.col("id"))]
    df = spark.range(100_000).select(*[c.alias(n) for c, n in zip(cells, SPEC.required, strict=True)])
    _, found = validate.validate_raw(df, SPEC)
    message = next(m for m in found.fired("warning") if m.startswith("invalid_categories"))
    assert message.count("'odd ") == validate.NAMED_CATEGORIES and message.endswith(f"and {100_000 - validate.NAMED_CATEGORIES} more")
    assert found.unexpected.count() == 100_000
    from longspan.operators import profile
    assert profile.outcome_report(spark, found).where("section = 'unexpected_categories'").count() == 100_000


def test_parsing_rules(spark):
    texts = [*NULL_TOKENS, "1", " 2.5 ", "+.5", "3.", "1e3", "-Infinity", "INF", "1_000", "12d", "0x1", "nAn"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_number(null_tokens(F.col("t"))).alias("n"))
    got = {r["t"]: r["n"] for r in df.collect()}
    assert all(got[t] is None for t in [*NULL_TOKENS, "1_000", "12d", "0x1", "nAn"])
    assert [got[t] for t in ("1", " 2.5 ", "+.5", "3.", "1e3", "-Infinity", "INF")] == [1, 2.5, 0.5, 3, 1000, float("-inf"), float("inf")]
    days = ["2020-1-5", "2020-01-05", "2020-02-30", " 2020-01-05", "20200105", "2020-01-05x"]
    df = spark.createDataFrame([(t,) for t in days], "t string").select("t", parse_date(F.col("t")).cast("string").alias("d"))
    got = {r["t"]: r["d"] for r in df.collect()}
    assert [got[t] for t in days] == ["2020-01-05", "2020-01-05", None, None, None, None]
    assert spark.createDataFrame([("\t a b \n ",)], "t string").select(strip(F.col("t"))).first()[0] == "a b"


def test_ingest_writes_report_even_when_invalid(spark, tmp_path):
    path = tmp_path / "raw.csv"
    rows = raw_rows()
    rows[0][1] = "bad"
    path.write_text(",".join(COLUMNS) + "\n" + "\n".join(",".join(r) for r in rows))
    with pytest.raises(ValueError):
        stages.ingest(spark, str(path), str(tmp_path / "t"), str(tmp_path / "r"), SPEC)
    assert not (tmp_path / "t").exists()
    lines = [json.loads(x) for f in (tmp_path / "r").glob("*.json") for x in f.read_text().splitlines()]
    assert {"section": "integrity_audit", "key": "invalid_dates|Date", "metric": "n", "value": "1"} in lines


def test_ingest_round_trip(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(",".join(COLUMNS) + "\n" + "\n".join(",".join(r) for r in raw_rows()))
    for _ in range(2):
        report = stages.ingest(spark, str(path), str(tmp_path / "t"), str(tmp_path / "r"), SPEC)
        assert report.is_valid
    table = files.read_panel(spark, str(tmp_path / "t"))
    assert table.columns == COLUMNS and table.count() == 3 and dict(table.dtypes)["Date"] == "date"
    assert stages.explore_panel(spark, str(tmp_path / "t"), str(tmp_path / "e"), SPEC).count() > 100


def test_raw_text_is_parsed_once_and_line_breaks_are_read(spark, tmp_path):
    rows = raw_rows()
    path = tmp_path / "raw.csv"
    path.write_text(",".join(COLUMNS) + "\n" + "\n".join(",".join(['"Del\nhi"', *r[1:]]) for r in rows[:2]))
    report = stages.ingest(spark, str(path), str(tmp_path / "t"), str(tmp_path / "r"), SPEC, multi_line=True)
    assert report.is_valid and files.read_panel(spark, str(tmp_path / "t")).first()["City"] == "Del\nhi"


def test_columns_are_matched_by_header(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.csv").write_text("e,d\nA,1\n")
    (folder / "b.csv").write_text("d,e\n2,B\n3,C\n")
    got = {tuple(r) for r in files.read_raw_csv(spark, str(folder)).select("e", "d").collect()}
    assert got == {("A", "1"), ("B", "2"), ("C", "3")}
    (folder / "c.csv").write_text("d,x\n2,B\n")
    with pytest.raises(ValueError, match="different columns"):
        files.read_raw_csv(spark, str(folder))


def test_missing_and_empty_files(spark, tmp_path):
    for read in (files.read_raw_csv, files.read_panel, files.load_params):
        with pytest.raises(FileNotFoundError):
            read(spark, str(tmp_path / "nothing"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        files.read_raw_csv(spark, str(tmp_path / "empty.csv"))


P = PanelSpec(entity="e", time="d", measures=("a",), target="y", category="k", valid_flag="ok")


def panel(spark, values, targets=None, entity="A"):
    rows = [(entity, i, v, None if targets is None and v is None else (targets[i] if targets else 100.0)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "e string, i int, a double, y double")
    return df.select("e", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i")).alias("d"), "a", "y", F.lit("Good").alias("k"))


@pytest.mark.parametrize("n, sizes", [(2009, (1406, 301, 302)), (1679, (1175, 251, 253)), (113, (79, 16, 18)), (1, (0, 0, 1))])
def test_split_sizes(spark, n, sizes):
    out = split.assign_split(panel(spark, [1.0] * n), P)
    counts = {r["split"]: r["n_rows"] for r in split.overall_ranges(out, P).collect()}
    assert tuple(counts.get(s, 0) for s in ("train", "val", "test")) == sizes
    assert split.temporal_leaks(out, P).count() == 0 and split.shared_keys(out, P).count() == 0


def test_split_arithmetic_equals_python(spark):
    got = spark.range(3000).select("id", F.floor(F.col("id").cast("double") * F.lit(0.7)).alias("t"), F.floor(F.col("id").cast("double") * F.lit(0.15)).alias("v")).collect()
    assert all(r["t"] == int(r["id"] * 0.7) and r["v"] == int(r["id"] * 0.15) for r in got)


def test_split_ratios_are_checked():
    for bad in ({"train": 0.9}, {"train": 0.85, "val": 0.15}, {"train": 0.0}, {"val": -0.1}):
        with pytest.raises(ValueError):
            SplitConfig(**bad)


def test_fill_stays_inside_the_entity_and_uses_train_medians(spark):
    a = panel(spark, [10.0, 20.0, 30.0, None, None, 999.0, None, 7.0, None, 3000.0])
    b = panel(spark, [None, 25.0, None, 40.0, 50.0, 60.0, 70.0, 80.0, 90.0, None], entity="B")
    done = stages.impute_and_scale(stages.split_and_fill(a.unionByName(b), P), P)
    rows = {(r["e"], r["d"].day): r for r in done.table.collect()}
    train = [10, 20, 30, 30, 30, 999, 999, 25, 25, 40, 50, 60, 70]
    median = sorted(train)[len(train) // 2]
    assert done.params["a"].median == median and rows["B", 1]["a"] == median
    assert rows["A", 7]["a"] == 999 and rows["A", 9]["a"] == median  # test starts at day 9 and inherits nothing
    full = [*train, median]
    mean = sum(full) / len(full)
    variance = sum((v - mean) ** 2 for v in full) / len(full)
    assert done.params["a"].mean == pytest.approx(mean) and done.params["a"].variance == pytest.approx(variance)
    assert done.params["a"].min == 10 and done.params["a"].max == 999


def test_column_without_values(spark):
    done = stages.impute_and_scale(stages.split_and_fill(panel(spark, [None] * 10, [100.0] * 10), P), P)
    assert done.params["a"].median == 0.0 and done.params["a"].scale == 1.0 and done.params["y"].scale == 1.0
    assert {(r["a"], r["scaled_a"], r["scaled_y"]) for r in done.table.collect()} == {(0.0, 0.0, 0.0)}


def test_scaler_ignores_later_splits(spark):
    base = [float(i % 7) for i in range(70)]
    one = stages.impute_and_scale(stages.split_and_fill(panel(spark, base + [50.0] * 15 + [500.0] * 15), P), P)
    two = stages.impute_and_scale(stages.split_and_fill(panel(spark, base + [1.0] * 30), P), P)
    assert one.params["a"] == two.params["a"]
    assert one.table.where("split = 'test'").agg(F.avg("scaled_a")).first()[0] > 200


def test_validity_flag_survives(spark):
    done = stages.impute_and_scale(stages.split_and_fill(panel(spark, [1.0] * 6, [100.0, None, 120.0, None, 140.0, 150.0]), P), P)
    assert [r["ok"] for r in done.table.orderBy("d").collect()] == [True, False, True, False, True, True]


def test_strict_validation_rejects(spark):
    with pytest.raises(ValueError, match="infinite"):
        validate.validate_strict(panel(spark, [1.0, float("inf")]), P)
    text = panel(spark, [1.0]).withColumn("a", F.lit("x"))
    with pytest.raises(ValueError, match="non-numeric"):
        validate.validate_strict(text, P)
    with pytest.raises(ValueError, match="dates"):
        validate.validate_strict(panel(spark, [1.0]).withColumn("d", F.lit("2020-02-30")), P)
    with pytest.raises(ValueError, match="missing required"):
        validate.validate_strict(panel(spark, [1.0]).drop("a"), P)


def test_remaining_nulls_are_an_error(spark):
    with pytest.raises(ValueError):
        impute.require_complete(panel(spark, [None, 1.0], [1.0, 1.0]).withColumn("split", F.lit("train")), ["a"])


# Fixed values, taken over from the published fixture of this problem: per entity the start and step of the measures and of the target,
# the unobserved rows, the scales, and with them the anchors below.
RAMPS = (("CityA", 10.0, 1.0, 100.0, 2.0), ("CityB", 50.0, 0.5, 200.0, 1.5))
UNOBSERVED = ("CityA", (10, 35))
MEASURE_SCALE, TARGET_SCALE = (25, 10), (140, 20)


def forty(spark):
    rows = []
    for e, base, step, target, tstep in RAMPS:
        for i in range(40):
            rows.append((e, i, base + i * step, target + i * tstep, not (e == UNOBSERVED[0] and i in UNOBSERVED[1])))
    df = spark.createDataFrame(rows, "City string, i int, v double, AQI double, aqi_target_valid boolean")
    cols = [F.col("v").alias(m) for m in AIR_QUALITY_MEASURES]
    scaled = [((F.col("v") - MEASURE_SCALE[0]) / MEASURE_SCALE[1]).alias(f"scaled_{m}") for m in AIR_QUALITY_MEASURES]
    df = df.select("City", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i")).alias("Date"), "i", *cols, "AQI", "aqi_target_valid",
                   *scaled, ((F.col("AQI") - TARGET_SCALE[0]) / TARGET_SCALE[1]).alias("scaled_AQI"))
    from longspan.operators.ordering import with_position
    df = with_position(df, SPEC)
    return df.withColumns({"split": F.lit("train"), "_split_pos": F.col("_pos"), "_split_rows": F.col("_rows")})


def test_feature_anchors(spark):
    out = features.engineer(forty(spark), SPEC, FeatureConfig())
    a = {r["i"]: r for r in out.where("City = 'CityA'").collect()}
    b = {r["i"]: r for r in out.where("City = 'CityB'").collect()}
    assert [a[i]["PM2.5_lag_1"] for i in (0, 1, 5)] == [10, 10, 14] and a[5]["PM2.5_lag_3"] == 12
    assert [b[i]["PM2.5_lag_1"] for i in (0, 1)] == [50, 50]
    assert [a[i]["AQI_roll_mean_3"] for i in (2, 3)] == [102, 104]
    assert (a[6]["AQI_roll_min_7"], a[6]["AQI_roll_max_7"]) == (100, 112) and a[0]["AQI_roll_std_7"] == 0.0
    for n in ("day_of_week", "month", "day_of_year", "season"):
        assert all(r[f"{n}_sin"] ** 2 + r[f"{n}_cos"] ** 2 == pytest.approx(1) for r in a.values())
    names = features.feature_names(SPEC, FeatureConfig())
    assert {k: len(v) for k, v in names.items()} == {"calendar": 8, "lag": 12, "rolling": 28, "roc": 15, "volatility": 6}
    model = features.model_features(SPEC, FeatureConfig(), out.columns)
    assert len(model) == 82 and model[0] == "scaled_PM2.5" and model[12] == "scaled_AQI" and model[13] == "day_of_week_sin"
    assert not {"City", "Date", "AQI", "AQI_Bucket", "aqi_target_valid", "split"} & set(model)


def test_nulls_in_lagged_columns_are_an_error(spark):
    gap = forty(spark).withColumn("CO", F.when(F.col("i") != 4, F.col("CO")))
    with pytest.raises(Exception, match="anchored_lag"):
        features.engineer(gap, SPEC, FeatureConfig()).collect()


def test_missing_scores_keep_their_place(spark):
    df = forty(spark).withColumns({"gamma": F.lit(1.0), "score": F.when(F.col("i") % 2 == 0, F.lit(2.0))})
    got = fuzzy.attention_weights(df, SPEC, "score", lookback=3).where("City = 'CityA'").orderBy("Date").collect()
    assert [len(r["weights"]) for r in got] == [3] * 38
    assert got[0]["weights"] == pytest.approx([0.5, 0.0, 0.5]) and got[1]["weights"] == pytest.approx([0.0, 1.0, 0.0])


def test_stages_leave_nothing_behind(spark, tmp_path):
    from longspan.session import shared_dir
    folder = Path(shared_dir(spark).removeprefix("file:")) / "longspan"
    before = set(folder.glob("*")) if folder.exists() else set()
    files.write_panel(panel(spark, [float(i % 9) for i in range(60)]), str(tmp_path / "t"))
    stages.preprocess(spark, str(tmp_path / "t"), str(tmp_path / "p"), str(tmp_path / "q"), P)
    one = FeatureConfig.of(("a",), ("a",), ("a",), ("a",))
    done = stages.build_samples(spark, str(tmp_path / "p"), str(tmp_path / "s"), str(tmp_path / "u"), P, one, SequenceConfig(lookback=5))
    assert done.windows.count() > 0 and (set(folder.glob("*")) if folder.exists() else set()) == before


def test_cluster_needs_a_shared_folder(monkeypatch):
    from longspan import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def scans(df):
    """Table scans of a plan, shuffles that are used again counted once."""
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_reports_read_the_panel_few_times(spark, tmp_path):
    files.write_panel(panel(spark, [float(i % 9) for i in range(60)]), str(tmp_path / "t"))
    table = files.read_panel(spark, str(tmp_path / "t"))
    raw_panel = pin_text(spark, table)
    assert scans(validate.check_counts(raw_panel, P)) == 1
    from longspan.operators import explore
    assert scans(explore.duplicate_summary(table, P)) == 0  # counted before it returns, by signatures


def pin_text(spark, table):
    from longspan.session import pin
    return pin(table.select(*[F.col(c).cast("string").alias(c) for c in table.columns]))


def test_later_rows_change_nothing(spark):
    base = forty(spark)
    changed = base.withColumns({c: F.when(F.col("i") == 35, 10000.0).otherwise(F.col(f"`{c}`")) for c in SPEC.numeric})
    keep = ["City", "i", *[f"`{c}`" for c in features.continuous_names(SPEC, FeatureConfig())]]
    one, two = (features.engineer(d, SPEC, FeatureConfig()).where("i <= 34").select(keep) for d in (base, changed))
    assert one.exceptAll(two).count() == 0


def test_windows_of_forty_rows(spark):
    names = [f"scaled_{m}" for m in AIR_QUALITY_MEASURES]
    cfg = SequenceConfig()
    windows = sequences.candidate_windows(forty(spark), SPEC, cfg, names).where("City = 'CityA'").cache()
    counts = sequences.window_counts(windows, cfg).first()
    assert (counts["candidates"], counts["skipped"], counts["kept"]) == (10, 1, 9)
    first = windows.orderBy("input_end").first()
    assert first["y"] == 160.0 and str(first["target_time"]) == "2020-01-31" and str(first["input_start"]) == "2020-01-01"
    assert len(first["x"]) == 30 and len(first["x"][0]) == 12 and first["x"][29][0] == pytest.approx(1.4)
    kept = sequences.keep_observed(windows, cfg)
    row = sequences.integrity(kept, cfg, 12).first()
    assert all(row[c] == 0 for c in row.asDict() if c != "split")
    summed = sequences.keep_observed(sequences.candidate_windows(forty(spark), SPEC, cfg, names, ["scaled_PM2.5"]).where("City = 'CityA'"), cfg)
    flat = sequences.flatten_samples(summed).orderBy("input_end").first()["flat"]
    assert sequences.unusable_steps(forty(spark), names).first()["bad_value"] == 0
    odd = forty(spark).withColumn("scaled_CO", F.when(F.col("i") == 3, F.lit(float("inf"))).otherwise(F.col("scaled_CO")))
    assert sequences.unusable_steps(odd, names).first()["bad_value"] == 2
    assert len(flat) == 30 * 12 + 8 and flat[-8:-4] == pytest.approx([1.1, 0.216025, 0.8, 1.4], abs=1e-5)
    assert sequences.candidate_windows(forty(spark), SPEC, SequenceConfig(lookback=40)).count() == 0


def test_parameters_round_trip(spark, tmp_path):
    done = stages.impute_and_scale(stages.split_and_fill(panel(spark, [1.0, None, 3.0, 4.0] * 5), P), P)
    files.save_params(spark, done.params, str(tmp_path / "p"))
    assert files.load_params(spark, str(tmp_path / "p")) == done.params


def test_metrics(spark):
    rows = [("m", 10.0, 12.0), ("m", 60.0, 40.0), ("m", 450.0, 430.0), ("m", 0.0, 1.0)]
    scored = spark.createDataFrame(rows, "model string, actual double, prediction double")
    got = scoring.regression_metrics(scored).first()
    assert got["rmse"] == pytest.approx((805 / 4) ** 0.5) and got["mae"] == pytest.approx(43 / 4)
    assert got["mape"] == pytest.approx(100 * (0.2 + 20 / 60 + 20 / 450) / 3)
    assert scoring.huber_loss(scored).first()["huber"] == pytest.approx((1.5 + 19.5 + 19.5 + 0.5) / 4)
    from longspan.operators.catalogue import hazard_band
    named = scored.withColumns({"actual_category": hazard_band(F.col("actual")), "predicted_category": hazard_band(F.col("prediction"))})
    c = scoring.category_metrics(named).first()
    assert c["accuracy"] == 0.75 and c["severe_recall"] == 1.0 and c["macro_recall"] == pytest.approx((1 + 0 + 1) / 3)


def test_fuzzy_sets(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.2,), (0.375,), (0.35,), (5.0,), (None,)], "composite_roc double")
    got = fuzzy.multiplier(fuzzy.memberships(df)).collect()
    assert got[0]["stable"] == 1.0 and got[0]["gamma"] == pytest.approx(0.7, abs=0.01)
    assert got[1]["moderate"] == pytest.approx(0.5) and got[2]["moderate"] == 1.0 and got[3]["moderate"] == pytest.approx(0.5)
    assert got[4]["surge"] == 0.5 and got[5]["gamma"] == pytest.approx(2.0) and got[6]["gamma"] is None


def test_scenarios_keep_missing_values(spark):
    df = spark.createDataFrame([(10.0,), (None,)], "a double")
    got = scenario.perturb(df, {"cut": {"a": -30.0}, "stop": {"a": -150.0}}).orderBy("scenario", "a").collect()
    assert [(r["scenario"], r["a"]) for r in got] == [("cut", None), ("cut", 7.0), ("stop", None), ("stop", 0.0)]


def test_robust_and_minmax(spark):
    df = spark.createDataFrame([(float(v), 3.0) for v in (1, 2, 3, 4, 9)], "a double, same double")
    assert scale.fit_robust(df, ["a", "same"]) == {"a": (3.0, 2.0), "same": (3.0, 1.0)}
    assert scale.fit_minmax(df, ["a", "same"]) == {"a": (1.0, 8.0), "same": (3.0, 1.0)}


def test_repository_has_no_data():
    root = Path(__file__).resolve().parents[1]
    assert not [p for p in root.rglob("*.parquet") if ".git" not in p.parts]
