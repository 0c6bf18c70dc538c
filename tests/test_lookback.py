"""Look-back pulls by day bitmaps against plain counting, and newest rows at equal times."""

import datetime as dt
import random

import pytest

from longspan.config import PanelSpec
from longspan.operators import catalogue

SPEC = PanelSpec(entity="e", time="d", measures=("v",), target="t", category="b", valid_flag="ok")
DAY0 = dt.date(1969, 11, 20)  # the days run over the start of the epoch


def day(n):
    return DAY0 + dt.timedelta(days=n)


def tables(spark, seed):
    rng = random.Random(seed)
    rows = [(e, day(n), float(n)) for e in "ab" for n in range(150) if rng.random() < (0.99 if e == "a" else 0.8)]
    rows += [rows[5], (None, day(1), 0.0), ("a", None, 0.0)]
    asked = [(e, day(n)) for e in ("a", "b", "c") for n in range(-5, 160, 3)] + [("a", day(40)), ("a", day(40)), (None, day(3)), ("a", None)]
    return rows, asked, spark.createDataFrame(rows, "e string, d date, v double"), spark.createDataFrame(asked, "e string, reference_date date")


@pytest.mark.parametrize("days", [1, 7, 30, 62, 70])
def test_like_plain_counting(spark, days):
    rows, asked, df, requests = tables(spark, days)
    have = {(e, d) for e, d, _ in rows if e and d}
    got = {(r.e, r.reference_date): (r.n_found, r.accepted) for r in catalogue.lookback_pull(requests, df, SPEC, days).collect()}
    want = {}
    for e, ref in set(asked):
        n = sum((e, ref - dt.timedelta(days=k)) in have for k in range(days)) if e and ref else 0
        want[e, ref] = (n, n == days)
    assert got == want
    pulled = sorted((r.e, r.reference_date, r.d, r.v) for r in catalogue.lookback_rows(requests, df, SPEC, days).collect())
    assert pulled == sorted((e, ref, d, v) for (e, ref), (_, ok) in want.items() if ok for x, d, v in rows
                            if x == e and d and 0 <= (ref - d).days < days)


def test_requests_are_not_copied_once_a_day(spark):
    """The days are no rows of the plan: a request is copied for each stretch it touches, two or three."""
    _, _, df, requests = tables(spark, 1)
    touched = catalogue._touched(requests.where("e = 'a' AND reference_date IS NOT NULL").distinct(), 30, 30)
    assert touched.groupBy("e", "reference_date").count().agg({"count": "max"}).first()[0] <= 2
    assert catalogue.lookback_pull(requests.limit(0), df, SPEC).count() == 0
    assert catalogue.lookback_rows(requests, df.limit(0), SPEC).count() == 0


def test_newest_of_equal_times(spark):
    rows = [("a", day(2), 1, "x"), ("a", day(2), 2, "b"), ("a", day(1), 9, "z"), ("b", None, 5, "q")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "e string, d date, v int, s string").repartition(3)
        got = {r.e: (r.d, r.v, r.s) for r in catalogue.latest_rows(df, "e", "d", ["v", "s"]).collect()}
        assert got == {"a": (day(2), 2, "b"), "b": (None, None, None)}
