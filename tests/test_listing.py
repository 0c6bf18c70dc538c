"""Pages of a sorted copy against plain sorting, and the files that a page reads."""

import datetime as dt
import random

import pytest

from longspan.operators import catalogue
from longspan.sources.listing import write_listing


def rows(seed=1, n=600):
    rng = random.Random(seed)
    out = [(rng.choice(["a", "b", "cé", "", None]), dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(90)), k) for k in range(n)]
    return [(e, None if k % 50 == 0 else d, k) for e, d, k in out]


def key(r):
    return tuple((v is not None, v if v is not None else 0) for v in r)


ORDER = ["e", "d", "k"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    df = spark.createDataFrame(rows(), "e string, d date, k int").repartition(5)
    return df, write_listing(df, ORDER, str(tmp_path_factory.mktemp("listing") / "x"), files=12)


def test_pages_by_offset(spark, stored):
    _, listing = stored
    want = sorted(rows(), key=key)
    for offset, size in ((0, 10), (95, 30), (590, 50), (600, 5), (0, 700)):
        assert [tuple(r) for r in listing.page(spark, size, offset).collect()] == want[offset:offset + size]


def test_pages_by_key(spark, stored):
    df, listing = stored
    want = sorted(rows(), key=key)
    for at in (0, 3, 117, 118, 300, 598, 599):
        got = [tuple(r) for r in listing.page(spark, 25, after=want[at]).collect()]
        assert got == want[at + 1:at + 26]
        assert [tuple(r) for r in catalogue.page(df, ORDER, 25, after=want[at]).collect()] == got
    assert [tuple(r) for r in listing.page(spark, 5, offset=7, after=want[40]).collect()] == want[48:53]
    assert [tuple(r) for r in listing.page(spark, 4, after=("b", None, -1)).collect()] == [r for r in want if key(r) > key(("b", None, -1))][:4]


def test_a_page_reads_one_or_two_files(spark, stored):
    _, listing = stored
    want = sorted(rows(), key=key)
    for at in (10, 250, 500):
        assert 1 <= len(listing.page(spark, 5, after=want[at]).inputFiles()) <= 2
        assert 1 <= len(listing.page(spark, 5, offset=at).inputFiles()) <= 2
    assert len(spark.read.parquet(f"{listing.path}/rows").inputFiles()) > 6


def test_the_key_is_pushed_down(spark, stored):
    _, listing = stored
    rows_ = spark.read.parquet(f"{listing.path}/rows")
    plan = catalogue.page(rows_, ORDER, 5, after=("b", dt.date(2021, 2, 1), 3))._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = next(x for x in plan.splitlines() if x.startswith("PushedFilters"))
    assert "GreaterThan(e,b)" in pushed and "GreaterThan(d,2021-02-01)" in pushed and "GreaterThan(k,3)" in pushed, pushed


def test_empty_and_wrong_keys(spark, stored, tmp_path):
    df, listing = stored
    empty = write_listing(df.limit(0), ORDER, str(tmp_path / "none"))
    assert empty.page(spark, 5).count() == 0 and empty.page(spark, 5, after=("a", None, 1)).count() == 0
    with pytest.raises(ValueError, match="values"):
        listing.page(spark, 5, after=("a",))
