"""Every query against its SQL on the smallest data set."""

import re

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_only_these_have_no_sql():
    own = {name for name in queries() if not re.match(r"op\d+_|pipeline$", name)}
    assert own - set(oracle_sql()) == ROWS_ONLY and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    problem, *_ = compare(spark, con, name, queries()[name], oracle_sql()[name], SF)
    assert problem is None, problem


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["host", "cnt_distinct_hosts", "cnt_logs", "fqdn_norm"] and df.count() > 0


def test_rows_only_queries_agree_with_the_helper_on_one_series(spark):
    """The detection of a stored series equals the plain functions applied to it."""
    import numpy as np

    from flowloom.operators import periodicity, series, spectral
    from flowloom.plans.queries.bindings import Tables

    day_series = series.build_series(Tables(spark, SF).web()).where("ts_cnt > 2").limit(20).collect()
    df = spark.createDataFrame([(str(r.day), r.host, r.tdf, r.ts_cnt) for r in day_series], "day string, host string, tdf array<int>, ts_cnt int")
    peaks = {(r.day, r.host): r.autocorr_peaks for r in periodicity.with_peaks(df).collect()}
    for r in df.collect():
        assert peaks[(r.day, r.host)] == spectral.acf_peaks(np.array(r.tdf)).tolist()
