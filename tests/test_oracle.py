"""Every registered query with SQL equals its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from oracle import connect, same
from small_tables import SF_SMALL

SQL = E.oracle_sql()
NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    same(E.queries()[name](spark, SF_SMALL), con, SQL[name])


CHUNKED = ["section_split", "first_k_non_null", "backcast_seed", "union_seed", "interpolate_linear",
           "forward_fill", "lag_columns", "lag_deltas", "diff_cumsum", "session_id", "impute_first_start",
           "session_age", "label_is_censored", "lookahead_1h", "lookahead_2h", "label_clean_ffill", "device_labels", "ordered_split",
           "walk_forward_folds", "roc_auc_score"]


@pytest.mark.parametrize("name", CHUNKED)
def test_query_matches_oracle_with_small_chunks(spark, con, small_chunks, name):
    same(E.queries()[name](spark, SF_SMALL), con, SQL[name])


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"user_id", "Datetime", "sensor_end_1h", "sensor_end_2h"} <= set(df.columns)


def test_every_query_is_registered_with_callable():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert all(callable(f) for f in qs.values())
