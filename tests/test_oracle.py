"""Every registered query against its DuckDB oracle on the smallest fixture."""
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from rillet.plans.catalog import QUERIES as CATALOG  # noqa: E402
from rillet.plans.streams import QUERIES as STREAMS
from rillet.plans.tables import QUERIES as STATEMENTS
from rillet.sources.fixtures import TABLES

SF = "/root/testdata/sf0.001"


def _norm(df: pd.DataFrame):
    cols = sorted(df.columns)

    def v(x):
        if x is None or (isinstance(x, float) and math.isnan(x)) or (not isinstance(x, (list, dict)) and pd.isna(x)):
            return "NULL"
        if isinstance(x, float):
            return f"{x:.6f}"
        if hasattr(x, "isoformat"):
            return pd.Timestamp(x).isoformat()
        return str(x)
    return sorted(tuple(v(x) for x in r) for r in df[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_documented():
    missing = set(CATALOG | STATEMENTS | STREAMS) - set(E.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(CATALOG | STATEMENTS | STREAMS))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _norm(got) == _norm(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.fixture()
def sliced(spark, monkeypatch):
    """Slices that hold some thirty rows of a hot key at most."""
    from rillet.operators import scan
    monkeypatch.setattr(scan, "ROWS_PER_TASK", 30)
    return spark


SLICED = ["session_count", "over_running_sum", "over_running_count", "flagged_withdrawals", "dual_window_flags",
          "dual_window_flags_joined", "latest_values_union", "temporal_join", "changelog_view", "classify_risk",
          "match_failed3", "match_failed_then_success", "match_escalating"]


@pytest.mark.parametrize("name", SLICED)
def test_sliced_plan_matches_oracle(sliced, con, name):
    df = E.queries()[name](sliced, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan
    assert _norm(df.toPandas()) == _norm(con.execute(E.oracle_sql()[name]).df())


def test_every_query_returns_rows_at_sf001(spark):
    """An empty result would compare equal to an empty oracle; every query must
    produce rows on the sf0.01 fixture."""
    empty = [n for n, fn in CATALOG.items() if fn(spark, "/root/testdata/sf0.01").limit(1).count() == 0]
    assert empty == []
