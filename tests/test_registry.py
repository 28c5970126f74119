"""Every registered query with SQL equals DuckDB on the smallest tables; the rest returns rows."""

import os

import duckdb
import pytest

from apronlake.plans import registry

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(df):
    cells = df[sorted(df.columns)].astype(object).where(df.notna(), None).map(str)
    cells = cells.replace({r"\.0$": "", r" 00:00:00$": ""}, regex=True)
    return sorted(map(tuple, cells.values.tolist()))


#: One query a family always; all of them with ALL_QUERIES=1.
QUICK = ["delay_rate_by_hour", "chain", "asof_weather", "smoothed_rates", "roc_auc", "connection_risk", "request_validation", "interval_lookup", "day_typicality", "holiday_flags", "scalar_cleaning", "batch_features", "ml_feature_rows", "feature_guards", "landing_statuses", "conformed_csv", "rolling_mart", "canonical_positions", "staged_flights", "drilldown_ranking", "airports_reference"]


@pytest.mark.parametrize("name", sorted(registry.ORACLES) if os.environ.get("ALL_QUERIES") else QUICK)
def test_query_equals_sql(spark, sf_dir, duck, name):
    got, want = registry.QUERIES[name](spark, sf_dir).toPandas(), duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


def test_every_query_has_sql_or_is_a_fit():
    fits = {"model_report", "platt_scores", "family_report", "bundle_scores", "proxy_day_bundle", "isotonic_scores", "regressor_report"}
    assert set(registry.QUERIES) - set(registry.ORACLES) == fits


def test_entry_point_without_llm(monkeypatch):
    import builtins
    import importlib

    import __spark_entry__ as entry

    real = builtins.__import__

    def no_llm(name, *a, **k):
        if name == "corpus_pipeline" or name.startswith("apronlake.llm"):
            raise ImportError(name)
        return real(name, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(builtins, "__import__", no_llm)
        bare = importlib.reload(entry)
        assert set(bare.queries()) == set(registry.QUERIES)
    importlib.reload(entry)
