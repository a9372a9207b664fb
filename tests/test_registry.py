"""A sample of the registered queries against their SQL; ``check.py`` runs all of them."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, table

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ["flagship_city_index", "e2_e5_overall_index", "p5_duplicate_columns", "p14_fill_global", "p15_interpolate", "p18_dedupe_ts",
          "f8_sample_strat", "w6_forecast_frame", "w9_serve_features", "w10_serve_sequence", "a6_downsample", "a12_kde", "a14_box_by_label",
          "m23_mismatch", "m26_m29_evaluate", "m5_city_holdout", "m12_knn", "j6_city_mentions", "x4_polarity", "t7_bad_air_sessions"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return c


def test_names():
    assert set(oracle_sql()) <= set(queries())
    assert set(SAMPLE) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() == 5


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, FOLDER)
    cur = con.execute(oracle_sql()[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([c[0] for c in cur.description], cur.fetchall())
