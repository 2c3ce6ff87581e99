"""The driver contract, and each query against its SQL on the smallest test data."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FAST = ["uiq1_stories_per_author", "usr1_user_stats", "usr2_user_domains", "g1_user_growth", "man1_manifest", "edge_children", "joi5_cross_links", "crs2_compressed_rows", "gra1_story_of_item", "cc_components", "sco_edge_scores", "relc_component_index", "src1_ingest_lines", "prj_scalar_functions", "inc1_incremental_counts"]


def rows(frame: pd.DataFrame) -> list:
    def value(x):
        if x is None or x is pd.NA or x is pd.NaT or x != x:
            return None
        if isinstance(x, float):  # a column of integers with nulls arrives as floats
            return int(x) if x == int(x) else round(x, 6)
        return int(x) if hasattr(x, "item") and float(x) == int(x) else x

    return sorted((tuple(map(value, r)) for r in frame[sorted(frame.columns)].itertuples(index=False)), key=repr)


@pytest.mark.skipif(not os.path.exists(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = entry.queries()[name](spark, DATA).toPandas(), con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert not any(n.startswith("op") or n == "pipeline" for n in entry.registry.queries())


@pytest.mark.skipif(not os.path.exists(DATA), reason="needs the test tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
