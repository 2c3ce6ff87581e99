"""What queries write on the way to their rows: copies of whole items must not grow with the number of items."""

import os

import pytest
from pyspark.sql import functions as F

from threadloom.operators import gather
from threadloom.plans import registry
from threadloom.sources import adapter, ingest

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(DATA), reason="needs the test tables")


@needs_data
def test_point_look_up_builds_no_archive(spark, monkeypatch):
    monkeypatch.setattr(registry.sinks, "write_shards", lambda *a: pytest.fail("all items are written for one look-up"))
    registry._SHARED.clear()
    every = {r.id: r for r in adapter.items(spark, DATA).collect()}
    for key in (1, 42, 97, 211, max(every), max(every) + 1, 0, -3):
        monkeypatch.setattr(registry, "_POINT", key)
        found = registry.queries()["flt7_point_lookup"](spark, DATA)
        assert found.collect() == [every[x] for x in every if x == key], key
        plan = found._jdf.queryExecution().toString()
        assert all(f"EqualTo({c}," in plan for c in ("event_id", "doc_id", "page_id")), plan


def test_latest_leaves_lines_where_they_are_read(spark, monkeypatch):
    import random

    random.seed(7)
    rows = []
    for n, file in enumerate(["b", "a", "c/1", "c/10", None]):
        ids = {*random.sample(range(-300, 9000), 1500), -(2**63), 2**63 - 1, n, -64 * n}
        rows += [(i, file, k, f"{file}{k}", n) for k, i in enumerate(ids)]
    one = spark.createDataFrame(rows, "id long, file string, place long, text string, score int").repartition(3)
    twice = one.union(spark.createDataFrame([(5, "c/1", 99_999, "x", 0), (5, "c/1", 99_998, "y", 0), (4000, "c/10", -1, "z", 0), (7, "d", 0, "d", 0), (2**63 - 1, "d", 5, "first", 0), (2**63 - 1, "d", 6, "last", 0)], one.schema))
    for lines in (one, twice, one.where("false")):
        best = {}
        for r in lines.collect():
            if r.id not in best or (r.file or "", r.place) > (best[r.id].file or "", best[r.id].place):
                best[r.id] = r
        want = sorted((r.id, r.text, r.score) for r in best.values())
        assert sorted(tuple(r) for r in ingest.latest(lines).collect()) == want
        with monkeypatch.context() as m:
            m.setattr(ingest, "MARKS_BYTES", 0)
            assert sorted(tuple(r) for r in ingest.latest(lines).collect()) == want
    text = ingest.latest(one.sparkSession.createDataFrame(rows, one.schema))
    text.collect()
    assert "Exchange hashpartitioning" not in text._jdf.queryExecution().executedPlan().toString()


def test_latest_tells_dumps_apart(spark, monkeypatch):
    import random

    random.seed(9)
    rows = [(random.randrange(-70, 200), random.choice(["a", "b", None]), k, f"x{k}", random.choice(["0", "1", "1.0", None])) for k in range(2000)]
    best = {}
    for r in rows:
        at = (r[4] or "", r[0])
        best[at] = max(best.get(at, r), r, key=lambda x: (x[1] or "", x[2]))
    want = sorted((r[0], r[3]) for r in best.values())
    lines = spark.createDataFrame(rows, "id long, file string, place long, text string, dump string").repartition(3)
    once = lines.where("place % 20 = 0").dropDuplicates(["id", "dump"])
    for size in (ingest.MARKS_BYTES, 0):
        monkeypatch.setattr(ingest, "MARKS_BYTES", size)
        assert sorted(map(tuple, ingest.latest(lines).collect())) == want
        assert ingest.latest(once).count() == once.count()


@needs_data
@pytest.mark.parametrize("repeated", [["events"], ["documents", "pages"]])
def test_ingest_returns_all_rows_of_repeated_ids(spark, tmp_path, repeated):
    """Keys of the test tables repeat: as whole copies of rows, and with other columns."""
    duckdb = pytest.importorskip("duckdb")
    from collections import Counter

    con = duckdb.connect()
    keys = {"documents": "doc_id", "pages": "page_id", "events": "event_id"}
    for name, key in keys.items():
        more = f"union all from t where {key} in (3, 4) union all from t where {key} = 4 union all select * replace ({key} - 30 as {key}) from t where {key} >= 30 and {key} < 45" if name in repeated else ""
        # events whose text and url there are: a table of repeated keys has fewer keys than rows
        only = "where (event_id + 1) % (select count(*) from documents) in (select doc_id from documents) and (event_id + 1) % (select count(*) from pages) in (select page_id from pages)" if name == "events" else ""
        con.sql(f"copy (with t as (from '{DATA}/{name}.parquet' {only}) from t {more}) to '{tmp_path}/{name}.parquet' (format parquet)")
        con.sql(f"create view {name} as from '{tmp_path}/{name}.parquet'")
    sql = con.sql(registry.oracle_sql()["src1_ingest_lines"])
    columns, want = sql.columns, sql.fetchall()
    assert len(set(want)) > len({r[0] for r in want})
    got = registry.queries()["src1_ingest_lines"](spark, str(tmp_path))
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(want)


@needs_data
def test_ordered_scan_deals_no_texts(spark, monkeypatch):
    want = sorted(map(tuple, adapter.items(spark, DATA).collect()))
    monkeypatch.setattr(adapter, "PART_ROWS", 100)
    scan = registry.queries()["src4_ordered_scan"](spark, DATA)
    parts = scan.withColumn("part", F.spark_partition_id()).collect()
    assert [tuple(r)[:-1] for r in parts] == want and [r.part for r in parts] == sorted(r.part for r in parts) and len({r.part for r in parts}) > 5
    plan = scan._jdf.queryExecution().optimizedPlan().toString().split("\n")
    dealt = next(k for k, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert any("text" in line for line in plan[:dealt]) and not any("text#" in line for line in plan[dealt:])


def test_gather_equals_a_left_join(spark, monkeypatch):
    import random

    random.seed(8)
    monkeypatch.setattr(gather, "GROUP_BYTES", 2000)
    keyed = [(random.choice([k, k - 5000, 77]), random.choice([None, "", "é" * (k % 50), "x" * (k % 700)])) for k in range(3000)] + [(None, "lost"), (2**63 - 1, "most"), (-(2**63), "least")]
    table = spark.createDataFrame(keyed, "k long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = gather.by_key(table, "k", "text", "keyed")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert all(a[1] <= b[0] for a, b in zip(files, files[1:], strict=False)) and len(files) > 1
    rows = [(i, random.choice([i, i % 40, -i, None, 10**12])) for i in range(2000)] + [(2000, 2**63 - 1), (2001, -(2**63)), (2002, 77), (2003, 0)]
    left = spark.createDataFrame(rows, "id long, key long").coalesce(1).sortWithinPartitions("id")
    want = sorted(map(repr, left.join(table.where("k is not null"), left.key == table.k, "left").select("id", "key", "text").collect()))
    for out in (gather.OUT_BYTES, 300):
        monkeypatch.setattr(gather, "OUT_BYTES", out)
        got = gather.gather(left, [("key", files, "text")]).collect()
        assert [r.id for r in got] == sorted(r.id for r in got) and sorted(map(repr, got)) == want
    assert [tuple(r) for r in gather.gather(left.where("id < 2"), [("key", [], "text")]).collect()] == [(*r, None) for r in rows[:2]]


@needs_data
def test_ordered_scan_where_python_cannot_read(spark, monkeypatch):
    def closed(path):
        raise ValueError("unrecognized filesystem")

    monkeypatch.setattr(gather, "_open", closed)
    texts = adapter.keyed_texts(spark, DATA)
    assert texts == {"url": None, "text": None}
    got = adapter.ordered_items(spark, DATA, texts).collect()
    assert got == sorted(adapter.items(spark, DATA).collect(), key=lambda r: r.id)
