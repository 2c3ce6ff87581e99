"""Sinks, host calls and the whole build on a small set of items."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from threadloom.operators import related, shard, users
from threadloom.plans.api import Database
from threadloom.plans.build import Build
from threadloom.sources import sinks
from threadloom.streaming import incremental


def test_packed_cross_round_trip():
    rows = [(7, [1, 3]), (2, [0]), (9, [])]
    packed = sinks.pack_cross(rows, 4)
    assert packed[:4] == b"CSHX" and sinks.unpack_cross(packed) == {2: [0], 7: [1, 3], 9: []}
    with pytest.raises(ValueError):
        sinks.pack_cross([(1, [70_000])], 4)
    with pytest.raises(ValueError):
        sinks.unpack_cross(b"x" * 24)


def test_build(spark, tmp_path):
    host = "https://news.ycombinator.com/item?id="
    lines = []
    for i in range(1, 61):
        story = i % 4 == 1
        lines.append({"id": i, "time": 1704067200 + i * 3600, "type": "story" if story else "comment", "by": f"User{i % 5}", "title": f"Ask HN: shared subject words {i % 3}" if story else "", "text": f"long shared discussion body number words {host}{max(1, i - 4)}", "score": i, "parent": None if story else i - 1})
    (tmp_path / "dump").mkdir()
    with gzip.open(tmp_path / "dump" / "1.json.gz", "wt") as f:
        f.write("\n".join(map(json.dumps, lines)))
    out = str(tmp_path / "out")
    build = Build(spark, out, shard.CutRules(target_bytes=2000, max_days=None))
    build.run(str(tmp_path / "dump"))
    manifest = json.load(open(f"{out}/manifest.json"))
    assert sum(s["count"] for s in manifest["shards"]) == 60 and len(manifest["shards"]) > 2
    assert json.load(open(f"{out}/archive.json"))["totals"]["posts"] == 15
    assert spark.read.parquet(f"{out}/edges").count() == 45 and spark.read.parquet(f"{out}/users").count() == 5
    related = json.load(open(f"{out}/related/manifest.json"))
    assert related["totals"]["component_count"] >= 1 and related["totals"]["member_count"] == sum(s["member_count"] for s in related["shards"])
    before = spark.read.parquet(f"{out}/users").inputFiles()
    build.run()
    assert spark.read.parquet(f"{out}/users").inputFiles() == before
    shards = {s["sid"]: s for s in manifest["shards"]}
    assert all(s["bytes"] > 0 and s["share"] > 0 and len(s["content"]) == 12 for s in shards.values()) and len({s["content"] for s in shards.values()}) == len(shards)
    assert spark.read.parquet(f"{out}/user_months").count() == 5
    listed = json.load(open(f"{out}/users.json"))
    assert listed["totals"]["users"] == 5 and listed["user_growth"][0]["new_users"] == 5 and listed["user_active"] == [{"month": "2024-01", "active": 5}]
    bounds = sorted((s["id_lo"], s["id_hi"], s["sid"]) for s in shards.values())
    found = sinks.look_up(spark, f"{out}/shards", bounds, 33)
    assert [r.id for r in found.collect()] == [33] and len(found.inputFiles()) == 1 and sinks.look_up(spark, f"{out}/shards", bounds, 999).count() == 0
    compressed = spark.read.parquet(f"{out}/cross")
    sinks.write_cross(compressed, f"{out}/cross.bin", len(manifest["shards"]), "binary")
    packed = sinks.unpack_cross(open(f"{out}/cross.bin", "rb").read())
    assert packed == {r.parent_id: list(r.sids) for r in compressed.collect()}
    assert sinks.read_shards(spark, f"{out}/shards", [0]).select("sid").distinct().count() == 1


def _build_lines(n):
    return [(i, "story" if i % 3 == 1 else "comment", f"u{i % 11}", 1704067200 + i, i, f"title {i}", "some words https://news.ycombinator.com/item?id=1", None, None if i % 3 == 1 else i - 1) for i in range(1, n + 1)]


def test_steps_are_built_anew_when_their_settings_change(spark, tmp_path):
    items = spark.createDataFrame(_build_lines(90), "id long, type string, author string, time long, score long, title string, text string, url string, parent long")
    out = str(tmp_path / "out")

    def files(name):
        return set(spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(f"{out}/{name}").select("path").toPandas()["path"])

    rules, other = shard.CutRules(target_bytes=2000, max_days=None), shard.CutRules(target_bytes=4000, max_days=None)
    with pytest.raises(ValueError):
        Build(spark, out, rules).run()
    Build(spark, out, rules, user_target=1, user_every=4).run(items=items)
    before = {name: files(name) for name in ("shards", "users", "related/components", "edges")}
    assert [s["users"] for s in json.load(open(f"{out}/users.json"))["shards"]] == [4, 4, 3]
    Build(spark, out, rules, user_target=1, user_every=6).run()
    after = {name: files(name) for name in before}
    assert [name for name in before if before[name] != after[name]] == ["users"]
    Build(spark, out, rules, related.Config(min_edge_weight=0.5), user_target=1, user_every=6).run()
    assert files("related/components") != after["related/components"] and files("edges") == after["edges"]
    sinks.remove(spark, f"{out}/_steps/edges")  # as if the run had ended while edges were written
    Build(spark, out, rules, related.Config(min_edge_weight=0.5), user_target=1, user_every=6).run()
    assert files("edges") != after["edges"] and files("shards") == after["shards"]
    n = len(json.load(open(f"{out}/manifest.json"))["shards"])
    Build(spark, out, other, related.Config(min_edge_weight=0.5), user_target=1, user_every=6).run(items=items)
    assert len(json.load(open(f"{out}/manifest.json"))["shards"]) < n and files("edges") != after["edges"]


def test_shard_discovery_prefers_hashed_and_gzip(spark, tmp_path):
    for name in ("shard_0.sqlite", "shard_0.sqlite.gz", "shard_1.sqlite.gz", "shard_1_0123456789ab.sqlite.gz", "shard_2.sqlite", "shard_x.sqlite", "shard_3_zz.sqlite", "other_4.sqlite"):
        (tmp_path / name).write_bytes(name.encode())
    found = {r.sid: (r.file, r.bytes) for r in sinks.discover_shards(spark, str(tmp_path)).collect()}
    assert found == {0: ("shard_0.sqlite.gz", 17), 1: ("shard_1_0123456789ab.sqlite.gz", 30), 2: ("shard_2.sqlite", 14)}


def test_host_calls(spark):
    db = Database(spark, items=spark.range(5).withColumn("name", F.concat(F.lit("n"), "id")))
    assert db.select_value("select count(*) from {items}") == 5
    assert db.select_values("select id from {items} where id > :low order by id", {"low": 2}) == [3, 4]
    assert db.select_object("select * from {items} where name = ?", ["n1"]) == {"id": 1, "name": "n1"}
    assert db.select_array("select id from {items} where id = 99") is None
    assert db.exec("select 1 as a;\nselect id from {items} where id = 2;", row_mode="object") == [{"id": 2}]
    assert [r.id for r in db.rows("select id from {items} order by id")] == [0, 1, 2, 3, 4] and db.has("items")


def test_user_routing(spark):
    names = spark.createDataFrame([("Amy",), ("bob ",), ("Zoe",)], "username string")
    shards = spark.createDataFrame([(0, "a", "b"), (1, "bob", "m"), (2, "n", "zz")], "sid int, user_lo string, user_hi string")
    assert {r.username: r.sid for r in users.route_users(shards, names).collect()} == {"Amy": 0, "bob ": 1, "Zoe": 2}


def test_incremental_intake_is_exactly_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for n in (3, 4):
        spark.range(n).write.mode("append").parquet(source)
        incremental.process_new(spark, source, spark.range(1).schema, lambda df: df, target, checkpoint)
    assert spark.read.parquet(target).count() == 7
    phase = incremental.Phase(spark, str(tmp_path / "phases"))
    assert phase.run("a", {"x": 1}, lambda: spark.range(3)).count() == 3
    assert phase.run("a", {"x": 1}, lambda: spark.range(9)).count() == 3 and phase.run("a", {"x": 2}, lambda: spark.range(9)).count() == 9
