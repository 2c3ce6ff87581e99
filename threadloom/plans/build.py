"""The whole build: dump to shards, manifest, archive index, cross-shard index, user tables and related discussions."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from threadloom.operators import edges, related, shard, users
from threadloom.scratch import materialize
from threadloom.sources import ingest, sinks


#: Raised when a step's rows change their meaning; outputs of older steps are then built anew.
SCHEMA_VERSION = 2


@dataclass(frozen=True)
class Build:
    """Output below out, in steps that read the steps before them.

    A step is kept if it is there in whole and was built with the same rules, by the same version, from the same
    steps before it: the hash of all that is written beside its output when it is complete, and compared on the next run. restart builds
    everything anew."""

    spark: SparkSession
    out: str
    rules: shard.CutRules = shard.CutRules()
    config: related.Config = related.Config()
    user_target: int = users.TARGET_BYTES
    user_every: int = users.LOOK_EVERY
    restart: bool = False

    def _stamp(self, name: str) -> str:
        settings = {"shards": vars(self.rules), "users": [self.user_target, self.user_every], "related": vars(self.config)}
        used = ["shards"] if name != "users" and name != "related" else ["shards", name]
        return hashlib.sha256(json.dumps([SCHEMA_VERSION, {k: settings[k] for k in used}], sort_keys=True).encode()).hexdigest()[:16]

    def _file(self, name: str) -> str:
        return f"{self.out}/_steps/{name}"

    def _done(self, name: str) -> bool:
        return not self.restart and sinks.read_bytes(self.spark, self._file(name)) == self._stamp(name).encode()

    def _step(self, name: str, build) -> None:
        """Runs build unless its output is there; the mark that it is comes last, and goes first."""
        if not self._done(name):
            sinks.remove(self.spark, self._file(name))
            build()
            sinks.write_bytes(self.spark, self._file(name), self._stamp(name).encode())

    def _table(self, name: str, make) -> None:
        self._step(name, lambda: make().write.mode("overwrite").parquet(f"{self.out}/{name}"))

    def run(self, dump: str | None = None, items: DataFrame | None = None, presorted: bool = False) -> None:
        """From a folder of dumps, or from items; with shards written before, neither is needed."""
        self._step("shards", lambda: self._shards(dump, items, presorted))
        sharded = sinks.read_shards(self.spark, f"{self.out}/shards")
        self._step("manifests", lambda: self.manifests(sharded))
        self._table("edges", lambda: edges.edges(sharded))
        self._table("cross", lambda: edges.compressed_rows(edges.cross_links(self.spark.read.parquet(f"{self.out}/edges"), self._bounds())))
        self._step("users", lambda: self._users(sharded))
        self._step("related", lambda: sinks.write_related(related.Related(sharded.drop("sid"), self.config), f"{self.out}/related"))

    def _shards(self, dump: str | None, items: DataFrame | None, presorted: bool) -> None:
        if dump is None and items is None:
            raise ValueError("no shards by these rules yet: give a dump or items")
        staged = items if items is not None else materialize(ingest.ingest(self.spark, dump, presorted, empty_as_zero=True).drop("kids", "descendants"), "staging")
        bounds = materialize(shard.shard_bounds(staged, self.rules), "bounds")
        sinks.write_shards(shard.with_shard(staged, bounds), f"{self.out}/shards")

    def manifests(self, sharded: DataFrame | None = None) -> None:
        """The manifest, with sizes on disk and content hashes, and the archive index, from shards that are written."""
        sharded = sharded if sharded is not None else sinks.read_shards(self.spark, f"{self.out}/shards")
        sinks.write_item_manifest(sharded, f"{self.out}/manifest.json", self.rules)
        sinks.repair_sizes(self.spark, f"{self.out}/manifest.json", f"{self.out}/shards", hashes=True)
        sinks.write_archive_index(sharded, f"{self.out}/archive.json")

    def _bounds(self) -> DataFrame:
        return sinks.read_manifest(self.spark, f"{self.out}/manifest.json").select("sid", "id_lo", "id_hi")

    def _users(self, sharded: DataFrame) -> None:
        stats = materialize(users.user_stats(sharded), "users")
        domains, months = materialize(users.user_domains(sharded), "user-domains"), materialize(users.user_months(sharded), "user-months")
        placed = materialize(users.user_shards(users.user_bytes(stats, domains, months), self.user_target, self.user_every), "user-shards")
        sinks.write_user_shards(stats, domains, months, placed, self.out)
        self.user_manifest()

    def user_manifest(self) -> None:
        """The manifest of users alone, from user shards that are written."""
        sinks.write_user_manifest(self.spark, self.out, f"{self.out}/users.json", self.user_target)
