"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

Circulant MinHash (Li and Li 2022): one permutation places a shingle on a circle of 2^32 positions, a
second one ranks positions; coordinate k of the signature is the smallest rank after the circle is
shifted by k. Two permutations make all coordinates.

Plan: (1) one pass makes each text's set size, a 128-bit hash of its set and its signature;
(2) texts with equal sets are one class, so copies never meet again; (3) signatures of classes are cut
into bands; a band value that several classes share is a bucket; (4) every class proposes a link to the
leader (smallest class) it shares most buckets with, which is verified on the full sets, and verified links are contracted; (5) only buckets that still hold several
components are searched further, in blocks of bounded size: first by signatures alone, which leaves the classes that have a possible link to
another component, then their full sets are made and sent to the blocks that need them, possible links are verified there, likeliest first, and
only links that join components leave the block. Pairs within a component are never compared, a pair is looked at in the first bucket it
shares, and no bucket is capped.

A pair at the threshold shares no band with probability (1 - s^ROWS)^BANDS (2e-6 at 0.8), and pairs whose signatures agree
in fewer than ``LEAST`` of the coordinates aren't verified (2e-6 at 0.8).

Defined cases: null and empty texts have no shingle, are components of their own and are kept; texts with fewer words than a
shingle are one shingle; rows of one doc_id are judged by their own text, and a link of one of them
links the id; further columns are ignored; an empty table gives no rows.

Classes are named by their smallest doc_id (NearDuplicates takes unique ids), so where ids repeat rows get names of their own first: components of rows come from
those, and components of ids from joining the components that rows of one id are in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import words
from threadloom.llm.common import broadcast_if_small, materialize, prepare, table
from threadloom.operators.components import connected_components

BANDS, ROWS = 25, 4
K = BANDS * ROWS
#: Share of equal coordinates below which a pair is not verified.
LEAST = 0.6
#: Classes, and shingles, on one side of a block pair.
BLOCK, BLOCK_SHINGLES = 2048, 2_000_000
#: Largest vocabulary of a block that bit sets are used for.
BITSET_WORDS = 1 << 16
_CHUNK = 512
BLOCK_COLUMNS = ["band", "bucket", "i", "j", "side", "rep", "comp", "n"]
POSSIBLE = "band int, bucket long, i int, j int, side int, rep long, comp long, n long"
#: Column with the name of a row.
ROW = "near_duplicates_row"

SIGNED = "doc_id long, n_shingles long, set_hi long, set_lo long, signature binary"
_SIGNED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_hi", pa.int64()), ("set_lo", pa.int64()), ("signature", pa.binary())])
_SHIFTS = np.arange(1, K + 1, dtype=np.uint32)[:, None]


def signature(shingles: np.ndarray) -> np.ndarray:
    """K coordinates from two permutations: place = the upper half of a mixed hash, rank = a bijection of 32-bit numbers."""
    place = (words.mix(shingles) >> np.uint64(32)).astype(np.uint32)
    out = np.full(K, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(place), _CHUNK):
        x = place[None, at : at + _CHUNK] + _SHIFTS
        t = x >> np.uint32(16)
        x ^= t
        x *= np.uint32(0x85EBCA6B)
        np.right_shift(x, np.uint32(13), out=t)
        x ^= t
        x *= np.uint32(0xC2B2AE35)
        np.right_shift(x, np.uint32(16), out=t)
        x ^= t
        np.minimum(out, x.min(axis=1), out=out)
    return out


def _sign(shingle_words: int, lower: bool):
    def run(batches):
        for batch in batches:
            n, hi, lo, signatures = [], [], [], []
            for text in batch.column(1):
                s = words.shingles(words.hashes(words.split(text.as_py(), lower)), shingle_words)
                n.append(len(s))
                if len(s):
                    d = xxhash.xxh3_128_digest(s.tobytes())
                    hi.append(int.from_bytes(d[:8], "big", signed=True))
                    lo.append(int.from_bytes(d[8:], "big", signed=True))
                    signatures.append(signature(s).tobytes())
                else:
                    hi.append(None)
                    lo.append(None)
                    signatures.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(signatures, pa.binary())], schema=_SIGNED_SCHEMA)

    return run


def _candidates(x: dict, y: dict, same: bool, band: int, share: int):
    """(agreement, i, j) of pairs that may be links: in different components, of fitting sizes, alike in enough
    coordinates, and with this band as the first that they share (so a pair is looked at once, whatever number of buckets it shares)."""
    own = slice(ROWS * band, ROWS * (band + 1))
    for i in range(len(x["rep"])):
        low = i + 1 if same else 0
        fits = (y["comp"][low:] != x["comp"][i]) & (100 * np.minimum(y["n"][low:], x["n"][i]) >= share * np.maximum(y["n"][low:], x["n"][i]))
        at = np.flatnonzero(fits) + low
        if not len(at):
            continue
        equal = y["sig"][at] == x["sig"][i]
        good = (equal.mean(axis=1) >= LEAST) & equal[:, own].all(axis=1)
        if band:
            good &= ~equal[:, : ROWS * band].reshape(len(at), band, ROWS).all(axis=2).any(axis=1)
        for k in np.flatnonzero(good).tolist():
            yield float(equal[k].mean()), i, int(at[k])


class _Sets:
    """Exact intersections of a block's sets: bit sets over their common vocabulary while that is small, else sorted arrays."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets = sets
        self.vocabulary = np.unique(np.concatenate(sets))
        self.bits: dict[int, int] | None = {} if len(self.vocabulary) <= BITSET_WORDS else None

    def _bitset(self, i: int) -> int:
        if i not in self.bits:
            marks = np.zeros(len(self.vocabulary), bool)
            marks[np.searchsorted(self.vocabulary, self.sets[i])] = True
            self.bits[i] = int.from_bytes(np.packbits(marks).tobytes(), "big")
        return self.bits[i]

    def common(self, i: int, j: int) -> int:
        if self.bits is not None:
            return (self._bitset(i) & self._bitset(j)).bit_count()
        return len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))


def _sides(group):
    """A block's classes, the two sides that are compared (row numbers in column at), and whether they are one and the same."""
    data = {"rep": group.column("rep").to_numpy(), "comp": group.column("comp").to_numpy(), "n": group.column("n").to_numpy(), "sig": np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(-1, K)}
    side = group.column("side").to_numpy()
    x, y = ({k: v[side == s] for k, v in (data | {"at": np.arange(len(side))}).items()} for s in (0, 1))
    same = not len(y["rep"])
    return data, x, x if same else y, same


def _possible(share: int):
    """The classes of a block that have a possible link, by signatures alone. A block is a bucket's classes, or a pair of parts of a large
    bucket: rows of side 0 against those of side 1."""

    def run(key, group):
        _, x, y, same = _sides(group)
        hit = np.zeros(group.num_rows, bool)
        for _, i, j in _candidates(x, y, same, key[0].as_py(), share):
            hit[x["at"][i]] = hit[y["at"][j]] = True
        return group.select(BLOCK_COLUMNS).filter(pa.array(hit))

    return run


def _blocks(share: int):
    """Verified links between different components of a block, as many as join them: likeliest pairs first, none between classes that
    are joined by then."""

    def run(key, group):
        data, x, y, same = _sides(group)
        found = sorted((-e, int(x["at"][i]), int(y["at"][j])) for e, i, j in _candidates(x, y, same, key[0].as_py(), share))
        links = []
        if found:
            sets = _Sets([np.frombuffer(v, np.uint64) for v in group.column("hashes").to_pylist()])
            parent: dict[int, int] = {}

            def root(c: int) -> int:
                while parent.get(c, c) != c:
                    c = parent[c]
                return c

            names, comp, sizes = data["rep"].tolist(), data["comp"].tolist(), data["n"].tolist()
            for _, i, j in found:
                a, b = root(comp[i]), root(comp[j])
                if a != b:
                    common = sets.common(i, j)
                    if 100 * common >= share * (sizes[i] + sizes[j] - common):
                        parent[max(a, b)] = min(a, b)
                        links.append((names[i], names[j]))
        return pa.table({"a": pa.array([v[0] for v in links], pa.int64()), "b": pa.array([v[1] for v in links], pa.int64())})

    return run


class NearDuplicates:
    """Classes of equal sets, verified links between classes, and components."""

    def __init__(self, docs: DataFrame, shingle_words: int, share: int = 80, lower: bool = True) -> None:
        prepare(docs.sparkSession)
        self.share, self.shingle_words, self.lower = share, shingle_words, lower
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.signed = materialize(self.docs.mapInArrow(_sign(shingle_words, lower), SIGNED), "signatures")
        self.classes = materialize(
            self.signed.where("n_shingles > 0 and doc_id is not null").groupBy("set_hi", "set_lo").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")),
            "classes",
        )

    def _bands(self) -> DataFrame:
        keys = [F.xxhash64(F.substring("signature", 4 * ROWS * i + 1, 4 * ROWS)) for i in range(BANDS)]
        return self.classes.select("rep", F.posexplode(F.array(*keys)).alias("band", "bucket"))

    def _verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets reach the threshold."""
        ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "verify-ids")
        texts = materialize(self.docs.join(broadcast_if_small(ids, 16), "doc_id", "left_semi"), "verify-texts")
        left = pairs.select("a", "b").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        both = left.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb")
        k, lower, share = self.shingle_words, self.lower, self.share

        def run(batches):
            last = (None, None)
            for batch in batches:
                keep = []
                for i, (ta, tb) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                    ta, tb = ta.as_py(), tb.as_py()
                    if last[0] is None or last[0] != ta:
                        last = (ta, words.shingles(words.hashes(words.split(ta, lower)), k))
                    x, y = last[1], words.shingles(words.hashes(words.split(tb, lower)), k)
                    common = len(x) + len(y) - len(np.union1d(x, y))
                    if 100 * common >= share * (len(x) + len(y) - common):
                        keep.append(i)
                yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

        return materialize(both.mapInArrow(run, "a long, b long").distinct(), "links")

    def links(self) -> DataFrame:
        """Verified links between classes, enough of them for exact components."""
        bands = self._bands()
        shared = materialize(bands.groupBy("band", "bucket").agg(F.min("rep").alias("leader"), F.count("*").alias("members")).where("members > 1"), "buckets")
        if shared.isEmpty():
            return shared.select(F.col("leader").alias("a"), F.col("leader").alias("b"))
        members = materialize(bands.join(shared.drop("members"), ["band", "bucket"]), "members")
        # each class proposes one link: to the leader it shares most buckets with
        votes = members.where("rep <> leader").groupBy("rep", "leader").agg(F.count("*").alias("votes"))
        first = materialize(votes.groupBy(F.col("rep").alias("b")).agg(F.max_by("leader", F.struct("votes", -F.col("leader"))).alias("a")).select("a", "b"), "proposals")
        found = self._verify(first)
        parts = connected_components(found.select(F.col("a").alias("u"), F.col("b").alias("v")))
        labelled = members.select("band", "bucket", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("band", "bucket", "rep", F.coalesce("component", "rep").alias("comp"))
        info = labelled.join(self.classes.select("rep", "n"), "rep")
        mixed = info.groupBy("band", "bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"), F.sum("n").alias("weight")).where("lo <> hi")
        still = materialize(info.join(mixed.select("band", "bucket", "size", "weight"), ["band", "bucket"]), "mixed")
        return found.union(self._cross_links(still))

    def _cross_links(self, members: DataFrame) -> DataFrame:
        """Links between components that meet in a bucket."""
        k, lower = self.shingle_words, self.lower

        def sets(batches):
            for batch in batches:
                made = [words.shingles(words.hashes(words.split(t.as_py(), lower)), k) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in made], pa.binary())], names=["rep", "hashes"])

        blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")
        dealt = (
            members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("band", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "rep", "comp", "n")
        )
        signatures = self.classes.select("rep", "signature")
        block = ["band", "bucket", "i", "j"]
        possible = materialize(dealt.join(signatures, "rep").groupBy(block).applyInArrow(_possible(self.share), POSSIBLE), "possible")
        ids = materialize(possible.select(F.col("rep").alias("doc_id")).distinct(), "possible-ids")
        full = self.docs.join(broadcast_if_small(ids, 16), "doc_id", "left_semi").mapInArrow(sets, "rep long, hashes binary")
        full = materialize(full.join(signatures, "rep"), "possible-sets")
        return materialize(possible.join(full, "rep").groupBy(block).applyInArrow(_blocks(self.share), "a long, b long"), "cross-links")

    def result(self) -> DataFrame:
        parts = connected_components(self.links().select(F.col("a").alias("u"), F.col("b").alias("v")))
        by_class = self.classes.select("set_hi", "set_lo", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("set_hi", "set_lo", F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("component_id"))
        out = self.signed.select("doc_id", "n_shingles", "set_hi", "set_lo").join(by_class, ["set_hi", "set_lo"], "left")
        component = F.coalesce("component_id", "doc_id")
        return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), F.coalesce("class_id", "doc_id").alias("class_id"))


def ids_repeat(docs: DataFrame) -> bool:
    return not docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("long")).count().where("count > 1").isEmpty()


def named_rows(docs: DataFrame) -> DataFrame:
    """docs with the column ROW, unique and fixed by being written; null without doc_id."""
    return materialize(docs.withColumn(ROW, F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())), "named-rows")


def row_components(named: DataFrame, shingle_words: int = 5, share: int = 80, lower: bool = True) -> DataFrame:
    """ROW, doc_id, n_shingles, part and class of each row of named_rows; rows of one part are near duplicates, of one class equal sets."""
    found = NearDuplicates(named.select(F.col(ROW).alias("doc_id"), "text"), shingle_words, share, lower).result()
    ids = named.where(F.col(ROW).isNotNull()).select(ROW, F.col("doc_id").cast("long").alias("doc_id"))
    return materialize(found.select(F.col("doc_id").alias(ROW), "n_shingles", F.col("component_id").alias("part"), F.col("class_id").alias("class")).join(ids, ROW, "left"), "row-components")


def dropped_rows(named: DataFrame, shingle_words: int = 5, share: int = 80, lower: bool = True) -> DataFrame:
    """ROW of the rows of named_rows but for one of each component of rows: that of the smallest doc_id."""
    rows = row_components(named, shingle_words, share, lower).where(F.col(ROW).isNotNull())
    first = rows.groupBy("part").agg(F.min(F.struct("doc_id", ROW))[ROW].alias("first"))
    return rows.join(first, "part").where(F.col(ROW) != F.col("first")).select(ROW)


def near_duplicates(docs: DataFrame, shingle_words: int = 5, share: int = 80, lower: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and class_id of each row; share: the Jaccard threshold in percent."""
    prepare(docs.sparkSession)
    if not ids_repeat(docs):
        return NearDuplicates(docs, shingle_words, share, lower).result()
    rows = row_components(named_rows(docs.select("doc_id", "text")), shingle_words, share, lower)
    leaders = materialize(rows.where("doc_id is not null").groupBy("part").agg(F.min("doc_id").alias("leader")), "leaders")
    classes = rows.where("doc_id is not null").groupBy("class").agg(F.min("doc_id").alias("class_id"))
    edges = rows.join(leaders, "part").where("doc_id <> leader").select(F.col("doc_id").alias("u"), F.col("leader").alias("v")).distinct()
    parts = connected_components(edges).withColumnRenamed("node", "doc_id")
    component = F.coalesce("component", "doc_id")
    return rows.join(parts, "doc_id", "left").join(classes, "class", "left").select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "class_id")


def op1_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2).drop("class_id")


OP1_SQL = """
with recursive d as (select doc_id, row_number() over () as rid,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select rid, doc_id, case when len(w) = 0 then [] when len(w) = 1 then w
    else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as g from d),
n as (select rid, doc_id, cast(len(g) as bigint) as n_shingles from s),
e as (select rid, unnest(g) as x from s),
c as (select p.rid as a, q.rid as b, count(*) as c from e p join e q using (x) where p.rid <> q.rid group by all),
l as (select x.doc_id as a, y.doc_id as b from c join n x on x.rid = c.a join n y on y.rid = c.b
    where 100 * c.c >= 80 * (x.n_shingles + y.n_shingles - c.c)),
r as (select doc_id as a, doc_id as b from documents union select r.a, l.b from r join l on r.b = l.a),
m as (select a, min(b) as component_id from r group by a)
select doc_id, n_shingles, component_id, doc_id = component_id as kept from n join m on m.a = n.doc_id
"""
