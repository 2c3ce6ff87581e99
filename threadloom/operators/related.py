"""Related discussions: links between items, resolved to stories, scored, pruned, clustered and ranked."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.functions.scalar import utc_date
from threadloom.functions.text import MAX_LINKS_PER_ITEM, MAX_STORY_TOKENS, has_related_keyword, jaccard, linked_items, story_tokens
from threadloom.operators.ancestors import MAX_DEPTH, comment_totals, nearest_marked
from threadloom.operators.components import connected_components
from threadloom.operators.order import numbered, rotate
from threadloom.scratch import materialize


@dataclass(frozen=True)
class Config:
    # Defaults and weights of the published index.
    max_depth: int = MAX_DEPTH
    max_links_per_item: int = MAX_LINKS_PER_ITEM
    link_dump_cap: int = 8
    max_story_tokens: int = MAX_STORY_TOKENS
    min_edge_weight: float = 0.18
    max_edges_per_source: int = 5
    components_per_shard: int = 3500
    target_bytes: int = 15 << 20
    least_components: int = 250
    look_every: int = 100
    rank_model: str = "points"

    def __post_init__(self) -> None:
        if self.rank_model not in ("points", "legacy"):
            raise ValueError("rank_model is points or legacy")
        for name in ("max_depth", "max_story_tokens", "max_edges_per_source", "components_per_shard"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")


def raw_links(items: DataFrame, config: Config = Config()) -> DataFrame:
    """One row per item and distinct item it links to, not itself."""
    linking = items.where(F.contains("text", F.lit("item?id=")) | F.contains("url", F.lit("item?id=")))
    # one evaluation of the patterns per item: an outer explode keeps the optimizer from repeating them in a filter
    found = linking.select("id", "time", "score", has_related_keyword(F.col("text")).alias("has_keyword"), linked_items(F.col("text"), F.col("url"), config.max_links_per_item).alias("targets"))
    pairs = found.select("id", "time", "score", "has_keyword", F.explode_outer("targets").alias("target_item_id")).where("target_item_id <> id")
    return pairs.select(F.col("id").alias("evidence_item_id"), F.col("id").alias("source_item_id"), F.col("time").alias("source_time"), F.col("score").alias("source_score"), "has_keyword", "target_item_id")


def resolved_links(links: DataFrame, stories: DataFrame) -> DataFrame:
    """Links with the stories (id, story_id) of both ends; others go."""
    ends = stories.where("story_id is not null")
    source = ends.select(F.col("id").alias("source_item_id"), F.col("story_id").alias("source_story_id"))
    target = ends.select(F.col("id").alias("target_item_id"), F.col("story_id").alias("target_story_id"))
    return links.join(source, "source_item_id").join(target, "target_item_id")


def profiles(items: DataFrame, stories: DataFrame, config: Config = Config()) -> DataFrame:
    """Tokens, title, author, time, score and url of each of stories (id)."""
    picked = items.join(stories.select("id").distinct(), "id", "right")
    return picked.select(F.col("id").alias("story_id"), story_tokens(F.col("title"), F.col("text"), config.max_story_tokens).alias("tokens"), "title", "author", "time", "score", "url")


def evidence(resolved: DataFrame) -> DataFrame:
    """Per item and source story: its latest time, best score, keyword and the distinct target stories, sorted. At most the link cap per item."""
    return resolved.groupBy("evidence_item_id", "source_story_id").agg(F.max("source_time").alias("source_time"), F.max("source_score").alias("source_score"), F.max("has_keyword").alias("has_keyword"), F.array_sort(F.collect_set("target_story_id")).alias("targets"))


def edge_scores(grouped: DataFrame, tokens: DataFrame, config: Config = Config()) -> DataFrame:
    """Weighted edges between stories, summed over evidence.

    align is the mean similarity of source and targets, consistency that of all target pairs; both, and the keyword, make the base score, damped for inconsistent and for long lists."""
    targets = F.filter("targets", lambda t: t != F.col("source_story_id"))
    cut = F.slice(targets, 1, config.max_links_per_item) if config.max_links_per_item > 0 else targets
    rows = grouped.select("evidence_item_id", "source_story_id", "source_time", "has_keyword", cut.alias("targets")).where(F.size("targets") > 0)
    exploded = rows.select("evidence_item_id", "source_story_id", "source_time", "has_keyword", F.explode("targets").alias("target_story_id"))
    of_target = tokens.select(F.col("story_id").alias("target_story_id"), F.col("tokens").alias("target_tokens"))
    of_source = tokens.select(F.col("story_id").alias("source_story_id"), F.col("tokens").alias("source_tokens"))
    gathered = exploded.join(of_target, "target_story_id", "left").join(of_source, "source_story_id").where(F.size("source_tokens") > 0)
    similar = gathered.withColumn("sim", jaccard(F.col("source_tokens"), F.col("target_tokens")))
    lists = similar.groupBy("evidence_item_id", "source_story_id").agg(F.max("source_time").alias("source_time"), F.max("has_keyword").alias("has_keyword"), F.array_sort(F.collect_list(F.struct("target_story_id", "sim", F.coalesce("target_tokens", F.array().cast("array<string>")).alias("tokens")))).alias("t"))
    n = F.size("t")
    align = F.aggregate("t", F.lit(0.0), lambda s, x: s + x["sim"]) / n
    pairs = F.flatten(F.transform("t", lambda x, i: F.transform(F.slice("t", i + 2, n), lambda y: jaccard(x["tokens"], y["tokens"]))))
    consistency = F.when(n > 1, F.aggregate("_pairs", F.lit(0.0), lambda s, x: s + x) / F.size("_pairs")).otherwise(F.col("align"))
    cap = config.link_dump_cap
    scored = (
        lists.withColumn("align", align).withColumn("_pairs", pairs).withColumn("consistency", consistency)
        .withColumn("base", (F.lit(0.55) * F.col("align") + F.lit(0.45) * F.col("consistency") + F.when(F.col("has_keyword") > 0, 0.15).otherwise(0.0))
            * F.least(F.greatest(F.lit(0.35) + F.lit(2.0) * F.col("consistency"), F.lit(0.35)), F.lit(1.0)) * F.when((F.lit(cap) > 0) & (n > cap), F.lit(float(cap)) / n).otherwise(F.lit(1.0)))
        .where("base > 0.01D")
    )
    each = scored.select("source_story_id", "source_time", "align", "consistency", "base", F.explode("t").alias("x")).select("source_story_id", F.col("x.target_story_id").alias("target_story_id"), (F.col("base") * (F.lit(0.6) + F.lit(0.4) * F.col("x.sim"))).alias("w"), "align", "consistency", "source_time").where("w > 0.001D")
    return each.groupBy("source_story_id", "target_story_id").agg(F.sum("w").alias("weight"), F.max("align").alias("source_align"), F.max("consistency").alias("self_consistency"), F.count("*").alias("evidence_count"), F.max("source_time").alias("last_time"))


def prune(scores: DataFrame, config: Config = Config()) -> DataFrame:
    """The best out-edges of each source above the weight limit."""
    order = Window.partitionBy("source_story_id").orderBy(F.desc("weight"), F.desc("evidence_count"), F.coalesce("last_time", F.lit(0).cast("bigint")).desc(), F.desc("target_story_id"))
    kept = scores.where(F.col("weight") >= F.lit(config.min_edge_weight)).withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= config.max_edges_per_source)
    return kept.select("source_story_id", "target_story_id", "weight", "evidence_count", "last_time")


def components(pruned: DataFrame) -> DataFrame:
    """(story_id, component_id); component_id is the smallest story of the component."""
    return connected_components(pruned.select(F.col("source_story_id").alias("u"), F.col("target_story_id").alias("v"))).select(F.col("node").alias("story_id"), F.col("component").alias("component_id"))


def story_strength(pruned: DataFrame) -> DataFrame:
    """(story_id, rel_score): weights of all edges at a story."""
    both = pruned.select(F.col("source_story_id").alias("story_id"), "weight").unionAll(pruned.select(F.col("target_story_id").alias("story_id"), "weight"))
    return both.groupBy("story_id").agg(F.sum("weight").alias("rel_score"))


def incoming(pruned: DataFrame) -> DataFrame:
    return pruned.groupBy(F.col("target_story_id").alias("story_id")).agg(F.count("*").alias("incoming_link_count"), F.sum("evidence_count").alias("total_evidence_count"))


def _members(parts: DataFrame, profile: DataFrame, totals: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    joined = parts.join(profile.drop("tokens"), "story_id", "left").join(totals.select(F.col("id").alias("story_id"), "comment_total"), "story_id", "left")
    return joined.withColumn("t0", F.coalesce("time", zero)).withColumn("s0", F.coalesce("score", zero)).withColumn("c0", F.coalesce("comment_total", zero))


def component_index(parts: DataFrame, pruned: DataFrame, profile: DataFrame, totals: DataFrame, config: Config = Config()) -> DataFrame:
    """One row per component of two or more stories: root, sizes, sums, rank score and years. One aggregate over members and one over links."""
    members = _members(parts, profile, totals).join(incoming(pruned).select("story_id", "incoming_link_count"), "story_id", "left")
    root = F.max_by("story_id", F.struct(utc_date(F.col("t0")), "s0", "t0", "story_id"))
    years = F.collect_set(F.when(F.col("t0") > 0, F.year(utc_date(F.col("t0")))))
    by_member = members.groupBy("component_id").agg(
        root.alias("root_story_id"), F.count("*").alias("member_count"), F.max("t0").alias("latest_time"), F.max("s0").alias("max_story_score"), F.sum("s0").alias("story_points_sum"),
        F.sum("c0").alias("comment_count"), F.sum(F.coalesce("incoming_link_count", F.lit(0).cast("bigint"))).alias("incoming_link_count"), years.alias("years"),
    ).where("member_count >= 2")
    by_link = pruned.join(parts.withColumnRenamed("story_id", "source_story_id"), "source_story_id").groupBy("component_id").agg(F.count("*").alias("edge_count"))
    joined = by_member.join(by_link, "component_id", "left").withColumn("edge_count", F.coalesce("edge_count", F.lit(0).cast("bigint")))
    # Weights of the two rank models.
    points = F.ceil(F.col("story_points_sum") + F.col("comment_count") * F.lit(2.718)).cast("double")
    legacy = F.col("max_story_score") * F.lit(0.7) + F.col("latest_time") * F.lit(1e-6) * F.lit(0.3) + F.col("member_count") * F.lit(2.0) + F.col("edge_count") * F.lit(0.5)
    rank = points if config.rank_model == "points" else legacy
    csv = F.nullif(F.array_join(F.sort_array("years", asc=False), ","), F.lit(""))
    return joined.select("component_id", "root_story_id", "member_count", "edge_count", rank.alias("rank_score"), "latest_time", "max_story_score", "story_points_sum", "comment_count", "incoming_link_count", csv.alias("years_csv"))


def component_members(parts: DataFrame, index: DataFrame, pruned: DataFrame, profile: DataFrame) -> DataFrame:
    kept = parts.join(index.select("component_id"), "component_id", "left_semi")
    return kept.join(story_strength(pruned), "story_id", "left").join(profile.drop("tokens"), "story_id", "left").select("component_id", "story_id", F.coalesce("rel_score", F.lit(0.0)).alias("rel_score"), "title", "author", "time", "score", "url")


def component_links(parts: DataFrame, index: DataFrame, pruned: DataFrame) -> DataFrame:
    one = parts.select(F.col("story_id").alias("source_story_id"), "component_id")
    two = parts.select(F.col("story_id").alias("target_story_id"), F.col("component_id").alias("other"))
    return pruned.join(one, "source_story_id").join(two, "target_story_id").where("component_id = other").drop("other").join(index.select("component_id"), "component_id", "left_semi")


RANK_ORDER = (F.desc, "rank_score"), (F.desc, "latest_time"), (F.desc, "component_id")


def component_bytes(index: DataFrame, members: DataFrame, links: DataFrame) -> DataFrame:
    """(component_id, bytes): estimated size of a component's rows: 128 bytes, 48 and the texts of each member, 40 a link."""
    own = index.select("component_id", F.lit(128).cast("bigint").alias("bytes"))
    texts = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in ("title", "author", "url")), F.lit(48))
    parts = [members.groupBy("component_id").agg(F.sum(texts).alias("bytes")), links.groupBy("component_id").agg((F.count("*") * 40).alias("bytes"))]
    return own.unionByName(parts[0]).unionByName(parts[1]).groupBy("component_id").agg(F.sum("bytes").alias("bytes"))


def ranked(index: DataFrame, sizes: DataFrame, config: Config = Config()) -> DataFrame:
    """Components with rank (from 1), bytes and shard. A shard ends where, looked at after every so many components, it has the target number of them, or
    the target bytes and a least number."""
    with_ranks = numbered(index.join(sizes, "component_id"), tuple(order(c) for order, c in RANK_ORDER), "ranked")
    return rotate(with_ranks, F.col("bytes"), config.look_every, config.target_bytes, config.least_components, config.components_per_shard)


def member_order() -> tuple:
    """Order of a component's members: strength, points, time, id, all falling."""
    zero = F.lit(0).cast("bigint")
    return F.desc("rel_score"), F.coalesce("score", zero).desc(), F.coalesce("time", zero).desc(), F.desc("story_id")


def link_order() -> tuple:
    """Order of a component's links: weight, evidence, latest time, all falling; then ids."""
    return F.desc("weight"), F.desc("evidence_count"), F.coalesce("last_time", F.lit(0).cast("bigint")).desc(), F.asc("source_story_id"), F.asc("target_story_id")


#: The orders that the index of components can be listed in.
LISTINGS = {
    "comments": (F.desc, ("comment_count", "latest_time", "component_id")),
    "points": (F.desc, ("story_points_sum", "latest_time", "component_id")),
    "discussions": (F.desc, ("member_count", "rank_score", "component_id")),
    "recent": (F.desc, ("latest_day", "story_points_sum", "component_id")),
}


def listed(index: DataFrame, by: str, n: int) -> DataFrame:
    """The first n components by comments, points, number of discussions, or day of the latest one and then points."""
    order, columns = LISTINGS[by]
    return index.withColumn("latest_day", F.floor(F.col("latest_time") / 86400)).orderBy(*(order(c) for c in columns)).limit(n).drop("latest_day")


def backlinks(pruned: DataFrame, profile: DataFrame, limit: int = 10_000) -> DataFrame:
    """The stories most linked to; the limit is the report's size."""
    zero = F.lit(0).cast("bigint")
    top = incoming(pruned).join(profile.drop("tokens"), "story_id").orderBy(F.desc("incoming_link_count"), F.coalesce("score", zero).desc(), F.coalesce("time", zero).desc(), F.desc("story_id")).limit(limit)
    order = Window.orderBy(F.desc("incoming_link_count"), F.coalesce("score", zero).desc(), F.coalesce("time", zero).desc(), F.desc("story_id"))
    return top.select(F.row_number().over(order).alias("rank"), "story_id", "title", "author", "time", "score", "url", "incoming_link_count")


@dataclass
class Related:
    """All steps over one set of items; the costly ones are written once."""

    items: DataFrame
    config: Config = Config()

    def __post_init__(self) -> None:
        config = self.config
        self.links = materialize(raw_links(self.items, config), "raw-links")
        chain = self.items.select("id", "type", "parent")
        story = nearest_marked(chain, chain.where("type = 'story'"), config.max_depth)
        ends = self.links.select(F.col("source_item_id").alias("id")).union(self.links.select(F.col("target_item_id").alias("id"))).distinct()
        self.stories = materialize(story.join(ends, "id", "left_semi"), "item-stories")
        self.resolved = materialize(resolved_links(self.links, self.stories), "resolved-links")
        profiled = self.stories.where("story_id is not null").select(F.col("story_id").alias("id")).distinct()
        self.profiles = materialize(profiles(self.items, profiled, config), "profiles")
        self.totals = materialize(comment_totals(chain, profiled), "comment-totals")
        self.scores = materialize(edge_scores(evidence(self.resolved), self.profiles, config), "edge-scores")
        self.pruned = materialize(prune(self.scores, config), "pruned")
        self.parts = materialize(components(self.pruned), "components")
        self.index = materialize(component_index(self.parts, self.pruned, self.profiles, self.totals, config), "component-index")

    def members(self) -> DataFrame:
        return component_members(self.parts, self.index, self.pruned, self.profiles)

    def component_links(self) -> DataFrame:
        return component_links(self.parts, self.index, self.pruned)

    def ranked(self) -> DataFrame:
        return ranked(self.index, component_bytes(self.index, self.members(), self.component_links()), self.config)

    def backlinks(self, limit: int = 10_000) -> DataFrame:
        return backlinks(self.pruned, self.profiles, limit)
