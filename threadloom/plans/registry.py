"""Queries by operator, and the SQL that states the same result for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.functions import scalar, text
from threadloom.operators import ancestors, edges, related, shard, users
from threadloom.plans import catalog, examples
from threadloom.plans.api import Database
from threadloom.scratch import materialize, scratch_path
from threadloom.sources import adapter, ingest, sinks
from threadloom.sources.adapter import ITEMS_SQL

#: Bytes at which the test data's shards are cut; the published archive's 12 MiB would make one shard of them.
TEST_RULES = shard.CutRules(target_bytes=1 << 20, max_bytes=2 << 20, max_days=None)
_SHARED: dict = {}


def _version(spark, sf_dir: str) -> tuple:
    """Sizes and times of the input files, so that what was made of them isn't used for others."""
    at = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(at, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def _once(spark, sf_dir: str, name: str, make):
    """What several queries of a session read is made once for the same files."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    version = _version(spark, sf_dir)
    if key not in _SHARED or _SHARED[key][0] != version:
        _SHARED[key] = (version, make())
    return _SHARED[key][1]


def _items(spark, d):
    return adapter.items(spark, d)


def _bounds(spark, d):
    return _once(spark, d, "bounds", lambda: materialize(shard.shard_bounds(_items(spark, d), TEST_RULES), "bounds"))


def _sharded(spark, d):
    return shard.with_shard(_items(spark, d), _bounds(spark, d))


def _manifest(spark, d):
    return shard.manifest(_sharded(spark, d))


def _edges(spark, d):
    return edges.edges(_sharded(spark, d).select("sid", "id", "parent", "time"))


def _cross(spark, d):
    return edges.cross_links(_edges(spark, d), _bounds(spark, d))


def _users(spark, d):
    return users.user_stats(_items(spark, d))


#: Sizes of the test data's user shards.
_USER_TARGET, _USER_EVERY = 3000, 5


def _user_shards(spark, d):
    """user_key, bytes, rank and sid of each author."""
    i = _items(spark, d)
    make = lambda: materialize(users.user_shards(users.user_bytes(_users(spark, d), users.user_domains(i), users.user_months(i)), _USER_TARGET, _USER_EVERY), "user-shards")
    return _once(spark, d, "user-shards", make)


def _route_users(spark, d):
    """Each author's shard, found again from the name as another one spells it."""
    placed = _user_shards(spark, d)
    return users.route_users(users.user_bounds(placed), placed.select(F.upper("user_key").alias("username"))).withColumnRenamed("username", "user")


def _archive(spark, d):
    """Items as published shards, and their sorted bounds as a client holds them."""

    def make():
        path = scratch_path(spark, "archive")
        sinks.write_shards(_sharded(spark, d), path)
        return path, sorted((r.id_lo, r.id_hi, r.sid) for r in _bounds(spark, d).collect())

    return _once(spark, d, "archive", make)


def _ordered(spark, d):
    return adapter.ordered_items(spark, d, _once(spark, d, "keyed-texts", lambda: adapter.keyed_texts(spark, d)))


def _related(spark, d):
    return _once(spark, d, "related", lambda: related.Related(_items(spark, d)))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


def _lines(spark, d):
    """The items as two dumps' JSON lines; the first dump has older scores, ids and times as strings or fractions, and lines that can't be read.
    Of items with the same id, each is in a pair of dumps of its own."""
    i = adapter.dumped_items(spark, d)
    dump = ["dump"] if "dump" in i.columns else []
    line = F.to_json(F.struct(F.col("id"), F.col("time"), F.col("type"), F.col("author").alias("by"), F.coalesce("title", F.lit("")).alias("title"), F.col("text"), F.col("url"), F.col("score"), F.col("parent")), {"ignoreNullFields": "false"})
    old = F.concat(F.lit('{"id":"'), F.col("id"), F.lit('","time":'), F.coalesce(F.concat(F.col("time").cast("string"), F.lit(".75")), F.lit("null")), F.lit(',"type":"old","score":-1}'))
    first = i.select(F.explode(F.array(old, F.lit(""), F.lit("{broken"), F.lit('{"time":3}'))).alias("value"), F.lit("a.json.gz").alias("file"), F.col("id").alias("place"), *dump)
    return first.union(i.select(F.explode(F.array(line)), F.lit("b.json.gz"), F.col("id"), *dump))  # as a generator's output, lines are made once


_SHARD_SQL = f"""{ITEMS_SQL},
sized as (select *, 80 + length(coalesce(author, '')) + length(coalesce(title, '')) + length(coalesce(text, '')) + length(coalesce(url, '')) as b from items),
summed as (select *, row_number() over (order by id) as rn, sum(b) over (order by id) as cum from sized),
cuts as (with recursive c as (
    select 0 as sid, cast(1 as bigint) as r0, (select min(rn) from summed where cum >= {TEST_RULES.target_bytes}) as r1
    union all select sid + 1, r1 + 1, (select min(s.rn) from summed s where s.cum >= (select cum from summed z where z.rn = c.r1) + {TEST_RULES.target_bytes})
    from c where r1 is not null and r1 < (select max(rn) from summed)) select * from c),
sharded as materialized (select cast(cuts.sid as integer) as sid, s.* from summed s join cuts on s.rn >= cuts.r0 and s.rn <= coalesce(cuts.r1, (select max(rn) from summed))),
bounds as (select sid, min(id) as id_lo, max(id) as id_hi from sharded group by sid),
ordered as (select sid, time, row_number() over (partition by sid order by time) - 1 as k, count(*) over (partition by sid) as n from sharded where time is not null),
eff as (select sid, max(time) filter (where k = cast(floor((n - 1) * cast(0.01 as double)) as bigint)) as lo, max(time) filter (where k = cast(floor((n - 1) * cast(0.99 as double)) as bigint)) as hi from ordered group by sid),
manifest as (select s.sid, min(id) as id_lo, max(id) as id_hi, min(time) as tmin, max(time) as tmax, coalesce(any_value(eff.lo), min(time)) as tmin_eff, coalesce(any_value(eff.hi), max(time)) as tmax_eff,
    count(*) filter (where time is null) as time_null, count(*) as count, cast(sum(b) as bigint) as raw_bytes_est, count(*) filter (where type <> 'comment') as posts, count(*) filter (where type = 'comment') as comments
    from sharded s left join eff on eff.sid = s.sid group by s.sid),
edges as (select sid, parent as parent_id, cast(row_number() over (partition by sid, parent order by time nulls first, id) - 1 as integer) as ord, id as child_id from sharded where parent is not null and parent <> 0),
crossing as (select distinct parent_id, edges.sid as shard_sid from edges join bounds on bounds.sid = edges.sid where parent_id < id_lo or parent_id > id_hi)
"""

_DOMAIN = r"nullif(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^.*@', ''), '^www\.', ''), '')"
_MONTH = "strftime(make_timestamp(time * 1000000), '%Y-%m')"
_USER_SQL = f"""{ITEMS_SQL},
posts as (select *, lower(trim(author)) as user_key, coalesce(score, 0) as points, coalesce(time, -4611686018427387904) as t0 from items where author is not null),
firsts as (select user_key, author as username from posts qualify row_number() over (partition by user_key order by t0, id) = 1),
bests as (select user_key, id as max_score_id, nullif(title, '') as max_score_title from posts qualify row_number() over (partition by user_key order by points desc, t0, id) = 1),
users as (select p.user_key, any_value(f.username) as username, min(nullif(time, 0)) as first_time, max(nullif(time, 0)) as last_time, count(*) as items,
    count(*) filter (where type = 'comment') as comments, count(*) filter (where type = 'story') as stories, count(*) filter (where type = 'story' and title ilike 'ask hn:%') as ask,
    count(*) filter (where type = 'story' and title ilike 'show hn:%') as show, count(*) filter (where type = 'story' and title ilike 'launch hn:%') as launch,
    count(*) filter (where type = 'job') as jobs, count(*) filter (where type = 'poll') as polls, cast(sum(points) as bigint) as sum_score, max(points) as max_score, min(points) as min_score,
    any_value(b.max_score_id) as max_score_id, any_value(b.max_score_title) as max_score_title
    from posts p join firsts f on f.user_key = p.user_key join bests b on b.user_key = p.user_key group by p.user_key),
user_domains as (select user_key, {_DOMAIN} as domain, count(*) as count from posts where url is not null and {_DOMAIN} is not null group by all),
user_months as (select user_key, {_MONTH} as month, count(*) as count from posts where nullif(time, 0) is not null group by all)
"""

_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)


def _strip(c: str) -> str:
    out = f"coalesce({c}, '')"
    for entity, char in text.ENTITIES:
        out = f"replace({out}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return rf"trim(regexp_replace(regexp_replace({out}, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"


def _ids(pattern: str) -> str:
    return f"regexp_extract_all(text || chr(10) || coalesce(url, ''), '{pattern}', 1, 'i')"


_LINK_SQL = rf"""{ITEMS_SQL},
found as (select id, unnest(list_concat(list_concat({_ids(r'https?://news\.ycombinator\.com/item\?id=([0-9]+)')}, {_ids(r'\bnews\.ycombinator\.com/item\?id=([0-9]+)')}),
    list_concat({_ids(r'href\s*=\s*["' + "'" * 2 + r']item\?id=([0-9]+)')}, {_ids(r'\bitem\?id=([0-9]{3,})\b')}))) as target from items),
raw_links as (select distinct i.id as evidence_item_id, i.id as source_item_id, i.time as source_time, i.score as source_score,
    cast(regexp_matches({_strip('i.text')}, '\b(related|past)\s*:', 'i') as integer) as has_keyword, cast(target as bigint) as target_item_id
    from items i join found on found.id = i.id where cast(target as bigint) > 0 and cast(target as bigint) <> i.id)
"""

_CHAIN_SQL = """
chain as (with recursive c as (select id, id as here, type, parent, 0 as depth from items
    union all select c.id, i.id, i.type, i.parent, depth + 1 from c join items i on i.id = c.parent where c.type <> 'story' and depth < 40) select * from c),
item_story as (select id, min(here) filter (where type = 'story') as story_id from chain group by id)
"""


def _related_sql(limit: float = 0.18, per_source: int = 5) -> str:
    return f"""{_LINK_SQL}, {_CHAIN_SQL},
resolved as (select l.*, s.story_id as source_story_id, t.story_id as target_story_id from raw_links l join item_story s on s.id = l.source_item_id join item_story t on t.id = l.target_item_id
    where s.story_id is not null and t.story_id is not null),
ends as (select source_item_id as id from raw_links union select target_item_id from raw_links),
profiled as (select distinct story_id as id from item_story where story_id is not null and id in (select id from ends)),
words as (select id, unnest(w) as w, unnest(range(1, len(w) + 1)) as p from (select i.id, string_split_regex(lower({_strip('title')} || ' ' || {_strip('text')}), '[^a-z0-9]+') as w from items i join profiled using (id))),
firsts as (select id, w, min(p) as p from words where length(w) >= 3 and w not in ({_STOP}) and not regexp_full_match(w, '[0-9]+') group by all),
kept as (select id, w from firsts qualify row_number() over (partition by id order by p) <= 96),
tokens as materialized (select p.id, coalesce(list_sort(list(w) filter (where w is not null)), []) as tokens from profiled p left join kept k using (id) group by p.id),
up as (with recursive u as (select i.id, i.parent as here from items i where type = 'comment' union all
    select u.id, i.parent from u join items i on i.id = u.here where u.here not in (select id from profiled)) select * from u),
comment_totals as (select p.id, count(u.id) as comment_total from profiled p left join up u on u.here = p.id group by p.id),
pairs as (select distinct evidence_item_id, source_story_id, target_story_id from resolved where source_story_id <> target_story_id),
heads as (select evidence_item_id, source_story_id, max(source_time) as source_time, max(has_keyword) as has_keyword from resolved group by all),
sims as (select p.*, a.tokens as st, b.tokens as tt,
    case when len(a.tokens) > 0 and len(b.tokens) > 0 then len(list_intersect(a.tokens, b.tokens)) / cast(len(a.tokens) + len(b.tokens) - len(list_intersect(a.tokens, b.tokens)) as double) else 0 end as sim
    from pairs p join tokens a on a.id = p.source_story_id join tokens b on b.id = p.target_story_id where len(a.tokens) > 0),
cons as (select x.evidence_item_id, x.source_story_id, avg(case when len(x.tt) > 0 and len(y.tt) > 0 then len(list_intersect(x.tt, y.tt)) / cast(len(x.tt) + len(y.tt) - len(list_intersect(x.tt, y.tt)) as double) else 0 end) as c
    from sims x join sims y on x.evidence_item_id = y.evidence_item_id and x.source_story_id = y.source_story_id and x.target_story_id < y.target_story_id group by all),
agg as (select s.evidence_item_id, s.source_story_id, avg(sim) as align, count(*) as n from sims s group by all),
bases as (select g.*, h.source_time, coalesce(c.c, g.align) as consistency,
    (cast(0.55 as double) * align + cast(0.45 as double) * coalesce(c.c, align) + case when h.has_keyword > 0 then cast(0.15 as double) else 0 end)
    * least(greatest(cast(0.35 as double) + 2 * coalesce(c.c, align), cast(0.35 as double)), 1) * case when n > 8 then cast(8 as double) / n else 1 end as base
    from agg g join heads h using (evidence_item_id, source_story_id) left join cons c using (evidence_item_id, source_story_id)),
edge_scores as (select source_story_id, target_story_id, sum(w) as weight, max(align) as source_align, max(consistency) as self_consistency, count(*) as evidence_count, max(source_time) as last_time
    from (select s.source_story_id, s.target_story_id, base * (cast(0.6 as double) + cast(0.4 as double) * sim) as w, align, consistency, source_time from sims s join bases b using (evidence_item_id, source_story_id) where base > 0.01)
    where w > 0.001 group by all),
pruned as materialized (select source_story_id, target_story_id, weight, evidence_count, last_time from edge_scores where weight >= cast({limit} as double)
    qualify row_number() over (partition by source_story_id order by weight desc, evidence_count desc, coalesce(last_time, 0) desc, target_story_id desc) <= {per_source}),
links as (select source_story_id as a, target_story_id as b from pruned union select target_story_id, source_story_id from pruned),
reach as (with recursive r as (select a, a as b from links union select r.a, l.b from r join links l on r.b = l.a) select * from r),
parts as materialized (select a as story_id, min(b) as component_id from reach group by a),
profile as (select p.id as story_id, i.title, i.author, i.time, i.score, i.url, coalesce(c.comment_total, 0) as comment_total from profiled p left join items i using (id) left join comment_totals c using (id)),
incoming as (select target_story_id as story_id, count(*) as incoming_link_count, cast(sum(evidence_count) as bigint) as total_evidence_count from pruned group by all),
member as (select p.component_id, p.story_id, coalesce(time, 0) as t, coalesce(score, 0) as s, comment_total as c, coalesce(incoming_link_count, 0) as k, title, author, time, score, url
    from parts p left join profile using (story_id) left join incoming using (story_id)),
roots as (select component_id, story_id as root_story_id from member qualify row_number() over (partition by component_id order by t // 86400 desc, s desc, t desc, story_id desc) = 1),
component_index as materialized (select m.component_id, any_value(root_story_id) as root_story_id, count(*) as member_count,
    (select count(*) from pruned join parts on parts.story_id = source_story_id where parts.component_id = m.component_id) as edge_count,
    ceil(sum(s) + sum(c) * cast(2.718 as double)) as rank_score, max(t) as latest_time, max(s) as max_story_score, cast(sum(s) as bigint) as story_points_sum, cast(sum(c) as bigint) as comment_count,
    cast(sum(k) as bigint) as incoming_link_count, string_agg(distinct year(make_timestamp(t * 1000000)) :: varchar, ',' order by year(make_timestamp(t * 1000000)) :: varchar desc) filter (where t > 0) as years_csv
    from member m join roots using (component_id) group by m.component_id having count(*) >= 2)
"""


#: Rotation of the test data's component shards.
_ROTATE = related.Config(components_per_shard=40, target_bytes=12_000, least_components=15, look_every=10)


def _ranked(spark, d):
    r = _related(spark, d)
    return related.ranked(r.index, related.component_bytes(r.index, r.members(), r.component_links()), _ROTATE).select("component_id", "rank", "bytes", "sid")


def _places(df: DataFrame, order: tuple, *ids: str) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy("component_id").orderBy(*order))).select("component_id", *ids, "place")


def _rotation_sql(source: str, size: str, every: int, target: int, least: int, most: int) -> str:
    """placed-like common table expressions: source (with rank) with sid, by the greedy rule over blocks."""
    return f"""blocks as (select (rank - 1) // {every} as block, count(*) as n, sum({size}) as held from {source} group by 1),
walk as (with recursive w as (select cast(0 as bigint) as block, cast(0 as bigint) as sid, n, held from blocks where block = 0
    union all select b.block, w.sid + cast(w.n >= {most} or (w.held >= {target} and w.n >= {least}) as bigint),
        case when w.n >= {most} or (w.held >= {target} and w.n >= {least}) then b.n else w.n + b.n end, case when w.n >= {most} or (w.held >= {target} and w.n >= {least}) then b.held else w.held + b.held end
    from w join blocks b on b.block = w.block + 1) select block, cast(sid as integer) as sid from w)"""


_USER_SHARDS_SQL = f""", user_sizes as (select user_key, 128 + strlen(username) + coalesce(strlen(max_score_title), 0)
    + coalesce((select sum(16 + strlen(domain)) from user_domains d where d.user_key = u.user_key), 0) + coalesce((select sum(16 + strlen(month)) from user_months m where m.user_key = u.user_key), 0) as bytes from users u),
ranks as (select *, row_number() over (order by user_key) as rank from user_sizes),
{_rotation_sql("ranks", "bytes", _USER_EVERY, _USER_TARGET, 0, 1 << 60)},
placed as (select r.*, walk.sid from ranks r join walk on walk.block = (r.rank - 1) // {_USER_EVERY})
"""

_STRENGTH_SQL = """, strong as (select component_id, story_id, time, score, (select coalesce(sum(weight), 0) from (select source_story_id as x, weight from pruned union all select target_story_id, weight from pruned) where x = story_id) as rel_score from member)
"""

_RANKED_SQL = f""", own_sizes as (select m.component_id, 128 + sum(48 + coalesce(strlen(title), 0) + coalesce(strlen(author), 0) + coalesce(strlen(url), 0)) as own from member m group by 1),
counted as (select p.component_id, 40 * count(*) as links from pruned join parts p on p.story_id = source_story_id group by 1),
ranks as (select c.component_id, row_number() over (order by rank_score desc, latest_time desc, c.component_id desc) as rank, cast(s.own + coalesce(l.links, 0) as bigint) as bytes
    from component_index c join own_sizes s using (component_id) left join counted l using (component_id)),
{_rotation_sql("ranks", "bytes", _ROTATE.look_every, _ROTATE.target_bytes, _ROTATE.least_components, _ROTATE.components_per_shard)},
rotated as (select r.*, walk.sid from ranks r join walk on walk.block = (r.rank - 1) // {_ROTATE.look_every})
"""

#: The days, rows and bytes after which test shards end where all rules are tried.
_DAY_RULES = shard.CutRules(target_bytes=8 << 20, max_bytes=16 << 20, max_rows=3000, max_days=2)
_DAY_SQL = f""", numbered as materialized (select id, time, row_number() over (order by id) as rn, sum(80 + length(coalesce(author, '')) + length(coalesce(title, '')) + length(coalesce(text, '')) + length(coalesce(url, ''))) over (order by id) as cum from items),
cuts as (with recursive w as (select cast(-1 as bigint) as sid, cast(0 as bigint) as upto
    union all select w.sid + 1, (
      select coalesce(min(x.rn), (select max(rn) from numbered)) from (
        select n.rn, n.cum, list(n.time) filter (where n.time is not null) over (order by n.rn) as ts from numbered n where n.rn > w.upto and n.rn <= w.upto + {_DAY_RULES.max_rows}) x
      where x.cum - coalesce((select cum from numbered z where z.rn = w.upto), 0) >= {_DAY_RULES.target_bytes} or x.rn - w.upto >= {_DAY_RULES.max_rows}
        or (len(x.ts) > 0 and (list_max(x.ts) - list_min(x.ts)) // 86400 >= {_DAY_RULES.max_days}
          and (len(x.ts) < {_DAY_RULES.robust_from} or (list_sort(x.ts)[cast(floor((len(x.ts) - 1) * cast({_DAY_RULES.high} as double)) as bigint) + 1] - list_sort(x.ts)[cast(floor((len(x.ts) - 1) * cast({_DAY_RULES.low} as double)) as bigint) + 1]) // 86400 >= {_DAY_RULES.max_days})))
    from w where w.upto < (select max(rn) from numbered)) select * from w)
select cast(a.sid as integer) as sid, min(n.id) as id_lo, max(n.id) as id_hi from cuts a join numbered n on n.rn <= a.upto and n.rn > (select b.upto from cuts b where b.sid = a.sid - 1) where a.sid >= 0 group by a.sid
"""


def _fn_spark(spark, d):
    i = _items(spark, d)
    return i.select(
        "id", scalar.domain(F.col("url")).alias("host"), scalar.month_key(F.col("time")).alias("month"), scalar.day_end(F.col("time")).alias("day_end"), scalar.iso_time(F.col("time")).alias("iso"), scalar.channel(F.col("type"), F.col("title")).alias("channel"),
        scalar.user_key(F.col("author")).alias("user_key"), scalar.short_hash(F.coalesce("text", F.lit(""))).alias("hash"), text.raw_bytes().alias("raw_bytes"), F.length(text.flatten(F.col("text"))).cast("bigint").alias("flat_chars"),
        F.round(scalar.span_days(F.col("parent"), F.col("id")), 6).alias("span_days"), scalar.human_delta(F.col("id") * 37 - 100000).alias("delta"),
    )


def _hundredths(unit: int) -> str:
    n = f"cast(floor(abs(id * 37 - 100000) / cast({unit} as double) * 100 + 0.5) as bigint)"
    return f"({n} // 100) || '.' || lpad(cast({n} % 100 as varchar), 2, '0')"


_FN_SQL = rf"""with {ITEMS_SQL}
select id, {_DOMAIN} as host, case when nullif(time, 0) is not null then {_MONTH} end as month, time // 86400 * 86400 + 86399 as day_end, coalesce(strftime(make_timestamp(time * 1000000), '%Y-%m-%dT%H:%M:%SZ'), 'n/a') as iso,
  case when type = 'job' then 'jobs' when type <> 'story' then null when title ilike 'ask hn:%' then 'ask' when title ilike 'show hn:%' then 'show' when title ilike 'launch hn:%' then 'launch' else 'story' end as channel,
  lower(trim(coalesce(author, ''))) as user_key, left(sha256(text), 12) as hash,
  80 + length(coalesce(author, '')) + length(coalesce(title, '')) + length(text) + length(coalesce(url, '')) as raw_bytes,
  case when length(trim(regexp_replace(text, '\s+', ' ', 'g'))) > 240 then 243 else length(trim(regexp_replace(text, '\s+', ' ', 'g'))) end as flat_chars,
  round((id - parent) / cast(86400 as double), 6) as span_days,
  case when id * 37 < 100000 then '-' else '' end || case when abs(id * 37 - 100000) >= 86400 then {_hundredths(86400)} || ' days' when abs(id * 37 - 100000) >= 3600 then {_hundredths(3600)} || ' hours'
    when abs(id * 37 - 100000) >= 60 then {_hundredths(60)} || ' minutes' else cast(abs(id * 37 - 100000) as varchar) || ' sec' end as delta
from items"""

_WIDE = related.Config(min_edge_weight=0.05, max_edges_per_source=2)
_RANGE = "author = 'user7' and time between 1704240000 and 1705881600"
_POINT, _PARENT = 4242, 1


def _entries() -> dict:
    """name: (query, SQL or None)."""
    i, e, m = _items, _edges, _manifest
    plain = f"with {ITEMS_SQL} "
    sh, us = f"with {_SHARD_SQL} ", f"with {_USER_SQL} "
    rel = f"with {_related_sql()} "
    short = ["id", "title", "author", "time", "score"]
    scores = ("weight", "source_align", "self_consistency")
    rel_cols = "component_id, root_story_id, member_count, edge_count, rank_score, latest_time, max_story_score, story_points_sum, comment_count, incoming_link_count, years_csv"
    return {
        "src1_ingest_lines": (lambda s, d: ingest.latest(ingest.parse_lines(_lines(s, d))).drop("kids", "descendants"), plain + "select *, 0 as dead, 0 as deleted from (select id, time, type, author, title, text, url, score, parent from items)"),
        "src4_ordered_scan": (_ordered, plain + "select * from items"),
        "src8_export": (lambda s, d: ingest.exportable(i(s, d).withColumn("deleted", (F.col("id") % 13 == 0).cast("int"))), plain + "select * from items where not id % 13 = 0"),
        "prj_scalar_functions": (_fn_spark, _FN_SQL),
        "flt1_with_parent": (lambda s, d: edges.with_parent(i(s, d)).select("id", "parent"), plain + "select id, parent from items where parent is not null and parent <> 0"),
        "flt7_point_lookup": (lambda s, d: adapter.item(s, d, _POINT), plain + f"select * from items where id = {_POINT}"),
        "flt7_user_lookup": (lambda s, d: catalog.user(_users(s, d).drop("avg_score"), "USER7"), us + "select * from users where user_key = 'user7'"),
        "flt7_children": (lambda s, d: catalog.children(e(s, d), _PARENT), sh + f"select * from edges where parent_id = {_PARENT}"),
        "src11_author_scan": (lambda s, d: catalog.author_scan(i(s, d).select("id", "author", "time"), "USER2", "user30"), plain + "select id, author, time from items where lower(author) >= 'user2' and lower(author) < 'user30'"),
        "flt8_author_range": (lambda s, d: catalog.author_range(i(s, d), "user7", 1704240000, 1705881600), plain + f"select * from items where {_RANGE}"),
        "flt9_last_day": (lambda s, d: catalog.last_day(i(s, d)), plain + "select * from items where type = 'story' and time >= (select max(time) from items) - 86400"),
        "flt10_ask": (lambda s, d: catalog.titled(i(s, d), "Ask HN:").select(short), plain + "select id, title, author, time, score from items where type = 'story' and title ilike 'Ask HN:%'"),
        "flt10_show": (lambda s, d: catalog.titled(i(s, d), "Show HN:").select(short), plain + "select id, title, author, time, score from items where type = 'story' and title ilike 'Show HN:%'"),
        "uiq1_stories_per_author": (lambda s, d: catalog.stories_per_author(i(s, d)), plain + "select author, count(*) as stories from items where type = 'story' group by author order by stories desc, author nulls first limit 50"),
        "uiq2_users_per_domain": (lambda s, d: catalog.users_per_domain(users.user_domains(i(s, d))), us + "select domain, count(distinct user_key) as users from user_domains group by domain"),
        "uiq3_activity_per_month": (lambda s, d: catalog.activity_per_month(users.user_months(i(s, d))), us + "select month, cast(sum(count) as bigint) as active from user_months group by month"),
        "uiq4_child_counts": (lambda s, d: catalog.child_counts(e(s, d)), sh + "select parent_id, count(*) as cnt from edges group by parent_id"),
        "joi1_comments_per_item": (lambda s, d: catalog.comments_per_item(e(s, d), i(s, d)), sh + "select parent_id as id, any_value(i.title) as title, count(*) as comments from edges join items i on i.id = parent_id group by parent_id"),
        "top1_by_score": (lambda s, d: catalog.top(i(s, d).where("type = 'story'").select(short), [F.desc("score"), "id"], 30), plain + "select id, title, author, time, score from items where type = 'story' order by score desc nulls last, id limit 30"),
        "top1_by_time": (lambda s, d: catalog.top(i(s, d).where("type = 'story'").select(short), [F.desc("time"), "id"], 50), plain + "select id, title, author, time, score from items where type = 'story' order by time desc nulls last, id limit 50"),
        "top2_users_by_score": (lambda s, d: catalog.top(_users(s, d).select("username", "user_key", "max_score"), [F.desc("max_score"), "user_key"], 30), us + "select username, user_key, max_score from users order by max_score desc, user_key limit 30"),
        "top3_user_domains": (lambda s, d: catalog.top_per_user(users.user_domains(i(s, d)), "domain"), us + "select *, cast(row_number() over (partition by user_key order by count desc, domain) as integer) as rn from user_domains qualify rn <= 8"),
        "top3_user_months": (lambda s, d: catalog.top_per_user(users.user_months(i(s, d)), "month"), us + "select *, cast(row_number() over (partition by user_key order by count desc, month) as integer) as rn from user_months qualify rn <= 8"),
        "smp1_sample": (lambda s, d: catalog.sample(i(s, d).select("id"), 100), plain + "select id from items order by md5('0#' || id), id limit 100"),
        "usr1_user_stats": (lambda s, d: _rounded(_users(s, d), "avg_score"), us + "select *, round(sum_score / cast(items as double), 9) as avg_score from users"),
        "usr2_user_domains": (lambda s, d: users.user_domains(i(s, d)), us + "select * from user_domains"),
        "usr3_user_months": (lambda s, d: users.user_months(i(s, d)), us + "select * from user_months"),
        "usr4_user_shards": (lambda s, d: users.user_bounds(_user_shards(s, d)), us + _USER_SHARDS_SQL + "select sid, min(user_key) as user_lo, max(user_key) as user_hi, count(*) as users, cast(sum(bytes) as bigint) as bytes from placed group by sid"),
        "g1_user_growth": (lambda s, d: users.user_growth(_users(s, d)), us + "select month, new_users, cast(sum(new_users) over (order by month) as bigint) as total_users from (select strftime(make_timestamp(first_time * 1000000), '%Y-%m') as month, count(*) as new_users from users where first_time is not null group by 1)"),
        "g2_active_users": (lambda s, d: users.active_users(users.user_months(i(s, d))), us + "select month, count(*) as active from user_months group by month"),
        "shard_bounds": (_bounds, sh + "select * from bounds"),
        "shard_day_rule": (lambda s, d: shard.shard_bounds(_items(s, d), _DAY_RULES), f"with {ITEMS_SQL}" + _DAY_SQL),
        "man1_manifest": (m, sh + "select * from manifest"),
        "arc1_posts_comments": (lambda s, d: m(s, d).select("sid", "count", "posts", "comments"), sh + "select sid, count, posts, comments from manifest"),
        "arc2_effective_time": (lambda s, d: m(s, d).select("sid", "tmin_eff", "tmax_eff", "time_null"), sh + "select sid, tmin_eff, tmax_eff, time_null from manifest"),
        "arc3_totals": (lambda s, d: shard.totals(m(s, d)), sh + "select cast(sum(count) as bigint) as items, cast(sum(posts) as bigint) as posts, cast(sum(comments) as bigint) as comments, cast(sum(raw_bytes_est) as bigint) as bytes, count(*) as shards, max(tmax) as snapshot_time from manifest"),
        "edge_children": (e, sh + "select * from edges"),
        "joi2_route_ids": (lambda s, d: _sharded(s, d).select("id", "sid"), sh + "select id, sid from sharded"),
        "joi4_route_times": (lambda s, d: shard.route_times(m(s, d), 1704672000, 1705276800).select("sid"), sh + "select sid from manifest where tmin_eff <= 1705276800 and tmax_eff >= 1704672000"),
        "joi5_cross_links": (_cross, sh + "select * from crossing"),
        "cli6_skipped_edges": (lambda s, d: edges.skipped(e(s, d), _bounds(s, d), i(s, d)).select("parent_id", "child_id", "parent_sid", "child_sid", "seconds"), sh + "select e.parent_id, e.child_id, b.sid as parent_sid, e.sid as child_sid, c.time - p.time as seconds from edges e join bounds b on e.parent_id between b.id_lo and b.id_hi and b.sid <> e.sid join items p on p.id = e.parent_id join items c on c.id = e.child_id"),
        "joi3_route_users": (_route_users, us + _USER_SHARDS_SQL + "select upper(user_key) as user, sid from placed"),
        "api1_bound_sql": (lambda s, d: Database(s, items=i(s, d)).query("select type, count(*) as n from {items} where score > :low group by type", {"low": 100}), plain + "select type, count(*) as n from items where score > 100 group by type"),
        "crs1_cross_counts": (lambda s, d: _cross(s, d).agg(F.count("*").alias("links"), F.countDistinct("parent_id").alias("parents")), sh + "select count(*) as links, count(distinct parent_id) as parents from crossing"),
        "crs2_compressed_rows": (lambda s, d: edges.compressed_rows(_cross(s, d)).select("parent_id", F.array_join("sids", ",").alias("sids"), "offset"), sh + "select parent_id, string_agg(shard_sid, ',' order by shard_sid) as sids, cast(sum(count(*)) over (order by parent_id) - count(*) as bigint) as offset from crossing group by parent_id"),
        "joi14_threads": (lambda s, d: edges.thread(e(s, d), _cross(s, d), _bounds(s, d), i(s, d).select(F.col("id").alias("parent_id"))), sh + "select parent_id, sid, ord, child_id from edges where parent_id in (select id from items)"),
        "top4_order_statistic": (lambda s, d: m(s, d).select("sid", "tmin_eff"), sh + "select sid, tmin_eff from manifest"),
        "htm_strip": (lambda s, d: i(s, d).select("id", F.md5(text.strip_html(F.col("text")).cast("binary")).alias("plain")), plain + f"select id, md5({_strip('text')}) as plain from items"),
        "kwd_related": (lambda s, d: i(s, d).select("id", text.has_related_keyword(F.col("text")).alias("keyword")), plain + rf"select id, cast(regexp_matches({_strip('text')}, '\b(related|past)\s*:', 'i') as integer) as keyword from items"),
        "lnk_raw_links": (lambda s, d: _related(s, d).links, f"with {_LINK_SQL} select * from raw_links"),
        "gra1_story_of_item": (lambda s, d: ancestors.story_of_item(i(s, d).select("id", "type", "parent")), f"with {ITEMS_SQL}, {_CHAIN_SQL} select * from item_story"),
        "tok_profiles": (lambda s, d: _related(s, d).profiles.select("story_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n")), rel + "select id as story_id, array_to_string(tokens, ' ') as tokens, cast(len(tokens) as integer) as n from tokens"),
        "cmt1_comment_totals": (lambda s, d: _related(s, d).totals, rel + "select * from comment_totals"),
        "relg_evidence": (lambda s, d: related.evidence(_related(s, d).resolved).withColumn("targets", F.array_join("targets", ",")), rel + "select evidence_item_id, source_story_id, max(source_time) as source_time, max(source_score) as source_score, max(has_keyword) as has_keyword, string_agg(distinct target_story_id, ',' order by target_story_id) as targets from resolved group by all"),
        "sco_edge_scores": (lambda s, d: _rounded(_related(s, d).scores, *scores), rel + "select source_story_id, target_story_id, round(weight, 9) as weight, round(source_align, 9) as source_align, round(self_consistency, 9) as self_consistency, evidence_count, last_time from edge_scores"),
        "prn_pruned": (lambda s, d: _rounded(_related(s, d).pruned, "weight"), rel + "select * replace (round(weight, 9) as weight) from pruned"),
        "prn_pruned_wide": (lambda s, d: _rounded(related.prune(_related(s, d).scores, _WIDE), "weight"), f"with {_related_sql(0.05, 2)} select * replace (round(weight, 9) as weight) from pruned"),
        "cc_components": (lambda s, d: _related(s, d).parts, rel + "select * from parts"),
        "relr_story_strength": (lambda s, d: _rounded(related.story_strength(_related(s, d).pruned), "rel_score"), rel + "select story_id, round(sum(weight), 9) as rel_score from (select source_story_id as story_id, weight from pruned union all select target_story_id, weight from pruned) group by all"),
        "reli_incoming": (lambda s, d: related.incoming(_related(s, d).pruned), rel + "select * from incoming"),
        "relc_component_index": (lambda s, d: _related(s, d).index, rel + f"select {rel_cols} from component_index"),
        "rnkl_legacy_rank": (lambda s, d: _rounded(related.component_index(_related(s, d).parts, _related(s, d).pruned, _related(s, d).profiles, _related(s, d).totals, related.Config(rank_model="legacy")), "rank_score").select("component_id", "rank_score"), rel + "select component_id, round(max_story_score * cast(0.7 as double) + latest_time * cast(0.000001 as double) * cast(0.3 as double) + member_count * 2 + edge_count * cast(0.5 as double), 9) as rank_score from component_index"),
        "relm_members": (lambda s, d: _rounded(_related(s, d).members(), "rel_score"), rel + "select component_id, story_id, round((select coalesce(sum(weight), 0) from (select source_story_id as x, weight from pruned union all select target_story_id, weight from pruned) where x = story_id), 9) as rel_score, title, author, time, score, url from member"),
        "rell_links": (lambda s, d: _rounded(_related(s, d).component_links(), "weight"), rel + "select source_story_id, target_story_id, round(weight, 9) as weight, evidence_count, last_time, component_id from pruned join parts on parts.story_id = source_story_id"),
        "snk12_ranked": (_ranked, rel + _RANKED_SQL + "select component_id, rank, bytes, sid from rotated"),
        "srt2_member_order": (lambda s, d: _places(_related(s, d).members(), related.member_order(), "story_id"), rel + _STRENGTH_SQL + "select component_id, story_id, cast(row_number() over (partition by component_id order by rel_score desc, coalesce(score, 0) desc, coalesce(time, 0) desc, story_id desc) as integer) as place from strong"),
        "srt2_link_order": (lambda s, d: _places(_related(s, d).component_links(), related.link_order(), "source_story_id", "target_story_id"), rel + "select component_id, source_story_id, target_story_id, cast(row_number() over (partition by component_id order by weight desc, evidence_count desc, coalesce(last_time, 0) desc, source_story_id, target_story_id) as integer) as place from pruned join parts on parts.story_id = source_story_id"),
        "srt4_by_comments": (lambda s, d: related.listed(_related(s, d).index, "comments", 25).select("component_id", "comment_count"), rel + "select component_id, comment_count from component_index order by comment_count desc, latest_time desc, component_id desc limit 25"),
        "srt4_by_points": (lambda s, d: related.listed(_related(s, d).index, "points", 25).select("component_id", "story_points_sum"), rel + "select component_id, story_points_sum from component_index order by story_points_sum desc, latest_time desc, component_id desc limit 25"),
        "srt4_by_discussions": (lambda s, d: related.listed(_related(s, d).index, "discussions", 25).select("component_id", "member_count"), rel + "select component_id, member_count from component_index order by member_count desc, rank_score desc, component_id desc limit 25"),
        "srt4_by_recent": (lambda s, d: related.listed(_related(s, d).index, "recent", 25).select("component_id", "latest_time"), rel + "select component_id, latest_time from component_index order by latest_time // 86400 desc, story_points_sum desc, component_id desc limit 25"),
        "srt5_timeline": (lambda s, d: catalog.timeline(_related(s, d).members()), rel + "select component_id, story_id, cast(row_number() over (partition by component_id order by t // 86400, s desc, story_id) as integer) as n from member"),
        "flt11_years": (lambda s, d: catalog.in_years(_related(s, d).index, 2024, 1999).select("component_id"), rel + "select component_id from component_index where years_csv like '%2024%' or years_csv like '%1999%'"),
        "bkl_backlinks": (lambda s, d: _related(s, d).backlinks(), rel + "select cast(row_number() over (order by incoming_link_count desc, coalesce(score, 0) desc, coalesce(time, 0) desc, story_id desc) as integer) as rank, story_id, title, author, time, score, url, incoming_link_count from incoming join profile using (story_id)"),
    } | examples.entries(plain)


def queries() -> dict:
    return {name: query for name, (query, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _entries().items() if sql}
