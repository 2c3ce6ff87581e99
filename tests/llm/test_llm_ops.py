"""Each operator on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, further columns; against brute force."""

import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("threadloom.llm")

from pyspark.sql import functions as F  # noqa: E402

from threadloom.llm import bpe, chat, decontaminate, fingerprint, minhash, quality, sharding, substring, toxicity, warc, words  # noqa: E402

DOC = "doc_id long, text string, lang string, source string, n_chars long"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOC)


def odd(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, a further column with a name of a result."""
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t", "en", "s", 3), (4, "word", "en", "s", 4), (None, "no id here", None, None, None), (5, "x " * 30_000, "en", "s", 60_000), (6, "same text of five words", "en", "s", 0), (6, "same text of five words", "en", "s", 0), (7, "é" * 5000, "fr", "s", 1)]
    return spark.createDataFrame(rows, DOC).withColumn("score", F.lit("clash")).withColumn("component_id", F.lit(1))


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


# 1
def brute_components(rows, k):
    sets = [words.shingles(words.hashes(words.split(t, True)), k) for _, t in rows]
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i]) and len(sets[j]):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    a, b = root(rows[i][0]), root(rows[j][0])
                    parent[max(a, b)] = min(a, b)
    return {d: root(d) for d, _ in rows}


@pytest.mark.parametrize("block", [2048, 16])
def test_minhash_finds_all_components(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    random.seed(block)
    vocabulary = [f"w{i}" for i in range(2000)]

    def changed(base, p):
        return " ".join(random.choice(vocabulary) if random.random() < p else w for w in base)

    texts = []
    for size in (40, 150, 300):
        base = [random.choice(vocabulary) for _ in range(size)]
        texts += [changed(base, random.choice([0.01, 0.04, 0.08])) for _ in range(40)] + [" ".join(base)] * 3
    common = " ".join(random.choice(vocabulary) for _ in range(60))
    texts += [" ".join(random.choice(vocabulary) for _ in range(30)) + " " + common for _ in range(40)] + [None, "", "A", "a", "B c"]
    random.shuffle(texts)
    out = {r.doc_id: r for r in minhash.near_duplicates(docs(spark, texts), 2).collect()}
    want = brute_components(list(enumerate(texts)), 2)
    assert {d: r.component_id for d, r in out.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.values())


def test_minhash_odd_rows(spark):
    out = minhash.near_duplicates(odd(spark), 5).collect()
    assert len(out) == 9 and sum(r.n_shingles == 0 for r in out) == 3
    assert [r.component_id for r in out if r.doc_id == 6] == [6, 6]
    assert minhash.near_duplicates(odd(spark).where("false"), 5).count() == 0


def test_minhash_repeated_ids(spark):
    def text(name, last=""):
        return " ".join(f"{name}{i}" for i in range(40)) + last

    rows = [(1, text("a")), (2, text("b")), (5, text("a", " end")), (5, text("c")), (6, text("c", " end")), (7, text("d")), (7, text("d")), (7, ""), (7, text("b")), (9, text("c")), (8, text("e")), (8, text("f")), (None, text("a"))]
    table = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOC)
    out = minhash.near_duplicates(table, 2).collect()
    want = {1: 1, 2: 2, 5: 1, 6: 1, 7: 2, 8: 8, 9: 1, None: None}  # 5 joins a and c, 7 joins b and d
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in out) == sorted((i or 0, want[i] or 0) for i, _ in rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in out)
    assert sorted(r.n_shingles for r in out) == sorted(40 if t.endswith("end") else 39 if t else 0 for _, t in rows)


def test_probability_of_a_lost_link():
    """What the docstring says of pairs at the threshold: no band in common, or too few equal coordinates."""
    from math import comb

    s = 0.8
    assert (1 - s**minhash.ROWS) ** minhash.BANDS < 3e-6
    few = sum(comb(minhash.K, k) * s**k * (1 - s) ** (minhash.K - k) for k in range(round(minhash.LEAST * minhash.K)))
    assert few < 3e-6


def test_circulant_signature_estimates_jaccard():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2500])
    estimate = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(estimate - 1500 / 2500) < 0.15


# 2
def test_fingerprints(spark):
    texts = ["a b c d e f g " * 40, "a b c d e f g " * 40, "x y", None, "", "𝔘é " + "q " * 9]
    rows = {r.doc_id: r for r in fingerprint.fingerprints(docs(spark, texts)).collect()}
    assert rows[0].fingerprint == rows[1].fingerprint and rows[3].fingerprint == rows[4].fingerprint
    order = sorted(rows, reverse=True)
    for i, d in enumerate(order):
        text, following = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        assert rows[d].n_chars == len(text) and rows[d].edited_sha256 == sha(edited)
        assert 0 <= rows[d].near_edited <= 1 and 0 <= rows[d].near_next <= 1
    assert rows[1].near_next == 1.0 and rows[4].near_next == 1.0
    assert fingerprint.fingerprints(odd(spark)).count() == 9 and fingerprint.fingerprints(odd(spark).where("false")).count() == 0


def brute_sketch(text):
    w = BLANK.findall(text or "")
    shingles = {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return hashlib.md5(" ".join(w).encode()).hexdigest(), sorted(h for h in (hashlib.md5(x.encode()).hexdigest()[:16] for x in shingles) if int(h, 16) < 1 << 63)


def brute_likeness(a, b):
    x, y = set(a[1]), set(b[1])
    return len(x & y) / len(x | y) if x | y else float(a[0] == b[0])


def test_fingerprints_equal_brute_force(spark):
    random.seed(2)
    texts = [" ".join(random.choice("abcdef") for _ in range(random.choice([0, 1, 3, 5, 6, 20, 300]))) + random.choice(["", " \n", "\tz"]) for _ in range(60)] + [None, "", " \x0b", "漢 é 𝔘 " * 9]
    ids = [random.choice([None, 5, 5, 7, *range(100, 140)]) for _ in texts]
    table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in zip(ids, texts, strict=True)], DOC).withColumn("sketch", F.lit(1))
    rows = sorted(zip(ids, texts, strict=True), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()), reverse=True)
    want = []
    for at, (d, text) in enumerate(rows):
        text, following = text or "", rows[(at + 1) % len(rows)][1] or ""
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        own, changed, after = map(brute_sketch, (text, edited, following))
        want.append((d, len(text), sha(edited), f"{own[0]}:{','.join(own[1])}", f"{changed[0]}:{','.join(changed[1])}", brute_likeness(own, changed), brute_likeness(own, after)))
    got = fingerprint.fingerprints(table)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_fingerprint_ranges_divide_hot_ids(spark):
    bounds = fingerprint._bounds([1, 5, 5, 5, 9])
    assert [b[0] for b in bounds] == [1, 5, 5, 5, 9] and bounds[1][1] == 0 < bounds[2][1] < bounds[3][1]
    hot = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    sizes = [r["count"] for r in fingerprint.with_next(hot).where("not copy").groupBy("bucket").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 800


def test_sketches_estimate_containment(spark):
    big = " ".join(f"t{i}" for i in range(8000))
    small = " ".join(f"t{i}" for i in range(1000, 2000))
    s = fingerprint.with_sketch(docs(spark, [big, small]), "text", "k")
    a, b = F.col("a"), F.col("b")
    row = s.where("doc_id = 1").select(F.col("k").alias("a")).crossJoin(s.where("doc_id = 0").select(F.col("k").alias("b"))).select(
        fingerprint.containment(a, b).alias("c"), fingerprint.likeness(a, b).alias("j"), fingerprint.cardinality(b).alias("n"), (fingerprint.merge(a, b)["hashes"] == b["hashes"]).alias("within")).first()
    assert row.c == 1 and row.within and abs(row.j - 996 / 7996) < 0.02 and abs(row.n - 7996) < 500


# 3
def test_wand_returns_all_above_threshold():
    random.seed(4)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(random.randint(1, 40)))) for i in range(300)]
    index = decontaminate.Index(items)
    for _ in range(100):
        terms = sorted({index.term[t] for t in random.sample(vocabulary, random.randint(1, 50)) if t in index.term})
        scores = np.zeros(len(index.item_of))
        for t in terms:
            scores[index.docs[t]] += index.impacts[t]
        for limit in (0.5, 0.2):
            assert sorted(d for d, _ in index.search(terms, limit)) == np.flatnonzero(scores >= limit - 1e-9).tolist()


def test_decontamination(spark):
    random.seed(9)
    vocabulary = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(30)) + ". " + " ".join(random.choice(vocabulary) for _ in range(8)) + ".") for i in range(40)] + [(98, None), (99, "")]
    noise = [" ".join(random.choice(vocabulary) for _ in range(400)) for _ in range(30)]
    question_only = items[3][1].split(". ")[0]
    texts = noise + [noise[0] + " " + items[5][1].upper() + " " + noise[1], noise[2] + " " + question_only, None, ""]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs(spark, texts), benchmark).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(30, 5)]
    assert sorted(r.doc_id for r in decontaminate.without_benchmark(docs(spark, texts), benchmark).collect()) == [i for i in range(34) if i != 30]
    assert decontaminate.without_benchmark(odd(spark), benchmark.where("false")).count() == 9
    assert decontaminate.contaminated(odd(spark), benchmark).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    items = [(i, " ".join(f"i{i}w{j}" for j in range(20)) + ". yes it is.") for i in range(12)]
    found = decontaminate.contaminated(docs(spark, [items[7][1], items[2][1]]), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(0, 7), (1, 2)]


def test_items_without_id_and_blocks_of_the_filter(spark, monkeypatch):
    items = [(i if i > 1 else (None, -1)[i], " ".join(f"i{i}w{j}" for j in range(20)) + ". yes it is.") for i in range(12)] + [(5, " ".join(f"again{j}" for j in range(20)) + ". yes it is.")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [items[0][1], items[1][1], items[12][1], "nothing " * 30, None, items[7][1]]
    for size in (1 << 20, 200):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(spark, texts), benchmark).collect()) == [(0, None), (1, -1), (2, 5), (5, 7)]
        assert sorted(r.doc_id for r in decontaminate.without_benchmark(docs(spark, texts), benchmark).collect()) == [3, 4]


def test_blocks_score_as_one_index(spark, monkeypatch):
    random.seed(12)
    items = [(i, " ".join(random.choice([f"v{int(random.expovariate(0.05))}", f"i{i}w{j}"]) for j in range(random.randint(20, 90))) + ". yes it is.") for i in range(30)] + [(99, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [" ".join(t.split()[:-4][: len(t.split()) - 6] + ["x"] + t.split()[-5:]) for _, t in items[:30]]

    def found():
        return sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in decontaminate.contaminated(docs(spark, texts), benchmark).collect())

    whole = found()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 4000)
    assert len(whole) >= 20 and found() == whole


# 4
def test_shards_fit(spark):
    texts = ["z" * random.Random(i).randint(0, 900) for i in range(400)] + ["big" * 4000]
    rows = sharding.assign_shards(docs(spark, texts), 5000).collect()
    assert len(rows) == 401
    size = {}
    for r in rows:
        size[r.shard] = size.get(r.shard, 0) + len(texts[r.doc_id])
    assert all((size[r.shard] > 5000) == r.oversized and size[r.shard] == r.shard_bytes and len(r.shard) == r.depth for r in rows)
    assert [r.shard_rows for r in rows if r.oversized] == [1]
    names = sorted(size)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))
    assert sharding.assign_shards(odd(spark), 100).count() == 9 and sharding.assign_shards(odd(spark).where("false"), 100).count() == 0


# 5
def test_written_shards_hold_every_row(spark, tmp_path):
    rows = [(i, "z" * random.Random(i).randint(0, 900), "en", "s", i) for i in range(200)]
    rows += [(None, "no id " + str(i), "de", "s", i) for i in range(3)] + [(7, "same", "fr", "s", 0)] * 3 + [(7, None, "fr", "s", 1), (None, None, None, None, None), (8, "big" * 4000, "en", "s", 0)]
    sharding.write_shards(spark.createDataFrame(rows, DOC), str(tmp_path / "out"), 5000)
    written = {f.name: [tuple(r) for r in spark.read.parquet(str(f)).select("doc_id", "text", "lang", "source", "n_chars").collect()] for f in (tmp_path / "out").glob("shard=*")}
    assert sorted((r for part in written.values() for r in part), key=repr) == sorted(rows, key=repr)
    assert len(written) > 10 and sum(sum(len(r[1] or "") for r in part) > 5000 for part in written.values()) == 1


def test_warc_round_trip(spark, tmp_path):
    body = "<p>é</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n" + "x" * 100
    rows = [(3, "http://a", body), (1, "http://b\r\nX: y", body), (2, None, body), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (None, "u", body), (8, "u", "y" * 99), (9, "u", "y" * 99), (1, "http://b", body)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path)
    read = warc.read_archives(spark, path)
    out = sorted(warc.resolve_revisits(read).collect(), key=lambda r: (r.page_id is None, r.page_id))
    assert [(r.page_id, r.record_type, r.refers_to) for r in out] == [(1, "response", None), (1, "response", None), (2, "revisit", 1), (3, "revisit", 1), (4, "response", None), (5, "response", None), (6, "response", None), (7, "response", None), (8, "response", None), (9, "response", None), (None, "response", None)]
    assert all(r.payload_digest == sha(body) and r.payload_bytes == len(body.encode()) for r in out if r.page_id in (1, 2, 3))
    payloads = {bytes(r.payload).decode() for r in read.where("record_type = 'response'").collect()}
    assert payloads == {body, "short", "", "y" * 99}
    warc.write_archives(pages.where("false"), str(tmp_path / "none"))
    assert warc.resolve_revisits(warc.read_archives(spark, str(tmp_path / "none"))).count() == 0


def test_warc_archives_of_others(spark, tmp_path):
    bodies = ["", "\r\n", "a\r\n", "\r\n\r\n", "b\r\n\r\n\r\n\r\n", "c\r", "\nd", "é\r\n\r\nWARC/1.1\r\n\r\n", "e" * 100_000]
    spark.createDataFrame(list(enumerate(bodies)), "page_id long, html string").withColumn("url", F.lit("u")).repartition(4).transform(lambda p: warc.write_archives(p, str(tmp_path / "own")) or p)
    assert {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(spark, str(tmp_path / "own")).collect()} == dict(enumerate(bodies))
    records = [f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(b.encode()) + 4}\r\n\r\n\r\n\r\n{b}\r\n\r\n".encode() for i, b in enumerate(bodies)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "members.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "in" / "plain.warc").write_bytes(b"".join(records))
    read = warc.read_archives(spark, str(tmp_path / "in")).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in read) == sorted(2 * list(enumerate(bodies)))
    (tmp_path / "in" / "cut.warc.gz").write_bytes(gzip.compress(records[-1][:-6]))
    with pytest.raises(Exception, match="cut off"):
        warc.read_archives(spark, str(tmp_path / "in")).collect()


def test_warc_record_ids(spark, tmp_path):
    rows = [(1, "x" * 200), (1, "y" * 200), (2, "x" * 200), (3, "y" * 200), (None, "x" * 200), (None, "z")]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.lit("u")), str(tmp_path / "ids"))
    archives = [f.read_bytes() for f in (tmp_path / "ids").glob("*.gz")]
    heads = [h for a in archives for h, _ in warc.parse_records(a)]
    responses = {h["warc-record-id"]: h["warc-payload-digest"] for h in heads if h["warc-type"] == "response"}
    assert len({h["warc-record-id"] for h in heads}) == len(rows)
    assert sum(h["warc-type"] == "revisit" and responses[h["warc-refers-to"]] == h["warc-payload-digest"] for h in heads) == 2


def test_warc_rejects_cut_archives():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert [b for _, b in warc.parse_records(record * 2)] == [b"hello"] * 2
    with pytest.raises(ValueError):
        list(warc.parse_records(record[:-6]))


# 6
@pytest.fixture(scope="module")
def codec():
    path, pattern = bpe.vocabulary()
    return bpe.Codec(bpe.load_ranks(path), pattern)


def test_bpe_equals_tiktoken(codec):
    import tiktoken

    encoding = tiktoken.Encoding("own", pat_str=codec.pattern.pattern, mergeable_ranks=codec.ranks, special_tokens={})
    random.seed(6)
    letters = "ab  \n\t'st re1²Ⅷé漢 　\xa0.!_<|endoftext|>𝔘"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) for _ in range(3000)] + ["", "a" * 5000, " " * 3000 + "x", "ab" * 2000, "I'm   fine\n\n ok ", "don't we'll"]
    for text in texts:
        ids = codec.encode(text)
        assert ids == encoding.encode_ordinary(text), repr(text)
        assert codec.decode(ids).decode() == text


def test_bpe_takes_any_pattern(codec):
    import tiktoken

    pattern = r"\w{1,3}|\W"
    own, other = bpe.Codec(codec.tokens, pattern, codec.hash), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=codec.ranks, special_tokens={})
    for text in ("Several words, and one more.", "漢字 don't", ""):
        assert own.encode(text) == other.encode_ordinary(text)


def test_minimal_perfect_hash(codec):
    h = bpe.MinimalPerfectHash(codec.tokens)
    assert [h.candidate(t) for t in codec.tokens] == list(range(len(codec.tokens)))
    assert sorted(h.slots) == list(range(len(codec.tokens)))


def test_bpe_rows(spark, codec):
    path, pattern = bpe.vocabulary()
    for r, text in zip(bpe.encode_documents(odd(spark), path, pattern).collect(), [r.text for r in odd(spark).collect()], strict=True):
        ids = codec.encode(text or "")
        assert list(r.ids) == ids and r.n_tokens == len(ids) and r.ids_sha256 == sha(" ".join(map(str, ids))) and r.decoded_sha256 == sha(text or "")
    assert bpe.encode_digests(odd(spark).where("false"), path, pattern).count() == 0


# 7, 9
def labelled(spark, bad, column):
    random.seed(7)
    vocabulary = [f"plain{i}" for i in range(300)]
    texts, labels = [], []
    for i in range(400):
        flag = i % 4 == 0
        plain = [random.choice(vocabulary) for _ in range(60)]
        texts.append(" ".join(bad(plain) if flag else plain))
        labels.append((i, int(flag)))
    return docs(spark, texts), spark.createDataFrame(labels, f"doc_id long, {column} int")


def test_toxicity_learns(spark):
    def insulted(plain):
        return plain[:20] + random.sample(["awful1", "awful2", "vile1", "vile2"], 3) + plain[20:]

    d, labels = labelled(spark, insulted, "toxic")
    model = toxicity.fit(d, labels)
    rows = {r.doc_id: r for r in toxicity.score(d, model).collect()}
    held = [r.doc_id for r in d.where(toxicity.held_out(5, 0)).collect()]
    assert held and all((rows[i].score >= 0.5) == (i % 4 == 0) for i in held)
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd(spark).drop("score"), model).collect())
    assert toxicity.fit(d, labels.where("false"))["weights"] == {}
    assert toxicity.score(odd(spark).where("false"), model).count() == 0


def test_segments_are_the_maximal_ones():
    def brute(scores):
        if not any(s > 0 for s in scores):
            return []
        best = max(((round(sum(scores[i:j]), 9), -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)))
        total, *_, i, j = best
        return [(a, b, s) for a, b, s in brute(scores[:i])] + [(i, j - 1, total)] + [(a + j, b + j, s) for a, b, s in brute(scores[j:])]

    random.seed(8)
    for _ in range(200):
        scores = [random.choice([-20.0, -11.0, 13.0, 27.0, -7.0]) for _ in range(random.randint(0, 14))]
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.segments(np.array(scores))]
        assert got == [(a, b, round(s, 6)) for a, b, s in brute(scores)], scores


def test_every_toxic_passage_is_found():
    scan = toxicity._scan({"weights": {"=vile": 3.0, "=awful": 2.5, "=mean": 2.0}, "lambda": 1.0, "k": 0.01})
    plain = " word" * 30
    found, x = scan("vile awful" + plain + " mean" + plain + " Vile, awful" + plain)
    assert [f[:2] for f in found] == [(0, 1), (32, 32), (63, 64)]
    assert [round(f[2], 9) for f in found] == [5.5, 2.0, 5.5] and x == pytest.approx(7.5)
    dense = scan("vile awful mean" + plain * 2 + " mean mean vile awful vile mean")[0]
    assert [f[:2] for f in dense] == [(0, 2), (63, 68)] and dense[1][2] == pytest.approx(14.5)


def test_only_significant_segments_count():
    scan = toxicity._scan({"weights": {"=vile": 3.0, "=mean": 0.5}, "lambda": 1.0, "k": 1.0})
    found, x = scan("mean" + " word" * 10 + " vile vile")  # chance gives a segment of log(13) = 2.56 once
    assert [f[:2] for f in found] == [(11, 12)] and x == pytest.approx(6 - np.log(13))


def test_toxicity_equals_brute_force(spark):
    """The whole operator again, from its docstring, in plain Python."""
    from math import exp, log, sqrt

    random.seed(17)
    common = [f"plain{i}" for i in range(60)]
    texts = []
    for i in range(250):
        w = [random.choice(common) for _ in range(random.randint(0, 60))]
        if i % 3 == 0:
            at = random.randint(0, len(w))
            w[at:at] = random.sample(["Awful,", "vile1", "vile2", "mean", "meaner"], random.randint(1, 4))
        texts.append(" ".join(w))
    texts += [None, "", texts[0]]
    labels = [(i, int(i % 3 == 0) if i % 17 else None) for i in range(253)] + [(3, 0)]
    train = [(t, y) for i, t in enumerate(texts) if i % 17 and zlib.crc32(str(i).encode()) % 5 for y in [int(i % 3 == 0)]]

    def words_of(t):
        return (t or "").split()

    def feats(w):
        w = w.strip(toxicity.STRIP).lower()
        return ["=" + w] + ["^" + w[:k] for k in (8, 7, 6, 5, 4) if len(w) >= k] if w else []

    def has(t):
        return {f for w in words_of(t) for f in feats(w)}

    n1, n0 = sum(y for _, y in train), sum(1 - y for _, y in train)
    c1, c0, every = ({} for _ in range(3))
    for t, y in train:
        for f in has(t):
            (c1 if y else c0)[f] = (c1 if y else c0).get(f, 0) + 1
    for t in texts:
        for f in has(t):
            every[f] = every.get(f, 0) + 1
    total, weights = min(500.0, 0.05 * (n1 + n0)), {}
    for f, y1 in c1.items():
        y0 = c0.get(f, 0)
        if y1 >= 3 and y1 / n1 > y0 / n0:
            prior = max(0.05, total * every[f] / len(texts))
            a, b = y1 + prior, y0 + prior
            d = log(a / max(n1 + total - a, 0.5)) - log(b / max(n0 + total - b, 0.5))
            if d / sqrt(1 / a + 1 / b) >= 2.6 and d >= 1.2:
                weights[f] = d

    def scores_of(t):
        return [max((weights[f] for f in feats(w) if f in weights), default=-0.4) for w in words_of(t)]

    def best_of(scores):  # maximal segments by splitting at the best one
        if not any(s > 0 for s in scores):
            return []
        _, _, _, i, j = max((round(sum(scores[i:j]), 9), i - j, -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))
        return [*best_of(scores[:i]), (i, j - 1, sum(scores[i:j])), *((a + j, b + j, s) for a, b, s in best_of(scores[j:]))]

    model = toxicity.fit(docs(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model["weights"] == pytest.approx(weights)
    lam, k = model["lambda"], model["k"]
    clean = [(scores_of(t)) for t, y in train if not y]
    hits, size = sum(s > 0 for x in clean for s in x), sum(map(len, clean))
    high, share = (np.mean(list(weights.values())), 1 / (max(1, int(size / hits)) + 1)) if hits else (max(weights.values()), 1 / 2000)
    assert share * exp(lam * high) + (1 - share) * exp(-0.4 * lam) == pytest.approx(1, abs=1e-3)
    assert k == pytest.approx(np.clip(1 / max(1e-9, np.mean([len(x) * exp(-lam * max((s for *_, s in best_of(x)), default=0)) for x in clean])), 1e-4, 1))
    for r in toxicity.score(docs(spark, texts), model).collect():
        t, scores = texts[r.doc_id], scores_of(texts[r.doc_id])
        least, own = log(max(k * len(scores), 1)), {}
        spans = [x for x in best_of(scores) if lam * x[2] > least]
        for a, b, s in spans:
            key = frozenset(words_of(t)[i].strip(toxicity.STRIP).lower() for i in range(a, b + 1) if scores[i] > 0)
            own[key] = max(own.get(key, 0), lam * s - least)
        assert [(x.first_word, x.last_word) for x in r.spans] == [x[:2] for x in spans]
        assert r.evidence == pytest.approx(sum(own.values())) and r.score == pytest.approx(1 / (1 + exp(-max(-40, min(40, model["a"] + model["b"] * r.evidence)))))


def test_training_sample_is_bounded(spark):
    d = docs(spark, [f"text {i} " + "x" * 100 for i in range(50)]).union(docs(spark, ["same row"] * 30).withColumn("doc_id", F.lit(7).cast("long")))
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    every = toxicity.training_sample(d, labels, "toxic", 5, 0, 1000, 1 << 20).collect()
    held = {r.doc_id for r in d.where(toxicity.held_out(5, 0)).collect()}
    assert len(every) == 50 - len(held) + (7 not in held) and sum(r.text == "same row" for r in every) == (7 not in held)
    few = toxicity.training_sample(d, labels, "toxic", 5, 0, 1000, 1000).collect()
    assert 0 < sum(len(r.text) for r in few) <= 1000 and {r.text for r in few} <= {r.text for r in every}
    assert toxicity.training_sample(d, labels, "toxic", 5, 0, 4, 1 << 20).count() <= 4
    assert toxicity.training_sample(d.where("false"), labels, "toxic", 5, 0, 4, 1 << 20).count() == 0


def test_features_of_a_rare_label(spark):
    texts = ["vile " * (i % 2) + f"toxic{i}" if i < 8 else "vile plain" if i < 14 else f"plain{i}" for i in range(800)]
    labels = spark.createDataFrame([(i, int(i < 8)) for i in range(800)], "doc_id long, toxic int")
    model = toxicity.fit(docs(spark, texts), labels, folds=1, held_out=1)
    assert model["weights"]["=vile"] >= toxicity.MIN_LOG_ODDS  # in 4 of 8 toxic and 6 of 792 clean texts
    assert "=plain" not in model["weights"]


def test_quality_learns(spark):
    d, labels = labelled(spark, lambda plain: plain[:10] + [w.upper() + "!!" for w in plain[10:]], "bad")
    labels = labels.select("doc_id", (1 - F.col("bad")).alias("quality"))
    model = quality.fit(d, labels)
    rows = {r.doc_id: r for r in quality.score(d, model).collect()}
    held = [r.doc_id for r in d.where(quality.held_out(3, 1)).collect()]
    assert held and all((rows[i].score >= 0.5) == (i % 4 != 0) for i in held)
    assert quality.accepted(d, model).count() == 300 and quality.accepted(odd(spark), None).count() == 9
    assert all(0 <= r.score <= 1 for r in quality.score(odd(spark).drop("score"), model).collect())
    assert quality.fit(d, labels.where("quality = 1")) is None


def test_quality_equals_brute_force():
    """Encoding, gated attention and score in plain loops; gradients against differences."""
    from math import exp, tanh

    rng = np.random.default_rng(5)
    texts = [None, "", "a", "one two two  THREE!", "x y " * 700 + "End.", "é" * 600, "\n\t" * 300]
    for text in texts:
        data = (text or "").encode()
        x = quality.encode(text)
        passages = max(1, (len(data) + 128) // 512)
        assert len(x) == passages
        counts = np.zeros((passages, 256))
        for i in range(len(data) - 1):
            counts[min(i // 512, passages - 1), quality._CLASS[data[i]] * 16 + quality._CLASS[data[i + 1]]] += 1
        assert np.allclose(x[:, :256], counts / np.maximum(counts.sum(1, keepdims=True), 1), atol=1e-6)
        again, starts, at = np.zeros(passages), np.zeros(passages), 0
        found = [(m.start(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)] if len(data) > 1 else []
        for (_, before), (place, word) in zip(found, found[1:], strict=False):
            starts[min(place // 512, passages - 1)] += 1
            again[min(place // 512, passages - 1)] += word == before
        assert np.allclose(x[:, 256], again / np.maximum(starts, 1), atol=1e-6)
    bags = [rng.random((n, quality.WIDTH)).astype(np.float32) for n in (1, 3, 2)]
    model = quality.train(np.concatenate(bags), np.array([1, 3, 2]), np.array([0, 1, 0], dtype=np.float32))
    first = np.array([0, 1, 4])
    *_, attention, _, _, p = quality._forward(model, np.concatenate(bags), first)
    for b, bag in enumerate(bags):
        hidden, weight = [], []
        for row in bag:
            z = [(row[i] - model["mean"][i]) / model["sd"][i] for i in range(quality.WIDTH)]
            h = [tanh(sum(z[i] * model["W"][i, j] for i in range(quality.WIDTH)) + model["b"][j]) for j in range(quality.HIDDEN)]
            gate = [tanh(sum(h[j] * model["V"][j, a] for j in range(quality.HIDDEN))) / (1 + exp(-sum(h[j] * model["U"][j, a] for j in range(quality.HIDDEN)))) for a in range(quality.ATTENTION)]
            hidden.append(h)
            weight.append(exp(sum(g * model["w"][a] for a, g in enumerate(gate))))
        share = [w / sum(weight) for w in weight]
        score = 1 / (1 + exp(-sum(model["c"][j] * sum(a * h[j] for a, h in zip(share, hidden, strict=True)) for j in range(quality.HIDDEN)) - model["d"][0]))
        assert np.allclose(attention[first[b] : first[b] + len(bag)], share, atol=1e-4) and p[b] == pytest.approx(score, abs=1e-4)


def test_quality_keeps_texts_without_words(spark):
    model = {"mean": np.zeros(quality.WIDTH), "sd": np.ones(quality.WIDTH), "W": np.zeros((quality.WIDTH, 2)), "b": np.zeros(2), "V": np.zeros((2, 2)), "U": np.zeros((2, 2)), "w": np.zeros(2), "c": np.zeros(2), "d": np.array([-9.0])}
    rows = docs(spark, [None, "", " \t\n\x0b", "word", "more words"]).withColumn("score", F.lit("x"))
    kept = quality.accepted(rows, model)
    assert kept.columns == rows.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2]


def test_fit_reads_all_passages(spark):
    text = "plain words " * 2000
    rows = [pa.RecordBatch.from_pydict({"label": pa.array([1], pa.int32()), "text": [text]})]
    (batch,) = quality._bags(rows)
    assert batch.column(1).to_pylist() == [len(quality.encode(text))] and len(quality.encode(text)) > 40


# 8
def brute_removed(rows):
    """(doc_id, text) sorted: kept words of each."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        w = BLANK.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            key = tuple(w[s : s + 20])
            if key in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(key)
        out[d] = ([x for x, g in zip(w, gone, strict=True) if not g], len(w))
    return out


def test_substring_dedup(spark, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK_BYTES", 3000)
    random.seed(10)
    few, many = ["a", "b", "c"], [f"w{i}" for i in range(300)]
    passages = [[random.choice(many) for _ in range(n)] for n in (19, 20, 21, 60)] + [["a"] * 50, ["a", "b"] * 30]
    texts = []
    for i in range(120):
        parts = []
        for _ in range(random.randint(0, 4)):
            parts += random.choice(passages) if random.random() < 0.6 else [random.choice(many if random.random() < 0.7 else few) for _ in range(random.randint(0, 40))]
        texts.append((" \n" if i % 2 else "  ").join(parts))
    texts += [None, "", texts[0], "x " * 100]
    table = docs(spark, texts).repartition(5)
    want = brute_removed(list(enumerate(texts)))
    for r in substring.dedup_digests(table).collect():
        kept, n = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, n - len(kept), sha(" ".join(kept))), r.doc_id
    cut = {r.doc_id: r for r in substring.dedup_documents(table).collect()}
    for d, (kept, n) in want.items():
        assert BLANK.findall(cut[d].text or "") == kept
        if len(kept) == n:
            assert cut[d].text == texts[d]


def test_substring_odd_rows(spark):
    assert substring.dedup_documents(odd(spark)).columns == odd(spark).columns
    rows = substring.dedup_digests(odd(spark)).collect()
    assert len(rows) == 9 and [r.n_removed for r in rows if r.doc_id == 5] == [29_999]
    assert substring.dedup_digests(odd(spark).where("false")).count() == 0


def test_symbols_stand_wherever_their_context_does():
    """Of a window's words alone follow its interior symbols, whatever is around it; long runs and small alphabets too."""
    rng = np.random.default_rng(3)
    names = words.mix(np.arange(1, 40, dtype=np.uint64))
    seen = 0
    for trial in range(600):
        kinds = int(rng.integers(1, 30))
        window, found = rng.integers(0, kinds, 20), set()
        if trial % 3 == 0:
            window = np.repeat(window, rng.integers(1, 9, 20))[:20]
        level = int(rng.integers(1, 8))
        for _ in range(4):
            before, after = (rng.integers(0, kinds, rng.integers(0, 30)) for _ in range(2))
            ids = np.concatenate([before, window, after]).astype(np.int32)
            seq = substring.Sequence(ids, names[ids], np.array([0, len(ids)])).rename(level)
            inside = (seq.low >= len(before)) & (seq.high <= len(before) + 20)
            found.add(tuple(zip(seq.name[inside].tolist(), (seq.at[inside] - len(before)).tolist(), (seq.low[inside] - len(before)).tolist(), (seq.high[inside] - len(before)).tolist(), strict=True)))
        assert len(found) == 1, (trial, level)
        seen += bool(found.pop())
    assert seen > 200


def test_runs_and_pairs_are_named():
    ids = np.array([0, 1, 1, 1, 2, 0, 1, 1, 2, 0], np.int32)
    names = words.mix(np.arange(1, 4, dtype=np.uint64))
    seq = substring.Sequence(ids, names[ids], np.array([0, len(ids)]))
    seq.name_runs()
    assert seq.at.tolist() == [0, 1, 4, 5, 6, 8, 9] and len(set(seq.name.tolist())) == 4  # two words, runs of 3 and of 2
    assert (seq.low.tolist()[1], seq.high.tolist()[1]) == (0, 5)  # a run's context holds the words that end it
    while len(seq.name) > 1 and seq.level < 40:
        seq.rename(seq.level + 1)
    assert len(seq.name) == 1


def test_buckets_are_walked_by_what_they_hold():
    u = np.sort(words.mix(np.arange(1000, dtype=np.uint64)))
    parts = list(substring._slices(u, 1 << 30))
    assert len(parts) > 990 and sum(s.stop - s.start for _, s in parts) == 1000 and list(substring._slices(u[:0], 8)) == []
    assert [b for b, _ in substring._slices(u, 4)] == [0, 1, 2, 3]


def test_substring_dedup_of_long_runs(spark, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK_BYTES", 2000)
    random.seed(21)
    texts = []
    for _ in range(60):
        w = []
        for _ in range(random.randint(1, 6)):
            w += random.choice([["a"] * random.randint(1, 70), ["a", "b"] * random.randint(1, 30), [random.choice("abc") for _ in range(random.randint(1, 40))]])
        texts.append(" ".join(w))
    want = brute_removed(list(enumerate(texts)))
    for r in substring.dedup_digests(docs(spark, texts).repartition(6)).collect():
        kept, n = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, n - len(kept), sha(" ".join(kept))), r.doc_id


# 10
def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|end|>", "<\\|end|>", "<\\\\|start|>user", "<<SYS>><</SYS>>", "[\\INST]", "a<", "|b", "", None, "<<|<|end|>|>[[/INST]"]
    for text in nasty:
        assert chat.unescape(chat.escape(text or "")) == (text or "")
        assert not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", chat.escape(text or ""))
    rows = [(c, t, ("user", "assistant", None)[t % 3], nasty[(c + t) % len(nasty)]) for c in range(5) for t in range(7)] + [(1, 3, "assistant", "tie"), (None, None, "assistant", "x"), (9, 0, "assistant", "y" * 100_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(0))
    out = {r.conv_id: r for r in chat.read_digests(chat.format_conversations(table)).collect()}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (-1 if r[1] is None else r[1], chat.format_turn(r[2], r[3])[0]))
        assert out[c].n_turns == len(own)
        assert out[c].turns_sha256 == sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (out[c].loss_chars, out[c].loss_sha256) == (len(loss), sha(loss))
    assert chat.read_digests(chat.format_conversations(table.where("false"))).count() == 0


def test_chat_parts_of_a_table(spark):
    kind = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
    rows = [(1, 0, "user", "not read", [("text", "see ", None, None, None, None, None), ("image", None, "a.png", 56, 28, None, None)]), (1, 1, "assistant", "yes", None), (1, 2, "user", "x", [("document", None, "b.pdf", None, None, None, 1)]), (2, 0, "user", "gone", [])]
    table = spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string, parts {kind}")
    out = sorted(chat.format_conversations(table).collect(), key=lambda r: (r.conv_id, r.turn))
    whole = "".join(r.segment for r in out if r.conv_id == 1)
    assert [r.segment[len("<|start|>user<|message|>") : -len("<|end|>")] for r in out if r.role == "user"] == ["see <|image|>", "<|document|>", ""]
    assert [(a.kind, a.ref, a.n_tokens, whole[a.position :].startswith(chat.PLACEHOLDER[a.kind])) for r in out for a in r.attachments] == [("image", "a.png", 2, True), ("document", "b.pdf", 256, True)]
    (loss,) = [(r.loss_start, r.loss_end) for r in out if r.loss_start is not None]
    assert whole[slice(*loss)] == "yes"
    for clash in (F.lit("text"), F.array(F.lit("text")), F.lit(3)):
        same = chat.format_conversations(table.withColumn("parts", clash)).where("conv_id = 2").first()
        assert same.segment == "<|start|>user<|message|>gone<|end|>"


def test_chat_parts(spark):
    parts = [{"type": "text", "text": "see <|image|>"}, {"type": "image", "ref": "a.png", "width": 56, "height": 29}, {"type": "audio", "ref": "b.wav", "seconds": 2.0}, {"type": "document", "ref": "c.pdf", "pages": 2}]
    segment, lo, hi, attachments = chat.format_turn("user", None, parts)
    assert [(a["kind"], a["ref"], a["n_tokens"]) for a in attachments] == [("image", "a.png", 4), ("audio", "b.wav", 50), ("document", "c.pdf", 512)]
    for a in attachments:
        assert segment[a["position"] :].startswith(chat.PLACEHOLDER[a["kind"]])
    assert segment[lo:hi].startswith("see <\\|image|>")
    with pytest.raises(ValueError):
        chat.format_turn("user", None, [{"type": "video"}])
