"""The pipeline's stages on a small corpus with planted cases, and the guard in the driver entry."""

import os
import random

import pytest

pytest.importorskip("threadloom.llm")

import corpus_pipeline  # noqa: E402
import __spark_entry__ as entry  # noqa: E402

DATA = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert names["pipeline"] is corpus_pipeline.run and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.skipif(not os.path.exists(DATA), reason="needs the test tables")
def test_planted_cases(spark, tmp_path):
    random.seed(3)
    vocabulary = [f"Word{i}" for i in range(400)]
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").where("text is not null").orderBy("item_id").first().text

    def prose(n):
        return " ".join(random.choice(vocabulary).lower() for _ in range(n)).capitalize() + "."

    passage, base = prose(60), prose(120)
    texts = {1: prose(100), 2: base, 3: base + " end", 4: prose(50) + " " + passage, 5: prose(50) + " " + passage + " " + prose(50), 6: prose(40) + "\n" + item + "\n" + prose(40), 7: None, 8: ""}
    docs = spark.createDataFrame([(k, v, "en", "s", len(v or "")) for k, v in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    near = corpus_pipeline.dedup_near(spark, docs, DATA)
    assert sorted(r.doc_id for r in near.collect()) == [1, 2, 4, 5, 6, 7, 8] and near.columns == docs.columns
    cut = {r.doc_id: r for r in corpus_pipeline.dedup_substrings(spark, near, DATA).collect()}
    assert passage.split()[30] in cut[4].text and passage not in cut[5].text and cut[1].text == texts[1] and cut[5].n_chars == len(cut[5].text)
    clean = corpus_pipeline.remove_benchmark(spark, docs, DATA)
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2, 3, 4, 5, 7, 8]
    assert sorted(r.doc_id for r in corpus_pipeline.encode(spark, docs, DATA).collect()) == sorted(texts)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), DATA).count() == 0


def test_near_dedup_decides_by_row(spark):
    def text(name, last=""):
        return " ".join(f"{name}{i}" for i in range(40)) + last

    rows = [(1, text("a")), (5, text("a", " end")), (5, text("c")), (7, text("d")), (7, text("d")), (7, None), (None, text("a")), (None, text("a"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.dedup_near(spark, docs, DATA)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted([rows[0], rows[2], rows[3], *rows[5:]], key=repr)


@pytest.mark.skipif(not os.path.exists(DATA), reason="needs the test tables")
def test_texts_without_words_pass_every_filter(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(900_001, None, "en", "s", 0), (900_002, "", "en", "s", 0), (900_003, " \n", "en", "s", 2)], docs.schema)
    rows = docs.union(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, rows, DATA).where("doc_id > 900000")
        assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text is not None) == [(900_002, ""), (900_003, " \n")] and kept.count() == 3


@pytest.mark.skipif(not os.path.exists(DATA), reason="needs the test tables")
def test_run_equals_brute_force(spark):
    """All stages again, in plain Python, from the model's scores and the library's tokens."""
    import hashlib
    import re

    from threadloom.llm import bpe, decontaminate, quality

    word = re.compile(r"[^\x20\x09-\x0D]+")
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    model = quality.fit(table, spark.read.parquet(f"{DATA}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in table.collect()]
    scores = quality.predict(model, [t for _, t in rows])[0]
    rows = [r for r, p in zip(rows, scores, strict=True) if p >= 0.5 or not word.search(r[1] or "")]

    def shingles(text, k):
        w = word.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets = {d: shingles(t, 5) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[:at]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    rows = sorted(r for r in rows if root(r[0]) == r[0])
    seen, cut = set(), []
    for d, t in rows:
        w = list(word.finditer(t or ""))
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            key = tuple(m.group() for m in w[s : s + 20])
            if key in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(key)
        out, at = [], 0
        for m, g in zip(w, gone, strict=True):
            out.append("" if g else t[at : m.end()])
            at = m.end()
        cut.append((d, ("".join(out) + t[at:]).strip(" \t\n\r\x0b\x0c") if any(gone) else t))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    parts = [decontaminate.question_answer(t) for _, t in items]

    def holds(text, part):
        terms, k = decontaminate.terms_of(text), min(5, len(part))
        have, own = ({tuple(x[i : i + k]) for i in range(len(x) - k + 1)} for x in (terms, part))
        return bool(own) and len(own & have) / len(own) >= 0.8

    cut = [(d, t) for d, t in cut if not any(holds(t, q) and holds(t, a) for q, a in parts)]
    codec = bpe.Codec(bpe.load_ranks(bpe.vocabulary()[0]), bpe.vocabulary()[1])
    want = {d: hashlib.sha256(" ".join(map(str, codec.encode(t or ""))).encode()).hexdigest() for d, t in cut}
    got = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, DATA).collect()}
    assert got == want


@pytest.mark.skipif(not os.path.exists(DATA), reason="needs the test tables")
def test_run(spark):
    assert 0 < corpus_pipeline.run(spark, DATA).count() <= spark.read.parquet(f"{DATA}/documents.parquet").count()
