"""Toxicity by maximum-scoring segments of token log-odds.

1. Token log-odds with an informative Dirichlet prior (Monroe, Colaresi and Quinn 2008): features are
   lower-case words and their prefixes of 4 to 8 letters, counted by label over a bounded sample of the
   labelled training rows; the prior of the kept features is their frequency in the *whole* corpus.
2. A token scores the log-odds of its strongest feature, any other token a negative drift, so that
   segment scores follow the extreme-value theory of Karlin and Altschul (1990).
3. Every maximal scoring segment of a text is found in one linear scan (Ruzzo and Tompa 1999).
4. A segment of score S in a text of n tokens is expected K n exp(-lambda S) times by chance. lambda is
   solved from the token scores of clean training texts and K is fitted to their best segments (extreme
   values). A text's evidence is the sum of lambda S - log(K n) over its significant segments, of those with
   the same scoring words the best only, mapped to a probability by a logistic fit on the training sample.

Every occurrence of a word scores in the scan, so a passage is found wherever it stands and however often; repeats are
damped in the evidence alone, else one passage repeated through a long text would outweigh many different ones.

Labels are learned only from rows whose crc32(doc_id) mod 5 is not 0; at most ``SAMPLE_ROWS`` of
them and ``SAMPLE_BYTES`` of their texts, whole rows by the smallest hashes (a documented bound on the fit; corpus counts and scoring
cover all rows).

Defined cases: null and empty texts have no segment and get the score of no evidence; a doc_id with
several labels counts as toxic if any is; null labels are ignored; repeated rows are scored
each and learned from once; without labels of both kinds every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import materialize, table

SAMPLE_ROWS, SAMPLE_BYTES = 16_000, 256 << 20
FOLDS, HELD_OUT = 5, 0
#: A feature is kept if it is in so many toxic training texts, in a larger share of the toxic than of the clean ones (so that the rule
#: doesn't depend on how many there are of each), and its log-odds are so large and so many deviations above 0.
MIN_TOXIC_DOCS, MIN_Z, MIN_LOG_ODDS = 3, 2.6, 1.2
#: Texts that the prior counts for: this share of the sampled texts, at most so many.
PRIOR_SHARE, PRIOR_MOST = 0.05, 500.0
DRIFT = -0.4
MEMO = 200_000
PREFIXES = (8, 7, 6, 5, 4)
STRIP = ".,;:!?\"'()[]{}|*#$%&-_"

SCORED = "doc_id long, score double, evidence double, spans array<struct<first_word:int,last_word:int,score:double>>"
_SPANS = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64())]))
_SCORED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("evidence", pa.float64()), ("spans", _SPANS)])


def features(word: str) -> list[str]:
    """The word itself ('=word') and its prefixes ('^pref'), the most specific first."""
    word = word.strip(STRIP).lower()
    if not word:
        return []
    return ["=" + word] + ["^" + word[:k] for k in PREFIXES if len(word) >= k]


class TokenScores(dict):
    """Word to its score, by the kept features; bounded memo."""

    def __init__(self, weights: dict[str, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        found = [self.weights[f] for f in features(word) if f in self.weights]
        out = max(found) if found else DRIFT
        if len(self) >= MEMO:
            self.clear()
        self[word] = out
        return out


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score), in order; linear time.

    Each open candidate keeps the total before it, the total at its end and the nearest earlier
    candidate with a smaller total before it, so a merge never walks the same candidate twice."""
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    totals = np.concatenate(([0.0], np.cumsum(scores, dtype=np.float64)))
    stack: list[list] = []  # first, last, total before, total at the end, link
    for i in positive.tolist():
        new = [i, i, float(totals[i]), float(totals[i + 1]), -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            new[4] = j
            if j < 0 or stack[j][3] >= new[3]:
                stack.append(new)
                break
            new = [stack[j][0], new[1], stack[j][2], new[3], -1]
            del stack[j:]
    return [(a, b, hi - lo) for a, b, lo, hi, _ in stack]


def token_scores(memo: TokenScores, words: list[str]) -> np.ndarray:
    """Scores of a text's words, every occurrence alike."""
    return np.fromiter(map(memo.__getitem__, words), np.float64, len(words))


def significant(found: list[tuple[int, int, float]], n_words: int, lam: float, k: float) -> list[tuple[int, int, float]]:
    """The segments of which chance gives less than one as good in so many words."""
    least = math.log(max(k * n_words, 1.0))
    return [x for x in found if lam * x[2] > least]


def evidence(found: list[tuple[int, int, float]], words: list[str], scores: np.ndarray, lam: float, k: float) -> float:
    """Sum over significant segments of how far they exceed what chance gives in so many words; segments whose sets of scoring
    words are equal count once, by the best."""
    least, best = math.log(max(k * len(words), 1.0)), {}
    for a, b, s in found:
        own = frozenset(words[a + i].strip(STRIP).lower() for i in np.flatnonzero(scores[a : b + 1] > 0).tolist())
        best[own] = max(best.get(own, 0.0), lam * s - least)
    return math.fsum(best.values())


def _scan(model: dict):
    memo = TokenScores(model["weights"])

    def scan(text: str | None):
        """The significant segments and their evidence."""
        words = (text or "").split()
        scores = token_scores(memo, words)
        found = significant(segments(scores), len(words), model["lambda"], model["k"])
        return found, evidence(found, words, scores, model["lambda"], model["k"])

    return scan


def _probability(model: dict, x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, model["a"] + model["b"] * x))))


_MODELS: dict = {}


def _score(shared):
    def run(batches):
        model = shared.value
        key = id(shared.value)
        scan = _MODELS.get(key)
        if scan is None:
            _MODELS.clear()
            scan = _MODELS[key] = _scan(model)
        for batch in batches:
            scores, values, spans = [], [], []
            for text in batch.column(1):
                found, x = scan(text.as_py())
                scores.append(_probability(model, x))
                values.append(x)
                spans.append([{"first_word": a, "last_word": b, "score": s} for a, b, s in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(values, pa.float64()), pa.array(spans, _SPANS)], schema=_SCORED_SCHEMA)

    return run


def _count_features(batches):
    """Per task: in how many toxic and clean texts each feature is."""
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            seen = set()
            for word in set((text or "").split()):
                seen.update(features(word))
            counts[label].update(seen)
    yield from _counter_batches(counts)


def _counter_batches(counts: dict[int, Counter]):
    names = list(set(counts[0]) | set(counts[1]))
    for at in range(0, len(names), 20_000):
        part = names[at : at + 20_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[1][x] for x in part], pa.int64()), pa.array([counts[0][x] for x in part], pa.int64())], names=["feature", "toxic", "clean"])


def _corpus_counts(shared):
    """Per task: in how many texts of the corpus each kept feature is."""

    def run(batches):
        kept, memo, counts = shared.value, {}, Counter()
        for batch in batches:
            for text in batch.column(0):
                seen = set()
                for word in set((text.as_py() or "").split()):
                    own = memo.get(word)
                    if own is None:
                        if len(memo) >= MEMO:
                            memo.clear()
                        own = memo[word] = tuple(f for f in features(word) if f in kept)
                    if own:
                        seen.update(own)
                counts.update(seen)
                counts[""] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["feature", "n"])

    return run


def log_odds(y1, y0, n1, n0, prior, total):
    """Log-odds ratio with a Dirichlet prior of that total weight, and its z value."""
    a, b = y1 + prior, y0 + prior
    delta = math.log(a / max(n1 + total - a, 0.5)) - math.log(b / max(n0 + total - b, 0.5))
    return delta, delta / math.sqrt(1.0 / a + 1.0 / b)


def _karlin(scores: np.ndarray) -> float:
    """The positive lambda with mean(exp(lambda s)) = 1; scores have a negative mean."""
    lo, hi = 1e-3, 10.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if np.mean(np.exp(np.minimum(mid * scores, 50))) < 1 else (lo, mid)
    return lo


def logistic_1d(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton's method with a small ridge; the slope is kept positive."""
    a, b = 0.0, 0.1
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([np.sum(y - p) - 1e-2 * a, np.sum((y - p) * x) - 1e-2 * b])
        h = np.array([[w.sum() + 1e-2, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-2]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(max(b, 1e-3))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int, most_bytes: int) -> DataFrame:
    """(label, text) of distinct labelled rows outside the held-out fold: by rising hash of doc_id, at most so many, and as many as
    keep their texts within most_bytes (one at least). Rows are taken whole."""
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != held_out)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # at most `rows` pairs of integers: bounded, so broadcast; the texts of other rows are never shuffled
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(materialize(chosen, "labelled")), "doc_id")
    found = found.select(F.struct(F.xxhash64("doc_id").alias("h"), "doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("t")).alias("key"), "label", "text")
    keys = found.select("key", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).distinct().orderBy("key").limit(rows).collect()
    last, held = None, 0
    for r in keys:
        held += r.size
        if last is not None and held > most_bytes:
            break
        last = r.key
    if last is None:
        return found.select("label", "text").limit(0)
    within = found.where(F.col("key") <= F.struct(F.lit(last.h).cast("long").alias("h"), F.lit(last.doc_id).cast("long").alias("doc_id"), F.lit(last.t).alias("t")))
    return within.dropDuplicates(["key"]).select("label", "text")


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, sample_rows: int = SAMPLE_ROWS) -> dict:
    """The model: feature weights (bounded by the sample), lambda, K and the logistic map."""
    spark = docs.sparkSession
    none = {"weights": {}, "lambda": 1.0, "k": 1.0, "a": -40.0, "b": 1e-3}
    sample = materialize(training_sample(docs, labels, "toxic", folds, held_out, sample_rows, SAMPLE_BYTES), "toxicity-sample")
    sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return none
    counted = sample.mapInArrow(_count_features, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rows = counted.where((F.col("toxic") >= MIN_TOXIC_DOCS) & (F.col("toxic") * n0 > F.col("clean") * n1)).collect()
    candidates = {r.feature: (r.toxic, r.clean) for r in rows}
    shared = spark.sparkContext.broadcast(frozenset(candidates))
    corpus = {r.feature: r.n for r in docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_corpus_counts(shared), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    n_docs = max(1, corpus.get("", 1))
    weights, prior = {}, min(PRIOR_MOST, PRIOR_SHARE * (n1 + n0))
    for feature, (y1, y0) in candidates.items():
        delta, z = log_odds(y1, y0, n1, n0, max(0.05, prior * corpus.get(feature, 0) / n_docs), prior)
        if z >= MIN_Z and delta >= MIN_LOG_ODDS:
            weights[feature] = delta
    if not weights:
        return none
    model = none | {"weights": weights}
    drawn = _rows_of(sample, model)
    label, words, best = (np.array([r[i] for r in drawn], dtype=np.float64) for i in range(3))
    clean = label == 0
    hits = sum(r[3] for r in drawn if r[0] == 0)
    n_words = max(1.0, words[clean].sum())
    # scores of a clean text's tokens: the drift but for its hits, at least half a hit
    lam = _karlin(np.concatenate([np.full(1999, DRIFT), [max(weights.values())]])) if not hits else _karlin(np.repeat([DRIFT, float(np.mean(list(weights.values())))], [max(1, int(min(1e6, n_words / hits))), 1]))
    # the mean over clean texts of K n exp(-lambda S) for their best segment S is 1 where chance alone is at work
    k = float(np.clip(1.0 / max(1e-9, np.mean(words[clean] * np.exp(-lam * best[clean]))), 1e-4, 1.0))
    model |= {"lambda": lam, "k": k}
    pairs = _evidence_of(sample, model)
    a, b = logistic_1d(np.minimum(np.array([x for _, x in pairs]), 60.0), np.array([y for y, _ in pairs], dtype=np.float64))
    return model | {"a": a, "b": b}


def _rows_of(sample: DataFrame, model: dict) -> list[tuple]:
    """label, words, best segment and hits of each sampled row (bounded by the sample)."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        memo = TokenScores(shared.value["weights"])
        for batch in batches:
            out = []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                scores = token_scores(memo, (text or "").split())
                out.append((label, len(scores), max((s for _, _, s in segments(scores)), default=0.0), int((scores > 0).sum())))
            yield pa.RecordBatch.from_pylist([dict(zip("lwbh", r, strict=True)) for r in out], schema=pa.schema([("l", pa.int32()), ("w", pa.int64()), ("b", pa.float64()), ("h", pa.int64())]))

    return [tuple(r) for r in sample.mapInArrow(run, "l int, w long, b double, h long").collect()]


def _evidence_of(sample: DataFrame, model: dict) -> list[tuple[int, float]]:
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scan = _scan(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scan(t)[1] for t in batch.column(1).to_pylist()], pa.float64())], names=["l", "x"])

    return [tuple(r) for r in sample.mapInArrow(run, "l int, x double").collect()]


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, evidence and the significant segments of each row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_score(shared), SCORED)


def held_out(folds: int, fold: int) -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
