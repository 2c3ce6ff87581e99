"""Benchmark decontamination: a BM25 index over test items, queried by every training passage.

Index: items are cut into segments of at most ``SEGMENT_WORDS`` words; each term has a posting list in blocks of
``POSTING_BLOCK`` with the largest impact of each block. An impact is the term's BM25 weight divided by the segment's score for
its own text, so a passage's score is the share of the segment's BM25 mass it holds and one ``THRESHOLD`` serves all.

Query: passages of ``PASSAGE_WORDS`` words every half passage. Block-max WAND (Ding and Suel 2011) returns every segment whose score
reaches the threshold. Before it, a bound that can't lose one: the commonest index terms are non-essential as long as
they hold less than the threshold of any segment; a segment can reach the threshold only if the impacts of the essential terms
that a passage holds, added to the segment's non-essential mass, do. These bounds are added up for a whole batch of texts at once, and WAND
runs on the passages where some segment passes.

Verification, on the whole text: the item is split into question and answer (its last sentence); both must have at least
``OVERLAP`` of their 5-word shingles in the text.

The benchmark's size is checked: beyond ``BLOCK_BYTES`` it is dealt into blocks by hash, one after the other indexed, sent and dropped
again, and every passage queries them all. The number of segments, their mean length and the number of
segments of each term are counted over all items, so weights and scores are those of one index.

Terms are words in lower case without punctuation at their ends. Defined cases: null and empty texts and items without a term match
nothing; items of one sentence, and items whose last sentence is all they have, are question and answer at once; repeated
rows and items are reported each; items without item_id are reported with none; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_left
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import materialize, prepare, release, table

K1, B = 1.2, 0.75
SEGMENT_WORDS, PASSAGE_WORDS = 64, 128
POSTING_BLOCK = 64
THRESHOLD = 0.5
#: Largest share of any segment that its non-essential terms may hold; below the threshold.
COMMON_MASS = 0.35
SHINGLE, OVERLAP = 5, 0.8
BLOCK_BYTES = 16 << 20
MEMO = 300_000
_STRIP = ".,;:!?\"'()[]{}<>|*#$%&-_`~“”‘’«»…"

MATCHES = "doc_id long, item_id long, score double, first_word long, question_overlap double, answer_overlap double"
_MATCH_SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])


def term_of(word: bytes) -> str:
    return word.decode().strip(_STRIP).lower()


def terms_of(text: str | None) -> list[str]:
    return [t for t in map(term_of, (text or "").encode().split()) if t]


def question_answer(text: str | None) -> tuple[list[str], list[str]]:
    """Terms of the item's question and of its answer, the last sentence."""
    sentences = [t for t in (terms_of(s) for s in re.split(r"(?<=[.!?])\s+|\n+", (text or "").strip())) if t]
    answer = sentences.pop() if sentences else []
    question = [t for s in sentences for t in s]
    return question or answer, answer


def segments_of(text: str | None) -> list[Counter]:
    """The terms of each segment of an item."""
    terms = terms_of(text)
    return [Counter(terms[at : at + SEGMENT_WORDS]) for at in range(0, len(terms), SEGMENT_WORDS)]


class Index:
    """Postings of segments, with block maxima; everything numbered from 0.

    counts: the number of segments, their words and the number of segments of each term, if items are a part of the benchmark."""

    def __init__(self, items: list[tuple[int, str]], counts: tuple[int, int, dict[str, int]] | None = None) -> None:
        self.items = [(i, *question_answer(text)) for i, text in items]
        segments: list[tuple[int, Counter]] = []
        for number, (_, text) in enumerate(items):
            segments += [(number, c) for c in segments_of(text)]
        self.item_of = [s[0] for s in segments]
        self.term: dict[str, int] = {}
        df: Counter = Counter()
        for _, c in segments:
            df.update(c.keys())
        for t in sorted(df, key=lambda t: (-df[t], t)):  # the commonest terms have the smallest numbers
            self.term[t] = len(self.term)
        n = len(segments)
        all_n, all_words, all_df = counts or (n, sum(sum(c.values()) for _, c in segments), df)
        mean = all_words / max(1, all_n)
        postings: list[list[tuple[int, float]]] = [[] for _ in self.term]
        self.common = np.zeros(n)  # non-essential mass of each segment
        impacts = []
        for _, terms in segments:
            size = sum(terms.values())
            w = {self.term[t]: math.log(1 + (all_n - all_df[t] + 0.5) / (all_df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * size / mean)) for t, c in terms.items()}
            total = sum(w.values())
            impacts.append({t: v / total for t, v in w.items()})
            for t, v in impacts[-1].items():
                postings[t].append((len(impacts) - 1, v))
        self.first_essential = 0
        for t, posting in enumerate(postings):
            if any(self.common[d] + v > COMMON_MASS for d, v in posting):
                break
            for d, v in posting:
                self.common[d] += v
            self.first_essential = t + 1
        self.docs = [np.array([d for d, _ in p], np.int32) for p in postings]
        self.impacts = [np.array([v for _, v in p]) for p in postings]
        self.block_last = [d[POSTING_BLOCK - 1 :: POSTING_BLOCK].tolist() + ([int(d[-1])] if len(d) % POSTING_BLOCK else []) for d in self.docs]
        self.block_max = [[float(v[i : i + POSTING_BLOCK].max()) for i in range(0, len(v), POSTING_BLOCK)] for v in self.impacts]
        self.top = [float(v.max()) for v in self.impacts]
        sizes = [len(d) for d in self.docs]
        self.start = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.flat_docs = np.concatenate(self.docs) if self.docs else np.zeros(0, np.int32)
        self.flat_impacts = np.concatenate(self.impacts) if self.impacts else np.zeros(0)
        self.doc_lists = [d.tolist() for d in self.docs]

    def search(self, terms: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """Block-max WAND: (segment, score) of all segments whose score for these distinct terms reaches the threshold."""
        lists = [[0, t] for t in terms]  # position in the term's postings, term
        out, docs = [], self.doc_lists
        need = threshold - 1e-9
        while True:
            lists = [x for x in lists if x[0] < len(docs[x[1]])]
            lists.sort(key=lambda x: docs[x[1]][x[0]])
            bound, pivot = 0.0, -1
            for i, (_, t) in enumerate(lists):
                bound += self.top[t]
                if bound >= need:
                    pivot = i
                    break
            if pivot < 0:
                return out
            doc = docs[lists[pivot][1]][lists[pivot][0]]
            while pivot + 1 < len(lists) and docs[lists[pivot + 1][1]][lists[pivot + 1][0]] == doc:
                pivot += 1
            # the blocks that would hold the pivot's document
            blocks = [bisect_left(self.block_last[t], doc) for _, t in lists[: pivot + 1]]
            if sum(self.block_max[t][b] for (_, t), b in zip(lists, blocks, strict=False) if b < len(self.block_max[t])) >= need:
                score = 0.0
                for x in lists[: pivot + 1]:
                    at = bisect_left(docs[x[1]], doc, x[0])
                    x[0] = at
                    if at < len(docs[x[1]]) and docs[x[1]][at] == doc:
                        score += float(self.impacts[x[1]][at])
                        x[0] = at + 1
                if score >= need:
                    out.append((doc, score))
            else:
                # nothing before the end of the nearest of these blocks, or the next list's document, can pass
                ends = [self.block_last[t][b] + 1 for (_, t), b in zip(lists, blocks, strict=False) if b < len(self.block_last[t])]
                if pivot + 1 < len(lists):
                    ends.append(docs[lists[pivot + 1][1]][lists[pivot + 1][0]])
                target = max(min(ends), doc + 1)
                for x in lists[: pivot + 1]:
                    x[0] = bisect_left(docs[x[1]], target, x[0])


def _shingles(terms: list[str], k: int) -> set:
    return {tuple(terms[i : i + k]) for i in range(len(terms) - k + 1)}


def overlap(part: list[str], text_terms: list[str], cache: dict) -> float:
    """Share of the part's shingles (of five words, or all its words if fewer) that the text has."""
    if not part:
        return 0.0
    k = min(SHINGLE, len(part))
    if k not in cache:
        cache[k] = _shingles(text_terms, k)
    own = _shingles(part, k)
    return len(own & cache[k]) / len(own)


class _TermIds(dict):
    def __init__(self, index: Index) -> None:
        super().__init__()
        self.index = index

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        term = term_of(word)
        out = self[word] = self.index.term.get(term, -1) if term else -2
        return out


def _candidates(index: Index, ids: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Passages (by the number of their first half) in which some segment can reach the threshold."""
    essential = np.flatnonzero(ids >= index.first_essential)
    if not len(essential):
        return essential
    t, h = ids[essential], half[essential]
    once = np.unique(h.astype(np.int64) << 32 | t)
    t, h = (once & 0xFFFFFFFF).astype(np.int64), once >> 32
    sizes = index.start[t + 1] - index.start[t]
    at = np.repeat(index.start[t] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
    n = len(index.item_of)
    keys, which = np.unique(np.repeat(h, sizes) * n + index.flat_docs[at], return_inverse=True)
    mass = np.bincount(which, index.flat_impacts[at])
    # a passage is a half and the one after it
    both = np.concatenate((keys, keys[keys >= n] - n))
    total_keys, which = np.unique(both, return_inverse=True)
    total = np.bincount(which, np.concatenate((mass, mass[keys >= n])))
    passing = total + index.common[total_keys % n] >= THRESHOLD - 1e-9
    return np.unique(total_keys[passing] // n)


_INDEXES: dict = {}


def _index(shared) -> tuple[Index, _TermIds]:
    """This worker's index of a broadcast block of items."""
    key, items, counts = shared.value
    if key not in _INDEXES:
        _INDEXES.clear()
        index = Index(items, counts)
        _INDEXES[key] = (index, _TermIds(index))
    return _INDEXES[key]


def matches(index: Index, memo: _TermIds, texts: list[str | None]) -> list[tuple]:
    """(row, item number, score, first word, question overlap, answer overlap) of each verified match."""
    if not index.term or not texts:
        return []
    step = PASSAGE_WORDS // 2
    ids, halves, first_half = [], [], [0]
    for text in texts:
        words = (text or "").encode().split()
        own = np.fromiter(map(memo.__getitem__, words), np.int32, len(words))
        own = own[own > -2]
        ids.append(own)
        halves.append(np.arange(len(own)) // step + first_half[-1])
        first_half.append(first_half[-1] + len(own) // step + 2)  # one empty half between texts
    found: dict[tuple[int, int], tuple[float, int]] = {}
    for p in _candidates(index, np.concatenate(ids), np.concatenate(halves)).tolist():
        row = bisect_left(first_half, p + 1) - 1
        at = (p - first_half[row]) * step
        terms = np.unique(ids[row][at : at + PASSAGE_WORDS])
        for segment, score in index.search(terms[terms >= 0].tolist()):
            k = (row, index.item_of[segment])
            if k not in found or score > found[k][0]:
                found[k] = (score, at)
    out, last, text_terms, cache = [], -1, [], {}
    for (row, item), (score, at) in sorted(found.items()):
        if row != last:
            last, text_terms, cache = row, terms_of(texts[row]), {}
        _, question, answer = index.items[item]
        q, a = overlap(question, text_terms, cache), overlap(answer, text_terms, cache)
        if q >= OVERLAP and a >= OVERLAP:
            out.append((row, item, score, at, q, a))
    return out


def _match(shared):
    def run(batches):
        index, memo = _index(shared)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                ids = part.column(0).to_pylist()
                found = matches(index, memo, part.column(1).to_pylist())
                if found:
                    yield pa.RecordBatch.from_pylist([dict(zip(_MATCH_SCHEMA.names, (ids[row], index.items[item][0], *rest), strict=True)) for row, item, *rest in found], schema=_MATCH_SCHEMA)

    return run


def _keep(shared):
    def run(batches):
        index, memo = _index(shared)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                hit = {m[0] for m in matches(index, memo, part.column("text").to_pylist())}
                yield part.filter(pa.array([i not in hit for i in range(part.num_rows)])) if hit else part

    return run


def _count_terms(batches):
    """Per batch of items: block, term and in how many segments it is; under the empty term their number and words."""
    for batch in batches:
        found: dict[int, Counter] = {}
        segments, n_words = Counter(), Counter()
        for block, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for terms in segments_of(text):
                found.setdefault(block, Counter()).update(terms.keys())
                segments[block] += 1
                n_words[block] += sum(terms.values())
        rows = [(block, t, n, 0) for block, df in found.items() for t, n in df.items()] + [(block, "", n, n_words[block]) for block, n in segments.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["block", "term", "n", "words"])


class _Blocks:
    """The items in blocks of a checked size, each with the counts over all items of the block's terms. One block is on the driver at a time."""

    def __init__(self, spark, benchmark: DataFrame) -> None:
        prepare(spark)
        self.spark, self.run = spark, uuid.uuid4().hex
        self.items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        size = self.items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
        self.n = max(1, math.ceil(2 * size / BLOCK_BYTES)) if size > BLOCK_BYTES else 1
        # several texts of one item_id are dealt each by itself
        place = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.n))
        if self.n > 1:
            self.items = materialize(self.items.withColumn("block", place), "benchmark")
            self.by_block = materialize(self.items.select(F.col("block").cast("long").alias("block"), "text").mapInArrow(_count_terms, "block long, term string, n long, words long").groupBy("block", "term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")), "block-terms")
            self.over_all = materialize(self.by_block.groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")), "terms")
            self.total = self.over_all.where("term = ''").first()

    def share(self, block: int):
        """Broadcasts a block; its items and terms are no more than its bytes hold."""
        own, counts = self.items, None
        if self.n > 1:
            own = own.where(F.col("block") == block)
            if self.total:
                terms = self.over_all.join(self.by_block.where(F.col("block") == block).select("term"), "term", "left_semi").where("term <> ''")
                counts = (self.total.n, self.total.words, {r.term: r.n for r in terms.select("term", "n").collect()})
        part = sorted(((r.item_id, r.text) for r in own.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        return self.spark.sparkContext.broadcast(((self.run, block), part, counts))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each row of docs (doc_id, text) and item that it holds. Documents are read once for each block of the benchmark."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks, parts = _Blocks(docs.sparkSession, benchmark), []
    if blocks.n == 1:
        return rows.mapInArrow(_match(blocks.share(0)), MATCHES)
    for block in range(blocks.n):
        shared = blocks.share(block)
        parts.append(materialize(rows.mapInArrow(_match(shared), MATCHES), "matches"))
        shared.destroy()
    return reduce(DataFrame.unionByName, parts)


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no item, with all columns; a filter of map tasks alone, written after each block but the last."""
    blocks, out, before = _Blocks(docs.sparkSession, benchmark), docs, None
    for block in range(blocks.n - 1):
        shared = blocks.share(block)
        out = materialize(out.mapInArrow(_keep(shared), docs.schema), "decontaminated")
        shared.destroy()
        if before is not None:
            release(before)
        before = out
    return out.mapInArrow(_keep(blocks.share(blocks.n - 1)), docs.schema)


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
