"""Quality by attention-based multiple-instance learning (Ilse, Tomczak and Welling 2018).

A document is a bag of passages (blocks of ``PASSAGE_BYTES`` bytes of its UTF-8 text). Each passage is
encoded from its histogram of byte-class bigrams and its share of words that repeat the word before;
a learned layer embeds it, gated attention weighs the passages, and the weighted representation is
scored. Only document labels are used; the attention says which passages decided.

The fit takes at most ``SAMPLE_ROWS`` labelled rows whose crc32(doc_id) mod 3 is not 1, and at most ``SAMPLE_BYTES`` of their
texts (those of the smallest hashes; a documented bound on rows), with all their passages; scoring reads every passage of every row.

Defined cases: null and empty texts are one passage without bytes; texts without a word (null, empty, white space) hold nothing to
judge, so ``accepted`` keeps them whatever their score; several labels of a doc_id
count as their maximum; without labels of both kinds every score is 1 (nothing is rejected); repeated
rows are scored each and learned from once; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import materialize, table
from threadloom.llm.toxicity import held_out, training_sample

SAMPLE_ROWS, SAMPLE_BYTES = 6_000, 64 << 20
FOLDS, HELD_OUT = 3, 1
PASSAGE_BYTES = 512
CLASSES = 16
WIDTH = CLASSES * CLASSES + 2
HIDDEN, ATTENTION = 24, 12
EPOCHS, BATCH, RATE, DECAY = 14, 64, 3e-3, 1e-4

SCORED = "doc_id long, score double, top_passage int, n_passages int"
_SCORED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("top_passage", pa.int32()), ("n_passages", pa.int32())])


def _byte_classes() -> np.ndarray:
    kinds = np.zeros(256, np.int32)
    groups = [b" ", b"\n", b"\t\x0b\x0c\r", bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58)), b".", b",", b"!?", b";:", b"|", b"*#$%&@^~`+=", b"<>/\\_", b"\"'()[]{}", b"-", bytes(range(128, 256))]
    for k, group in enumerate(groups):
        kinds[list(group)] = k
    return kinds


_CLASS = _byte_classes()
_SPACE = " \t\n\x0b\x0c\r"
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_WEIGHT = np.random.default_rng(7).integers(1, 2**31, 64).astype(np.uint32) | np.uint32(1)


def encode(text: str | None) -> np.ndarray:
    """A row per passage: bigram shares, the share of repeated words, and the passage's fill."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    n = len(data)
    p = max(1, (n + PASSAGE_BYTES // 4) // PASSAGE_BYTES)  # a short rest joins the passage before
    if n < 2:
        return np.zeros((1, WIDTH), np.float32)
    place = np.minimum(np.arange(n - 1) // PASSAGE_BYTES, p - 1)
    kinds = _CLASS[data]
    pairs = np.bincount(place * (CLASSES * CLASSES) + kinds[:-1] * CLASSES + kinds[1:], minlength=p * CLASSES * CLASSES).reshape(p, -1).astype(np.float32)
    size = pairs.sum(1, keepdims=True)
    out = np.empty((p, WIDTH), np.float32)
    out[:, :-2] = pairs / np.maximum(size, 1)
    out[:, -1] = np.minimum(size[:, 0] / PASSAGE_BYTES, 1)
    blank = _BLANK[data]
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    out[:, -2] = 0
    if len(starts) > 1:
        word = np.cumsum(np.bincount(starts, minlength=n)) - 1
        weighted = np.where(blank, np.uint32(0), (data.astype(np.uint32) + np.uint32(1)) * _WEIGHT[(np.arange(n) - starts[np.maximum(word, 0)]) & 63])
        sums = np.add.reduceat(weighted, starts)
        at = np.minimum(starts[1:] // PASSAGE_BYTES, p - 1)
        same = np.bincount(at, sums[1:] == sums[:-1], minlength=p)
        out[:, -2] = same / np.maximum(np.bincount(at, minlength=p), 1)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(m: dict, x: np.ndarray, first: np.ndarray):
    """x: passages, first: where each bag begins. Returns what the gradients need as well."""
    x = (x - m["mean"]) / m["sd"]
    h = np.tanh(x @ m["W"] + m["b"])
    t, g = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    e = np.clip((t * g) @ m["w"], -20, 20)
    bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
    ex = np.exp(e)
    a = ex / np.add.reduceat(ex, first)[bag]
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    return x, h, t, g, a, bag, z, _sigmoid(z @ m["c"] + m["d"][0])


def train(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, seed: int = 11) -> dict:
    """Adam on the bags' log loss, in one process over a bounded sample."""
    rng = np.random.default_rng(seed)
    m = {"mean": x.mean(0), "sd": np.maximum(x.std(0), 1e-2)}
    shapes = {"W": (WIDTH, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "w": (ATTENTION,), "c": (HIDDEN,), "d": (1,)}
    for k, shape in shapes.items():
        m[k] = np.zeros(shape, np.float32) if k in "bd" else (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    moments = {k: [np.zeros_like(m[k]), np.zeros_like(m[k])] for k in shapes}
    offsets, step = np.concatenate(([0], np.cumsum(sizes))), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(sizes))
        for at in range(0, len(order), BATCH):
            bags = order[at : at + BATCH]
            xb = np.concatenate([x[offsets[i] : offsets[i + 1]] for i in bags])
            first = np.concatenate(([0], np.cumsum(sizes[bags])[:-1]))
            xs, h, t, g, a, bag, z, p = _forward(m, xb, first)
            dl = ((p - y[bags]) / len(bags)).astype(np.float32)
            grad = {"c": z.T @ dl, "d": np.array([dl.sum()])}
            dz = dl[:, None] * m["c"]
            dzp = dz[bag]
            da = (dzp * h).sum(1)
            de = a * (da - np.add.reduceat(a * da, first)[bag])
            gate = t * g
            grad["w"] = gate.T @ de
            dgate = de[:, None] * m["w"]
            dt, dg = dgate * g * (1 - t * t), dgate * t * g * (1 - g)
            grad["V"], grad["U"] = h.T @ dt, h.T @ dg
            dh = (a[:, None] * dzp + dt @ m["V"].T + dg @ m["U"].T) * (1 - h * h)
            grad["W"], grad["b"] = xs.T @ dh + DECAY * m["W"], dh.sum(0)
            step += 1
            for k, v in grad.items():
                one, two = moments[k]
                one += 0.1 * (v - one)
                two += 0.001 * (v * v - two)
                m[k] = (m[k] - RATE * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return m


def _bags(batches):
    """The sampled rows' labels and passages, as float16 bytes."""
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = encode(text)
            yield pa.RecordBatch.from_arrays([pa.array([label], pa.int32()), pa.array([len(x)], pa.int32()), pa.array([x.astype(np.float16).tobytes()], pa.binary())], names=["label", "n", "x"])


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, fold: int = HELD_OUT, sample_rows: int = SAMPLE_ROWS) -> dict | None:
    """The model, or None if the labels don't have both kinds."""
    sample = training_sample(docs, labels, "quality", folds, fold, sample_rows, SAMPLE_BYTES)
    rows = materialize(sample.mapInArrow(_bags, "label int, n int, x binary"), "quality-sample").collect()
    rows.sort(key=lambda r: (r.label, r.n, bytes(r.x)))  # the fit doesn't depend on the order of partitions
    y = np.array([r.label for r in rows], dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return None
    sizes = np.array([r.n for r in rows])
    x = np.concatenate([np.frombuffer(r.x, np.float16).reshape(r.n, WIDTH) for r in rows]).astype(np.float32)
    return train(x, sizes, y)


def predict(model: dict | None, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores, the passage with the most attention, and the number of passages."""
    bags = [encode(t) for t in texts]
    sizes = np.array([len(b) for b in bags])
    if model is None:
        return np.ones(len(bags)), np.zeros(len(bags), np.int32), sizes
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    *_, a, _bag, _z, p = _forward(model, np.concatenate(bags), first)
    return p.astype(np.float64), np.array([np.argmax(a[f : f + n]) for f, n in zip(first, sizes, strict=True)], dtype=np.int32), sizes


def _score(shared):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                p, top, sizes = predict(shared.value, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p), pa.array(top, pa.int32()), pa.array(sizes.astype(np.int32))], schema=_SCORED_SCHEMA)

    return run


def _keep(shared):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = part.column("text").to_pylist()
                judged = [i for i, t in enumerate(texts) if t and t.strip(_SPACE)]
                stays = np.ones(len(texts), bool)
                if judged:
                    stays[judged] = predict(shared.value, [texts[i] for i in judged])[0] >= 0.5
                yield part.filter(pa.array(stays))

    return run


def accepted(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of docs that the model accepts or that have no word, with all columns; a filter of map tasks alone."""
    return docs.mapInArrow(_keep(docs.sparkSession.sparkContext.broadcast(model)), docs.schema)


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, score, the passage with the most attention and the number of passages of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_score(shared), SCORED)


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
