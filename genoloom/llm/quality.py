"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document, softmax on top.

Features of a text are its words, its pairs of neighbouring words, and character n-grams inside words (as they are written:
case counts), each hashed to one of BUCKETS rows. A document is the mean of its rows; a linear layer and softmax give the
probability of label 1. Rows and layer are trained together by numpy stochastic gradient descent.

Learning reads at most TRAIN_ROWS labelled rows (those with the smallest hash of doc_id among the rows that may be learned
from) and of these no more than make TRAIN_FEATURES features, two stated bounds. Executors turn texts into feature counts, one
task trains on them, and only the model reaches the driver: as the layer is linear it is one number per bucket, a table of
fixed size at every input size. Scoring covers every text in full, very long ones included.

Nulls: a null or empty text has no features and scores the prior; rows without a label, or with a null one, are not learned
from; with no usable label at all every score is 0.5. Of several labels of one doc_id the largest counts. Repeated rows are
scored each, rows that share a doc_id by their own texts. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _ODD, batches, buffer_of, powers, row_key, splitmix, table, tidy, words_of

BUCKETS = 1 << 17
DIM = 8
NGRAMS = (3, 4)
EPOCHS = 12
RATE = 0.6
#: Most labelled rows that are learned from.
TRAIN_ROWS = 3000
#: Most features (different buckets of a text) that are learned from.
TRAIN_FEATURES = 12_000_000
THRESHOLD = 0.3
SEED = 7


def features(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature, and the row of texts it belongs to."""
    buf, starts = buffer_of(texts)
    words, begin, end, _ = words_of(buf, starts, lower=False)
    doc = (np.searchsorted(starts, begin, "right") - 1).astype(np.int32)
    mask = np.uint64(BUCKETS - 1)
    ids, rows = [words & mask], [doc]
    with np.errstate(over="ignore"):
        if len(words) > 1:
            same = doc[1:] == doc[:-1]
            ids.append(splitmix(words[:-1][same] * _ODD + words[1:][same]) & mask)
            rows.append(doc[1:][same])
        data = buf.astype(np.uint64) + np.uint64(1)
        length = end - begin
        inside = np.zeros(len(buf), np.int32)  # bytes from here to the end of the word
        if len(begin):
            at = np.repeat(end, length) - (np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(begin, length))
            inside[np.repeat(begin, length) + (np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length))] = at
        byte_doc = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
        for n in NGRAMS:
            if len(buf) < n:
                continue
            h = np.zeros(len(buf) - n + 1, np.uint64)
            for k, p in enumerate(powers(n)):
                h += data[k : len(buf) - n + 1 + k] * p
            ok = inside[: len(h)] >= n
            ids.append(splitmix(h[ok] + np.uint64(n)) & mask)
            rows.append(byte_doc[: len(h)][ok])
    return np.concatenate(ids).astype(np.int32), np.concatenate(rows)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares."""
    ids, _ = features([text])
    u, c = np.unique(ids, return_counts=True)
    return u.astype(np.int32), (c / max(len(ids), 1)).astype(np.float32)


def train(parts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weight of each bucket and bias: the log-odds of a document are the mean of its weights plus the bias."""
    if not len(parts):
        return np.zeros(BUCKETS, np.float32), 0.0
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    if labels.min() == labels.max():
        return np.zeros(BUCKETS, np.float32), bias
    rng = np.random.default_rng(SEED)
    table_ = rng.uniform(-1, 1, (BUCKETS, DIM)).astype(np.float32) / DIM
    layer = np.zeros((DIM, 2), np.float32)
    base = np.array([0.0, bias], np.float32)
    order = np.arange(len(parts))
    for epoch in range(EPOCHS):
        rng.shuffle(order)
        rate = RATE * (1 - epoch / EPOCHS)
        for i in order:
            u, w = parts[i]
            if not len(u):
                continue
            mean = w @ table_[u]
            z = mean @ layer + base
            p = np.exp(z - z.max())
            p /= p.sum()
            p[int(labels[i])] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            base -= 0.1 * rate * p
            table_[u] -= rate * (w / (w @ w))[:, None] * back  # moves the mean by rate * back
    weight = table_ @ (layer[:, 1] - layer[:, 0])
    return weight.astype(np.float32), float(base[1] - base[0])


def _features(it):
    for batch in it:
        for i in range(batch.num_rows):
            u, w = counted(batch.column("text")[i].as_py())
            yield pa.RecordBatch.from_arrays([batch.column(c).slice(i, 1) for c in ("id", "q")] + [pa.array([u.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())], names=["id", "q", "u", "w"])
    tidy()


def _train(it):
    """The model, as one row; nothing where there is nothing to learn from."""
    rows, left = [], TRAIN_FEATURES
    for batch in it:
        for id_, q, u, w in zip(*(batch.column(c).to_pylist() for c in ("id", "q", "u", "w")), strict=True):
            left -= len(u) // 4
            if left >= 0 or not rows:
                rows.append((id_, u, q, w))
    if rows:
        rows.sort(key=lambda r: r[:2])
        weight, bias = train([(np.frombuffer(u, np.int32), np.frombuffer(w, np.float32)) for _, u, _, w in rows], np.array([r[2] for r in rows], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([weight.tobytes()], pa.binary()), pa.array([bias])], names=["weight", "bias"])
    tidy()


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """The model for labels.quality, from at most `rows` labelled rows whose crc32(doc_id as text) mod 5 is not 0."""
    own = labels.selectExpr("cast(doc_id as bigint) id", "cast(quality as int) q").filter("q in (0, 1) and crc32(cast(id as string)) % 5 <> 0")
    own = own.groupBy("id").agg(F.max("q").alias("q")).orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.selectExpr("cast(doc_id as bigint) id", "cast(text as string) text")
    found = texts.join(F.broadcast(own), "id").select("id", "q", "text").mapInArrow(_features, "id bigint, q int, u binary, w binary")
    # A top-k by merge: one partition of at most `rows` rows, on which one task trains.
    found = found.orderBy(F.xxhash64("id"), "id", F.xxhash64("u", "w")).limit(rows)
    got = found.mapInArrow(_train, "weight binary, bias double").collect()
    return (np.frombuffer(got[0]["weight"], np.float32), got[0]["bias"]) if got else train([], np.zeros(0))


def score_quality(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id, held_out, score, predicted, row (row_key) for every row of docs (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(it):
        weight, bias = sent.value
        for block in batches(it):
            n = len(block["doc_id"])
            ids, rows = features(block["text"])
            total = np.bincount(rows, weight[ids], n)
            count = np.maximum(np.bincount(rows, minlength=n), 1)
            p = _sigmoid(total / count + bias)
            yield pa.RecordBatch.from_arrays([pa.array(block["doc_id"], pa.int64()), pa.array(block["row"], pa.int64()), pa.array(p, pa.float64())], names=["doc_id", "row", "score"])

    scored = row_key(docs).mapInArrow(score, "doc_id bigint, row bigint, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "row")


def op4_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, learn(docs, table(spark, sf_dir, "labels"))).drop("row")
