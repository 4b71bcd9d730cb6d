"""Hard-negative mining: for each anchor and each of its nearest rows of the same label, the nearest rows of other labels whose score
lies in a window below the positive's.

Each task builds ball trees over the rows it reads, at most TREE_ROWS a tree: a node holds the mean of its rows and the largest
distance from it, so the inner product of an anchor with any row of the node lies within |anchor| * radius of its product with
the mean. A search takes the node with the highest upper bound first. A node is left out if its upper bound is below the window
or strictly below the kth score found so far (equal scores may win by vec_id), or its lower bound is above the window. What
leaves a task is k rows for each anchor and window; the best of all tasks are taken by rank. The rows stay where they
are read, and anchors are broadcast in blocks of at most ANCHOR_BYTES, one pass for positives and one for negatives each, so that
no row meets another by a shuffle and a label that a third of the rows hold is no key.

Scores are inner products of the integers floor(SCALE * x); components beyond LARGE either way count as LARGE, as 100 times a score
of 4,096 of them would not fit a long. Rows with a null label, a null vector, or a null or non-finite component take no part. Rows
of different lengths have no score with each other; an empty vector scores 0 with empty vectors. A null vec_id is no anchor,
keeps its label and comes last among ties; repeated rows are rows of their own, ties between them go by a number given to each row. A
negative positive score has an empty window, a score of 0 one that holds only 0. Other columns are ignored. An empty table, or one
without anchors, gives an empty result.
"""

from __future__ import annotations

import heapq
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.components import shared_folder
from .common import cut, table

ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 10
#: The window, in hundredths of the positive's score.
LOW, HIGH = 30, 90
SCALE = 256
LARGE = 1 << 22
TREE_ROWS = 65_536
LEAF = 128
ANCHOR_BYTES = 8 << 20
#: Anchors whose products with all nodes are held at a time.
TOGETHER = 256
FAR = 1 << 62


class BallTree:
    """Rows (integer vectors) in balls: node i has a center, a radius, its rows at begin[i]..end[i] of order, and children (0: a leaf)."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(x))
        centers, radius, self.begin, self.end, self.child = [], [], [], [], []
        x = x.astype(np.float64)
        waiting = [(0, len(x), -1)]
        while waiting:
            lo, hi, parent = waiting.pop()
            node = len(centers)
            if parent >= 0 and not self.child[parent]:
                self.child[parent] = node
            elif parent >= 0:
                self.child[parent] = (self.child[parent], node)
            own = x[self.order[lo:hi]]
            center = own.mean(0)
            apart = np.sqrt(((own - center) ** 2).sum(1))
            centers.append(center)
            radius.append(apart.max())
            self.begin.append(lo)
            self.end.append(hi)
            self.child.append(0)
            if hi - lo > leaf and radius[-1] > 0:
                # Along the line of two far rows, half to each side.
                a = own[apart.argmax()]
                b = own[((own - a) ** 2).sum(1).argmax()]
                half = (hi - lo) // 2
                self.order[lo:hi] = self.order[lo:hi][np.argpartition(own @ (b - a), half)]
                waiting += [(lo + half, hi, node), (lo, lo + half, node)]
        self.centers, self.radius = np.array(centers), np.array(radius)
        # Products are whole numbers; in doubles they are exact below 2**53.
        whole = x.shape[1] * np.abs(x).max(initial=0) ** 2 < 2**53
        self.rows = x[self.order] if whole else x[self.order].astype(np.int64)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bounds of the product of each anchor with the rows of each node; rounding only widens them."""
        q = anchors.astype(np.float64)
        size = np.sqrt((q**2).sum(1))[:, None]
        middle, reach = q @ self.centers.T, size * self.radius
        slack = 1 + 1e-9 * (size * np.sqrt((self.centers**2).sum(1)) + reach)
        return middle + reach + slack, middle - reach - slack

    def best(self, q: np.ndarray, upper: np.ndarray, lower: np.ndarray, wanted: np.ndarray, rank: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (least and most score) the first k of the wanted rows, by falling score and rising rank: places in order, scores."""
        q = q.astype(self.rows.dtype)
        floors, found = [lo for lo, _ in windows], [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(windows)
        heap = [(-upper[0], 0)]
        while heap:
            top, node = heapq.heappop(heap)
            if all(-top < least for least in floors):
                break
            if all(-top < least or lower[node] > hi for least, (_, hi) in zip(floors, windows, strict=True)):
                continue
            if self.child[node]:
                for c in self.child[node]:
                    heapq.heappush(heap, (-upper[c], c))
                continue
            a, b = self.begin[node], self.end[node]
            score = (self.rows[a:b] @ q).astype(np.int64)
            for w, (_, hi) in enumerate(windows):
                ok = np.flatnonzero(wanted[a:b] & (score >= floors[w]) & (score <= hi))
                if not len(ok):
                    continue
                place, value = np.concatenate((found[w][0], ok + a)), np.concatenate((found[w][1], score[ok]))
                first = np.lexsort((rank[place], -value))[:k]
                found[w] = place[first], value[first]
                if len(first) == k:
                    floors[w] = max(floors[w], int(value[first[-1]]))
        return found


def _trees(it):
    """Trees over at most TREE_ROWS rows of one length each, and their rows' columns in tree order."""
    held, rows = [], 0

    def grow():
        t = pa.Table.from_batches(held).combine_chunks()
        x = t.column("x").chunk(0)
        size = np.asarray(x.value_lengths())
        flat, ends = np.asarray(x.flatten(), dtype=np.int64), np.cumsum(size)
        for d in np.unique(size).tolist():
            own = np.flatnonzero(size == d)
            tree = BallTree(flat[(ends[own] - d)[:, None] + np.arange(d)])
            own = own[tree.order]
            part = t.select(["rid", "vec_id", "label"]).take(pa.array(own))
            id_ = part.column("vec_id")
            lost = np.asarray(id_.is_null())
            rid = part.column("rid").to_numpy()
            rank = np.empty(len(own), np.int64)
            rank[np.lexsort((rid, id_.fill_null(0).to_numpy(), lost))] = np.arange(len(own))
            yield d, tree, rid, id_.combine_chunks(), part.column("label").to_numpy(), rank

    for batch in it:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, TREE_ROWS - rows)
            held.append(part)
            rows += part.num_rows
            at += part.num_rows
            if rows == TREE_ROWS:
                yield from grow()
                held, rows = [], 0
    if rows:
        yield from grow()


def _search(block, k: int, same: bool):
    """For each anchor and window of the block (a broadcast list of rid, label, x, windows as (key, least, most)): its k best rows in each tree."""

    def search(it):
        by_length: dict[int, list] = {}
        for a in block.value:
            by_length.setdefault(len(a[2]), []).append(a)
        for d, tree, rid, vec_id, label, rank in _trees(it):
            anchors = by_length.get(d, [])
            for at in range(0, len(anchors), TOGETHER):
                some = anchors[at : at + TOGETHER]
                q = np.array([a[2] for a in some], np.int64).reshape(len(some), d)
                upper, lower = tree.bounds(q)
                out = [], [], [], []
                for i, (own, kind, _, windows) in enumerate(some):
                    wanted = (label == kind) & (rid != own) if same else label != kind
                    got = tree.best(q[i], upper[i], lower[i], wanted, rank, [w[1:] for w in windows], k)
                    for (key, _, _), (place, score) in zip(windows, got, strict=True):
                        for col, v in zip(out, (np.full(len(place), own), np.full(len(place), key), place, score), strict=True):
                            col.append(v)
                anchor, key, place, score = (np.concatenate([np.zeros(0, np.int64), *c]) for c in out)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(key), vec_id.take(pa.array(place)), pa.array(rid[place]), pa.array(score)], names=["anchor", "key", "vec_id", "rid", "score"])

    return search


def _first(rows: DataFrame, search, k: int) -> DataFrame:
    """anchor, key, vec_id, rid, score, rank: the k best of all trees for each anchor and key."""
    got = rows.select("rid", "vec_id", "label", "x").mapInArrow(search, "anchor bigint, key bigint, vec_id bigint, rid bigint, score bigint")
    order = Window.partitionBy("anchor", "key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return got.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def scored_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, label (shifted for every seventh vec_id), x (integers) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    fine = F.col("label").isNotNull() & F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    x = F.transform("e", lambda v: F.floor(F.greatest(F.least(v * SCALE, F.lit(float(LARGE))), F.lit(float(-LARGE)))).cast("int"))
    return rows.filter(F.coalesce(fine, F.lit(False))).select("vec_id", label.alias("label"), x.alias("x"))


def hard_negatives(vectors: DataFrame, anchor_bytes: int | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of vectors (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    most = ANCHOR_BYTES if anchor_bytes is None else anchor_bytes
    # A row's number, given once, as a table is read more than once.
    rows = cut(scored_rows(vectors).withColumn("rid", F.monotonically_increasing_id()), "rows")
    anchors = rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0)
    n, width = anchors.agg(F.count("*"), F.coalesce(F.sum(F.size("x") * 8 + 200 * POSITIVES), F.lit(0))).first()
    folder, schema = f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}", "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    blocks = -(-width // most) if n else 0
    for b in range(blocks):
        # At most about ANCHOR_BYTES of anchors.
        own = {r["rid"]: r for r in anchors.filter(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == b).collect()}
        if not own:
            continue
        ask = spark.sparkContext.broadcast([(i, r["label"], r["x"], [(0, -FAR, FAR)]) for i, r in own.items()])
        near = _first(rows, _search(ask, POSITIVES, True), POSITIVES).select("anchor", "vec_id", "rank", "score").collect()
        ask.destroy()
        windows: dict[int, list] = {}
        for r in near:
            windows.setdefault(r["anchor"], []).append((r["rank"], -(-LOW * r["score"] // 100), HIGH * r["score"] // 100))
        ask = spark.sparkContext.broadcast([(i, own[i]["label"], own[i]["x"], [w for w in part if w[1] <= w[2]]) for i, part in windows.items()])
        pairs = spark.createDataFrame([(r["anchor"], r["rank"], own[r["anchor"]]["vec_id"], r["vec_id"], r["score"]) for r in near], "anchor bigint, key bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
        got = _first(rows, _search(ask, NEGATIVES, False), NEGATIVES).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        # At most POSITIVES rows for each anchor of the block.
        got.join(F.broadcast(pairs), ["anchor", "key"]).select(*[c.split()[0] for c in schema.split(", ")]).write.parquet(f"{folder}/block={b}")
        ask.destroy()
    if not n:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder)


def op13_ball_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))
