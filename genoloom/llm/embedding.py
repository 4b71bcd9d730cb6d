"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, verified pairs.

Equal vectors of one label form a class first; only one vector of a class is hashed and compared, with the number of its
members, so that a vector that a third of all rows hold costs one row. Each class is rotated by three rounds of random
signs and a fast Hadamard transform; a table's bucket is the signed largest coordinate of several such rotations, as many as
make buckets no larger however many classes there are (rotations_for). Besides it, the buckets with one second-largest
coordinate are entered. Buckets of one row are dropped before any vector moves. A
bucket of more than BLOCK classes is split into pairs of blocks, so that no task holds a whole large bucket; nothing is
capped. Every pair in a bucket is verified by its cosine in double precision and counts in one of its common buckets;
what leaves a task is the number of links of each class and a forest of them, not the pairs.

Vectors link when labels are equal and not null and the cosine is at least LEAST. Vectors that are null, empty, zero, or
hold null or non-finite components link with nothing, as do vectors of different lengths. Labels may be of any type that can
be hashed. Components are read in double precision. Repeated vec_ids, null ones too, are vectors of their own. Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import components, roots
from .common import cut, group_starts, pairs_in_groups, splitmix, table, whole_groups

LEAST = 0.98
TABLES = 10
BLOCK = 1024
SEED = 5


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotations_for(n: int, width: int) -> int:
    """Rotations of a bucket for n vectors: each divides a bucket by up to twice the width; one more than those that bring n to one."""
    return 1 + max(1, math.ceil(math.log(max(n, 2)) / math.log(2 * max(width, 2))))


def bucket_keys(x: np.ndarray, label: np.ndarray, rotations: int, tables: int = TABLES) -> np.ndarray:
    """Bucket keys of each row: (rows, (1 + rotations) * tables)."""
    n, d = x.shape
    wide = 1 << max(1, (d - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, wide - d)))
    rng = np.random.default_rng(SEED)
    signs = rng.choice(np.array([-1.0, 1.0]), (tables, rotations, 3, wide))
    rows, out = np.arange(n), []
    salt = splitmix(label.astype(np.int64).view(np.uint64) ^ np.uint64(d))
    for t in range(tables):
        parts = []
        for turn in range(rotations):
            y = x
            for r in range(3):
                y = hadamard(y * signs[t, turn, r])
            size = np.abs(y)
            best = size.argmax(1)
            first = 2 * best + (y[rows, best] < 0)
            size[rows, best] = -1
            second = size.argmax(1)
            parts.append((first, 2 * second + (y[rows, second] < 0)))
        for probe in range(-1, rotations):
            code = np.full(n, t + 1, np.uint64)
            for turn, both in enumerate(parts):
                code = splitmix(code * np.uint64(2 * wide) + both[turn == probe].astype(np.uint64))
            out.append(splitmix(code + salt))
    return np.stack(out, 1).view(np.int64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; components are brought below one first, so that no square is infinite."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hash(rotations: int):
    """class and key: all keys of each class."""

    def hashes(it):
        for batch in it:
            if not batch.num_rows:
                continue
            cls, label = batch.column("cls").to_numpy(), batch.column("label").to_numpy()
            col = batch.column("vec")
            size = np.asarray(col.value_lengths())
            flat, ends = np.asarray(col.flatten(), dtype=np.float64), np.cumsum(size)
            for d in np.unique(size):
                of = np.flatnonzero(size == d)
                keys = bucket_keys(unit(flat[(ends[of] - d)[:, None] + np.arange(d)]), label[of], rotations)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(cls[of], keys.shape[1])), pa.array(keys.ravel())], names=["cls", "key"])

    return hashes


def _verify(rotations: int):
    def verify(it):
        for t in whole_groups(it, ["key", "i", "j"], 4000):
            col = {n: t.column(n).to_numpy() for n in ("key", "i", "j", "b", "cls", "label", "members")}
            vec = t.column("vec").combine_chunks()
            size = np.asarray(vec.value_lengths())
            flat, ends = np.asarray(vec.flatten(), dtype=np.float64), np.cumsum(size)
            for at, to in _spans(group_starts([col["key"], col["i"], col["j"]])):
                for d in np.unique(size[at:to]):
                    own = np.arange(at, to)[size[at:to] == d]
                    yield from _links({n: v[own] for n, v in col.items()}, flat[(ends[own] - d)[:, None] + np.arange(d)], rotations)

    return verify


def _links(c: dict, x: np.ndarray, rotations: int):
    """Of whole cells: for each class with links its linked members (b null), and a forest (a, b) that joins what is linked."""
    x = unit(x)
    keys = bucket_keys(x, c["label"], rotations)
    linked, ends = np.zeros(len(x), np.int64), []
    for left, right in pairs_in_groups(group_starts([c["key"], c["i"], c["j"]])):
        ok = (c["i"][left] == c["j"][left]) | (c["b"][left] != c["b"][right])
        ok &= (c["label"][left] == c["label"][right]) & (c["cls"][left] != c["cls"][right])
        left, right = left[ok], right[ok]
        ok = np.concatenate([np.zeros(0, bool), *(np.einsum("ij,ij->i", x[left[k : k + 50_000]], x[right[k : k + 50_000]]) >= LEAST for k in range(0, len(left), 50_000))])
        left, right = left[ok], right[ok]
        for k in range(0, len(left), 20_000):
            p, q = left[k : k + 20_000], right[k : k + 20_000]
            # A pair counts in the smallest of its common buckets.
            common = keys[p][:, :, None] == keys[q][:, None, :]
            once = np.where(common.any(2), keys[p], np.iinfo(np.int64).max).min(1) == c["key"][p]
            p, q = p[once], q[once]
            linked += np.bincount(p, c["members"][q], len(x)).astype(np.int64) + np.bincount(q, c["members"][p], len(x)).astype(np.int64)
            ends.append(np.stack(roots(c["cls"][p], c["cls"][q]), 1))
    some = np.flatnonzero(linked)
    if len(some):
        ends = np.concatenate(ends)
        node, root = roots(ends[:, 0], ends[:, 1])
        node, root = node[node != root], root[node != root]
        a = np.concatenate((c["cls"][some], node))
        nil = np.concatenate((np.ones(len(some), bool), np.zeros(len(node), bool)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(np.concatenate((c["cls"][some], root)), mask=nil), pa.array(np.concatenate((linked[some], np.zeros(len(node), np.int64))))], names=["a", "b", "linked"]
        )


def _spans(starts: np.ndarray, most: int = 4096):
    """Runs of whole groups of about `most` rows, as (first row, end)."""
    at = 0
    while at < len(starts) - 1:
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + most, "right")) - 1)
        yield int(starts[at]), int(starts[to])
        at = to


def near_vectors(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.xxhash64("label").alias("label"), F.col("label").isNotNull().alias("labelled"), F.col("embedding").cast("array<double>").alias("vec"))
    fine = F.col("labelled") & (F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vec", lambda x: x != 0)
    fine = F.coalesce(fine, F.lit(False))
    rows = rows.withColumn("cls", F.when(fine, F.xxhash64("label", "vec")))
    classes = cut(rows.filter("cls IS NOT NULL").groupBy("cls", "label").agg(F.first("vec").alias("vec"), F.min("vec_id").alias("least"), F.count("*").alias("members")), "classes")
    n, width = classes.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(1))).first()
    rotations = rotations_for(n, width)
    keys = cut(classes.mapInArrow(_hash(rotations), "cls bigint, key bigint").distinct(), "keys")
    full = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    g = F.ceil(F.col("n") / F.lit(float(block))).cast("int")
    cells = keys.join(full, "key").withColumn("g", g).withColumn("b", F.pmod(F.hash("cls"), "g")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    cells = cells.select("key", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "b", "cls")
    filled = cells.join(classes.drop("least"), "cls")
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = cut(filled.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_verify(rotations), "a bigint, b bigint, linked bigint"), "links")
    other = links.filter("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("linked").alias("others"))
    comp = components(links.filter("b IS NOT NULL")).withColumnRenamed("id", "cls")
    joined = classes.select("cls", "least", "members").join(comp, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    low = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    known = joined.join(low, "component").join(other, "cls", "left").select("cls", "component_id", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = rows.select("vec_id", "cls").join(cut(known, "known"), "cls", "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )


def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
