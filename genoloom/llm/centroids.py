"""Centroid clustering by sort-means, exact in integers.

Each round orders the other centroids by their distance from each centroid. A vector starts from the centroid it was assigned
to before, at distance d, and scans the others in that order; it stops at the first that is strictly further than 2 d from its
start, as by the triangle inequality neither that one nor any later one is nearer than d (at exactly 2 d one may be as near, and
win by its number). The vectors with their assignments are written once a round, with the sums of each task beside them, so a round
is one pass and what reaches the driver is a row for each centroid and dimension. A round's table is deleted when the next one
is there.

Components become floor(SCALE * x); beyond LARGE either way they count as LARGE, as no squared distance would fit a long. Vectors
that are null, of another length than DIMENSIONS, or hold null or non-finite components are left out. Starts are the vectors
with the smallest lowercase-hex sha256 of `3:<vec_id>` (a null vec_id counts as an empty text); equal ones, as of repeated rows,
go by their components. With fewer vectors than centroids each vector is a start. Of equally near centroids the smaller number
wins, so of equal centroids only the first gets vectors; an empty centroid stays where it is. Repeated rows are vectors of their
own. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import shared_folder
from .common import discard, matrix, table

DIMENSIONS = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
#: 64 squares of twice this fit a long.
LARGE = 1 << 27
ROW = "vec_id bigint, x array<int>, cluster int, distance bigint, n bigint, total array<bigint>"


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows of a and rows of b, one by one."""
    d = a.astype(np.int64) - b
    return np.einsum("...j,...j->...", d, d)


def sort_means(x: np.ndarray, centers: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row of x and its squared distance, scanned from the assignment before."""
    gap = squared(centers[:, None], centers[None])
    order = np.argsort(gap, axis=1, kind="stable")
    # gap > 4 d, where 4 d might not fit.
    quarter = np.take_along_axis(gap // 4 + (gap % 4 > 0), order, 1)
    start = squared(x, centers[before])
    best, who = start.copy(), before.copy()
    live = np.arange(len(x))
    for s in range(len(centers)):
        live = live[quarter[before[live], s] <= start[live]]
        if not len(live):
            break
        to = order[before[live], s]
        d = squared(x[live], centers[to])
        better = (d < best[live]) | ((d == best[live]) & (to < who[live]))
        best[live[better]], who[live[better]] = d[better], to[better]
    return who, best


def _round(centers: np.ndarray):
    def assign(it):
        k, d = centers.shape
        n, total, spread = np.zeros(k, np.int64), np.zeros((k, d), np.int64), [0] * k
        for batch in it:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"), d, np.int64)
            who, far = sort_means(x, centers, batch.column("cluster").to_numpy().astype(np.int64))
            for c in np.unique(who).tolist():
                own = who == c
                n[c] += own.sum()
                total[c] += x[own].sum(0)
                spread[c] += sum(far[own].tolist())
            none = pa.nulls(batch.num_rows, pa.int64()), pa.nulls(batch.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), pa.array(who.astype(np.int32)), pa.array(far), *none], names=["vec_id", "x", "cluster", "distance", "n", "total"])
        some = np.flatnonzero(n)
        # A task's sums: no vector of their own.
        far = pa.array([min(spread[c], (1 << 63) - 1) for c in some.tolist()], pa.int64())
        nil = pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*nil, pa.array(some.astype(np.int32)), far, pa.array(n[some]), pa.array(total[some].tolist(), pa.list_(pa.int64()))], names=["vec_id", "x", "cluster", "distance", "n", "total"])

    return assign


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, x (integers) of the vectors that take part."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    fine = (F.size("e") == DIMENSIONS) & F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    x = F.transform("e", lambda v: F.floor(F.greatest(F.least(v * SCALE, F.lit(float(LARGE))), F.lit(float(-LARGE)))).cast("int"))
    return rows.filter(F.coalesce(fine, F.lit(False))).select("vec_id", x.alias("x"))


def cluster(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """vec_id, cluster, distance of every vector that takes part, and a row for each centroid: cluster, x, n, cluster_inertia."""
    spark = vectors.sparkSession
    folder = f"{shared_folder(spark)}/centroids-{uuid.uuid4().hex}"
    rows = integer_vectors(vectors)
    first = rows.orderBy(F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256), "x").limit(centroids)
    starts = [r["x"] for r in first.collect()]
    if not starts:
        none = spark.createDataFrame([], "cluster int, x array<int>, n bigint, cluster_inertia bigint")
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")).filter("false"), none
    centers = np.array(starts, np.int64)
    now = rows.withColumn("cluster", F.lit(0))
    for turn in range(rounds + 1):
        path = f"{folder}/{turn}"
        now.select("vec_id", "x", "cluster").mapInArrow(_round(centers), ROW).write.parquet(path)
        done = spark.read.schema(ROW).parquet(path)
        sums = done.filter("n IS NOT NULL")
        if turn:
            discard(spark, f"{folder}/{turn - 1}")
        if turn < rounds:
            part = sums.select("cluster", "n", F.posexplode("total").alias("j", "v")).groupBy("cluster", "j").agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
            for r in part.collect():
                centers[r["cluster"], r["j"]] = int(r["v"]) // r["n"]
        now = done.filter("n IS NULL")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    got = {r["cluster"]: r for r in sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.least(F.sum(F.col("distance").cast("decimal(38,0)")), most).cast("bigint").alias("s")).collect()}
    about = [(c, x, got[c]["n"] if c in got else 0, got[c]["s"] if c in got else 0) for c, x in enumerate(centers.tolist())]
    return now.select("vec_id", "cluster", "distance"), spark.createDataFrame(about, "cluster int, x array<int>, n bigint, cluster_inertia bigint")


def op11_sort_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, about = cluster(table(spark, sf_dir, "embeddings"))
    # A row for each centroid.
    known = about.collect()
    inertia = min(sum(r["cluster_inertia"] for r in known), (1 << 63) - 1)
    digest = [(r["cluster"], r["cluster_inertia"], inertia, hashlib.sha256(",".join(map(str, r["x"])).encode()).hexdigest()) for r in known]
    return rows.join(F.broadcast(spark.createDataFrame(digest, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
