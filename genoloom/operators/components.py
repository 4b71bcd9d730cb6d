"""Connected components: of edges between numbers, and of transcripts that share exon bases."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .intervals import islands

#: Edges that one local contraction holds at a time.
LOCAL_EDGES = 500_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a local session (tests) gets a folder of its own; on a cluster it is an error, as a folder of one machine would lose data."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset: set it to a folder that driver and executors share")
        place = f"file://{tempfile.mkdtemp(prefix='genoloom-')}"
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def cut(df: DataFrame, label: str = "cut", codec: str | None = None) -> DataFrame:
    """Write to the shared folder (codec: packed by it, not by the session's) and read back: the plan starts anew there, rounds do not pile up in it, and it outlives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that an operator wrote and no longer reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard_cut(*tables: DataFrame) -> None:
    """Delete tables that were cut and that no plan reads any more."""
    for df in tables:
        for path in {os.path.dirname(f) for f in df.inputFiles()}:
            discard(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing refers to any more, as after a cut: it does so when the driver collects its garbage, which may be long after a disk is full. Twice, as what Python held is let go of in between."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node each is joined with, within these edges."""
    nodes, inv = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _contract(it):
    held, n = [], 0

    def flush():
        t = pa.Table.from_batches(held)
        node, root = roots(t.column("u").to_numpy(), t.column("v").to_numpy())
        keep = node != root
        return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(root[keep])], names=["u", "v"])

    for batch in it:
        held.append(batch)
        n += batch.num_rows
        if n >= LOCAL_EDGES:
            yield flush()
            held, n = [], 0
    if n:
        yield flush()


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(20,0)))")).first())


def components(edges: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) of every id that an edge (a, b) names; ids without edges are not listed. Null ends and loops are left out. Edges are contracted inside partitions, then by alternating large-star and small-star steps: rounds grow with the logarithm of the longest path; each is written to the shared folder."""
    e = edges.select(F.col("a").cast("bigint").alias("u"), F.col("b").cast("bigint").alias("v")).filter("u <> v")
    e = cut(e.mapInArrow(_contract, "u bigint, v bigint"), "edges")
    before = _sign(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        e = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = cut(e, "edges")
        after = _sign(e)
        if after == before:
            break
        before = after
    member = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return member.unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def exon_components(exons: DataFrame, keys: list[str], tx: str) -> DataFrame:
    """keys, tx, component (smallest tx of its component; tx is a number): transcripts of one key linked by a shared exon base. Islands by the strict rule link each transcript with the first one of the island; the links' components are found on numbers that stand for (keys, tx)."""
    link = cut(islands(exons, keys, touching=False).select(*keys, F.col(tx).alias("tx"), "island").distinct(), "links")
    release(link.sparkSession)
    node = cut(link.select(*keys, "tx").distinct().withColumn("node", F.monotonically_increasing_id()), "nodes")
    at = link.join(node, [*keys, "tx"])
    edge = at.join(at.groupBy(*keys, "island").agg(F.min("node").alias("b")), [*keys, "island"]).select(F.col("node").alias("a"), "b")
    part = components(edge).withColumnRenamed("id", "node")
    known = node.join(part, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = known.groupBy("component").agg(F.min("tx").alias("_least"))
    return known.join(least, "component").select(*keys, F.col("tx").alias(tx), F.col("_least").alias("component"))
