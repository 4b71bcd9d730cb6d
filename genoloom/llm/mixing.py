"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions alone.

Every document of a source starts with the same fractional number of copies f = target / source size. The whole part is
taken as it is; the fractional parts go through a tournament. Two documents that meet move probability mass between them
so that the words they are expected to bring stay the same, until one of them is 0 or 1; the other one goes on. Groups of
about FAN documents play in one array fold; the one that is left of each group meets others of its source in the next
round, so that the rounds form a tree of depth log_FAN(documents). A source's sum of words therefore never moves by more
than its last document.

Nulls: a null text has size 0; a null source is a source of its own, after the others. Documents of size 0 take 0. Rows with
a null or repeated doc_id play as documents of their own, equal rows too: their draws take the place of the row in the written
table of sizes into account, those of all other rows only the row's own values. Texts of any length count whole. Sources are
few: the running sums of targets are windows over one row for each source. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, key_of, small_side, table

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
FAN = 32
SEED = 20240229
WORD = r"[^\x20\x09-\x0D]+"
EPS = 1e-12
#: What stands for a row in the tournament; `own` is what its draws depend on.
ID = "struct<doc_id:bigint,own:bigint,carry:bigint>"


def _let(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source: source_size, n (documents with words), target. A target stops at most * source_size; what is over goes to the others by weight. One row per source; the water level comes from running sums over the sources in the order in which they reach their limit."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    array = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("w", F.element_at(array, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", most * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("w"))
    every = W.partitionBy()
    upto = W.orderBy("full_at").rangeBetween(W.unboundedPreceding, W.currentRow)
    per = per.withColumn("all_size", F.sum("source_size").over(every)).withColumn("all_w", F.sum("w").over(every))
    per = per.withColumn("level", F.sum("cap").over(upto) + F.col("full_at") * (F.col("all_w") - F.sum("w").over(upto)))
    per = per.withColumn("full", F.col("level") <= share * F.col("all_size"))
    rest = share * F.col("all_size") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0.0))
    free = F.sum(F.when(~F.col("full"), F.col("w"))).over(every)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("w") * rest / free))
    return per.select("source", "source_size", "n", target.alias("target"))


def _fold(rows: Column, last: bool) -> Column:
    """Plays the documents of one group in order. rows: array of (h, id, size, p). Gives (id, size, p) of the one that is left, or nulls, and out: (id, size, up) of the others; with last, the one that is left is drawn."""
    none = F.struct(F.lit(None).cast(ID).alias("id"), F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("double").alias("p"))
    empty = F.array().cast(f"array<struct<id:{ID},size:bigint,up:boolean>>")
    unit = lambda *x: (F.xxhash64(F.lit(SEED), *x).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52)))
    done = lambda id_, size, p: F.struct(id_.alias("id"), size.alias("size"), (p > 0.5).alias("up"))
    keep = lambda s: F.struct(s["id"].alias("id"), s["size"].alias("size"), s["p"].alias("p"))

    def meet(acc: Column, x: Column) -> Column:
        r, a, b = acc["r"], acc["r"]["size"].cast("double"), x["size"].cast("double")
        p, q = r["p"], x["p"]
        moves = F.struct(
            F.least(1 - p, q * b / a).alias("d1"), F.least(p, (1 - q) * b / a).alias("d2"),
            (1 - p <= q * b / a).alias("p_full"), (p <= (1 - q) * b / a).alias("p_empty"), unit(r["id"]["own"], x["id"]["own"]).alias("u"),
        )

        def moved(m: Column) -> Column:
            up = m["u"] * (m["d1"] + m["d2"]) < m["d2"]
            p2 = F.when(up, F.when(m["p_full"], 1.0).otherwise(p + m["d1"])).otherwise(F.when(m["p_empty"], 0.0).otherwise(p - m["d2"]))
            q2 = F.when(up, F.when(m["p_full"], q - m["d1"] * a / b).otherwise(0.0)).otherwise(F.when(m["p_empty"], q + m["d2"] * a / b).otherwise(1.0))
            return F.struct(p2.alias("p"), q2.alias("q"))

        def settle(s: Column) -> Column:
            whole = lambda v: (v < EPS) | (v > 1 - EPS)
            first, second = done(r["id"], r["size"], s["p"]), done(x["id"], x["size"], s["q"])
            left_x = F.struct(x["id"].alias("id"), x["size"].alias("size"), s["q"].alias("p"))
            left_r = F.struct(r["id"].alias("id"), r["size"].alias("size"), s["p"].alias("p"))
            return (
                F.when(whole(s["p"]) & whole(s["q"]), F.struct(none.alias("r"), F.concat(acc["out"], F.array(first, second)).alias("out")))
                .when(whole(s["p"]), F.struct(left_x.alias("r"), F.concat(acc["out"], F.array(first)).alias("out")))
                .otherwise(F.struct(left_r.alias("r"), F.concat(acc["out"], F.array(second)).alias("out")))
            )

        return F.when(p.isNull(), F.struct(keep(x).alias("r"), acc["out"].alias("out"))).otherwise(_let(_let(moves, moved), settle))

    def finish(acc: Column) -> Column:
        if not last:
            return acc
        r = acc["r"]
        drawn = F.struct(r["id"].alias("id"), r["size"].alias("size"), (unit(r["id"]["own"], F.lit(-1)) < r["p"]).alias("up"))
        return F.struct(none.alias("r"), F.when(r["p"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(drawn))).alias("out"))

    return F.aggregate(rows, F.struct(none.alias("r"), empty.alias("out")), meet, finish)


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, fan: int = FAN, carry: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row of docs (doc_id, source, text), and its column `carry` (bigint) where one is named."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    carried = F.lit(None) if carry is None else docs[carry]
    sized = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["source"], size.alias("size"), key_of(docs).alias("key"), carried.cast("bigint").alias("carry"))
    sized = cut(sized.withColumn("place", F.monotonically_increasing_id()), "sized")
    twins = cut(sized.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1").select("key", F.lit(True).alias("twin")), "twins")
    # What the draws of a row depend on: its values, and its place only if it has an equal.
    own = F.xxhash64("key", "source", F.when(F.col("twin"), F.col("place")))
    sized = cut(sized.join(small_side(twins, 24), "key", "left").select("doc_id", "source", "size", "carry", own.alias("own")), "rows")
    per = cut(targets(sized, weights, share, most), "targets")
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sized.join(per, sized["source"].eqNullSafe(per["source"])).select(
        "doc_id", sized["source"], "size", "carry", "own", "source_size", "target", "n", F.floor(f).alias("base"), (f - F.floor(f)).alias("p")
    )
    plays = (F.col("size") > 0) & (F.col("p") > EPS)
    rows = rows.withColumn("plays", plays)
    settled = [rows.filter(~F.col("plays")).select("doc_id", "carry", "source", "size", "source_size", "target", F.when(F.col("p") > 1 - EPS, F.col("base") + 1).otherwise(F.col("base")).alias("copies"))]
    most_n = per.agg(F.max("n")).first()[0] or 0
    rounds = max(1, math.ceil(math.log(max(most_n, 2), fan)))
    keys = ["source", "source_size", "target", "n", "base"]
    live = rows.filter("plays").select(*keys, F.struct("doc_id", "own", "carry").alias("id"), "size", "p")
    for k in range(1, rounds + 1):
        groups = F.ceil(F.col("n") / F.lit(float(fan) ** k)).cast("bigint")
        h = F.xxhash64(F.lit(SEED + k), "id.own", "size")
        played = (
            live.select(*keys, F.pmod(h, groups).alias("g"), F.struct(h.alias("h"), "id", "size", "p").alias("x"))
            .groupBy(*keys, "g")
            .agg(F.sort_array(F.collect_list("x")).alias("xs"))
            .select(*keys, _fold(F.col("xs"), k == rounds).alias("f"))
        )
        played = cut(played.select(*keys, "f.r", "f.out"), f"round{k}")
        out = played.select(*keys, F.inline("out"))
        settled.append(out.select("id.doc_id", "id.carry", "source", "size", "source_size", "target", (F.col("base") + F.col("up").cast("int")).alias("copies")))
        live = played.filter("r.p IS NOT NULL").select(*keys, "r.id", "r.size", "r.p")
    done = settled[0]
    for x in settled[1:]:
        done = done.unionByName(x)
    kept = [] if carry is None else [F.col("carry").alias(carry)]
    return done.select("doc_id", "source", "size", "source_size", "target", F.col("copies").cast("int").alias("copies"), (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), *kept)


def op9_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
