"""Interval operators: 1-based closed coordinates, any key columns.

Two adjacency rules are kept apart: touching=True joins intervals that touch (union of bases), touching=False needs a shared
base (clustering). Joins are equi joins on bins, so that a long contig spreads over many tasks; a plain overlap condition
would be a sort-merge join that is quadratic inside a contig.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bins are a power of two between these widths when they are chosen from the data.
LEAST_BIN, MOST_BIN = 1 << 10, 1 << 20
#: Bases of a tile, inside which intervals are united before tiles are.
TILE = 1 << 18


def _runs(df: DataFrame, keys: list[str], touching: bool, start: str, end: str, name: str) -> DataFrame:
    """df with the number of the island of its keys: a running maximum of ends, then a running sum of gaps."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col(start) > before + (1 if touching else 0)), 1).otherwise(0)
    return df.withColumn("_opens", opens).withColumn(name, F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_opens")


def _tiled(df: DataFrame, keys: list[str], touching: bool, start: str, end: str, tile: int) -> DataFrame:
    """df with _tile and the number _run of its run among the intervals of its keys that start in one tile, so that a long or crowded contig is many tasks."""
    return _runs(df.withColumn("_tile", F.floor(F.col(start) / tile)), [*keys, "_tile"], touching, start, end, "_run")


def islands(df: DataFrame, keys: list[str], touching: bool = True, start: str = "start", end: str = "end", name: str = "island", tile: int = TILE) -> DataFrame:
    """df with the number of the island (within its keys) each interval belongs to. Runs are found tile by tile; only they, whose number a contig's length bounds and not its rows, meet in one window per key, and give their rows the number."""
    rows = _tiled(df, keys, touching, start, end, tile)
    own = [*keys, "_tile", "_run"]
    runs = rows.groupBy(*own).agg(F.min(start).alias("_s"), F.max(end).alias("_e"))
    runs = _runs(runs, keys, touching, "_s", "_e", name).select(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(own)], name)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(own)]
    return rows.join(runs, same).select(*df.columns, name)


def merge_intervals(df: DataFrame, keys: list[str], touching: bool = True, start: str = "start", end: str = "end", tile: int | None = TILE) -> DataFrame:
    """keys, start, end, n: union of the intervals of each key, first inside tiles, then of what is left. tile None: in one pass, for keys with few intervals each, such as transcripts."""
    union = lambda rows, of, n: rows.groupBy(*of).agg(F.min(start).alias(start), F.max(end).alias(end), n.alias("n"))
    rows = df.select(*keys, start, end)
    if tile is None:
        return union(_runs(rows, keys, touching, start, end, "_run"), [*keys, "_run"], F.count("*")).drop("_run")
    runs = union(_tiled(rows, keys, touching, start, end, tile), [*keys, "_tile", "_run"], F.count("*")).drop("_tile", "_run")
    return union(_runs(runs, keys, touching, start, end, "_run"), [*keys, "_run"], F.sum("n")).drop("_run")


def bin_width(*frames: DataFrame, start: str = "start", end: str = "end") -> int:
    """A power of two near the 99th percentile of interval length of the longer side, within bounds."""
    most = 0
    for df in frames:
        got = df.select((F.col(end) - F.col(start) + 1).alias("n")).agg(F.percentile_approx("n", 0.99)).first()[0]
        most = max(most, got or 0)
    width = LEAST_BIN
    while width < most and width < MOST_BIN:
        width *= 2
    return width


def _bins(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    return df.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", bin_size: int | None = None, prefix: str = "r_") -> DataFrame:
    """Pairs of overlapping intervals (how inner or left: right's columns but the keys get a prefix), or left's rows with
    (left_semi) or without (left_anti) an overlap. A pair is reported from the one bin that holds the start of its overlap.
    """
    width = bin_size or bin_width(left, right)
    if how in ("left_semi", "left_anti"):
        probe = _bins(left.select(*keys, "start", "end").distinct(), "start", "end", width)
        other = _bins(right.select(*keys, F.col("start").alias("_s"), F.col("end").alias("_e")), "_s", "_e", width)
        hit = probe.join(other, [*keys, "_bin"]).filter((F.col("start") <= F.col("_e")) & (F.col("_s") <= F.col("end")))
        return left.join(hit.select(*keys, "start", "end").distinct(), [*keys, "start", "end"], how).select(*left.columns)
    renamed = right.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in right.columns if c not in keys])
    s, e = f"{prefix}start", f"{prefix}end"
    pairs = _bins(left, "start", "end", width).join(_bins(renamed, s, e, width), [*keys, "_bin"])
    pairs = pairs.filter((F.col("start") <= F.col(e)) & (F.col(s) <= F.col("end")) & (F.col("_bin") == F.floor(F.greatest("start", s) / width)))
    pairs = pairs.drop("_bin").select(*left.columns, *[c for c in renamed.columns if c not in keys])
    if how == "inner":
        return pairs
    if how != "left":
        raise ValueError(f"unknown kind of join: {how}")
    rest = interval_join(left, right, keys, "left_anti", width)
    return pairs.unionByName(rest, allowMissingColumns=True)


def covered_bases(df: DataFrame, keys: list[str], cover: DataFrame, ids: list[str], bin_size: int | None = None) -> DataFrame:
    """ids, covered: bases of each id's intervals inside the union of cover."""
    union = merge_intervals(cover, keys)
    pairs = interval_join(df, union, keys, "inner", bin_size)
    shared = F.least("end", "r_end") - F.greatest("start", "r_start") + 1
    some = pairs.groupBy(*ids).agg(F.sum(shared).alias("covered"))
    return df.select(*ids).distinct().join(some, ids, "left").withColumn("covered", F.coalesce("covered", F.lit(0)).cast("bigint"))


def gaps(df: DataFrame, keys: list[str], at_least: int = 1) -> DataFrame:
    """Introns: the gaps between neighbouring intervals of each key, with their number ix; gaps shorter than at_least are left out."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    out = df.withColumn("_next", F.lead("start").over(w)).withColumn("ix", F.row_number().over(w).cast("bigint"))
    out = out.filter(F.col("_next").isNotNull()).withColumn("start", F.col("end") + 1).withColumn("end", F.col("_next") - 1).drop("_next")
    return out.filter(F.col("end") - F.col("start") + 1 >= at_least)


def depth_segments(df: DataFrame, keys: list[str], depth: str = "depth", how: str = "max", bin_size: int | None = None) -> DataFrame:
    """keys, start, end, depth: elementary segments of the intervals with the largest (how max) or summed (how sum) depth over them; neighbours of equal depth are joined, segments without an interval dropped. Sums are running sums of what begins and ends; for the largest, intervals of one depth are united first, so that a segment meets each depth once however many intervals lie over it."""
    w = Window.partitionBy(*keys).orderBy("start")
    if how == "sum":
        ends = df.select(*keys, F.inline(F.array(F.struct(F.col("start").alias("start"), F.col(depth).alias("d"), F.lit(1).alias("n")), F.struct((F.col("end") + 1).alias("start"), (-F.col(depth)).alias("d"), F.lit(-1).alias("n")))))
        ends = ends.groupBy(*keys, "start").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        got = ends.select(*keys, "start", (F.lead("start").over(w) - 1).alias("end"), F.sum("d").over(run).alias("depth"), F.sum("n").over(run).alias("_n")).filter("_n > 0 AND depth > 0").drop("_n")
    else:
        flat = merge_intervals(df.select(*keys, F.col(depth).alias("depth"), "start", "end"), [*keys, "depth"]).select(*keys, "depth", "start", "end")
        edge = flat.select(*keys, F.explode(F.array(F.col("start"), F.col("end") + 1)).alias("start")).distinct()
        parts = edge.withColumn("end", F.lead("start").over(w) - 1).filter(F.col("end").isNotNull())
        got = interval_join(parts, flat, keys, "inner", bin_size).groupBy(*keys, "start", "end").agg(F.max("r_depth").alias("depth")).filter("depth > 0")
    new = F.coalesce((F.lag("end").over(w) + 1 != F.col("start")) | (F.lag("depth").over(w) != F.col("depth")), F.lit(True))
    got = got.withColumn("_new", new.cast("int")).withColumn("_g", F.sum("_new").over(w))
    return got.groupBy(*keys, "_g", "depth").agg(F.min("start").alias("start"), F.max("end").alias("end")).select(*keys, "start", "end", "depth")


def _before(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows (keys, _p, _row, _o: barriers with _row 0, questions with 1) with _best, the barrier of the largest _p strictly before a question, and _alt, the best of another owner than that one's. Equal places: questions come first."""
    w = Window.partitionBy(*keys).orderBy("_p", F.col("_row").desc(), "_o").rowsBetween(Window.unboundedPreceding, -1)
    u = rows.withColumn("_best", F.max(F.when(F.col("_row") == 0, F.struct("_p", "_o"))).over(w))
    # For barriers: the best one before them of another owner than theirs, carried on.
    u = u.withColumn("_alt", F.when((F.col("_row") == 0) & (F.col("_best._o") != F.col("_o")), F.col("_best")))
    return u.withColumn("_alt", F.last("_alt", ignorenulls=True).over(w))


def nearest(df: DataFrame, barriers: DataFrame, keys: list[str], own: str, tile: int = TILE) -> DataFrame:
    """df with left_end (largest end before its start) and right_start (smallest start behind its end) of barriers of another `own`. Barriers and rows meet tile by tile; each tile begins with the two nearest barriers of different owners from the tiles before it, so that the own one can be skipped. These come from a scan over two rows a tile, whose number a contig's length bounds and not its rows."""

    def side(frame: DataFrame, at: Column, barrier_at: Column, largest: bool, name: str) -> DataFrame:
        sign = 1 if largest else -1
        place = F.floor(F.col("_p") / tile)
        b = barriers.select(*keys, F.col(own).alias("_o"), (sign * barrier_at).alias("_p")).filter("_o IS NOT NULL AND _p IS NOT NULL").distinct().withColumn("_tile", place)
        u = frame.withColumn("_p", sign * at).withColumn("_tile", place).withColumn("_row", F.lit(1)).withColumn("_o", F.lit(None).cast(b.schema["_o"].dataType))
        # The two last barriers of each tile that differ in owner.
        of_owner = b.groupBy(*keys, "_tile", "_o").agg(F.max("_p").alias("_p"))
        two = of_owner.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_tile").orderBy(F.desc("_p"), F.desc("_o")))).filter("_r <= 2").drop("_r")
        asks = u.select(*keys, "_tile").distinct().select("*", (F.col("_tile") * tile).alias("_p"), F.lit(1).alias("_row"))
        over = _before(two.withColumn("_row", F.lit(0)).unionByName(asks, allowMissingColumns=True), keys).filter("_row = 1")
        held = over.select(*keys, "_tile", F.explode(F.array("_best", "_alt")).alias("_b")).filter("_b IS NOT NULL").select(*keys, "_tile", "_b._p", "_b._o")
        inside = b.unionByName(held).withColumn("_row", F.lit(0))
        u = _before(u.unionByName(inside, allowMissingColumns=True), [*keys, "_tile"])
        chosen = F.when(F.col("_best._o") != F.col(own), F.col("_best._p")).when(F.col("_best._o").isNotNull(), F.col("_alt._p"))
        return u.filter("_row = 1").withColumn(name, sign * chosen).drop("_p", "_tile", "_row", "_o", "_best", "_alt")

    out = side(df, F.col("start"), F.col("end"), True, "left_end")
    return side(out, F.col("end"), F.col("start"), False, "right_start")
