"""N-gram Jaccard join by partitioning the universe of shingles, exact at its threshold.

A document is the set of its distinct word shingles, each a 64-bit hash. Sets are put in size bands so narrow that a similar
pair lies in one band or in two neighbouring ones; the pair is looked for in the band of the smaller set. A band splits the
universe of hashes into segments. A pair may differ in at most H shingles, and each differing shingle spoils one segment, so
a segment that is entered whole survives unless it holds a difference, and a segment that is entered with all its one-deletion
neighbours survives unless it holds two. plan() chooses for every band how many segments of either kind to use: enough that
more than SLACK of them survive H differences, at the lowest cost, which counts entries and the chance that unrelated sets
meet in a short segment.

The surplus is what keeps skew out without losing a pair: a document leaves out its empty segments, and entries that more
than CAP sets share. If either set of a pair leaves out no more than the surplus, the pair still meets in an entry that both
kept. Only sets that leave out more than half the surplus (members of large groups of near copies, mostly) are compared by a
second, finer partition: there a similar pair shares at least as many entries as it may differ in, so that each set needs to
show only its rarest entries, by a global count, and a set with too few common ones shows none (a prefix filter). Entries of
many sets are compared with one pivot, the set that shows most of them, and then only across the components that are still
apart, in blocks; pairs inside a component need no further comparison, as the result holds components. Sets that are equal
share one class and are entered once by each task.

Candidate pairs pass an exact bound first: the numbers of shingles in BINS hash bins may not differ by more than the sets may.
Every candidate pair is verified with whole sets. Hashes stand for shingles throughout (64 bits after a full mix).
A null text, or one without words, is the empty set and links with nothing. Fewer words than a shingle are one shingle.
Repeated rows are members of one class, rows of one doc_id with different texts are members of their own classes. Very long
texts are read whole; more than 2**32 shingles fall in one band. Rows with a null doc_id are compared and name no component.
Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.components import components
from .common import batches, buffer_of, capped_groups, cut, group_starts, heavy_join, pairs_in_groups, row_key, splitmix, table, whole_groups, words_of

CAP = 8
BINS = 256
BLOCK = 512
#: Classes that a task remembers as entered; one that it enters again costs rows, not results.
SEEN = 1_000_000
#: plan() reckons with unrelated sets that share a passage of so many shingles, and weighs their meeting so many times an entry.
PASSAGE = 60
CHANCE = 1500.0
MIX = splitmix(np.arange(101, 117, dtype=np.uint64)) | np.uint64(1)


class Rule:
    """Shingle length and threshold: sets link if 100 * intersection >= percent * union."""

    def __init__(self, words: int, percent: int):
        self.words, self.percent = words, percent
        self.low = [1]
        while self.low[-1] < 1 << 32:
            self.low.append(self.low[-1] * 100 // percent + 1)
        self.plans: dict[int, tuple[int, int, int]] = {}

    def band(self, n):
        return np.searchsorted(self.low, n, "right") - 1

    def top(self, band):
        """Largest size in a band."""
        return np.asarray(self.low)[np.asarray(band) + 1] - 1

    def plan(self, band: int) -> tuple[int, int, int]:
        """(whole segments, segments with one-deletion neighbours, surplus) of a band."""
        if band not in self.plans:
            hi = int(self.top(band))
            t = self.percent
            differ = (hi + hi * 100 // t) * (100 - t) // (100 + t)
            n = (self.low[band] + hi) / 2
            surplus = 1 + differ // 10 if differ else 0
            deep = np.arange(differ // 2 + surplus + 2)
            # Differences spoil whole segments first, at one each, then two for each deep one; the fewest whole ones that leave
            # more than the surplus:
            whole = np.where(deep <= surplus + 1, differ + surplus + 1 - deep, np.maximum(differ - 2 * (deep - surplus - 1) - 1, 0))
            k = n / np.maximum(whole + deep, 1)
            shared = min(0.9, PASSAGE / n)
            cost = whole * (1 + CHANCE * shared**k) + deep * (1 + k) * (1 + CHANCE * shared ** (k - 1))
            best = int(cost.argmin())
            self.plans[band] = (int(whole[best]), int(deep[best]), surplus)
        return self.plans[band]

    @staticmethod
    def survive(whole: int, deep: int, differ: int) -> int:
        return whole + deep - differ if differ <= whole else deep - min(deep, (differ - whole) // 2)


def shingle_sets(texts: list, k: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    buf, starts = buffer_of(texts)
    w, _, _, first = words_of(buf, starts)
    out = []
    with np.errstate(over="ignore"):
        if len(w) >= k:
            s = w[: len(w) - k + 1] * MIX[0]
            for i in range(1, k):
                s = s + w[i : len(w) - k + 1 + i] * MIX[i]
            s = splitmix(s)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= k:
                x = np.sort(s[a : b - k + 1])
                if len(x) > 1:
                    x = x[np.concatenate(([True], x[1:] != x[:-1]))]
            elif b > a:
                x = splitmix(np.array([(w[a:b] * MIX[8 : 8 + b - a]).sum(dtype=np.uint64) + np.uint64(b - a)]))
            else:
                x = np.zeros(0, np.uint64)
            out.append(x)
    return out


def class_of(x: np.ndarray) -> int:
    """The id of a set: equal sets, and only they, have the same."""
    with np.errstate(over="ignore"):
        return int(splitmix(np.array([splitmix(x).sum(dtype=np.uint64) + np.uint64(len(x)) * MIX[15]])).view(np.int64)[0])


def sizes_of(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, row, n (set size), cls, bins (how many shingles fall in each of BINS hash bins, modulo 256)."""
    k = rule.words

    def measure(it):
        for block in batches(it):
            sets = shingle_sets(block["text"], k)
            bins = [np.bincount((x & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS).astype(np.uint8).tobytes() for x in sets]
            yield pa.RecordBatch.from_arrays([pa.array(block["doc_id"], pa.int64()), pa.array(block["row"], pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array([class_of(x) for x in sets], pa.int64()), pa.array(bins, pa.binary())], names=["doc_id", "row", "n", "cls", "bins"])

    return docs.mapInArrow(measure, "doc_id bigint, row bigint, n bigint, cls bigint, bins binary")


def entries_of_set(x: np.ndarray, band: int, rule: Rule) -> tuple[np.ndarray, bool]:
    """The entries of one set in a band, and whether it keeps its empty segments."""
    whole, deep, surplus = rule.plan(band)
    m = whole + deep
    seg = ((x >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    v = splitmix(x ^ MIX[band % 7])
    at = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
    with np.errstate(over="ignore"):
        total = np.add.reduceat(v, at)
        own = seg[at]
        tag = splitmix((own + np.uint64(1)) * MIX[3] + np.uint64(band) * MIX[4])
        out = [total + tag]
        if deep:
            is_deep = own < deep
            size = np.diff(np.append(at, len(x)))
            of = np.repeat(np.arange(len(at)), size)
            inside = is_deep[of] & (size[of] > 1)
            out.append(total[of[inside]] - v[inside] + tag[of[inside]])
            empty = m - len(at) + int((is_deep & (size == 1)).sum())
        else:
            empty = m - len(at)
        sparse = empty > surplus // 2
        if sparse:
            gone = np.ones(m, bool)
            gone[own.astype(np.int64)] = False
            if deep:
                gone[own[is_deep & (size == 1)].astype(np.int64)] = True
            out.append(splitmix((np.flatnonzero(gone).astype(np.uint64) + np.uint64(1)) * MIX[3] + np.uint64(band) * MIX[4]))
    return splitmix(np.concatenate(out)), sparse


def entries(docs: DataFrame, rule: Rule) -> DataFrame:
    """entry, cls, n (set size; negative: keeps its empty segments), band of the entries. Each task enters a class once."""

    def enter(it):
        seen: set[int] = set()
        for block in batches(it):
            es, cs, ns, bs = [], [], [], []
            for x in shingle_sets(block["text"], rule.words):
                n = len(x)
                if not n or (c := class_of(x)) in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(c)
                band = int(rule.band(n))
                for j in (band, band - 1):
                    if j < 0 or (j < band and n * rule.percent > 100 * int(rule.top(j))):
                        continue
                    e, sparse = entries_of_set(x, j, rule)
                    es.append(e)
                    cs.append(np.full(len(e), c, np.int64))
                    ns.append(np.full(len(e), -n if sparse else n, np.int32))
                    bs.append(np.full(len(e), j, np.int16))
            if es:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(es).view(np.int64)), pa.array(np.concatenate(cs)), pa.array(np.concatenate(ns)), pa.array(np.concatenate(bs))], names=["entry", "cls", "n", "band"])

    return docs.mapInArrow(enter, "entry bigint, cls bigint, n int, band smallint")


def _meet(cap: int, percent: int):
    """Of entries in order: pairs of classes that share one, or (b null) the members of an entry that more than cap share."""

    def meet(it):
        for t, hot in capped_groups(it, "entry", "cls", cap):
            e, c, n, band = (t.column(x).to_numpy() for x in ("entry", "cls", "n", "band"))
            starts = group_starts([e])
            some = ~hot & (np.repeat(np.diff(starts), np.diff(starts)) > 1)
            found = []
            if some.any():
                ee, cc, nn = e[some], c[some], np.abs(n[some]).astype(np.int64)
                for p, q in pairs_in_groups(group_starts([ee])):
                    ok = np.minimum(nn[p], nn[q]) * 100 >= percent * np.maximum(nn[p], nn[q])
                    found.append(np.stack((np.minimum(cc[p], cc[q])[ok], np.maximum(cc[p], cc[q])[ok]), 1))
                pairs = np.unique(np.concatenate(found), axis=0)
                nil = pa.nulls(len(pairs), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), nil, pa.nulls(len(pairs), pa.int32()), pa.nulls(len(pairs), pa.int16())], names=["a", "b", "entry", "n", "band"])
            if hot.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[hot]), pa.nulls(int(hot.sum()), pa.int64()), pa.array(e[hot]), pa.array(n[hot]), pa.array(band[hot])], names=["a", "b", "entry", "n", "band"])

    return meet


def enter_finely(x: np.ndarray, band: int, rule: Rule) -> tuple[np.ndarray, int]:
    """Entries of a set in a band of twice as many segments as a pair may differ in, and how many of them it must share with a similar set (besides empty segments)."""
    hi = int(rule.top(band))
    differ = (hi + hi * 100 // rule.percent) * (100 - rule.percent) // (100 + rule.percent)
    m = 2 * differ + 2
    seg = ((x >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    at = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
    least = m - differ - (m - len(at))
    with np.errstate(over="ignore"):
        tag = lambda own: splitmix((own + np.uint64(1)) * MIX[5] + np.uint64(band) * MIX[6])
        out = np.add.reduceat(splitmix(x ^ MIX[7]), at) + tag(seg[at])
        if least <= 0:
            gone = np.setdiff1d(np.arange(m, dtype=np.uint64), seg[at])
            out = np.concatenate((out, tag(gone)))
    return splitmix(out), least


def _fine(rule: Rule):
    def fine(it):
        for batch in it:
            es, cs, ns, bs, ls, ws = [], [], [], [], [], []
            for c, text, bands in zip(batch.column("cls").to_pylist(), batch.column("text").to_pylist(), batch.column("bands").to_pylist(), strict=True):
                x = shingle_sets([text], rule.words)[0]
                n = len(x)
                for j in bands:
                    e, least = enter_finely(x, j, rule)
                    es.append(e)
                    cs.append(np.full(len(e), c, np.int64))
                    ns.append(np.full(len(e), n, np.int32))
                    bs.append(np.full(len(e), j, np.int16))
                    ls.append(np.full(len(e), len(e), np.int32))
                    ws.append(np.full(len(e), len(e) - max(least, 1) + 1, np.int32))
            if es:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(es).view(np.int64)), *[pa.array(np.concatenate(v)) for v in (cs, ns, bs, ls, ws)]], names=["entry", "cls", "n", "band", "of", "most"])

    return fine


def _near(x: np.ndarray, y: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether rows of bins differ by no more than similar sets of this total size may."""
    d = x - y
    return np.minimum(d, np.negative(d)).sum(1, dtype=np.int64) * (100 + percent) <= total * (100 - percent)


def _counted(it):
    """Entries in order with the number of their sets (c); entries of one set only are left out."""
    for t in whole_groups(it, ["entry"], 100_000):
        starts = group_starts([t.column("entry").to_numpy()])
        c = np.repeat(np.diff(starts), np.diff(starts))
        yield from t.append_column("c", pa.array(c)).filter(pa.array(c > 1)).to_batches()


def _bound(percent: int):
    """Drops pairs whose bins differ by more than a similar pair may: an exact bound."""

    def bound(it):
        for batch in it:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("xa", "xb"))
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            keep = [_near(x[k : k + 4096], y[k : k + 4096], total[k : k + 4096], percent) for k in range(0, len(x), 4096)]
            yield batch.filter(pa.array(np.concatenate(keep))).select(["a", "b"])

    return bound


class Verifier:
    """Verifies pairs (a, b) of classes with whole sets, after the exact bound by bins."""

    def __init__(self, docs: DataFrame, classes: DataFrame, rule: Rule):
        self.docs, self.classes, self.rule = docs, classes, rule

    def texts(self, wanted: DataFrame) -> DataFrame:
        """cls, text of one document of each wanted class."""
        reps = cut(self.classes.select("cls", "row").join(wanted, "cls"), "reps")
        # One strategy at every size: texts meet the keys in a shuffle, once for all verifications.
        found = self.docs.join(reps.hint("merge"), "row").select("cls", "text")
        return cut(found.dropDuplicates(["cls"]), "texts")

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """The pairs that the bounds by size and bins leave."""
        percent = self.rule.percent
        side = lambda c: self.classes.select(F.col("cls").alias(c), F.col("bins").alias(f"x{c}"), F.col("n").alias(f"n{c}"))
        near = pairs.hint("merge").join(side("a"), "a").join(side("b").hint("merge"), "b").filter(F.least("na", "nb") * 100 >= percent * F.greatest("na", "nb"))
        return cut(near.mapInArrow(_bound(percent), "a bigint, b bigint"), "near")

    def __call__(self, near: DataFrame, texts: DataFrame) -> DataFrame:
        """The bounded pairs that are similar; texts holds all their classes."""
        k, percent = self.rule.words, self.rule.percent
        joined = near.hint("merge").join(texts.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("cls").alias("b"), F.col("text").alias("tb")).hint("merge"), "b")

        def check(it):
            for batch in it:
                a, b = batch.column("a"), batch.column("b")
                ta, tb = batch.column("ta"), batch.column("tb")
                ok, last, x = [], None, None
                for i in range(batch.num_rows):
                    if a[i].as_py() != last:
                        last = a[i].as_py()
                        x = shingle_sets([ta[i].as_py()], k)[0]
                    y = shingle_sets([tb[i].as_py()], k)[0]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * both >= percent * (len(x) + len(y) - both))
                keep = np.flatnonzero(ok)
                yield pa.RecordBatch.from_arrays([a.take(pa.array(keep)), b.take(pa.array(keep))], names=["a", "b"])

        return joined.select("a", "b", "ta", "tb").mapInArrow(check, "a bigint, b bigint")


def _cross(percent: int):
    """Pairs of different components inside cells of sorted entries that pass the exact bounds by size and bins."""

    def cross(it):
        for t in whole_groups(it, ["entry", "i", "j"], 2000):
            c = {n: t.column(n).to_numpy() for n in ("entry", "i", "j", "blk", "cls", "component", "n")}
            bins = np.frombuffer(b"".join(t.column("bins").to_pylist()), np.uint8).reshape(-1, BINS)
            found = [np.zeros((0, 2), np.int64)]
            for p, q in pairs_in_groups(group_starts([c["entry"], c["i"], c["j"]])):
                ok = (c["component"][p] != c["component"][q]) & ((c["i"][p] == c["j"][p]) | (c["blk"][p] != c["blk"][q]))
                ok &= np.minimum(c["n"][p], c["n"][q]) * 100 >= percent * np.maximum(c["n"][p], c["n"][q])
                p, q = p[ok], q[ok]
                ok = np.concatenate([np.zeros(0, bool), *(_near(bins[p[k : k + 4096]], bins[q[k : k + 4096]], (c["n"][p] + c["n"][q])[k : k + 4096], percent) for k in range(0, len(p), 4096))])
                x, y = c["cls"][p[ok]], c["cls"][q[ok]]
                found.append(np.stack((np.minimum(x, y), np.maximum(x, y)), 1))
            pairs = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return cross


def similar_classes(docs: DataFrame, rule: Rule, cap: int = CAP, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """sizes (doc_id, row, n, cls) and the components of classes (id, component) under the rule."""
    spark = docs.sparkSession
    docs = row_key(docs)
    sizes = cut(sizes_of(docs, rule), "sizes")
    classes = cut(sizes.filter("n > 0").groupBy("cls").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("bins").alias("bins")), "classes")
    sizes = sizes.drop("bins")
    verify = Verifier(docs, classes, rule)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pair_rows = "a bigint, b bigint, entry bigint, n int, band smallint"

    def meet(rows: DataFrame) -> DataFrame:
        return cut(rows.repartition(parts, "entry").sortWithinPartitions("entry", "cls").mapInArrow(_meet(cap, rule.percent), pair_rows), "met")

    met = meet(entries(docs, rule))
    near = verify.bounded(cut(met.filter("b IS NOT NULL").select("a", "b").distinct(), "pairs"))
    hot = met.filter("b IS NULL").select(F.col("a").alias("cls"), "n", "band")

    def heavy(it):
        for batch in it:
            surplus = {b: rule.plan(b)[2] for b in set(batch.column("band").to_pylist())}
            keep = [s or h > surplus[b] // 2 for b, h, s in zip(batch.column("band").to_pylist(), batch.column("h").to_pylist(), batch.column("sparse").to_pylist(), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["cls", "band"])

    loaded = hot.groupBy("cls", "band").agg(F.count("*").alias("h"), (F.min("n") < 0).alias("sparse")).mapInArrow(heavy, "cls bigint, band smallint")
    loaded = cut(loaded.groupBy("cls").agg(F.collect_list("band").alias("bands")), "loaded")
    texts = verify.texts(near.select(F.explode(F.array("a", "b")).alias("cls")).unionByName(loaded.select("cls")).distinct())
    links = cut(verify(near, texts), "links")
    if loaded.isEmpty():
        return sizes, components(links)
    # Heavy sets among themselves: entries by rising frequency, of each set only as many as a similar pair cannot miss.
    fine = texts.join(loaded.hint("merge"), "cls").select("cls", "text", "bands").mapInArrow(_fine(rule), "entry bigint, cls bigint, n int, band smallint, of int, most int")
    fine = fine.repartition(parts, "entry").sortWithinPartitions("entry").mapInArrow(_counted, "entry bigint, cls bigint, n int, band smallint, of int, most int, c bigint")
    own = Window.partitionBy("cls", "band")
    # Entries of one set only come first in the order of frequency, though they are not sent.
    rank = F.row_number().over(own.orderBy("c", "entry")) + F.col("of") - F.count("*").over(own)
    prefix = fine.withColumn("r", rank).filter("r <= most").select("entry", "cls", "n", "band")
    met = meet(prefix)
    found = met.filter("b IS NOT NULL").select("a", "b")
    hot = cut(met.filter("b IS NULL").select(F.col("a").alias("cls"), "entry", "n"), "hot")
    weight = hot.groupBy("cls").agg(F.count("*").alias("w"))
    pivots = hot.join(weight, "cls").groupBy("entry").agg(F.max(F.struct("w", "cls")).alias("p"))
    pivots = cut(pivots.select("entry", F.col("p.cls").alias("pivot")), "pivots")
    first = hot.join(pivots, "entry").filter(F.col("cls") != F.col("pivot")).select(F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b"))
    links = cut(links.unionByName(verify(verify.bounded(cut(found.unionByName(first).distinct(), "pairs")), texts)), "links")
    comp = cut(components(links), "components")
    if hot.isEmpty():
        return sizes, comp
    rest = hot.join(pivots, "entry").filter(F.col("cls") != F.col("pivot")).join(comp.withColumnRenamed("id", "cls"), "cls", "left")
    rest = cut(rest.select("entry", "cls", F.coalesce("component", "cls").alias("component")), "rest")
    apart = cut(rest.groupBy("entry").agg(F.count("*").alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi"), "apart")
    g = F.ceil(F.col("size") / F.lit(float(block))).cast("int")
    cells = heavy_join(rest, apart.select("entry", "size", g.alias("g")), ["entry"], "size", 28).withColumn("blk", F.pmod(F.hash("cls"), "g")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    cells = cells.select("entry", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "blk", "cls", "component").join(classes.select("cls", "n", "bins"), "cls")
    more = cut(cells.repartition(parts, "entry", "i", "j").sortWithinPartitions("entry", "i", "j").mapInArrow(_cross(rule.percent), "a bigint, b bigint").distinct(), "pairs")
    if not more.isEmpty():
        comp = components(cut(links.unionByName(verify(more, texts)), "links"))
    return sizes, comp


def jaccard_groups(docs: DataFrame, words: int, percent: int, cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included), row (row_key) and component (one for each set of linked rows; null for rows without words) for every row of docs."""
    sizes, comp = similar_classes(docs, Rule(words, percent), cap, block)
    classes = sizes.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    named = classes.join(comp.withColumnRenamed("id", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    low = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = cut(named.join(low, "component").select("cls", "component", "component_id"), "known")
    out = sizes.withColumn("cls", F.when(F.col("n") > 0, F.col("cls"))).join(known, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "row", "component")


def jaccard_components(docs: DataFrame, words: int, percent: int, cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included) for every row of docs."""
    return jaccard_groups(docs, words, percent, cap, block).drop("row", "component")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), 4, 85)
