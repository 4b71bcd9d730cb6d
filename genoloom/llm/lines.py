"""Line dedup by a segment-partition edit join.

Lines (texts split at line feeds) of at least SHORT bytes are cut into DISTANCE + 1 segments. A line within DISTANCE edits of
another one holds at least one of its segments whole, at a place that the two lengths bound. Every line enters its own
segments in an index under (length, segment number, segment) and probes the index of each length from its own down to
DISTANCE less with those of its substrings that can match. Lines that meet are verified by edit distance: common ends are
cut off, the rest is decided by a banded bit-parallel automaton, exact up to DISTANCE. An index entry that more than CAP
lines share is compared in pairs of blocks, each block pair a task's cell, where byte counts (an exact bound) come before the
automaton and only the lines found to repeat leave the cell; nothing is capped. Equal lines are one line by their 64-bit hash.

A line's first place is its smallest (doc_id, line number); rows of one doc_id with different texts are documents of their
own, in order of a hash of their text. A line repeats if it is within DISTANCE edits of a different line whose first place is
earlier; all its places are removed. Of every other line the first place stays and later places are removed. Lines shorter
than SHORT bytes stay. A null text stays null, an empty one stays empty; a text that loses all its lines becomes empty. Very
long lines and texts are lines and texts like others. Equal rows (one doc_id, one text) are copies of one document and keep
the same lines. Lines of rows with a null doc_id stay and count for nothing. Other columns are kept, but n_lines and
n_removed are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import _BYTE, _INVERSE, batches, buffer_of, capped_groups, cut, free_name, group_starts, heavy_join, key_of, pairs_in_groups, powers, row_key, small_side, splitmix, table, whole_groups

DISTANCE = 2
SHORT = 30
CAP = 16
BLOCK = 256
MIX = splitmix(np.arange(301, 309, dtype=np.uint64)) | np.uint64(1)


def within(a: bytes, b: bytes, k: int) -> bool:
    """Whether the edit distance of a and b is at most k."""
    if abs(len(a) - len(b)) > k:
        return False
    n = min(len(a), len(b))
    if n:
        same = np.frombuffer(a, np.uint8, n) == np.frombuffer(b, np.uint8, n)
        p = n if same.all() else int(same.argmin())
        a, b = a[p:], b[p:]
        n -= p
    if n:
        same = np.frombuffer(a, np.uint8)[::-1][:n] == np.frombuffer(b, np.uint8)[::-1][:n]
        s = n if same.all() else int(same.argmin())
        a, b = a[: len(a) - s], b[: len(b) - s]
    if not a or not b:
        return max(len(a), len(b)) <= k
    # Bit t of rows[e], when i bytes of b are read: the first i - k + t bytes of a are within e edits of them. The band is 2k + 1
    # bits wide, however long the lines are.
    full = (2 << (2 * k)) - 1
    rows = [((2 << e) - 1) << k for e in range(k + 1)]
    for i, c in enumerate(b, 1):
        hit = 0
        for t in range(max(0, k - i + 1), min(2 * k, len(a) - i + k) + 1):
            if a[i - k + t - 1] == c:
                hit |= 1 << t
        new = []
        for e in range(k + 1):
            r = rows[e] & hit
            if e:
                r |= rows[e - 1] | (rows[e - 1] >> 1) | (new[e - 1] << 1)
            new.append(r & full)
        rows = new
        if not rows[k]:
            return False
    return bool(rows[k] >> (len(a) - len(b) + k) & 1)


def cuts(length: int, k: int = DISTANCE) -> list[tuple[int, int]]:
    """(start, size) of the k + 1 segments of a line; the last ones are one longer where they must be."""
    small, extra = divmod(length, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        size = small + (i >= k + 1 - extra)
        out.append((at, size))
        at += size
    return out


def probes(length: int, other: int, k: int = DISTANCE) -> list[tuple[int, int, int]]:
    """(segment number, start, size) of the substrings of a line of this length that can be a segment of a line of length other <= length, seen from both ends."""
    delta = length - other
    out = []
    for i, (p, size) in enumerate(cuts(other, k)):
        lo, hi = max(0, p - i, p + delta - (k - i)), min(length - size, p + i, p + delta + (k - i))
        out += [(i, s, size) for s in range(lo, hi + 1)]
    return out


class Lines:
    """The lines of a block of texts: text number, line number, bounds in the buffer, hash."""

    def __init__(self, texts: list, short: int):
        self.buf, starts = buffer_of(texts)
        end = np.flatnonzero(self.buf == 10)
        begin = np.concatenate(([0], end[:-1] + 1)) if len(end) else end
        text = np.searchsorted(starts, begin, "right") - 1
        no = np.arange(len(begin)) - np.searchsorted(begin, starts[:-1])[text] if len(begin) else begin
        keep = end - begin >= short
        self.text, self.no, self.begin, self.end = text[keep], no[keep], begin[keep], end[keep]
        with np.errstate(over="ignore"):
            self.sums = np.empty(len(self.buf) + 1, np.uint64)
            self.sums[0] = 0
            np.cumsum(_BYTE[self.buf] * powers(len(self.buf)), out=self.sums[1:])
        self.back = powers(len(self.buf) + 1, _INVERSE)
        self.hash = splitmix(self.part(self.begin, self.end) + (self.end - self.begin).astype(np.uint64) * MIX[0]).view(np.int64)

    def part(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[begin]) * self.back[begin]

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.begin[i] : self.end[i]].tobytes()


def _places(short: int):
    def places(it):
        for block in batches(it):
            x = Lines(block["text"], short)
            doc, row = (pa.array(block[c], pa.int64()).take(pa.array(x.text)) for c in ("doc_id", "row"))
            yield pa.RecordBatch.from_arrays([pa.array(x.hash), doc, row, pa.array(x.no.astype(np.int64))], names=["line", "doc_id", "row", "no"])

    return places


def _entries(short: int, k: int):
    """key, line: entries of each task's distinct lines, own segments and probes alike."""
    plans: dict[int, np.ndarray] = {}

    def plan(n: int) -> np.ndarray:
        if n not in plans:
            out = {(n, i, s, s + z) for i, (s, z) in enumerate(cuts(n, k))}
            for other in range(max(n - k, 0), n + 1):
                out |= {(other, i, s, s + z) for i, s, z in probes(n, other, k)}
            plans[n] = np.array(sorted(out), np.int64)
        return plans[n]

    def enter(it):
        seen: set[int] = set()
        for block in batches(it):
            x = Lines(block["text"], short)
            _, first = np.unique(x.hash, return_index=True)
            first = np.array([i for i in first.tolist() if int(x.hash[i]) not in seen], np.int64)
            if not len(first):
                continue
            if len(seen) < 2_000_000:
                seen.update(x.hash[first].tolist())
            length = x.end[first] - x.begin[first]
            order = np.argsort(length, kind="stable")
            first, length = first[order], length[order]
            keys, lines = [], []
            at = group_starts([length])
            for a, b in zip(at[:-1], at[1:], strict=True):
                p = plan(int(length[a]))
                own = x.begin[first[a:b]][:, None]
                with np.errstate(over="ignore"):
                    salt = splitmix((p[:, 0] * 64 + p[:, 1]).astype(np.uint64)) * MIX[1]
                    keys.append(splitmix(x.part(own + p[:, 2], own + p[:, 3]) + salt).ravel())
                lines.append(np.repeat(x.hash[first[a:b]], len(p)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(lines))], names=["key", "line"])

    return enter


def _meet(cap: int):
    """Pairs of lines that share an entry, or (b null) the members of an entry that more than cap share."""

    def meet(it):
        for t, hot in capped_groups(it, "key", "line", cap):
            e, c = t.column("key").to_numpy(), t.column("line").to_numpy()
            starts = group_starts([e])
            some = ~hot & (np.repeat(np.diff(starts), np.diff(starts)) > 1)
            if some.any():
                cc = c[some]
                found = [np.stack((np.minimum(cc[p], cc[q]), np.maximum(cc[p], cc[q])), 1) for p, q in pairs_in_groups(group_starts([e[some]]))]
                pairs = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(len(pairs), pa.int64())], names=["a", "b", "key"])
            if hot.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[hot]), pa.nulls(int(hot.sum()), pa.int64()), pa.array(e[hot])], names=["a", "b", "key"])

    return meet


def _texts_of(short: int):
    def texts(it):
        for block in batches(it):
            x = Lines(block["text"], short)
            _, first = np.unique(x.hash, return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(x.hash[first]), pa.array([x.bytes_of(i) for i in first.tolist()], pa.binary())], names=["line", "text"])

    return texts


def _verify(k: int):
    """Of pairs with their texts and first places: the later line, where they are near."""

    def verify(it):
        for batch in it:
            c = [batch.column(n).to_pylist() for n in ("a", "b", "ta", "tb", "pa", "pb")]
            late = [b if (*x.values(), a) < (*y.values(), b) else a for a, b, ta, tb, x, y in zip(*c, strict=True) if within(ta, tb, k)]
            yield pa.RecordBatch.from_arrays([pa.array(late, pa.int64())], names=["line"])

    return verify


def _cells(k: int):
    """Of cells of lines with texts and first places: the lines that are near an earlier one."""

    def cells(it):
        for t in whole_groups(it, ["key", "i", "j"], 200):
            keys = [t.column(n).to_numpy() for n in ("key", "i", "j")]
            texts, blk, line = t.column("text").to_pylist(), t.column("blk").to_numpy(), t.column("line").to_numpy()
            place = [(*p.values(), x) for p, x in zip(t.column("p").to_pylist(), line.tolist(), strict=True)]
            size = np.array([len(x) for x in texts])
            hist = np.stack([np.bincount(np.frombuffer(x, np.uint8) & 31, minlength=32) for x in texts]).astype(np.int16)
            late: set[int] = set()
            for p, q in pairs_in_groups(group_starts(keys), 100_000):
                ok = ((keys[1][p] == keys[2][p]) | (blk[p] != blk[q])) & (np.abs(size[p] - size[q]) <= k)
                p, q = p[ok], q[ok]
                ok = np.abs(hist[p] - hist[q]).sum(1) <= 2 * k
                for x, y in zip(p[ok].tolist(), q[ok].tolist(), strict=True):
                    lo, hi = (x, y) if place[x] < place[y] else (y, x)
                    if line[hi] not in late and within(texts[lo], texts[hi], k):
                        late.add(int(line[hi]))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(late), pa.int64())], names=["line"])

    return cells


def removed_lines(docs: DataFrame, k: int = DISTANCE, short: int = SHORT, cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """doc_id, row, no: the places of lines of docs (doc_id, text, row) to be removed."""
    spark = docs.sparkSession
    docs = docs.filter("doc_id IS NOT NULL")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = cut(docs.mapInArrow(_places(short), "line bigint, doc_id bigint, row bigint, no bigint"), "places")
    first = cut(places.groupBy("line").agg(F.min(F.struct("doc_id", "no", "row")).alias("p"), F.count("*").alias("n")), "first")
    text = docs.select("text")
    met = text.mapInArrow(_entries(short, k), "key bigint, line bigint").repartition(parts, "key").sortWithinPartitions("key", "line")
    met = cut(met.mapInArrow(_meet(cap), "a bigint, b bigint, key bigint"), "met")
    pairs = cut(met.filter("b IS NOT NULL").select("a", "b").distinct(), "pairs")
    hot = met.filter("b IS NULL").select(F.col("a").alias("line"), "key")
    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("line")).unionByName(hot.select("line")).distinct(), "wanted")
    found = text.mapInArrow(_texts_of(short), "line bigint, text binary").join(small_side(wanted, 40), "line")
    found = cut(found.groupBy("line").agg(F.first("text").alias("text")).join(first.drop("n"), "line"), "texts")
    side = lambda x: found.select(F.col("line").alias(x), F.col("text").alias(f"t{x}"), F.col("p").alias(f"p{x}"))
    late = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_verify(k), "line bigint")
    g = F.ceil(F.col("size") / F.lit(float(block))).cast("int")
    count = cut(hot.groupBy("key").agg(F.count("*").alias("size")), "hot")
    cells = heavy_join(hot, count, ["key"], "size", 24).withColumn("g", g).withColumn("blk", F.pmod(F.hash("line"), "g")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    cells = cells.select("key", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "blk", "line").join(found, "line")
    cells = cells.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_cells(k), "line bigint")
    late = late.unionByName(cells).distinct().withColumn("late", F.lit(True))
    state = cut(first.join(late, "line", "left").filter("late OR n > 1").select("line", "n", F.when(F.col("late"), F.lit(None)).otherwise(F.col("p.row")).alias("keep_row"), F.col("p.no").alias("keep_no")), "state")
    gone = heavy_join(places, state, ["line"], "n", 72).filter("keep_row IS NULL OR keep_row <> row OR keep_no <> no")
    return gone.select("doc_id", "row", "no").distinct()


@F.arrow_udf(StringType())
def _without_lines(texts: pa.Array, gone: pa.Array) -> pa.Array:
    out = []
    for text, numbers in zip(texts, gone, strict=True):
        value = text.as_py()
        if value is not None and numbers.is_valid and len(numbers):
            dropped = set(numbers.as_py())
            value = "\n".join(x for i, x in enumerate(value.split("\n")) if i not in dropped)
        out.append(value)
    return pa.array(out, pa.string())


def dedup_lines(docs: DataFrame, k: int = DISTANCE, short: int = SHORT, cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """docs with the repeated lines of text gone, and n_lines and n_removed of each row."""
    gone = removed_lines(row_key(docs), k, short, cap, block).groupBy("doc_id", "row").agg(F.collect_list("no").alias("gone"))
    id_, row, gone_ = (free_name(docs, n) for n in ("id", "row", "gone"))
    gone = cut(gone.select(F.col("doc_id").alias(id_), F.col("row").alias(row), F.col("gone").alias(gone_)), "gone")
    joined = docs.join(small_side(gone, 64, F.size(gone_) * 8), (F.col("doc_id").cast("bigint") == F.col(id_)) & (key_of(docs) == F.col(row)), "left")
    text = F.col("text").cast("string")
    none = F.coalesce(F.size(gone_), F.lit(0)) <= 0
    held = F.when(none, text).otherwise(_without_lines(F.when(~none, text), F.col(gone_)))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("bigint")
    kept = [F.col(c) if c != "text" else held.alias("text") for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(*kept, n.alias("n_lines"), F.when(none, 0).otherwise(F.size(gone_)).cast("bigint").alias("n_removed"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (of the text that is left)."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
