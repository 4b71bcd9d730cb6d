"""What the training-data operators share: tables, shared storage, blocks of text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import cut, discard, release  # noqa: F401

#: Small sides up to this many estimated bytes may be broadcast; larger ones are shuffled.
BROADCAST_BYTES = 24 << 20


#: Rows in an Arrow batch, where the session has Spark's default: texts are long, and workers share an executor's memory.
ARROW_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_of(docs: DataFrame):
    """A row's own key from doc_id and text: rows that share a doc_id but not a text stay apart, rows that are equal in both have one key."""
    id_, text = docs["doc_id"].cast("bigint"), docs["text"].cast("string")
    return F.xxhash64(F.coalesce(id_, F.lit(-1)), id_.isNull(), F.coalesce(text, F.lit("")), text.isNull())


def row_key(docs: DataFrame) -> DataFrame:
    """doc_id, text and row (key_of)."""
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"), key_of(docs).alias("row"))


def small_side(df: DataFrame, row_bytes: int, more=None) -> DataFrame:
    """A broadcast hint for df if its counted size, row_bytes for each row and what `more` (a column of bytes) adds, stays below BROADCAST_BYTES; else df as it is (a shuffle join). df should be cheap to count: a table that was cut."""
    n, extra = df.agg(F.count("*"), F.coalesce(F.sum(F.lit(0) if more is None else more), F.lit(0))).first()
    return F.broadcast(df) if n * row_bytes + extra <= BROADCAST_BYTES else df


#: A key with more than one in so many of all rows is heavy, so that there are fewer heavy keys than this.
HEAVY = 10_000


def heavy_join(left: DataFrame, right: DataFrame, on: list[str], count: str, row_bytes: int) -> DataFrame:
    """Inner join of left with right, which has each key once and in `count` the rows of left that have it. A small right side is broadcast whole. Of a larger one only heavy keys are, fewer than HEAVY; the others meet in a shuffle in which no key has more than one in HEAVY of the rows."""
    n, total = right.agg(F.count("*"), F.coalesce(F.sum(count), F.lit(0))).first()
    if n * row_bytes <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), on)
    heavy = right.filter(F.col(count) * HEAVY > total)
    light = left.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(right.filter(F.col(count) * HEAVY <= total), on)
    return left.join(F.broadcast(heavy), on).unionByName(light)


def matrix(col, width: int, kind=np.float64) -> np.ndarray:
    """The rows of an Arrow list column, all of this length, as a matrix."""
    return np.asarray(col.flatten(), dtype=kind).reshape(-1, width)


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores that make it no column of df."""
    return next(n for n in (f"{name}{'_' * i}" for i in range(1, len(df.columns) + 2)) if n.lower() not in {c.lower() for c in df.columns})


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = splitmix(np.arange(1, 257, dtype=np.uint64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Scratch(dict):
    """Arrays worth keeping between blocks of one task; they stay behind when functions travel."""

    def __reduce__(self):
        return Scratch, ()


_KEPT = Scratch()


def powers(n: int, base: int = int(_ODD)) -> np.ndarray:
    """base**i mod 2**64 for i < n."""
    if len(_KEPT.get(base, ())) < n:
        out = np.full(max(n, 1) * 5 // 4, np.uint64(base), np.uint64)
        out[0] = 1
        with np.errstate(over="ignore"):
            _KEPT[base] = np.multiply.accumulate(out)
    return _KEPT[base][:n]


_INVERSE = pow(int(_ODD), -1, 1 << 64)


def buffer_of(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts (null: empty), each followed by a line feed, and where each text starts (one more at the end)."""
    parts = [b"" if t is None else t if isinstance(t, bytes) else t.encode() for t in texts]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b"\n".join(parts) + b"\n", np.uint8) if parts else np.zeros(0, np.uint8), starts


def words_of(buf: np.ndarray, starts: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ([^\\x20\\x09-\\x0D]+) of a buffer: 64-bit hash, start, end, and the first word of each text (one more at the end)."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(len(starts), np.int64)
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    data = _LOWER[buf] if lower else buf
    with np.errstate(over="ignore"):
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[data] * powers(len(data)), out=sums[1:])
        h = (sums[end] - sums[begin]) * powers(len(data), _INVERSE)[begin] + (end - begin).astype(np.uint64)
    return splitmix(h), begin, end, np.searchsorted(begin, starts)


def tidy() -> None:
    """Give back what a worker no longer uses: workers live on between tasks, and several share an executor's memory."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def batches(it, max_bytes: int = 1 << 20):
    """Arrow batches cut into runs of rows with a bounded amount of text, so that long texts do not pile up in one block. Yields dicts of Python lists."""
    import pyarrow.compute as pc

    for batch in it:
        names = batch.schema.names
        col = batch.column(names.index("text"))
        size = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + max_bytes, "right")))
            part = batch.slice(at, to - at)
            yield {n: part.column(i).to_pylist() for i, n in enumerate(names)}
            at = to
    tidy()


def whole_groups(it, keys: list[str], least: int = 20_000):
    """pyarrow tables of at least `least` rows that never split a group of equal keys; the input must be sorted by them."""
    import pyarrow as pa

    held, rows = [], 0
    for batch in it:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        whole = pa.Table.from_batches(held)
        at = len(whole) - tail_group(whole, keys)
        if at:
            yield whole.slice(0, at).combine_chunks()
        held = whole.slice(at).combine_chunks().to_batches()
        rows = len(whole) - at
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()
    tidy()


def capped_groups(it, key: str, member: str, cap: int, least: int = 100_000):
    """pyarrow tables of rows sorted by key and member, without rows that repeat both, and which of them are of keys of more than cap members. Keys of at most cap members are never split; of a larger one no more than about `least` rows are held at once."""
    import pyarrow as pa

    held, rows, last, hot_key = [], 0, None, None

    def ready(whole, final):
        nonlocal last, hot_key
        k, m = whole.column(key).to_numpy(), whole.column(member).to_numpy()
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
        if last is not None:
            new[0] = (int(k[0]), int(m[0])) != last
        whole, k = whole.filter(pa.array(new)), k[new]
        if not len(k):
            return whole, k.astype(bool), whole
        starts = group_starts([k])
        size = np.diff(starts)
        hot = np.repeat(size > cap, size)
        if hot_key is not None:
            hot |= k == hot_key
        at = len(k)
        if not final and not hot[-1]:
            at = int(starts[-2])
        if at:
            last = (int(k[at - 1]), int(whole.column(member)[at - 1].as_py()))
            hot_key = int(k[at - 1]) if hot[at - 1] else None
        return whole.slice(0, at).combine_chunks(), hot[:at], whole.slice(at)

    for batch in it:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        out, hot, rest = ready(pa.Table.from_batches(held), False)
        if len(out):
            yield out, hot
        held = rest.combine_chunks().to_batches()
        rows = len(rest)
    if rows:
        out, hot, _ = ready(pa.Table.from_batches(held), True)
        if len(out):
            yield out, hot
    tidy()


def tail_group(t, keys: list[str]) -> int:
    """Rows of the last group."""
    same = np.ones(len(t), bool)
    for k in keys:
        col = t.column(k).to_numpy()
        same &= col == col[-1]
    return int(np.argmin(same[::-1])) if not same.all() else len(t)


def group_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where each group of equal neighbouring rows starts, and the number of rows at the end."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


def pairs_in_groups(starts: np.ndarray, most: int = 400_000):
    """Index pairs (left < right) inside each group, in blocks of about `most` pairs or one row's pairs."""
    n = int(starts[-1])
    end = np.repeat(starts[1:], np.diff(starts))
    later = end - np.arange(n) - 1
    total = np.concatenate(([0], np.cumsum(later)))
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        count = later[at:to]
        left = np.repeat(np.arange(at, to), count)
        right = left + 1 + np.arange(len(left)) - np.repeat(total[at:to] - total[at], count)
        if len(left):
            yield left, right
        at = to
