"""Suffix-array dedup: every byte goes that a LENGTH-byte string covers which also starts earlier in the corpus.

Only what may repeat reaches a suffix array. Each LENGTH-byte window of a text has an anchor, the leftmost of its GRAM-byte
strings with the smallest hash, so equal windows have equal anchors at equal places. Neighbouring windows with one anchor are
a run: (hash of the anchor, hash of all bytes of the run). Runs whose anchor occurs nowhere else hold no repeated window.
Runs that are equal as a whole repeat the earliest of them, in a task's block at once, then over all by anchor. What is left
are different runs around one anchor: their bytes are cut out of the texts as pieces and sent to shards by key, the anchor.

A key of more than HOT pieces is refined first. Each window holds the bytes its key knows and has others on their left and
right; it belongs to the half that has more on the left, or to the other one, and a half's key knows so many bytes more on
that side. A piece thus falls into two, equal parts of pieces are again one part and repeats of it, parts that share their
key with no other are dropped, and the rest is refined until keys are small. As what a key does not know halves with each
step, seven steps end at whole windows; a piece whose windows all repeat leaves in a few parts and not window by window.

A shard is a block of pieces in order of key and document. It joins them and builds a suffix array by prefix doubling that
re-sorts only what is not yet in order (Larsson and Sadakane), from eight bytes on until LENGTH is covered. Common prefixes of
neighbours follow Kasai's rule that the next position shares at most one byte less: only positions whose neighbour does not
move along are compared byte by byte, the others follow from them. Windows that share LENGTH bytes form a group, whose
earliest stays. Where a key goes on in the next shard, the two are merged: the windows of the next one are looked up by binary
search among the sorted ones of those before.

Order is by doc_id, then start; rows of one doc_id with different texts are documents of their own, in order of a hash of
their text. A null text has no bytes. Equal rows (one doc_id, one text) are one document and give equal results; rows with a
null doc_id remove nothing and lose nothing. Matches never cross texts. Very long texts are one document like others and are
cut out piece by piece. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _BYTE, _INVERSE, batches, buffer_of, cut, powers, row_key, small_side, splitmix, table, tidy

LENGTH = 100
GRAM = 24
#: Pieces from which on a key is refined.
HOT = 1500
#: Pieces (of at most 2 * LENGTH - GRAM bytes) of one suffix array.
SHARD_ROWS = 6_000
SALT = splitmix(np.arange(501, 505, dtype=np.uint64)) | np.uint64(1)


def sums_of(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        sums = np.empty(len(buf) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[buf] * powers(len(buf)), out=sums[1:])
    return sums, powers(len(buf) + 1, _INVERSE)


def leftmost_lows(h: np.ndarray, w: int) -> np.ndarray:
    """For each i, where the leftmost smallest of h[i : i + w] is; len(h) - w + 1 of them."""
    n = len(h)
    rows = -(-n // w) + 1
    x = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    x[:n] = h
    x = x.reshape(rows, w)
    col = np.arange(w, dtype=np.int32)
    low = np.minimum.accumulate(x, 1)
    new = np.ones_like(x, bool)
    new[:, 1:] = x[:, 1:] < low[:, :-1]
    head = np.maximum.accumulate(np.where(new, col, 0), 1)
    back = np.minimum.accumulate(x[:, ::-1], 1)
    new = np.ones_like(x, bool)
    new[:, 1:] = x[:, ::-1][:, 1:] <= back[:, :-1]
    tail = np.minimum.accumulate(np.where(new, col[::-1], w), 1)[:, ::-1]
    back = back[:, ::-1]
    base = (np.arange(rows, dtype=np.int64) * w)[:, None]
    head, tail, low, back = (head + base).ravel(), (tail + base).ravel(), low.ravel(), back.ravel()
    i = np.arange(n - w + 1)
    j = i + w - 1
    return np.where(back[i] <= low[j], tail[i], head[j])


def runs_of(buf: np.ndarray, starts: np.ndarray):
    """Runs of windows with one anchor: anchor hash, run hash, text, first and last window start in the text, anchor's place in the text."""
    n = len(buf) - LENGTH + 1
    z = np.zeros(0, np.int64)
    if n <= 0:
        return z, z, z, z, z, z
    sums, back = sums_of(buf)
    with np.errstate(over="ignore"):
        h = splitmix((sums[GRAM:] - sums[:-GRAM]) * back[: len(buf) + 1 - GRAM])
    anchor = leftmost_lows(h, LENGTH - GRAM + 1)[:n]
    text = np.searchsorted(starts, np.arange(n), "right") - 1
    fine = np.arange(n) + LENGTH <= starts[text + 1] - 1
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (fine[1:] != fine[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], n) - 1
    keep = fine[lo]
    lo, hi = lo[keep], hi[keep]
    a, text = anchor[lo], text[lo]
    with np.errstate(over="ignore"):
        run = (sums[hi + LENGTH] - sums[lo]) * back[lo]
        run = splitmix(run + splitmix(((a - lo) * 4096 + (hi - lo)).astype(np.uint64)) * SALT[0])
    return h[a].view(np.int64), run.view(np.int64), text, lo - starts[text], hi - starts[text], a - starts[text]


def _runs(it):
    """Runs of windows; of equal runs of a block only the earliest is sent on by its anchor, the others are repeats (known), put together where they are neighbours."""
    for block in batches(it, 1 << 19):
        h, run, text, lo, hi, _ = runs_of(*buffer_of(block["text"]))
        doc, row = (np.array(block[c], np.int64)[text] if len(text) else text for c in ("doc_id", "row"))
        known = np.zeros(len(h), bool)
        with np.errstate(over="ignore"):
            key = splitmix(h.view(np.uint64) * SALT[2] + run.view(np.uint64))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(h), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        some = np.flatnonzero(twice)
        if len(some):
            some = some[np.lexsort((lo[some], row[some], doc[some], key[some]))]
            new = np.append(True, key[some][1:] != key[some][:-1])
            first = some[np.maximum.accumulate(np.where(new, np.arange(len(some)), 0))]
            known[some] = ~new
            drop = some[~new & (row[some] == row[first]) & (lo[some] == lo[first])]
        else:
            drop = some
        k = np.flatnonzero(known & ~np.isin(np.arange(len(h)), drop)) if len(drop) else np.flatnonzero(known)
        new = np.ones(len(k), bool)
        new[1:] = (text[k][1:] != text[k][:-1]) | (lo[k][1:] != hi[k][:-1] + 1)
        at = np.flatnonzero(new)
        end = hi[k[np.append(at[1:], len(k)) - 1]] if len(k) else k
        k = k[at]
        rest = np.flatnonzero(~known)
        # Repeats travel along, spread by place instead of anchor.
        spread = splitmix((row[k] + lo[k]).astype(np.uint64)).view(np.int64)
        cols = [np.concatenate(v) for v in ((h[rest], spread), (run[rest], spread), (doc[rest], doc[k]), (row[rest], row[k]), (lo[rest], lo[k]), (hi[rest], end))]
        flag = np.concatenate((np.zeros(len(rest), bool), np.ones(len(k), bool)))
        yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int64)) for c in cols[:4]], *[pa.array(c.astype(np.int32)) for c in cols[4:]], pa.array(flag)], names=["h", "run", "doc_id", "row", "lo", "hi", "known"])


def _sift(it):
    """Of runs sorted by (h, run, doc_id, row, lo): repeats of an equal run (kind 0), and one of each where an anchor has several (kind 1)."""
    names = ["kind", "h", "doc_id", "row", "lo", "hi"]
    last = None  # the first of the run that is open: h, run, doc_id, row, lo, hi, and whether its anchor is known to have several
    for batch in it:
        known_ = batch.column("known")
        again = batch.filter(known_)
        if again.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(again.num_rows, np.int8)), *[again.column(c).cast(pa.int64()) for c in names[1:]]], names=names)
        batch = batch.filter(pc.invert(known_))
        n = batch.num_rows
        if not n:
            continue
        h, run, doc, row, lo, hi = (batch.column(c).to_numpy().astype(np.int64) for c in ("h", "run", "doc_id", "row", "lo", "hi"))
        new_h, new_run = np.ones(n, bool), np.ones(n, bool)
        new_h[1:] = h[1:] != h[:-1]
        new_run[1:] = new_h[1:] | (run[1:] != run[:-1])
        if last is not None:
            new_h[0] = h[0] != last[0]
            new_run[0] = new_h[0] or run[0] != last[1]
        first = np.maximum.accumulate(np.where(new_run, np.arange(n), -1))
        f_row = np.where(first >= 0, row[first], last[3] if last else 0)
        f_lo = np.where(first >= 0, lo[first], last[4] if last else 0)
        again = ~new_run & ((row != f_row) | (lo != f_lo))
        # Firsts of runs in order, the open one before them: a first counts if the first before or after has its anchor.
        at = np.flatnonzero(new_run)
        firsts = [v[at] for v in (h, doc, row, lo, hi)]
        known = np.zeros(len(at), bool)
        if last is not None:
            firsts = [np.concatenate(([v], x)).astype(np.int64) for v, x in zip((last[0], *last[2:6]), firsts, strict=True)]
            known = np.concatenate(([last[6]], known))
        same = firsts[0][1:] == firsts[0][:-1]
        several = np.zeros(len(firsts[0]), bool)
        several[1:] |= same
        several[:-1] |= same
        give = several & ~known
        last = (int(firsts[0][-1]), int(run[at[-1]]) if len(at) else last[1], *[int(v[-1]) for v in firsts[1:]], bool(several[-1] or known[-1]))
        kind = np.concatenate((np.zeros(int(again.sum()), np.int8), np.ones(int(give.sum()), np.int8)))
        yield pa.RecordBatch.from_arrays([pa.array(kind), *[pa.array(np.concatenate((x[again], y[give]))) for x, y in zip((h, doc, row, lo, hi), firsts, strict=True)]], names=names)


def _cut_out(it):
    for block in batches(it):
        out = []
        for doc, row, text, parts in zip(block["doc_id"], block["row"], block["text"], block["parts"], strict=True):
            data = (text or "").encode()
            out += [(p["h"], p["hot"], doc, row, p["lo"], data[p["lo"] : p["hi"] + LENGTH]) for p in parts if p["hi"] + LENGTH <= len(data)]
        if out:
            c = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.bool_()), *[pa.array(v, pa.int64()) for v in c[2:5]], pa.array(c[5], pa.binary())], names=["key", "hot", "doc_id", "row", "lo", "bytes"])


def _anchored(it):
    """Pieces with the place (kl, kr) of their anchor, whose hash is their key."""
    for batch in it:
        if not batch.num_rows:
            continue
        data, begin = joined(batch.column("bytes").to_pylist())
        sums, back = sums_of(data)
        with np.errstate(over="ignore"):
            h = splitmix((sums[GRAM:] - sums[:-GRAM]) * back[: len(data) + 1 - GRAM]).view(np.int64)
        of = np.repeat(np.arange(batch.num_rows), np.diff(begin))[: len(h)]
        hits = np.flatnonzero(h == batch.column("key").to_numpy()[of])
        piece, first = np.unique(of[hits], return_index=True)
        kl = np.zeros(batch.num_rows, np.int32)
        kl[piece] = hits[first] - begin[piece]
        yield batch.select(["key", "doc_id", "row", "lo", "bytes"]).append_column("kl", pa.array(kl)).append_column("kr", pa.array(kl + GRAM))


def joined(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pieces one after the other, and where each begins (one more at the end)."""
    begin = np.concatenate(([0], np.cumsum([len(p) for p in pieces], dtype=np.int64)))
    return np.frombuffer(b"".join(pieces), np.uint8), begin


def _refine(step: int):
    """The two parts of each piece: windows with more unknown bytes on the left of what is known, and the others. whole stands for all bytes of a part."""

    def refine(it):
        for batch in it:
            pieces = batch.column("bytes").to_pylist()
            if not pieces:
                continue
            data, begin = joined(pieces)
            sums, back = sums_of(data)
            key, kl, kr, lo = (batch.column(c).to_numpy().astype(np.int64) for c in ("key", "kl", "kr", "lo"))
            n = np.diff(begin) - LENGTH + 1
            left = LENGTH - kr + kl + 1 >> 1
            # Windows start at kl - x, with x bytes of the window on the left of what is known: x >= left, or x < left.
            for side, (first, last, l2, r2) in enumerate(((np.zeros_like(n), np.minimum(n - 1, kl - left), kl - left, kr), (np.maximum(0, kl - left + 1), n - 1, kl, kl - left + 1 + LENGTH))):
                some = np.flatnonzero(first <= last)
                if not len(some):
                    continue
                a, b, l2, r2 = begin[some] + first[some], begin[some] + last[some] + LENGTH, l2[some], r2[some]
                with np.errstate(over="ignore"):
                    known = (sums[begin[some] + r2] - sums[begin[some] + l2]) * back[begin[some] + l2]
                    salt = splitmix((key[some] * 16 + step * 2 + side).astype(np.uint64))
                    whole = splitmix(splitmix((sums[b] - sums[a]) * back[a] + SALT[0]) + ((l2 - first[some]) * 4096 + b - a).astype(np.uint64))
                    fresh = splitmix(known + salt)
                cols = [fresh.view(np.int64), whole.view(np.int64), batch.column("doc_id").to_numpy()[some], batch.column("row").to_numpy()[some], lo[some] + first[some]]
                ends = [(l2 - first[some]).astype(np.int32), (r2 - first[some]).astype(np.int32)]
                cut_ = pa.array([data[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in cols], cut_, *[pa.array(c) for c in ends]], names=["key", "whole", "doc_id", "row", "lo", "bytes", "kl", "kr"])

    return refine


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros behind the end."""
    n = len(data)
    wide = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | wide[i : n + i]
    return key


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of data in order of their first `depth` bytes at least (what is behind the end sorts first)."""
    n = len(data)
    key = eight_bytes(data)
    sa = np.argsort(key)
    k = key[sa]
    new = np.ones(n, bool)
    new[1:] = k[1:] != k[:-1]
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[sa] = group
    h = 8
    open_ = np.arange(n)
    while h < depth:
        # What stays open is the places of groups of more than one; the others keep their rank.
        g = group[open_]
        many = np.zeros(len(open_), bool)
        many[1:] = g[1:] == g[:-1]
        many[:-1] |= many[1:]
        open_, g = open_[many], g[many]
        if not len(open_):
            break
        own = sa[open_]
        both = g * (n + 1) + rank[np.minimum(own + h, n)] + 1
        order = np.argsort(both)
        own, both = own[order], both[order]
        sa[open_] = own
        fresh = np.ones(len(open_), bool)
        fresh[1:] = both[1:] != both[:-1]
        place = np.maximum.accumulate(np.where(fresh, np.arange(len(open_)), 0))
        group[open_] = open_[place]
        rank[own] = group[open_]
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix in order with the one before it, up to `most` bytes."""
    n = len(data)
    key = eight_bytes(data)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] == before[:-1] + 1) & (before[:-1] >= 0)
    follows[1:] &= data[:-1] == data[before[:-1]]
    # A position whose neighbour moves along shares one byte less than the position before it; where that one was cut off at
    # `most`, the position is compared itself.
    at = np.flatnonzero(~follows & (before >= 0))
    out = np.zeros(n, np.int64)
    out[at] = _compare(key, at, before[at], most)
    head = np.maximum.accumulate(np.where(~follows, np.arange(n), 0))
    value = out[head] - (np.arange(n) - head)
    redo = np.flatnonzero(follows & (out[head] >= most))
    value[redo] = _compare(key, redo, before[redo], most)
    return np.maximum(value, 0)[sa]


def _compare(key: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Common prefixes at places a and b, eight bytes at a time."""
    n = len(key)
    room = np.minimum(n - np.maximum(a, b), most)
    out = room.copy()
    live = np.arange(len(a))
    for k in range(0, most, 8):
        live = live[room[live] > k]
        x = key[a[live] + k] ^ key[b[live] + k]
        apart = x != 0
        if apart.any():
            bits = x[apart].astype(">u8").view(np.uint8).reshape(-1, 8) != 0
            out[live[apart]] = np.minimum(room[live[apart]], k + bits.argmax(1))
        live = live[~apart]
        if not len(live):
            break
    return out


def repeated_windows(data: np.ndarray, begin: np.ndarray, doc: np.ndarray, row: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Places in the joined pieces whose window has an equal one that is earlier in (doc, row, start)."""
    of = np.repeat(np.arange(len(lo)), np.diff(begin))
    sa = suffix_array(data, LENGTH)
    shared = common_prefixes(data, sa, LENGTH)
    piece = of[sa]
    new = np.ones(len(sa), bool)
    new[1:] = shared[1:] < LENGTH
    # Neighbours that share LENGTH bytes may lie behind a piece's end; only whole windows count.
    want = (sa + LENGTH <= begin[piece + 1]) & ~(new & np.append(new[1:], True))
    group = np.cumsum(new)[want]
    own, piece = sa[want], piece[want]
    start = lo[piece] + own - begin[piece]
    order = np.lexsort((start, row[piece], doc[piece], group))
    first = np.ones(len(order), bool)
    g = group[order]
    first[1:] = g[1:] != g[:-1]
    head = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    late = ~first & ((row[piece[order]] != row[piece[head]]) | (start[order] != start[head]))
    return own[order[late]]


def _blocks(it, rows: int):
    """pyarrow tables of `rows` rows (the last one of fewer), in order."""
    held, n = [], 0
    for batch in it:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            held.append(part)
            n += part.num_rows
            batch = batch.slice(part.num_rows)
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()
    tidy()


def _shards(rows: int):
    """Repeated windows of pieces sorted by (key, doc_id, row, lo), as runs of starts; shards that share a key are merged."""

    def shards(it):
        open_, before = None, np.zeros(0, np.uint64)  # the key of the shard before that may go on, and its windows
        last = None  # the piece before
        for t in _blocks(it, rows):
            full = len(t) == rows
            place = [t.column(c).to_numpy() for c in ("key", "row", "lo")]
            new = np.ones(len(t), bool)  # equal rows bring a piece more than once
            new[1:] = np.any([v[1:] != v[:-1] for v in place], axis=0)
            new[0] = last != [int(v[0]) for v in place]
            last = [int(v[-1]) for v in place]
            t = t.filter(pa.array(new))
            if not len(t):
                continue
            doc, row, lo, key = (t.column(c).to_numpy() for c in ("doc_id", "row", "lo", "key"))
            data, begin = joined(t.column("bytes").to_pylist())
            late = np.zeros(len(data), bool)
            late[repeated_windows(data, begin, doc, row, lo)] = True
            sums, back = sums_of(data)

            def contents(pieces: slice, begin=begin, data=data, sums=sums, back=back) -> tuple[np.ndarray, np.ndarray]:
                n = np.diff(begin)[pieces] - LENGTH + 1
                at = np.repeat(begin[:-1][pieces] - np.cumsum(n) + n, n) + np.arange(n.sum())
                with np.errstate(over="ignore"):
                    return at, splitmix((sums[at + LENGTH] - sums[at]) * back[at])

            if open_ is not None and key[0] == open_:
                at, content = contents(slice(0, int(np.searchsorted(key, open_, "right"))))
                found = np.minimum(np.searchsorted(before, content), max(len(before) - 1, 0))
                late[at[before[found] == content] if len(before) else at[:0]] = True
            if full:
                _, content = contents(slice(int(np.searchsorted(key, key[-1])), len(key)))
                before = np.union1d(before, content) if open_ == key[-1] else np.unique(content)
                open_ = int(key[-1])
            place = np.flatnonzero(late)
            piece = np.searchsorted(begin, place, "right") - 1
            new = np.ones(len(place), bool)
            new[1:] = (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)
            at = np.flatnonzero(new)
            end = place[np.append(at[1:], len(place)) - 1] if len(place) else place
            of = piece[at]
            shift = lo[of] - begin[of]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (doc[of], row[of], place[at] + shift, end + shift)], names=["doc_id", "row", "lo", "hi"])

    return shards


def _unite(it):
    """Of the runs of starts of each document: the removed bytes, as few disjoint runs (lo, end exclusive)."""
    for batch in it:
        if not batch.num_rows:
            continue
        out = []
        for ranges in batch.column("ranges"):
            v = ranges.values
            lo, end = v.field("lo").to_numpy(), v.field("hi").to_numpy() + LENGTH
            order = np.argsort(lo, kind="stable")
            lo, end = lo[order], np.maximum.accumulate(end[order])
            new = np.ones(len(lo), bool)
            new[1:] = lo[1:] > end[:-1]
            at = np.flatnonzero(new)
            out.append(np.stack((lo[at], end[np.append(at[1:], len(lo)) - 1]), 1).astype(np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("id_row"), pa.array(out, pa.binary())], names=["id", "id_row", "gone"])


def _apply(it):
    for block in batches(it):
        rows = []
        for doc, text, packed in zip(block["doc_id"], block["text"], block["gone"], strict=True):
            data = (text or "").encode()
            gone = np.minimum(np.frombuffer(packed or b"", np.int64).reshape(-1, 2), len(data))
            gone = gone[gone[:, 0] < gone[:, 1]]
            rest, at = [], 0
            for lo, end in gone.tolist():
                rest.append(data[at:lo])
                at = end
            rest.append(data[at:])
            rows.append((doc, len(data), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), hashlib.sha256(b"".join(rest)).hexdigest()))
        c = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([*[pa.array(v, pa.int64()) for v in c[:4]], pa.array(c[4], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _refined(hot: DataFrame, most: int, keep: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Pieces of hot keys, refined until no key has more than `most`: the pieces for the shards with keep's, and (doc_id, row, lo, hi) of repeats found on the way."""
    schema = "key bigint, whole bigint, doc_id bigint, row bigint, lo bigint, bytes binary, kl int, kr int"
    again = []
    hot = hot.mapInArrow(_anchored, "key bigint, doc_id bigint, row bigint, lo bigint, bytes binary, kl int, kr int")
    step = 0
    while True:
        parts = cut(hot.mapInArrow(_refine(step), schema), f"parts{step}")
        # Of equal parts the first one stays; minima are taken before anything moves, so a very common part is no one task's.
        first = parts.groupBy("key", "whole").agg(F.min(F.struct("doc_id", "row", "lo", "bytes", "kl", "kr")).alias("f"), F.count("*").alias("n"))
        first = cut(first.select("key", "whole", "n", "f.*"), f"first{step}")
        many = first.filter("n > 1").select("key", "whole", F.col("row").alias("f_row"), F.col("lo").alias("f_lo"))
        same = parts.join(small_side(many, 48), ["key", "whole"]).filter("row <> f_row OR lo <> f_lo")
        again.append(same.select("doc_id", "row", "lo", (F.col("lo") + F.length("bytes") - LENGTH).alias("hi")))
        keys = cut(first.groupBy("key").agg(F.count("*").alias("n_key")).filter("n_key > 1"), f"keys{step}")
        live = first.select("key", "doc_id", "row", "lo", "bytes", "kl", "kr").join(small_side(keys, 32), "key")
        keep = keep.unionByName(live.filter(F.col("n_key") <= most).select("key", "doc_id", "row", "lo", "bytes"))
        step += 1
        if keys.filter(F.col("n_key") > most).isEmpty():
            return keep, again
        hot = live.filter(F.col("n_key") > most).drop("n_key")


def repeated_ranges(docs: DataFrame, hot: int = HOT, shard: int = SHARD_ROWS) -> DataFrame:
    """doc_id, row, lo, hi: runs of starts (bytes, both ends included) of LENGTH-byte strings of docs (doc_id, row, text) that also start earlier."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.filter("doc_id IS NOT NULL")
    runs = docs.mapInArrow(_runs, "h bigint, run bigint, doc_id bigint, row bigint, lo int, hi int, known boolean")
    sifted = runs.repartition(parts, "h").sortWithinPartitions("h", "run", "doc_id", "row", "lo")
    sifted = cut(sifted.mapInArrow(_sift, "kind tinyint, h bigint, doc_id bigint, row bigint, lo bigint, hi bigint"), "sifted")
    several = sifted.filter("kind = 1").drop("kind")
    busy = cut(several.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select("h", F.lit(True).alias("hot")), "busy")
    several = several.join(small_side(busy, 16), "h", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    asked = cut(several.groupBy(F.col("doc_id").alias("id"), F.col("row").alias("id_row")).agg(F.collect_list(F.struct("h", "hot", "lo", "hi")).alias("parts")), "asked")
    # Equal rows are one document: their pieces are cut out of each, and equal ones are one below.
    pieces = docs.join(asked, (docs["doc_id"] == asked["id"]) & (docs["row"] == asked["id_row"])).select("doc_id", "row", "text", "parts")
    pieces = pieces.mapInArrow(_cut_out, "key bigint, hot boolean, doc_id bigint, row bigint, lo bigint, bytes binary")
    again = []
    if busy.isEmpty():
        pieces = pieces.drop("hot")
    else:
        pieces = cut(pieces, "pieces")
        pieces, again = _refined(pieces.filter("hot"), hot, pieces.filter("NOT hot").drop("hot"))
    pieces = pieces.repartition(parts, "key").sortWithinPartitions("key", "doc_id", "row", "lo")
    out = pieces.mapInArrow(_shards(shard), "doc_id bigint, row bigint, lo bigint, hi bigint").unionByName(sifted.filter("kind = 0").select("doc_id", "row", "lo", "hi"))
    for x in again:
        out = out.unionByName(x)
    return out


def dedup_substrings(docs: DataFrame, hot: int = HOT, shard: int = SHARD_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs (doc_id, text)."""
    docs = row_key(docs)
    ranges = repeated_ranges(docs, hot, shard).groupBy(F.col("doc_id").alias("id"), F.col("row").alias("id_row")).agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    gone = cut(ranges.mapInArrow(_unite, "id bigint, id_row bigint, gone binary"), "gone")
    joined = docs.join(small_side(gone, 56, F.length("gone")), (docs["doc_id"] == gone["id"]) & (docs["row"] == gone["id_row"]), "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(_apply, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))
