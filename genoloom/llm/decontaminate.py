"""Benchmark decontamination in a latent space, with subsequence and answer checks.

Benchmark items are cut into pieces of at most PIECE words; texts into passages of SPAN words, each half over the one before.
Words weigh by their document frequency over all documents (counted in DF_BUCKETS hash buckets). A distributed randomised SVD
of the corpus' TF-IDF passages over all words, in LATENT hashed features, gives the latent directions: one pass multiplies the
passage matrix X with a random test matrix and its transpose back (X'X Omega, a sum over partitions of bounded size), and the
Nystroem form of the result gives the leading right singular vectors. A passage or piece has two coordinates: its words as they
are, and its place in the latent space, in which words that occur together lie near each other.

Every passage is projected, and compared with every piece in the latent space (each direction divided by its singular value,
so that the few strongest do not decide alone, and shrunk to nothing where this comes down to that of chance). It becomes a candidate for a piece if their latent cosine
reaches NEAR of what a copy of the piece has in the best passage of its worst place: so items told in other words of the same
subject are found, whose common words are too light for a cosine of words. As no latent space of few directions keeps rare
words apart, a second way guards verbatim copies: the cosine of the words, plus WEIGHT of the latent cosine, reaches a limit.
The limit is a piece's own: the cosine, with even weights, of a piece of its length that keeps PARAPHRASE
of its words, in the best passage of its worst place, times SLACK as the kept words may be the lighter ones. Only this second
way asks first that a passage has enough of its weight in benchmark words for any cosine to reach the least limit of a space;
spaces hold pieces of like length. Candidates are checked in the text around the passage: the longest common subsequence with
the piece must cover COPY of it, or PARAPHRASE of it if the piece's answer (its last ANSWER words) is there in one run. Latent
candidates around which too few of the piece's words stand for that, in whatever order, are not checked further.

The benchmark is the query set. Its pieces, cut on the executors, come to the driver in blocks of about AT_ONCE (16 bytes a
word) and go to every task, which builds the matrices of SPACE pieces each; one pass over the texts serves a block, whatever
the length of an item. A null or empty text, or item, matches nothing. Equal rows give one result, rows that share a doc_id
are one document of several texts. Texts are read whole, very long ones too. Of several passages the one with the
largest share counts, of those that hold a piece whole the first. Other
columns are ignored. An empty table or benchmark gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, buffer_of, cut, row_key, table, tidy, words_of

SPAN = 32
PIECE = 64
#: Pieces of one pass over the texts, and of one matrix.
AT_ONCE = 1500
SPACE = 250
DF_BUCKETS = 1 << 17
LATENT = 1 << 14
SKETCH = 80
#: Columns of the sketch in a row of its sum.
COLUMNS = 16
DIRECTIONS = 64
WEIGHT = 0.05
#: Share of a copy's latent cosine.
NEAR = 0.65
#: For weights that are not even.
SLACK = 0.85
COPY = 0.6
PARAPHRASE = 0.45
ANSWER = 4
SEED = 3
SCHEMA = "doc_id bigint, item_id bigint, start_word bigint, cosine double, lcs_share double, answer boolean, row bigint"
PIECES = "item_id bigint, no int, words binary"


def _bucket(w: np.ndarray) -> np.ndarray:
    return (w & np.uint64(DF_BUCKETS - 1)).astype(np.int64)


def _latent(w: np.ndarray) -> np.ndarray:
    return ((w >> np.uint64(20)) & np.uint64(LATENT - 1)).astype(np.int64)


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per word bucket, and documents. At most DF_BUCKETS + 1 rows come to the driver."""

    def count(it):
        total, n = np.zeros(DF_BUCKETS + 1, np.int64), 0
        for block in batches(it):
            buf, starts = buffer_of(block["text"])
            w, begin, _, first = words_of(buf, starts)
            text = np.searchsorted(starts, begin, "right") - 1
            for lo in range(0, len(block["text"]), 8192):  # so that text and bucket fit 32 bits
                own = slice(first[lo], first[min(lo + 8192, len(first) - 1)])
                pairs = np.sort(((text[own] - lo) * DF_BUCKETS + _bucket(w[own])).astype(np.int32))
                pairs = pairs[np.flatnonzero(np.diff(pairs, prepend=-1))]
                total[:-1] += np.bincount(pairs & (DF_BUCKETS - 1), minlength=DF_BUCKETS)
            n += len(block["text"])
        total[-1] = n
        tidy()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["b", "c"])

    got = docs.select("text").mapInArrow(count, "b int, c bigint").groupBy("b").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(DF_BUCKETS + 1, np.int64)
    out[got["b"].to_numpy()] = got["c"].to_numpy()
    return out[:-1], int(out[-1])


def copied(n: int) -> float:
    """The cosine, with even weights, of a piece of n words and the best passage that holds it at its worst place."""
    step = SPAN // 2
    best = min(max(min(o + n, at + SPAN) - max(o, at) for at in range(0, o + n, step)) for o in range(step))
    return best / (SPAN * n) ** 0.5


def limit(n: int) -> float:
    """The cosine from which a passage is a candidate for a piece of n words."""
    return SLACK * PARAPHRASE * copied(n)


def _cut_pieces(it):
    """Pieces of items: words of at most PIECE, each half over the one before."""
    for block in batches(it):
        out = []
        for item_id, text in zip(block["item_id"], block["text"], strict=True):
            w = words_of(*buffer_of([text]))[0]
            if len(w):
                out += [(item_id, k, w[s : s + PIECE].tobytes()) for k, s in enumerate(range(0, max(len(w) - PIECE // 2, 1), PIECE // 2))]
        if out:
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], names=["item_id", "no", "words"])


class Space:
    """The pieces of one matrix: their words' weights (feature by piece, rows of unit length), and their latent places."""

    def __init__(self, pieces: list[tuple[int, np.ndarray]], idf: np.ndarray, directions: np.ndarray):
        self.item, self.words = [i for i, _ in pieces], [w for _, w in pieces]
        self.vocabulary = np.unique(np.concatenate(self.words))
        self.seen = np.zeros(1 << 20, bool)  # of the top 20 bits of a word's hash
        self.seen[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True
        self.matrix = np.zeros((len(self.vocabulary), len(pieces)), np.float32)
        self.places = np.zeros((len(pieces), directions.shape[1]), np.float32)
        for i, w in enumerate(self.words):
            weight = idf[_bucket(w)]
            np.add.at(self.matrix[:, i], np.searchsorted(self.vocabulary, w), weight)
            self.places[i] = weight @ directions[_latent(w)]
        self.matrix /= np.maximum(np.linalg.norm(self.matrix, axis=0), 1e-9)
        self.places /= np.maximum(np.linalg.norm(self.places, axis=1, keepdims=True), 1e-9)
        self.limits = np.array([limit(len(w)) for w in self.words])
        self.near = np.array([NEAR * copied(len(w)) for w in self.words], np.float32)
        self.sizes = np.array([len(w) for w in self.words])
        # The places of a piece that a word has (feature by piece), as bits, and those of the answer.
        self.bits = np.zeros(self.matrix.shape, np.uint64)
        for i, w in enumerate(self.words):
            np.bitwise_or.at(self.bits[:, i], np.searchsorted(self.vocabulary, w), np.uint64(1) << np.arange(len(w), dtype=np.uint64))
        self.answers = np.array([((1 << len(w)) - 1) & ~((1 << max(len(w) - ANSWER, 0)) - 1) for w in self.words], np.uint64)
        self.most = self.matrix.max(1)  # what a word can add to a cosine with any piece

    def features(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each word, and whether it is a word of the pieces."""
        own = self.seen[(w >> np.uint64(44)).astype(np.int64)]
        out = np.zeros(len(w), np.int32)
        maybe = np.flatnonzero(own)
        at = np.minimum(np.searchsorted(self.vocabulary, w[maybe]), len(self.vocabulary) - 1)
        same = self.vocabulary[at] == w[maybe]
        own[maybe[~same]] = False
        out[maybe[same]] = at[same]
        return out, own


def sums_of(rows: np.ndarray, which: np.ndarray, weight: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The weighted sums of rows[which], from each place of begin (the first is 0) to the next; some at a time, so that they stay in a processor's cache."""
    out = np.zeros((len(begin), rows.shape[1]), np.float32)
    for lo in range(0, len(which), 4096):
        hi = min(lo + 4096, len(which))
        a, b = np.searchsorted(begin, lo, "right") - 1, np.searchsorted(begin, hi, "left")
        part = rows[which[lo:hi]]
        part *= weight[lo:hi, None]
        out[a:b] += np.add.reduceat(part, np.maximum(begin[a:b] - lo, 0), axis=0)
    return out


def omega() -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(LATENT, SKETCH)).astype(np.float32)


def directions(docs: DataFrame, sent) -> np.ndarray:
    """The leading right singular vectors of the passages of all texts (TF-IDF, LATENT features), divided by their singular values and shrunk as these come near the first one left out: one pass makes Y = X'X Omega, and X'X is about Y (Omega'Y)^-1 Y'."""
    cols = [f"c{k}" for k in range(COLUMNS)]
    parts = SKETCH // COLUMNS

    def multiply(it):
        idf = sent.value
        test = omega()
        total = np.zeros((LATENT, SKETCH), np.float32)
        for block in batches(it):
            buf, starts = buffer_of(block["text"])
            w, _, _, first = words_of(buf, starts)
            if not len(w):
                continue
            f, weight = _latent(w), idf[_bucket(w)].astype(np.float32)
            text = np.repeat(np.arange(len(first) - 1), np.diff(first))
            begin = np.flatnonzero((np.arange(len(w)) - first[text]) % SPAN == 0)
            size = np.diff(np.append(begin, len(w)))
            norm = np.add.reduceat(weight * weight, begin)
            t = sums_of(test, f, weight, begin) / np.maximum(norm, 1e-9)[:, None]
            order = np.argsort(f.astype(np.uint16), kind="stable")  # one sum for each feature
            f, weight, passage = f[order], weight[order], np.repeat(np.arange(len(begin)), size)[order]
            at = np.flatnonzero(np.diff(f, prepend=-1))
            total[f[at]] += sums_of(t, passage, weight, at)
        total = total.reshape(-1, COLUMNS)
        some = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(total[some, k]) for k in range(COLUMNS)]], names=["row", *cols])
        tidy()

    got = docs.select("text").mapInArrow(multiply, "row int, " + ", ".join(f"{c} float" for c in cols)).groupBy("row").agg(*[F.sum(c).alias(c) for c in cols]).toArrow()
    y = np.zeros((LATENT * parts, COLUMNS))
    y[got["row"].to_numpy()] = np.stack([got[c].to_numpy() for c in cols], 1)
    y = y.reshape(LATENT, SKETCH)
    value, vector = np.linalg.eigh((lambda m: (m + m.T) / 2)(omega().T.astype(float) @ y))
    good = value > max(value.max(), 1e-12) * 1e-6
    half = y @ (vector[:, good] / np.sqrt(value[good]))  # half half' is the Nystroem form
    u, s, _ = np.linalg.svd(half, full_matrices=False)
    out = np.zeros((LATENT, DIRECTIONS), np.float32)
    n = min(DIRECTIONS, int((s > max(s.max(initial=0), 1e-9) * 1e-3).sum()))
    if n:
        out[:, :n] = u[:, :n] / s[:n] * (1 - (s[min(n, len(s) - 1)] / s[:n]) ** 2)
    return out


def lcs(piece: list[int], region: list[int]) -> int:
    where: dict[int, int] = {}
    for j, x in enumerate(piece):
        where[x] = where.get(x, 0) | (1 << j)
    full = (1 << len(piece)) - 1
    v = full
    for x in region:
        hit = v & where.get(x, 0)
        if hit:
            v = ((v + hit) | (v - hit)) & full
    return len(piece) - v.bit_count()


def has_run(run: list[int], region: list[int]) -> bool:
    return any(region[i : i + len(run)] == run for i in range(len(region) - len(run) + 1))


def _search(sent):
    def search(it):
        block_pieces, idf, latent = sent.value
        spaces = [Space(block_pieces[k : k + SPACE], idf, latent) for k in range(0, len(block_pieces), SPACE)]
        for block in batches(it, 1 << 19):
            buf, starts = buffer_of(block["text"])
            w, _, _, first = words_of(buf, starts)
            if not len(w):
                continue
            weight = idf[_bucket(w)].astype(np.float32)
            size = np.diff(first)
            n = np.maximum(-(-(size - SPAN) // (SPAN // 2)), 0) + 1
            n[size == 0] = 0
            text = np.repeat(np.arange(len(size)), n)
            begin = first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * (SPAN // 2)
            end = np.minimum(begin + SPAN, first[text + 1])
            square = weight.astype(float) ** 2
            sums = np.concatenate(([0.0], np.cumsum(square)))
            norm = np.sqrt(np.maximum(sums[end] - sums[begin], 1e-9))
            # Places of the passages, each from the sums of its two halves.
            blocks = -(-size // (SPAN // 2))
            half = np.concatenate(([0], np.cumsum(blocks)))
            halves = np.repeat(first[:-1], blocks) + (np.arange(half[-1]) - np.repeat(half[:-1], blocks)) * (SPAN // 2)
            at_half = half[text] + (begin - first[text]) // (SPAN // 2)
            z = sums_of(latent, _latent(w), weight, halves)
            z = z[at_half] + z[np.minimum(at_half + 1, len(z) - 1)] * (blocks[text] > 1)[:, None]
            z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
            best: dict[tuple[int, int], tuple] = {}
            for space in spaces:
                known: dict[tuple[int, bytes], tuple] = {}  # what equal surroundings gave
                f, own = space.features(w)
                for at in range(0, len(z), 2048):
                    near = _near(space, z[at : at + 2048], f, own, at_half[at : at + 2048], half[text[at : at + 2048]], half[text[at : at + 2048] + 1], halves)
                    _check(space, w, f, own, text, first, begin, end, ((at + i, p, c) for i, p, c in near), best, known)
                mine, most = (np.concatenate(([0.0], np.cumsum(np.where(own, x, 0)))) for x in (square, weight * space.most[f]))
                least = (space.limits.min() - WEIGHT) * norm - 1e-6
                keep = np.flatnonzero((np.sqrt(np.maximum(mine[end] - mine[begin], 0)) >= least) & (most[end] - most[begin] >= least))
                for at in range(0, len(keep), 2048):
                    _check(space, w, f, own, text, first, begin, end, _alike(space, z, f, own, weight, begin, end, norm, keep[at : at + 2048]), best, known)
            if best:
                rows = [(block["doc_id"][t], item, -s, c, share, a, block["row"][t]) for (t, item), (share, c, s, a) in best.items()]
                types = [pa.int64()] * 3 + [pa.float64()] * 2 + [pa.bool_(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return search


def _near(space: Space, z, f, own, at_half, low, high, halves):
    """Candidates by the latent space: (passage, piece, latent cosine) for passages with places z, whose first half is at_half and whose text has the halves from low to high."""
    cos = z @ space.places.T
    passage, piece = np.nonzero(cos >= space.near)
    if not len(passage):
        return
    # The places of a piece whose words stand in the halves around: at most so many are in a common subsequence.
    step = SPAN // 2
    around = -(-space.sizes // step)
    lo = np.maximum(at_half[passage] - around[piece], low[passage])
    hi = np.minimum(at_half[passage] + 2 + around[piece], high[passage])
    base, top = int(lo.min()), int(hi.max())
    token = np.arange(halves[base], halves[top] if top < len(halves) else len(f))
    token = token[own[token]]
    there = np.zeros((top - base, len(space.words)), np.uint64)
    if len(token):
        block = np.searchsorted(halves, token, "right") - 1 - base
        at = np.flatnonzero(np.diff(block, prepend=-1))
        for k in range(0, len(at), 128):
            own_ = slice(at[k], at[k + 128] if k + 128 < len(at) else len(token))
            there[block[at[k : k + 128]]] = np.bitwise_or.reduceat(space.bits[f[token[own_]]], at[k : k + 128] - at[k], axis=0)
    got = np.zeros(len(passage), np.uint64)
    for k in range(int((hi - lo).max())):
        own_ = np.minimum(lo + k, hi - 1)
        got |= there[own_ - base, piece]
    n = np.bitwise_count(got)
    answer = space.answers[piece]
    good = (n >= COPY * space.sizes[piece]) | ((n >= PARAPHRASE * space.sizes[piece]) & (got & answer == answer))
    for i in np.flatnonzero(good).tolist():
        yield int(passage[i]), int(piece[i]), float(cos[passage[i], piece[i]])


def _alike(space: Space, z, f, own, weight, begin, end, norm, some):
    """Candidates by their words: (passage, piece, cosine with the latent part) for passages `some`."""
    length = end[some] - begin[some]
    cut_ = np.concatenate(([0], np.cumsum(length)))
    token = np.repeat(begin[some] - cut_[:-1], length) + np.arange(cut_[-1])
    passage = np.repeat(np.arange(len(some)), length)
    inside = own[token]
    token, passage = token[inside], passage[inside]
    cos = np.zeros((len(some), space.matrix.shape[1]), np.float32)
    if len(token):
        at = np.flatnonzero(np.diff(passage, prepend=-1))
        cos[passage[at]] = np.add.reduceat(space.matrix[f[token]] * weight[token][:, None], at, axis=0)
    cos /= norm[some][:, None]
    # Where the latent space may decide, its cosines are added.
    near = np.flatnonzero((cos >= space.limits - WEIGHT).any(1))
    cos = cos[near] + WEIGHT * (z[some[near]] @ space.places.T)
    for i, p in zip(*np.nonzero(cos >= space.limits), strict=True):
        yield int(some[near[i]]), int(p), float(cos[i, p])


def _check(space: Space, w, f, own, text, first, begin, end, candidates, best: dict, known: dict) -> None:
    """Enters in best what candidates hold of the pieces of a space: (text, item) to (share, cosine, minus start, answer)."""
    for k, p, cosine in candidates:
        t, size = int(text[k]), len(space.words[p])
        key = (t, space.item[p])
        if key in best and best[key][0] == 1:
            continue  # held whole
        region = slice(max(int(first[t]), int(begin[k]) - size), min(int(first[t + 1]), int(end[k]) + size))
        # Only the piece's own words can be in a common subsequence.
        shared = w[region][own[region] & (space.matrix[f[region], p] > 0)]
        if len(shared) < PARAPHRASE * size:
            continue
        around = (p, w[region].tobytes())
        if around not in known:
            piece = space.words[p].tolist()
            share = lcs(piece, shared.tolist()) / size
            known[around] = share, share >= PARAPHRASE and has_run(piece[-ANSWER:], w[region].tolist())
        share, answer = known[around]
        if share >= COPY or answer:
            got = (share, cosine, -int(begin[k] - first[t]), answer)
            best[key] = max(best.get(key, got), got)


def contaminated(docs: DataFrame, benchmark: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """The pairs of a row and a benchmark item that it holds (SCHEMA), one for each."""
    spark = docs.sparkSession
    docs = row_key(docs)
    items = benchmark.selectExpr("cast(item_id as bigint) item_id", "cast(text as string) text").filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    pieces = cut(items.mapInArrow(_cut_pieces, PIECES).select("item_id", "words").distinct(), "pieces")
    count = pieces.count()
    if not count:
        return spark.createDataFrame([], SCHEMA)
    df, n = document_frequency(docs)
    idf = (np.log((n + 1) / (df + 1)) + 0.1).astype(np.float32)
    latent = directions(docs, spark.sparkContext.broadcast(idf))
    blocks = max(1, -(-count // at_once))
    out = None
    for b in range(blocks):
        own = pieces.filter(F.pmod(F.hash("item_id", "words"), F.lit(blocks)) == b).toArrow()
        rows = sorted(zip(own["item_id"].to_pylist(), own["words"].to_pylist(), strict=True), key=lambda x: (len(x[1]), x))
        sent = spark.sparkContext.broadcast(([(i, np.frombuffer(w, np.uint64)) for i, w in rows], idf, latent))
        found = docs.mapInArrow(_search(sent), SCHEMA)
        out = found if out is None else out.unionByName(found)
    best = out.groupBy("doc_id", "row", "item_id").agg(F.max(F.struct("lcs_share", "cosine", "start_word", "answer")).alias("m"))
    return best.select("doc_id", "item_id", "m.start_word", "m.cosine", "m.lcs_share", "m.answer", "row")


def op2_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")
