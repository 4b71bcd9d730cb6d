"""Centroid clustering, word-table encoding and hard negatives against brute force and the tokenizers library."""

import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from genoloom.llm import centroids, negatives, tokens

R = random.Random(31)
INF, NAN = float("inf"), float("nan")
VECTORS = "vec_id bigint, embedding array<double>, label int"


def lloyd(rows, k, rounds):
    """vec_id, cluster, distance in the order of rows, and final centroids, by plain integers."""
    kept = [(i, [math.floor(1024 * x) for x in e]) for i, e, _ in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    centers = [x for _, x in sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]
    for turn in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(centers)) for _, x in kept]
        if turn == rounds:
            return sorted((str(i), n, d) for (i, _), (d, n) in zip(kept, near, strict=True)), centers
        for n in range(len(centers)):
            own = [x for (_, x), (_, m) in zip(kept, near, strict=True) if m == n]
            if own:
                centers[n] = [sum(col) // len(own) for col in zip(*own, strict=True)]


def some_vectors(n, spread=0.3):
    middle = [[R.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [m + R.gauss(0, spread) for m in middle[i % 5]], R.randrange(4)) for i in range(n)]
    return rows


def test_sort_means_equals_lloyd(spark):
    rows = some_vectors(150) + [(1000 + i, [0.5] * 64, 1) for i in range(40)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [1.0] * 63, 1), (2003, [NAN] * 64, 1), (2004, [None] + [0.0] * 63, 1), (2005, [INF] * 64, 1), (None, [0.25] * 64, None), (7, [0.1] * 64, 1), (7, [0.1] * 64, 1)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("cluster", F.lit("x")).withColumn("x", F.lit(1)).repartition(5)
    for k, rounds in ((8, 10), (3, 1), (20, 3)):
        got, about = centroids.cluster(df, k, rounds)
        want, centers = lloyd(rows, k, rounds)
        assert sorted((str(r[0]), r[1], r[2]) for r in got.collect()) == want
        assert [r["x"] for r in sorted(about.collect())] == centers
        assert sum(r["n"] for r in about.collect()) == len(want)


def test_sort_means_ties_few_and_none(spark):
    # Two starts are equal: the second stays empty.
    rows = [(i, [float(i // 2)] * 64, 0) for i in range(6)]
    got, about = centroids.cluster(spark.createDataFrame(rows, VECTORS))
    assert sorted((str(r[0]), r[1], r[2]) for r in got.collect()) == lloyd(rows, 8, 10)[0]
    assert sorted(r["n"] for r in about.collect()) == [0, 0, 0, 2, 2, 2]
    got, about = centroids.cluster(spark.createDataFrame([(1, None, 0)], VECTORS))
    assert got.count() == 0 and about.count() == 0
    # Components as large as doubles are give the largest distance a long holds for them.
    huge = [(i, [1e300 * (-1) ** i] * 64, 0) for i in range(4)]
    got, _ = centroids.cluster(spark.createDataFrame(huge, VECTORS), 1, 0)
    assert max(r["distance"] for r in got.collect()) == 64 * (2 * centroids.LARGE) ** 2


def test_sort_means_stops_strictly_beyond_twice():
    # x lies midway between centroid 1, its start, and centroid 0, exactly twice as far from 1: the tie goes to 0.
    x, c = np.zeros((1, 64), np.int64), np.zeros((2, 64), np.int64)
    c[0, 0], c[1, 0] = -5, 5
    who, far = centroids.sort_means(x, c, np.array([1]))
    assert (who.tolist(), far.tolist()) == ([0], [25])


def mined(rows):
    """What hard_negatives gives, from all pairs of whole rows."""
    kept = []
    for n, (i, e, label) in enumerate(rows):
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        kept.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in e], n))
    out = []
    for a in kept:
        if a[0] is None or a[0] % 100:
            continue
        score = [(-sum(x * y for x, y in zip(a[2], b[2], strict=True)), b[0] is None, b[0] or 0, b[3], b) for b in kept if len(b[2]) == len(a[2]) and b[3] != a[3]]
        for p in sorted(s for s in score if s[4][1] == a[1])[:5]:
            fit = sorted(s for s in score if s[4][1] != a[1] and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0])[:10]
            out += [(a[0], p[4][0], r, s[4][0], -p[0], -s[0]) for r, s in enumerate(fit, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("leaf", [4, 128])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, leaf):
    monkeypatch.setattr(negatives.BallTree.__init__, "__defaults__", (leaf,))
    rows = [(i, e, label) for i, e, label in some_vectors(420, 0.8)]
    # Ties of score, a label of a third of the rows, and every kind of row that takes no part.
    rows += [(1000 + i, rows[i % 3][1], 2) for i in range(60)] + [(1100, rows[0][1], 3), (1200, [0.0] * 64, 1), (1300, [-v for v in rows[1][1]], 3)]
    rows += [(3000, None, 1), (3100, [NAN] * 64, 1), (3200, [None] * 64, 1), (3300, [1.0] * 64, None), (3400, [0.5] * 8, 1), (3401, [0.5] * 8, 1), (3402, [0.25] * 8, 2), (3500, [], 1), (3501, [], 1), (3502, [], 2), (None, rows[5][1], 2), (3600, [INF] + [0.0] * 63, 1)]
    R.shuffle(rows)
    df = spark.createDataFrame(rows, VECTORS).withColumn("rid", F.lit("x")).withColumn("x", F.lit(1)).repartition(3)
    want = mined(rows)
    assert len(want) > 100
    assert sorted((tuple(r) for r in negatives.hard_negatives(df).collect()), key=str) == want
    assert sorted((tuple(r) for r in negatives.hard_negatives(df, 6000).collect()), key=str) == want


def test_hard_negatives_of_repeated_anchors_large_values_and_nothing(spark):
    rows = [(0, [1.0, 2.0], 1)] * 2 + [(5, [1.0, 2.0], 1), (6, [0.5, 1.0], 2), (8, [0.5, 0.75], 2)]
    df = spark.createDataFrame(rows, VECTORS)
    got = sorted(tuple(r) for r in negatives.hard_negatives(df).collect())
    # Row 0 is there twice and its label becomes 2: each copy is the other's positive, and so are 6 and 8.
    assert got == sorted(mined(rows))
    huge = [(100 * i, [1e300 * (i + 1)] * 64, i % 2) for i in range(6)]
    assert negatives.hard_negatives(spark.createDataFrame(huge, VECTORS)).count() == 0
    assert negatives.hard_negatives(df.limit(0)).count() == 0
    assert negatives.hard_negatives(df.filter("vec_id > 0")).count() == 0


def test_ball_tree_leaves_nodes_out(spark):
    rng = np.random.default_rng(3)
    x = (rng.normal(0, 1, (64, 64)).repeat(100, 0) * 256 + rng.normal(0, 2, (6400, 64))).astype(np.int64)
    tree = negatives.BallTree(x, 64)
    upper, lower = tree.bounds(x[:5])
    seen = []

    class Rows:
        dtype = tree.rows.dtype

        def __getitem__(self, s):
            seen.append(s)
            return rows[s]

    rows, tree.rows = tree.rows, Rows()
    wanted, rank = np.ones(len(x), bool), np.arange(len(x))
    for i in range(5):
        seen.clear()
        exact = rows @ x[i]
        lo, hi = int(exact.max() // 4), int(exact.max() // 2)
        got = tree.best(x[i], upper[i], lower[i], wanted, rank, [(lo, hi)], 5)[0]
        ok = np.flatnonzero((exact >= lo) & (exact <= hi))
        assert got[0].tolist() == ok[np.lexsort((ok, -exact[ok]))[:5]].tolist()
        assert len(seen) < sum(not c for c in tree.child) / 2


TEXTS = [
    None, "", " \t\n\r\x0b\x0c ", "Hello, World! Hello", "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "don't WE'LL it's 1234 ①②", "é é ̈ À֮", "ΑΣ ΑΣΑ İ ſ ß",
    "x\u0085y z w \x1c\x1d", "nul\0nul \0", "日本語 텍스트 👨‍👩‍👧", "w" * 5000, "</w> Ġ the</w>", "Hello, World! Hello", "tab\tnew\nline",
]


@pytest.mark.parametrize("table_bytes", [None, 0, 6000])
def test_encoding_equals_the_library(spark, table_bytes):
    made = tokens.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    own = Tokenizer.from_str(made)
    letters = [chr(c) for c in [*range(0x180), *range(0x300, 0x340), *range(0x2000, 0x2030), 0x3000, 0xFEFF, 0x1F600]]
    rows = list(enumerate(TEXTS)) + [(100 + i, "".join(R.choice(letters if R.random() < 0.7 else " \t\n") for _ in range(40))) for i in range(200)]
    rows += [(500 + i, f"the same text of many copies {i % 3}") for i in range(60)] + [(900, "long " + " ".join(f"v{i * i}" for i in range(60_000)))]
    rows += [(None, "no id"), (None, None), (3, "Hello, World! Hello"), (3, "other words")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit(1)).withColumn("word", F.lit("x")).repartition(5)
    got = tokens.decode(tokens.encode(docs, made, table_bytes), made).collect()
    want = []
    for i, t in rows:
        ids = own.encode(t or "", add_special_tokens=False).ids
        want.append((i, tuple(ids), own.decode(ids, skip_special_tokens=False)))
    assert sorted(((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in got), key=str) == sorted(want, key=str)


def test_each_distinct_word_is_encoded_once(spark):
    made = tokens.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.createDataFrame([(i, "one two two three") for i in range(50)], "doc_id bigint, text string")
    got = {r["word"]: r["n"] for r in tokens.word_table(docs, made).collect()}
    assert got == {"one": 50, "two": 100, "three": 50}
    assert tokens.encode(docs.limit(0), made).count() == 0


def test_tokenizers_of_other_kinds_are_refused():
    with pytest.raises(ValueError, match="one by one"):
        tokens.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
