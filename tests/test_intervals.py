"""Interval operators against counting by base, on random intervals."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoloom.operators import annotate
from genoloom.operators import intervals as iv
from genoloom.operators.annotate import greedy_accept
from genoloom.operators.components import components, exon_components

R = random.Random(5)
ROWS = [(i, R.choice("ab"), s, s + R.randint(0, 40)) for i in range(120) for s in [R.randint(1, 900)]]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id bigint, k string, start bigint, end bigint")


def bases(rows, k):
    return {p for _, x, s, e in rows if x == k for p in range(s, e + 1)}


def test_union_covers_the_same_bases_and_never_touches(df):
    got = iv.merge_intervals(df, ["k"]).collect()
    for k in "ab":
        mine = sorted((r["start"], r["end"]) for r in got if r["k"] == k)
        assert {p for s, e in mine for p in range(s, e + 1)} == bases(ROWS, k)
        assert all(a[1] + 1 < b[0] for a, b in zip(mine, mine[1:], strict=False))


def test_strict_union_keeps_touching_ones_apart(spark):
    x = spark.createDataFrame([("a", 1, 10), ("a", 11, 20), ("a", 15, 30)], "k string, start bigint, end bigint")
    assert sorted((r["start"], r["end"]) for r in iv.merge_intervals(x, ["k"], touching=False).collect()) == [(1, 10), (11, 30)]
    assert iv.merge_intervals(x, ["k"]).count() == 1


@pytest.mark.parametrize("width", [8, 64, 4096])
def test_joins_equal_the_plain_condition(df, width):
    left, right = df.filter("id % 2 = 0"), df.filter("id % 2 = 1")
    want = sorted((a[0], b[0]) for a in ROWS if a[0] % 2 == 0 for b in ROWS if b[0] % 2 and a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3])
    assert sorted((r["id"], r["r_id"]) for r in iv.interval_join(left, right, ["k"], "inner", width).collect()) == want
    hit = {a for a, _ in want}
    assert {r["id"] for r in iv.interval_join(left, right, ["k"], "left_semi", width).collect()} == hit
    assert {r["id"] for r in iv.interval_join(left, right, ["k"], "left_anti", width).collect()} == {r[0] for r in ROWS if r[0] % 2 == 0} - hit
    assert {r["id"] for r in iv.interval_join(left, right, ["k"], "left", width).filter("r_id IS NULL").collect()} == {r[0] for r in ROWS if r[0] % 2 == 0} - hit


def test_semi_join_keeps_repeated_rows(spark):
    a = spark.createDataFrame([("a", 1, 5), ("a", 1, 5)], "k string, start bigint, end bigint")
    assert iv.interval_join(a, a, ["k"], "left_semi", 16).count() == 2


def test_covered_bases(df):
    got = {r["id"]: r["covered"] for r in iv.covered_bases(df, ["k"], df.filter("id < 30"), ["id"], 64).collect()}
    for i, k, s, e in ROWS:
        assert got[i] == len(set(range(s, e + 1)) & bases(ROWS[:30], k))


@pytest.mark.parametrize("how", ["max", "sum"])
def test_depth_by_base(df, how):
    got = {}
    for r in iv.depth_segments(df.withColumn("depth", F.col("id") % 5 + 1), ["k"], "depth", how, 64).collect():
        for p in range(r["start"], r["end"] + 1):
            assert (r["k"], p) not in got
            got[r["k"], p] = r["depth"]
    want = {}
    for i, k, s, e in ROWS:
        for p in range(s, e + 1):
            want.setdefault((k, p), []).append(i % 5 + 1)
    assert got == {x: (max if how == "max" else sum)(v) for x, v in want.items()}


def test_gaps_of_touching_segments(spark):
    x = spark.createDataFrame([("t", 1, 10), ("t", 11, 20), ("t", 31, 40)], "k string, start bigint, end bigint")
    assert [(r["start"], r["end"]) for r in iv.gaps(x, ["k"]).collect()] == [(21, 30)]


def test_nearest_of_another_owner(df):
    x = df.withColumn("own", F.col("id") % 4)
    for r in iv.nearest(x, x.select("k", "own", "start", "end"), ["k"], "own").collect():
        left = [e for i, k, s, e in ROWS if k == r["k"] and i % 4 != r["own"] and e < r["start"]]
        right = [s for i, k, s, e in ROWS if k == r["k"] and i % 4 != r["own"] and s > r["end"]]
        assert (r["left_end"], r["right_start"]) == (max(left, default=None), min(right, default=None))


def test_components_equal_union_find(spark, df):
    root = {i: i for i, *_ in ROWS}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ROWS:
        for b in ROWS:
            if a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3]:
                x, y = find(a[0]), find(b[0])
                root[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in exon_components(df, ["k"], "id").collect()}
    assert got == {i: find(i) for i, *_ in ROWS}


def test_greedy_fold_equals_counting_by_base(spark):
    rows = [(i, "c", "+", s, s + R.randint(0, 30), i % 3, i) for i in range(80) for s in [R.randint(1, 400)]]
    got = {r["gene"] for r in greedy_accept(spark.createDataFrame(rows, "gene bigint, seqid string, strand string, start bigint, end bigint, file_ord bigint, ord bigint")).collect()}
    taken, want = set(), set()
    for g, _, _, s, e, _, _ in sorted(rows, key=lambda r: (r[5], r[6])):
        own = set(range(s, e + 1))
        if len(own & taken) <= 0.5 * len(own):
            want.add(g)
            taken |= own
    assert got == want


@pytest.mark.parametrize("touching", [True, False])
def test_islands_over_tile_edges_equal_one_pass(spark, touching):
    df = spark.createDataFrame([(i, R.choice(["a", None]), s, s + R.randint(0, 25)) for i in range(300) for s in [R.randint(1, 1500)]], "id bigint, k string, start bigint, end bigint")
    one = {tuple(r) for r in iv.merge_intervals(df, ["k"], touching, tile=None).collect()}
    assert {tuple(r) for r in iv.merge_intervals(df, ["k"], touching, tile=16).collect()} == one
    got = iv.islands(df, ["k"], touching, tile=16).collect()
    assert len(got) == 300
    spans: dict = {}
    for r in got:
        lo, hi, n = spans.get((r["k"], r["island"]), (r["start"], r["end"], 0))
        spans[r["k"], r["island"]] = (min(lo, r["start"]), max(hi, r["end"]), n + 1)
    assert {(k, *v) for (k, _), v in spans.items()} == one


def test_components_of_a_long_path_and_a_star(spark):
    rows = [(i, i + 1) for i in range(10, 400)] + [(1000, 1000 + i) for i in range(50)] + [(5, None)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(rows, "a bigint, b bigint").repartition(7)).collect()}
    assert got == {**{i: 10 for i in range(10, 401)}, **{1000 + i: 1000 for i in range(50)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("distance", ["euclidean", "cosine"])
def test_nearest_vectors_in_blocks(spark, monkeypatch, distance):
    monkeypatch.setattr(annotate, "QUERY_BLOCK", 7)
    monkeypatch.setattr(annotate, "BASE_BLOCK", 11)
    vec = {i: [R.randint(-3, 3) + 0.5 for _ in range(4)] for i in range(60)}
    df = spark.createDataFrame([*vec.items(), (100, None), (101, [float("nan")] * 4), (102, [1.0, None, 1.0, 1.0])], "id bigint, vec array<double>")
    got = {(r["query"], r["rank"]): r["neighbour"] for r in annotate.nearest_vectors(df.filter("id % 5 = 0"), df, 3, distance).collect()}

    def far(a, b):
        x, y = np.array(vec[a]), np.array(vec[b])
        if distance == "cosine":
            x, y = x / np.sqrt((x * x).sum()), y / np.sqrt((y * y).sum())
            return round(1 - x @ y, 9)
        return round(float(((x - y) ** 2).sum()), 9)

    assert set(got) == {(q, r) for q in range(0, 60, 5) for r in (1, 2, 3)}
    for q in range(0, 60, 5):
        want = sorted(far(q, b) for b in vec if b != q)[:3]
        assert [far(q, got[q, r]) for r in (1, 2, 3)] == want
