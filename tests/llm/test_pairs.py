"""Operators on pairs of documents, lines and vectors against brute force."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoloom.llm import embedding, jaccard, lines
from genoloom.operators import components as graph

R = random.Random(11)


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_documents():
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(25):
        base = [R.choice(words) for _ in range(R.choice([1, 3, 5, 8, 12, 20, 40, 80, 160]))]
        for _ in range(R.randint(1, 7)):
            t = list(base)
            for _ in range(R.choice([0, 0, 1, 1, 2, 3])):
                t[R.randrange(len(t))] = R.choice(words)
            rows.append((n, " ".join(t)))
            n += 1
    hot = [R.choice(words) for _ in range(90)]
    for _ in range(40):  # one large group of near copies, and one of copies
        t = list(hot)
        t[R.randrange(90)] = R.choice(words)
        rows.append((n, " ".join(t)))
        n += 1
    rows += [(n + i, " ".join(hot)) for i in range(20)]
    return rows + [(9000, None), (9001, ""), (9002, " \n\t"), (9003, "Lone"), (9004, "lONE"), (9005, "É x"), (9006, "é x")]


@pytest.mark.parametrize(("words", "percent", "cap", "block"), [(4, 85, 12, 512), (4, 85, 2, 3), (5, 80, 12, 512), (5, 80, 3, 4)])
def test_jaccard_join(spark, words, percent, cap, block):
    rows = near_documents()
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = components(ids, links)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("cls", F.lit("x")).withColumn("n", F.lit(1))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs, words, percent, cap, block).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in ids}


def test_jaccard_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert jaccard.jaccard_components(empty, 4, 85).count() == 0
    twice = spark.createDataFrame([(5, "a b c d e")] * 2 + [(3, "a b c d e")], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in jaccard.jaccard_components(twice, 4, 85).collect()) == [(3, 2, 3), (5, 2, 3), (5, 2, 3)]


def test_every_band_keeps_a_surplus():
    rule = jaccard.Rule(4, 85)
    kinds = set()
    for band in range(45):
        whole, deep, surplus = rule.plan(band)
        hi = int(rule.top(band))
        differ = (hi + hi * 100 // 85) * 15 // 185
        assert rule.survive(whole, deep, differ) > surplus
        kinds |= {k for k, v in (("whole", whole), ("deep", deep)) if v}
    assert kinds == {"whole", "deep"}


def test_components_of_long_paths(spark):
    ids = list(range(200))
    R.shuffle(ids)
    edges = list(zip(ids, ids[1:], strict=False))[:150]
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(8)
    got = {r["id"]: r["component"] for r in graph.components(df).collect()}
    want = components({x for e in edges for x in e}, edges)
    assert got == want
    assert graph.components(df.limit(0)).count() == 0


def brute_lines(rows, k, short):
    first = {}
    for d, t in sorted(r for r in rows if r[1] is not None):
        for n, x in enumerate(t.encode().split(b"\n")):
            if len(x) >= short:
                first.setdefault(x, (d, n))
    order, late = sorted(first, key=first.get), set()
    for i, x in enumerate(order):
        if any(lines.within(x, y, k) for y in order[:i]):
            late.add(x)
    out = {}
    for d, t in rows:
        parts = [] if t is None else t.encode().split(b"\n")
        keep = [x for n, x in enumerate(parts) if len(x) < short or (x not in late and first[x] == (d, n))]
        out[d] = (len(parts), len(parts) - len(keep), None if t is None else b"\n".join(keep).decode())
    return out


def test_edit_distance():
    def plain(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            q = [i]
            for j, y in enumerate(b, 1):
                q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
            p = q
        return p[-1]

    for _ in range(1500):
        a = bytes(R.choice(b"ab") for _ in range(R.randint(0, 9)))
        b = bytes(R.choice(b"ab") for _ in range(R.randint(0, 9)))
        for k in range(4):
            assert lines.within(a, b, k) == (plain(a, b) <= k)


@pytest.mark.parametrize(("cap", "block"), [(16, 256), (2, 3)])
def test_line_dedup(spark, cap, block):
    base = ["".join(R.choice("abcdef é") for _ in range(R.randint(31, 60))) for _ in range(25)]
    rows = []
    for d in range(90):
        own = []
        for _ in range(R.randint(0, 5)):
            x = list(R.choice(base))
            for _ in range(R.choice([0, 0, 1, 2, 3])):
                x[R.randrange(len(x))] = R.choice("abcxyz")
            own.append("".join(x))
        rows.append((d, "\n".join([*own, *["short"] * R.randint(0, 2)])))
    rows += [(200, None), (201, ""), (202, "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("no", F.lit(7)).withColumn("gone", F.lit("x"))
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in lines.dedup_lines(docs, cap=cap, block=block).collect()}
    assert got == brute_lines(rows, lines.DISTANCE, lines.SHORT)


def test_line_dedup_empty_table(spark):
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    rows, n = [], 0
    for b in rng.normal(size=(100, 64)):
        for _ in range(rng.integers(1, 8)):
            rows.append((n, (b + rng.normal(size=64) * rng.choice([0.05, 0.1, 0.14, 0.2])).astype(np.float32).tolist(), int(rng.integers(0, 2))))
            n += 1
    rows += [(n + i, rows[0][1], rows[0][2]) for i in range(30)]
    fine = {r[0]: (np.array(r[1], float), r[2]) for r in rows}
    odd = [(9000, None, 1), (9001, [0.0] * 64, 1), (9002, [float("nan")] + [1.0] * 63, 1), (9003, [1.0, 2.0], 1), (9004, [1.0, 2.0], 1), (9005, rows[0][1], None), (9006, [], 0), (9007, [None] * 64, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, label int").withColumn("cls", F.lit(1))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding.near_vectors(df, block=16).collect()}
    links = [(a, b) for a in fine for b in fine if a < b and fine[a][1] == fine[b][1] and fine[a][0] @ fine[b][0] >= 0.98 * np.linalg.norm(fine[a][0]) * np.linalg.norm(fine[b][0])]
    count = collections.Counter(x for e in links for x in e)
    assert all(got[i][0] <= count[i] for i in fine)
    assert sum(got[i][0] for i in fine) >= 0.99 * 2 * len(links)
    assert {i: got[i][0] for i, *_ in odd} == {9003: 1, 9004: 1} | {i: 0 for i in (9000, 9001, 9002, 9005, 9006, 9007)}
    assert got[9004][1:] == (9003, False) and got[9005][1:] == (9005, True)


def test_near_vectors_empty_table(spark):
    assert embedding.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0



def test_very_long_lines_and_sets():
    a = b"xxx" + bytes(range(97, 123)) * 4000
    b = bytearray(a)
    b[5], b[-5] = 1, 2
    assert lines.within(a, bytes(b), 2) and not lines.within(a, bytes(b), 1)
    rule = jaccard.Rule(4, 85)
    whole, deep, surplus = rule.plan(int(rule.band(3_000_000)))
    assert whole + deep > surplus


def test_line_dedup_of_ids_with_two_texts_and_null_ids(spark):
    a, x, y = "alpha " * 8, "unique line of the first kind, long enough", "another line that nothing else is like at all"
    rows = [(1, f"{a}\nx"), (5, f"y\n{a}"), (5, f"z\n{x}"), (5, f"z\n{x}"), (None, f"{a}\n{y}"), (7, "\n".join([y] * 3)), (8, "b" * 200_000), (9, "b" * 200_000 + "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("row", F.lit(1)).withColumn("id", F.lit("i"))
    got = sorted((str(r["doc_id"]), r["text"][:60], r["n_lines"], r["n_removed"]) for r in lines.dedup_lines(docs).collect())
    want = [("1", f"{a}\nx", 2, 0), ("5", "y", 2, 1), ("5", f"z\n{x}", 2, 0), ("5", f"z\n{x}", 2, 0), ("None", f"{a}\n{y}", 2, 0), ("7", y, 3, 2), ("8", "b" * 60, 1, 0), ("9", "", 1, 1)]
    assert got == sorted((i, t[:60], n, m) for i, t, n, m in want)


@pytest.mark.parametrize("size", [3, 17])
def test_capped_groups(size):
    import pyarrow as pa

    from genoloom.llm.common import capped_groups

    rows = sorted((k, m) for k in range(40) for m in range(R.choice([1, 2, 4, 5, 30])) for _ in range(R.choice([1, 1, 3])))
    given = pa.table({"k": [r[0] for r in rows], "m": [r[1] for r in rows]}).to_batches(max_chunksize=size)
    out = [(k, m, bool(h)) for t, hot in capped_groups(iter(given), "k", "m", 4, 10) for k, m, h in zip(t["k"].to_pylist(), t["m"].to_pylist(), hot, strict=True)]
    n = collections.Counter(k for k, _ in set(rows))
    assert out == [(k, m, n[k] > 4) for k, m in sorted(set(rows))]


def test_everything_without_broadcasts(spark, monkeypatch):
    from genoloom.llm import common

    base = ["".join(R.choice("abcdef é") for _ in range(40)) for _ in range(9)]
    rows = [(d, "\n".join(R.choice(base)[: R.choice([39, 40])] for _ in range(R.randint(1, 6)))) for d in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(tuple(r) for r in lines.dedup_lines(docs, cap=3, block=4).collect())
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    for heavy in (10_000, 5):
        monkeypatch.setattr(common, "HEAVY", heavy)
        assert sorted(tuple(r) for r in lines.dedup_lines(docs, cap=3, block=4).collect()) == want
