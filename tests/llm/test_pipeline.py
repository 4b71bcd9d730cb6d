"""The pipeline on a small corpus with planted cases, stage by stage."""

import random

import corpus_pipeline as p
from genoloom.llm import queries

R = random.Random(31)
WORDS = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrs"] * 3


def corpus(spark, tmp_path):
    say = lambda n: " ".join(R.choice(WORDS) + str(R.randrange(40)) for _ in range(n))
    items = [(i, say(25)) for i in range(5)]
    rows = [(i, say(R.randint(40, 120)), "en", f"s{i % 4}", 0) for i in range(120)]
    rows += [(200, " ".join(["BUY!!"] * 60), "en", "s0", 0), (201, "SALE!! WIN!! " * 30, "en", "s1", 0)]
    rows += [(210 + i, rows[i][1] + " tail", "en", "s2", 0) for i in range(5)]
    rows += [(220 + i, say(30) + " " + items[i][1] + " " + say(30), "en", "s3", 0) for i in range(5)]
    rows += [(300, None, "en", None, None), (301, "", None, "s0", 0)]
    labels = [(i, 1, 0) for i in range(110)] + [(400 + i, 0, 0) for i in range(40)]
    rows += [(400 + i, " ".join(R.choice(["BUY!!", "SALE!!", "WIN!!"]) for _ in range(60)), "en", "s0", 0) for i in range(40)]
    d = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, tmp_path):
    d = corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in p.STAGES:
        docs = stage(spark, docs, d)
        docs.write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        ids[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert name == "mix" or docs.columns == columns
    clean = set(range(5, 120))
    assert [n for n, _ in p.STAGES] == ["quality", "lines", "near_copies", "benchmark", "mix"]
    assert not ids["quality"] & ({200, 201} | set(range(400, 440))) and clean <= ids["quality"]
    assert clean <= ids["lines"] and {300, 301} <= ids["lines"]
    assert not ids["near_copies"] & set(range(210, 215)) and clean <= ids["near_copies"]
    assert not ids["benchmark"] & set(range(220, 225)) and clean <= ids["benchmark"]
    assert docs.filter("copies < 1 OR copies > 2").count() == 0
    assert {r["doc_id"] for r in p.run(spark, d).select("doc_id").collect()} == ids["mix"]


def test_all_are_registered():
    names = queries.queries()
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14))


def test_near_copies_of_rows_with_a_map(spark, tmp_path):
    t = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(5, t, {"a": 2}, 9), (5, t, {"a": 1}, 4), (5, t, None, 7), (6, t, {}, 1), (7, "other", {}, 1)], "doc_id bigint, text string, m map<string,int>, k int")
    assert sorted((r["doc_id"], r["k"]) for r in p.near_copies(spark, docs, str(tmp_path)).collect()) == [(5, 4), (7, 1)]


def test_rows_that_share_an_id_null_ids_repeats_and_clashing_columns(spark, tmp_path):
    d = corpus(spark, tmp_path)
    say = lambda n: " ".join(R.choice(WORDS) + str(R.randrange(40)) for _ in range(n))
    a, b, c, e = say(60), say(60), say(60), say(60)
    item = spark.read.parquet(f"{d}/benchmark.parquet").filter("item_id = 2").first()["text"]
    odd = [(700, a), (700, b), (700, b), (701, a), (None, c), (None, e), (702, c), (703, item + " " + say(8)), (703, say(30)), (704, "")]
    odd = [(i, t, "en", "s1", 0, 9, 8, "x", k) for k, (i, t) in enumerate(odd)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, row int, key string, number int"
    docs = spark.createDataFrame(odd, schema)
    texts = lambda df: sorted((str(r["doc_id"]), r["text"]) for r in df.collect())
    kept = p.near_copies(spark, docs, d)
    assert kept.columns == docs.columns
    assert texts(kept) == sorted([("700", a), ("700", b), ("702", c), ("None", e), ("703", odd[7][1]), ("703", odd[8][1]), ("704", "")])
    assert [r["number"] for r in kept.filter("text = '%s'" % b).collect()] == [1]
    kept = p.benchmark(spark, docs, d)
    assert texts(kept) == sorted((str(r[0]), r[1]) for r in odd if r[8] != 7) and kept.columns == docs.columns
    for stage in (p.quality, p.lines):
        assert stage(spark, docs, d).columns == docs.columns
    bad = spark.createDataFrame([(600, "BUY!! WIN!! " * 30, "en", "s", 0), (600, say(60), "en", "s", 0), (None, "BUY!! SALE!! " * 30, "en", "s", 0)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    bad = bad.unionByName(spark.read.parquet(f"{d}/documents.parquet").filter("doc_id < 120 OR doc_id >= 400"))
    assert [t[:3] != "BUY" for i, t in texts(p.quality(spark, bad, d)) if i in ("600", "None")].count(False) == 0
    mixed = p.mix(spark, docs, d).collect()
    assert len({r["text"] for r in mixed}) == len({r[1] for r in odd if r[1]}) and all(r["copies"] in (1, 2) and r["size"] > 0 for r in mixed)
    assert sum(r["taken"] for r in mixed) == sum(len(r["text"].split()) * r["copies"] for r in mixed)


def test_empty_tables(spark, tmp_path):
    d = corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    e = str(tmp_path / "none")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{d}/{name}.parquet").limit(0).write.parquet(f"{e}/{name}.parquet")
    assert p.quality(spark, docs, e).count() == docs.count() == p.benchmark(spark, docs, e).count()
    nothing = docs.limit(0)
    for _, stage in p.STAGES:
        nothing = stage(spark, nothing, e)
        assert nothing.count() == 0
