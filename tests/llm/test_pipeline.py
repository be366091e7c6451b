"""The corpus pipeline stage by stage on a small fixture."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orbitloom.llm import queries

RNG = random.Random(3)
WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels = [], []
    for k in range(600):
        t = [RNG.choice(WORDS) for _ in range(RNG.randint(30, 80))]
        if k % 6 == 0:
            t.insert(3, "zworxing")
        if k == 101:
            t.insert(4, "a@b.example.com")
        rows.append((k, " ".join(t), "en", f"src{k % 3}", len(" ".join(t)), "x", 1.5))
        labels.append((k, 1, int(k % 6 == 0)))
    near = rows[7][1].split()
    near[-1] = "changed"
    rows += [(1000, rows[7][1], "en", "src1", 5, "x", 0.0), (1001, " ".join(near), None, None, None, "x", 0.0), (1002, None, "en", "src1", None, None, None), (1003, "", "en", "src1", 0, None, None), (8, *rows[8][1:])]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component string, score double").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns
        seen[name] = {(r["doc_id"], r["text"]) for r in docs.collect()}
        seen[name, "n"] = docs.count()
    kept = {i for i, _ in seen["toxicity"]}
    assert not any("zworx" in (t or "") for _, t in seen["toxicity"]) and len(kept) == 500 + 4
    assert kept - {i for i, _ in seen["near_duplicates"]} == {1000, 1001} and {1002, 1003} <= {i for i, _ in seen["near_duplicates"]}
    assert seen["near_duplicates", "n"] == len(kept) - 2  # the repeated row stays once
    changed = seen["personal_data"] - seen["near_duplicates"]
    assert [(i, "[EMAIL]" in t) for i, t in changed] == [(101, True)] and seen["personal_data", "n"] == seen["near_duplicates", "n"]
    assert docs.filter("n_chars <> char_length(text)").isEmpty()
    assert seen["mixing"] <= seen["personal_data"] and len(seen["mixing"]) > 0.75 * len(seen["personal_data"])
    packed = corpus_pipeline.STAGES[4][1](spark, docs, folder)
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert whole.filter("n <> m").isEmpty() and whole.count() == docs.count()


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 300
    for t in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    for name, f in queries.QUERIES.items():
        assert f(spark, str(tmp_path)).count() == 0, name


def test_registered_queries_count_every_row(spark, folder):
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    for name in ("op1_transport_stream", "op2_sharding", "op3_jaccard_join", "op6_toxicity", "op7_mixing", "op8_personal_data", "op9_token_counts", "op10_license_scan"):
        assert queries.QUERIES[name](spark, folder).count() == n, name


def test_near_duplicates_are_those_of_brute_force(spark):
    """Five words and a similarity of 0.8, against all pairs of texts: one row of each group stays, that of the smallest id."""
    rng = random.Random(17)
    texts = []
    for _ in range(40):
        base = [rng.choice(WORDS) for _ in range(rng.choice([3, 8, 40, 90]))]
        texts.append(base)
        for _ in range(rng.randint(0, 3)):
            near = list(rng.choice(texts[-3:]))
            for _ in range(rng.randint(0, 3)):
                near[rng.randrange(len(near))] = rng.choice(WORDS)
            texts.append(near)
    rows = [(k, " ".join(t), "en", "s", 0) for k, t in enumerate(texts)] + [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, " ", "en", "s", 0)]
    rng.shuffle(rows)

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    sets = {k: shingles(t) for k, t, *_ in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = 0
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
                links += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert kept == sorted(k for k in sets if find(k) == k) and links > 15 and len(kept) < len(rows) - 10


def test_documents_need_no_count_of_characters(spark):
    docs = spark.createDataFrame([(1, "write a.b@c-d.example.com now", "en", "s")], "doc_id long, text string, lang string, source string")
    assert [tuple(r) for r in corpus_pipeline.personal_data(spark, docs, "").collect()] == [(1, "write [EMAIL] now", "en", "s")]
