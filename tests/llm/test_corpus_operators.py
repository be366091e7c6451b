"""Operators that work across rows, against brute force on small fixtures, and their odd cases."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orbitloom.llm import mixing, near_duplicates, neighbours, packing, sharding, toxicity
from orbitloom.llm.common import numbered, stored
from orbitloom.llm.components import components

RNG = random.Random(11)


def test_numbers_are_gapless(spark):
    df = stored(spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id"), F.when(F.col("id") % 3 == 0, 5).alias("same")), "numbers")
    rows = numbered(df, F.col("k"), ["same"], "n", 1000).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["k"]].append(r["n"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(rows) == 1000


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 200), (200, 300), (300, 100), (7, 7), (None, 3)] + [(1000, 1000 + k) for k in range(1, 50)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 200: 100, 300: 100} | {1000 + k: 1000 for k in range(50)}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


# ---- near duplicates


def word_sets(rows, width):
    out = {}
    for i, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\x0b", " ").replace("\x0c", " ").split()
        n = min(width, len(w))
        out[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
    return out


def brute_components(rows, width, percent):
    sets = word_sets(rows, width)
    least = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return {i: (len(sets[i]), least[i]) for i in sets}


@pytest.fixture(scope="module")
def near_rows():
    words = [f"w{k}" for k in range(60)]
    rows, common = [], " ".join(RNG.choice(words) for _ in range(30))
    for base in range(8):
        text = [RNG.choice(words) for _ in range(RNG.choice((12, 40, 90, 200)))]
        for _ in range(14):
            t = list(text)
            for _ in range(RNG.choice((0, 0, 1, 1, 2, 4, 9))):
                t[RNG.randrange(len(t))] = RNG.choice(words)
            rows.append(" ".join(t).title() if RNG.random() < 0.3 else " ".join(t) + "\n")
        rows.append(common + " " + " ".join(RNG.choice(words) for _ in range(30)))
    rows += ["", None, " \n ", "one", "One ", "one two", "one two"]
    RNG.shuffle(rows)
    return [(3 * k, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_join_equals_brute_force(spark, near_rows, width, percent):
    got = near_duplicates.jaccard_components(spark.createDataFrame(near_rows, "id long, text string"), width, percent).collect()
    want = brute_components(near_rows, width, percent)
    assert {r["id"]: (r["n"], r["component"]) for r in got} == want and len(got) == len(near_rows)
    assert any(v[1] != k for k, v in want.items())


def test_join_by_shuffle_and_blocks(spark, near_rows, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BROADCAST_IDS", 0)
    monkeypatch.setattr(near_duplicates, "PARTNERS", 3)
    got = near_duplicates.jaccard_components(spark.createDataFrame(near_rows, "id long, text string"), 3, 90).collect()
    assert {r["id"]: (r["n"], r["component"]) for r in got} == brute_components(near_rows, 3, 90)


def test_join_takes_odd_tables(spark):
    schema = "id long, text string, component int, n int"
    assert near_duplicates.jaccard_components(spark.createDataFrame([], schema)).isEmpty()
    rows = [(5, "a b c d", 1, 1), (5, "a b c d", 1, 1), (None, "a b c d", 1, 1), (7, "A  B c\td", 1, 1), (8, None, 1, 1)]
    got = sorted(map(tuple, near_duplicates.jaccard_components(spark.createDataFrame(rows, schema), 3, 90).collect()), key=str)
    assert got == sorted([(5, 2, 5), (5, 2, 5), (None, 2, None), (7, 2, 5), (8, 0, 8)], key=str)


def test_word_hashes_do_not_depend_on_segments(monkeypatch):
    texts = [" ".join("é" * RNG.randint(1, 90) for _ in range(40)), "x" * 1000, " a\x0bb ", "", "y" * 64 + " " + "z" * 63 + " " + "q" * 129, " " * 200 + "w"]
    whole = [near_duplicates.word_hashes(t).tolist() for t in texts]
    monkeypatch.setattr(near_duplicates, "SEGMENT", 64)
    monkeypatch.setattr(near_duplicates, "WHOLE", 50)
    monkeypatch.setattr(near_duplicates, "_POWERS", [])
    assert [near_duplicates.word_hashes(t).tolist() for t in texts] == whole
    assert len(whole[0]) == 40 and len(whole[1]) == 1 and len(whole[4]) == 3
    monkeypatch.undo()
    monkeypatch.setattr(near_duplicates, "_POWERS", [])
    words = ["a" * n for n in (1999, 2000, 2001, 70_000)] + ["ab" * 40_000]
    assert len(set(near_duplicates.word_hashes(" ".join(words)).tolist())) == 5
    assert near_duplicates.word_hashes(" ".join(words)).tolist() == [near_duplicates.word_hashes(w).tolist()[0] for w in words]


def test_structured_words_differ():
    """Words of Thue and Morse and their complements are equal under any polynomial modulo a power of two."""
    for n in (8, 10, 11, 12):
        word = "".join("ab"[bin(k).count("1") % 2] for k in range(1 << n))
        other = word.translate({97: "b", 98: "a"})
        assert len(set(near_duplicates.word_hashes(f"{word} {other}").tolist())) == 2
        assert len(near_duplicates.shingles(f"{word} x y {other} x y", 3)) == 4


def test_rows_that_repeat_an_id_are_one_document(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(3, a), (5, a), (5, b), (7, b + " more"), (9, "c d e f"), (9, "g h i j"), (9, ""), (11, "g h i j"), (13, "g H  i j"), (13, "g H  i j")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = sorted((r["id"], r["component"]) for r in near_duplicates.jaccard_components(df, 3, 90).collect())
    assert got == [(3, 3), (5, 3), (5, 3), (7, 3), (9, 9), (9, 9), (9, 9), (11, 9), (13, 9), (13, 9)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _key string")
    kept = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert kept == sorted([(3, a), (5, b), (9, "c d e f"), (9, "g h i j"), (9, "")])


def test_holders_of_hot_tokens_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "MEETING", 3)
    monkeypatch.setattr(near_duplicates, "HOLDERS", 2)
    words = [f"w{k}" for k in range(14)]
    rows = [(k, " ".join(RNG.sample(words, 12))) for k in range(60)]
    rows += [(100 + k, t + " w1 w2") for k, (_, t) in enumerate(rows[:20])]
    got = near_duplicates.jaccard_components(spark.createDataFrame(rows, "id long, text string"), 1, 80).collect()
    assert {r["id"]: (r["n"], r["component"]) for r in got} == brute_components(rows, 1, 80)


# ---- packing


def brute_windows(counts, size):
    room, windows = [], 0
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            fits = [r for r in room if r >= n]
            if fits:
                room.remove(min(fits))
                room.append(min(fits) - n)
            else:
                windows += 1
                room.append(size - n)
    return windows


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_equals_one_piece_at_a_time(seed):
    rng = random.Random(seed)
    size = rng.choice((8, 64, 2048))
    counts = collections.Counter(rng.randint(1, size if rng.random() < 0.7 else max(1, size // 6)) for _ in range(rng.randint(0, 250)))
    windows, placed = collections.defaultdict(list), collections.Counter()
    for n, rank, number, first, each, at in packing.best_fit_decreasing(counts, size):
        assert rank == placed[n]
        placed[n] += number
        for k in range(number):
            windows[first + k // each].append((at + k % each * n, n))
    assert placed == counts and len(windows) == brute_windows(counts, size) and set(windows) == set(range(len(windows)))
    for w in windows.values():
        assert [a for a, _ in sorted(w)] == np.cumsum([0, *(n for _, n in sorted(w))])[:-1].tolist() and sum(n for _, n in w) <= size


def test_packed_documents(spark):
    import tokenizers

    words = ["Hello", "world,", "Été", "don't", "42"]
    rows = [(k, " ".join(RNG.choice(words) for _ in range(RNG.choice((0, 3, 200, 900, 3000)))), "x", 1) for k in range(40)] + [(40, None, "x", 1), (3, "again", "x", 1), (3, "again", "x", 1), (None, "no id", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rank string, length_ int")
    cut = packing.pieces(df, "text", public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])
    got = packing.pack(cut, ["doc_id", "start", "ids_crc32"]).collect()
    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t, *_ in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(i, a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes()), len(ids)) for a in range(0, len(ids), 2048)]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by) == set(range(len(by)))
    for w in by.values():
        assert [a for a, _ in sorted(w)] == np.cumsum([0, *(n for _, n in sorted(w))])[:-1].tolist() and sum(n for _, n in w) <= 2048
    assert packing.pack(cut.limit(0), ["doc_id", "start", "ids_crc32"]).isEmpty()


# ---- sharding


def shards_of(spark, hubs, shards=4):
    nodes = stored(spark.createDataFrame([(k, "x") for k in range(len(hubs))], "node long, law string"), "nodes")
    links = stored(spark.createDataFrame([(k, h) for k, own in enumerate(hubs) for h in own], "node long, hub long"), "links")
    got = {r["node"]: (r["shard"], r["slot"]) for r in sharding.balanced_shards(nodes, links, shards).collect()}
    by = collections.defaultdict(list)
    for s, slot in got.values():
        by[s].append(slot)
    sizes = [len(by[s]) for s in range(shards)]
    assert len(got) == len(hubs) and sum(sizes) == len(hubs) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    return {k: s for k, (s, _) in got.items()}


def test_groups_stay_together(spark):
    hubs = [[k // 5] for k in range(100)] + [[] for _ in range(103)]
    own = shards_of(spark, hubs)
    assert sum(len({own[5 * g + k] for k in range(5)}) == 1 for g in range(20)) >= 18


@pytest.mark.parametrize("size", [2, 5])
def test_groups_of_a_fully_linked_table_come_together(spark, size):
    n = 40_000
    nodes = stored(spark.range(n).select(F.col("id").alias("node")), "nodes")
    links = stored(nodes.select("node", F.floor(F.col("node") / size).alias("hub")), "links")
    found = sharding.balanced_shards(nodes, links, 4)
    counts = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    whole = found.groupBy(F.floor(F.col("node") / size)).agg(F.countDistinct("shard").alias("n")).filter("n = 1").count()
    assert whole >= 0.85 * n / size


def test_group_larger_than_a_shard_is_split_evenly(spark):
    own = shards_of(spark, [[0]] * 70 + [[] for _ in range(30)])
    assert sorted(collections.Counter(own[k] for k in range(70)).values())[-1] == 25


def test_links_of_several_hubs_and_small_tables(spark):
    shards_of(spark, [[k // 4, 1000 + k % 3] for k in range(60)])
    shards_of(spark, [[0], [0], []], shards=4)
    shards_of(spark, [[] for _ in range(9)])


def test_no_quota_passes_the_cap():
    rng = np.random.default_rng(1)
    for _ in range(30):
        wish = rng.integers(0, 50, (6, 6)) * (1 - np.eye(6, dtype=int))
        size = wish.sum(1) + rng.integers(0, 40, 6)
        cap = max(size.max(), 60)
        allowed = wish * sharding.quotas(wish.astype(float), size.astype(float), cap)
        assert (size + allowed.sum(0) - allowed.sum(1) <= cap + 1e-3).all() and (allowed <= wish + 1e-9).all()


# ---- neighbours


def brute_nearest(rows, k=5):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(float)
    norms, out = np.sqrt((x * x).sum(1)), {}
    for i in np.flatnonzero(ids % 50 == 0):
        score = (x * x[i]).sum(1) / (norms * norms[i])
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


@pytest.mark.parametrize("n", [2, 4, 60, 3000])
def test_search_recall(spark, n):
    rng = np.random.default_rng(n)
    rows = [(k, rng.normal(size=16).tolist()) for k in range(n)]
    got = collections.defaultdict(list)
    for r in neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = brute_nearest(rows)
    assert set(got) == set(want) and all([r for r, *_ in v] == list(range(1, min(5, n - 1) + 1)) for v in got.values())
    hits = sum(len({i for _, i, _ in got[q]} & {i for i, _ in v}) for q, v in want.items()) / sum(map(len, want.values()))
    assert hits >= (1 if n <= 60 else 0.9)
    exact = {(q, i): s for q, v in want.items() for i, s in v}
    assert all(exact.get((q, i), s) == s for q, v in got.items() for _, i, s in v)


def test_equal_vectors_tie_by_id_and_hot_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 2)
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(300)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect()
    by = {(r["query_id"], r["rank"]): r["vec_id"] for r in got}
    assert all(by[q, k + 1] == [i for i in range(6) if i != q][k] for q in range(0, 300, 50) for k in range(5))


def probed_recall(spark, df, k=5, every=50, sample=200):
    """Recall of the probes alone, the queries for which they found too few, and the share of the table that a query visits."""
    vectors = stored(neighbours.usable(df), "vectors")
    asked = stored(vectors.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding"), "asked")
    n = vectors.count()
    hashes = neighbours.fitted(vectors, asked, n, k)
    found = stored(neighbours.probed(vectors, asked, hashes, n, k), "found")
    got = collections.defaultdict(set)
    for r in neighbours.ranked(found, k).collect():
        got[r["query_id"]].add(r["vec_id"])
    rows = vectors.toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_numpy()).astype(float)
    unit, hits, seen = x / np.sqrt((x * x).sum(1))[:, None], 0, 0.0
    chosen = np.random.default_rng(9).permutation(np.flatnonzero(ids % every == 0))[:sample]
    own = [hashes.buckets(unit, t) for t in range(neighbours.TABLES)]
    for i in chosen:
        score = unit @ unit[i]
        score[i] = -2
        hits += len(got[ids[i]] & set(ids[np.argsort(-score)[:k]].tolist()))
        seen += (np.min([hashes.costs(unit[i][None], own[t], t) for t in range(neighbours.TABLES)], axis=0) <= hashes.most).mean()
    return hits / (k * len(chosen)), neighbours.short_of(asked, found, k).count(), seen / len(chosen)


def vector_table(spark, x):
    return spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x))}))


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_probes_answer_the_given_tables_alone(spark, folder):
    recall, short, _ = probed_recall(spark, spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet"))
    assert recall >= 0.9 and short == 0


def test_vectors_of_extreme_size_are_compared(spark):
    rng = np.random.default_rng(4)
    plain = rng.normal(size=(120, 8))
    sizes = np.array([1.0, 1e200, 1e-200, 1e300, 1e-300, 5e-310])[np.arange(120) % 6]
    search = lambda x, kind: [tuple(r) for r in neighbours.search(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], f"vec_id long, embedding array<{kind}>"), F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect()]
    want, got = search(plain, "double"), search(plain * sizes[:, None], "double")
    assert [r[:3] for r in got] == [r[:3] for r in want] and len(got) == 60
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-9)
    small = search(np.where(np.arange(120)[:, None] % 2, plain * 1e-38, plain * 1e37), "float")
    assert all(np.isfinite(r[3]) for r in small) and len(small) == 60


def test_probes_reach_recall_without_structure_too(spark):
    recall, short, seen = probed_recall(spark, vector_table(spark, np.random.default_rng(5).normal(size=(100_000, 64))), every=500)
    assert recall >= 0.9 and short == 0 and seen < 0.4


def test_probes_visit_little_of_a_table_with_structure(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(200, 32))
    recall, short, seen = probed_recall(spark, vector_table(spark, centres[np.arange(20_000) % 200] + 0.1 * rng.normal(size=(20_000, 32))))
    assert recall >= 0.9 and short == 0 and seen < 0.05


def test_few_vectors_are_all_found(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "fitted", lambda *a: neighbours.Hashes.drawn(2, 24))  # it visits the home bucket only
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [r["vec_id"] for r in neighbours.search(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [2, 1]


def test_doubles_keep_their_precision(spark):
    rows = [(k, [1.0, 1e-9 * k]) for k in range(8)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).orderBy("rank").collect()
    x = np.array([v for _, v in rows])
    assert all(r["score"] == (x[r["vec_id"]] * x[0]).sum() / (np.sqrt((x[r["vec_id"]] ** 2).sum()) * np.sqrt((x[0] ** 2).sum())) for r in got)


def test_vectors_that_cannot_be_compared(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (None, [1.0, 1.0]), (50, [0.0, 0.0]), (8, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    assert [(r["query_id"], r["vec_id"]) for r in neighbours.search(df, F.col("vec_id") % 50 == 0).collect()] == [(0, 1)]
    assert neighbours.search(df.limit(0), F.col("vec_id") % 50 == 0).isEmpty()


def test_probes_come_by_falling_success():
    h = neighbours.Hashes.drawn(8, 4)
    h.near, h.most = 3, 5.0
    u = np.random.default_rng(3).normal(size=8)
    u /= np.linalg.norm(u)
    place, want = h.places(u[None], 0)[0], {}
    home = np.floor(place).astype(int)
    for step in np.ndindex(7, 7, 7):
        at = home[:3] + np.array(step) - 3
        cost = sum(max(0.0, a - p, p - a - 1) ** 2 for a, p in zip(at, place[:3])) * neighbours.WIDTH**2
        if cost <= h.most:
            want[int((at * h.odd[0, :3]).sum())] = cost
    names, costs = h.probes(u, 0)
    assert names[0] == h.hoods(h.buckets(u[None], 0), 0)[0] and costs[0] == 0
    assert set(names.tolist()) == set(want) and len(names) == len(want) > 3
    assert all(want[n] == pytest.approx(c) for n, c in zip(names.tolist(), costs)) and (np.diff(costs) >= 0).all()
    buckets = h.buckets(np.random.default_rng(4).normal(size=(50, 8)) / 3, 0)
    got = h.costs(u[None], buckets, 0)[0]
    assert got == pytest.approx([sum(max(0.0, a - p, p - a - 1) ** 2 for a, p in zip(b.tolist(), place)) * neighbours.WIDTH**2 for b in buckets], rel=1e-5, abs=1e-6)


# ---- toxicity


def test_classifier_on_held_out_rows(spark):
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    rows, labels = [], []
    for k in range(900):
        bad = k % 6 == 0
        t = [RNG.choice(words) for _ in range(RNG.randint(5, 60))]
        if bad:
            t.insert(RNG.randrange(len(t)), RNG.choice(("zworx", "zworxing", "Quibblet")))
        rows.append((k, " ".join(t), "x"))
        labels.append((k, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    held = [k for k in range(900) if zlib.crc32(str(k).encode()) % 3 == 1]
    got = [(model.score(rows[k][1]) >= 0.7, labels[k][2] == 1) for k in held]
    assert sum(a and b for a, b in got) >= 0.9 * sum(b for _, b in got) and sum(a and not b for a, b in got) <= 0.01 * len(got)
    assert 0 <= model.score("") < 0.5
    found = toxicity.scored(docs.limit(0), "text", model, "_score")
    assert found.isEmpty() and found.columns == ["doc_id", "text", "score", "_score"]


def test_labels_of_the_held_out_part_are_never_read(spark):
    docs = spark.createDataFrame([(k, "zworx" if k % 2 else "fine words") for k in range(60)], "doc_id long, text string")
    held = [(k, 1, 1) for k in range(60) if zlib.crc32(str(k).encode()) % 3 == 1]
    model = toxicity.fit(docs, spark.createDataFrame(held, "doc_id long, quality int, toxic int"))
    assert model.score("zworx") == model.score("") == pytest.approx(0.5)
    one = toxicity.fit(docs, spark.createDataFrame([(0, 1, 0), (2, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int"))
    assert one.score("zworx") < 0.01


# ---- mixing


def test_raked_marginals_are_met():
    rng = np.random.default_rng(4)
    mass = rng.random((4, 3, 2)) * 100
    targets = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.25, 0.25]), np.array([0.9, 0.1])]
    got = mass * mixing.rake(mass, targets)
    for axis, t in enumerate(targets):
        assert got.sum(tuple(k for k in range(3) if k != axis)) / got.sum() == pytest.approx(t, abs=1e-6)
    p = mixing.probabilities(mass, mixing.rake(mass, targets), 0.6)
    assert (mass * p).sum() == pytest.approx(0.6 * mass.sum()) and p.max() <= 1
    assert mixing.probabilities(np.zeros((2, 1, 1)), np.ones((2, 1, 1)), 0.5).tolist() == [[[1.0]], [[1.0]]]


def test_mixing_takes_odd_rows(spark):
    rows = [(k, "some plain words here " * (k % 5), "ab"[k % 2], ("en", None)[k % 2], "clash") for k in range(400)] + [(7, None, None, None, None), (None, "x", "a", "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, tokens string")
    got = mixing.mixed(df, "text", ["doc_id", "source", "lang", "tokens"], prefix="_").collect()
    assert len(got) == 402 and {r["_topic"] == "empty" for r in got if not r["_tokens"]} == {True}
    expected = sum(r["_tokens"] * r["_probability"] for r in got) / sum(r["_tokens"] for r in got)
    assert expected == pytest.approx(0.7) and 0.55 < sum(r["_tokens"] for r in got if r["_kept"]) / sum(r["_tokens"] for r in got) < 0.85
    assert mixing.mixed(df.limit(0), "text", ["doc_id", "source", "lang"]).isEmpty()


def test_all_categories_are_raked(spark, monkeypatch):
    rows = [(k, "plain words " * (1 + k % 7), f"s{k % 700 if k < 1400 else k % 9}", "en") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    last = {f"s{k}": 1.0 for k in range(690, 700)}
    for targets in (None, {"source": last, "lang": 0.7, "topic": 0.7}):
        found = []
        for cells in (100_000, 10):
            monkeypatch.setattr(mixing, "CELLS", cells)
            found.append({r["doc_id"]: (r["tokens"], r["source"], r["weight"], r["probability"]) for r in mixing.mixed(df, "text", ["doc_id", "source", "lang"], targets, 0.002 if targets else 0.7).collect()})
        assert set(found[0]) == set(found[1]) == set(range(3000))
        for k, x in found[0].items():
            assert x[:2] == found[1][k][:2] and x[2:] == pytest.approx(found[1][k][2:], rel=1e-6)
        mass, got = collections.Counter(), collections.Counter()
        for tokens, source, weight, _ in found[0].values():
            mass[source] += tokens
            got[source] += tokens * weight
        total = sum(mass.values())
        want = {s: last.get(s, 0.0) if targets else (m / total) ** 0.5 for s, m in mass.items()}
        assert all(got[s] / total == pytest.approx(want[s] / sum(want.values()), rel=1e-3, abs=1e-9) for s in mass)


def words_in(text):
    return "".join(" " if c in "\t\n\x0b\x0c\r" else c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ")


def brute_profile(text):
    words, bins = [w.encode() for w in words_in(text) if w], [0] * mixing.BINS
    for w in words:
        h = sum(int(mixing._LETTERS[c]) * pow(mixing._BASE, i, 1 << 64) for i, c in enumerate(w)) % (1 << 64)
        bins[(h ^ h >> 29) * 0xBF58476D1CE4E5B9 % (1 << 64) >> 56] += 1
    return len(words), bins


def test_profiles_equal_word_by_word():
    for t in ["", " ", "a", "A\x0bb\x0c  Été's longest-word-of-all\n", "x " * 700, "\x1cq\u2003r s", "".join(RNG.choice("aB \né") for _ in range(500)), "internetabcde internxyzwvut " * 40]:
        n, bins = mixing.profile(t)
        assert (n, np.frombuffer(bins, "<u4").tolist()) == brute_profile(t)
    assert len(set(np.flatnonzero(np.frombuffer(mixing.profile(" ".join(f"beginning{k:04d}" for k in range(2000)))[1], "<u4")))) > 200


def test_long_texts_of_different_words_have_different_topics(spark):
    rng = np.random.default_rng(3)
    themes = [[f"beginning{c}{k:03d}" for k in range(60)] for c in "ab"]
    rows = [(k, " ".join(rng.choice(themes[k % 2], 120_000 if k < 4 else 200)), "s", "en") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    topic = {r["doc_id"]: r["topic"] for r in mixing.mixed(df, "text", ["doc_id", "source", "lang"]).collect()}
    by = [{topic[k] for k in range(60) if k % 2 == half} for half in (0, 1)]
    assert not by[0] & by[1] and "empty" not in by[0] | by[1]


def test_probabilities_equal_brute_force_row_by_row(spark):
    themes = [[f"{c}{k}{c}" for k in range(40)] for c in ("moon", "fish", "iron")]
    rows = [(k, " ".join(RNG.choice(themes[k % 3]) for _ in range(RNG.randint(5, 60))), f"s{k % 5}" if k % 7 else None, ("en", "de")[k % 2]) for k in range(900)]
    rows += [(2000 + k, None, "s1", "en") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = {"source": {"s0": 0.5, "s1": 0.2, None: 0.3}, "lang": 0.7, "topic": 0.3}
    got = {r["doc_id"]: r for r in mixing.mixed(df, "text", ["doc_id", "source", "lang"], targets, 0.2).collect()}
    # topics tell the themes apart
    by = collections.defaultdict(set)
    for i, _, _, _ in rows[:900]:
        by[got[i]["topic"]].add(i % 3)
    assert all(len(v) == 1 for v in by.values()) and got[2000]["topic"] == "empty"
    # rake the rows themselves, by dictionaries
    tokens = {i: len([w for w in words_in(t) if w]) for i, t, _, _ in rows}
    assert all(got[i]["tokens"] == n for i, n in tokens.items())
    total, weight, wanted = sum(tokens.values()), dict.fromkeys(tokens, 1.0), {}
    for d in ("source", "lang", "topic"):
        mass = collections.Counter()
        for i, r in got.items():
            mass[r[d]] += tokens[i]
        share = targets[d] if isinstance(targets[d], dict) else {c: (x / total) ** targets[d] for c, x in mass.items() if x}
        share = {c: share.get(c, 0.0) for c in mass if mass[c]}
        wanted[d] = {c: x / sum(share.values()) for c, x in share.items()}
    for _ in range(300):
        for d, share in wanted.items():
            now = collections.Counter()
            for i, r in got.items():
                now[r[d]] += tokens[i] * weight[i]
            for i, r in got.items():
                if tokens[i]:
                    weight[i] *= share[r[d]] * total / now[r[d]] if now[r[d]] else 0.0
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(tokens[i] * min(1, mid * weight[i]) for i in tokens) < 0.2 * total else (low, mid)
    for i, r in got.items():
        if tokens[i]:
            assert r["weight"] == pytest.approx(weight[i], rel=1e-6, abs=1e-9) and r["probability"] == pytest.approx(min(1, low * weight[i]), rel=1e-6, abs=1e-9)
        else:
            assert r["probability"] == 1


def test_names_with_underscores_pass_through(spark):
    df = spark.createDataFrame([(k, "some words", "a", "en", "x", 1.5, "(null)") for k in range(20)], "doc_id long, text string, source string, lang string, _source string, _weight double, __topic string")
    got = mixing.mixed(df, "text", df.columns, prefix="___").collect()
    assert all(r["_source"] == "x" and r["_weight"] == 1.5 and r["__topic"] == "(null)" and 0 <= r["___probability"] <= 1 for r in got) and len(got) == 20
