"""Source divergence against plain Python, and the registered query against DuckDB at a second size."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest

from orbitloom.llm import divergence, queries
from orbitloom.llm.divergence import OP11_SQL, source_divergence

TERM = re.compile(b"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def cut(text):
    return TERM.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def brute(rows, least=10, top=10):
    docs = [(lang or "", source or "", cut(text)) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= least)
        counts = {s: collections.Counter() for s in {d[1] for d in own}}
        for _, s, words in own:
            counts[s].update(t for t in words if df[t] >= least)
        share = lambda c, n: 1 + 10**9 * (c + 2) // (n + 2 * len(kept))
        p = {s: {t: share(c[t], sum(c.values())) for t in kept} for s, c in counts.items()}
        whole = sum(counts.values(), collections.Counter())
        q = {t: share(whole[t], sum(whole.values())) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s)
            term = sorted((-f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, item.decode(), -v, k) for part, some in (("pair", pair), ("term", term)) for k, (v, item) in enumerate(some, 1)]
    return sorted(out)


def made(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


ODD = [
    ("en", "a", None), ("en", None, ""), (None, None, "null langs"), (None, "z", "only here"), ("xx", "lonely", "one two"), ("xx", "empty", None), ("en", "a", "hot " * 20_000), ("en", "b", "Été ÉTÉ été日本\x00x"), ("en", "a", "AbC abc ABC"), ("en", "*", "a*b"), ("", "q", "blank"),
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    found = [(rng.choice(["en", "de"]), rng.choice(["a", "a", "a", "b", "c", "dé", None]), " ".join(rng.choice(words[: rng.choice([20, 300])]) for _ in range(rng.randint(0, 60)))) for _ in range(300)]
    return found + ODD + [found[0]] * 5


@pytest.mark.parametrize("levels", [(3, 6), (1,), (1, 2, 3, 4, 5, 6, 7), ()])
def test_all_rows_are_those_of_plain_python(spark, rows, levels):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, count int").repartition(5)
    assert made(source_divergence(df, levels=levels)) == brute(rows)


def test_small_filters_blocks_and_batches_change_nothing(spark, rows, monkeypatch):
    many = [(lang, f"{source}{k % 5}", text) for k, (lang, source, text) in enumerate(rows)]
    for name, value in (("FILTER_BITS", 64), ("TEXT_BYTES", 300), ("ROWS", 7), ("SOURCES", 3), ("TERMS", 4), ("BLOCKS", 1)):
        monkeypatch.setattr(divergence, name, value)
    df = spark.createDataFrame(many, "lang string, source string, text string").repartition(3)
    assert made(source_divergence(df, least=4, top=3)) == brute(many, 4, 3)


def test_an_empty_table_gives_no_row_and_too_many_groups_are_an_error(spark, rows):
    assert source_divergence(spark.createDataFrame([], "lang string, source string, text string")).count() == 0
    with pytest.raises(ValueError, match="more than 2 groups"):
        source_divergence(spark.createDataFrame(rows, "lang string, source string, text string"), most_groups=2)


def test_shares_stay_exact_at_any_size(spark):
    from pyspark.sql import functions as F

    cases = [(0, 0, 0), (5, 10**15, 10**9), (10**15, 10**15, 3), (7, 9, 2), (10**17, 3 * 10**17, 10**10)]
    df = spark.createDataFrame(cases, "c long, n long, v long").select("c", "n", "v", divergence.shares(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    assert all(r["p"] == 1 + 10**9 * (r["c"] + 2) // max(1, r["n"] + 2 * r["v"]) for r in df.collect())
    p = np.array([1, 10**9 + 1, 5], np.int64)
    assert divergence.divergence(p, p[::-1].copy()).tolist() == [(a - b) ** 2 // (a + b) for a, b in zip(p.tolist(), p[::-1].tolist())]


def test_the_query_gives_what_duckdb_gives(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    columns = "lang, source, part, item, value, rank"
    want = sorted(con.sql(f"select {columns} from ({OP11_SQL})").fetchall())
    assert made(queries.QUERIES["op11_source_divergence"](spark, sf)) == want and len(want) > 100
