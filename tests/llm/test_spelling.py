"""Spelling variants against brute force over all pairs of words, and the registered query against plain Python and DuckDB."""

import collections
import random
import re
import zlib

import pytest

from orbitloom.llm import queries, spelling
from orbitloom.llm.spelling import Trie, looks, near_words, one_edit, search, spelling_forms, split_nodes, visits, word_counts


def edit_by_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, factor=10):
    found = {}
    for w, n in words.items():
        near = [(m, x) for x, m in words.items() if edit_by_one(w, x)]
        best = min(near, key=lambda t: (-t[0], t[1]), default=None)
        found[w] = (best[1] if best and best[0] >= factor * n else None, n, len(near), best[0] if best and best[0] >= factor * n else None)

    def root(w):
        while found[w][0]:
            w = found[w][0]
        return w

    return sorted((w, f, root(w), n, k, m) for w, (f, n, k, m) in found.items())


def rows_of(df):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()), key=str)


def some_words(rng, number, letters="abcdé×"):
    words = {}
    while len(words) < number:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, 8)))
        words[w] = rng.choice([1, 2, 3, 30, 300, 4000])
    return words


def test_one_edit_is_exact():
    rng = random.Random(1)
    for _ in range(20_000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(1, 6)))
        b = "".join(rng.choice("ab") for _ in range(rng.choice([len(a), len(a) + 1])))
        assert one_edit(a, b) == edit_by_one(a, b), (a, b)


@pytest.mark.parametrize(("groups", "most"), [(1, 5), (4, 1), (4, 20), (16, 1), (16, 50), (16, 10_000)])
def test_forms_are_those_of_brute_force(spark, groups, most):
    words = some_words(random.Random(groups * most), 250)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows_of(spelling_forms(df, groups=groups, most=most)) == sorted(brute(words), key=str)


@pytest.mark.parametrize("leaf", [0, 6])
def test_each_pair_is_met_once_and_the_budget_is_one_each(monkeypatch, leaf):
    monkeypatch.setattr(spelling, "LEAF", leaf)
    words = some_words(random.Random(9), 400, "abc")
    trie = Trie({"a": 0, "b": 1, "c": 2}, 3)
    for w, n in words.items():
        trie.add(trie.vector(w), w, n)
    met, seen = collections.Counter(), 0
    for w in words:
        v = trie.vector(w)
        for node, more, less in visits(v, {()}):
            start = trie.root.get(node[0])
            for found in search(start, v, 1, more, less) if start is not None else ():
                seen += len(found)
                for x, _, u in found:
                    assert u == trie.vector(x)
                    if not leaf:  # leaves of full depth: nothing outside of the budget is reached
                        assert sum(max(0, b - a) for a, b in zip(v[1:], u[1:])) <= 1 and sum(max(0, a - b) for a, b in zip(v[1:], u[1:])) <= 1
                    if one_edit(w, x) and (len(x) > len(w) or looks(w, v, x, u)):
                        met[frozenset((w, x))] += 1
    assert met == {frozenset((a, b)): 1 for a in words for b in words if a < b and edit_by_one(a, b)} and seen < 400 * 200


def test_nodes_are_split_until_they_fit(spark):
    vectors = spark.createDataFrame([([3, 1, 2],)] * 7 + [([3, 2, 1],)] * 2 + [([4, 0, 4],)] * 3, "v array<int>")
    split, blocks = split_nodes(vectors, 2, 3)
    assert split == {(3,), (3, 1)} and blocks == {(3, 1, 2): 3}
    assert split_nodes(vectors, 2, 7) == ({(3,)}, {}) and split_nodes(vectors, 2, 9) == (set(), {})


def test_chains_are_followed_to_their_root_and_ties_go_to_the_smallest(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "ccccccc": 2, "ccccccd": 50, "ccccccb": 50, "ccccccé": 50, "zzzzzzzz": 9, "zzzzzzzy": 89}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    found = {r["word"]: r for r in spelling_forms(df).collect()}
    assert found["aaaaaaa"]["root"] == "aaaabbb" and found["aaaaaaa"]["form"] == "aaaaaab"
    assert found["ccccccc"]["form"] == "ccccccb" and found["ccccccc"]["n_near"] == 3
    assert found["zzzzzzzz"]["form"] is None and found["zzzzzzzz"]["root"] == "zzzzzzzz" and found["zzzzzzzz"]["n_near"] == 1 and found["zzzzzzzz"]["form_n"] is None


def counted(rows):
    words = collections.Counter()
    for k, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                words[w] += 1
    return words


ODD = [None, "", " ", "Abcdefgh abcdefgh ABCDEFGH", "École École ÉCOLEéé ×××××××÷", "abcdefg日abcdefg Ŝabcdefg", "x" * 50_000, "longword " * 20_000, "\x00abcdefgh\x00", "abcdefgh'ijklmnop"]


def test_words_are_cut_and_counted_as_said(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(3, ODD[3]), (None, "nokeyword nokeyword")] + [(100 + k, "misspelled variants happening") for k in range(200)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n string").repartition(4)
    want = dict(counted(rows))
    assert len(want) > 20
    assert {r["word"]: r["n"] for r in word_counts(df, "doc_id", "text").collect()} == want
    monkeypatch.setattr(spelling, "ENTRIES", 3)
    assert {r["word"]: r["n"] for r in word_counts(df, "doc_id", "text").collect()} == want


def test_empty_tables_have_no_words(spark):
    assert word_counts(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").count() == 0
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling_forms(empty).count() == 0 and near_words(empty).count() == 0


def test_the_query_gives_what_brute_force_gives(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    words = {w: n for w, n in counted(rows).items() if n >= 2}
    by_gap = collections.defaultdict(set)  # words at one edit share a pattern with one gap
    for w in words:
        for i in range(len(w) + 1):
            by_gap[w[:i] + "?" + w[i:]].add(w)
            if i < len(w):
                by_gap[w[:i] + "?" + w[i + 1 :]].add(w)
    near = collections.defaultdict(set)
    for some in by_gap.values():
        for a in some:
            near[a] |= {b for b in some if edit_by_one(a, b)}
    got = queries.QUERIES["op12_spelling_variants"](spark, sf).collect()
    assert {r["word"]: (r["n"], r["n_near"]) for r in got} == {w: (n, len(near[w])) for w, n in words.items()}
    forms = {r["word"]: r["form"] for r in got}
    for w, n in words.items():
        best = min(((-words[x], x) for x in near[w]), default=None)
        assert forms[w] == (best[1] if best and -best[0] >= 10 * n else None)
    assert sum(f is not None for f in forms.values()) > 5
