"""Operators that work row by row, against independent brute force and round trips."""

import os
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from orbitloom.llm import licenses, personal_data, token_counts, transport_stream
from orbitloom.llm.packing import Identifiers

ODD = ["", " ", "\n", "a  b\n\n  c ", "▁ ▁▁x", "日本語 テスト\n  é", "a\x00b", "👍🏽 ok.", "hello\r\n world\t\x0b\x0c\x1c", "=" * 300, " " * 99 + "x", "<s> <0x0A> <|endoftext|>, x<|endoftext|>", "it's, don't. I'll 'S 3., 12,345.67"]
RNG = random.Random(5)
FUZZ = ["".join(RNG.choice("aB1.,'! \n\téÉ́<|>s@+-()") for _ in range(RNG.randint(0, 60))) for _ in range(1500)]


def test_token_counts_equal_the_library():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ODD + FUZZ + ["ab" * 3000, "x" * 20_000]
    want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)]
    assert [token_counts.counter(path).count(t) for t in texts] == want


def test_token_cache_generations(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 3)
    c = token_counts.PieceCounter(public_tokenizers.path("piece_bpe_32k.model"))
    whole = token_counts.counter(public_tokenizers.path("piece_bpe_32k.model"))
    for t in FUZZ[:300]:
        assert c.count(t) == whole.count(t)


def test_identifiers_equal_the_library(monkeypatch):
    from orbitloom.llm import packing

    monkeypatch.setattr(packing, "CACHE_WORDS", 50)
    own = Identifiers(public_tokenizers.path("word_bpe_49k.json"))
    for t in ODD + FUZZ + ["y" * 5000 + " z"]:
        assert own.encode(t) == own.plain(t)


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) < 256 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    )
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, text) if ok(m[0])]


def test_personal_data_equals_the_plain_patterns():
    near = ["".join(RNG.choice("0123456789. -+@a") for _ in range(70)) for _ in range(1500)]
    known = ["Mail a.b+c@x-y.example.com, +1 (383) 555-6083; 10.0.0.255 256.1.1.1 4738745156746829; 4111 1111 1111 1111", "é 4111-1111-1111-1111"]
    for t in ODD + FUZZ + near + known:
        assert [s[:3] for s in personal_data.find(t) if s[0] in personal_data.KINDS[:4]] == base_spans(t)
    assert {"email", "ip", "card", "phone"} <= {s[0] for s in personal_data.find(known[0])}


def test_own_kinds_need_checksum_and_context():
    good = "IBAN: GB82 WEST 1234 5698 7654 32."
    assert [s[0] for s in personal_data.find(good)] == ["iban"]
    assert personal_data.find(good.replace("32.", "33.")) == []
    assert [s[0] for s in personal_data.find("amex card 378282246310005")] == ["pan"]
    assert personal_data.find("order 378282246310005") == []


@pytest.mark.parametrize("tail", [" BIC MIDLGB22", " EUR 250", " 2024 invoice", "\nBIC", " Bank", ", 7", " FR14 2004 1010 0505 0001 3M02 606"])
def test_account_numbers_before_other_words(tail):
    for number in ("GB82 WEST 1234 5698 7654 32", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"):
        text = f"IBAN {number}{tail}"
        spans = personal_data.find(text)
        assert [text[a:b] for kind, a, b, _ in spans if kind == "iban"] == [number, tail[1:]][: 1 + tail.startswith(" FR")]
        assert number not in personal_data.masked(text, spans)
    assert not [s for s in personal_data.find("AB12 GB82 WEST 1234 5698 7654 33 BIC") if s[0] == "iban"]
    assert [s[1:3] for s in personal_data.find("AB12 GB82 WEST 1234 5698 7654 32 BIC") if s[0] == "iban"] == [(5, 32)]


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "@" * 100_000, "a@" * 100_000])
def test_long_runs_take_linear_time(text):
    personal_data.find(text)


def test_masking(spark):
    rows = [(1, "write a@b.example.com now", "x"), (2, None, "y"), (3, "", None), (1, "write a@b.example.com now", "x")]
    got = personal_data.mask_personal_data(spark.createDataFrame(rows, "doc_id long, text string, score string"), "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "write [EMAIL] now", "x"), (2, None, "y"), (3, "", None), (1, "write [EMAIL] now", "x")], key=str)


def test_license_places_and_spans():
    scan = licenses.scanner().scan
    words = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "under", "the"]
    texts = [" ".join(RNG.choice(words) for _ in range(50)) for _ in range(300)] + ODD + ["MIT LICENSE mit license", "ÉMIT license", "cc-by cc by"]
    for t in texts:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), t)
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        want = sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        n, places, _ = scan(t)
        assert n == len(w) and sorted(places) == want
    grant = next(text for label, text in licenses.TEMPLATES if label == "mit")
    half = grant.split()
    broken = " ".join([*half[:20], "really", *half[20:]])
    for t in (grant, broken, grant.upper(), "before it " + grant + " after it"):
        spans = scan(t)[2]
        assert any(label == "mit" and cover > 0.9 for label, _, _, cover in spans)
    assert scan("nothing to see in the terms of the day")[2] == []


def test_licence_files_are_found_as_people_write_them():
    """Texts that the templates were not written from: other line breaks, comment marks, holders' names in place of general words, older wordings."""
    scan = licenses.scanner().scan
    mit = """// Copyright 2021 J. Doe
// Permission is hereby granted, free of charge, to any person obtaining a
// copy of this software and associated documentation files (the "Software"),
// to deal in the Software without restriction, including without limitation
// the rights to use, copy, modify, merge, publish, distribute, sublicense,
// and/or sell copies of the Software, and to permit persons to whom the
// Software is furnished to do so, subject to the following conditions:"""
    bsd = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:
 * 3. Neither the name of the University nor the names of its contributors
 *    may be used to endorse or promote products derived from this software
 *    without specific prior written permission.
 * THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND"""
    gpl = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License version 2
as published by the Free Software Foundation."""
    cc = "<p>This work is licensed under a <a href='x'>Creative Commons Attribution-NonCommercial 4.0 International License</a>.</p>"
    want = ((mit, {"mit"}), (bsd, {"bsd"}), (gpl, {"gpl"}), (cc, {"cc-by-nc"}))
    for text, labels in want:
        for t in (text, f"some words before it {text} and after it"):
            assert {s[0] for s in scan(t)[2]} >= labels, labels
    for t in ("the software is provided to schools without fee", "permission to use the hall is granted by the council", "this work is licensed in many lands under the law of the sea"):
        assert scan(t)[2] == []


@pytest.mark.parametrize("step", [4, 5, 6, 7])
def test_templates_with_replaced_words_are_found_if_enough_is_covered(step):
    scan, cases = licenses.scanner().scan, 0
    for label, text in licenses.TEMPLATES:
        words = text.split()
        for first in range(step):
            broken = [f"zq{i}" if i % step == first else w for i, w in enumerate(words)]
            runs = [len(x.split()) for x in re.split(r"zq\d+", " ".join(broken))]
            if sum(n for n in runs if n >= licenses.LEAST_MATCH) / len(words) >= licenses.LEAST_COVER:
                spans = scan("alpha beta " + " ".join(broken) + " gamma")[2]
                assert any(s[0] == label and s[3] >= licenses.LEAST_COVER for s in spans), (label, first)
                cases += 1
    assert cases > 30


def test_chains_cover_most_among_all_places():
    """Chains against all subsequences of matches, on a small alphabet where matches have many places."""
    scanner = licenses.Scanner.__new__(licenses.Scanner)
    scanner.automaton, scanner.ids, scanner.phrases = licenses.Automaton(), {}, []
    rng = random.Random(2)
    template = [rng.randint(0, 2) for _ in range(24)]
    scanner.templates = [("t", template)]
    scanner.automaton.add(0, template)
    for _ in range(60):
        matches, at = [], 0
        for _ in range(rng.randint(1, 4)):
            length, begin = rng.randint(3, 6), rng.randint(0, 18)
            at += length + rng.randint(0, 3)
            matches.append((at, length, scanner.automaton.find(template[begin : begin + length])))
        places = [(end, n, p) for end, n, v in matches for p in scanner.automaton.ends[v][0]]
        best = {}
        for k, (end, n, p) in enumerate(places):
            best[k] = n
            for j, (end0, n0, p0) in enumerate(places[:k]):
                over = max(0, end0 - (end - n), p0 + 1 - (p + 1 - n))
                if end0 < end and over < n and p > p0 and end - n - end0 <= licenses.MOST_GAP and p - n - p0 <= licenses.MOST_GAP:
                    best[k] = max(best[k], best[j] + n - over)
        most = max(best.values())
        spans = scanner.chained(matches)
        assert bool(spans) == (most >= licenses.LEAST_COVER * 24) and all(s[3] <= 1 for s in spans)
        if spans:
            assert max(s[3] for s in spans) == min(1.0, most / 24)


def test_automaton_matches_are_the_longest():
    a = licenses.Automaton()
    seqs = [[RNG.randint(0, 3) for _ in range(RNG.randint(1, 12))] for _ in range(12)]
    for k, s in enumerate(seqs):
        a.add(k, s)
    subs = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for _ in range(200):
        text, v, n = [RNG.randint(0, 4) for _ in range(20)], 0, 0
        for i, c in enumerate(text):
            while v and c not in a.next[v]:
                v = a.link[v]
                n = a.len[v]
            v, n = (a.next[v][c], n + 1) if c in a.next[v] else (0, 0)
            assert n == max((k for k in range(i + 2) if k == 0 or tuple(text[i + 1 - k : i + 1]) in subs), default=0)
            for t in range(len(seqs)) if n else ():
                assert sorted(a.ends[v].get(t, [])) == [end for end in range(len(seqs[t])) if end + 1 >= n and seqs[t][end + 1 - n : end + 1] == text[i + 1 - n : i + 1]]


@pytest.mark.parametrize("n", [64, 128, 176, 184, 16384, 16384 + 64, 16384 * 9 + 64, 64 * 257])
def test_transport_round_trip(n):
    data = os.urandom(n)
    stream = transport_stream.mux(data)
    d = transport_stream.demux(stream)
    assert b"".join(u["data"] for u in d["units"]) == data and d["faults"] == 0
    assert d["programs"] == {1: 0x1000} and d["streams"] == {0x100: (1, 6)}
    assert [u["pts"] for u in d["units"]] == [3600 * k for k in range(-(-n // 16384))]
    assert [u["random_access"] for u in d["units"]] == [k % 8 == 0 for k in range(len(d["units"]))]


def test_transport_faults():
    stream = transport_stream.mux(os.urandom(64 * 1000))
    lost = stream[: 188 * 10] + stream[188 * 11 :]
    assert transport_stream.demux(lost)["faults"] >= 1
    twice = stream[: 188 * 11] + stream[188 * 10 :]
    assert transport_stream.demux(twice)["faults"] == 0
    for bad in (stream[:-1], b"\x00" + stream[1:]):
        with pytest.raises(transport_stream.StreamError):
            transport_stream.demux(bad)
    assert transport_stream.demux(b"")["units"] == []


def test_media_columns(spark):
    df = spark.createDataFrame([(1, "x", None), (2, None, 3), (None, "", 3)], "doc_id long, text string, media int")
    media = transport_stream.transport_streams(df, "text", ["doc_id"])
    rows = {r["doc_id"]: r for r in transport_stream.elementary_packets(media, "media", ["doc_id", "n_bytes"]).collect()}
    assert rows[1]["payload"] == b"x".ljust(64, b"\0") and rows[2]["payload"] == rows[None]["payload"] == bytes(64)
    assert rows[1]["error"] is None and rows[1]["units"][0]["pts"] == 0 and rows[1]["programs"] == {1: 0x1000}
    broken = transport_stream.elementary_packets(spark.createDataFrame([(1, None), (2, b"zz")], "doc_id long, media binary"), "media", ["doc_id"])
    assert {r["doc_id"]: r["error"] for r in broken.collect()} == {1: "null", 2: "not whole packets"}


def test_row_operators_take_odd_tables(spark):
    odd = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "mit license", 2), (2, "word " * 50_000, 3)], "doc_id long, text string, n_tokens int")
    none = odd.limit(0)
    path = public_tokenizers.path("piece_bpe_32k.model")
    for f in (lambda d: token_counts.token_counts(d, "text", path, ["doc_id"]), lambda d: licenses.license_scan(d, "text", ["doc_id"]), lambda d: personal_data.personal_data(d, "text", ["doc_id"])):
        assert f(odd).count() == 4 and f(none).count() == 0
    big = token_counts.token_counts(odd, "text", path, ["doc_id"]).filter("doc_id = 2").first()
    assert big["n_bytes"] == 250_000 and big["n_tokens"] == 50_001
    assert zlib.crc32(b"") == 0 and odd.select(F.crc32(F.lit(b""))).first()[0] == 0
