"""Token files: round trips, the chunk index, odd texts against the tokenizer, and the registered query against plain Python."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orbitloom.llm import queries, token_files
from orbitloom.llm.token_files import END_ID, FileReader, FileWriter, Units, from_planes, planes, read_digests, read_ids, write_ids
from orbitloom.sources.storage import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n", "  a\n\n b ", "<|endoftext|>", "a  <|endoftext|> b", "é日本👍🏽 \x1c\x85 ok", "don't, I'll. 12, 3.", "été. Ünd,\nNeu", "a\x00b c", "word " * 30_000, "x" * 5000]


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("top", [0, 1, 2, 255, 256, 50_256, 2**31, 2**32 - 1])
@pytest.mark.parametrize("number", [0, 1, 7, 8, 1000])
def test_planes_go_there_and_back(kind, top, number):
    ids = np.random.default_rng(number).integers(0, top + 1, number, dtype=np.uint64).astype("<u4")
    parts = planes(ids, kind)
    assert len(parts) <= (32 if kind == "bit" else 4) and from_planes(parts, number, kind).tolist() == ids.tolist()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_a_file_gives_back_documents_and_any_stretch_by_its_index(tmp_path, kind):
    rng = np.random.default_rng(3)
    docs = [(None if k == 5 else k - 2, rng.integers(0, 60_000, n).astype("<u4")) for k, n in enumerate([0, 1, 900, 100, 0, 3, 257, 64, 5000])]
    with open(tmp_path / "x", "wb") as out:
        writer = FileWriter(out, kind, 100, 3)
        for key, ids in docs:
            writer.add(key, ids)
        writer.close()
    with pa.OSFile(str(tmp_path / "x")) as source:
        reader = FileReader(source)
        found = [(reader.keys[k], np.concatenate([*parts, np.zeros(0, "<u4")]).tolist()) for k, parts in reader.documents()]
        assert found == [(k, ids.tolist()) for k, ids in docs]
        whole = np.concatenate([ids for _, ids in docs])
        for first, number in [(0, 0), (0, 1), (99, 2), (100, 100), (len(whole) - 1, 1), (0, len(whole)), (333, 4000)]:
            assert reader.range(first, number).tolist() == whole[first : first + number].tolist()
        reads = []
        reader.source = type("Counted", (), {"read_at": lambda _, n, at: reads.append(at) or source.read_at(n, at)})()
        reader.range(950, 20)
        assert len(reads) == 1  # one block of a hundred


def test_identifiers_are_the_tokenizers():
    rng, plain, own = random.Random(5), Tokenizer.from_file(PATH), Units(PATH)
    parts = ["a", "don't", "x.", "1,", " ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "é", "日本", "👍🏽", " ", "᠎", "\x1c", "...", "--", "'s", "<|endoftext|>", "\x00", ".", "été.", "Ünd,"]
    texts = [t or "" for t in ODD]
    for k in range(6000):
        some = [rng.choice(parts) if rng.random() < (0.6 if k % 2 else 0.1) else rng.choice(" \n") + "w" + rng.choice(["x", "yz.", "é,", "7."]) for _ in range(rng.randint(0, 12))]
        texts.append("".join(some).strip() if k % 3 else "".join(some))
    assert [x.tolist() for x in own.encode_many(texts)] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_small_caches_change_nothing(monkeypatch):
    texts = [" ".join(f"w{(k * j) % 97}" for j in range(60)) for k in range(50)]
    want = [x.tolist() for x in Units(PATH).encode_many(texts)]
    monkeypatch.setattr(token_files, "CACHE_UNITS", 10)
    monkeypatch.setattr(token_files, "CACHE_CHARS", 3)
    own = Units(PATH)
    assert [own.encode_many([t])[0].tolist() for t in texts] == want


def test_files_hold_all_rows_in_order_of_keys(spark):
    rng = random.Random(2)
    rows = [(k, t, "x") for k, t in enumerate(ODD)] + [(None, "no key", "x"), (None, None, "x"), (3, "same key", "x"), (3, "same key", "x")] + [(-7, "hot " * 3 + str(k % 2), "x") for k in range(200)]
    rows += [(rng.randrange(10**12), "some words here, " * rng.randint(1, 9), "x") for _ in range(300)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string").repartition(5)
    path = new_path(spark, "ids")
    manifest = write_ids(df, "doc_id", "text", PATH, path, kind="bit", block=500, files=6)
    assert manifest.count() > 3
    plain = Tokenizer.from_file(PATH)
    got = sorted(read_ids(manifest).collect(), key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.r_[0, np.cumsum([len(r["ids"]) for r in got])[:-1]].tolist()
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k))
    assert sorted((r["doc_id"] is None, r["doc_id"], r["ids"]) for r in got) == sorted((k is None, k, [*plain.encode(t or "", add_special_tokens=False).ids, END_ID]) for k, t, _ in rows)
    digests = {(r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in read_digests(manifest).collect()}
    assert digests == {(r["start"], r["doc_id"], len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in got}


def test_an_empty_table_makes_no_file(spark):
    manifest = write_ids(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text", PATH, new_path(spark, "ids"))
    assert manifest.count() == 0 and read_digests(manifest).count() == 0


def test_a_broken_file_is_an_error():
    with pytest.raises(ValueError, match="not a token file"):
        FileReader(pa.BufferReader(bytes(100)))
    with pytest.raises(ValueError):
        planes(np.zeros(1, "<u4"), "nibble")
    out = io.BytesIO()
    FileWriter(out, "bit", 10, 1).close()
    assert list(FileReader(pa.BufferReader(out.getvalue())).documents()) == []


def test_the_query_gives_what_the_tokenizer_gives(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    plain, start, want = Tokenizer.from_file(PATH), 0, []
    for k, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = queries.QUERIES["op13_token_files"](spark, sf)
    assert sorted(tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == want
