"""Token identifiers in binary files: blocks of identifiers transposed into bit or byte planes, each plane compressed, with a chunk index."""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orbitloom.llm.common import map_streams, marked, stored, table
from orbitloom.sources.storage import new_path

#: End mark of a document, identifiers a block, bytes of input files that one token file is meant to hold, and how hard planes are compressed.
END_ID, BLOCK, FILE_BYTES, LEVEL = 2, 1 << 16, 32 << 20, 1
#: Units of a worker's cache, after which it becomes the old one, from which units in use are taken over, and the longest unit that it keeps.
CACHE_UNITS, CACHE_CHARS = 300_000, 48
#: Characters of texts that are encoded at once.
TEXT_CHARS = 8 << 20
#: First bytes of a file, and its last: where the index begins, how long it is compressed, blocks, documents, identifiers, kind of plane.
MAGIC, TAIL = b"tokplan1", struct.Struct("<QQQQQc8s")

MANIFEST = "file long, path string, docs long, ids long, bytes long"


def planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block of little-endian unsigned 32-bit identifiers, lowest first; those above the highest bit in use are left out. kind: bit or byte."""
    width = max(1, int(ids.max(initial=0)).bit_length())
    if kind == "bit":
        return [np.packbits((ids >> np.uint32(k)).astype(np.uint8) & 1, bitorder="little").tobytes() for k in range(width)]
    if kind == "byte":
        own = ids.view(np.uint8).reshape(-1, 4)
        return [own[:, k].tobytes() for k in range(-(-width // 8))]
    raise ValueError(kind)


def from_planes(parts: list[bytes], number: int, kind: str) -> np.ndarray:
    ids = np.zeros(number, "<u4")
    for k, part in enumerate(parts):
        own = np.frombuffer(part, np.uint8)
        if kind == "bit":
            ids |= np.unpackbits(own, count=number, bitorder="little").astype("<u4") << np.uint32(k)
        else:
            ids.view(np.uint8).reshape(-1, 4)[:, k] = own
    return ids


class FileWriter:
    """One token file: documents are added one after another, a block is written whenever it is full."""

    def __init__(self, out, kind: str, block: int, level: int):
        self.out, self.kind, self.block = out, kind, block
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.held: list[np.ndarray] = []
        self.waiting = self.at = self.ids = 0
        self.chunks: list[tuple[int, int, list[int]]] = []  # where a block begins, its identifiers, compressed bytes of its planes
        self.keys: list[int | None] = []
        self.lengths: list[int] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _flush(self, ids: np.ndarray) -> None:
        parts = [self.pack(p) for p in planes(ids, self.kind)]
        self.chunks.append((self.at, len(ids), [len(p) for p in parts]))
        self._put(b"".join(parts))

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids))
        self.ids += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            whole = np.concatenate(self.held)
            cut = len(whole) // self.block * self.block
            for a in range(0, cut, self.block):
                self._flush(whole[a : a + self.block])
            self.held, self.waiting = [whole[cut:].copy()], len(whole) - cut

    def close(self) -> None:
        if self.waiting:
            self._flush(np.concatenate(self.held))
        none = np.array([k is None for k in self.keys], bool)
        index = [
            np.array([c[0] for c in self.chunks], "<u8").tobytes(), np.array([c[1] for c in self.chunks], "<u4").tobytes(), np.array([len(c[2]) for c in self.chunks], "u1").tobytes(),
            np.array([n for c in self.chunks for n in c[2]], "<u4").tobytes(),
            np.array([k or 0 for k in self.keys], "<i8").tobytes(), np.packbits(none, bitorder="little").tobytes(), np.array(self.lengths, "<u8").tobytes(),
        ]
        begin, data = self.at, self.pack(b"".join(index))
        self._put(data)
        self._put(TAIL.pack(begin, len(data), len(self.chunks), len(self.keys), self.ids, self.kind.encode()[1:2], MAGIC))


class FileReader:
    """The index of one token file, and its identifiers block by block."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        begin, length, chunks, docs, self.ids, kind, magic = TAIL.unpack(source.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.kind = {b"i": "bit", b"y": "byte"}[kind]
        self.unpack = zstandard.ZstdDecompressor().decompress
        data, at = self.unpack(source.read_at(length, begin)), 0

        def take(dtype: str, number: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, dtype, number, at)
            at += found.nbytes
            return found

        self.begins, self.numbers, width = take("<u8", chunks), take("<u4", chunks).astype(np.int64), take("u1", chunks).astype(int)
        self.sizes = np.split(take("<u4", int(width.sum())).astype(int), np.cumsum(width)[:-1]) if chunks else []
        keys, none = take("<i8", docs), np.unpackbits(take("u1", -(-docs // 8)), count=docs, bitorder="little").astype(bool)
        self.keys = [None if n else int(k) for k, n in zip(keys, none, strict=True)]
        self.lengths = take("<u8", docs).astype(np.int64)

    def chunk(self, k: int) -> np.ndarray:
        sizes = self.sizes[k]
        data, cuts = self.source.read_at(int(sizes.sum()), int(self.begins[k])), np.r_[0, np.cumsum(sizes)]
        return from_planes([self.unpack(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], int(self.numbers[k]), self.kind)

    def range(self, first: int, number: int) -> np.ndarray:
        """Any stretch of the file's identifiers: only the blocks that hold it are read, as the chunk index tells where they are."""
        ends = np.cumsum(self.numbers)
        a, b = np.searchsorted(ends, first, side="right"), np.searchsorted(ends, first + number, side="left")
        found = [self.chunk(k) for k in range(int(a), min(int(b) + 1, len(ends)))] if number else []
        before = int(ends[a - 1]) if a else 0
        return np.concatenate([*found, np.zeros(0, "<u4")])[first - before : first - before + number]

    def documents(self) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
        """(place of the document, its identifiers in pieces, each part of one block). A document's pieces have to be taken before the next document."""
        blocks = iter(range(len(self.numbers)))
        rest = np.zeros(0, "<u4")

        def pieces(left: int) -> Iterator[np.ndarray]:
            nonlocal rest
            while left:
                if not len(rest):
                    rest = self.chunk(next(blocks))
                own, rest = rest[:left], rest[left:]
                left -= len(own)
                yield own

        for k, n in enumerate(self.lengths.tolist()):
            yield k, pieces(n)


class Units(dict):
    """Identifiers of whole texts, by a cache of the library's answers for short stretches.

    A byte-level tokenizer cuts a text before the last white space of a run that a visible character follows, so a space and the word after it have the same identifiers in every text; so have the
    white space before that, and a comma or full stop that ends a word. A stretch of a space and letters alone is what the tokenizer's own pattern would cut out, so the library's merging model gets it at once;
    all others go through the whole tokenizer. So do texts with strings of special tokens, and those with control characters that only some count as white space.

    Looking each word up costs most, as a large cache is scattered in memory. So texts in which only single spaces and line feeds part the words are cut and their words numbered many texts at once by Arrow, and the cache is asked once a distinct word.
    """

    LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or spec["model"]["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex"):
            raise ValueError("only byte-level tokenizers without a normaliser")
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in spec["model"]["merges"]]
        self.merge = models.BPE(spec["model"]["vocab"], merges, cache_capacity=0).tokenize  # the same model without its own cache of words
        self.find = re.compile(rf" ?[{self.LETTERS}]+(?=[.,]?(?!\S))| ?\S+|\s+(?!\S)|\s").findall
        self.letters = re.compile(rf" ?[{self.LETTERS}]+").fullmatch
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join(["[\x1c-\x1f\u180e]", *special])).search
        self.rare = [*(t.content for t in self.tokenizer.get_added_tokens_decoder().values()), "  ", " \n", "\n ", "\n\n", "\x00", "\u180e", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]
        self.latin = [x for x in self.rare if x.isascii()]
        # byte-level alphabets write a visible byte as itself and the others, in order, from U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = {b: b for b in shown} | {b: 256 + k for k, b in enumerate(sorted(set(range(256)).difference(shown)))}
        self.old: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, unit: str) -> bytes:
        data = self.old.get(unit)
        if data is None:
            data = array("I", [t.id for t in self.merge(unit.encode().decode("latin-1").translate(self.alphabet))]).tobytes() if self.letters(unit) else self.plain(unit)
        if len(unit) <= CACHE_CHARS:
            self[unit] = data
        return data

    def encode(self, text: str) -> bytes:
        if self.odd(text):
            return self.plain(text)
        self.trim()
        return b"".join(map(self.__getitem__, self.find(text)))

    def trim(self) -> None:
        if len(self) > CACHE_UNITS:
            self.old = dict(self)
            self.clear()

    def simple(self, text: str) -> bool:
        return text != "" and text[0] not in " \n" and text[-1] not in " \n" and not any(x in text for x in (self.latin if text.isascii() else self.rare))

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Identifiers of each text."""
        self.trim()
        found: list[np.ndarray | None] = [None if self.simple(t) else np.frombuffer(self.encode(t), "<u4") for t in texts]
        if own := [k for k, x in enumerate(found) if x is None]:
            # a word that no space stands before is marked by a zero byte
            lists = pc.split_pattern(pa.array(["\x00" + texts[k].replace("\n", " \n \x00") for k in own], pa.large_string()), " ")
            words = lists.flatten().dictionary_encode()
            each = [self[w[1:] if w[0] == "\x00" else w if w == "\n" else " " + w] if (w[-1] not in ".,") else self.ended(w) for w in words.dictionary.to_pylist()]
            lengths = np.fromiter(map(len, each), np.int64, len(each)) // 4
            data, first, at = np.frombuffer(b"".join(each), "<u4"), np.cumsum(lengths) - lengths, words.indices.to_numpy()
            number = lengths[at]
            ends = np.cumsum(number)
            ids = data[np.arange(ends[-1]) + np.repeat(first[at] - ends + number, number)]
            cuts = np.r_[0, ends][lists.offsets.to_numpy()]
            for k, a, b in zip(own, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                found[k] = ids[a:b]
        return found

    def ended(self, w: str) -> bytes:
        """A word that ends in a comma or full stop."""
        unit = w[1:] if w[0] == "\x00" else " " + w
        return self[unit[:-1]] + self[unit[-1]] if self.letters(unit[:-1]) else self[unit]


_units: dict[str, Units] = {}


def units(path: str) -> Units:
    if path not in _units:
        _units[path] = Units(path)
    return _units[path]


def filesystem(path: str):
    """(store, path in it) of an address that Spark gives."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def write_ids(df: DataFrame, key: str, text: str, tokenizer: str, path: str, end: int = END_ID, kind: str = "byte", block: int = BLOCK, level: int = LEVEL, files: int | None = None) -> DataFrame:
    """Writes the identifiers of each whole text and an end mark into files below path, in ascending order of key (an integer), and returns the stored manifest, a row a file (file, path, docs, ids, bytes).

    A null or empty text is its end mark alone; a null key comes first; rows with equal keys stand side by side, ordered by a hash of their text, repeated rows each for themselves. Other columns are not read. No row, no file.
    Keys are dealt by range, so file k + 1 goes on where file k ends, and each task streams through its own range: it holds some texts of TEXT_CHARS characters together or one longer text, one block and the index of its file. A key that very many rows
    share spreads over files by the texts' hashes and the rows' places. A task writes under a name of its own and renames the file when it is whole, so a repeated task replaces the file by an equal one.
    """
    spark, m = df.sparkSession, marked(df.columns)
    rows = df.select(F.col(key).cast("long").alias(f"{m}key"), F.xxhash64(text).alias(f"{m}hash"), F.monotonically_increasing_id().alias(f"{m}row"), F.col(text).alias(f"{m}text"))
    order = [m + c for c in ("key", "hash", "row")]
    if files is None:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # of input files; what Spark can't tell the size of counts as enormous
        files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // FILE_BYTES if size < 1 << 60 else 1)
    last = np.array([end], "<u4")

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        first = next(rows, None)
        if first is None:
            return
        encode, number = units(tokenizer).encode_many, TaskContext.get().partitionId()
        store, root = filesystem(path)
        store.create_dir(root, recursive=True)
        name, own = f"{root}/ids-{number:08d}.tok", f"{root}/.{number:08d}-{uuid.uuid4().hex}"
        with store.open_output_stream(own) as out:
            writer = FileWriter(out, kind, block, level)
            while first is not None:
                some, size = [], 0
                while first is not None and size < TEXT_CHARS:
                    some.append(first)
                    size += len(first[1] or "")
                    first = next(rows, None)
                for (own_key, _), ids in zip(some, encode([t or "" for _, t in some]), strict=True):
                    writer.add(own_key, np.append(ids, last))
            writer.close()
        store.move(own, name)
        yield number, f"{path}/ids-{number:08d}.tok", len(writer.keys), writer.ids, writer.at

    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select(f"{m}key", f"{m}text")
    return stored(map_streams(dealt, run, MANIFEST), "manifest")


def opened_files(manifest: DataFrame) -> DataFrame:
    """(path, first): the files of a manifest with the identifiers in all files before; a row a file, dealt evenly."""
    before = F.sum("ids").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))  # over a row a file
    return manifest.select("path", F.coalesce(before, F.lit(0)).alias("first")).repartition(max(1, manifest.count()))


def read_ids(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, ids) of each document, from the files: its place among all identifiers, and its own with the end mark."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for path, first in rows:
            store, at = filesystem(path)
            with store.open_input_file(at) as source:
                reader = FileReader(source)
                for k, parts in reader.documents():
                    ids = np.concatenate([*parts, np.zeros(0, "<u4")])
                    yield reader.keys[k], first, ids.astype(np.int64).tolist()
                    first += len(ids)

    return map_streams(opened_files(manifest), run, f"`{key}` long, start long, ids array<long>")


def read_digests(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of each document, from the files; however long a document is, one block of it is held."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for path, first in rows:
            store, at = filesystem(path)
            with store.open_input_file(at) as source:
                reader = FileReader(source)
                for k, parts in reader.documents():
                    n = crc = 0
                    for ids in parts:
                        n, crc = n + len(ids), zlib.crc32(ids.tobytes(), crc)
                    yield reader.keys[k], first, n, crc
                    first += n

    return map_streams(opened_files(manifest), run, f"`{key}` long, start long, n_tokens long, ids_crc32 long")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_ids(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), new_path(spark, "ids"))
    return read_digests(manifest)
