"""Best-fit decreasing packing of token sequences into windows of fixed size."""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitloom.llm.common import map_rows, numbered, stored, table

WINDOW, END_ID = 2048, 1
#: Words of a worker's cache of identifiers, after which it becomes the old one, from which words in use are taken over, and the longest word that it keeps.
CACHE_WORDS, CACHE_CHARS = 200_000, 48


class Identifiers:
    """Identifiers of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizer's pre-tokenizer never crosses white space, so a text's identifiers are those of its words, and a cache
    by word serves most of them. Only the space, tab, line feed and carriage return cut words here; every other kind of
    white space stays inside a word and is left to the tokenizer. A comma or full stop that ends a word after a letter or
    digit of ASCII is always a pre-token of its own, so a new word is looked up without it first.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Encodes new words in one call and deals the identifiers out by their places."""
        known = self.known
        tails = [w for w in words if w[-1] in ".," and w[-2:-1].isascii() and w[-2:-1].isalnum()]
        cores = list({w[:-1] for w in tails}.union(words.difference(tails), ".,").difference(known))
        found = self.tokenizer.encode(" ".join(cores), add_special_tokens=False)
        ends = np.cumsum([len(w) + 1 for w in cores])
        ids = np.array(found.ids, "<u4")
        starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(ids))
        cuts = np.searchsorted(np.searchsorted(ends, starts, side="right"), np.arange(len(cores) + 1)).tolist()
        data = ids.tobytes()
        for k, w in enumerate(cores):
            known[w] = data[4 * cuts[k] : 4 * cuts[k + 1]]
        for w in tails:
            known[w] = known[w[:-1]] + known[w[-1]]

    def encode(self, text: str) -> bytes:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        if new := set(words).difference(self.known):
            if len(self.known) > CACHE_WORDS:
                self.old, self.known = self.known, {"": b""}
                new = set(words).difference(self.known)
            if old := [w for w in new if w in self.old]:
                self.known.update((w, self.old[w]) for w in old)
                new.difference_update(old)
            own = {w: self.plain(w) for w in new if len(w) > CACHE_CHARS}
            self.learn(new.difference(own))
            if own:
                return b"".join([own[w] if w in own else self.known[w] for w in words])
        return b"".join(map(self.known.__getitem__, words))


class OpenWindows:
    """Segment tree over remaining capacities 0..size; a leaf holds runs of windows (first, number) with that much room left."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.some = [False] * (2 * self.base)
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def _mark(self, room: int) -> None:
        i = self.base + room
        self.some[i] = bool(self.runs[room])
        while i > 1:
            i //= 2
            self.some[i] = self.some[2 * i] or self.some[2 * i + 1]

    def put(self, room: int, first: int, number: int) -> None:
        if number and room:
            self.runs[room].append((first, number))
            self._mark(room)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._mark(room)
        return run

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least `least` that has an open window."""
        i = self.base + least
        if self.some[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.some[i + 1]:
                i += 1
                while i < self.base:
                    i = 2 * i if self.some[2 * i] else 2 * i + 1
                return i - self.base
            i //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], size: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Packs counts[n] pieces of each length n: longest first, each into the tightest open window, a new one if none has room.

    Pieces of equal length are alike and so are windows with equal room, so a step places a whole run: the tightest
    window stays the tightest until no further piece of this length fits, and so takes `each` of them. Returns steps
    (length, first rank, number, first window, each, offset): the piece of that length with rank first rank + k lies in window
    first window + k // each at offset + (k % each) * length. The work depends on the lengths that occur, not on how many pieces there are.
    """
    open_, windows, steps = OpenWindows(size), 0, []
    for n in sorted(counts, reverse=True):
        rank, left = 0, counts[n]
        while left:
            room = open_.tightest(n)
            first, number = open_.take(room) if room is not None else (windows, -(-left // (size // n)))
            if room is None:
                room, windows = size, windows + number
            each = room // n
            placed = min(left, number * each)
            steps.append((n, rank, placed, first, each, size - room))
            full, rest = divmod(placed, each)
            open_.put(room - each * n, first, full)
            if rest:
                open_.put(room - rest * n, first + full, 1)
            open_.put(room, first + full + bool(rest), number - full - bool(rest))
            rank, left = rank + placed, left - placed
    return steps


def pieces(df: DataFrame, text: str, tokenizer: str, keep: list[str], size: int = WINDOW) -> DataFrame:
    """One row a piece: the columns in keep, start, length, ids_crc32 and doc_tokens. A text's identifiers are followed by END_ID and cut into full windows and a rest; a null or empty text is END_ID alone."""

    def make() -> Callable[[tuple], Iterable[tuple]]:
        encode, end = identifiers(tokenizer).encode, np.array([END_ID], "<u4").tobytes()

        def row(values: tuple) -> Iterable[tuple]:
            data = encode(values[-1] or "") + end
            n = len(data) // 4
            for at in range(0, n, size):
                yield *values[:-1], at, min(size, n - at), zlib.crc32(data[4 * at : 4 * (at + size)]), n

        return row

    kinds = dict(df.dtypes)
    return map_rows(df.select(*keep, text), make, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "start long, length long, ids_crc32 long, doc_tokens long"]))


_identifiers: dict[str, Identifiers] = {}


def identifiers(path: str) -> Identifiers:
    if path not in _identifiers:
        _identifiers[path] = Identifiers(path)
    return _identifiers[path]


def pack(cut: DataFrame, order: list[str], size: int = WINDOW) -> DataFrame:
    """Adds sequence_id and offset to a table with a `length` column of 1 to size; order breaks ties among equal lengths (rows that tie there too are alike).

    The driver packs the histogram of lengths, at most `size` rows; its steps, grouped by length, are at most `size` rows again and are
    broadcast. Ranks within a length are numbered in parallel, so neither a frequent length nor the whole table meets in one task.
    """
    spark = cut.sparkSession
    cut = stored(cut, "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps: dict[int, list[tuple]] = defaultdict(list)
    for n, *step in best_fit_decreasing(counts, size):
        steps[n].append(tuple(step))
    plan = spark.createDataFrame(list(steps.items()), "length long, steps array<struct<rank: long, number: long, first: long, each: long, at: long>>")
    ranked = numbered(cut, F.col("length"), order, "rank", sum(counts.values()))
    own = F.expr("filter(steps, s -> rank >= s.rank and rank < s.rank + s.number)[0]")
    placed = ranked.join(F.broadcast(plan), "length").withColumn("own", own)
    found = placed.withColumns({"sequence_id": F.expr("own.first + (rank - own.rank) div own.each"), "offset": F.expr("own.at + (rank - own.rank) % own.each * length")})
    return found.select(*cut.columns, "sequence_id", "offset")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces(table(spark, sf_dir, "documents"), "text", public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])
    return pack(cut, ["doc_id", "start", "ids_crc32"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
