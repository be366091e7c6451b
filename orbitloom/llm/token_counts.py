"""Token counts of a piece BPE vocabulary by heap and linked list, without identifiers."""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitloom.llm.common import map_rows, table

SPACE = "▁"
#: Entries of a worker's cache of counts by stretch. A full cache becomes the old one, from which stretches in use are taken over, so twice as many are held at most.
CACHE_ENTRIES = 700_000
#: Longer stretches without a space aren't kept in the cache.
CACHE_CHARS = 64


class PieceCounter:
    """Counts tokens as the sentence-piece library does for a BPE model with byte fallback and an identity normaliser.

    A text becomes symbols, one a character (a space is the mark SPACE, and one stands before the text). A heap holds the adjacent pairs
    that form a piece, the piece of lowest rank first and of equal ranks the leftmost; a linked list holds the symbols.
    Each popped pair that still stands merges. Tokens are the initial symbols minus the merges; a symbol that's no piece
    counts its UTF-8 bytes. No piece has the mark after another character (checked on loading), nor a line feed, nor a
    comma or full stop after a letter, so no merge crosses those places and the stretches between them are counted alone.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        pieces = [(p.piece, p.score) for p in model.pieces if p.type == 1]
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or any(p.type not in (1, 2, 3, 6) for p in model.pieces):
            raise ValueError("only models with an identity normaliser, a leading space and no extra symbols")
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p, _ in pieces):
            raise ValueError("only models whose pieces don't cross a space or line feed")
        if any(a.isalpha() and b in ".," for p, _ in pieces for a, b in zip(p, p[1:])):
            raise ValueError("only models whose pieces don't have a comma or full stop after a letter")
        self.rank = {p: -score for p, score in pieces}
        self.known: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def merged(self, s: str) -> int:
        rank, n = self.rank, len(s)
        text: list[str | None] = list(s)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, p) for i in range(n - 1) if (r := rank.get(p := s[i : i + 2])) is not None]
        heapq.heapify(heap)
        tokens = n + sum(len(c.encode()) - 1 for c in s if c not in rank)  # a character that's no piece never merges
        while heap:
            _, i, pair = heapq.heappop(heap)
            a = text[i]
            if a is None or (j := right[i]) < 0 or len(a) >= len(pair) or a + text[j] != pair:
                continue
            text[i], text[j], tokens = pair, None, tokens - 1
            k = right[i] = right[j]
            if k >= 0:
                left[k] = i
                if (r := rank.get(p := pair + text[k])) is not None:
                    heapq.heappush(heap, (r, i, p))
            if (h := left[i]) >= 0 and (r := rank.get(p := text[h] + pair)) is not None:
                heapq.heappush(heap, (r, h, p))
        return tokens

    def stretch(self, s: str) -> int:
        if (n := self.known.get(s)) is not None:
            return n
        if (n := self.old.get(s)) is None:
            n = self.stretch(s[:-1]) + self.merged(s[-1]) if s[-1] in ".," and s[-2:-1].isalpha() else self.merged(s)
        if len(s) <= CACHE_CHARS:
            if len(self.known) >= CACHE_ENTRIES:
                self.old, self.known = self.known, {}
            self.known[s] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        total, stretch, first = 0, self.stretch, True
        for line in text.split("\n"):
            # within a line, each space starts a stretch; runs of spaces belong to the stretch that follows them
            if not first:
                total += 1  # the line feed, one byte
            words, get = line.split(" "), self.known.get
            if "" not in words and SPACE not in line:
                total += stretch(SPACE + words[0] if first else words[0])
                for w in words[1:]:
                    n = get(w := SPACE + w)
                    total += stretch(w) if n is None else n
            else:
                for s in re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", (" " + line if first else line).replace(" ", SPACE)):
                    total += stretch(s)
            first = False
        return total


_counters: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """One a worker process, kept between tasks with its cache."""
    if path not in _counters:
        _counters[path] = PieceCounter(path)
    return _counters[path]


def token_counts(df: DataFrame, text: str, model: str, keep: list[str]) -> DataFrame:
    """The columns named in keep, with n_bytes and n_tokens of each whole text (null: empty, no tokens). One row a row; repeated rows and other columns don't matter."""

    def make() -> Callable[[tuple], Iterable[tuple]]:
        count = counter(model).count

        def row(values: tuple) -> Iterable[tuple]:
            s = values[-1] or ""
            yield *values[:-1], len(s.encode()), count(s)

        return row

    kinds = dict(df.dtypes)
    return map_rows(df.select(*keep, text), make, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_bytes long", "n_tokens long"]))


def op9_token_counts(spark: SparkSession, sf_dir: str, limit: int = 4096) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents"), "text", public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
