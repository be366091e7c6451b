"""Licence scans by the matching statistics of a generalised suffix automaton over licence words."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from orbitloom.llm.common import map_rows, table
from orbitloom.llm.license_texts import TEXTS

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of text in UTF-8 with A-Z lower-cased
#: Phrases whose every place is reported.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Licence paragraphs by label, as words.
TEMPLATES = tuple((label, " ".join(w.decode() for w in WORD.findall(text.encode().lower()))) for label, texts in TEXTS.items() for text in texts)
#: Words that a maximal match needs to enter a chain, words that may lie between two matches of a chain, in text and template, and the share of a template that a span must cover.
LEAST_MATCH, MOST_GAP, LEAST_COVER = 3, 6, 0.75


class Automaton:
    """Generalised suffix automaton of word sequences: each state is a class of substrings with the same ends; extended sequence by sequence from the root."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.ends: list[dict[int, list[int]]] = [{}]  # of a state: by template, the places where its strings end

    def _state(self, length: int, next_: dict[int, int], link: int) -> int:
        self.next.append(next_)
        self.link.append(link)
        self.len.append(length)
        self.ends.append({})
        return len(self.len) - 1

    def extend(self, last: int, word: int) -> int:
        """The state of last's string with one more word."""
        if word in self.next[last]:  # another sequence had it
            q = self.next[last][word]
            return q if self.len[q] == self.len[last] + 1 else self._split(last, word, q)
        new, p = self._state(self.len[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._split(p, word, q)
        return new

    def _split(self, p: int, word: int, q: int) -> int:
        copy = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.ends[copy] = {k: list(v) for k, v in self.ends[q].items()}
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, template: int, words: list[int]) -> None:
        last = 0
        for end, word in enumerate(words):
            last = v = self.extend(last, word)
            while v > 0:
                self.ends[v].setdefault(template, []).append(end)
                v = self.link[v]

    def find(self, words: list[int]) -> int:
        v = 0
        for w in words:
            v = self.next[v][w]
        return v


class Scanner:
    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.templates = [(label, [self._id(w) for w in text.split()]) for label, text in TEMPLATES]
        phrases = [([self._id(w) for w in text.split()], label) for text, label in PHRASES.items()]
        self.automaton = a = Automaton()
        for k, (_, words) in enumerate(self.templates):
            a.add(k, words)
        for k, (words, _) in enumerate(phrases):
            a.add(-1 - k, words)
        # of a state: the phrases that end every string of at least so many words in it
        own: dict[int, list[tuple[int, str]]] = {}
        for words, label in phrases:
            own.setdefault(a.find(words), []).append((len(words), label))
        self.phrases: list[list[tuple[int, str]]] = [[] for _ in a.len]
        for v in sorted(range(1, len(a.len)), key=a.len.__getitem__):
            self.phrases[v] = own.get(v, []) + self.phrases[a.link[v]]

    def _id(self, word: str) -> int:
        return self.ids.setdefault(word.encode(), len(self.ids))

    def scan(self, text: str) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int, float]]]:
        """The number of words, the places of phrases as (start, label), and template spans as (label, start, end, share of the template covered); positions are words from 0."""
        words = WORD.findall(text.encode().lower())
        a, get = self.automaton, self.ids.get
        nexts, links, lens = a.next, a.link, a.len
        places, matches = [], []
        v = length = 0
        for i, word in enumerate(map(get, words)):
            if word is None:
                if length >= LEAST_MATCH:
                    matches.append((i, length, v))
                v = length = 0
                continue
            if word not in nexts[v]:
                if length >= LEAST_MATCH:
                    matches.append((i, length, v))  # a maximal match: it can't grow to the right
                while v and word not in nexts[v]:
                    v = links[v]
                    length = lens[v]
            if word in nexts[v]:
                v, length = nexts[v][word], length + 1
                for n, label in self.phrases[v]:
                    if n <= length:
                        places.append((i + 1 - n, label))
        if length >= LEAST_MATCH:
            matches.append((len(words), length, v))
        return len(words), places, self.chained(matches)

    def chained(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Joins matches that lie in the same order and close together in text and template, by the path that covers most words; a chain that covers enough of its template is a span.

        A match counts at every place of its template where its words stand. Each place continues the chain that covers most among those that end close before it in both, or begins one. Of chains of a template that overlap
        in the text the one that covers most is told, of equal ones the earliest.
        """
        live: dict[int, list[tuple[int, int, int, int]]] = {}  # by template, chains that may go on: text end, template end, words covered, text start
        found: dict[int, list[tuple[int, int, int]]] = {}  # by template, chains that cover enough: words covered, text start, text end
        for end, length, v in matches:
            start = end - length
            for k, places in self.automaton.ends[v].items():
                if k < 0:
                    continue
                least = LEAST_COVER * len(self.templates[k][1])
                chains = [c for c in live.get(k, ()) if c[0] >= start - MOST_GAP]
                new = []
                for at in places:
                    covered, first = length, start
                    for end0, at0, before, first0 in chains:
                        over = max(0, end0 - start, at0 - (at + 1 - length))  # words of both matches count once
                        if over < length and at + 1 > at0 and at + 1 - length - at0 <= MOST_GAP and before + length - over > covered:
                            covered, first = before + length - over, first0
                    new.append((end, at + 1, covered, first))
                    if covered >= least:
                        found.setdefault(k, []).append((covered, first, end))
                live[k] = chains + new
        spans = []
        for k, own in found.items():
            label, words = self.templates[k]
            told: list[tuple[int, int, int]] = []
            for covered, first, end in sorted(own, key=lambda c: (-c[0], c[1], c[2])):
                if all(end <= a or first >= b for _, a, b in told):
                    told.append((covered, first, end))
            spans += [(label, first, end, min(1.0, covered / len(words))) for covered, first, end in told]
        return sorted(spans, key=lambda x: (x[1], x[2], x[0]))


_scanner: list[Scanner] = []


def scanner() -> Scanner:
    if not _scanner:
        _scanner.append(Scanner())
    return _scanner[0]


def license_scan(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns in keep, with n_words, `places` (start, label) of the phrases and `spans` (label, start, end, cover) of the templates over each whole text. A null or empty text has no words; repeated rows give repeated results."""

    def make() -> Callable[[tuple], Iterable[tuple]]:
        scan = scanner().scan

        def row(values: tuple) -> Iterable[tuple]:
            n, places, spans = scan(values[-1] or "")
            yield *values[:-1], n, [{"start": s, "label": x} for s, x in places], [dict(zip(("label", "start", "end", "cover"), x, strict=True)) for x in spans]

        return row

    kinds = dict(df.dtypes)
    return map_rows(df.select(*keep, text), make, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "n_words long, places array<struct<start: long, label: string>>, spans array<struct<label: string, start: long, end: long, cover: double>>"]))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    base, own = "transform(places, x -> x.label)", "transform(spans, x -> x.label)"
    return found.selectExpr(
        "doc_id", "n_words", "cast(size(places) as long) n_base", "array_min(transform(places, x -> x.start)) first_word", "array_max(transform(places, x -> x.start)) last_word",
        f"array_join(array_sort(array_distinct({base})), ',') base_labels", f"array_join(array_sort(array_distinct(concat({base}, {own}))), ',') labels",
        "cast(greatest(case when size(places) > 0 then 0.5D else 0D end, coalesce(array_max(transform(spans, x -> x.cover)), 0D)) as double) score",
    )
