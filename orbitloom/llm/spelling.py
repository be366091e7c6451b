"""Spelling variants: words of a corpus at one edit's distance, found in a trie of letter-group counts."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitloom.llm.common import map_streams, stored, table

#: Least code points and occurrences of a word, how much more frequent its form must be, and by what the checksum of a planted misspelling is divided.
LEAST_CHARS, LEAST_COUNT, FACTOR, DIVISOR = 7, 2, 10, 31
#: Letter groups of the trie, words that one shard of it is meant to hold, words of a leaf that isn't cut further, and entries after which a task sends what it has counted.
GROUPS, SHARD, LEAF, ENTRIES = 16, 20_000, 6, 200_000

# Latin-1 writes each letter of a word as one byte, and everything outside of it as a question mark, so words are cut and lower-cased (A to Z alone) in one table.
_WORDS = bytes(c if 97 <= c <= 122 or c >= 0xC0 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def word_counts(df: DataFrame, key: str, text: str, least: int = LEAST_CHARS) -> DataFrame:
    """(word, n) of all whole texts: maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case; where 31 divides the checksum of key and run, the run loses one letter. Shorter results don't count.

    Tasks count first, so a word is sent once a task and not once an occurrence, and send what they have whenever it reaches ENTRIES words. A null text has no words, a null key is written as nothing; rows that repeat a key count each.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        total: Counter[bytes] = Counter()
        for own, s in rows:
            if not s:
                continue
            base = zlib.crc32(b"%s:" % ("" if own is None else str(own)).encode())
            for w, n in Counter([w for w in s.encode("latin-1", "replace").translate(_WORDS).split() if len(w) >= least]).items():
                h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), base)
                if not h % DIVISOR:
                    at = h % len(w)
                    w = w[:at] + w[at + 1 :]
                    if len(w) < least:
                        continue
                total[w] += n
            if len(total) >= ENTRIES:
                yield from ((w.decode("latin-1"), n) for w, n in total.items())
                total.clear()
        yield from ((w.decode("latin-1"), n) for w, n in total.items())

    return map_streams(df.select(F.col(key), F.col(text)), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letter_groups(words: DataFrame, groups: int = GROUPS) -> dict[str, int]:
    """Letter to group: the most frequent letters have a group each, in that order, as their counts tell words apart best; the rest are dealt to the last few in turn. At most as many rows as there are letters come to the driver."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''").groupBy("letter").count()
    found = [r["letter"] for r in letters.orderBy(F.desc("count"), "letter").collect()]
    single = groups * 3 // 4
    return {c: k if k < single else single + (k - single) % (groups - single) for k, c in enumerate(found)}


class Trie:
    """Words by their length and then by how many letters of each group they have, group after group. A node is a dict by the next count, or, as long as few words lie there, a list of them as (word, n, vector)."""

    def __init__(self, groups: dict[str, int], number: int):
        self.groups, self.number = groups, number
        self.root: dict | list = []

    def vector(self, word: str) -> list[int]:
        """The length, and then the letters of each group."""
        found = [0] * (self.number + 1)
        found[0] = len(word)
        for c in word:
            found[self.groups[c] + 1] += 1
        return found

    def split(self, leaf: list, at: int) -> dict | list:
        """The node in place of a leaf, whose words agree before place `at` of their vectors."""
        if len(leaf) <= LEAF or at > self.number:
            return leaf
        parts: dict[int, list] = {}
        for entry in leaf:
            parts.setdefault(entry[2][at], []).append(entry)
        return {count: self.split(part, at + 1) for count, part in parts.items()}

    def add(self, vector: list[int], word: str, n: int, at: int = 0) -> None:
        """Adds a word below the root, which stands at place `at` of vectors."""
        entry, node = (word, n, vector), self.root
        if isinstance(node, list):
            node.append(entry)
            self.root = self.split(node, at)
            return
        while isinstance(child := node.setdefault(vector[at], []), dict):
            node, at = child, at + 1
        child.append(entry)
        if len(child) > LEAF:
            node[vector[at]] = self.split(child, at + 1)


def visits(vector: list[int], split: set[tuple[int, ...]]) -> Iterator[tuple[tuple[int, ...], int, int]]:
    """(node, surplus, deficit): the depth-first search of a word in the top of the trie, down to the nodes that are whole shards, with the budget that it has spent.

    A word looks for the words that are one letter longer, and for those of its length. One with a letter more has a surplus of one in one group; one with a letter replaced has a surplus of one and a deficit of one,
    or neither. Of two words with a replaced letter the one that meets its surplus first looks for the other, so each pair is found from one side.
    """
    stack = [((vector[0] + 1,), 0, -1), ((vector[0],), 0, 0)]  # a deficit of -1: none may be spent
    while stack:
        node, more, less = stack.pop()
        if node not in split:
            yield node, more, less
            continue
        own = vector[len(node)]
        stack.append(((*node, own), more, less))
        if not more:
            stack.append(((*node, own + 1), 1, less))
        elif not less and own:
            stack.append(((*node, own - 1), more, 1))


def search(node: dict | list, vector: list[int], at: int, more: int, less: int) -> Iterator[list]:
    """The leaves that the same search reaches below a shard's node."""
    stack = [(node, at, more, less)]
    while stack:
        node, at, more, less = stack.pop()
        if type(node) is list:
            yield node
            continue
        own, get = vector[at], node.get
        at += 1
        if (child := get(own)) is not None:
            stack.append((child, at, more, less))
        if not more:
            if (child := get(own + 1)) is not None:
                stack.append((child, at, 1, less))
        elif not less and own and (child := get(own - 1)) is not None:
            stack.append((child, at, more, 1))


def looks(word: str, vector: list[int], other: str, others: list[int]) -> bool:
    """Whether of two equally long words this one looks for the other: it meets its surplus first, or, where all counts are equal, is the smaller."""
    for a, b in zip(vector, others, strict=True):
        if a != b:
            return a < b
    return word < other


def one_edit(a: str, b: str) -> bool:
    """Whether b is a with one letter replaced, or with one more; b is as long as a or longer by one."""
    if a == b:
        return False
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def split_nodes(vectors: DataFrame, number: int, most: int = SHARD) -> tuple[set[tuple[int, ...]], dict[tuple[int, ...], int]]:
    """(nodes of the trie that hold more words than a shard, blocks of the leaves that still do), found level by level; vectors has a column v. There are at most words / most of them on a level, and only they come to the driver."""
    split: set[tuple[int, ...]] = set()
    level, rows = 1, vectors.select("v")
    while True:
        node = F.slice("v", 1, level)
        big = [(tuple(r["node"]), r["count"]) for r in rows.groupBy(node.alias("node")).count().filter(F.col("count") > most).collect()]
        if not big:
            return split, {}
        if level == number + 1:
            return split, {k: -(-n // most) for k, n in big}
        split.update(k for k, _ in big)
        names = vectors.sparkSession.createDataFrame([(",".join(map(str, k)),) for k, _ in big], "name string")
        rows = rows.join(F.broadcast(names) if len(big) <= 10_000 else names, F.concat_ws(",", F.transform(node, lambda x: x.cast("string"))) == F.col("name"), "left_semi")
        level += 1


def near_words(words: DataFrame, groups: int = GROUPS, most: int = SHARD) -> DataFrame:
    """(word, n_near, near_n, near) of every word of words (word, n) that has a near word: how many differ by one inserted, deleted or replaced letter, and the most frequent of these, ties to the smallest.

    The trie is cut at nodes of at most `most` words; its top, which says where, is small and goes to all tasks. A word goes to its own shard, and as a query to those that its search reaches. In a shard its words come first
    and are made a trie, through which the queries stream one by one. Words that agree in all counts and are too many for a shard lie in blocks, all of which a query visits. The words are distinct.
    """
    spark = words.sparkSession
    letters = letter_groups(words, groups)
    shape = spark.sparkContext.broadcast((letters, groups))

    def measured(rows: Iterator[tuple]) -> Iterator[tuple]:
        trie = Trie(*shape.value)
        for (word,) in rows:
            yield (trie.vector(word),)

    vectors = stored(map_streams(words.select("word"), measured, "v array<int>"), "vectors")
    top = spark.sparkContext.broadcast(split_nodes(vectors, groups, most))

    def dealt(rows: Iterator[tuple]) -> Iterator[tuple]:
        trie, (split, blocks) = Trie(*shape.value), top.value

        def name(node: tuple[int, ...], block: int) -> str:
            return ",".join(map(str, node)) + (f"/{block}" if block else "")

        for word, n in rows:
            vector, depth = trie.vector(word), 1
            while tuple(vector[:depth]) in split:
                depth += 1
            own = tuple(vector[:depth])
            yield name(own, zlib.crc32(word.encode()) % blocks.get(own, 1)), depth, -1, -1, word, n
            for node, more, less in visits(vector, split):
                for block in range(blocks.get(node, 1)):
                    yield name(node, block), len(node), more, less, word, n

    def met(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, trie, found = None, Trie(*shape.value), {}

        def better(a: tuple | None, n: int, word: str) -> tuple:
            return (1, n, word) if a is None else (a[0] + 1, *((n, word) if (-n, word) < (-a[1], a[2]) else a[1:]))

        for shard, depth, more, less, word, n in rows:
            if shard != now:
                yield from ((w, *x) for w, x in found.items())
                now, found, trie.root = shard, {}, []
            vector = trie.vector(word)
            if more < 0:
                trie.add(vector, word, n, depth)
                continue
            best, size = None, len(word)
            for leaf in search(trie.root, vector, depth, more, less):
                for other, m, others in leaf:
                    if one_edit(word, other) and (len(other) > size or looks(word, vector, other, others)):
                        best = better(best, m, other)
                        found[other] = better(found.get(other), n, word)
            if best:
                yield word, *best
        yield from ((w, *x) for w, x in found.items())

    sent = map_streams(words.select("word", "n"), dealt, "shard string, depth int, more int, less int, word string, n long")
    # words have more = -1, so they come before the queries of their shard
    parts = map_streams(sent.repartition("shard").sortWithinPartitions("shard", "more"), met, "word string, n_near long, near_n long, near string")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.max("near_n").alias("near_n"), F.min_by("near", F.struct(-F.col("near_n"), F.col("near"))).alias("near"))


def spelling_forms(words: DataFrame, factor: int = FACTOR, groups: int = GROUPS, most: int = SHARD, rounds: int = 70) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of words (word, n), distinct words without nulls: form is its most frequent near word (ties: the smallest in code-point order) if that is at least `factor` times as frequent, root the last
    form when forms are followed. A form is always more frequent than its word, so no chain returns; each round doubles the length that has been followed. An empty table stays empty.
    """
    words = stored(words, "words")
    near = near_words(words, groups, most)
    keeps = F.col("near_n") >= factor * F.col("n")
    found = words.join(near, "word", "left").select("word", F.when(keeps, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(keeps, F.col("near_n")).alias("form_n"))
    found = stored(found, "forms")
    links = stored(found.filter("form is not null").select("word", F.col("form").alias("root")), "links")
    for _ in range(rounds):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "links")
        links = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    else:
        raise RuntimeError(f"forms did not settle in {rounds} rounds")
    return found.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(table(spark, sf_dir, "documents"), "doc_id", "text")
    return spelling_forms(counts.filter(F.col("n") >= LEAST_COUNT))


#: Checksums by the usual table, one byte after another; near words by their deletions.
OP12_SQL = """with recursive poly(k, b, v) as (
  select 0, i, i from (select unnest(range(256)) i) union all
  select k + 1, b, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from poly where k < 8),
crc as materialized (select list(v order by b) t from poly where k = 8),
runs as (
  select coalesce(doc_id::varchar, '') d, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{C0}-\\x{FF}]+')) w from documents),
own as (select d, w, count(*) n from runs where length(w) >= 7 group by all),
summed as (
  select w, n, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, 1 + octet_length(encode(d || ':' || w))), lambda i: ('0x' || substr(hex(encode(d || ':' || w)), (2 * i - 1)::int, 2))::bigint)),
    lambda h, x: xor(h >> 8, t[1 + (xor(h, x) & 255)])), 4294967295) h from own, crc),
cut as (select case when h % 31 = 0 then substr(w, 1, (h % length(w))::int) || substr(w, (h % length(w))::int + 2) else w end w, n from summed),
words as materialized (select w, sum(n)::bigint n from cut where length(w) >= 7 group by w having sum(n) >= 2),
gone as materialized (select w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) g from (select w, n, unnest(range(1, length(w)::int + 1))::int i from words)),
pairs as (
  select a.w a, a.n an, b.w b, b.n bn from gone a join gone b on a.g = b.g and a.i = b.i and a.w <> b.w
  union select g.w, g.n, s.w, s.n from gone g join words s on g.g = s.w union select s.w, s.n, g.w, g.n from gone g join words s on g.g = s.w),
best as (select a w, count(*) n_near, max(bn) m, arg_min(b, (-bn, b)) f from pairs group by a),
forms as materialized (select w, n, coalesce(n_near, 0) n_near, case when m >= 10 * n then f end form, case when m >= 10 * n then m end form_n from words left join best using (w)),
chain(w, root) as (select w, w from forms union select c.w, f.form from chain c join forms f on f.w = c.root where f.form is not null),
roots as (select c.w, arg_max(c.root, x.n) root from chain c join words x on x.w = c.root group by c.w)
select w word, form, root, n, n_near, form_n from forms join roots using (w)"""
