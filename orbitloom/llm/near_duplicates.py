"""N-gram Jaccard join by multiple global orders: candidates share prefix tokens under each of several token orders before they are verified."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitloom.llm.common import by_bytes, map_rows, marked, release, stored, table
from orbitloom.llm.components import components

#: Most tokens whose frequency class is known to the orders, and most that a task reports; they bound what is broadcast and shape only the cost, as any order gives the same links.
FREQUENT, TASK_FREQUENT = 500_000, 100_000
#: Tokens that a task counts before it forgets those it saw once.
TASK_TOKENS = 1_000_000
#: Most ids, or rows of a few numbers, that are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 250_000
#: Partners that meet one copy of a leading text.
PARTNERS = 250
#: Holders of a prefix token that are gathered in one list; tokens with more go by joins that can be split.
HOLDERS = 16
#: Holders of one hot token in a block; blocks meet one by one.
MEETING = 500
#: Bytes that are hashed at once, and the longest word whose sum of products fits into 64 bits.
SEGMENT, WHOLE = 1 << 16, 2_000

_RNG = np.random.default_rng(20240229)
_PRIME = (1 << 31) - 1
#: Letters of two independent polynomials modulo a prime: different numbers for different bytes, each under 2^21.
_LETTERS = [_RNG.permutation(np.arange(1, 1 << 21, dtype=np.uint64))[:256].copy() for _ in range(2)]
_BASES = [int(x) for x in _RNG.integers(1 << 20, _PRIME, 2)]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_WORD = np.uint64(0xD6E8FEB86659FD93)
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(base: int) -> np.ndarray:
    out = np.ones(SEGMENT, np.uint64)
    at = 1
    while at < SEGMENT:  # doubles what is known
        n = min(at, SEGMENT - at)
        out[at : at + n] = out[:n] * np.uint64(pow(base, at, _PRIME)) % np.uint64(_PRIME)
        at *= 2
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def _long_word(word: np.ndarray) -> list[int]:
    """Both polynomials of a word of any length."""
    out = []
    for letters, base, (power, _) in zip(_LETTERS, _BASES, _POWERS, strict=True):
        total = 0
        for at in range(0, len(word), WHOLE):
            part = word[at : at + WHOLE]
            total += int((letters[part] * power[: len(part)]).sum()) * pow(base, at, _PRIME)
        out.append(total % _PRIME)
    return out


def word_hashes(text: str) -> np.ndarray:
    """62-bit hashes, spread over 64 bits, of the words of a whole text, A-Z lower-cased, words ended by white space of ASCII. A word's hash is two polynomials of its bytes modulo a prime, at bases drawn once, so words that are built
    alike don't meet. They are read off running sums over segments that end at white space; a difference of sums modulo 2^64 is exact for a word of WHOLE bytes, and longer words are summed on their own."""
    if not _POWERS:
        _POWERS.extend((_powers(b), _powers(pow(b, -1, _PRIME))) for b in _BASES)
    data = np.frombuffer(text.encode().lower(), np.uint8)
    found, at = [], 0
    while at < len(data):
        part = data[at : at + SEGMENT]
        blank = _BLANK[part]
        if at + SEGMENT < len(data):
            if not blank.any():  # a word longer than a segment
                rest, end = at + SEGMENT, None
                while end is None:
                    ends = np.flatnonzero(_BLANK[data[rest : rest + SEGMENT]])
                    end = rest + int(ends[0]) if len(ends) else len(data) if rest + SEGMENT >= len(data) else None
                    rest += SEGMENT
                first, second = _long_word(data[at:end])
                found.append(np.array([first << 31 | second], np.uint64))
                at = end
                continue
            last = int(np.flatnonzero(blank)[-1]) + 1
            part, blank = part[:last], blank[:last]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]])))
        start, end = edges[::2], edges[1::2]
        own = []
        for letters, (power, inverse) in zip(_LETTERS, _POWERS, strict=True):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters[part] * power[: len(part)])])
            own.append((sums[end] - sums[start]) % np.uint64(_PRIME) * inverse[start] % np.uint64(_PRIME))
        h = own[0] << np.uint64(31) | own[1]
        for j in np.flatnonzero(end - start > WHOLE):
            first, second = _long_word(part[start[j] : end[j]])
            h[j] = first << 31 | second
        found.append(h)
        at += len(part)
    return mix(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of `width` words; of a shorter text its whole sequence as one; none without words."""
    words = word_hashes(text)
    n = min(width, len(words))
    if not n:
        return words
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix(out * _WORD + words[k : len(words) - n + 1 + k])
    return np.unique(out)


def least_overlap(n: int, percent: int) -> int:
    """Tokens that a set of n tokens must share with any set it links to."""
    return -(-percent * n // 100)


def least_shared(n: int, m: int, percent: int) -> int:
    """Tokens that the prefixes of two linked sets share under any order. The sets share at least `both` tokens, so at most n - both tokens of one aren't in the other; what its prefix has beyond those is shared, and lies in the other's prefix too."""
    both = -(-percent * (n + m) // (100 + percent))
    return min(both - least_overlap(n, percent), both - least_overlap(m, percent)) + 1


@dataclass
class Orders:
    """Global token orders: rare tokens first by the class of their frequency, within a class by a hash that differs from order to order."""

    tokens: np.ndarray  # sorted frequent tokens
    classes: np.ndarray  # their classes, 1 and more; all other tokens are of class 0

    def prefix(self, tokens: np.ndarray, order: int, length: int) -> np.ndarray:
        classes = np.zeros(len(tokens), np.int8)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
            classes = np.where(self.tokens[at] == tokens, self.classes[at], 0)
        return tokens[np.lexsort((mix(tokens + np.uint64(order)), classes))[:length]]


def sized(df: DataFrame) -> DataFrame:
    """A stored table, broadcast if it is short."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def longs(tokens: np.ndarray) -> list[int]:
    return tokens.view(np.int64).tolist()


def halves(tokens: np.ndarray) -> bytes:
    """The lower halves of tokens, sorted: equal tokens have equal halves, so a filter on them loses nothing."""
    return np.unique(tokens.astype("<u4")).tobytes()


def profiled(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, fingerprint) of each row, with each task's most frequent tokens in one more row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        names = ["id", "n", "fingerprint", "tokens", "counts"]
        known, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def merged() -> None:
            """Adds what is held to the tokens known, and of the others those that it holds twice."""
            nonlocal known, counts
            fresh = np.concatenate(held) if held else known[:0]
            held.clear()
            fresh.sort()
            first = np.flatnonzero(np.r_[True, fresh[1:] != fresh[:-1]]) if len(fresh) else np.zeros(0, np.int64)
            n = np.diff(np.r_[first, len(fresh)])
            fresh = fresh[first]
            at = np.minimum(np.searchsorted(known, fresh), max(0, len(known) - 1))
            hit = known[at] == fresh if len(known) else np.zeros(len(fresh), bool)
            counts[at[hit]] += n[hit]
            new = ~hit & (n > 1)
            known, counts = np.concatenate([known, fresh[new]]), np.concatenate([counts, n[new]])
            order = np.argsort(known, kind="stable")
            known, counts = known[order], counts[order]

        size = 0
        for batch in batches:
            rows: list[tuple] = []
            for at in range(0, batch.num_rows, 256):
                ids, texts = (c.slice(at, 256).to_pylist() for c in batch.columns)
                for id_, text in zip(ids, texts, strict=True):
                    s = shingles(text or "", width)
                    marks = np.array([mix(s + np.uint64(k)).sum(dtype=np.uint64) for k in (11, 12)], np.uint64).tobytes()
                    rows.append((id_, len(s), marks, None, None))
                    held.append(s)
                    size += len(s)
                    if size >= TASK_TOKENS:
                        merged()
                        size = 0
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], names=names)
        merged()
        top = np.argsort(-counts, kind="stable")[:TASK_FREQUENT]
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((None, None, None, known[top].tobytes(), counts[top].tobytes()), kinds, strict=True)], names=names)
        release()

    by_bytes(docs.sparkSession)
    return docs.select("id", "text").mapInArrow(run, "id long, n long, fingerprint binary, tokens binary, counts binary")


def frequent_orders(profiles: DataFrame) -> Orders:
    """Adds up what the tasks report and keeps the classes (powers of two) of the most frequent tokens, at most FREQUENT."""

    def make() -> Callable[[tuple], Iterable[tuple]]:
        return lambda row: zip(np.frombuffer(row[0], np.int64).tolist(), np.frombuffer(row[1], np.int64).tolist(), strict=True)

    found = map_rows(profiles.filter("tokens is not null").select("tokens", "counts"), make, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = stored(found.select("token", F.floor(F.log2("n")).cast("int").alias("class")), "frequent")
    sizes = {r["class"]: r["count"] for r in found.groupBy("class").count().collect()}
    least, total = 64, 0
    for c in sorted(sizes, reverse=True):
        total += sizes[c]
        if total > FREQUENT:
            break
        least = c
    rows = found.filter(F.col("class") >= least).toArrow()  # at most FREQUENT rows
    tokens = rows.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return Orders(tokens[order], rows.column("class").to_numpy().astype(np.int8)[order])


def keyed(df: DataFrame, id_: str, text: str, split: DataFrame | None, name: str) -> DataFrame:
    """df with a column that tells rows apart by id, and, where one id has different texts, by id and text."""
    if split is None:
        return df.withColumn(name, F.col(id_).cast("long"))
    m = marked(df.columns)
    own = df.join(split.withColumn(f"{m}split", F.lit(True)).withColumnRenamed("id", f"{m}id"), F.col(id_).cast("long") == F.col(f"{m}id"), "left")
    return own.withColumn(name, F.when(F.col(f"{m}split"), F.xxhash64(F.col(id_).cast("long"), F.col(text))).otherwise(F.col(id_).cast("long"))).drop(f"{m}id", f"{m}split")


class Join:
    """One run of the join over docs (id, text). A text's key is its id, or a hash of id and text for ids that have different texts; `split` holds those ids, if there are any."""

    def __init__(self, docs: DataFrame, width: int, percent: int):
        docs = docs.select("id", "text")
        self.width, self.percent = width, percent
        profiles = stored(profiled(docs, width), "profiles")
        rows = profiles.filter("tokens is null").select("id", "n", "fingerprint")
        self.orders = docs.sparkSession.sparkContext.broadcast(frequent_orders(profiles))
        repeated = rows.filter("id is not null").groupBy("id").agg(F.count("*").alias("rows"), F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high")).filter("rows > 1")
        repeated = stored(repeated.select("id", (F.col("low") != F.col("high")).alias("split")), "repeated")
        #: Whether several rows have one id.
        self.repeats = not repeated.isEmpty()
        split = repeated.filter("split").select("id")
        self.split = None if split.isEmpty() else split
        own = keyed(docs, "id", "text", self.split, "key")
        self.docs = own.select(F.col("key").alias("id"), "text")
        #: (key, id, n, fingerprint) of each row.
        self.rows = rows.withColumn("key", F.col("id"))
        if self.split is not None:
            again = profiled(own.join(split, "id", "left_semi").select(F.col("key").alias("id"), "text"), width).filter("tokens is null").withColumnRenamed("id", "key").select("key", "n", "fingerprint")
            ids = own.join(split, "id", "left_semi").select("key", "id").distinct()
            self.rows = stored(self.rows.join(split, "id", "left_anti").unionByName(again.join(ids, "key")), "rows")
        #: Documents with equal sets are one class; its least key represents it.
        self.classes = stored(self.rows.filter("n > 0 and key is not null").groupBy("fingerprint", "n").agg(F.min("key").alias("rep")), "classes")

    def prefixes(self) -> DataFrame:
        """(rep, n, prefix, second, third): the prefixes of each representative under three orders, of the second and third the halves."""
        width, percent, orders = self.width, self.percent, self.orders

        def make() -> Callable[[tuple], Iterable[tuple]]:
            def row(values: tuple) -> Iterable[tuple]:
                s = shingles(values[1] or "", width)
                if len(s) and values[0] is not None:
                    length = len(s) - least_overlap(len(s), percent) + 1
                    first, second, third = (orders.value.prefix(s, k, length) for k in (1, 2, 3))
                    yield values[0], len(s), longs(first), halves(second), halves(third)

            return row

        own = self.rows.withColumnsRenamed({"fingerprint": "f", "n": "m"})
        copies = stored(own.join(self.classes, (F.col("f") == F.col("fingerprint")) & (F.col("m") == F.col("n"))).filter("key <> rep").select(F.col("key").alias("id")).distinct(), "copies")
        schema = "id long, n long, prefix array<long>, second binary, third binary"
        if copies.count() <= BROADCAST_IDS:
            found = map_rows(self.docs.join(F.broadcast(copies), "id", "left_anti"), make, schema)
        else:
            found = map_rows(self.docs, make, schema).join(copies, "id", "left_anti")
        if self.repeats:  # a representative's text may stand in several rows
            twice = stored(self.rows.filter("n > 0").groupBy("key").count().filter("count > 1").join(self.classes, F.col("key") == F.col("rep"), "left_semi").select(F.col("key").alias("id")), "twice")
            once = found.join(twice, "id", "left_semi").groupBy("id").agg(*(F.first(c).alias(c) for c in ("n", "prefix", "second", "third")))
            found = found.join(twice, "id", "left_anti").unionByName(once)
        return found.select(F.col("id").alias("rep"), "n", "prefix", "second", "third")

    def may_link(self, n: str, pos: str, m: str, at: str) -> Column:
        """The first common token of two prefixes leaves enough tokens behind it in both sets."""
        need = F.expr(f"{self.percent} * ({n} + {m})")
        return F.expr(f"{n} * 100 >= {self.percent} * {m} and {m} * 100 >= {self.percent} * {n}") & (F.expr(f"least({n} - {pos}, {m} - {at})") * (100 + self.percent) >= need)

    def met(self, pairs: DataFrame, data: DataFrame, columns: list[str], test: Callable[[tuple, tuple], bool]) -> DataFrame:
        """(lead, member): the pairs for which test(lead's values, member's values) holds, of the columns of data (id, ...).

        What data holds is dealt by lead, each block of PARTNERS members with a copy of the lead's values, and streams past
        it in order, so a task holds two rows however many members a lead has.
        """
        counts = pairs.groupBy("lead").agg(F.ceil(F.count("*") / PARTNERS).alias("blocks"))
        members = pairs.join(counts, "lead").select("lead", F.pmod(F.xxhash64("member"), "blocks").alias("block"), F.col("member").alias("id"), F.lit(1).alias("place"))
        leads = counts.select("lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.col("lead").alias("id"), F.lit(0).alias("place"))
        rows = stored(members.unionByName(leads), "pairs")
        rows = F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows
        dealt = data.join(rows, "id").repartition("lead", "block").sortWithinPartitions("lead", "block", "place").select("lead", "block", "place", "id", *columns)

        def make() -> Callable[[tuple], Iterable[tuple]]:
            key, first = None, ()

            def row(values: tuple) -> Iterable[tuple]:
                nonlocal key, first
                lead, block, place, id_, *own = values
                if not place:
                    key, first = (lead, block), prepared(own)
                elif key == (lead, block) and test(first, prepared(own)):
                    yield lead, id_

            return row

        prepared = self.prepared(columns)
        return stored(map_rows(dealt, make, "lead long, member long").distinct(), "met")

    def prepared(self, columns: list[str]) -> Callable[[list], tuple]:
        width = self.width
        if columns == ["text"]:
            return lambda values: (shingles(values[0] or "", width),)
        return lambda values: (values[0], *(np.frombuffer(v, "<u4") for v in values[1:]))

    def verified(self, pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
        """(a, b): the linked ones of pairs (lead, member), which occur once each. They must share as many prefix tokens as linked sets do under the second and the third order as well; for those that do, the whole sets are compared."""
        percent = self.percent

        def share(p: np.ndarray, q: np.ndarray) -> int:
            return len(np.intersect1d(p, q, assume_unique=True))

        def linked(a: tuple, b: tuple) -> bool:
            both = share(a[0], b[0])
            return both * 100 >= percent * (len(a[0]) + len(b[0]) - both)

        def close(a: tuple, b: tuple) -> bool:
            n, m = a[0], b[0]
            length = n - least_overlap(n, percent) + 1
            # halves of one prefix that happen to be equal count once, so as many may be missing
            return all(share(p, q) >= least_shared(n, m, percent) - (length - len(p)) for p, q in zip(a[1:], b[1:], strict=True))

        near = self.met(pairs, prefixes.select(F.col("rep").alias("id"), "n", "second", "third"), ["n", "second", "third"], close)
        found = self.met(near, self.docs, ["text"], linked)
        return found.select(F.least("lead", "member").alias("a"), F.greatest("lead", "member").alias("b"))

    def links(self) -> DataFrame:
        """(a, b) between representatives: enough of the links for every connection.

        First each prefix token leads its holders to the one that has it earliest, so that large groups of near copies grow
        together by a number of pairs that is linear in them. Then all candidate pairs between different groups are
        verified, which leaves out only pairs that are connected already.
        """
        prefixes = stored(self.prefixes(), "prefixes")
        entries = prefixes.select("rep", "n", F.posexplode("prefix").alias("pos", "token"))
        often = entries.groupBy("token").agg(F.count("*").alias("holders")).filter("holders > 1")
        shared = stored(entries.join(often, "token"), "shared")
        hot = shared.filter(F.col("holders") > HOLDERS)
        lists = stored(shared.filter(F.col("holders") <= HOLDERS).groupBy("token").agg(F.array_sort(F.collect_list(F.struct("pos", "rep", "n"))).alias("held")), "lists")

        def oriented(pairs: DataFrame) -> DataFrame:
            once = pairs.groupBy(F.least("lead", "member").alias("a"), F.greatest("lead", "member").alias("b")).agg(F.min("lead").alias("lead"))
            return once.select("lead", (F.col("a") + F.col("b") - F.col("lead")).alias("member"))

        # each holder with the one that has the token earliest
        leads = sized(stored(hot.groupBy("token").agg(F.min(F.struct("pos", "rep", "n")).alias("x")), "leads"))
        led = hot.join(leads, "token").select("x", F.struct("pos", "rep", "n").alias("y"))
        led = led.unionByName(lists.select(F.get("held", F.lit(0)).alias("x"), F.explode("held").alias("y")))
        led = led.filter("x.rep <> y.rep").filter(self.may_link("x.n", "x.pos", "y.n", "y.pos")).select(F.col("x.rep").alias("lead"), F.col("y.rep").alias("member"))
        first = self.verified(stored(oriented(led), "led"), prefixes)
        groups = stored(components(first).select("node", "component"), "groups")

        # all pairs of holders between different groups
        named = hot.join(groups, F.col("rep") == F.col("node"), "left").select("token", F.struct("pos", "rep", "n").alias("x"), F.coalesce("component", "rep").alias("c"))
        named = stored(named, "hot")
        mixed = named.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.ceil(F.count("*") / MEETING).alias("blocks")).filter("low <> high")
        open_ = named.join(sized(stored(mixed.select("token", "blocks"), "mixed")), "token").withColumn("own", F.pmod(F.xxhash64("x.rep"), "blocks"))
        # a token's holders are dealt to blocks; each block meets each, so no task gets more than two blocks of a token
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        ones = open_.select("token", F.col("own").alias("left"), each.alias("right"), "x", "c")
        others = open_.select("token", each.alias("left"), F.col("own").alias("right"), F.col("x").alias("y"), F.col("c").alias("d"))
        crossing = ones.join(others, ["token", "left", "right"]).filter("c < d").select("x", "y")
        every = lists.select(F.posexplode("held").alias("i", "x"), "held").select("x", F.explode(F.slice("held", F.col("i") + 2, F.lit(HOLDERS))).alias("y"))
        pairs = crossing.unionByName(every).filter("x.rep <> y.rep").filter(self.may_link("x.n", "x.pos", "y.n", "y.pos"))
        pairs = pairs.select(F.least("x.rep", "y.rep").alias("lead"), F.greatest("x.rep", "y.rep").alias("member")).distinct()
        for side in ("lead", "member"):
            pairs = pairs.join(groups.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}")), side, "left")
        pairs = pairs.filter(F.coalesce("c_lead", "lead") != F.coalesce("c_member", "member")).select("lead", "member")
        second = self.verified(stored(pairs, "crossing"), prefixes)
        return first.unionByName(second)

    def result(self, tied: bool = True) -> DataFrame:
        """(key, id, n, component, first) of each row: the least id of its group and the key of that group's row of least id and key; rows of one id are one document if tied.
        Without words a row is a group of its own, without an id it has none."""
        links = self.links()
        if self.split is not None and tied:
            keys = self.rows.filter("n > 0").join(self.split, "id", "left_semi").join(self.classes, ["fingerprint", "n"]).select("id", "rep").distinct()
            links = links.unionByName(keys.join(keys.groupBy("id").agg(F.min("rep").alias("a")), "id").select("a", F.col("rep").alias("b")))
        groups = components(links)
        classes = self.classes.join(groups, F.col("rep") == F.col("node"), "left").select(F.col("fingerprint").alias("f"), F.col("n").alias("size"), F.coalesce("component", "rep").alias("group"))
        # a class may hold a third of all rows: its rows are dealt by id, and joined by fingerprint only where Spark can split the join
        joined = self.rows.join(classes, (self.rows["fingerprint"] == F.col("f")) & (F.col("n") == F.col("size")), "left")
        named = F.col("n") > 0
        if self.split is None:  # keys are ids
            joined = joined.withColumns({"least": F.col("group"), "first": F.col("group")})
        else:
            joined = stored(joined, "grouped")
            least = joined.filter("n > 0 and id is not null").groupBy("group").agg(F.min(F.struct("id", "key")).alias("x"))
            joined = joined.join(least.select(F.col("group").alias("g"), F.col("x.id").alias("least"), F.col("x.key").alias("first")), F.col("group") == F.col("g"), "left")
        own = lambda c, alone: F.when(named, F.when(F.col("id").isNotNull(), F.col(c))).otherwise(F.col(alone)).alias("component" if c == "least" else c)
        return joined.select("key", "id", "n", own("least", "id"), own("first", "key"))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs (id long, text): per row id, n (distinct shingles of `width` words of the whole text) and component, the least id that is reached by
    links; two documents link when 100 * shared >= percent * union. Null, empty and blank texts have no shingles and link with nothing; a null id
    has no component; rows that repeat an id are one document, which links where one of its texts does (a row without words is left alone);
    other columns don't matter. An empty table gives no rows. A chain of links too long for 50 rounds of components() raises an error, after rounds that double its reach."""
    return Join(docs, width, percent).result().select("id", "n", "component")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    found = jaccard_components(docs, 3, 90)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


#: DuckDB SQL for the rows of op3_jaccard_join, by all pairs that share a shingle.
OP3_SQL = """with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w from documents),
sets as (
  select doc_id, case when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) when len(w) > 0 then [array_to_string(w, ' ')] else [] end s from words),
items as materialized (select doc_id, len(s) n, unnest(s) x from sets),
links as materialized (
  select a.doc_id a, b.doc_id b from items a join items b on a.x = b.x and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach(doc_id, other) as (select doc_id, doc_id from sets union select r.doc_id, l.b from reach r join links l on l.a = r.other)
select s.doc_id, len(s.s) n_shingles, r.least component_id from sets s join (select doc_id, min(other) least from reach group by 1) r using (doc_id)"""
