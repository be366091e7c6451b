"""Source divergence: how the terms of each source differ from those of the other sources and of the whole language."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from orbitloom.llm.common import by_bytes, map_streams, release, stored, table

#: Least documents of a kept term, prefix lengths in bytes at which terms are tried before they are complete, and ranks of the terms that are told.
LEAST_DOCUMENTS, LEVELS, TOP = 10, (3, 6), 10
#: Bits of a filter of prefixes, and tasks that join the filters of many.
FILTER_BITS, FEW = 1 << 25, 8
#: Bytes of texts whose terms are counted at once, rows of an output batch, sources of a block of pairs, terms that meet at once, and sums of pairs that a task holds.
TEXT_BYTES, ROWS, SOURCES, TERMS, BLOCKS = 24 << 20, 100_000, 256, 512, 16
SCALE = 1_000_000_000
#: Ends a prefix that terms go on from; no term holds this byte.
MORE = b"*"

# Bytes of terms: letters of ASCII in lower case, and every byte of a longer character.
_TERMS = bytes(c if 97 <= c <= 122 or c >= 0x80 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


@dataclass
class Words:
    """The terms of some documents: each distinct one once, and for every occurrence its document and the place of its term."""

    distinct: pa.Array  # large_string
    document: np.ndarray
    term: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes | None]) -> Words:
        plain = pa.array([(t or b"").translate(_TERMS) for t in texts], pa.large_binary()).cast(pa.large_string())
        lists = pc.ascii_split_whitespace(plain)
        found = lists.flatten().dictionary_encode()
        term, document = found.indices.to_numpy(), np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        if (blank := pc.index(found.dictionary, "").as_py()) >= 0:  # before a first and after a last space
            document, term = document[term != blank], term[term != blank]
        return cls(found.dictionary, document, term)

    def kept(self, alive: np.ndarray) -> Words:
        """Only the occurrences of terms that are alive."""
        some = alive[self.term]
        return Words(self.distinct, self.document[some], self.term[some])

    def lengths(self) -> np.ndarray:
        return pc.binary_length(self.distinct).to_numpy()


def passing(bits: np.ndarray, lang: int, items: Iterable[bytes], number: int) -> np.ndarray:
    """Which items of a language (its checksum) the filter lets through."""
    at = np.fromiter((zlib.crc32(x, lang) for x in items), np.int64, number) % (8 * len(bits))
    return (bits[at >> 3] >> (at & 7) & 1).astype(bool)


def map_texts(docs: DataFrame, run: Callable[[list[pa.Array], list[bytes | None]], Iterator[list]], schema: str) -> DataFrame:
    """Work on many texts at once: run() gets the columns before the last and the last, the texts as UTF-8, of TEXT_BYTES of texts together or one longer text, and yields lists of output columns."""
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    by_bytes(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def made() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            texts = whole.column(whole.num_columns - 1).cast(pa.large_binary()).to_pylist()
            for columns in run([c.combine_chunks() for c in whole.columns[:-1]], texts):
                rows = pa.Table.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c.cast(t) for c, t in zip(columns, arrow.types, strict=True)], schema=arrow)
                yield from rows.to_batches(ROWS)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.column(batch.num_columns - 1).nbytes
            if size >= TEXT_BYTES:
                yield from made()
                held, size = [], 0
        if held:
            yield from made()
        held = []
        release()

    return docs.mapInArrow(task, schema)


def grouped(columns: list[pa.Array]) -> tuple[np.ndarray, list[tuple]]:
    """The place of each row's values among the distinct ones, and these."""
    found: dict[tuple, int] = {}
    at = np.array([found.setdefault(k, len(found)) for k in zip(*(c.to_pylist() for c in columns), strict=True)], np.int64)
    return at, list(found)


def filter_of(found: DataFrame) -> np.ndarray:
    """A filter of the rows (lang binary, item binary), of one size however many there are: each task sets bits, a few tasks join what others have set, the driver joins those few. Bits that two items share only let through more, never less."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for lang, item in rows:
            at = zlib.crc32(item, zlib.crc32(lang)) % FILTER_BITS
            bits[at >> 3] |= 1 << (at & 7)
        yield (zlib.compress(bits.tobytes(), 1),)

    def join(rows: Iterator[tuple]) -> Iterator[tuple]:
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for (more,) in rows:
            bits |= np.frombuffer(zlib.decompress(more), np.uint8)
        yield (zlib.compress(bits.tobytes(), 1),)

    total = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in map_streams(map_streams(found, run, "bits binary").repartition(FEW), join, "bits binary").collect():
        total |= np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return total


def surviving(docs: DataFrame, least: int, levels: tuple[int, ...]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, filter of complete terms, filter of prefixes) of each level; docs: (lang binary, text), a row a document.

    Iceberg refinement: the first prefixes of terms are counted by distinct documents, those in too few are discarded, the others are extended to the next length. A term no longer than a level's length is complete there; a longer one is
    in no more documents than each of its prefixes, so none that should be kept is lost. What is left goes to the tasks as filters of fixed size. Each level reads the texts again and counts only what passes.
    """
    spark = docs.sparkSession
    found: list[tuple[int, np.ndarray, np.ndarray]] = []
    for length in levels:
        known = spark.sparkContext.broadcast(found[-1] if found else None)

        def run(columns: list[pa.Array], texts: list[bytes | None], length=length, known=known) -> Iterator[list]:
            words = Words.of(texts)
            langs, names = grouped(columns)
            long = words.lengths() > length
            # prefixes are numbered anew, with a mark that tells them from terms that end there
            cut = pc.if_else(pa.array(long), pc.binary_join_element_wise(pc.binary_slice(words.distinct.cast(pa.binary()), 0, length), pa.scalar(MORE, pa.binary()), pa.scalar(b"", pa.binary())), words.distinct.cast(pa.binary())).dictionary_encode()
            item, number = cut.indices.to_numpy(), len(cut.dictionary)
            spoken = langs[words.document]
            for k, (lang,) in enumerate(names):
                own = np.flatnonzero(spoken == k)
                pairs = words.document[own] * np.int64(number) + item[words.term[own]]
                if known.value:
                    alive = np.zeros(len(words.distinct), bool)
                    some = np.unique(words.term[own])
                    some = some[words.lengths()[some] > known.value[0]]
                    alive[some] = passing(known.value[2], zlib.crc32(lang), (x[: known.value[0]] for x in words.distinct.cast(pa.binary()).take(pa.array(some)).to_pylist()), len(some))
                    pairs = pairs[alive[words.term[own]]]
                items, docs_of = np.unique(distinct(pairs) % number, return_counts=True) if len(pairs) else (pairs, pairs)
                yield [pa.array([lang] * len(items), pa.binary()), cut.dictionary.take(pa.array(items)), docs_of]

        sums = map_texts(docs, run, "lang binary, item binary, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))
        level = stored(sums.filter(F.col("n") >= least).select("lang", "item"), "level")
        ended = F.substring("item", -1, 1) != F.lit(MORE)
        found.append((length, filter_of(level.filter(ended)), filter_of(level.filter(~ended).select("lang", F.expr("substring(item, 1, length(item) - 1)").alias("item")))))
    return found


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def term_counts(docs: DataFrame, least: int = LEAST_DOCUMENTS, levels: tuple[int, ...] = LEVELS) -> tuple[DataFrame, DataFrame]:
    """(lang, term), stored, of the terms in at least `least` documents of a language, and (lang, source, term, count), stored, of these in each group in which they occur; docs: (lang binary, source binary, text), a row a document.

    The last level of the refinement: terms are complete, and those that the levels before let through are counted by document and occurrence in each group; both counts are exact, so what filters let through too much goes here.
    """
    known = docs.sparkSession.sparkContext.broadcast(surviving(docs.select("lang", "text"), least, levels))

    def run(columns: list[pa.Array], texts: list[bytes | None]) -> Iterator[list]:
        words = Words.of(texts)
        groups, names = grouped(columns)
        lengths, plain = words.lengths(), words.distinct.cast(pa.binary())
        number = np.int64(max(1, len(plain)))
        for lang in {k[0] for k in names}:
            own = np.flatnonzero(np.array([k[0] == lang for k in names])[groups[words.document]])
            alive = np.ones(len(plain), bool)
            before = 0
            some = np.unique(words.term[own])
            for k, (length, whole, prefixes) in enumerate(known.value):
                last = k + 1 == len(known.value)
                for bits, has, cut in ((whole, (lengths[some] > before) & (lengths[some] <= length), None), *(((prefixes, lengths[some] > length, length),) if last else ())):
                    at = some[has]
                    alive[at] = passing(bits, zlib.crc32(lang), (x[:cut] for x in plain.take(pa.array(at)).to_pylist()), len(at))
                before = length
            own = own[alive[words.term[own]]]
            if not len(own):
                continue
            keys, count = np.unique(groups[words.document[own]] * number + words.term[own], return_counts=True)
            once = distinct(words.document[own] * number + words.term[own])
            _, docs_of = np.unique(groups[once // number] * number + once % number, return_counts=True)  # of the same keys
            at = keys // number
            yield [pa.array([names[g][0] for g in at], pa.binary()), pa.array([names[g][1] for g in at], pa.binary()), plain.take(pa.array(keys % number)), docs_of, count]

    sums = map_texts(docs.select("lang", "source", "text"), run, "lang binary, source binary, term binary, docs long, count long").groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))
    sums = stored(sums, "candidates")
    kept = stored(sums.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least).select("lang", "term"), "kept")
    return kept, stored(sums.drop("docs").join(kept, ["lang", "term"], "left_semi"), "counts")


def shares(count: Column, n: Column, v: Column) -> Column:
    """p = 1 + floor(SCALE * (count + 2) / (n + 2 v)), exact at any size; n and v are 0 only where there is no term."""
    wide = lambda x: x.cast("decimal(38,0)")
    return (F.lit(1) + F.call_function("div", wide(F.lit(SCALE)) * wide(count + 2), F.greatest(wide(n) + 2 * wide(v), F.lit(1).cast("decimal(38,0)")))).cast("long")


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of integers in 1 to SCALE + 1, whose squares fit into 64 bits."""
    d = p - q
    return d * d // (p + q)


def pair_sums(rows: DataFrame, bases: dict[bytes, np.ndarray]) -> DataFrame:
    """(lang, i, j, value): for sources i and j of a language, by their places, the sum over the terms in rows of their divergence, less what each term would have if neither had it. rows: (lang binary, own array of (i, p)), one a term; bases: p of a
    missing term by source. Tasks sum terms together, blocks of sources at a time, and send sums."""
    sent = rows.sparkSession.sparkContext.broadcast(bases)

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        sums: dict[tuple[bytes, int, int], np.ndarray] = {}

        def flushed() -> Iterator[tuple]:
            for (lang, a, b), total in sums.items():
                for i, j in zip(*map(np.ndarray.tolist, np.nonzero(total)), strict=True):
                    yield lang, a * SOURCES + i, b * SOURCES + j, int(total[i, j])
            sums.clear()

        def meet(lang: bytes, some: list[list]) -> Iterator[tuple]:
            base = sent.value[lang]
            blocks = range(-(-len(base) // SOURCES))
            p: dict[int, np.ndarray] = {}
            for k, own in enumerate(some):
                for e in own:
                    a = e["i"] // SOURCES
                    if a not in p:
                        p[a] = np.repeat(base[None, a * SOURCES : (a + 1) * SOURCES], len(some), 0)
                    p[a][k, e["i"] % SOURCES] = e["p"]
            for a in blocks:
                for b in range(a, len(blocks)):
                    if a not in p and b not in p:
                        continue
                    ba, bb = base[a * SOURCES : (a + 1) * SOURCES], base[b * SOURCES : (b + 1) * SOURCES]
                    pa, pb = p.get(a, ba[None]), p.get(b, bb[None])
                    found = sums.setdefault((lang, a, b), np.zeros((len(ba), len(bb)), np.int64))
                    for i in range(len(ba)):
                        found[i] += (divergence(pa[:, i : i + 1], pb) - divergence(ba[i], bb)).sum(0)
            if len(sums) > BLOCKS:
                yield from flushed()

        held: dict[bytes, list] = {}
        for lang, own in rows:
            some = held.setdefault(lang, [])
            some.append(own)
            if len(some) >= TERMS:
                yield from meet(lang, some)
                held[lang] = []
        for lang, some in held.items():
            if some:
                yield from meet(lang, some)
        yield from flushed()

    return map_streams(rows, run, "lang binary, i int, j int, value long").groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def source_divergence(df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS, levels: tuple[int, ...] = LEVELS, top: int = TOP, most_groups: int = 100_000) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` is the divergence of a source from each other source of its language, over all kept terms; part `term` the `top` terms that are most above the language's own share.

    A term is kept for a language if at least `least` of its documents have it; each row is a document. Nulls are empty, empty and very long texts are counted whole, repeated rows count each, ties go by the UTF-8 bytes of the item. A group without
    terms is there all the same; a language without kept terms has pairs of value 0. An empty table gives no row. Other columns are not read. Groups (language, source) are known to the driver, and as every pair of a language's
    sources is a row of the result, more than `most_groups` of them are an error.
    """
    spark = df.sparkSession
    binary = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")
    docs = df.select(binary(lang).alias("lang"), binary(source).alias("source"), F.col(text).alias("text"))
    groups = docs.select("lang", "source").distinct().limit(most_groups + 1).collect()
    if len(groups) > most_groups:
        raise ValueError(f"more than {most_groups} groups of language and source")
    kept, counts = term_counts(docs, least, levels)
    sizes = {bytes(r["lang"]): r["v"] for r in kept.groupBy("lang").agg(F.count("*").alias("v")).collect()}
    totals = {(bytes(r["lang"]), bytes(r["source"])): r["n"] for r in counts.groupBy("lang", "source").agg(F.sum("count").alias("n")).collect()}
    names: dict[bytes, list[bytes]] = {}
    for g in sorted((bytes(r["lang"]), bytes(r["source"])) for r in groups):
        names.setdefault(g[0], []).append(g[1])
    share = lambda n, v: 1 + SCALE * 2 // max(n + 2 * v, 1)  # noqa: E731  of a term that isn't there
    bases = {x: np.array([share(totals.get((x, s), 0), sizes.get(x, 0)) for s in own], np.int64) for x, own in names.items()}
    known = [(bytearray(x), bytearray(s), i, totals.get((x, s), 0), sizes.get(x, 0)) for x, own in names.items() for i, s in enumerate(own)]
    known = spark.createDataFrame(known, "lang binary, source binary, i int, n long, v long")
    langs = spark.createDataFrame([(bytearray(x), sum(totals.get((x, s), 0) for s in own)) for x, own in names.items()], "lang binary, whole long")
    rows = counts.join(F.broadcast(known), ["lang", "source"]).withColumn("p", shares(F.col("count"), F.col("n"), F.col("v")))
    by_term = stored(rows.groupBy("lang", "term").agg(F.collect_list(F.struct("i", "p")).alias("own"), F.sum("count").alias("all"), F.first("v").alias("v")), "terms")
    # parts of terms by what the whole language has of them
    q = by_term.join(F.broadcast(langs), "lang").withColumn("q", shares(F.col("all"), F.col("whole"), F.col("v")))
    above = q.select("lang", "term", "q", F.inline("own")).filter("p > q").join(F.broadcast(known.select("lang", "i", "source")), ["lang", "i"])
    value = F.expr("((p - q) * (p - q)) div (p + q)")
    ranks = lambda rows: rows.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    term = ranks(above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))).filter(F.col("rank") <= top)
    sums = pair_sums(by_term.select("lang", "own"), bases)
    other = known.select("lang", F.col("i").alias("j"), F.col("source").alias("item"))
    # what all terms would give if no source had them, which every pair of sources begins with
    base = spark.createDataFrame([(bytearray(x), b.tolist()) for x, b in bases.items()], "lang binary, base array<long>")
    pairs = known.select("lang", "source", "i", "v").join(F.broadcast(other), "lang").filter("i <> j").join(F.broadcast(base), "lang")
    pairs = pairs.withColumns({"a": F.get("base", F.col("i")), "b": F.get("base", F.col("j")), "low": F.least("i", "j"), "high": F.greatest("i", "j")})
    sums = sums.withColumnsRenamed({"i": "low", "j": "high"})
    pairs = pairs.join(sums, ["lang", "low", "high"], "left").withColumn("whole", F.expr("v * (((a - b) * (a - b)) div (a + b)) + coalesce(value, 0L)"))
    pair = ranks(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.col("whole").alias("value")))
    text_of = lambda c: F.col(c).cast("string").alias(c)
    return pair.unionByName(term).select(text_of("lang"), text_of("source"), "part", text_of("item"), "value", F.col("rank").cast("int").alias("rank"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = """with d as (
  select row_number() over () id, coalesce(lang, '') lang, coalesce(source, '') source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
w as materialized (select id, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) term from d),
kept as materialized (select lang, term from w group by all having count(distinct id) >= 10),
size as (select lang, count(*) v from kept group by all),
counts as materialized (select lang, source, term, count(*) c from w join kept using (lang, term) group by all),
grp as (select g.lang, g.source, coalesce(n, 0) n, coalesce(v, 0) v from (select distinct lang, source from d) g left join (select lang, source, sum(c) n from counts group by all) t using (lang, source) left join size using (lang)),
per as materialized (
  select g.lang, g.source, k.term, coalesce(c, 0) c, (1 + 1000000000::hugeint * (coalesce(c, 0) + 2) // (g.n + 2 * g.v)::hugeint)::hugeint p from grp g join kept k using (lang) left join counts using (lang, source, term)),
whole as (
  select lang, term, (1 + 1000000000::hugeint * (sum(c)::hugeint + 2) // (t.n + 2 * t.v)::hugeint)::hugeint q from per join (select lang, sum(n)::hugeint n, max(v) v from grp group by all) t using (lang) group by lang, term, t.n, t.v),
pair as (
  select a.lang, a.source, 'pair' part, b.source item, coalesce(s.value, 0) as value from grp a join grp b on a.lang = b.lang and a.source <> b.source left join (
    select x.lang, x.source a, y.source b, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) as value from per x join per y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all) s
  on s.lang = a.lang and s.a = a.source and s.b = b.source),
term as (
  select per.lang, per.source, 'term' part, per.term item, (p - q) * (p - q) // (p + q) as value from per join whole using (lang, term) where c > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) r from (select * from pair union all select * from term) u)
select lang, source, part, item, value::bigint as value, r::int rank from ranked where part = 'pair' or r <= 10"""
