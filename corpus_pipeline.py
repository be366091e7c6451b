"""Corpus pipeline: from documents to packed training sequences, each stage over all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitloom.llm.common import marked, stored, table
from orbitloom.llm.mixing import mixed
from orbitloom.llm.near_duplicates import BROADCAST_IDS, Join, keyed
from orbitloom.llm.packing import pack, pieces
from orbitloom.llm.personal_data import mask_personal_data
from orbitloom.llm.toxicity import THRESHOLD, fit, scored

#: Tokens that the mixing stage keeps, as a share of those it gets.
BUDGET = 0.9


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose score, by a classifier fitted to the labels, reaches the threshold. Null and empty texts are scored as empty, repeated rows alike; without labels every document stays."""
    model, score = fit(docs, table(spark, sf_dir, "labels")), marked(docs.columns) + "score"
    return scored(docs, "text", model, score).filter(F.col(score) < THRESHOLD).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked texts one row, that of the smallest doc_id. Texts without words and rows without an id are no one's duplicates; an id with several different texts has each of them judged by itself."""
    join = Join(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), 5, 80)
    groups, m = stored(join.result(tied=False), "groups"), marked(docs.columns)
    own = keyed(docs, "doc_id", "text", join.split, f"{m}key")
    gone = stored(groups.filter("first <> key").select("key").distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    kept = own.join(gone, own[f"{m}key"] == gone["key"], "left_anti")
    if not join.repeats:
        return kept.select(*docs.columns)
    twice = stored(groups.filter("n > 0 and key is not null").groupBy("key").count().filter("count > 1").select("key"), "twice")
    once = kept.join(twice, kept[f"{m}key"] == twice["key"], "left_semi").dropDuplicates([f"{m}key"])
    return kept.join(twice, kept[f"{m}key"] == twice["key"], "left_anti").unionByName(once).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in all texts by its kind and counts their characters anew, where documents have such a count; no document goes."""
    masked = mask_personal_data(docs, "text")
    return masked.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else masked


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents by probabilities that are calibrated to the target weights. Rows that repeat an id share its fate; a null source or language is a category of its own; documents without words in a cell without tokens stay."""
    m = marked(docs.columns)
    return mixed(docs, "text", docs.columns, budget=BUDGET, prefix=m).filter(f"{m}kept").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a piece: the sequence that holds it and its place there. A null or empty text is one piece of its end mark; repeated rows are packed each; ties in length go by id and content, and what ties there too is alike."""
    cut = pieces(docs, "text", public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])
    return pack(cut, ["doc_id", "start", "ids_crc32"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mixing", mixing), ("packing", packing)]

#: SQL expresses neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; what a stage returns is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = stored(docs, name) if k + 1 < len(STAGES) else docs
    return docs
