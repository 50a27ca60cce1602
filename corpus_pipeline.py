"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last
return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import byte_bpe, language, line_crf, mixing, set_join
from lexweave.llm.common import discard, staged, table

SPARE = "lexweave source"
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of quality below the threshold; an empty table stays empty, and without labels all documents stay."""
    scored = line_crf.quality(docs, table(spark, sf_dir, "labels"), keep=True)
    return scored.where("predicted = 1").select("row.*")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which no language can be told; lang becomes the predicted one where it is missing.

    Where lang is given it stays: it is what the prediction was learned from.
    An empty table stays empty; where no row has a lang, nothing can be told
    and no document stays.
    """
    told = language.language_of(docs, keep=True).where("lang_pred <> 'und'")
    columns = [F.coalesce(F.col("row")["lang"], "lang_pred").alias("lang") if c == "lang" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return told.select(*columns)


def keyed(docs: DataFrame) -> DataFrame:
    """Rows (row, key): key orders rows by doc_id and tells apart rows that repeat an id with another text."""
    text = F.col("text").cast("string")
    return docs.select(F.struct("*").alias("row"), F.struct(F.col("doc_id"), F.xxhash64(text, F.octet_length(text))).alias("key"), text.alias("text"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of near copies the document of the smallest id (null first), of equal ids one of their texts.

    Texts without words are in no group and all stay. Rows that repeat both id
    and text are in one group; which of them stays doesn't matter but for
    other columns. An empty table stays empty.
    """
    rows = keyed(docs)
    groups = staged(set_join.jaccard_components(rows, id_col="key"))
    copies = groups.where("key <> component_id").select("key").distinct()
    left = rows.join(copies, "key", "left_anti")
    again = groups.where("n_shingles > 0 and key = component_id").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    if again.limit(1).count():
        repeated = left.join(again, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row"))
        left = left.join(again, "key", "left_anti").select("row").union(repeated.select("row"))
    return left.select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that sources meet their targets; rows that are equal but for other columns share their copies.

    Documents without words go, and so does all of an empty table.
    """
    rows = keyed(docs.withColumn(SPARE, F.col("source"))).select("row", F.struct("key", F.col("row")[SPARE].alias("source")).alias("key"), "text", F.col("row")[SPARE].alias("source"))
    copies = mixing.mix(rows, id_col="key").where("size > 0").groupBy("key").agg(F.sum("copies").cast("int").alias("copies"), F.count(F.lit(1)).alias("n"))
    copies = staged(copies)
    taken = rows.join(copies.where("n = 1 and copies > 0"), "key").select("row", "copies")
    again = copies.where("n > 1")
    if again.limit(1).count():
        repeated = rows.join(again.where("copies > 0"), "key").groupBy("key").agg(F.first("row").alias("row"), F.first("copies").alias("copies"))
        taken = taken.union(repeated.select("row", "copies"))
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*").drop(SPARE)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, as digests, and what they decode to; an empty table gives no rows."""
    return byte_bpe.encoding_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

#: SQL can express neither the classifiers nor the encoder; tests hold run() against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over documents; what a stage read is deleted once the next one's table is written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, sf_dir))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
