"""Substring search through postings of trigrams; what they find is verified on the folded text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions.text import search_fold

GRAM = 3


def _postings(batches: Iterator[pa.RecordBatch], most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """From (bucket, key, folded) rows (gram, bucket, keys), a gram of a bucket once for each stretch of texts of about `most` distinct grams."""

    def flush() -> pa.RecordBatch:
        code, row = np.concatenate(codes), np.concatenate(rows)
        of = bucket[row]
        order = np.lexsort((code, of))
        code, row, of = code[order], row[order], of[order]
        start = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (of[1:] != of[:-1])]) if len(code) else np.empty(0, int)
        grams = ["".join(chr(c >> s & 0x1FFFFF) for s in (42, 21, 0)) for c in code[start].tolist()]
        keys = pa.ListArray.from_arrays(pa.array(np.r_[start, len(code)], pa.int32()), batch.column("key").take(pa.array(row)))
        return pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(of[start], pa.int32()), keys], ["gram", "bucket", "keys"])

    for batch in batches:
        bucket, codes, rows, size = batch.column("bucket").to_numpy(), [], [], 0
        for i, text in enumerate(batch.column("folded")):
            a = np.frombuffer(text.as_py().encode("utf-32-le"), "<u4").astype(np.int64)
            codes.append(np.unique(a[:-2] << 42 | a[1:-1] << 21 | a[2:]))
            rows.append(np.full(len(codes[-1]), i))
            size += len(codes[-1])
            if size >= most:
                yield flush()
                codes, rows, size = [], [], 0
        if size:
            yield flush()


def build(df: DataFrame, key: str, text: Column, path: str, buckets: int = 64) -> None:
    """Write an index under the folder: folded texts by bucket of their key, postings (gram, bucket, keys) by range of grams, and how many texts hold a gram.

    A posting row holds keys of one bucket, so a frequent gram is at least as
    many rows as there are buckets: choose these by the number of texts. Null texts
    are found by nothing; keys must not repeat.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    rows = df.select(key, search_fold(text).alias("folded"), bucket.alias("bucket")).where("folded is not null")
    rows.limit(0).coalesce(1).write.parquet(f"{path}/shape")  # texts of no row leave no file to tell their columns
    rows.repartition(buckets, "bucket").write.partitionBy("bucket").parquet(f"{path}/texts")
    held = _texts(df.sparkSession, path).select("bucket", F.col(key).alias("key"), "folded")
    held = held.mapInArrow(_postings, f"gram string, bucket int, keys array<{df.schema[key].dataType.simpleString()}>")
    held.repartitionByRange("gram", "bucket").sortWithinPartitions("gram").write.parquet(f"{path}/postings")
    postings = df.sparkSession.read.parquet(f"{path}/postings")
    postings.groupBy("gram").agg(F.sum(F.size("keys")).alias("n")).repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/grams")


def _texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/shape").schema).parquet(f"{path}/texts")


def search(spark: SparkSession, path: str, key: str, needle: str, probes: int = 4, most: int = 256) -> DataFrame:
    """Keys of the texts of an index that hold the needle, whatever its case and marks.

    The rarest `probes` of its (first `most`) grams are looked up; only buckets
    in which a text has them all are read. A needle of fewer than three
    characters reads all texts; an empty one is in all.
    """
    texts = _texts(spark, path)
    folded = spark.range(1).select(search_fold(F.lit(needle))).first()[0]
    found = texts.where(F.col("folded").contains(folded)).select(key)
    grams = sorted({folded[i : i + GRAM] for i in range(len(folded) - GRAM + 1)})[:most]
    if not grams:
        return found
    counts = {r["gram"]: r["n"] for r in spark.read.parquet(f"{path}/grams").where(F.col("gram").isin(grams)).collect()}
    if len(counts) < len(grams):
        return found.limit(0)
    rarest = sorted(grams, key=lambda g: (counts[g], g))[:probes]
    hits = spark.read.parquet(f"{path}/postings").where(F.col("gram").isin(rarest)).select("bucket", F.explode("keys").alias(key))
    hits = hits.groupBy("bucket", key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(rarest))
    there = [r["bucket"] for r in hits.select("bucket").distinct().collect()]  # a row a bucket at most
    return texts.where(F.col("bucket").isin(there) & F.col("folded").contains(folded)).join(hits, ["bucket", key], "left_semi").select(key) if there else found.limit(0)
