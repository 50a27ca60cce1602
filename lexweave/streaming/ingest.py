"""New leaf files as a stream; an extension beyond batch parity."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, path: str, schema: str, fmt: str = "json") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def once(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hand what is new to `each` and stop; what was handed on before isn't again."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def replace_leaves(path: str, keys: list[str], folders: int = 256) -> Callable[[DataFrame, int], None]:
    """For once(): a batch replaces the rows of each leaf (keys) that it holds, and no others.

    Leaves are dealt by a hash into as many folders as are named here, which
    a table keeps for good. A batch writes the folders that it has leaves of
    anew, with the rows of their other leaves, all before the first is put in
    place; so a load costs as many moves as folders, however many leaves there
    are, and reads and writes the whole of the folders it meets. A folder's new
    rows are moved there as its next generation, then the old one is deleted:
    a reader in between may see both, and the next load deletes what a crash
    has left. One writer at a time. A batch that is handed on again, as after
    a crash between the write and its checkpoint, gives the same table. Within
    a batch all rows of a leaf count, so a leaf's rows must come in one batch,
    as those of a file do.
    """

    def each(batch: DataFrame, _: int) -> None:
        spark, root = batch.sparkSession, path.rstrip("/")
        as_path = spark._jvm.org.apache.hadoop.fs.Path
        fs = as_path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(as_path(root))
        there = _generations(spark, root)
        marker = as_path(f"{root}/_folders-{folders}")
        if not fs.exists(marker):
            if there:
                raise ValueError(f"{path} was made with another number of folders than {folders}")
            fs.create(marker).close()
        folder = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(folders)).cast("int")
        batch = batch.persist()
        try:
            met = [r["f"] for r in batch.select(folder.alias("f")).distinct().collect()]  # a row a folder
            rows = batch
            if old := [f"{root}/_folder={f}/_generation={there[f]}" for f in met if f in there]:
                kept = spark.read.option("mergeSchema", "true").parquet(*old)
                leaves = batch.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
                same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
                rows = batch.unionByName(kept.join(leaves, same, "left_anti"), allowMissingColumns=True)
            beside = f"{root}/_next-{uuid.uuid4().hex}"
            rows.withColumn("_folder", folder).repartition("_folder").write.partitionBy("_folder").parquet(beside)
        finally:
            batch.unpersist()
        for f in met:
            at = f"{root}/_folder={f}"
            fs.mkdirs(as_path(at))
            if not fs.rename(as_path(f"{beside}/_folder={f}"), as_path(f"{at}/_generation={there.get(f, 0) + 1}")):
                raise OSError(f"can't put the new rows of {at} in place; it is as it was")
            if f in there:
                fs.delete(as_path(f"{at}/_generation={there[f]}"), True)
        fs.delete(as_path(beside), True)

    return each


def _generations(spark: SparkSession, root: str) -> dict[int, int]:
    """The generation of each folder; older ones, and folders that weren't put in place, are deleted."""
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = as_path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    out = {}
    for s in fs.listStatus(as_path(root)):
        name = s.getPath().getName()
        if name.startswith("_next-"):
            fs.delete(s.getPath(), True)
        elif name.startswith("_folder="):
            numbers = sorted(int(g.getPath().getName().split("=")[1]) for g in fs.listStatus(s.getPath()))
            for n in numbers[:-1]:
                fs.delete(as_path(f"{root}/{name}/_generation={n}"), True)
            if numbers:
                out[int(name.split("=")[1])] = numbers[-1]
        elif not name.startswith(("_", ".")):
            raise ValueError(f"{root} holds {name}, which is no folder of such a table")
    return out


def undone(batch: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Rows of a batch whose leaf isn't in the table yet; all where there is no table."""
    spark = batch.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return batch
    there = spark.read.schema(batch.schema).parquet(path).select(*keys).distinct()  # a folder's name alone would lose zeros before a number
    return batch.join(there, keys, "left_anti")


def windowed_counts(events: DataFrame, ts: str, key: str, width: str, late: str) -> DataFrame:
    """Counts by key and window, of events that are at most `late` behind; batch or stream."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(F.window(ts, width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")
