"""Writers. A load replaces all or nothing; what is there already isn't done again."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside the target, then put it in the target's place, and the old one back if that fails.

    Between the two renames a reader finds no table; one that must never
    do so reads through current(), which follows replace_version().
    """
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.write.parquet(beside)
    jvm = spark._jvm
    target, new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, beside, beside + ".old"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    there = fs.exists(target)
    if there and not fs.rename(target, old):
        raise OSError(f"can't move {path} out of the way; its rows are as they were")
    if not fs.rename(new, target):
        if there:
            fs.rename(old, target)
        raise OSError(f"can't put {beside} in the place of {path}; its rows are as they were")
    fs.delete(old, True)


class Conflict(Exception):
    """Another writer has committed after the version that a commit was made from."""


def replace_version(df: DataFrame, path: str, base: int | None = None) -> int:
    """Write df as the next version of the table under `path`, and give its number.

    Rows go to a folder of their own; the version exists once its entry in the
    log does, which is moved there whole and never over another. So a writer
    that dies leaves a folder that nobody reads, and of two writers of one
    number one gets the next, or, if it names the `base` it was made from (0:
    none), an error. Moves without overwriting are as atomic as the file
    system's.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    data = f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{data}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    part, at = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{root}/_log/.{data}", f"{root}/{data}"))
    fs = part.getFileSystem(conf)
    out = fs.create(part, True)
    out.write(bytearray(data.encode()))
    out.close()
    number = base if base is not None else max(versions(spark, path), default=0)
    while True:
        number += 1
        try:
            files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), conf)
            never_over = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            files.rename(fs.makeQualified(part), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{root}/_log/{number:020d}")), never_over)
            return number
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            if base is not None:
                fs.delete(part, False)
                fs.delete(at, True)
                raise Conflict(f"version {number} of {path} is there already") from None


def versions(spark: SparkSession, path: str) -> dict[int, str]:
    """The folders of the committed versions."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_log")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    numbers = sorted(int(n) for n in names if n.isdigit())
    if not numbers:
        return {}
    rows = spark.read.text([f"{path.rstrip('/')}/_log/{n:020d}" for n in numbers]).select("value", F.element_at(F.split("_metadata.file_path", "/"), -1).cast("int").alias("n")).collect()  # a row a version
    return {r["n"]: f"{path.rstrip('/')}/{r['value']}" for r in rows}


def current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version under the folder, or one by number."""
    there = versions(spark, path)
    return spark.read.parquet(there[max(there) if version is None else version])


def clear_versions(spark: SparkSession, path: str, keep: int = 2, older_than: float = 86400) -> list[str]:
    """Delete all versions but the newest `keep`, and folders of no version that are older than so many seconds (younger ones may be of writers at work); their names."""
    jvm, root = spark._jvm, path.rstrip("/")
    there = versions(spark, path)
    gone = {n: f for n, f in there.items() if n not in sorted(there)[-keep:]}
    at = jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for n in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/_log/{n:020d}"), False)
    kept = {f.rsplit("/", 1)[-1] for n, f in there.items() if n not in gone}
    old = {f.rsplit("/", 1)[-1] for f in gone.values()}
    out = []
    for s in fs.listStatus(at):
        name = s.getPath().getName()
        if name.startswith("data-") and name not in kept and (name in old or s.getModificationTime() < (time.time() - older_than) * 1000):
            fs.delete(s.getPath(), True)
            out.append(name)
    return sorted(out)


def json_array(rows: DataFrame, order: list[str], *by: str) -> DataFrame:
    """One JSON array of objects for each group of rows, in order; a group's rows come into one task, as its array is one value."""
    item = F.struct(*[F.col(c) for c in order], F.to_json(F.struct(*[F.col(c) for c in rows.columns if c not in by])).alias("_json"))
    listed = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["_json"])
    return rows.groupBy(*by).agg(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("json"))


def applied(df: DataFrame, proposals: DataFrame, keys: list[str], apply: bool) -> DataFrame:
    """The proposals alone, or with apply df with their new values; proposals are rows (keys, column, new)."""
    if not apply:
        return proposals
    columns = [r["column"] for r in proposals.select("column").distinct().orderBy("column").collect()]  # names of columns
    for c in columns:
        new = proposals.where(F.col("column") == c).select(*keys, F.col("new").cast(df.schema[c].dataType).alias("_new"))
        df = df.join(new, keys, "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    return df


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def text_files(df: DataFrame, path: str, name: str, text: str, folders: int = 256) -> None:
    """A file for each row, named by it, in folders part-000 and so on by a hash of the name; null texts are empty files.

    Tasks write their files in place, so a task that runs again writes the
    same ones; unlike partitionBy, nothing is renamed by the driver file by file.
    """
    rows = df.select(F.format_string("part-%03d", F.pmod(F.xxhash64(name), F.lit(folders))).alias("_folder"), F.col(name).alias("_name"), F.coalesce(text, F.lit("")).alias("_text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
        made = set()
        for batch in batches:
            for folder, file, body in zip(*(batch.column(c).to_pylist() for c in ("_folder", "_name", "_text")), strict=True):
                if folder not in made:
                    system.create_dir(f"{root}/{folder}")
                    made.add(folder)
                with system.open_output_stream(f"{root}/{folder}/{file}") as f:
                    f.write(body.encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()  # one row


def json_by(df: DataFrame, path: str, *keys: str) -> None:
    """JSON lines in a folder for each key."""
    df.write.mode("overwrite").partitionBy(*keys).json(path)


def csv(df: DataFrame, path: str) -> None:
    """With a header; quoted only where needed, quotes doubled, null as nothing."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="")


def csv_line(columns: list[Column]) -> Column:
    """A CSV line as a column."""
    quoted = lambda c: F.when(c.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    return F.array_join(F.array(*[F.coalesce(quoted(c.cast("string")), F.lit("")) for c in columns]), ",")


def web_json(columns: dict[str, Column]) -> Column:
    """A JSON object without null, "" and empty lists; 0 and {} stay. Arrays are told by their type alone, so pass them by array_or_null()."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()]))


def array_or_null(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def text_windows(df: DataFrame, header: Column, parts: list[Column]) -> DataFrame:
    """A text a row: a commented header, then the parts that aren't null."""
    return df.select(F.concat_ws("\n", F.concat(F.lit("# "), header), *parts).alias("value"))


def not_done(targets: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return targets.join(done.select(*keys).distinct(), keys, "left_anti")


def report(known: DataFrame, sections: dict[str, Column]) -> DataFrame:
    """Rows (section, n) of a plain report: all rows, and those of each condition, counted in one pass."""
    counts = known.agg(F.count(F.lit(1)).alias("n0"), *[F.count_if(c).alias(f"n{k}") for k, c in enumerate(sections.values(), 1)])
    names = ["known", *sections]
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("section"), F.col(f"n{k}").alias("n")) for k, n in enumerate(names)])).alias("r")).select("r.*")
