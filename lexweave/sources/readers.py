"""Readers: index records, leaf documents, page texts, page maps, markup, tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType, TimestampNTZType, TimestampType

from lexweave import schemas
from lexweave.session import scratch
from lexweave.sources.hocr_source import HocrSource


def hocr(spark: SparkSession, path: str, flush_at_end: bool = True, vol: str = r"(\d{2})[^/]*$", split: int = 64 << 20) -> DataFrame:
    """Paragraphs (vol, leaf, par_no, text) of OCR markup files, gzipped or not; `vol` is a pattern of paths whose group 1 is the volume.

    Filters on vol and leaf reach the reader: other volumes' files aren't
    opened, other leaves not parsed. Plain files are read in ranges of `split` bytes.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(HocrSource)
    return spark.read.format("hocr").options(vol=vol, split=split, flush=str(flush_at_end).lower()).load(path)


def page_map(spark: SparkSession, path: str) -> DataFrame:
    """(leaf, page_printed); of a leaf that occurs twice the last."""
    rows = spark.read.schema(schemas.PAGE_MAP).json(path, multiLine=True).select(F.posexplode("pages").alias("nth", "p"))
    last = F.row_number().over(Window.partitionBy("p.leafNum").orderBy(F.desc("nth")))
    return rows.withColumn("last", last).where("last = 1").select(F.col("p.leafNum").alias("leaf"), F.col("p.pageNumber").alias("page_printed"))


def index_records(spark: SparkSession, path: str, source: str = "regex") -> DataFrame:
    """JSON lines; blank lines go, a missing or null source becomes the default."""
    return spark.read.schema(schemas.INDEX_RECORD).json(path).withColumn("source", F.coalesce(F.nullif("source", F.lit("")), F.lit(source)))


def leaf_entries(spark: SparkSession, path: str) -> DataFrame:
    """A row for each entry of leaf documents, a JSON file a leaf; leaves without entries give none."""
    return leaf_documents(spark.read.schema(schemas.LEAF).json(path, multiLine=True))


def leaf_documents(leaves: DataFrame) -> DataFrame:
    """A row for each entry of leaf documents.

    Lists that are missing become empty ones; empty stats become null.
    entry_ordinal tells entries of one title on one leaf apart.
    """
    rows = leaves.select("vol", "leaf", "page_printed", F.col("window").alias("window_size"), "model", "note", F.regexp_extract("_metadata.file_path", r"[^/]*$", 0).alias("source_file"), F.posexplode("entries").alias("entry_ordinal", "e"))
    out = rows.select(*rows.columns[:-1], "e.*")
    return out.withColumn("cross_references", F.coalesce("cross_references", F.array().cast("array<string>"))).withColumn("stats", F.when(F.size("stats") > 0, F.col("stats")))


def page_texts(spark: SparkSession, path: str, pattern: str = r"(\d{2})_p(\d{4})\.txt$") -> DataFrame:
    """(vol, page, text), the key from the file's name; other files and blank pages go."""
    name = F.col("_metadata.file_path")
    rows = spark.read.text(path, wholetext=True).select(F.regexp_extract(name, pattern, 1).alias("vol"), F.regexp_extract(name, pattern, 2).alias("page"), F.col("value").alias("text"))
    return rows.where((F.col("vol") != "") & (F.trim("text") != "")).withColumn("page", F.col("page").cast("int"))


def web_payload(spark: SparkSession, path: str) -> DataFrame:
    """Entries of an exported web document as maps."""
    return spark.read.schema(schemas.WEB).json(path, multiLine=True).select(F.explode("entries").alias("entry"))


Fetch = Callable[[int, int], tuple[list[dict], bool]]


def _frame(rows: list[dict], shape: StructType) -> pd.DataFrame:
    """Rows as a frame, in which integers stay exact beside nulls and a column of nulls keeps its type."""
    columns = {f.name: pd.Series([r.get(f.name) for r in rows], dtype=object) for f in shape.fields}
    return pd.DataFrame({f.name: pd.to_datetime(columns[f.name]) if isinstance(f.dataType, TimestampType | TimestampNTZType) else columns[f.name] for f in shape.fields})


def paged(spark: SparkSession, fetch: Fetch, schema: str, page: int = 1000, tries: int = 4, total: int | None = None, stretch: int = 64) -> DataFrame:
    """Rows of a service that answers (offset, limit) with (rows, more); a page that fails `tries` times fails the read.

    Pages are fetched by the executors. With a known total each is a task's
    unit of work. Without one tasks follow `more` through stretches of so many
    pages, twice as many tasks each time until one has met the end, and write
    under the shared folder; so the service is asked beyond its end, where it
    must not fail, and what it says there is dropped.
    """

    def once(offset: int, limit: int) -> tuple[list[dict], bool]:
        for left in range(tries - 1, -1, -1):
            try:
                return fetch(offset, limit)
            except OSError:
                if not left:
                    raise
        raise AssertionError

    shape = spark.createDataFrame([], schema).schema
    if total is not None:

        def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for offset in batch["id"]:
                    yield _frame(once(int(offset), page)[0], shape)

        return spark.range(0, total, page, max(1, -(-total // page))).mapInPandas(pages, schema)
    path, start, width, tasks = scratch(spark), 0, page * stretch, 1
    noted = StructType([*shape.fields, StructField("_first", LongType()), StructField("_end", BooleanType())])

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in map(int, batch["id"]):
                offset, more = first, True
                while more and offset < first + width:
                    rows, more = once(offset, min(page, first + width - offset))
                    offset, more = offset + len(rows), more and bool(rows)
                    yield _frame(rows, shape).assign(_first=first, _end=False)
                if not more:
                    yield _frame([{}], shape).assign(_first=first, _end=True)

    end = None
    while end is None:
        spark.range(start, start + tasks * width, width, tasks).mapInPandas(follow, noted).write.mode("append").parquet(path)
        start, tasks = start + tasks * width, min(2 * tasks, 4096)
        end = spark.read.schema(noted).parquet(path).where("_end").agg(F.min("_first")).first()[0]
    return spark.read.schema(noted).parquet(path).where(~F.col("_end") & (F.col("_first") <= end)).select(shape.names)


def with_adapter(df: DataFrame, adapter: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Rows through an outside engine (recognition of page images, rendering, structured extraction), a batch at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield adapter(batch)

    return df.mapInPandas(run, schema)
