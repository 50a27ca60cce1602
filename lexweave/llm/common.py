"""Helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import struct
import tempfile
import uuid
from collections.abc import Callable, Collection, Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Words are runs of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
ENTRY = 210  # bytes that a remembered key and value take besides their own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, text_col: str) -> DataFrame:
    """Rows (row, text): the whole row as a struct, whatever its columns are called, and its text beside it."""
    return docs.select(F.struct("*").alias("row"), docs[text_col].cast("string").alias("text"))


def mapped(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """df.mapInArrow(). Batches are as large as the session says (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB by default); slices() cuts them further within the worker."""
    return df.mapInArrow(run, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only in local mode."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lexweave-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame) -> DataFrame:
    """Write df as Parquet under the shared folder and read it back: its lineage ends there, so lost executors cost no rework.

    Unlike a checkpoint this runs the last step once, and empty partitions leave no files.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/lexweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*frames: DataFrame) -> None:
    """Delete the files of staged() frames that nothing still to be computed reads."""
    for df in frames:
        if path := _paths.pop(df, None):
            jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on between tasks, and keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20, most_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about most_bytes of the text column (or one row); then give memory back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and (held + n > most_bytes or i - start >= most_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)
    give_back()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), component the smallest node.

    Alternates minimum-label propagation with pointer jumping; every round is
    a few joins on the edge list and is cut through the shared folder. Nodes
    without an edge don't appear. Minimum labels combine before the shuffle,
    so a node with very many edges costs no long task.
    """
    both = edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).where("src <> dst")
    both = staged(both.union(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = staged(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.first("src")).alias("label")))
    while True:
        near = both.join(labels, both.dst == labels.node).groupBy("src").agg(F.min("label").alias("near"))
        stepped = labels.join(near, labels.node == near.src).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("up"), F.col("label").alias("jump"))
        stepped = stepped.join(up, stepped.label == up.up, "left").select("node", "old", F.least("label", F.coalesce("jump", "label")).alias("label"))
        stepped = staged(stepped)
        discard(labels)
        if not stepped.where("old <> label").limit(1).count():
            discard(both)
            return stepped.select("node", F.col("label").alias("component"))
        labels = stepped


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers in as many bytes each as the largest needs above the smallest, which stand before."""
    low, high = (int(values.min()), int(values.max())) if len(values) else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if high - low < 1 << 8 * w)
    return struct.pack("<qbq", low, width, len(values)) + (values.astype(np.int64) - low).astype(f"<u{width}").tobytes()


def wide(data: bytes, count: int) -> list[np.ndarray]:
    """So many arrays of narrow(), one after another."""
    out, at = [], 0
    for _ in range(count):
        low, width, n = struct.unpack_from("<qbq", data, at)
        out.append(np.frombuffer(data, f"<u{width}", n, at + 17).astype(np.int64) + low)
        at += 17 + width * n
    return out


def runs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows with equal values of integer columns."""
    for batch in batches:
        if batch.num_rows:
            keys = np.stack([batch.column(c).to_numpy() for c in columns])
            start = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0)])
            for s, e in zip(start, np.r_[start[1:], batch.num_rows], strict=True):
                yield tuple(keys[:, s].tolist()), batch.slice(s, e - s)


class Recent:
    """Values of keys in two generations of about `most_bytes` each: of the older one stay the keys that are asked for again."""

    def __init__(self, most_bytes: int):
        self.most_bytes, self.held = most_bytes, 0
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def age(self) -> None:
        if self.held > self.most_bytes:
            self.before, self.now, self.held = self.now, {}, 0

    def keep(self, keys: Collection[str], values: Collection[bytes]) -> None:
        self.now.update(zip(keys, values, strict=True))
        self.held += ENTRY * len(keys) + sum(map(len, keys)) + sum(map(len, values))

    def unknown(self, keys: set[str]) -> list[str]:
        """The keys without a value; the values of all others are in `now` from here on."""
        new = keys.difference(self.now)
        before = self.before
        again = [k for k in new if k in before]  # an intersection would walk through all that is kept
        self.keep(again, list(map(self.before.__getitem__, again)))
        return list(new.difference(again))
