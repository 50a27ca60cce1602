"""Vectors as short codes by codebooks for each part of a vector (operator 12).

Components become integers, vectors are cut into parts, and equal parts of one
position are one weighted row: rounds of Lloyd's method run over these distinct
rows alone, with a task's sums combined before they meet. What goes to all
tasks is a codebook of fixed size. Codes and errors then join back to vectors:
parts and labels that hold a 256th of all rows or more (at most 256 of a
position) by a broadcast, so that no key gathers many rows in one task, all
others by a shuffle.

Integers are exact whatever their size: beyond 24 bits as Python's own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import discard, staged

EXACT = 1 << 24  # below this, squared distances of parts fit into 64 bits with much room
BLOCK = 4096  # distinct parts that are held against a codebook at once
HOT = 256
Book = np.ndarray  # entries x components


def integers(vector: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): 64-bit integers, or Python's where one is large."""
    with np.errstate(over="ignore"):
        found = np.floor(vector * scale)
    if not len(found) or np.abs(found).max() < EXACT:
        return found.astype(np.int64)
    return np.array([int(x) if np.isfinite(x) else int(y) * scale for x, y in zip(found, vector, strict=True)], object)


def packed_part(part: np.ndarray) -> bytes:
    """A first byte that tells how, then the part's integers."""
    if all(-EXACT < x < EXACT for x in part):
        return b"\0" + part.astype("<i8").tobytes()
    return b"\1" + ",".join(map(str, part)).encode()


def unpacked(parts: list[bytes], width: int) -> np.ndarray:
    if all(p[:1] == b"\0" for p in parts):
        return np.frombuffer(b"".join(p[1:] for p in parts), "<i8").reshape(len(parts), width)
    rows = [np.frombuffer(p, "<i8", offset=1).tolist() if p[:1] == b"\0" else list(map(int, p[1:].split(b","))) for p in parts]
    return np.array(rows, object).reshape(len(parts), width)


def cut_vectors(batches: Iterator[pa.RecordBatch], parts: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Rows (nth, vec_id, label, dim, parts); vectors that can't be cut into equal parts have none."""
    for batch in batches:
        dims, cut = [], []
        for v in batch.column("vector"):
            ints = integers(np.array(v.as_py(), np.float64), scale)
            dims.append(len(ints))
            cut.append(None if len(ints) % parts else [packed_part(p) for p in np.split(ints, parts)])
        columns = [batch.column("nth"), batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(cut, pa.list_(pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, ["nth", "vec_id", "label", "dim", "parts"])


def nearest(values: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray]:
    """For each value the index of its nearest entry (of equals the first) and the squared distance."""
    far = ((values[:, None, :] - book[None]) ** 2).sum(2) if values.shape[1] else np.zeros((len(values), len(book)), np.int64)
    at = np.argmin(far, 1)
    return at, far[np.arange(len(far)), at]


def by_position(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
    """(position, packed parts, their integers, their weights), a block at a time."""
    for batch in batches:
        pos, parts, weight = batch.column("pos").to_numpy(), batch.column("part").to_pylist(), batch.column("n").to_numpy()
        for p in np.unique(pos):
            rows = np.flatnonzero(pos == p)
            for start in range(0, len(rows), BLOCK):
                some = rows[start : start + BLOCK]
                held = [parts[i] for i in some]
                yield int(p), held, unpacked(held, width), weight[some]


def learned(distinct: DataFrame, books: list[Book], width: int) -> list[Book]:
    """The next codebooks: floors of weighted means; entries without a part stay."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list[int]] = {}
        for pos, _, values, weight in by_position(batches, width):
            at, _ = nearest(values, books[pos])
            heavy = values * weight[:, None].astype(values.dtype) if values.dtype == object or weight.max() < EXACT else values.astype(object) * weight[:, None].astype(object)
            for entry in np.unique(at):
                mine = at == entry
                new = [int(weight[mine].sum()), *map(int, heavy[mine].sum(0))]
                old = sums.get((pos, int(entry)))
                sums[pos, int(entry)] = [x + y for x, y in zip(old, new, strict=True)] if old else new
        rows = [(p, e, ",".join(map(str, s))) for (p, e), s in sums.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.string()))], ["pos", "entry", "sums"])

    def total(found: pa.Table) -> pa.Table:
        rows = [list(map(int, s.split(","))) for s in found.column("sums").to_pylist()]
        return pa.table({"pos": found.column("pos")[:1], "entry": found.column("entry")[:1], "sums": [",".join(str(sum(c)) for c in zip(*rows, strict=True))]}, schema=found.schema)

    shape = "pos int, entry int, sums string"
    out = [b.copy() for b in books]
    for row in distinct.mapInArrow(partial, shape).groupBy("pos", "entry").applyInArrow(total, shape).collect():  # a row an entry at most
        n, *sums = map(int, row["sums"].split(","))
        means = [s // n for s in sums]
        if any(abs(m) >= EXACT for m in means) and out[row["pos"]].dtype != object:
            out[row["pos"]] = out[row["pos"]].astype(object)
        out[row["pos"]][row["entry"]] = means
    return out


def coded(distinct: DataFrame, books: list[Book], width: int) -> DataFrame:
    """Rows (pos, part, n, entry, error); an error beyond 64 bits is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pos, parts, values, weight in by_position(batches, width):
            at, error = nearest(values, books[pos])
            errors = [int(e) if e < 1 << 63 else None for e in error]
            yield pa.RecordBatch.from_arrays([pa.array([pos] * len(at), pa.int32()), pa.array(parts, pa.binary()), pa.array(weight, pa.int64()), pa.array(at, pa.int32()), pa.array(errors, pa.int64())], ["pos", "part", "n", "entry", "error"])

    return distinct.mapInArrow(run, "pos int, part binary, n long, entry int, error long")


def spread_join(rows: DataFrame, values: DataFrame, keys: list[str], total: int) -> DataFrame:
    """rows with the columns of values, of which there is one (with its number n of rows) for each key of a row.

    Keys of a 256th of `total` rows or more, of which there can't be many, go
    to all tasks; so no task gets all rows of such a key.
    """
    hot = values.where(F.col("n") * HOT >= total).drop("n")
    cold = values.where(F.col("n") * HOT < total).drop("n")
    there = F.broadcast(hot.select(*keys))
    return rows.join(F.broadcast(hot), keys).unionByName(rows.join(there, keys, "left_anti").join(cold, keys))


def whole(total: Column) -> Column:
    """A sum as long; null where it needs more bits."""
    return total.try_cast("long")


def compressed(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """A row (vec_id, code, error, label_error, codebooks_sha256) for each vector that is whole and finite.

    The codebooks start as the parts of the vectors of the `entries` smallest
    ids (null last; of repeated ids the smaller vector first; all, if fewer).
    All vectors must have one length, that of the first of these, a multiple of
    `parts`; rows of other lengths stay, with null code and error, and count
    for nothing. An error beyond 64 bits is null, and then so is the error of
    its label; a label without any error has 0. Repeated rows are rows like
    others. An empty table gives no rows. Other columns are left out.
    """
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(x.isNotNull() & F.coalesce(finite, F.lit(False))).select(F.monotonically_increasing_id().alias("nth"), "vec_id", "label", "vector")
    kinds = {f.name: f.dataType for f in rows.schema}
    shape = f"nth long, vec_id {kinds['vec_id'].simpleString()}, label {kinds['label'].simpleString()}, dim int, parts array<binary>"
    kept = staged(rows.mapInArrow(lambda batches: cut_vectors(batches, parts, scale), shape))

    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "parts").limit(entries).collect()
    dim = first[0]["dim"] if first else 0
    width = dim // parts
    first = [r for r in first if r["dim"] == dim and r["parts"] is not None]
    books = [unpacked([bytes(r["parts"][p]) for r in first], width).copy() for p in range(parts)] if first else []

    whole_rows = kept.where((F.col("dim") == dim) & F.col("parts").isNotNull())
    cut = whole_rows.select("nth", F.posexplode("parts").alias("pos", "part"))
    distinct = staged(cut.groupBy("pos", "part").agg(F.count(F.lit(1)).alias("n")))
    for _ in range(rounds if first else 0):
        books = learned(distinct, books, width)
    digest = hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()

    values = staged(coded(distinct, books, width))
    discard(distinct)
    total = kept.count()
    found = spread_join(cut, values, ["pos", "part"], total).groupBy("nth").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "entry"))), lambda s: F.lower(F.lpad(F.hex(s["entry"]), 2, "0"))), "").alias("code"),
        F.when(F.count("error") == parts, whole(F.sum(F.col("error").cast("decimal(38,0)")))).alias("error"),
    )
    told = kept.select("nth", "vec_id", "label", F.coalesce(F.col("label").cast("string"), F.lit("")).alias("_label"), F.col("label").isNull().alias("_none"), ((F.col("dim") == dim) & F.col("parts").isNotNull()).alias("_counts"))
    told = staged(told.join(found, "nth", "left"))
    keys = ["_label", "_none"]
    lost = F.max((F.col("_counts") & F.col("error").isNull()).cast("int")) > 0
    by_label = told.groupBy(*keys).agg(F.when(~lost, whole(F.coalesce(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(0)))).alias("label_error"), F.count(F.lit(1)).alias("n"))
    out = spread_join(told, by_label, keys, total)
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
