"""Exact top-k inner products by a bit-sliced index (operator 8).

A block of rows is held as bitmaps: one for each component and binary digit of
the components' values. A query's scores are sums of these bitmaps, each at the
place value of its digit times a digit of the query's component; components
under a negative weight enter as complements. Carry-save adders, three bitmaps
to two, add all bitmaps of a place value at once. From the most significant
slice of the sums downward, rows are split into those sure to be among the
best, those still tied, and the rest; ties at the boundary are exact ties and
go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantised(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component; null for a null vector and one with null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


class Block:
    """Bit slices of the rows of an integer matrix, in the order of their ids."""

    def __init__(self, ids: np.ndarray, slices: np.ndarray, low: np.ndarray):
        self.ids, self.slices, self.low = ids, slices, low

    @staticmethod
    def build(ids: np.ndarray, values: np.ndarray) -> Block:
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        low = values.min(0)
        bits = max(1, int((values.max(0) - low).max()).bit_length())
        words = -(-len(ids) // 64)
        padded = np.zeros((words * 64, values.shape[1]), np.int64)
        padded[: len(ids)] = values - low
        slices = np.empty((values.shape[1], bits, words), np.uint64)
        for b in range(bits):
            slices[:, b] = np.ascontiguousarray(np.packbits((padded.T >> b) & 1, axis=1, bitorder="little")).view(np.uint64)
        return Block(ids, slices, low)

    def sums(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """Slices of a sum for each row that is its score plus a constant, and that constant."""
        dims, bits, words = self.slices.shape
        flat = self.slices.reshape(dims * bits, words)
        full = (1 << bits) - 1
        weight = np.abs(query)
        # score = sum q x;  x = low + x', and for q < 0: q x' = |q| (full - x') - |q| full
        constant = int((weight[query < 0] * full).sum() - (query * self.low).sum())
        places: list[list[np.ndarray]] = []
        for digit in range(int(weight.max(initial=0)).bit_length()):
            used = np.flatnonzero(weight >> digit & 1)
            flip = np.where(query[used] < 0, ~np.uint64(0), np.uint64(0))[:, None]
            for b in range(bits):
                while len(places) <= digit + b:
                    places.append([])
                if len(used):
                    places[digit + b].append(flat[used * bits + b] ^ flip)
        out, at = [], 0
        while at < len(places):
            maps = np.concatenate(places[at]) if places[at] else np.zeros((1, words), np.uint64)
            while len(maps) > 1:
                third = len(maps) // 3
                if third:
                    a, b, c = maps[:third], maps[third : 2 * third], maps[2 * third : 3 * third]
                    half = a ^ b
                    carry = (a & b) | (half & c)
                    rest = maps[3 * third :]
                    half ^= c
                    maps = np.concatenate([half, rest]) if len(rest) else half
                else:
                    carry = maps[:1] & maps[1:]
                    maps = maps[:1] ^ maps[1:]
                if at + 1 == len(places):
                    places.append([])
                places[at + 1].append(carry)
            out.append(maps[0])
            at += 1
        return (np.stack(out) if out else np.zeros((1, words), np.uint64)), constant

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those of id own; all, if fewer."""
        sums, constant = self.sums(query)
        n = len(self.ids)
        tied = np.packbits(self.ids != own, bitorder="little")
        tied = np.concatenate([tied, np.zeros(sums.shape[1] * 8 - len(tied), np.uint8)]).view(np.uint64)
        sure = np.zeros_like(tied)
        for s in sums[::-1]:
            more = sure | (tied & s)
            m = int(np.bitwise_count(more).sum())
            if m > k:
                tied = tied & s
            else:
                sure, tied = more, tied & ~s
                if m == k:
                    tied[:] = 0
                    break
        rows, ties = (np.flatnonzero(np.unpackbits(x.view(np.uint8), count=n, bitorder="little")) for x in (sure, tied))
        rows = np.concatenate([rows, ties[: k - len(rows)]])
        digits = sums[:, rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)
        scores = (digits.astype(np.int64) << np.arange(len(sums))[:, None]).sum(0) - constant
        return self.ids[rows], scores


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, scale: float = 64.0, block_rows: int = 32768, block_queries: int = 8192, together: int = 4) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best inner products of each query with all other rows.

    Vectors that are null or hold null or non-finite components, and rows
    without an id, take no part; shorter vectors count as filled up with
    zeros. Ties go to the smaller id. Rows of the query's own id are not its
    candidates. A repeated id counts as often as it occurs; as a query, once.
    An empty table gives no rows. Components so large that a score could leave
    64 bits are refused with an error. Groups of `together` blocks of rows meet parts
    of queries, each pair a unit of work of bounded size; only k rows a query
    leave a block. A group's bitmaps are copied once for each part, a part's
    queries once for each group, so neither side travels by single rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"), is_query.alias("asks")).where("id is not null and v is not null")
    queries = rows.where("asks").groupBy("id").agg(F.min("v").alias("v"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"), F.count_if("asks").alias("q"), F.max(F.greatest(F.array_max("v"), -(F.array_min("v") + 1))).alias("most")).first()
    blocks, dims = max(1, -(-size["n"] // block_rows)), size["dims"] or 0
    if dims * ((size["most"] or 0) + 1) ** 2 >= 1 << 62:
        raise ValueError(f"scores of {dims} components up to {size['most']} leave 64 bits")
    # units of work: as few as their size allows, but in small tables enough of them to share out
    groups = max(-(-blocks // together), min(blocks, 8))
    parts = max(1, -(-size["q"] // block_queries), min(8, size["q"] // 32))

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        values = np.zeros((len(part), max(1, dims)), np.int64)
        for i, v in enumerate(part["v"]):
            values[i, : len(v)] = v
        b = Block.build(part["id"].to_numpy(), values)
        return pd.DataFrame({"block": [key[0]], "ids": [b.ids.tobytes()], "slices": [b.slices.tobytes()], "low": [b.low.tobytes()]})

    index = rows.select("id", "v").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(build, "block int, ids binary, slices binary, low binary")
    asked = queries.withColumn("part", F.pmod(F.xxhash64("id", F.lit("query")), F.lit(parts)).cast("int")).groupBy("part").agg(F.collect_list("id").alias("q_ids"), F.collect_list("v").alias("q_vectors"))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = index.withColumn("of", F.col("block") % groups).withColumn("part", numbers(parts))
    units = index.join(asked.withColumn("of", numbers(groups)), ["of", "part"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for unit in batch.itertuples():
                low = np.frombuffer(unit.low, np.int64)
                ids = np.frombuffer(unit.ids, np.int64)
                block = Block(ids, np.frombuffer(unit.slices, np.uint64).reshape(len(low), -1, -(-len(ids) // 64)), low)
                for q_id, v in zip(unit.q_ids, unit.q_vectors, strict=True):
                    query = np.zeros(len(low), np.int64)
                    query[: len(v)] = v
                    found, scores = block.best(query, q_id, k)
                    yield pd.DataFrame({"query_id": np.full(len(found), q_id, np.int64), "vec_id": found, "score": scores})

    found = units.mapInPandas(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

