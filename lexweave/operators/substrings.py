"""Which strings hold, or are held by, strings of a set: automata over bounded parts of the set, texts streamed past them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _automaton(patterns: list[str]):
    import ahocorasick

    out = ahocorasick.Automaton()
    for k, p in enumerate(patterns):
        out.add_word(p, k)
    out.make_automaton()
    return out


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """(unit, kind, rows) of rows that follow one another."""
    for batch in batches:
        units, kinds = batch.column("_unit").to_pylist(), batch.column("_kind").to_pylist()
        edges = [0, *(i for i in range(1, len(units)) if (units[i], kinds[i]) != (units[i - 1], kinds[i - 1])), len(units)]
        for s, e in zip(edges, edges[1:], strict=False):
            if e > s:
                yield units[s], kinds[s], batch.slice(s, e - s)


def _holding(batches: Iterator[pa.RecordBatch], mode: str) -> Iterator[pa.RecordBatch]:
    """Of units, sorted with patterns first: the texts that hold a pattern, the patterns that a text holds, or the pairs of both."""
    unit, patterns, automaton, hit = None, [], None, np.empty(0, bool)

    def flush() -> Iterator[pa.RecordBatch]:
        if mode == "patterns" and hit.any():
            yield from pa.Table.from_batches(patterns).filter(pa.array(hit)).to_batches()

    for now, kind, rows in _stretches(batches):
        if now != unit:
            yield from flush()
            unit, patterns, automaton, hit = now, [], None, np.empty(0, bool)
        if kind == 0:
            patterns.append(rows)
            continue
        if not patterns:
            continue
        if automaton is None:
            values = [v for p in patterns for v in p.column("_value").to_pylist()]
            automaton = _automaton(values)
            hit = np.zeros(len(values), bool)
        texts = rows.column("_value").to_pylist()
        if mode == "texts":
            yield rows.filter(pa.array([next(automaton.iter(t), None) is not None for t in texts], pa.bool_()))
            continue
        met = [{k for _, k in automaton.iter(t)} for t in texts]
        if mode == "patterns":
            hit[list(set().union(*met))] = True
        else:
            which = pa.array([i for i, ks in enumerate(met) for _ in ks], pa.int32())
            found = rows.take(which)
            yield found.set_column(found.schema.get_field_index("_other"), "_other", pa.array([values[k] for ks in met for k in ks], pa.string()))
    yield from flush()


def _units(texts: DataFrame, patterns: DataFrame, block: list[str], text: str, pattern: str, part_bytes: int) -> DataFrame:
    keys = block or ["_all"]
    named = lambda df, c: df.select(*(block or [F.lit(0).alias("_all")]), F.col(c).alias("_value")).where("_value <> ''").distinct()
    known, rows = named(patterns, pattern), named(texts, text)
    number = lambda df, name: df.groupBy(*keys).agg(F.ceil(F.sum(F.octet_length("_value")) / part_bytes).cast("int").alias(name))
    sizes = number(known, "_parts").join(number(rows, "_slices"), keys)
    dealt = lambda n: F.pmod(F.xxhash64("_value"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = known.join(sizes, keys).withColumn("_part", dealt("_parts")).withColumn("_slice", each("_slices")).withColumn("_kind", F.lit(0))
    b = rows.join(sizes, keys).withColumn("_part", each("_parts")).withColumn("_slice", dealt("_slices")).withColumn("_kind", F.lit(1))
    units = a.unionByName(b).select(*keys, "_value", F.lit(None).cast("string").alias("_other"), F.to_json(F.struct(*keys, "_part", "_slice")).alias("_unit"), "_kind")
    return units.repartition("_unit").sortWithinPartitions("_unit", "_kind")


def holding(texts: DataFrame, patterns: DataFrame, block: list[str], text: str, pattern: str, held: bool = False, part_bytes: int = 8 << 20) -> DataFrame:
    """Rows (*block, text) of distinct texts that hold a pattern of their block; with `held` rows (*block, pattern) of patterns that a text of their block holds.

    Empty and null strings take no part. A block's patterns are dealt into
    parts of about part_bytes, each an automaton of its own, and its texts
    likewise, so that a large block is many units of bounded size; what a unit
    needs comes sorted to one task, patterns first.
    """
    units = _units(texts, patterns, block, text, pattern, part_bytes)
    found = units.mapInArrow(lambda batches: _holding(batches, "patterns" if held else "texts"), units.schema)
    return found.select(*block, F.col("_value").alias(pattern if held else text)).distinct()


def held_pairs(texts: DataFrame, patterns: DataFrame, block: list[str], text: str, pattern: str, part_bytes: int = 8 << 20) -> DataFrame:
    """Rows (*block, text, pattern) of distinct texts and the patterns of their block that they hold, likewise."""
    units = _units(texts, patterns, block, text, pattern, part_bytes)
    found = units.mapInArrow(lambda batches: _holding(batches, "pairs"), units.schema)
    return found.select(*block, F.col("_value").alias(text), F.col("_other").alias(pattern))
