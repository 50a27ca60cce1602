"""Ordered rules compiled to Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def from_rows(frame: DataFrame, most: int = 1000) -> list[tuple[str, str, str]]:
    """Rules (pattern, replacement, label) of rows (priority, pattern, replacement, label), in order of priority, pattern and replacement; null patterns go.

    Rules become part of the plan, so more than `most` of them are refused.
    """
    rows = frame.where("pattern is not null").orderBy("priority", "pattern", "replacement").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rules: they become expressions of one plan")
    return [(r["pattern"], r["replacement"] or "", r["label"]) for r in rows]


def rewrite(x: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """All (pattern, replacement, label) rules, one after another, then trimmed."""
    return F.trim(reduce(lambda y, rule: F.regexp_replace(y, rule[0], rule[1]), rules, x))


def rules_hit(x: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Labels of the rules that match the text as it is."""
    return F.array_compact(F.array(*[F.when(x.rlike(pattern), label) for pattern, _, label in rules]))


def first_label(x: Column, rules: Sequence[tuple[str, str]], otherwise: str | None = None) -> Column:
    """The label of the first (pattern, label) rule that matches."""
    out = F.lit(otherwise).cast("string")
    for pattern, label in reversed(rules):
        out = F.when(x.rlike(pattern), label).otherwise(out)
    return out


def swap_lead(x: Column, old: Column, new: Column) -> Column:
    """old at the start of x, if it stands there, becomes new; old is literal and may differ by row."""
    lead = F.regexp_extract(x, r"^\s*", 0)
    rest = F.substring(x, F.length(lead) + 1, F.length(x))
    return F.when(rest.startswith(old), F.concat(new, F.substring(rest, F.length(old) + 1, F.length(rest)))).otherwise(x)
