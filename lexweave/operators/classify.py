"""Membership, labels and verdicts as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reject_reason(checks: list[tuple[str, Column]]) -> Column:
    """The name of the first check that fails; null if a row passes all. A null check fails."""
    out = F.lit(None).cast("string")
    for name, ok in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), name).otherwise(out)
    return out


def upper_share(x: Column) -> Column:
    """Share of upper-case letters among the letters; null without letters."""
    return F.try_divide(F.length(F.regexp_replace(x, r"[^\p{Lu}]", "")), F.length(F.regexp_replace(x, r"[^\p{L}]", "")))


def weak_signals(x: Column, pattern: str) -> Column:
    """Distinct weak signals, in lower case, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(x, F.lit(f"({pattern})"), 1), F.lower)))


def double_signal(x: Column, strong: str, weak: str) -> Column:
    """One strong signal or two different weak ones."""
    return x.rlike(strong) | (F.size(weak_signals(x, weak)) >= 2)


def with_head_veto(x: Column, wanted: Column, veto: str, head: int) -> Column:
    """wanted, unless the first `head` characters match the veto."""
    return wanted & ~F.substring(x, 1, head).rlike(veto)


def vote(a: Column, b: Column, c: Column, current: Column) -> tuple[Column, Column, Column]:
    """verdict, consensus and whether current agrees, of three readings of which any may be null or empty.

    With three present: all agree, the odd one out, or all differ. With two:
    they agree or not, and which two. Fewer decide nothing.
    """
    a, b, c = (F.nullif(x, F.lit("")) for x in (a, b, c))
    names = F.concat(*[F.when(x.isNotNull(), n).otherwise("") for x, n in ((a, "A"), (b, "B"), (c, "C"))])
    present = F.length(names)
    two = F.array_compact(F.array(a, b, c))
    verdict = (
        F.when(present < 2, "fewer_than_2_sources")
        .when((present == 2) & (two[0] == two[1]), F.concat(F.lit("agree_2_of_2_"), names))
        .when(present == 2, F.concat(F.lit("disagree_2_of_2_"), names))
        .when((a == b) & (b == c), "all_agree")
        .when(b == c, "outlier_A")
        .when(a == c, "outlier_B")
        .when(a == b, "outlier_C")
        .otherwise("all_differ")
    )
    consensus = F.when((present == 2) & (two[0] == two[1]), two[0]).when(present == 3, F.when((a == b) | (a == c), a).when(b == c, b))
    return verdict, consensus, F.coalesce(current == consensus, F.lit(False))
