"""String similarities as Arrow UDFs; block before you score."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel(a: str, b: str) -> float:
    """2 * common / (length of both); 1 for two empty strings."""
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def token_sort(x: str) -> str:
    return " ".join(sorted(x.split()))


def token_set(a: str, b: str) -> float:
    """The best ratio among the shared words and the shared words with either rest."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, one, two = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not one or not two):
        return 1.0
    first, second = f"{both} {one}".strip(), f"{both} {two}".strip()
    scores = [indel(first, second)]
    if both:
        scores += [indel(both, first), indel(both, second)]
    return max(scores)


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter string with a window of the longer of its length."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0
    n = len(short)
    return max(indel(short, long[max(0, i) : i + n]) for i in range(1 - n, len(long)))


def weighted(a: str, b: str) -> float:
    """A weighted ratio, 0 to 100: whole strings, words in any order and, for unequal lengths, parts, each discounted."""
    if not a or not b:
        return 0.0
    ratio = max(len(a), len(b)) / min(len(a), len(b))
    best = indel(a, b)
    words = max(indel(token_sort(a), token_sort(b)), token_set(a, b))
    if ratio < 1.5:
        return 100 * max(best, 0.95 * words)
    scale = 0.9 if ratio <= 8 else 0.6
    parts = max(partial(token_sort(a), token_sort(b)), 1.0 if set(a.split()) & set(b.split()) else 0.0)
    return 100 * max(best, scale * partial(a, b), scale * 0.95 * parts)


def _scored(score):
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else score(x, y) for x, y in zip(a, b)], dtype="float64")

    return run


def indel_ratio(a: Column, b: Column) -> Column:
    return _scored(indel)(a, b)


def difflib_ratio(a: Column, b: Column) -> Column:
    """The standard library's matching-blocks ratio; the order of the arguments matters."""
    return _scored(lambda x, y: SequenceMatcher(None, x, y).ratio())(a, b)


def weighted_ratio(a: Column, b: Column) -> Column:
    return _scored(weighted)(a, b)


def may_reach(a: Column, b: Column, ratio: float) -> Column:
    """Whether lengths allow the ratio: twice the shorter over both bounds it from above."""
    return 2 * F.least(F.length(a), F.length(b)) >= ratio * (F.length(a) + F.length(b))
