"""Faceted counts, search, sorting, shares, ranks and ratios."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions.text import search_fold
from lexweave.session import staged


@dataclass
class FacetQuery:
    """facets: name to column; filters: facet to its selected value, empty for none; search over the text columns."""

    facets: dict[str, str]
    text: list[str]
    filters: dict[str, str] = field(default_factory=dict)
    search: str = ""

    def found(self) -> Column:
        """Whether a row has the search text, whatever its case and marks."""
        if not self.search:
            return F.lit(True)
        return search_fold(F.concat_ws(" ", *self.text)).contains(search_fold(F.lit(self.search)))

    def passes(self, but: str | None = None) -> Column:
        active = [(n, v) for n, v in self.filters.items() if v and n != but]
        return reduce(lambda a, b: a & b, [F.coalesce(F.col(self.facets[n]).cast("string") == v, F.lit(False)) for n, v in active], self.found())

    def rows(self, df: DataFrame) -> DataFrame:
        return df.where(self.passes())

    def counts(self, df: DataFrame) -> DataFrame:
        """Rows (facet, value, n): each facet counted over what passes all other filters, in one pass.

        A row counts for all facets if it fails no filter, and for one facet
        if that facet's is the only one it fails. Null and "" aren't counted.
        """
        active = [(n, v) for n, v in self.filters.items() if v]
        failed = F.array_compact(F.array(*[F.when(~F.coalesce(F.col(self.facets[n]).cast("string") == v, F.lit(False)), n) for n, v in active])) if active else F.array().cast("array<string>")
        each = F.explode(F.array(*[F.struct(F.lit(n).alias("facet"), F.col(c).cast("string").alias("value")) for n, c in self.facets.items()]))
        rows = df.where(self.found()).withColumn("_failed", failed).where(F.size("_failed") <= 1).select("_failed", each.alias("f")).select("_failed", "f.*")
        rows = rows.where((F.size("_failed") == 0) | (F.try_element_at("_failed", F.lit(1)) == F.col("facet"))).where("value is not null and value <> ''")
        return rows.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def sorted_by(df: DataFrame, column: str, descending: bool, tie: str) -> DataFrame:
    """By a column, nulls last in both directions."""
    key = F.col(column)
    return df.orderBy(key.desc_nulls_last() if descending else key.asc_nulls_last(), tie)


def frequencies(df: DataFrame, column: str, top: int) -> DataFrame:
    """The most frequent values but null and "", ties by value."""
    rows = df.where(F.col(column).isNotNull() & (F.col(column).cast("string") != ""))
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(top)


def key_sums(df: DataFrame, entries: Column) -> DataFrame:
    """Sum and count of each key of a map of numbers; keys of sum 0 go."""
    rows = df.select(F.explode(entries).alias("key", "value")).where("value is not null")
    return rows.groupBy("key").agg(F.sum("value").alias("total"), F.count("value").alias("n")).where("total > 0")


def rank_shift(df: DataFrame, key: str, first: str, second: str, top: int) -> DataFrame:
    """Among the top rows by `first`: places by it and by `second`, and the shift; ties by key."""
    best = df.orderBy(F.desc(first), key).limit(top)
    places = best.withColumn("place_1", F.row_number().over(Window.orderBy(F.desc(first), key)))
    places = places.withColumn("place_2", F.row_number().over(Window.orderBy(F.desc(second), key)))
    return places.withColumn("shift", F.col("place_1") - F.col("place_2"))


def share_of_max(df: DataFrame, value: str, *by: str) -> DataFrame:
    """df with share, value over the greatest of its group, and bar, the share in percent and at least 1; null values have neither.

    Greatest values are aggregated before they are joined, so rows don't move by group.
    """
    most = df.groupBy(*by).agg(F.max(value).alias("_most"))
    share = F.try_divide(F.col(value), F.col("_most"))
    return df.join(most, list(by)).withColumn("share", share).withColumn("bar", F.when(share.isNotNull(), F.greatest(F.lit(1.0), F.round(100 * share, 1)))).drop("_most")


def ratio_top(df: DataFrame, key: str, over: str, under: str, top: int) -> DataFrame:
    """The top rows by `over` with ratio over / under (none where under is 0) and place, their order by it; no ratio last, ties by key."""
    best = df.orderBy(F.desc(over), key).limit(top).withColumn("ratio", F.try_divide(F.col(over), F.col(under)))
    return best.withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_last("ratio"), key))).orderBy("place")


def page_with_total(df: DataFrame, column: str, descending: bool, tie: str, size: int = 500) -> DataFrame:
    """The first `size` rows in the order of sorted_by(), each with the number of all rows as total."""
    total = df.agg(F.count(F.lit(1)).alias("total"))  # one row
    return sorted_by(df, column, descending, tie).limit(size).join(F.broadcast(total))


def natural_order(x: Column, width: int = 12) -> Column:
    """A key that orders texts by letters without case and marks, and runs of digits as numbers."""
    padded = F.regexp_replace(search_fold(x), r"(\d+)", F.lit("0" * width + "$1"))
    return F.regexp_replace(padded, rf"0+(\d{{{width}}})(?!\d)", "$1")


def locale_order(x: Column, locale: str = "ca", width: int = 12) -> Column:
    """A key that orders texts as readers of a language expect, letters of its alphabet, marks and case each at their level, and runs of digits as numbers."""
    padded = F.regexp_replace(F.regexp_replace(x, r"(\d+)", F.lit("0" * width + "$1")), rf"0+(\d{{{width}}})(?!\d)", "$1")
    return F.collate(padded, locale)


def facet_order(counts: DataFrame, natural: list[str], ranked: dict[str, list[str]]) -> DataFrame:
    """Rows (facet, value, n) with place: by natural order, by a given rank (values that it lacks last), else by count, most first, then value."""
    rank = F.lit(None).cast("int")
    for facet, order in ranked.items():
        known = F.array_position(F.array(*map(F.lit, order)), F.col("value"))
        rank = F.when(F.col("facet") == facet, F.when(known > 0, known).otherwise(len(order) + 1)).otherwise(rank)
    by_name = F.col("facet").isin(natural)
    w = Window.partitionBy("facet").orderBy(F.coalesce(rank, F.lit(0)), F.when(by_name, natural_order(F.col("value"))), F.when(~by_name, -F.col("n")), search_fold(F.col("value")), "value")
    return counts.withColumn("place", F.row_number().over(w))


def match_rates(df: DataFrame, tier: str = "tier", none: str = "unmatched") -> DataFrame:
    """Rows (tier, n, percent) of all rows, and of what isn't `none` as tier `matched`."""
    counts = df.groupBy(F.col(tier).alias("tier")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_all"), F.coalesce(F.sum(F.when(F.col("tier") != none, F.col("n"))), F.lit(0)).alias("n"))
    out = counts.unionByName(total.select(F.lit("matched").alias("tier"), "n")).join(F.broadcast(total.select("_all")))
    return out.select("tier", "n", F.round(100.0 * F.col("n") / F.col("_all"), 3).alias("percent"))


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """df with a column of numbers from 1 in the order of the columns: numbered within sorted ranges, of which only the counts are summed in one place.

    The ranges are written before anything is counted: made a second time, by
    another sample or merged otherwise, they would be other ranges.
    """
    rows = staged(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    ranges = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = ranges.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return rows.withColumn("_nth", nth).join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_nth")).drop("_range", "_nth", "_before")


def places(df: DataFrame, *order: str) -> DataFrame:
    """df with place, from 1, in the order of the columns."""
    return numbered(df, "place", *order)
