"""Mixing sources to target weights by entropy balancing (operator 6).

Every source gets a target number of words. Its documents get rates
min(3, exp(lambda * size)): among all rates up to the cap that meet the target
these stay closest in relative entropy to taking each document once. lambda is
the root of the convex dual's gradient, found for all sources at once by
Newton's steps kept in brackets; a step is one aggregation of gradient and
curvature over the counts by source and size, as rows of one size share their
rate. Sums are of whole numbers, so that no order of tasks changes them. Rates
become whole copies by systematic rounding along the sizes: copies up to any
row are within one of the sum of the rates, so a source's words miss the target
by less than its largest document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.llm.common import WORD, discard, staged

SCALE = 1 << 20  # rates are whole multiples of 1 / SCALE: their sums are exact, whatever the order


FINE = 1 << 30  # of rates within Newton's steps


def numbered(df: DataFrame, *columns: str) -> DataFrame:
    """df with `nth`, its place from 0 in the order of the columns: counted in ranges, so no task sees all rows."""
    low = (1 << 33) - 1
    rows = df.repartitionByRange(*columns).sortWithinPartitions(*columns).select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().bitwiseAND(F.lit(low)).alias("inside"))
    rows = staged(rows)
    ranges = rows.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    # a row for each range, so for each shuffle partition
    before = ranges.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    return rows.join(F.broadcast(before), "range").withColumn("nth", F.col("before") + F.col("inside")).drop("range", "inside", "before")


def targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """Rows (no_source, source, source_size) with weight and target.

    Sources by code point, null last, weigh 5, 2, 1 and so on; shares of the
    total stop at cap times the source's size. Sources whose share exceeds that
    are capped and the excess goes to the others by weight, until none is above.
    """
    s = numbered(sources, "no_source", "source")
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("nth", F.lit(len(weights))) + 1).cast("int"))).drop("nth")
    s = staged(s.withColumn("most", F.lit(cap) * F.col("source_size")))
    total = s.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level = 0.0
    while True:
        over = F.col("weight") * level > F.col("most")
        left = s.agg(F.sum(F.when(over, F.col("most")).otherwise(0.0)).alias("capped"), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if not left["weight"] or (raised := (total - left["capped"]) / left["weight"]) <= level:
            break
        level = raised
    return s.select("no_source", "source", "source_size", "weight", F.least("most", F.col("weight") * level).alias("target"))


def tilt(root: Column, size: Column, cap: float) -> Column:
    """min(cap, exp(root * size))."""
    return F.exp(F.least(root * size, F.lit(math.log(cap))))


def dual_roots(cells: DataFrame, sources: DataFrame, cap: float, tolerance: float = 1e-7, rounds: int = 100) -> DataFrame:
    """sources with root: lambda with sum(n * size * min(cap, exp(lambda * size))) = target; infinite if only the cap reaches it.

    Each round is one aggregation over the cells, for all sources that aren't
    within the tolerance; its result, a row a source, is written and read again.
    """
    keys = ["no_source", "source"]
    inf = float("inf")
    stats = cells.groupBy(*keys).agg(F.sum("n").alias("rows"))
    state = sources.join(stats, keys).withColumn("low", F.lit(-inf)).withColumn("high", F.lit(inf))
    whole = (F.col("source_size") <= 0) | (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12))
    state = staged(state.withColumn("root", F.when(whole, inf).when(F.col("target") <= 0, -inf).otherwise(0.0)).withColumn("done", whole | (F.col("target") <= 0)))
    size, n, root, low, high = (F.col(c) for c in ("size", "n", "root", "low", "high"))
    exact = lambda x: (x * FINE).cast("long").cast("decimal(38,0)")
    for _ in range(rounds):
        if not state.where("not done").limit(1).count():
            break
        rate = tilt(root, size, cap)
        open_ = cells.join(state.where("not done").select(*keys, "root"), keys).where("size > 0")
        words = (n * size).cast("decimal(20,0)")
        sums = open_.groupBy(*keys).agg((F.sum(words * exact(rate)).cast("double") / FINE).alias("taken"), (F.sum(F.when(root * size < math.log(cap), words * size.cast("decimal(10,0)") * (rate * 1024).cast("long").cast("decimal(8,0)")).otherwise(0)).cast("double") / 1024).alias("slope"))
        off = F.col("taken") - F.col("target")
        new_low, new_high = F.when(off < 0, root).otherwise(low), F.when(off < 0, high).otherwise(root)
        step = F.when(F.col("slope") > 0, root - off / F.col("slope")).otherwise(F.lit(float("nan")))
        wide = root + F.when(off < 0, 1.0).otherwise(-1.0) * F.greatest(F.abs(root), F.col("rows") / F.col("source_size"))
        between = F.when((new_low > -inf) & (new_high < inf), (new_low + new_high) / 2).otherwise(wide)
        step = F.when(~F.isnan(step) & (step > new_low) & (step < new_high), step).otherwise(between)
        near = F.abs(off) <= tolerance * F.col("target")
        fixed = F.col("done") | near | (step == root)
        stepped = state.join(sums, keys, "left").select(*sources.columns, "rows", F.when(fixed, low).otherwise(new_low).alias("low"), F.when(fixed, high).otherwise(new_high).alias("high"), F.when(fixed, root).otherwise(step).alias("root"), fixed.alias("done"))
        stepped = staged(stepped)
        discard(state)
        state = stepped
    return state.drop("low", "high", "rows", "done")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), cap: int = 3, group: int = 256, together: int = 256) -> DataFrame:
    """Rows (id, size, source_size, target, taken, copies), one for each input row.

    size: words of the text (null: 0). taken = copies * size, copies at most
    cap. A source without words has target 0. Null sources are one source.
    Repeated rows are rows of their own. Rows of one source and size are
    dealt to parts of about `group` by a hash of the id. Every run gives
    the same copies: sums are of whole numbers, order is by size and id. An
    empty table gives no rows.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    src = F.col(source_col).cast("string")
    rows = staged(docs.select(F.col(id_col).alias("id"), src.isNull().alias("no_source"), F.coalesce(src, F.lit("")).alias("source"), size.alias("size")))
    cells = staged(rows.groupBy("no_source", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = targets(cells.groupBy("no_source", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, cap)

    keys = ["no_source", "source"]
    sources = dual_roots(cells, sources, cap)
    rate = F.when(F.col("size") > 0, F.when(F.col("root") == float("inf"), F.lit(cap * SCALE)).otherwise(F.least(F.round(tilt(F.col("root"), F.col("size"), cap) * SCALE), F.lit(cap * SCALE)))).otherwise(0).cast("long")
    rated = cells.join(sources.drop("weight"), keys).withColumn("rate", rate).withColumn("stretch", F.floor(F.col("size") / together)).withColumn("sum", F.col("rate") * F.col("n"))
    # sums before a size: of the stretches of sizes before its own, and within it
    long = rated.groupBy(*keys, "stretch").agg(F.sum("sum").alias("all"))
    long = long.select(*keys, "stretch", (F.sum("all").over(Window.partitionBy(*keys).orderBy("stretch")) - F.col("all")).alias("before"))
    inside = F.sum("sum").over(Window.partitionBy(*keys, "stretch").orderBy("size")) - F.col("sum")
    rated = staged(rated.withColumn("inside", inside).join(long, [*keys, "stretch"]).select(*keys, "size", "n", "source_size", "target", "rate", (F.col("before") + F.col("inside")).alias("start")))
    keys = [*keys, "size"]
    # as many parts of a cell as its largest one needs, so that none is a single task's, neither in the join nor in the window
    most = cells.agg(F.max("n")).first()[0] or 1
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(-(-most // group))).cast("long"))
    parts = dealt.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("m"))
    before = parts.select(*keys, "part", (F.sum("m").over(Window.partitionBy(*keys).orderBy("part")) - F.col("m")).alias("before"))
    known = staged(before.join(rated, keys))
    nth = F.row_number().over(Window.partitionBy(*keys, "part").orderBy("id"))
    out = dealt.withColumn("nth", nth).join(known, [*keys, "part"])
    last = F.col("start") + F.col("rate") * (F.col("before") + F.col("nth"))
    whole = lambda x: F.shiftright(x + SCALE // 2, SCALE.bit_length() - 1)
    copies = whole(last) - whole(last - F.col("rate"))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.cast("int").alias("copies"))
