"""Like strings through an inverted index of q-grams; complete for a floor of the indel ratio.

A pair at the floor is apart by at most D = (1 - floor) * (both lengths)
insertions and deletions. A deletion breaks at most q of a padded string's
grams, an insertion q - 1, and what isn't broken stands in the other string,
moved by no more than the indels before it. So of any k grams of the one, k less
the broken ones are found in the postings of the other at a fitting place: the
rarest k are looked up, k just beyond what can break.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions.similarity import indel_ratio, may_reach

PAD = "\u0001"
SLACK = 1e-9  # a floor like 0.9 isn't exact in binary


def gram_size(floor: float) -> int:
    """The longest gram, up to 4, of which a string at the floor can't lose all."""
    return max(1, min(4, int((2 - floor) / (2 - 2 * floor) + SLACK))) if floor < 1 else 4


def grams(text: Column, q: int) -> Column:
    """The grams of a string with q - 1 pads on each side, in order."""
    padded = F.concat(F.lit(PAD * (q - 1)), text, F.lit(PAD * (q - 1)))
    return F.transform(F.sequence(F.lit(1), F.length(text) + (q - 1)), lambda i: F.substring(padded, i, F.lit(q)))


def most_broken(n: Column, floor: float, q: int) -> Column:
    """How many grams of a string of n characters break at most, whatever its partner's length; q - 1 more where that is the longer one's."""
    return F.floor(q * n * (2 - 2 * floor) / (2 - floor) + SLACK).cast("int")


def apart(n: Column, m: Column, floor: float) -> tuple[Column, Column]:
    """(deletions, insertions) from a string of n to one of m characters, at most."""
    d = F.floor((1 - floor) * (n + m) + SLACK).cast("int")
    d = d - F.pmod(d + n + m, F.lit(2))
    return ((d + n - m) / 2).cast("int"), ((d - n + m) / 2).cast("int")


def bag(text: Column) -> Column:
    """The characters of a string, each with how often it has come before, so that equal ones count apart."""
    letters = F.split(text, "")
    return F.transform(letters, lambda c, i: F.concat(c, F.size(F.filter(F.slice(letters, F.lit(1), i), lambda x: x == c)).cast("string")))


def candidates(keys: DataFrame, names: DataFrame, block: list[str], key: str, name: str, floor: float, share: int = 4096) -> DataFrame:
    """Rows (*block, key, name): all pairs of a block at the floor among others; keys and names must be distinct in a block and not empty.

    Pairs found must also share enough characters in any order. Postings of a gram beyond `share` are dealt into parts, and its probes
    copied to each, so a frequent gram is many small tasks.
    """
    q = gram_size(floor)
    n, m = F.length(key), F.length(name)
    posted = names.select(*block, name, F.posexplode(grams(F.col(name), q)).alias("_at", "_gram"))
    counted = posted.groupBy(*block, "_gram").agg(F.count(F.lit(1)).alias("_n"))
    parts = F.floor(F.coalesce("_n", F.lit(0)) / share).cast("int")
    probes = keys.select(*block, key, F.posexplode(grams(F.col(key), q)).alias("_from", "_gram")).join(counted, [*block, "_gram"], "left")
    rarest = F.row_number().over(Window.partitionBy(*block, key).orderBy(F.coalesce("_n", F.lit(0)), "_gram", "_from"))
    wanted = most_broken(n, floor, q) + 1
    probes = probes.withColumn("_nth", rarest).where(F.col("_nth") <= wanted).where("_n is not null")
    probes = probes.select(*block, key, "_from", "_gram", F.explode(F.sequence(F.lit(0), parts)).alias("_part"))
    posted = posted.join(counted.where(F.col("_n") >= share), [*block, "_gram"], "left").select(*block, name, "_at", "_gram", F.pmod(F.xxhash64(name), parts + 1).cast("int").alias("_part"))
    gone, come = apart(n, m, floor)
    moved = F.col("_from") - F.col("_at")
    met = probes.join(posted, [*block, "_gram", "_part"]).where(may_reach(F.col(key), F.col(name), floor - SLACK) & moved.between(-come, gone))
    found = met.groupBy(*block, key, name).agg(F.count(F.lit(1)).alias("_met"))
    found = found.where(F.col("_met") >= wanted - (q * gone + (q - 1) * come)).select(*block, key, name)
    bags = found.join(keys.select(key).distinct().withColumn("_ours", bag(F.col(key))), key).join(names.select(name).distinct().withColumn("_theirs", bag(F.col(name))), name)
    return bags.where(2 * F.size(F.array_intersect("_ours", "_theirs")) >= (floor - SLACK) * (n + m)).select(*block, key, name)


def like(keys: DataFrame, names: DataFrame, block: list[str], key: str, name: str, floor: float, score: Callable[[Column, Column], Column] = indel_ratio) -> DataFrame:
    """Rows (*block, key, name, score) of all pairs of a block at the floor; a score may be the indel ratio or any that never exceeds it.

    Pairs that several blocks hold are scored once.
    """
    pairs = candidates(keys.select(*block, key).where(F.col(key) != "").distinct(), names.select(*block, name).where(F.col(name) != "").distinct(), block, key, name, floor)
    if not block:
        return pairs.withColumn("score", score(F.col(key), F.col(name))).where(F.col("score") >= floor)
    scored = pairs.select(key, name).distinct().withColumn("score", score(F.col(key), F.col(name))).where(F.col("score") >= floor)
    return pairs.join(scored, [key, name]).select(*block, key, name, "score")
