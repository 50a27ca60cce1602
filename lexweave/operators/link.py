"""Deduplication and linking inside blocking keys; every tie is broken."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions.similarity import indel_ratio, may_reach
from lexweave.operators.gram_index import like
from lexweave.operators.serve import numbered
from lexweave.operators.substrings import holding
from lexweave.session import staged


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def priority_dedup(main: DataFrame, extra: DataFrame, keys: list[str], rank: Column, order: list[Column | str]) -> DataFrame:
    """The row of best rank of each key of main, then rows of extra whose key main lacks, the first of each."""
    first = keep_first(main, keys, [rank.asc_nulls_last(), *order])
    return first.unionByName(keep_first(extra.join(first.select(*keys), keys, "left_anti"), keys, order))


def fuzzy_pairs(a: DataFrame, b: DataFrame, block: list[str], left: str, right: str, floor: float, score: Callable[[Column, Column], Column] = indel_ratio) -> DataFrame:
    """Pairs of rows within a block whose ratio (the indel ratio or one below it) is at least floor, found through an index of grams."""
    return a.join(like(a, b, block, left, right, floor, score), [*block, left]).join(b, [*block, right])


def _word_ends(key: Column) -> Column:
    """What stands before each space of a key."""
    words = F.split(key, " ")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda n: F.when(n < F.size(words), F.array_join(F.slice(words, F.lit(1), n), " ")))


def best_of_misses(keys: DataFrame, names: DataFrame, block: list[str], key: str, name: str, below: float, score: Callable[[Column, Column], Column] = indel_ratio, levels: tuple[float, ...] = (0.6, 0.3, 0.0)) -> DataFrame:
    """Rows (*block, key, score): for keys without a name at `below` the score of the most like name of their block; no row where a block has no name.

    The index is searched at ever lower floors, each by the keys that the one
    before left: what is found at a floor beats all that isn't, so only the
    last floor scores pairs that have little in common.
    """
    left, out = staged(keys), []
    for floor in [f for f in levels if f < below]:
        if not left.limit(1).count():
            break
        found = staged(like(left, names, block, key, name, floor, score).groupBy(*block, key).agg(F.max("score").alias("score")))
        out.append(found)
        left = staged(left.join(found, [*block, key], "left_anti"))
    rest = left.join(names.select(*block).distinct(), block, "left_semi").select(*block, key, F.lit(0.0).alias("score"))
    for found in out:
        rest = rest.unionByName(found)
    return rest


def link_cascade(texts: DataFrame, index: DataFrame, block: list[str], text_id: str, text_key: str, index_id: str, index_key: str, floor: float, score: Callable[[Column, Column], Column] = indel_ratio) -> DataFrame:
    """A row (text_id, index_id, tier, score) for each text row.

    Tiers: exact key; one key a prefix of the other that ends at a word's end;
    ratio of at least floor, best first. Ties go to the smallest index_id. No
    link: tier `none` and the best score within the block, null where the block
    has no index row. The first two tiers are joins on equal keys, the third
    goes through an index of grams and sees only what they left.
    """
    keys = [*block, text_key]
    texts_of = staged(texts.select(*keys).distinct())
    index_of = staged(index.where(F.col(index_key) != "").groupBy(*block, index_key).agg(F.min(index_id).alias(index_id)))
    wanted = texts_of.where(F.col(text_key) != "")
    equal = wanted.join(index_of.withColumn(text_key, F.col(index_key)), keys).select(*keys, index_id, F.lit(1).alias("tier"))
    shorter = wanted.withColumn(index_key, F.explode(_word_ends(F.col(text_key)))).join(index_of, [*block, index_key]).select(*keys, index_id, F.lit(2).alias("tier"))
    longer = index_of.withColumn(text_key, F.explode(_word_ends(F.col(index_key)))).join(wanted, keys).select(*keys, index_id, F.lit(2).alias("tier"))
    sure = staged(equal.unionByName(shorter).unionByName(longer).withColumn("score", F.lit(1.0)))
    left = staged(wanted.join(sure.select(*keys).distinct(), keys, "left_anti"))
    fuzzy = like(left, index_of, block, text_key, index_key, floor, score).join(index_of, [*block, index_key]).select(*keys, index_id, F.lit(3).alias("tier"), "score")
    best = staged(keep_first(sure.unionByName(fuzzy), keys, ["tier", F.desc("score"), index_id]))
    missed = texts_of.join(best, keys, "left_anti")
    misses = best_of_misses(missed, index_of, block, text_key, index_key, floor, score)
    named = F.element_at(F.array(F.lit("exact"), F.lit("prefix"), F.lit("fuzzy")), F.col("tier"))
    told = best.select(*keys, index_id, named.alias("tier"), "score").unionByName(misses, allowMissingColumns=True)
    found = texts.select(*keys, text_id).join(told, keys, "left")
    return found.select(text_id, index_id, F.coalesce("tier", F.lit("none")).alias("tier"), "score")


def covered(rows: DataFrame, known: DataFrame, block: list[str], key: str, known_key: str, floor: float, score: Callable[[Column, Column], Column] = indel_ratio) -> DataFrame:
    """Rows whose key equals, holds, is held by or is like a known one of its block; empty keys cover nothing and aren't covered."""
    keys = staged(rows.select(*block, key).where(F.col(key) != "").distinct())
    others = staged(known.select(*block, known_key).where(F.col(known_key) != "").distinct())
    cheap = staged(holding(keys, others, block, key, known_key).union(holding(others, keys, block, known_key, key, held=True)).distinct())
    near = like(staged(keys.join(cheap, [*block, key], "left_anti")), others, block, key, known_key, floor, score).select(*block, key)
    return rows.join(cheap.union(near).distinct(), [*block, key], "left_semi")


def neighbour_probe(rows: DataFrame, pages: DataFrame, block: list[str], at: str, page: str, offsets: list[int], hit: Column) -> DataFrame:
    """For each row the first offset, in the given order, at which its neighbour page is a hit."""
    order = F.create_map(*[F.lit(v) for k, o in enumerate(offsets) for v in (o, k)])
    probes = rows.withColumn("offset", F.explode(F.array(*map(F.lit, offsets)))).withColumn("_page", F.col(at) + F.col("offset"))
    found = probes.join(pages.withColumnRenamed(page, "_page"), [*block, "_page"]).where(hit)
    return keep_first(found, rows.columns, [order[F.col("offset")]]).drop("_page")


def geocode(places: DataFrame, gazetteer: DataFrame, overrides: DataFrame, parents: DataFrame, centroids: DataFrame, score: Callable[[Column, Column], Column], floor: float, bound: float = 0.0, most: int = 10, farms: list[str] | None = None, oldest: str = "historical", chief: str = "Municipi") -> DataFrame:
    """places (id, key, parent, region) to (id, tier, lon, lat, matched): the first tier that answers.

    curated override; exact key in the region (own parent first, then rows of
    the source `oldest`, then types that hold `chief`, then the smallest name); fuzzy in the region at `floor` and a length of at least
    max(4, 0.6 of the key's), of the `most` best of which the own parent's come
    first; the parent's own place; the region's centroid. `bound` is the least
    ratio by lengths that can reach the floor under the score. Gazetteer rows
    of a type in `farms` count as fuzzy hits only in the own parent. Only
    distinct pairs of keys are scored.
    """
    for c in {"type", "source"} - set(gazetteer.columns):
        gazetteer = gazetteer.withColumn(c, F.lit(None).cast("string"))
    gaz = gazetteer.select(F.col("region"), F.col("key").alias("g_key"), F.col("parent").alias("g_parent"), F.col("name").alias("matched"), "lon", "lat", "type", "source").where("length(g_key) >= 3")
    cols = ["id", "tier", "lon", "lat", "matched"]
    own = F.coalesce(F.col("parent") == F.col("g_parent"), F.lit(False)).cast("int").desc()
    one = places.join(overrides, "key").select("id", F.lit("curated").alias("tier"), "lon", "lat", F.col("key").alias("matched"))
    left = places.join(one, "id", "left_anti")
    old = F.coalesce(F.col("source") == oldest, F.lit(False)).cast("int").desc()
    main = F.coalesce(F.col("type").contains(chief), F.lit(False)).cast("int").desc()
    first_of = lambda by: keep_first(gaz, by, [old, main, "matched", "lon", "lat"]).select(*by, "matched", "lon", "lat").withColumnRenamed("g_key", "key")
    its_own = first_of(["region", "g_key", "g_parent"]).where("g_parent is not null").withColumnRenamed("g_parent", "parent")
    hits = left.join(its_own, ["region", "key", "parent"]).withColumn("_any", F.lit(0))
    hits = hits.unionByName(left.join(first_of(["region", "g_key"]), ["region", "key"]).withColumn("_any", F.lit(1)))
    two = keep_first(hits, ["id"], ["_any", "matched", "lon"]).select("id", F.lit("exact").alias("tier"), "lon", "lat", "matched")
    left = left.join(two, "id", "left_anti")
    long_enough = F.length("g_key") >= F.greatest(F.lit(4), F.floor(F.length("key") * 0.6).cast("int"))
    agrees = F.coalesce(F.col("parent") == F.col("g_parent"), F.lit(False)) | ~F.coalesce(F.col("type").isin(farms or []), F.lit(False))
    wanted = left.select("region", "key").distinct().join(gaz.select("region", "g_key").distinct(), "region").where(long_enough & may_reach(F.col("key"), F.col("g_key"), bound))
    scored = wanted.select("key", "g_key").distinct().withColumn("_score", score(F.col("key"), F.col("g_key"))).where(F.col("_score") >= floor)
    near = left.join(scored, "key").join(gaz, ["region", "g_key"]).where(agrees)
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("_score"), "matched", "lon"))
    near = near.withColumn("_place", place).where(F.col("_place") <= most)
    three = keep_first(near, ["id"], [own, F.desc("_score"), "matched", "lon"]).select("id", F.lit("fuzzy").alias("tier"), "lon", "lat", "matched")
    left = left.join(three, "id", "left_anti")
    four = left.join(parents, "parent").select("id", F.lit("parent").alias("tier"), "lon", "lat", F.col("parent").alias("matched"))
    left = left.join(four, "id", "left_anti")
    five = left.join(centroids, "region", "left").select("id", F.when(F.col("lon").isNull(), "unmatched").otherwise("region").alias("tier"), "lon", "lat", F.when(F.col("lon").isNotNull(), F.col("region")).alias("matched"))
    out = one.select(cols)
    for part in (two, three, four, five):
        out = out.unionByName(part.select(cols))
    return out


def placed_by_modern_name(gazetteer: DataFrame, score: Callable[[Column, Column], Column], floor: float, bound: float = 0.0) -> DataFrame:
    """gazetteer with coordinates, where it has none, of the row of its region spelled as its modern name, else of the most like one at `floor`."""
    known = gazetteer.where("lon is not null").select(F.col("region"), F.col("name").alias("_as"), F.col("lon").alias("_lon"), F.col("lat").alias("_lat"))
    lost = gazetteer.where("lon is null and modern is not null").select("id", "region", "modern")
    exact = lost.join(known, (lost["region"] == known["region"]) & (lost["modern"] == known["_as"])).select("id", F.lit(2.0).alias("_score"), "_as", "_lon", "_lat")
    left = lost.join(exact.select("id").distinct(), "id", "left_anti")
    pairs = left.select("region", "modern").distinct().join(known.select("region", "_as").distinct(), "region").where(may_reach(F.col("modern"), F.col("_as"), bound))
    scored = pairs.withColumn("_score", score(F.col("modern"), F.col("_as"))).where(F.col("_score") >= floor)
    like = left.join(scored, ["region", "modern"]).join(known, ["region", "_as"]).select("id", "_score", "_as", "_lon", "_lat")
    best = keep_first(exact.unionByName(like), ["id"], [F.desc("_score"), "_as", "_lon", "_lat"]).select("id", "_lon", "_lat")
    out = gazetteer.join(best, "id", "left")
    return out.select(*[F.coalesce(c, f"_{c}").alias(c) if c in ("lon", "lat") else F.col(c) for c in gazetteer.columns])


def best_in_list(rows: DataFrame, names: DataFrame, key: str, name: str, floor: float, score: Callable[[Column, Column], Column] = indel_ratio) -> DataFrame:
    """Rows (key, name, score) for distinct keys: the name itself if listed, else the most like one of the whole list at `floor`, ties to the first.

    Empty and null keys and names take no part. The list is an index of grams, of which a key looks up its rarest.
    """
    keys, listed = rows.select(key).distinct().where(F.col(key) != ""), names.select(name).distinct().where(F.col(name) != "")
    exact = keys.join(listed, keys[key] == listed[name]).select(key, name, F.lit(1.0).alias("score"))
    found = like(staged(keys.join(exact, key, "left_anti")), staged(listed), [], key, name, floor, score)
    return exact.unionByName(keep_first(found, [key], [F.desc("score"), name]))


def jitter(key: Column, lon: Column, lat: Column, radius: float) -> tuple[Column, Column]:
    """A place around (lon, lat) that a hash of the key fixes: angle and distance from two 16-bit fields of its md5."""
    field = lambda start: F.conv(F.substring(F.md5(key), start, 4), 16, 10).cast("double") / 65535
    angle, distance = field(29) * 2 * 3.141592653589793, field(25) * radius
    return lon + distance * F.cos(angle), lat + distance * F.sin(angle)


def loosely_equal(expected: Column, found: Column) -> Column:
    """Equal, or equal to one of the words of what was found."""
    return (expected == found) | F.array_contains(F.split(found, " "), expected)


def updated(df: DataFrame, changes: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """df with columns from changes where those have the key and a value; nothing is written in place."""
    new = changes.select(*key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    out = df.join(new, key, "left")
    return out.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns])


def appended(df: DataFrame, rows: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """df and rows with ids that follow its greatest, in order of columns of rows."""
    top = df.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    new = numbered(rows.select(df.columns), "_number", *order)
    return df.unionByName(new.withColumn(id_col, F.lit(top) + F.col("_number")).select(df.columns))
