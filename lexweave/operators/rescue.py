"""Rows that earlier accepted rows don't cover: the greedy choice in order, as rounds over a graph of conflicts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions.text import compressed_lemma, without_parens
from lexweave.operators.gram_index import like
from lexweave.operators.headword import blocked_lemma, gated_body, real_lemma
from lexweave.operators.link import appended, covered, keep_first
from lexweave.operators.substrings import held_pairs
from lexweave.session import staged


def first_independent(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Of nodes (id, club) the ids that a greedy pass in order of id accepts: none beside an accepted neighbour or an accepted member of its club.

    Edges are (later, earlier). Members of a club exclude each other without
    edges; a null club excludes nothing. A round accepts what has no undecided
    earlier neighbour and is the first undecided of its club, and drops what
    these exclude; rounds are as many as the longest chain of decisions that
    wait for each other.
    """
    left, edges, taken = staged(nodes.select("id", "club")), staged(edges.select("later", "earlier").distinct()), []
    while left.limit(1).count():
        first = left.where("club is not null").groupBy("club").agg(F.min("id").alias("id")).unionByName(left.where("club is null"))
        new = staged(first.join(edges.select(F.col("later").alias("id")).distinct(), "id", "left_anti"))
        taken.append(new)
        beside = edges.join(new.select(F.col("id").alias("earlier")), "earlier").select(F.col("later").alias("id")).distinct()
        left = left.join(new.select("id"), "id", "left_anti").join(beside, "id", "left_anti")
        left = staged(left.join(new.where("club is not null").select("club"), "club", "left_anti"))
        open_ = left.select("id")
        edges = staged(edges.join(open_.withColumnRenamed("id", "later"), "later", "left_semi").join(open_.withColumnRenamed("id", "earlier"), "earlier", "left_semi"))
    out = nodes.select("id").limit(0)
    for new in taken:
        out = out.union(new.select("id"))
    return out


def conflicts(nodes: DataFrame, block: list[str], key: str, floor: float) -> DataFrame:
    """Rows (later, earlier) of nodes (*block, key, id), keys distinct in a block and not empty, of which one holds the other or both are alike."""
    a, b = nodes.select(*block, key).withColumnRenamed(key, "_a"), nodes.select(*block, key).withColumnRenamed(key, "_b")
    near = like(a, b, block, "_a", "_b", floor).select(*block, "_a", "_b").union(held_pairs(a, b, block, "_a", "_b")).where("_a <> _b")
    ids = lambda c, to: nodes.select(*block, F.col(key).alias(c), F.col("id").alias(to))
    both = near.join(ids("_a", "_x"), [*block, "_a"]).join(ids("_b", "_y"), [*block, "_b"])
    return both.select(F.greatest("_x", "_y").alias("later"), F.least("_x", "_y").alias("earlier"))


def greedy_rescue(orphans: DataFrame, block: str, order: str, key: str, floor: float = 0.8) -> DataFrame:
    """Rows in order of which each is accepted unless a row accepted before it in its block has the same key, one that holds or is held by it, or a like one.

    Rows of equal order go by key; of equal keys only the first can be
    accepted; empty and null keys are not.
    """
    rows = staged(keep_first(orphans.where(F.col(key) != "").withColumn("_id", F.struct(order, block, key)), [block, key], [order]))
    nodes = rows.select(block, key, F.col("_id").alias("id"))
    taken = first_independent(nodes.withColumn("club", F.lit(None).cast("string")), conflicts(nodes, [block], key, floor))
    return rows.join(taken.withColumnRenamed("id", "_id"), "_id", "left_semi").drop("_id")


SPACES = " \t\n\x0b\f\r"  # what a pattern's \s stands for


def opened_paragraphs(heads: DataFrame, windows: DataFrame, block: list[str], head: str, header: str, domain: Callable[[Column], Column], longest: int = 50) -> DataFrame:
    """Rows (*block, head, opened): of its block's paragraphs, which blank lines part, one in which a line opens with the head, from there on; those of the domain first, then the longest, then the first.

    Heads must be distinct in a block, of at most `longest` characters, and
    not null; one that opens nothing has no row. A window (*block, window) may
    come in several rows, which `nth` orders; each ends its last paragraph.
    What may be the head of a line, its beginnings before a colon, stop, comma
    or the line's end, is looked up by value, so heads and paragraphs that
    don't meet cost nothing.
    """
    nth = F.col("nth") if "nth" in windows.columns else F.lit(0)
    parts = F.split(F.regexp_replace("window", header, ""), r"\n\s*\n")
    paragraphs = staged(windows.select(*block, nth.alias("_nth"), F.posexplode(parts).alias("_i", "_text")))

    at = F.col("_line")
    ends = F.lit(r"^\s*(?:\([^)]*(?:\)\s*|\z))?(?:[:.,]|\z)")  # of a line; what goes on in the next one may fit as well
    ended = lambda j: F.substring(at, j + 1, F.lit(1)).rlike(r"^(?:[\s(:.,]|\z)") & F.regexp_like(F.substring(at, j + 1, F.length(at)), ends)
    begun = F.transform(F.filter(F.sequence(F.lit(0), F.least(F.length(at), F.lit(longest))), ended), lambda j: F.substring(at, F.lit(1), j))
    lines = paragraphs.select(*block, "_nth", "_i", F.explode(F.transform(F.split("_text", r"\r\n|[\n\r\x{85}\x{2028}\x{2029}]"), lambda x: F.regexp_replace(x, r"^\s+", ""))).alias("_line"))
    begun = lines.select(*block, "_nth", "_i", F.explode(begun).alias("_begun"))
    first_line = F.regexp_replace(F.regexp_replace(head, r"^\s+", ""), r"(?s)[\n\r\x{85}\x{2028}\x{2029}].*", "")
    met = heads.select(*block, head, first_line.alias("_begun")).join(begun, [*block, "_begun"]).select(*block, head, "_nth", "_i").distinct()

    opener = F.concat(F.lit(r"(?m)^\s*\Q"), F.replace(head, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E\b(?:\s*\([^)]*\))?\s*[:.,]"))
    found = met.join(paragraphs, [*block, "_nth", "_i"]).where(F.regexp_like("_text", opener))
    found = found.withColumn("_text", F.trim(F.regexp_substr("_text", F.concat(opener, F.lit(r"[\s\S]*"))), F.lit(SPACES)))
    ranked = F.struct(domain(F.col("_text")).cast("int").alias("ours"), F.length("_text").alias("n"), (-F.col("_nth")).alias("nth"), (-F.col("_i")).alias("i"), F.col("_text").alias("text"))
    return found.groupBy(*block, head).agg(F.max(ranked)["text"].alias("opened"))


def rescued(orphans: DataFrame, texts: DataFrame, windows: DataFrame, blocklist: list[str], domain: Callable[[Column], Column], header: str = r"(?m)^=== [^=\n]+ ===\s*$|^\s*#.*$", floor: float = 0.8, least: int = 60, most: int = 8000, longest: int = 50) -> DataFrame:
    """Entries (id, vol, leaf, title, description, orphan_id) made of orphans (orphan_id, vol, leaf, title, context) that no text (id, vol, leaf, title) covers.

    An orphan has a title that reads as one, of at most `longest` characters,
    isn't listed and whose context is of the domain; no text of its leaf has an
    equal, holding, held or like compressed title, none of its volume an equal
    one. Its body, the opened paragraph of its leaf's window (vol, leaf,
    window; in several rows, if `nth` orders them) or else its context, has
    `least` characters and is of the domain. What passes is accepted in order
    of orphan_id unless it is covered in the same way by what was accepted
    before; ids follow the greatest of texts.
    """
    known = texts.select("vol", "leaf", compressed_lemma(F.col("title")).alias("known")).where("known <> ''")
    sane = orphans.where(real_lemma(F.col("title"), longest) & ~blocked_lemma(F.col("title"), blocklist) & F.coalesce(domain(F.col("context")), F.lit(False)))
    sane = staged(sane.withColumn("key", F.coalesce(compressed_lemma(F.col("title")), F.lit(""))))
    there = covered(sane, known, ["vol", "leaf"], "key", "known", floor).select("orphan_id")
    left = sane.join(there, "orphan_id", "left_anti").join(known.select("vol", F.col("known").alias("key")).distinct(), ["vol", "key"], "left_anti")
    left = staged(left.withColumn("_head", F.trim(F.substring_index("title", "(", 1))))
    opened = opened_paragraphs(left.select("vol", "leaf", "_head").distinct(), windows, ["vol", "leaf"], "_head", header, domain, longest)
    body = F.coalesce("opened", "context")
    left = left.join(opened, ["vol", "leaf", "_head"], "left").withColumn("description", gated_body(body, least, most)).where(F.col("description").isNotNull() & domain(body))
    left = staged(left.select("orphan_id", "vol", "leaf", "title", "key", "description"))
    first = keep_first(left.where("key <> ''"), ["vol", "leaf", "key"], ["orphan_id"]).withColumn("id", F.col("orphan_id"))
    nodes = staged(first.select("vol", "leaf", "key", "id"))
    edges = conflicts(nodes, ["vol", "leaf"], "key", floor)
    taken = first_independent(nodes.withColumn("club", F.to_json(F.struct("vol", "key"))), edges).withColumnRenamed("id", "orphan_id")
    new = left.join(taken.union(left.where("key = ''").select("orphan_id")), "orphan_id", "left_semi")
    kept = ["id", "vol", "leaf", "title", "description", "orphan_id"]
    none = texts.limit(0).withColumns({"description": F.lit(""), "orphan_id": F.lit(None).cast(orphans.schema["orphan_id"].dataType)}).select(kept)
    start = texts.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return appended(none, new.withColumn("id", F.lit(None).cast("long")).select(kept), "id", ["orphan_id"]).withColumn("id", F.col("id") + start)
