"""Headwords: from paragraphs to accepted titles, checked openers and readings borne out by a page. Word lists are parameters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions.similarity import indel_ratio, may_reach
from lexweave.functions.text import clean_lead, collapse, fold_accents, without_parens
from lexweave.operators.classify import reject_reason, upper_share
from lexweave.operators.link import keep_first


@dataclass
class TitleRules:
    """Patterns of two groups (title, body); what a loose match's body must begin with; headers, forbidden titles, what a body must be about."""

    strict: str
    loose: str
    marker: str
    header: str
    blocklist: list[str]
    domain: str
    noise: str = "[*#|~^]"
    shortest: int = 20
    length: tuple[int, int] = (3, 60)
    letters: int = 3
    upper: float = 0.6


def titled(text: Column, rules: TitleRules) -> Column:
    """title, body, loose and reject_reason of a paragraph: the first of ten checks that it fails, null if it passes all."""
    norm = collapse(text)
    strict = norm.rlike(rules.strict)
    part = lambda k: F.when(strict, F.regexp_extract(norm, rules.strict, k)).otherwise(F.regexp_extract(norm, rules.loose, k))
    raw, body = part(1), F.trim(part(2))
    title = F.regexp_replace(clean_lead(raw, rules.noise), "^[ .,;:-]+|[ .,;:-]+$", "")
    share = upper_share(F.regexp_extract(raw, r"^[^\s()-]+", 0))
    single = r"^(?:\p{Lu}\.?\s*){1,3}$"
    reason = reject_reason(
        [
            ("short_text", F.length(norm) >= rules.shortest),
            ("no_entry", strict | norm.rlike(rules.loose)),
            ("lower_case_lead", F.coalesce(share >= rules.upper, F.lit(True))),
            ("title_length", F.length(title).between(*rules.length)),
            ("few_letters", F.length(F.regexp_replace(title, r"[^\p{L}]", "")) >= rules.letters),
            ("header", ~title.rlike(rules.header)),
            ("blocklist", ~F.upper(title).isin(rules.blocklist)),
            ("letter_sequence", ~title.rlike(single)),
            ("no_marker", strict | body.rlike(rules.marker)),
            ("domain", body.rlike(rules.domain)),
        ]
    )
    return F.struct(title.alias("title"), body.alias("body"), (~strict).alias("loose"), reason.alias("reject_reason"))


def real_lemma(title: Column, most: int = 50) -> Column:
    """At most `most` characters, something outside parentheses, and there no word all in lower-case a-z."""
    bare = collapse(without_parens(title))
    return F.coalesce((F.length(title) <= most) & (bare != "") & ~bare.rlike(r"(?U)\b[a-z]+\b"), F.lit(False))


def blocked_lemma(title: Column, blocklist: list[str]) -> Column:
    """Whether what stands outside parentheses is listed, whatever its case and accents."""
    return F.coalesce(fold_accents(F.upper(collapse(without_parens(title)))).isin(blocklist), F.lit(False))


def sane_opener(lemma: Column, body: Column, junk: str, marker: str, capitals: int = 4) -> Column:
    """A lemma that is no junk word and starts with `capitals` upper-case letters, before a body that begins with a marker."""
    return ~lemma.rlike(junk) & lemma.rlike(rf"^\p{{Lu}}{{{capitals}}}") & body.rlike(marker)


def counted_rows(df: DataFrame, kind: str, single: str) -> DataFrame:
    """Rows without those of an aggregate: a kind that is present and not `single`."""
    return df.where(F.coalesce(F.col(kind), F.lit("")).isin("", single))


def gated_body(body: Column, least: int = 60, most: int = 8000) -> Column:
    """The first `most` characters of a body of `least` or more; null for a shorter one."""
    return F.when(F.length(body) >= least, F.substring(body, 1, most))


def borne_out(rows: DataFrame, key: list[str], text: str, ours: str, mangled: str, opener: str, floor: float = 0.7, score: Callable[[Column, Column], Column] = indel_ratio) -> DataFrame:
    """Rows (key, verdict, score): CONFIRM if our title stands in the text as words, else MANGLED-MATCHES if the mangled one does, else FUZZY if a line opens like ours, else UNCLEAR.

    What stands in parentheses doesn't count. Lines are scored by distinct
    pairs of title and opener, of which lengths rule most out.
    """
    bare = lambda c: F.trim(without_parens(F.col(c)))
    # \Q..\E: the title as it stands
    stands = lambda c: (bare(c) != "") & F.regexp_like(F.col(text), F.concat(F.lit("(?iU)\\b\\Q"), bare(c), F.lit("\\E\\b")))
    sure = F.when(stands(ours), "CONFIRM").when(stands(mangled), "MANGLED-MATCHES")
    rows = rows.select(*key, F.upper(bare(ours)).alias("_ours"), sure.alias("_sure"), F.when(sure.isNull(), F.col(text)).alias("_text"))
    lines = rows.where("_sure is null").select(*key, "_ours", F.explode(F.split("_text", "\n")).alias("_line"))
    lines = lines.withColumn("_opener", F.upper(F.trim(F.regexp_extract("_line", opener, 1)))).where("_opener <> ''").select(*key, "_ours", "_opener").distinct()
    a, b = F.col("_ours"), F.col("_opener")
    scored = lines.select("_ours", "_opener").distinct().where(may_reach(a, b, floor)).withColumn("score", score(a, b)).where(F.col("score") >= floor)
    best = lines.join(scored, ["_ours", "_opener"]).groupBy(*key).agg(F.max("score").alias("score"))
    out = rows.join(best, key, "left")
    return out.select(*key, F.coalesce("_sure", F.when(F.col("score").isNotNull(), "FUZZY"), F.lit("UNCLEAR")).alias("verdict"), "score")


def cross_referenced(found: DataFrame, text_links: DataFrame, index_links: DataFrame, key: str, lemma: str, name: str, name_key: Callable[[Column], Column], mangled: str) -> DataFrame:
    """found with bucket: KNOWN, CLEANER_TITLE or NOVEL.

    A link (key, name) to the texts counts before one to the index. Cleaner:
    the name's key is another, and the name is mangled where the lemma isn't.
    """
    links = text_links.select(key, F.lit(1).alias("_tier"), F.col(name).alias("_name")).unionByName(index_links.select(key, F.lit(2).alias("_tier"), F.col(name).alias("_name")))
    first = keep_first(links.where("_name is not null"), [key], ["_tier", "_name"])
    rows = found.join(first, key, "left")
    cleaner = (name_key(F.col("_name")) != name_key(F.col(lemma))) & F.col("_name").rlike(mangled) & ~F.col(lemma).rlike(mangled)
    return rows.withColumn("bucket", F.when(F.col("_name").isNull(), "NOVEL").when(cleaner, "CLEANER_TITLE").otherwise("KNOWN")).drop("_tier", "_name")
