"""Markup and page text to paragraphs and entries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MARK = "\u0001"  # stands where a text is cut


def hocr_paragraphs(volumes: DataFrame, content: str = "content", flush_at_end: bool = True, leaves: list[int] | None = None) -> DataFrame:
    """Rows (vol, leaf, par_no, text) from rows (vol, content) of character-wise OCR markup.

    A page tag `ocr_page` with a number in its id opens a leaf, `ocr_par` a
    paragraph, which `</p>`, the next paragraph, the next page or (unless
    flush_at_end is off) the end closes. Text is the characters of spans that
    hold exactly one; an encoded one is none. Paragraphs without text go.
    """
    pages = F.split(F.regexp_replace(F.col(content), r"<div[^>]*ocr_page[^>]*>", MARK + "$0"), MARK)
    page = volumes.select("vol", F.size(pages).alias("n_pages"), F.posexplode(pages).alias("nth", "page")).where("nth > 0")
    page = page.withColumn("leaf", F.regexp_extract("page", r"id=[\"'][A-Za-z_]*0*(\d+)[\"']", 1).cast("int"))
    page = page.withColumn("last_page", F.col("nth") == F.col("n_pages") - 1)
    if leaves is not None:
        page = page.where(F.col("leaf").isin(leaves))
    parts = F.split(F.regexp_replace("page", r"<p[^>]*ocr_par[^>]*>", MARK), MARK)
    par = page.select("vol", "leaf", "last_page", F.size(parts).alias("n"), F.posexplode(parts).alias("par_no", "raw")).where("par_no > 0")
    if not flush_at_end:
        par = par.where(~(F.col("last_page") & (F.col("par_no") == F.col("n") - 1) & ~F.col("raw").contains("</p>")))
    body = F.substring_index("raw", "</p>", 1)
    text = F.array_join(F.regexp_extract_all(body, F.lit(r"<span[^>]*>([^<])</span>"), 1), "")
    return par.select("vol", "leaf", "par_no", text.alias("text")).where("text <> ''")


def html_paragraphs(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Rows (key, par_no, text) of the `<p>` elements, closed or not; scripts and styles are cut out first."""
    plain = F.regexp_replace(html, r"<script[^>]*>[\s\S]*?</script>|<style[^>]*>[\s\S]*?</style>", "")
    parts = F.split(plain, "<p>")
    rows = pages.select(key, F.posexplode(parts).alias("par_no", "raw")).where("par_no > 0")
    body = F.regexp_replace(F.substring_index("raw", "</p>", 1), "<[^>]*>", " ")
    return rows.select(key, "par_no", F.trim(F.regexp_replace(body, r"[ \n\t\r]+", " ")).alias("text"))


def opener_table(pattern: str, key_type: str):
    """A table function of (key, text) rows: (key, nth, start, end, lemma, body) of a text's openers.

    The lemma is the pattern's first group, or else all that it matches; a body
    runs from there to the next opener or the text's end. Places are characters
    from 0: `start` that of the opener, `end` that after the body. Patterns are
    Python's; null texts give no rows.
    """
    found = re.compile(pattern)

    @F.arrow_udtf(returnType=f"key {key_type}, nth int, start int, end int, lemma string, body string")
    class Openers:
        def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
            which: list[int] = []
            out: list[tuple] = []
            for i, text in enumerate(rows.column(1).to_pylist()):
                hits = list(found.finditer(text or ""))
                ends = [*(h.start() for h in hits[1:]), len(text or "")]
                which += [i] * len(hits)
                out += [(n, h.start(), e, h[1] if found.groups else h[0], text[h.end() : e]) for n, (h, e) in enumerate(zip(hits, ends, strict=False), 1)]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.table([rows.column(0).take(pa.array(which, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["key", "nth", "start", "end", "lemma", "body"])

    return Openers


def openers(texts: DataFrame, key: str, text: str, opener: str) -> DataFrame:
    """Rows (key, nth, start, end, lemma, body) of opener_table(), the key under its own name."""
    rows = texts.select(key, F.col(text).cast("string"))
    return opener_table(opener, rows.schema[key].dataType.simpleString())(rows.asTable()).withColumnRenamed("key", key)


def entry(text: Column, strict: str, loose: str, body_marker: str) -> Column:
    """struct(title, body, loose) by the strict grammar, else by the loose one if the body has the marker; else null.

    Both patterns have the title as group 1 and the body as group 2.
    """
    parts = lambda p, is_loose: F.struct(F.trim(F.regexp_extract(text, p, 1)).alias("title"), F.trim(F.regexp_extract(text, p, 2)).alias("body"), F.lit(is_loose).alias("loose"))
    return F.when(text.rlike(strict), parts(strict, False)).when(text.rlike(loose) & F.regexp_extract(text, loose, 2).rlike(body_marker), parts(loose, True))


def best_paragraph(texts: DataFrame, key: str, text: str, header: str, opener: str, signal: str) -> DataFrame:
    """Rows (key, par_no, paragraph): of the paragraphs in which a line has the opener, from there on, those with the signal first, then the longest, then the first.

    Blank lines part paragraphs; header lines go first. Patterns see lines: ^ and $ are theirs.
    """
    plain = F.regexp_replace(text, f"(?m){header}", "")
    rows = texts.select(key, F.posexplode(F.split(plain, r"\n\s*\n")).alias("par_no", "whole")).where(F.col("whole").rlike(f"(?m){opener}"))
    rows = rows.select(key, "par_no", F.trim(F.regexp_extract("whole", f"(?m)(?:{opener})[\\s\\S]*", 0)).alias("paragraph"))
    order = Window.partitionBy(key).orderBy(F.col("paragraph").rlike(signal).cast("int").desc(), F.length("paragraph").desc(), "par_no")
    return rows.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")


def continuation_windows(leaves: DataFrame, targets: DataFrame, vol: str, leaf: str, text: str, k: int) -> DataFrame:
    """For each target the texts of the next k - 1 leaves that exist and aren't blank, in order.

    The offset is exploded, so the join is on equal keys whatever the gaps.
    """
    want = targets.select(vol, leaf, F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("offset")).withColumn("next_leaf", F.col(leaf) + F.col("offset"))
    have = leaves.select(F.col(vol).alias("_vol"), F.col(leaf).alias("_leaf"), F.col(text).alias("_text")).where(F.trim("_text") != "")
    found = want.join(have, (want[vol] == have["_vol"]) & (want["next_leaf"] == have["_leaf"]), "left")
    lists = found.groupBy(vol, leaf).agg(F.array_sort(F.collect_list(F.when(F.col("_text").isNotNull(), F.struct("offset", "_text")))).alias("next"))
    return lists.select(vol, leaf, F.transform("next", lambda s: s["_text"]).alias("continuations"))


def window_size(rows: DataFrame, keys: list[str], is_long: Column, long: int = 4, short: int = 2) -> DataFrame:
    """long for a leaf with any entry of the long kind, else short."""
    return rows.groupBy(*keys).agg(F.max(F.when(is_long, long).otherwise(short)).alias("window"))
