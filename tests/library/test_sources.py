"""Markup in ranges with pushed filters, version logs, table functions, folds of all scripts."""

import gzip
import os
import random
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual

from lexweave.functions import rules, text
from lexweave.operators import segment
from lexweave.sources import hocr_source, readers, sinks


def volume(rng, first, n, cut=False):
    """Pages of paragraphs, some without letters, some left open; `cut` ends in one."""
    out = []
    for leaf in range(first, first + n):
        out.append(f"<div class='ocr_page' id='page_{leaf:06d}' title='x'>\n")
        for _ in range(rng.randrange(4)):
            spans = "".join(f"<span class='ocrx_cinfo' title='b'>{c}</span>" for c in rng.choices(["a", "é", "&lt;", "", "bc", "Z"], k=rng.randrange(6)))
            out.append(f"<p class='ocr_par' id='p'>\n{spans}{rng.choice(['</p>', '</p>', ''])}\n")
        out.append("</div>\n")
    return "".join(out) + ("<p class='ocr_par'><span>q</span>" if cut else "")


@pytest.fixture(scope="module")
def volumes(tmp_path_factory):
    rng, root = random.Random(4), tmp_path_factory.mktemp("volumes")
    made = {"01": volume(rng, 0, 40), "02": volume(rng, 5, 30, cut=True), "03": volume(rng, 1, 3), "04": ""}
    for vol, body in made.items():
        if vol == "03":
            (root / f"tomo{vol}.html.gz").write_bytes(gzip.compress(body.encode()))
        else:
            (root / f"tomo{vol}.html").write_text(body)
    return str(root), made


@pytest.mark.parametrize(("split", "flush", "block"), [(64 << 20, True, 4 << 20), (700, True, 50), (97, False, 4 << 20), (33, True, 4 << 20)])
def test_ranges_of_markup(spark, volumes, monkeypatch, split, flush, block):
    """Whatever the ranges, what the DataFrame way reads from whole volumes."""
    path, made = volumes
    reader = hocr_source.HocrReader({"path": path, "vol": r"tomo(\d{2})", "split": split, "flush": str(flush).lower()})
    monkeypatch.setattr(hocr_source, "BLOCK", block)
    got = [tuple(r.values()) for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    whole = spark.createDataFrame(list(made.items()), "vol string, content string")
    want = segment.hocr_paragraphs(whole, flush_at_end=flush)
    assert sorted(got) == sorted(map(tuple, want.collect())) and len(got) > 60
    assert sorted(map(tuple, readers.hocr(spark, path, flush, r"tomo(\d{2})", split).collect())) == sorted(got)


def test_pushed_filters(spark, volumes):
    path, _ = volumes
    reader = hocr_source.HocrReader({"path": path})
    other = EqualTo(("text",), "x")
    assert list(reader.pushFilters([EqualTo(("vol",), "02"), In(("leaf",), tuple(range(3, 29))), GreaterThan(("leaf",), 7), LessThanOrEqual(("leaf",), 30), other])) == [other]
    assert {p.vol for p in reader.partitions()} == {"02"}
    leaves = {r["leaf"] for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()}
    assert leaves and min(leaves) >= 8 and max(leaves) <= 28
    df = readers.hocr(spark, path)
    every = df.collect()
    asked = df.where("vol = '02' and leaf in (7, 8, 9) and text <> 'Z'")
    assert sorted(map(tuple, asked.collect())) == sorted(tuple(r) for r in every if r["vol"] == "02" and r["leaf"] in (7, 8, 9) and r["text"] != "Z")
    left = next(x for x in asked._jdf.queryExecution().executedPlan().toString().split("\n") if "Filter" in x)
    assert "leaf" not in left and " = 02" not in left and "text" in left  # Spark checks only what the reader has not taken


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *x: spark.createDataFrame([(i,) for i in x], "i int")
    read = lambda **k: sorted(r[0] for r in sinks.current(spark, path, **k).collect())
    assert sinks.replace_version(rows(1), path) == 1
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.replace_version(rows(1, 2).select((F.col("i") / F.lit(0)).alias("i")), path)  # a writer that dies
    assert read() == [1]
    assert sinks.replace_version(rows(2), path) == 2 and read() == [2]
    assert sinks.replace_version(rows(3), path, base=2) == 3
    with pytest.raises(sinks.Conflict):
        sinks.replace_version(rows(4), path, base=2)
    assert read() == [3] and read(version=1) == [1]
    real = sinks.versions
    try:  # two writers that have read the same log
        sinks.versions = lambda *a: {k: v for k, v in real(*a).items() if k < 3}
        assert sinks.replace_version(rows(5), path) == 4
    finally:
        sinks.versions = real
    assert read() == [5]
    assert len(sinks.clear_versions(spark, path, keep=2)) == 2 and sorted(real(spark, path)) == [3, 4]
    assert len(sinks.clear_versions(spark, path, keep=2, older_than=-60)) >= 0 and read() == [5] and read(version=3) == [3]


def test_openers_hold_places_and_any_character(spark):
    rows = [(1, "ABC one \u0001 two DEF \u0002 é"), (2, None), (3, "none"), (4, "XYZ")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = sorted(map(tuple, segment.openers(df, "id", "text", "[A-Z]{3}").collect()))
    assert got == [(1, 1, 0, 14, "ABC", " one \u0001 two "), (1, 2, 14, 21, "DEF", " \u0002 é"), (4, 1, 0, 3, "XYZ", "")]
    grouped = segment.openers(df, "id", "text", r"([A-Z]{3})\s+").where("id = 1").orderBy("nth").collect()
    assert [r["lemma"] for r in grouped] == ["ABC", "DEF"] and grouped[0]["body"].startswith("one")
    assert segment.openers(df.limit(0), "id", "text", "[A-Z]").count() == 0


def test_rules_of_rows(spark):
    rows = [(2, "b+", "c", "second"), (1, "a", "b", "first"), (3, None, "x", "none"), (4, "c$", None, "gone")]
    frame = spark.createDataFrame(rows, "priority int, pattern string, replacement string, label string")
    made = rules.from_rows(frame)
    assert [r[2] for r in made] == ["first", "second", "gone"]
    assert spark.range(1).select(rules.rewrite(F.lit("aab x bc"), made)).first()[0] == "c x c"
    with pytest.raises(ValueError, match="more than 2"):
        rules.from_rows(frame, most=2)


@pytest.mark.parametrize("fold", ["all", "search"])
def test_fold_of_every_code_point(spark, fold):
    every = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    if fold == "all":
        function, want = text.fold_accents, lambda c: "".join(d for d in unicodedata.normalize("NFD", c) if unicodedata.category(d) != "Mn")
    else:
        every = [c for c in every if len(c.lower()) == 1 and c.lower() == c and unicodedata.category(c) != "Cn"]  # a letter new to one of both libraries may have a lower case there
        function, want = text.search_fold, lambda c: "".join(d for d in unicodedata.normalize("NFD", c) if not "̀" <= d <= "ͯ")
    parts = ["|".join(every[i : i + 500]) for i in range(0, len(every), 500)]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(parts)], "i int, x string").repartition(8)
    for r in df.select("x", function(F.col("x")).alias("y")).collect():
        got, given = r["y"], r["x"]
        if got != "".join(map(want, given)):
            wrong = [c for c in given.split("|") if c and want(c) not in got]
            raise AssertionError([hex(ord(c)) for c in wrong[:5]])
    assert spark.range(1).select(text.fold_accents(F.lit("й ά é 각"))).first()[0] == "и α e " + unicodedata.normalize("NFD", "각")


def test_variants_by_hand(spark):
    of = lambda x: spark.range(1).select(text.name_variants(F.lit(x), {})).first()[0]
    assert of("RAMIS (Son)") == ["CARAMIS", "RAMIS", "RAMISSON", "SONRAMIS"]
    assert {"CABOBLANCO", "CAPBLANCO"} <= set(of("BLANCO (cabo, Mallorca)"))
    assert of("CAS BRAU") == ["CABRAU", "CANBRAU", "CASBRAU"]
    assert of("CA SEROL") == ["CANASEROL", "CANSEROL", "CASEROL"]


def test_paragraph_by_blank_lines(spark):
    page = "=== 1 ===\nLEAD one\ngoes on the way\n \nnoise\nLEAD: two\n\n\nLEAD"
    df = spark.createDataFrame([(1, page), (2, "nothing"), (3, None)], "id int, text string")
    got = segment.best_paragraph(df, "id", "text", r"^===.*===$", "^LEAD", "the").collect()
    assert [tuple(r) for r in got] == [(1, 0, "LEAD one\ngoes on the way")]


@pytest.mark.parametrize("n", [0, 1, 40, 41, 1000])
def test_pages_are_followed_by_executors(spark, n):
    """A service of short pages that says more than it has beyond its end; integers beside nulls are exact."""
    driver = os.getpid()

    def fetch(offset, limit):
        assert os.getpid() != driver
        rows = [{"a": 2**60 + i, "b": None if i % 2 else 2**60 + 1, "c": f"r{i}"} for i in range(offset, min(offset + min(limit, 7), n))]
        return (rows, offset + len(rows) < n) if offset <= n else ([{"a": -1, "b": -1, "c": "beyond"}], True)

    want = [(2**60 + i, None if i % 2 else 2**60 + 1, f"r{i}") for i in range(n)]
    got = readers.paged(spark, fetch, "a long, b long, c string", page=10, stretch=4)
    assert sorted(map(tuple, got.collect())) == want


def test_short_ranges_read_little(volumes, monkeypatch, tmp_path):
    (tmp_path / "tomo01.html").write_bytes(b"x" * 1_000_000)
    reader, sizes = hocr_source.HocrReader({"path": str(tmp_path), "split": 70_000}), []
    monkeypatch.setattr(hocr_source, "pages", lambda blocks, start, end: iter([sizes.append(len(next(blocks)))][:0]))
    assert len([list(reader.read(p)) for p in reader.partitions()]) == 15 and max(sizes[:-1]) == 70_000
    monkeypatch.setattr(hocr_source, "RANGES", 4)
    assert [p.start for p in reader.partitions()] == [0, 250_000, 500_000, 750_000]


def test_a_file_a_text(spark, tmp_path):
    """Names and whole texts come back, written by tasks in few folders, twice the same."""
    rows = [(f"tomo{i % 3 + 1:02d}_p{i}.txt", f"é {i}\nline\r\n \u0001") for i in range(300)] + [("tomo01_p900.txt", None), ("other.txt", "x")]
    df, path = spark.createDataFrame(rows, "name string, t string"), str(tmp_path / "t")
    for _ in range(2):
        sinks.text_files(df, path, "name", "t", folders=4)
    assert sorted(os.listdir(path)) == [f"part-{k:03d}" for k in range(4)]
    got = readers.page_texts(spark, f"{path}/*", r"(\d{2})_p(\d+)\.txt$").collect()
    assert sorted(map(tuple, got)) == sorted((f"{i % 3 + 1:02d}", i, rows[i][1]) for i in range(300))
