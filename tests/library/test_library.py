"""Literal frames for what the shared tables don't have: nulls, ties, markup, files; and the oracle queries."""

import gzip
import json
import re
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from lexweave.functions import rules, similarity, text
from lexweave.operators import classify, link, rescue, segment, serve
from lexweave.plans import common, link_queries, registry
from lexweave.sources import readers, sinks
from lexweave.streaming import ingest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "function,given,want",
    [
        (text.fold_accents, "Älçñ ßé", "Alcn ße"),
        (text.search_fold, "ÀB É", "ab e"),
        (text.compress_alnum, "a-1 ß é", "A1SSE"),
        (text.compress_bare, "ab (cd) e", "ABE"),
        (text.compressed_lemma, "C1a 50 84", "CIASOBA"),
        (text.link_key, "  Vi1a (N0va) [x] r10 100", "biia r10 100"),
        (text.gaz_norm, "La Torre-Alta / d'En Pé", "TORRE ALTA DEN PE"),
        (text.gaz_norm, "LOS X_y*", "LOS X_Y*"),
        (text.article_lower, "El Prat", "el Prat"),
        (text.article_lower, "LOS X", "LOS X"),
        (text.article_lower, "Els Prats", "els Prats"),
        (text.join_hyphens, "a-b-c d- e", "ab-c d- e"),
        (text.join_hyphens_spaced, "a- b c-d", "ab cd"),
        (text.join_broken_words, "ab- cd A- b", "abcd A- b"),
        (text.clean_lead, "*ço#X rest ç", "ÇoX rest ç"),
        (text.clean_lead, "ç*(ñ*) x", "Ç(ñ*) x"),
        (lambda x: text.grouped_number(x.cast("double"), 1), "1234567.26", "1.234.567,3"),
        (text.html_escape, "<a & 'b'>", "&lt;a &amp; &#39;b&#39;&gt;"),
        (text.excerpt, "short", "short"),
        (text.fold_accents, None, None),
    ],
)
def test_text(spark, function, given, want):
    assert one(spark, function(F.lit(given).cast("string"))) == want


def test_text_more(spark):
    assert one(spark, text.excerpt(F.lit("word, " * 100))).endswith("word…")
    assert one(spark, text.name_variants(F.lit("Alt (Sant)"), {"Alt": "Alta"})) == ["ALT", "ALTA", "ALTSANT", "SANTALT"]
    assert one(spark, text.split_particle(F.lit("dePalma x"), "de", "palma")) == "de Palma x"
    assert one(spark, text.strip_trailer(F.lit("Vila. [ed.] "), r"\[ed\.\]")) == "Vila"
    assert one(spark, rules.swap_lead(F.lit("  A.B rest"), F.lit("A.B"), F.lit("C"))) == "C rest"
    assert one(spark, rules.first_label(F.lit("zz"), [("a", "A"), ("z", "Z")])) == "Z"
    assert one(spark, rules.rules_hit(F.lit("az"), [("a", "", "A"), ("q", "", "Q"), ("z", "", "Z")])) == ["A", "Z"]
    assert [one(spark, text.compact_number(F.lit(v))) for v in (12, 1234, 2_500_000)] == ["12.0", "1.2K", "2.5M"]


def test_similarity():
    assert similarity.indel("", "") == 1 and similarity.indel("", "a") == 0
    assert similarity.lcs("llinars", "llinas") == 6
    for a, b in (("abcd", "bd"), ("tide", "diet"), ("éa", "aé")):
        assert similarity.indel(a, b) == similarity.indel(b, a) and 0 <= similarity.indel(a, b) <= 1
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert similarity.lcs(a, b) == table[-1][-1]
    assert similarity.weighted("a b", "b a") == 95 and similarity.weighted("x", "") == 0


HOCR = """<div class='ocr_page' id='page_000007'><p class='ocr_par'><span>A</span><span>&amp;</span><span>b</span></p>
<p class='ocr_par'><span>c</span><div class='ocr_page' id='page_000009'><p class='ocr_par'></p><p class='ocr_par'><span>d</span>"""


def test_hocr(spark, tmp_path):
    with gzip.open(tmp_path / "vol_03.html.gz", "wt") as f:
        f.write(HOCR)
    got = [tuple(r) for r in readers.hocr(spark, str(tmp_path)).orderBy("leaf", "par_no").collect()]
    assert got == [("03", 7, 1, "Ab"), ("03", 7, 2, "c"), ("03", 9, 2, "d")]
    assert [r["text"] for r in readers.hocr(spark, str(tmp_path), flush_at_end=False).where("leaf = 9").collect()] == []


def test_readers(spark, tmp_path):
    (tmp_path / "map.json").write_text(json.dumps({"pages": [{"leafNum": 1, "pageNumber": "i"}, {"leafNum": 1, "pageNumber": "ii"}, {"leafNum": 2, "pageNumber": None}]}))
    assert sorted(map(tuple, readers.page_map(spark, str(tmp_path / "map.json")).collect()), key=str) == [(1, "ii"), (2, None)]
    (tmp_path / "i.jsonl").write_text('{"vol":"01","leaf":3,"title":"X"}\n\n{"vol":"01","leaf":4,"title":"Y","source":"hand"}\n')
    assert [(r["title"], r["source"]) for r in readers.index_records(spark, str(tmp_path / "i.jsonl")).orderBy("leaf").collect()] == [("X", "regex"), ("Y", "hand")]
    leaf = {"vol": "01", "leaf": 5, "entries": [{"title": "A", "stats": {}}, {"title": "A", "stats": {"n": 2}, "cross_references": ["B"]}]}
    (tmp_path / "leaves").mkdir()
    (tmp_path / "leaves/a.json").write_text(json.dumps(leaf))
    (tmp_path / "leaves/b.json").write_text(json.dumps({"vol": "01", "leaf": 6, "entries": []}))
    rows = readers.leaf_entries(spark, str(tmp_path / "leaves")).orderBy("entry_ordinal").collect()
    assert [(r["title"], r["stats"], r["cross_references"], r["entry_ordinal"]) for r in rows] == [("A", None, [], 0), ("A", {"n": 2.0}, ["B"], 1)]
    (tmp_path / "txt").mkdir()
    for name, body in (("tomo02_p0011.txt", "hi"), ("tomo02_p0012.txt", " "), ("x.txt", "no")):
        (tmp_path / "txt" / name).write_text(body)
    assert [tuple(r) for r in readers.page_texts(spark, str(tmp_path / "txt")).collect()] == [("02", 11, "hi")]
    calls = []

    def fetch(offset, limit):
        calls.append(offset)
        if len(calls) == 2:
            raise OSError
        return ([{"a": offset}], offset < 2)

    assert readers.paged(spark, fetch, "a int").count() == 3
    assert readers.with_adapter(spark.range(3), lambda b: b.assign(t="x"), "id long, t string").count() == 3


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", None), (2, 'q"', "")], "id int, x string, y string")
    target = str(tmp_path / "t")
    sinks.replace_table(df, target)
    sinks.replace_table(df.where("id = 1"), target)
    assert spark.read.parquet(target).count() == 1 and [p.name for p in tmp_path.iterdir()] == ["t"]
    sinks.csv(df.coalesce(1), str(tmp_path / "c"))
    assert next((tmp_path / "c").glob("*.csv")).read_text() == 'id,x,y\n1,"a,b",\n2,"q""",\n'
    sinks.json_lines(df, str(tmp_path / "j"))
    sinks.json_by(df, str(tmp_path / "k"), "id")
    assert spark.read.json(str(tmp_path / "k")).count() == 2
    assert sinks.text_windows(df, F.col("x"), [F.col("y"), F.lit("z")]).first()["value"] == "# a,b\nz"


def test_segments(spark):
    df = spark.createDataFrame([(1, "xx ONE a TWO b"), (2, "none"), (3, "END")], "k int, t string")
    got = [tuple(r) for r in segment.openers(df, "k", "t", "[A-Z]{3}").orderBy("k", "nth").collect()]
    assert got == [(1, 1, 3, 9, "ONE", " a "), (1, 2, 9, 14, "TWO", " b"), (3, 1, 0, 3, "END", "")]
    leaves = spark.createDataFrame([("1", 1, "a"), ("1", 2, " "), ("1", 3, "c"), ("1", 9, "z")], "vol string, leaf int, text string")
    got = {r["leaf"]: r["continuations"] for r in segment.continuation_windows(leaves, leaves, "vol", "leaf", "text", 4).collect()}
    assert got == {1: ["c"], 2: ["c"], 3: [], 9: []}


def test_verdicts(spark):
    rows = [("x", "x", "x"), ("y", "x", "x"), ("x", "y", "x"), ("x", "x", "y"), ("a", "b", "c"), ("x", "x", None), ("x", "", "y"), (None, "x", None), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    verdict, consensus, agrees = classify.vote(F.col("a"), F.col("b"), F.col("c"), F.lit("x"))
    got = [tuple(r) for r in df.select(verdict, consensus, agrees).collect()]
    assert got == [("all_agree", "x", True), ("outlier_A", "x", True), ("outlier_B", "x", True), ("outlier_C", "x", True), ("all_differ", None, False), ("agree_2_of_2_AB", "x", True), ("disagree_2_of_2_AC", None, False), ("fewer_than_2_sources", None, False), ("fewer_than_2_sources", None, False)]
    assert one(spark, classify.reject_reason([("a", F.lit(None).cast("boolean"))])) == "a"
    assert one(spark, classify.upper_share(F.lit("12"))) is None


def test_linking(spark):
    t = spark.createDataFrame([(1, "v", "casa"), (2, "v", "casa nova"), (3, "v", "molinet"), (4, "v", "zzz"), (5, "w", "casa"), (6, "v", None)], "tid int, v string, t string")
    i = spark.createDataFrame([(10, "v", "casa"), (11, "v", "casa"), (12, "v", "moline"), (13, "v", "cas")], "iid int, v string, i string")
    got = {r["tid"]: (r["iid"], r["tier"]) for r in link.link_cascade(t, i, ["v"], "tid", "t", "iid", "i", 0.85).collect()}
    assert got == {1: (10, "exact"), 2: (10, "prefix"), 3: (12, "fuzzy"), 4: (None, "none"), 5: (None, "none"), 6: (None, "none")}
    rows = spark.createDataFrame([(1, "b", "CASA"), (2, "b", "CASA"), (3, "b", "CASAS"), (4, "b", "MOLI"), (5, "c", "CASA"), (6, "b", "")], "id int, b string, k string")
    assert sorted(r["id"] for r in rescue.greedy_rescue(rows, "b", "id", "k").collect()) == [1, 4, 5]
    for df in (link.fuzzy_pairs(t, i, ["v"], "t", "i", 0.8), link.covered(t, i, ["v"], "t", "i", 0.8)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_facets_equal_one_group_each(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    q = serve.FacetQuery({"lang": "lang", "source": "source"}, ["text"], {"lang": "en", "source": "src2"}, "the")
    got = {(r["facet"], r["value"]): r["n"] for r in q.counts(docs).collect()}
    want = {}
    for f in q.facets:
        for r in docs.where(q.passes(f)).groupBy(f).count().collect():
            want[f, r[f]] = r["count"]
    assert got == want


def test_stream(spark, tmp_path):
    source, seen = tmp_path / "in", []
    spark.range(3).write.json(str(source))
    stream = ingest.new_files(spark, str(source), "id long")
    each = lambda df, _: seen.append(df.count())
    ingest.once(stream, str(tmp_path / "ck"), each)
    ingest.once(stream, str(tmp_path / "ck"), each)
    assert sum(seen) == 3


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    show = lambda v: None if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted((tuple(show(r[k]) for k in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_queries(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name in registry.SQL:
        want = duck.sql(registry.SQL[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert normal(rows, df.columns) == normal(want.fetchall(), want.columns)


def test_difflib_cascade_and_rescue_by_plain_loops(spark):
    """link_cascade_difflib, greedy_rescue, split_particle and geo_cascade_weighted against plain Python over whole tables."""
    from difflib import SequenceMatcher

    tables = common.Tables(spark, SF)
    texts, index = (df.collect() for df in link_queries._cascade_tables(tables))
    got = {r["text_id"]: (r["index_id"], r["tier"], r["score"]) for r in registry.QUERIES["link_cascade_difflib"](spark, SF).collect()}
    assert len(got) == len(texts)
    for x in texts:
        t, best, most = x["t"], (4, 0.0, 0), None
        for y in index:
            if y["p_brand"] == x["p_brand"]:
                i = y["i"]
                ratio = SequenceMatcher(None, t, i).ratio()
                most = max(most or 0.0, ratio)
                tier = 1 if t == i else 2 if t.startswith(i + " ") or i.startswith(t + " ") else 3 if ratio >= 0.85 else 4
                best = min(best, (tier, -1.0 if tier < 3 else -ratio, y["index_id"])) if tier < 4 else best
        want = (best[2], ["exact", "prefix", "fuzzy"][best[0] - 1], -best[1]) if best[0] < 4 else (None, "none", most)
        assert got[x["text_id"]] == want
    kept = {r["p_partkey"] for r in registry.QUERIES["greedy_rescue"](spark, SF).collect()}
    taken: dict[str, list[str]] = {}
    for r in tables.part.select("p_partkey", "p_brand", text.compress_alpha(F.col("p_name")).alias("k")).orderBy("p_partkey").collect():
        like = any(a in r["k"] or r["k"] in a or similarity.indel(r["k"], a) >= 0.8 for a in taken.setdefault(r["p_brand"], []))
        assert (r["p_partkey"] in kept) == (bool(r["k"]) and not like)
        if not like:
            taken[r["p_brand"]].append(r["k"])
    split = {r["doc_id"]: r["n"] for r in registry.QUERIES["split_particle"](spark, SF).collect()}
    for r in tables.documents.select("doc_id", "text").collect():
        assert split[r["doc_id"]] == len(re.sub(r"(?i)\b(of)(th)", r"\1 \2", r["text"]))
    places, gaz, _, parents, _ = (df.collect() for df in link_queries._geo_tables(tables))
    geo = {r["id"]: (r["tier"], r["matched"]) for r in registry.QUERIES["geo_cascade_weighted"](spark, SF).collect()}
    for p in places:
        near = [g for g in gaz if g["region"] == p["region"]]
        score = lambda g: similarity.weighted(p["key"], g["key"]) / 100
        fuzzy = sorted((g for g in near if len(g["key"]) >= max(4, int(len(p["key"]) * 0.6)) and score(g) >= 0.88), key=lambda g: (-score(g), g["name"]))[:10]
        exact = sorted((g for g in near if g["key"] == p["key"]), key=lambda g: (g["parent"] != p["parent"], g["name"]))
        if p["key"] == "curated place":
            assert geo[p["id"]][0] == "curated"
        elif exact:
            assert geo[p["id"]] == ("exact", exact[0]["name"])
        elif fuzzy:
            assert geo[p["id"]] == ("fuzzy", min(fuzzy, key=lambda g: (g["parent"] != p["parent"], -score(g), g["name"]))["name"])
        else:
            assert geo[p["id"]][0] == ("parent" if p["parent"] in {q["parent"] for q in parents} else geo[p["id"]][0])


def test_entry_module_with_the_training_data_folders_away(tmp_path):
    """The library's queries stay when both folders and the pipeline are deleted, or the tokenizers' package is missing."""
    root = Path(registry.__file__).parent.parent.parent
    for name in ("lexweave", "__spark_entry__.py", "corpus_pipeline.py"):
        (shutil.copytree if (root / name).is_dir() else shutil.copy)(root / name, tmp_path / name)
    count = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op1_') for n in q), len(e.oracle_sql()) > 50)"
    run = lambda code: subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert run(count)[1:] == ["True", "True"]
    assert run("import sys; sys.modules['public_tokenizers'] = None; " + count) == [str(len(registry.QUERIES)), "False", "True"]
    shutil.rmtree(tmp_path / "lexweave/llm")
    assert run(count) == [str(len(registry.QUERIES)), "False", "True"]
    (tmp_path / "corpus_pipeline.py").unlink()
    assert run(count) == [str(len(registry.QUERIES)), "False", "True"]


def test_without_the_training_data_operators():
    """Nothing outside the subpackage imports it, but the entry module."""
    root = Path(registry.__file__).parent.parent
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "lexweave.llm" in p.read_text()]
