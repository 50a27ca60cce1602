"""Search through postings, the order of a language, loads that are handed on again."""

import re
import shutil

import pytest
from pyspark.sql import functions as F

from lexweave.operators import link, search_index, serve
from lexweave.streaming import ingest


def test_search_reads_few_texts(spark, tmp_path):
    rows = [(i, f"Text número {i} about {['ships', 'Ríos', 'mills'][i % 3]}, {'rare word ' if i == 77 else ''}end") for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "ab"), (1003, "\U0001f600 rare ẃord \U0001f600\U0001f600")]
    df, path = spark.createDataFrame(rows, "id long, t string"), str(tmp_path / "index")
    search_index.build(df, "id", F.col("t"), path, buckets=32)
    fold = lambda s: s.lower().replace("ú", "u").replace("í", "i").replace("ẃ", "w")
    for needle in ("RARE word", "rios, end", "numero 12", "ab", "x", "", "número 399 about mills, end and more", "zzz", "\U0001f600\U0001f600", "e"):
        got = sorted(r[0] for r in search_index.search(spark, path, "id", needle).collect())
        assert got == sorted(i for i, t in rows if t is not None and fold(needle) in fold(t)), needle
    plan = search_index.search(spark, path, "id", "rare word")._jdf.queryExecution().executedPlan().toString()
    buckets = re.search(r"PartitionFilters: \[[^\]]*?bucket#\d+ (?:IN \(([\d,]+)\)|= (\d+))", plan)
    assert len((buckets[1] or buckets[2]).split(",")) <= 3 < 0.1 * 32
    search_index.build(df.limit(0), "id", F.col("t"), str(tmp_path / "none"))
    assert search_index.search(spark, str(tmp_path / "none"), "id", "rare word").count() == 0


def test_order_of_a_language(spark):
    """Expected as a Catalan dictionary has it, numbers by value, marks before case."""
    want = ["c", "ca", "Ca", "ça", "cb", "cel", "cell", "cel·la", "celma", "dia 2", "dia 10", "dia 10b", "n", "ñ", "na", "ña", "nb", "Òrrius", "os"]
    df = spark.createDataFrame([(w,) for w in reversed(want)], "w string")
    assert [r[0] for r in df.orderBy(serve.locale_order(F.col("w")), "w").collect()] == want


def test_a_batch_handed_on_again(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = lambda *rows: spark.createDataFrame(rows, "vol string, leaf int, x string")
    read = lambda: sorted((str(r["vol"]), r["leaf"], r["x"]) for r in spark.read.schema("x string, vol string, leaf int").parquet(path).collect())
    load = ingest.replace_leaves(path, ["vol", "leaf"])
    one = batch(("01", 1, "a"), ("01", 1, "b"), ("02", 1, "c"))
    assert ingest.undone(one, path, ["vol", "leaf"]).count() == 3
    load(one, 0)
    load(one, 0)
    assert read() == [("01", 1, "a"), ("01", 1, "b"), ("02", 1, "c")]
    two = batch(("01", 1, "new"), ("03", 7, "d"))
    assert [r["leaf"] for r in ingest.undone(two, path, ["vol", "leaf"]).collect()] == [7]
    load(two, 1)
    load(two, 1)
    assert read() == [("01", 1, "new"), ("02", 1, "c"), ("03", 7, "d")]


def test_leaves_share_folders(spark, tmp_path):
    """As many folders as are asked for, whatever the leaves; null and empty keys are leaves, columns that a batch lacks stay, and what a crash leaves goes."""
    path = str(tmp_path / "t")
    load = ingest.replace_leaves(path, ["k"], folders=8)
    shape = "k string, x string, y int"
    read = lambda: {r["k"]: (r["x"], r["y"]) for r in spark.read.schema(shape).parquet(path).collect()}
    load(spark.createDataFrame([], shape), 0)
    assert read() == {}
    want = {f"{n:03d}": ("a", n) for n in range(500)} | {None: ("b", 1), "": ("c", 2)}
    load(spark.createDataFrame([(k, *v) for k, v in want.items()], shape), 0)
    assert read() == want and len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("_folder=")]) == 8
    assert ingest.undone(spark.createDataFrame([("", "", 0), ("new", "", 0)], shape), path, ["k"]).count() == 1
    few = spark.createDataFrame([(None, "new"), ("007", "new"), ("else", "new")], "k string, x string")
    load(few, 1)
    want |= {None: ("new", None), "007": ("new", None), "else": ("new", None)}
    assert read() == want
    folder = next(p for p in (tmp_path / "t").glob("_folder=*"))  # as if the old generation had not been deleted
    now = next(folder.iterdir())
    shutil.copytree(now, folder / "_generation=0")
    shutil.copytree(folder, tmp_path / "t" / "_next-0" / folder.name)
    load(few, 1)
    assert read() == want and spark.read.schema(shape).parquet(path).count() == len(want)
    with pytest.raises(ValueError, match="another number"):
        ingest.replace_leaves(path, ["k"], folders=9)(few, 2)
    assert not list((tmp_path / "t").glob("_next-*")) and all(len(list(p.iterdir())) == 1 for p in (tmp_path / "t").glob("_folder=*"))


def test_numbers_of_many_rows(spark):
    """More rows than a sample of ranges holds, with columns that make the ranges' sizes other than those of the keys alone."""
    df = spark.range(0, 60000, 1, 6).select((F.col("id") * 7919 % 60000).alias("k"), F.repeat(F.md5(F.col("id").cast("string")), 40).alias("wide"))
    got = serve.places(df, "k")
    assert got.where("place = k + 1 and length(wide) = 1280").count() == 60000 == got.count()
    new = link.appended(df.limit(0), df.withColumn("n", F.lit(None).cast("long")).select("k", "wide"), "k", ["wide"])
    assert new.agg(F.min("k"), F.max("k"), F.count_distinct("k"), F.max(F.length("wide"))).first()[:] == (1, 60000, 60000, 1280)


def test_postings_are_made_by_the_text(spark):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"bucket": pa.array([0, 0, 1], pa.int32()), "key": [5, 6, 7], "folded": ["abcabc\U0001f600", "xabc", "ab"]})
    got = sorted((r["bucket"], r["gram"], r["keys"]) for b in search_index._postings(iter([batch])) for r in b.to_pylist())
    assert got == [(0, "abc", [5, 6]), (0, "bca", [5]), (0, "bc\U0001f600", [5]), (0, "cab", [5]), (0, "xab", [6])]
