"""The index of grams, automata, misses and the rescue flow against plain loops."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lexweave.functions.similarity import indel, indel_ratio
from lexweave.functions.text import compressed_lemma
from lexweave.operators import gram_index, link, rescue, substrings
from lexweave.plans import common, link_queries, registry

SF = "/root/testdata/sf0.001"


def words(seed, n=150):
    """Short strings and changed copies of them; accents, repeated letters, one letter."""
    rng = random.Random(seed)
    out = {"a", "aa", "aaaa", "é", "ñandú"}
    while len(out) < n:
        w = list("".join(rng.choices("abcdeé ", k=rng.randrange(1, 13))))
        out.add("".join(w))
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w) + 1)
            w[i : i + rng.randrange(2)] = rng.choice(["", "x", "a"])
        out.add("".join(w))
    return sorted(out - {""})


def frame(spark, rows, name):
    return spark.createDataFrame([(i % 2, w) for i, w in enumerate(rows)], f"v int, {name} string")


@pytest.mark.parametrize(("floor", "share"), [(0.5, 4096), (0.75, 9), (0.8, 4096), (0.9, 9), (1.0, 4096)])
def test_index_is_complete(spark, floor, share):
    a, b = words(1), words(2)
    blocks = (0,) if floor < 0.75 else (0, 1)
    keys, names = frame(spark, a, "k").where(F.col("v").isin(*blocks)), frame(spark, b, "n")
    found = {tuple(r) for r in gram_index.candidates(keys, names, ["v"], "k", "n", floor, share).collect()}
    want = {(i % 2, x, y) for i, x in enumerate(a) for j, y in enumerate(b) if i % 2 == j % 2 and i % 2 in blocks and indel(x, y) >= floor}
    assert want <= found
    if floor >= 0.8:
        assert len(found) < 0.2 * len(a) * len(b)


def test_whole_list_scores_few_pairs(spark):
    t = common.Tables(spark, SF)
    keys = t.part.select(F.replace("p_name", F.lit("o"), F.lit("")).alias("key")).distinct()
    names = t.part.select(F.col("p_name").alias("name")).distinct()
    n = gram_index.candidates(keys, names, [], "key", "name", 0.75).count()
    assert n <= 0.06 * keys.count() * names.count()


@pytest.mark.parametrize("part_bytes", [40, 8 << 20])
def test_substrings(spark, part_bytes):
    texts, patterns = words(3), [w for w in words(4) if len(w) < 4] + ["", None]
    rows, known = frame(spark, texts + ["", None], "t"), frame(spark, patterns, "p")
    pairs = {(i % 2, t, p) for i, t in enumerate(texts) for j, p in enumerate(patterns) if i % 2 == j % 2 and p and p in t}
    assert {tuple(r) for r in substrings.held_pairs(rows, known, ["v"], "t", "p", part_bytes).collect()} == pairs
    assert {tuple(r) for r in substrings.holding(rows, known, ["v"], "t", "p", False, part_bytes).collect()} == {(v, t) for v, t, _ in pairs}
    assert {tuple(r) for r in substrings.holding(rows, known, ["v"], "t", "p", True, part_bytes).collect()} == {(v, p) for v, _, p in pairs}
    every = {r[0] for r in substrings.holding(rows, known, [], "t", "p", False, part_bytes).collect()}
    assert every == {t for t in texts if any(p and p in t for p in patterns)}
    assert substrings.holding(rows.limit(0), known, ["v"], "t", "p").count() == 0


def test_best_of_misses(spark):
    a, b = words(5, 30) + ["zzz", "qqqq"], words(6, 30)
    keys, names = frame(spark, a, "k"), frame(spark, b, "n").where("v = 0")
    got = {(r["v"], r["k"]): r["score"] for r in link.best_of_misses(keys, names, ["v"], "k", "n", 0.9).collect()}
    assert got == {(0, x): max(indel(x, y) for y in b[::2]) for x in a[::2]}


def greedy(rows, floor=0.8):
    """Accepted of (block, order, key), by a plain loop."""
    taken, out = {}, []
    for block, order, key in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        own = taken.setdefault(block, [])
        if key and not any(k in key or key in k or indel(k, key) >= floor for k in own):
            own.append(key)
            out.append((block, order, key))
    return out


def test_greedy_rescue(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(2), i, w) for i, w in enumerate(rng.choices(words(9, 60), k=150))] + [(0, 500, ""), (0, 501, None), (1, 3, "abcd"), (1, 3, "abcde")]
    df = spark.createDataFrame([(b, o, k, "x") for b, o, k in rows], "v int, o int, k string, id string")
    assert sorted(map(tuple, rescue.greedy_rescue(df, "v", "o", "k").drop("id").collect())) == sorted(greedy([r for r in rows if r[2]]))
    assert rescue.greedy_rescue(df.limit(0), "v", "o", "k").count() == 0


def test_clubs(spark):
    """A member that a neighbour excludes doesn't stand for its club."""
    nodes = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "b"), (5, None)], "id int, club string")
    edges = spark.createDataFrame([(2, 1), (5, 4)], "later int, earlier int")
    assert sorted(r[0] for r in rescue.first_independent(nodes, edges).collect()) == [1, 3, 5]


def test_rescue_flow_by_a_plain_loop(spark):
    """The registered flow over whole tables, step by step as one would write it for a single machine."""
    orphans, texts, windows = link_queries._rescue_tables(common.Tables(spark, SF))
    with_key = lambda df: df.withColumn("key", compressed_lemma(F.col("title")))
    texts_, windows_ = with_key(texts).collect(), {(r["vol"], r["leaf"]): r["window"] for r in windows.collect()}
    ours = re.compile("(?i)th|en")
    by_leaf, by_vol = {}, {}
    for r in texts_:
        by_leaf.setdefault((r["vol"], r["leaf"]), []).append(r["key"])
        by_vol.setdefault(r["vol"], set()).add(r["key"])
    want, next_id = [], max(r["id"] for r in texts_) + 1
    for r in with_key(orphans).orderBy("orphan_id").collect():
        bare = re.sub(r"\s+", " ", re.sub(r"\([^)]*\)", "", r["title"])).strip()
        if len(r["title"]) > 50 or not bare or re.search(r"\b[a-z]+\b", bare) or bare.upper() in ("THE OF", "DER UND") or not ours.search(r["context"]):
            continue
        k, leaf = r["key"], (r["vol"], r["leaf"])
        if k and (any(t and (k == t or k in t or t in k or indel(k, t) >= 0.8) for t in by_leaf.get(leaf, [])) or k in by_vol.get(r["vol"], ())):
            continue
        head = r["title"].split("(")[0].strip()
        opened = [p[m.start() :].strip() for p in re.split(r"\n\s*\n", windows_.get(leaf, "")) if (m := re.search(rf"(?m)^\s*{re.escape(head)}\b(?:\s*\([^)]*\))?\s*[:.,]", p))]
        body = max([p for p in opened if ours.search(p)] or opened, key=len) if opened else r["context"]
        if len(body) < 60 or not ours.search(body):
            continue
        want.append((next_id, *leaf, r["title"], hashlib.md5(body[:8000].encode()).hexdigest(), r["orphan_id"]))
        by_leaf.setdefault(leaf, []).append(k)
        by_vol.setdefault(r["vol"], set()).add(k)
        next_id += 1
    got = sorted(map(tuple, registry.QUERIES["rescue_flow"](spark, SF).collect()))
    assert len(want) > 20 and got == want


def test_opened_paragraphs(spark):
    """By lookup of beginnings, from windows whole and in pieces, as by a loop over all heads and paragraphs."""
    rng = random.Random(11)
    heads = ["AB", "AB CD", "A.B", "CD", "X\\EY", "AB\nCD", "\tAB", "A, B", "(", "D"]
    bits = [*heads, *heads, " ", "\n", "\n\n", ":", ".", ",", " (x)", "(x\ny) ", "th", "\t", "\r\n", "\u2028", "zzz ", "\n# no\n", "=== H ===\n"]
    pieces = [(v, n, "".join(rng.choices(bits, k=12)) + "\n\nlast") for v in range(3) for n in range(40)]
    rows = [(v, h) for v in range(4) for h in heads]
    header = r"(?m)^=== [^=\n]+ ===\s*$|^\s*#.*$"
    line = "(?:^|(?<=[\n\u2028\x85\u2029])|(?<=\r)(?!\n))"
    want = {}
    for v, _, text in pieces:
        plain = re.sub(r"(?m)^=== [^=\n]+ ===[ \t\n\r\f\v]*$|^[ \t\n\r\f\v]*#.*$", "", text)
        for p in re.split(r"\n[ \t\n\r\f\v]*\n", plain):
            for h in heads:
                if m := re.search(rf"{line}[ \t\n\r\f\v]*{re.escape(h)}\b(?:\s*\([^)]*\))?\s*[:.,]", p, re.ASCII):
                    body = p[m.start() :].strip(" \t\n\r\f\v")
                    best = want.get((v, h))
                    if best is None or ("th" in body, len(body)) > ("th" in best, len(best)):
                        want[v, h] = body
    domain = lambda c: c.contains("th")
    keys = spark.createDataFrame(rows, "v int, h string")
    many = spark.createDataFrame(pieces, "v int, nth long, window string")
    whole = spark.createDataFrame([(v, "\n\n".join(t for u, _, t in pieces if u == v)) for v in range(3)], "v int, window string")
    for windows in (many, whole):
        got = {(r["v"], r["h"]): r["opened"] for r in rescue.opened_paragraphs(keys, windows, ["v"], "h", header, domain).collect()}
        assert len(want) > 12 and got == want


def test_heads_are_not_held_against_every_paragraph(spark):
    n = 300
    windows = spark.range(n).select(F.lit(1).alias("v"), F.col("id").alias("nth"), F.concat(F.lit("HEAD"), "id", F.lit(": what is said of it")).alias("window"))
    heads = spark.range(n).select(F.lit(1).alias("v"), F.concat(F.lit("HEAD"), "id").alias("h"))
    got = rescue.opened_paragraphs(heads, windows, ["v"], "h", "^#.*$", lambda c: c.contains("said"))
    assert got.count() == n and len(got.collect()) == n
    assert _most_rows(got._jdf.queryExecution().executedPlan()) <= 3 * n


def _most_rows(node):
    """The most rows that a node of an executed plan gave."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _most_rows(node.executedPlan())
    below = [node.plan()] if kind.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
    rows = node.metrics().get("numOutputRows")
    return max([rows.get().value() if rows.isDefined() else 0, *map(_most_rows, below)])


def test_equal_names_are_not_paired_with_every_place(spark):
    gaz = spark.range(400).select(F.lit("r").alias("region"), F.lit("name").alias("key"), F.concat(F.lit("P"), F.col("id") % 3).alias("parent"), F.concat(F.lit("n"), F.col("id") + 100).alias("name"), F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"), F.when(F.col("id") == 7, "historical").alias("source"))
    places = spark.range(300).select("id", F.lit("name").alias("key"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("P"), F.col("id") % 5)).alias("parent"), F.lit("r").alias("region"))
    overrides = spark.createDataFrame([], "key string, lon double, lat double")
    parents, centroids = spark.createDataFrame([], "parent string, lon double, lat double"), spark.createDataFrame([], "region string, lon double, lat double")
    got = link.geocode(places, gaz, overrides, parents, centroids, indel_ratio, 0.9, bound=0.9).where("tier = 'exact'")
    want = {1: "n107", 2: "n102"}  # a parent's own oldest, else its own first, else the oldest of all
    assert {r["id"]: r["matched"] for r in got.collect()} == {i: want.get(i % 5, "n107") for i in range(300)}
    assert _most_rows(got._jdf.queryExecution().executedPlan()) <= 1200
