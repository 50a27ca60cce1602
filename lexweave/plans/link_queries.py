"""Queries of joins, deduplication and matching."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexweave.functions import text
from lexweave.functions.similarity import difflib_ratio, indel_ratio, weighted_ratio
from lexweave.operators import link, rescue
from lexweave.plans.common import Query, registrar

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
query = registrar(QUERIES, SQL)


def lcs_sql(a: str, b: str) -> str:
    """The longest common subsequence in DuckDB: rows of the usual table, folded over the characters."""
    cell = f"CASE WHEN unicode({b}[x[1]]) = c[1] THEN prev[x[1]] + 1 ELSE greatest(prev[x[1] + 1], r[x[1]]) END"
    row = f"list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j::INT]), lambda r, x: list_append(r, {cell}), [0])"
    return f"list_reduce(list_transform(string_split({a}, ''), lambda c: [unicode(c)]), lambda prev, c: {row}, list_transform(range(0, length({b}) + 1), lambda z: 0))[-1]"


@query("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def left_join_ref(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left").select("doc_id", "lang", "quality", "toxic")


@query("SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def catalog_lookup(t):
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return t.supplier.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name", "r_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def orphans_anti(t):
    return t.customer.join(t.orders.where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1")
def hash_lookup_min(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))


@query("SELECT event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_event FROM events")
def next_match(t):
    return t.events.select("event_id", F.lead("event_id").over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("next_event"))


NAMES = "(SELECT DISTINCT p_type, p_name FROM part)"


@query(f"""SELECT p_type, a, b, score FROM (SELECT p_type, a, b, 2.0::DOUBLE * {lcs_sql('a', 'b')} / (length(a) + length(b)) AS score FROM
(SELECT x.p_type, x.p_name AS a, y.p_name AS b FROM {NAMES} x JOIN {NAMES} y ON x.p_type = y.p_type AND x.p_name < y.p_name)) WHERE score >= 0.8""")
def fuzzy_indel_block(t):
    names = t.part.select("p_type", "p_name").distinct()
    pairs = link.fuzzy_pairs(names.withColumnRenamed("p_name", "a"), names.withColumnRenamed("p_name", "b"), ["p_type"], "a", "b", 0.8)
    return pairs.where("a < b").select("p_type", "a", "b", "score")


TEXTS = "(SELECT p_partkey AS text_id, p_brand, lower(CASE WHEN p_partkey % 3 = 0 THEN replace(p_name, 'e', '') WHEN p_partkey % 5 = 0 THEN p_name || ' extra' ELSE p_name END) AS t FROM part WHERE p_partkey % 2 = 0)"
INDEX = "(SELECT p_partkey AS index_id, p_brand, lower(p_name) AS i FROM part WHERE p_partkey % 2 = 1)"


def _cascade_tables(t):
    key = F.col("p_partkey")
    name = F.lower(F.when(key % 3 == 0, F.replace("p_name", F.lit("e"), F.lit(""))).when(key % 5 == 0, F.concat("p_name", F.lit(" extra"))).otherwise(F.col("p_name")))
    return t.part.where(key % 2 == 0).select(key.alias("text_id"), "p_brand", name.alias("t")), t.part.where(key % 2 == 1).select(key.alias("index_id"), "p_brand", F.lower("p_name").alias("i"))


@query(f"""WITH pairs AS (SELECT x.text_id, x.t, y.index_id, y.i FROM {TEXTS} x JOIN {INDEX} y USING (p_brand)),
sure AS (SELECT text_id, index_id, CASE WHEN t = i THEN 1 ELSE 2 END AS tier, 1.0::DOUBLE AS score FROM pairs WHERE t = i OR starts_with(t, i || ' ') OR starts_with(i, t || ' ')),
rest AS (SELECT DISTINCT t, i FROM pairs WHERE text_id NOT IN (SELECT text_id FROM sure) AND 2.0 * least(length(t), length(i)) >= 0.85 * (length(t) + length(i))),
scored AS (SELECT t, i, 2.0::DOUBLE * {lcs_sql('t', 'i')} / (length(t) + length(i)) AS score FROM rest),
fuzzy AS (SELECT text_id, index_id, 3 AS tier, score FROM pairs JOIN scored USING (t, i) WHERE score >= 0.85 AND text_id NOT IN (SELECT text_id FROM sure)),
best AS (SELECT *, row_number() OVER (PARTITION BY text_id ORDER BY tier, score DESC, index_id) AS place FROM (SELECT * FROM sure UNION ALL SELECT * FROM fuzzy)),
none_ AS (SELECT DISTINCT text_id, t, i FROM pairs WHERE text_id NOT IN (SELECT text_id FROM best)),
miss AS (SELECT text_id, max(score) AS score FROM none_ JOIN (SELECT t, i, 2.0::DOUBLE * {lcs_sql('t', 'i')} / (length(t) + length(i)) AS score FROM (SELECT DISTINCT t, i FROM none_)) USING (t, i) GROUP BY 1)
SELECT x.text_id, b.index_id, coalesce(['exact', 'prefix', 'fuzzy'][b.tier], 'none') AS tier, coalesce(b.score, m.score) AS score FROM {TEXTS} x LEFT JOIN best b ON x.text_id = b.text_id AND b.place = 1 LEFT JOIN miss m ON m.text_id = x.text_id""")
def link_cascade_indel(t):
    """Rows without a link have the best score of their block."""
    return link.link_cascade(*_cascade_tables(t), ["p_brand"], "text_id", "t", "index_id", "i", 0.85)


@query()
def link_cascade_difflib(t):
    return link.link_cascade(*_cascade_tables(t), ["p_brand"], "text_id", "t", "index_id", "i", 0.85, difflib_ratio)


@query(f"""WITH rows_ AS (SELECT DISTINCT p_brand, t AS k FROM {TEXTS}), known AS (SELECT DISTINCT p_brand, i AS o FROM {INDEX}),
hit AS (SELECT DISTINCT r.p_brand, k FROM rows_ r JOIN known USING (p_brand) WHERE k = o OR contains(k, o) OR contains(o, k) OR 2.0 * {lcs_sql('k', 'o')} / (length(k) + length(o)) >= 0.9)
SELECT text_id, x.p_brand, t FROM {TEXTS} x JOIN hit ON x.p_brand = hit.p_brand AND t = k""")
def covered_semi(t):
    texts, index = _cascade_tables(t)
    return link.covered(texts, index, ["p_brand"], "t", "i", 0.9).select("text_id", "p_brand", "t")


@query("""SELECT l_orderkey, l_linenumber, "offset" FROM (SELECT a.l_orderkey, a.l_linenumber, o."offset", row_number() OVER (PARTITION BY a.l_orderkey, a.l_linenumber ORDER BY o.place) AS nth
FROM lineitem a, (VALUES (0, 0), (-1, 1), (1, 2), (-2, 3), (2, 4)) o("offset", place), lineitem b WHERE b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber + o."offset" AND b.l_returnflag = 'R') WHERE nth = 1""")
def band_probe(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber")
    pages = t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("page"), "l_returnflag")
    got = link.neighbour_probe(rows, pages, ["l_orderkey"], "l_linenumber", "page", [0, -1, 1, -2, 2], F.col("l_returnflag") == "R")
    return got.select("l_orderkey", "l_linenumber", "offset")


@query("""WITH d AS (SELECT doc_id, lang, md5(lower(text)) AS k, row_number() OVER (PARTITION BY lang, md5(lower(text)) ORDER BY doc_id) AS nth FROM documents) SELECT doc_id, lang FROM d WHERE nth = 1""")
def dedup_keep_first(t):
    rows = t.documents.select("doc_id", "lang", F.md5(F.lower("text")).alias("k"))
    return link.keep_first(rows, ["lang", "k"], ["doc_id"]).select("doc_id", "lang")


@query("""WITH main AS (SELECT p_partkey, p_name, p_brand, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY CASE p_type WHEN 'STANDARD' THEN 1 WHEN 'ECONOMY' THEN 2 WHEN 'PROMO' THEN 3 END NULLS LAST, p_partkey) AS nth FROM part WHERE p_partkey % 3 <> 0),
first_ AS (SELECT p_partkey, p_name, p_brand FROM main WHERE nth = 1),
extra AS (SELECT p_partkey, p_name, p_brand, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_partkey) AS nth FROM part p WHERE p_partkey % 3 = 0 AND NOT EXISTS (SELECT 1 FROM first_ f WHERE f.p_name = p.p_name AND f.p_brand = p.p_brand))
SELECT * FROM first_ UNION ALL SELECT p_partkey, p_name, p_brand FROM extra WHERE nth = 1""")
def dedup_priority(t):
    rank = F.when(F.col("p_type") == "STANDARD", 1).when(F.col("p_type") == "ECONOMY", 2).when(F.col("p_type") == "PROMO", 3)
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_type")
    return link.priority_dedup(part.where("p_partkey % 3 <> 0"), part.where("p_partkey % 3 = 0"), ["p_name", "p_brand"], rank, ["p_partkey"]).select("p_partkey", "p_name", "p_brand")


@query("""WITH e AS (SELECT p_name, p_type, p_brand FROM part WHERE p_partkey % 4 = 0) SELECT p_partkey FROM part p WHERE p_partkey % 4 <> 0 AND NOT EXISTS (SELECT 1 FROM e WHERE e.p_name = p.p_name AND e.p_type = p.p_type AND e.p_brand = p.p_brand)""")
def key_anti_filter(t):
    keys = ["p_name", "p_type", "p_brand"]
    return t.part.where("p_partkey % 4 <> 0").join(t.part.where("p_partkey % 4 = 0").select(*keys), keys, "left_anti").select("p_partkey")


@query("SELECT p_partkey, split_part(p_name, ' ', 2) AS expected, (p_name = 'bolt' OR list_contains(string_split(p_name, ' '), 'bolt')) AS agrees FROM part")
def loose_match(t):
    return t.part.select("p_partkey", F.split_part("p_name", F.lit(" "), F.lit(2)).alias("expected"), link.loosely_equal(F.lit("bolt"), F.col("p_name")).alias("agrees"))


@query("""SELECT s_suppkey, round(2.5 + a.d * 0.01 * cos(a.g * 2 * 3.141592653589793), 9) AS lon, round(39.5 + a.d * 0.01 * sin(a.g * 2 * 3.141592653589793), 9) AS lat FROM
(SELECT s_suppkey, ('0x' || substr(md5(s_name), 29, 4))::INT / 65535::DOUBLE AS g, ('0x' || substr(md5(s_name), 25, 4))::INT / 65535::DOUBLE AS d FROM supplier) a""")
def jitter(t):
    lon, lat = link.jitter(F.col("s_name"), F.lit(2.5), F.lit(39.5), 0.01)
    return t.supplier.select("s_suppkey", F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


GEO = {
    "gaz": "SELECT r_name AS region, n_name AS key, 'P' || (n_nationkey % 4) AS parent, n_name AS name, n_nationkey * 1.5 AS lon, 40 - n_nationkey * 0.5 AS lat FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 6 <> 5",
    "places": "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 7 = 0 THEN 'curated place' WHEN s_suppkey % 5 = 0 THEN replace(n_name, 'NATION_', 'NATON_') WHEN s_suppkey % 11 = 0 THEN 'nowhere' ELSE n_name END AS key, 'P' || (s_suppkey % 6) AS parent, r_name AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    "parents": "SELECT 'P' || (n_nationkey % 4) AS parent, min(n_nationkey) * 1.5 AS lon, 40 - min(n_nationkey) * 0.5 AS lat FROM nation WHERE n_nationkey % 4 < 2 GROUP BY 1",
    "centroids": "SELECT r_name AS region, r_regionkey * 10.0 AS lon, 40.0 AS lat FROM region WHERE r_regionkey < 4",
}


@query(f"""WITH gaz AS ({GEO['gaz']}), places AS ({GEO['places']}), parents AS ({GEO['parents']}), centroids AS ({GEO['centroids']}),
c1 AS (SELECT id, 1 AS n, 9.0 AS lon, 9.0 AS lat, key AS matched, 1 AS nth FROM places WHERE key = 'curated place'),
c2 AS (SELECT id, 2 AS n, lon, lat, name AS matched, row_number() OVER (PARTITION BY id ORDER BY (p.parent = g.parent)::INT DESC, name, lon) AS nth FROM places p JOIN gaz g ON p.region = g.region AND p.key = g.key),
c3 AS (SELECT id, 3 AS n, lon, lat, name AS matched, row_number() OVER (PARTITION BY id ORDER BY own DESC, score DESC, name) AS nth FROM (SELECT id, lon, lat, name, (p.parent = g.parent)::INT AS own, 2.0::DOUBLE * {lcs_sql('p.key', 'g.key')} / (length(p.key) + length(g.key)) AS score
  FROM places p JOIN gaz g ON p.region = g.region AND length(g.key) >= greatest(4, floor(length(p.key) * 0.6)::INT)) WHERE score >= 0.9),
c4 AS (SELECT id, 4 AS n, q.lon, q.lat, p.parent AS matched, 1 AS nth FROM places p JOIN parents q USING (parent)),
c5 AS (SELECT id, CASE WHEN z.lon IS NULL THEN 6 ELSE 5 END AS n, z.lon, z.lat, CASE WHEN z.lon IS NULL THEN NULL ELSE p.region END AS matched, 1 AS nth FROM places p LEFT JOIN centroids z USING (region)),
every AS (SELECT * FROM c1 UNION ALL SELECT * FROM c2 UNION ALL SELECT * FROM c3 UNION ALL SELECT * FROM c4 UNION ALL SELECT * FROM c5),
best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n) AS first_ FROM every WHERE nth = 1)
SELECT id, ['curated', 'exact', 'fuzzy', 'parent', 'region', 'unmatched'][n] AS tier, lon::DOUBLE AS lon, lat::DOUBLE AS lat, matched FROM best WHERE first_ = 1""")
def geo_cascade(t):
    return link.geocode(*_geo_tables(t), indel_ratio, 0.9, bound=0.9)


def _geo_tables(t):
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    number = F.col("n_nationkey")
    gaz = n.where(number % 6 != 5).select(F.col("r_name").alias("region"), F.col("n_name").alias("key"), F.concat(F.lit("P"), number % 4).alias("parent"), F.col("n_name").alias("name"), (number * F.lit(1.5)).alias("lon"), (40 - number * F.lit(0.5)).alias("lat"))
    s = t.supplier.join(n, F.col("s_nationkey") == number)
    i = F.col("s_suppkey")
    key = F.when(i % 7 == 0, "curated place").when(i % 5 == 0, F.replace("n_name", F.lit("NATION_"), F.lit("NATON_"))).when(i % 11 == 0, "nowhere").otherwise(F.col("n_name"))
    places = s.select(i.alias("id"), key.alias("key"), F.concat(F.lit("P"), i % 6).alias("parent"), F.col("r_name").alias("region"))
    parents = t.nation.where(number % 4 < 2).groupBy(F.concat(F.lit("P"), number % 4).alias("parent")).agg((F.min("n_nationkey") * F.lit(1.5)).alias("lon"), (40 - F.min("n_nationkey") * F.lit(0.5)).alias("lat"))
    centroids = t.region.where("r_regionkey < 4").select(F.col("r_name").alias("region"), (F.col("r_regionkey") * F.lit(10.0)).alias("lon"), F.lit(40.0).alias("lat"))
    overrides = t.spark.createDataFrame([("curated place", 9.0, 9.0)], "key string, lon double, lat double")
    return places, gaz, overrides, parents, centroids


@query()
def geo_cascade_weighted(t):
    return link.geocode(*_geo_tables(t), lambda a, b: weighted_ratio(a, b) / 100, 0.88)


@query()
def greedy_rescue(t):
    rows = t.part.select("p_partkey", "p_brand", text.compress_alpha(F.col("p_name")).alias("k"))
    return rescue.greedy_rescue(rows, "p_brand", "p_partkey", "k")


def _rescue_docs(t):
    """A volume a source, a leaf a length of text in thousands."""
    word = lambda k: F.get(F.split(F.col("text"), "[ \n]+", 4), F.lit(k))
    title = F.upper(F.concat_ws(" ", word(0), word(1)))
    title = F.when(F.length("text") % 7 == 0, F.lower(title)).when(F.length("text") % 5 == 0, F.concat(title, F.lit(" ("), word(2), F.lit(")"))).otherwise(title)
    return t.documents.where("text is not null").select("doc_id", F.col("source").alias("vol"), F.floor(F.col("n_chars") / 1000).cast("int").alias("leaf"), title.alias("title"), "text")


def _entries(docs):
    """What the leaves' windows are made of: entries in order of nth, parted by blank lines."""
    return docs.select("vol", "leaf", F.col("doc_id").alias("nth"), F.concat("title", F.lit(": "), F.substring("text", 1, 200)).alias("window"))


def _rescue_tables(t):
    """Labelled documents are texts, the others orphans; windows the leaves' texts."""
    docs = _rescue_docs(t)
    texts = docs.join(t.labels, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "vol", "leaf", "title")
    orphans = docs.join(t.labels, "doc_id", "left_anti").select(F.col("doc_id").alias("orphan_id"), "vol", "leaf", "title", F.substring("text", 1, 300).alias("context"))
    lines = _entries(docs).groupBy("vol", "leaf").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "window"))), lambda d: d["window"]), "\n\n").alias("window"))
    return orphans, texts, lines


@query()
def rescue_flow(t):
    """Windows are handed on by the entry: a leaf's, which grows with the table, is never one value."""
    orphans, texts, _ = _rescue_tables(t)
    return rescue.rescued(orphans, texts, _entries(_rescue_docs(t)), ["THE OF", "DER UND"], lambda c: c.rlike("(?i)th|en")).select("id", "vol", "leaf", "title", F.md5("description").alias("description"), "orphan_id")


@query("""SELECT d.doc_id, CASE WHEN l.quality = 0 THEN 'low' ELSE d.source END AS source FROM documents d LEFT JOIN labels l USING (doc_id)""")
def conditional_update(t):
    changes = t.labels.where("quality = 0").select("doc_id", F.lit("low").alias("source"))
    return link.updated(t.documents.select("doc_id", "source"), changes, ["doc_id"], ["source"])


@query("""SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY n_name), n_name FROM nation""")
def append_with_ids(t):
    rows = t.nation.select(F.lit(None).cast("long").alias("s_suppkey"), F.col("n_name").alias("s_name"))
    return link.appended(t.supplier.select("s_suppkey", "s_name"), rows, "s_suppkey", ["s_name"])


@query("SELECT o_orderkey AS k, 'order' AS kind FROM orders UNION ALL SELECT c_custkey, 'customer' FROM customer")
def bag_union(t):
    return t.orders.select(F.col("o_orderkey").alias("k"), F.lit("order").alias("kind")).unionByName(t.customer.select(F.col("c_custkey").alias("k"), F.lit("customer").alias("kind")))


@query("SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def set_union(t):
    return t.orders.select(F.col("o_custkey").alias("k")).union(t.customer.select("c_custkey")).distinct()


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def set_difference(t):
    return t.customer.select(F.col("c_custkey").alias("k")).subtract(t.orders.where("o_orderstatus = 'F'").select("o_custkey"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def skip_if_done(t):
    from lexweave.sources.sinks import not_done

    done = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return not_done(t.orders.select("o_orderkey"), done, ["o_orderkey"])
