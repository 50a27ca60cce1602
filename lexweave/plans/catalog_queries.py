"""Queries of headwords, whole-list matching, cross-references and the order of what is shown."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.functions import text
from lexweave.functions.similarity import indel_ratio
from lexweave.operators import headword, link, serve
from lexweave.plans.common import Query, registrar
from lexweave.plans.link_queries import GEO, INDEX, TEXTS, _cascade_tables, _geo_tables, lcs_sql

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
query = registrar(QUERIES, SQL)

SPACED = r"trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'))"
RULES = headword.TitleRules("^([A-Z][a-z]+ [^.:]{0,70}):(.*)$", r"^([^ .]{2,70})[., ]+(.*)$", "^(?:the|de|und|of|la|en)", "^(?:Licensed|This work)", ["ALL", "THE", "DIE"], "th|en", upper=0.1)


@query(f"""WITH n AS (SELECT doc_id, {SPACED} AS x FROM documents),
p AS (SELECT *, regexp_matches(x, '{RULES.strict}') AS strict, CASE WHEN regexp_matches(x, '{RULES.strict}') THEN '{RULES.strict}' ELSE '{RULES.loose}' END AS pattern FROM n),
e AS (SELECT doc_id, x, strict, CASE WHEN strict THEN regexp_extract(x, '{RULES.strict}', 1) ELSE regexp_extract(x, '{RULES.loose}', 1) END AS raw, trim(CASE WHEN strict THEN regexp_extract(x, '{RULES.strict}', 2) ELSE regexp_extract(x, '{RULES.loose}', 2) END) AS body FROM p),
t AS (SELECT *, regexp_extract(raw, '^[^\\s()-]*') AS head FROM e),
u AS (SELECT *, regexp_replace(translate(regexp_replace(head, '[*#|~^]', '', 'g'), 'çñ', 'ÇÑ') || substr(raw, length(head) + 1), '^[ .,;:-]+|[ .,;:-]+$', '', 'g') AS title,
length(regexp_replace(head, '[^\\p{{Lu}}]', '', 'g')) / nullif(length(regexp_replace(head, '[^\\p{{L}}]', '', 'g')), 0) AS share FROM t)
SELECT doc_id, title, NOT strict AS loose, CASE WHEN length(x) < 20 THEN 'short_text' WHEN NOT strict AND NOT regexp_matches(x, '{RULES.loose}') THEN 'no_entry' WHEN share < 0.1 THEN 'lower_case_lead'
WHEN length(title) NOT BETWEEN 3 AND 60 THEN 'title_length' WHEN length(regexp_replace(title, '[^\\p{{L}}]', '', 'g')) < 3 THEN 'few_letters' WHEN regexp_matches(title, '{RULES.header}') THEN 'header'
WHEN upper(title) IN ('ALL', 'THE', 'DIE') THEN 'blocklist' WHEN regexp_matches(title, '^(?:\\p{{Lu}}\\.?[\\s]*){{1,3}}$') THEN 'letter_sequence'
WHEN NOT strict AND NOT regexp_matches(body, '{RULES.marker}') THEN 'no_marker' WHEN NOT regexp_matches(body, '{RULES.domain}') THEN 'domain' END AS reject_reason FROM u""")
def title_chain(t):
    return t.documents.where("text is not null").select("doc_id", headword.titled(F.col("text"), RULES).alias("e")).select("doc_id", "e.title", "e.loose", "e.reject_reason")


LEMMA = "upper(left(p_name, 3)) || substr(p_name, 4) || CASE WHEN p_partkey % 4 = 0 THEN ' (' || lower(p_type) || ')' ELSE '' END"


def _lemma():
    return F.concat(F.upper(F.substring("p_name", 1, 3)), F.substring("p_name", F.lit(4), F.length("p_name")), F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit(" ("), F.lower("p_type"), F.lit(")"))).otherwise(""))


@query(f"""WITH l AS (SELECT p_partkey, {LEMMA} AS x, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE {LEMMA} END AS y FROM part), b AS (SELECT *, trim(regexp_replace(regexp_replace(y, '\\([^)]*\\)', '', 'g'), '[\\s]+', ' ', 'g')) AS bare FROM l)
SELECT p_partkey, length(y) <= 50 AND bare <> '' AND NOT regexp_matches(bare, '\\b[a-z]+\\b') AS is_real, upper(bare) IN ('HOT BOLT', 'SMALL WIDGET') AS blocked FROM b""")
def lemma_filters(t):
    title = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(_lemma())
    return t.part.select("p_partkey", headword.real_lemma(title).alias("is_real"), headword.blocked_lemma(title, ["HOT BOLT", "SMALL WIDGET"]).alias("blocked"))


@query("""SELECT p_partkey, NOT regexp_matches(x, '^(?:[A-Z]{2,3}|RED|TOMO)$') AND regexp_matches(x, '^\\p{Lu}{4}') AND regexp_matches(p_type, '^(?:PROMO|ECONOMY)') AS sane FROM (SELECT *, upper(split_part(p_name, ' ', 1)) AS x FROM part)""")
def opener_sanity(t):
    lemma = F.upper(F.split_part("p_name", F.lit(" "), F.lit(1)))
    return t.part.select("p_partkey", headword.sane_opener(lemma, F.col("p_type"), "^(?:[A-Z]{2,3}|RED|TOMO)$", "^(?:PROMO|ECONOMY)").alias("sane"))


@query("SELECT p_partkey FROM part WHERE NOT (p_type IS NOT NULL AND p_type <> '' AND p_type <> 'PROMO')")
def aggregate_exclusion(t):
    return headword.counted_rows(t.part, "p_type", "PROMO").select("p_partkey")


@query("SELECT doc_id, CASE WHEN length(text) >= 60 THEN md5(left(text, 8000)) END AS body FROM documents")
def length_gate(t):
    return t.documents.select("doc_id", F.md5(headword.gated_body(F.col("text"))).alias("body"))


LINE = r"^\s*([A-Z][a-z]{2,20})"
OURS = "CASE lang WHEN 'en' THEN 'Thering (x)' WHEN 'fr' THEN 'Lement' WHEN 'de' THEN 'Derein' ELSE 'Ciente' END"


@query(f"""WITH d AS (SELECT doc_id, text, trim(regexp_replace({OURS}, '\\([^)]*\\)', '', 'g')) AS o, 'und' AS m FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, text, upper(o) AS o, CASE WHEN regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}\\p{{M}}_])' || o || '($|[^\\p{{L}}\\p{{N}}\\p{{M}}_])') THEN 'CONFIRM' WHEN regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}\\p{{M}}_])' || m || '($|[^\\p{{L}}\\p{{N}}\\p{{M}}_])') THEN 'MANGLED-MATCHES' END AS sure FROM d),
l AS (SELECT DISTINCT doc_id, o, upper(regexp_extract(line, '{LINE}', 1)) AS z FROM (SELECT doc_id, o, unnest(string_split(text, chr(10))) AS line FROM s WHERE sure IS NULL)),
k AS (SELECT o, z, 2.0::DOUBLE * {lcs_sql('o', 'z')} / (length(o) + length(z)) AS score FROM (SELECT DISTINCT o, z FROM l WHERE z <> '' AND 2.0 * least(length(o), length(z)) >= 0.7 * (length(o) + length(z)))),
b AS (SELECT doc_id, max(score) AS score FROM l JOIN k USING (o, z) WHERE score >= 0.7 GROUP BY 1)
SELECT s.doc_id, coalesce(sure, CASE WHEN b.score IS NOT NULL THEN 'FUZZY' ELSE 'UNCLEAR' END) AS verdict, b.score FROM s LEFT JOIN b USING (doc_id)""")
def adjudicate(t):
    ours = F.when(F.col("lang") == "en", "Thering (x)").when(F.col("lang") == "fr", "Lement").when(F.col("lang") == "de", "Derein").otherwise("Ciente")
    rows = t.documents.where("text is not null").select("doc_id", "text", ours.alias("ours"), F.lit("und").alias("mangled"))
    return headword.borne_out(rows, ["doc_id"], "text", "ours", "mangled", LINE)


def _cascade_sql(texts: str, index: str, floor: float) -> str:
    """Rows (text_id, name) of the best link of each text within p_brand; ties to the smallest id."""
    return f"""SELECT text_id, i AS name FROM (SELECT *, row_number() OVER (PARTITION BY text_id ORDER BY tier, score DESC, index_id) AS place FROM (
SELECT text_id, index_id, i, CASE WHEN t = i THEN 1 WHEN starts_with(t, i || ' ') OR starts_with(i, t || ' ') THEN 2 ELSE 3 END AS tier,
CASE WHEN t = i OR starts_with(t, i || ' ') OR starts_with(i, t || ' ') THEN 1.0::DOUBLE ELSE score END AS score
FROM (SELECT x.text_id, x.t, y.index_id, y.i, k.score FROM {texts} x JOIN {index} y USING (p_brand) LEFT JOIN
(SELECT t, i, 2.0::DOUBLE * {lcs_sql('t', 'i')} / (length(t) + length(i)) AS score FROM (SELECT DISTINCT t, i FROM {texts} JOIN {index} USING (p_brand) WHERE 2.0 * least(length(t), length(i)) >= {floor} * (length(t) + length(i)))) k ON k.t = x.t AND k.i = y.i))
WHERE tier < 3 OR score >= {floor}) WHERE place = 1"""


_A = f"(SELECT index_id, p_brand, i FROM {INDEX} WHERE index_id % 3 = 0)"
_B = f"(SELECT index_id, p_brand, i FROM {INDEX} WHERE index_id % 3 <> 0)"
_FIRST = lambda x: f"upper(regexp_replace({x}, '[^A-Za-z0-9]', '', 'g'))"


@query(f"""WITH f AS (SELECT text_id, t, a.name AS a, b.name AS b FROM {TEXTS} x LEFT JOIN ({_cascade_sql(TEXTS, _A, 0.85)}) a USING (text_id) LEFT JOIN ({_cascade_sql(TEXTS, _B, 0.85)}) b USING (text_id))
SELECT text_id, CASE WHEN n IS NULL THEN 'NOVEL' WHEN {_FIRST('n')} <> {_FIRST('t')} AND regexp_matches(n, 'e|ll') AND NOT regexp_matches(t, 'e|ll') THEN 'CLEANER_TITLE' ELSE 'KNOWN' END AS bucket FROM (SELECT text_id, t, coalesce(a, b) AS n FROM f)""")
def xref_bucket(t):
    texts, index = _cascade_tables(t)
    names = index.select(F.col("index_id"), F.col("i").alias("name"))

    def links(part):
        found = link.link_cascade(texts, index.where(part), ["p_brand"], "text_id", "t", "index_id", "i", 0.85)
        return found.join(names, "index_id").select("text_id", "name")

    got = headword.cross_referenced(texts, links("index_id % 3 = 0"), links("index_id % 3 <> 0"), "text_id", "t", "name", text.compress_alnum, "e|ll")
    return got.select("text_id", "bucket")


@query(f"""WITH k AS (SELECT DISTINCT replace(p_name, 'o', '') AS k FROM part WHERE p_partkey % 2 = 0 UNION SELECT DISTINCT p_name FROM part WHERE p_partkey % 3 = 0), n AS (SELECT DISTINCT p_name AS n FROM part WHERE p_partkey % 2 = 1),
s AS (SELECT k, n, CASE WHEN k = n THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * {lcs_sql('k', 'n')} / (length(k) + length(n)) END AS score FROM k, n WHERE k <> ''),
b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, n) AS place FROM s WHERE score >= 0.75) SELECT k AS key, n AS name, score FROM b WHERE place = 1""")
def whole_list_match(t):
    keys = t.part.where("p_partkey % 2 = 0").select(F.replace("p_name", F.lit("o"), F.lit("")).alias("key")).union(t.part.where("p_partkey % 3 = 0").select("p_name"))
    return link.best_in_list(keys, t.part.where("p_partkey % 2 = 1").select(F.col("p_name").alias("name")), "key", "name", 0.75)


@query("""SELECT 'id' AS way, c_custkey, c_name FROM customer WHERE c_custkey = 42 UNION ALL
SELECT * FROM (SELECT 'title', c_custkey, c_name FROM customer WHERE contains(lower(c_name), '00007') ORDER BY lower(c_name), c_custkey LIMIT 1)""")
def detail_lookup(t):
    cols = ("c_custkey", "c_name")
    found = t.customer.where(text.search_fold(F.col("c_name")).contains("00007")).orderBy(text.search_fold(F.col("c_name")), "c_custkey").limit(1)
    return t.customer.where("c_custkey = 42").select(F.lit("id").alias("way"), *cols).union(found.select(F.lit("title").alias("way"), *cols))


@query("""WITH c AS (SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'unmatched' ELSE lower(c_mktsegment) END AS tier, count(*) AS n FROM customer GROUP BY 1), a AS (SELECT sum(n) AS n FROM c)
SELECT tier, n, round(100.0::DOUBLE * n / (SELECT n FROM a), 3) AS percent FROM c UNION ALL SELECT 'matched', coalesce(sum(n), 0)::BIGINT, round(100.0::DOUBLE * coalesce(sum(n), 0) / (SELECT n FROM a), 3) FROM c WHERE tier <> 'unmatched'""")
def match_rate(t):
    tier = F.when(F.col("c_mktsegment") == "BUILDING", "unmatched").otherwise(F.lower("c_mktsegment"))
    return serve.match_rates(t.customer.select(tier.alias("tier")))


@query("SELECT p_partkey, row_number() OVER (ORDER BY replace(p_brand, 'Brand#', '')::INT, p_size, p_partkey)::INT AS place FROM part")
def natural_sort(t):
    """Runs of digits count as numbers; the places are ranked by range, so no task sorts all."""
    key = serve.natural_order(F.concat_ws(" ", "p_brand", F.col("p_size").cast("string"), F.col("p_partkey").cast("string")))
    return serve.places(t.part.select("p_partkey", key.alias("_key")), "_key").select("p_partkey", F.col("place").cast("int").alias("place"))


@query("SELECT p_partkey, p_name, (SELECT count(*) FROM part) AS total FROM (SELECT p_partkey, p_name FROM part ORDER BY p_size DESC NULLS LAST, p_partkey LIMIT 500)")
def page_with_total(t):
    return serve.page_with_total(t.part, "p_size", True, "p_partkey").select("p_partkey", "p_name", "total")


@query("""WITH c AS (SELECT 'status' AS facet, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'size', p_size::VARCHAR, count(*) FROM part GROUP BY 2)
SELECT facet, value, n, row_number() OVER (PARTITION BY facet ORDER BY CASE WHEN facet = 'status' THEN coalesce(list_position(['P', 'O'], value), 3) ELSE 0 END, CASE WHEN facet = 'size' THEN value::INT END, CASE WHEN facet <> 'size' THEN -n END, lower(value), value)::INT AS place FROM c""")
def facet_order(t):
    count = lambda df, facet, c: df.groupBy(F.col(c).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(facet).alias("facet"), "value", "n")
    counts = count(t.orders, "status", "o_orderstatus").unionByName(count(t.orders, "priority", "o_orderpriority")).unionByName(count(t.part, "size", "p_size"))
    return serve.facet_order(counts, ["size"], {"status": ["P", "O"]})


@query("SELECT n_name, row_number() OVER (ORDER BY strip_accents(lower(x)), x)::INT AS place FROM (SELECT n_name, CASE WHEN n_nationkey % 2 = 0 THEN replace(n_name, 'A', 'Á') ELSE lower(n_name) END AS x FROM nation)")
def glossary_order(t):
    word = F.when(F.col("n_nationkey") % 2 == 0, F.replace("n_name", F.lit("A"), F.lit("Á"))).otherwise(F.lower("n_name"))
    rows = t.nation.select("n_name", word.alias("x"), text.search_fold(word).alias("_key"))
    return serve.places(rows, "_key", "x").select("n_name", F.col("place").cast("int").alias("place"))


LOCAL = "translate(split_part(p_name, ' ', 2), 'oeg', CASE p_partkey % 3 WHEN 0 THEN 'òéç' WHEN 1 THEN 'oèG' ELSE 'Oeñ' END) || CASE WHEN p_partkey % 4 = 0 THEN 'l·l' ELSE 'll' END"


@query(f"SELECT p_partkey, row_number() OVER (ORDER BY x COLLATE ca, p_size, p_partkey)::INT AS place FROM (SELECT p_partkey, p_size, {LOCAL} AS x FROM part)")
def locale_sort(t):
    """Catalan order: marks and case count after letters, a number counts as one."""
    to = F.when(F.col("p_partkey") % 3 == 0, "òéç").when(F.col("p_partkey") % 3 == 1, "oèG").otherwise("Oeñ")
    word = F.split_part("p_name", F.lit(" "), F.lit(2))
    for k, c in enumerate("oeg", 1):
        word = F.replace(word, F.lit(c), F.concat(F.lit("\u0001"), F.lit(str(k))))
    for k in (1, 2, 3):
        word = F.replace(word, F.lit(f"\u0001{k}"), F.substring(to, k, 1))
    x = F.concat(word, F.when(F.col("p_partkey") % 4 == 0, "l·l").otherwise("ll"))
    rows = t.part.select("p_partkey", "p_size", serve.locale_order(x).alias("_key"))
    return serve.places(rows, "_key", "p_size", "p_partkey").select("p_partkey", F.col("place").cast("int").alias("place"))


@query("SELECT c_nationkey, x AS category FROM (SELECT c_nationkey, unnest([c_mktsegment, 'NATION_' || c_nationkey]) AS x FROM customer)")
def flattened_categories(t):
    """Groups of categories, each a list, flattened to one list a row and that to rows."""
    groups = F.array(F.struct(F.array("c_mktsegment").alias("categories")), F.struct(F.array(F.concat(F.lit("NATION_"), "c_nationkey")).alias("categories")))
    return t.customer.select("c_nationkey", F.explode(F.flatten(F.transform(groups, lambda g: g["categories"]))).alias("category"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice IS NULL THEN NULL ELSE translate(format('{:,.2f}', o_totalprice::DOUBLE), ',.', '.,') END AS price FROM orders")
def number_locale(t):
    return t.orders.select("o_orderkey", text.grouped_number(F.col("o_totalprice").cast("double"), 2).alias("price"))


FARMS = GEO["gaz"].replace("n_name AS name,", "n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'farm' ELSE 'town' END AS type,")


@query(f"""WITH g AS (SELECT * FROM ({FARMS}) WHERE length(key) >= 3), p AS (SELECT * FROM ({GEO['places']}) WHERE key <> 'curated place'),
exact AS (SELECT DISTINCT id FROM p JOIN g ON p.region = g.region AND p.key = g.key),
s AS (SELECT id, name, lon, lat, (p.parent = g.parent)::INT AS own, type, 2.0::DOUBLE * {lcs_sql('p.key', 'g.key')} / (length(p.key) + length(g.key)) AS score FROM p JOIN g ON p.region = g.region AND length(g.key) >= greatest(4, floor(length(p.key) * 0.6)::INT) WHERE id NOT IN (SELECT id FROM exact)),
t AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, name, lon) AS place FROM s WHERE score >= 0.8 AND (own = 1 OR type <> 'farm')),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY own DESC, score DESC, name, lon) AS nth FROM t WHERE place <= 2) SELECT id, name AS matched, lon::DOUBLE AS lon FROM b WHERE nth = 1""")
def geo_farm_guard(t):
    places, gaz, overrides, parents, centroids = _geo_tables(t)
    typed = gaz.join(t.nation.select(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 0, "farm").otherwise("town").alias("type")), "name")
    got = link.geocode(places, typed, overrides, parents, centroids, indel_ratio, 0.8, bound=0.8, most=2, farms=["farm"])
    return got.where("tier = 'fuzzy'").select("id", "matched", "lon")


@query(f"""WITH g AS (SELECT n_nationkey AS id, n_regionkey AS region, n_name AS name, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey * 1.5 END AS lon, CASE WHEN n_nationkey % 3 = 0 THEN CASE WHEN n_nationkey % 2 = 0 THEN replace(n_name, 'NATION', 'NATON') ELSE replace(n_name, '_' || n_nationkey, '_' || (n_nationkey + 1)) END END AS modern FROM nation),
k AS (SELECT l.id, x.lon, x.name, CASE WHEN l.modern = x.name THEN 2.0::DOUBLE ELSE 2.0::DOUBLE * {lcs_sql('l.modern', 'x.name')} / (length(l.modern) + length(x.name)) END AS score FROM g l JOIN g x ON l.region = x.region AND x.lon IS NOT NULL WHERE l.lon IS NULL),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, name, lon) AS nth FROM k WHERE score >= 0.85) SELECT g.id, coalesce(g.lon, b.lon)::DOUBLE AS lon FROM g LEFT JOIN b ON b.id = g.id AND b.nth = 1""")
def modern_names(t):
    i = F.col("n_nationkey")
    modern = F.when(i % 3 == 0, F.when(i % 2 == 0, F.replace("n_name", F.lit("NATION"), F.lit("NATON"))).otherwise(F.replace("n_name", F.concat(F.lit("_"), i.cast("string")), F.concat(F.lit("_"), (i + 1).cast("string")))))
    lon = F.when(i % 3 != 0, i * F.lit(1.5))
    gaz = t.nation.select(i.alias("id"), F.col("n_regionkey").alias("region"), F.col("n_name").alias("name"), lon.alias("lon"), lon.alias("lat"), modern.alias("modern"))
    return link.placed_by_modern_name(gaz, indel_ratio, 0.85, bound=0.85).select("id", F.col("lon").cast("double").alias("lon"))


@query(f"""WITH p AS ({GEO['places']}), g AS (SELECT r_name AS region, n_name AS key, 'P' || (c_custkey % 6) AS parent, c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'historical' ELSE 'modern' END AS source, CASE WHEN c_custkey % 5 = 0 THEN 'Municipi' ELSE 'Nucli' END AS type, c_custkey * 0.5::DOUBLE AS lon
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
h AS (SELECT id, name, lon, row_number() OVER (PARTITION BY id ORDER BY (p.parent = g.parent)::INT DESC, (source = 'historical')::INT DESC, (type = 'Municipi')::INT DESC, name, lon) AS nth FROM p JOIN g ON p.region = g.region AND p.key = g.key WHERE p.key <> 'curated place')
SELECT id, name AS matched, lon FROM h WHERE nth = 1""")
def geo_exact_order(t):
    """Of several equal names the own parent's, the oldest source's, the chief type's first."""
    places, _, overrides, parents, centroids = _geo_tables(t)
    i = F.col("c_custkey")
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    gaz = named.select(F.col("r_name").alias("region"), F.col("n_name").alias("key"), F.concat(F.lit("P"), i % 6).alias("parent"), F.col("c_name").alias("name"), F.when(F.col("c_mktsegment") == "BUILDING", "historical").otherwise("modern").alias("source"), F.when(i % 5 == 0, "Municipi").otherwise("Nucli").alias("type"), (i * F.lit(0.5)).alias("lon"), F.lit(0.0).alias("lat"))
    got = link.geocode(places, gaz, overrides, parents, centroids, indel_ratio, 0.9, bound=0.9)
    return got.where("tier = 'exact'").select("id", "matched", F.col("lon").cast("double").alias("lon"))
