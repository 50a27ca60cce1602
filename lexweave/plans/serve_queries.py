"""Queries of facets, search, aggregates, ranks and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.operators import search_index, serve
from lexweave.plans.common import Query, registrar
from lexweave.session import scratch
from lexweave.sources import sinks
from lexweave.streaming.ingest import new_files, once, replace_leaves, windowed_counts

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
query = registrar(QUERIES, SQL)

FACETS = serve.FacetQuery({"lang": "lang", "source": "source", "band": "band"}, ["text"], {"lang": "en", "source": "src1"}, "Thé and")
FOUND = "contains(strip_accents(lower(text)), 'the and')"


@query(f"""WITH d AS (SELECT lang, source, CASE WHEN n_chars < 1000 THEN 'short' WHEN n_chars < 5000 THEN 'medium' ELSE 'long' END AS band FROM documents WHERE {FOUND})
SELECT 'lang' AS facet, lang AS value, count(*) AS n FROM d WHERE source = 'src1' GROUP BY 2 UNION ALL SELECT 'source', source, count(*) FROM d WHERE lang = 'en' GROUP BY 2
UNION ALL SELECT 'band', band, count(*) FROM d WHERE lang = 'en' AND source = 'src1' GROUP BY 2""")
def facet_counts(t):
    band = F.when(F.col("n_chars") < 1000, "short").when(F.col("n_chars") < 5000, "medium").otherwise("long")
    return FACETS.counts(t.documents.withColumn("band", band))


@query(f"SELECT doc_id, n_chars FROM documents WHERE lang = 'en' AND source = 'src1' AND {FOUND} ORDER BY n_chars DESC, doc_id LIMIT 20")
def search_topk(t):
    rows = FACETS.rows(t.documents.withColumn("band", F.lit("")))
    return serve.sorted_by(rows, "n_chars", True, "doc_id").select("doc_id", "n_chars").limit(20)


@query("SELECT doc_id, n_chars FROM documents WHERE contains(strip_accents(lower(text)), 'this work')")
def search_indexed(t):
    """An index of all texts, and what holds a phrase by it."""
    path = scratch(t.spark)
    search_index.build(t.documents, "doc_id", F.col("text"), path)
    return t.documents.select("doc_id", "n_chars").join(search_index.search(t.spark, path, "doc_id", "This Wórk"), "doc_id", "left_semi")


@query("SELECT source, count(*) AS n FROM documents WHERE source <> '' GROUP BY 1 ORDER BY n DESC, source LIMIT 15")
def frequency_top(t):
    return serve.frequencies(t.documents, "source", 15)


@query("SELECT sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END)::BIGINT AS good, sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END)::BIGINT AS bad, count_if(toxic = 1) AS toxic, count(*) AS n FROM labels")
def conditional_counts(t):
    q = F.col("quality")
    return t.labels.agg(F.sum(F.when(q == 1, 1).otherwise(0)).alias("good"), F.sum(F.when(q == 0, 1).otherwise(0)).alias("bad"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.count(F.lit(1)).alias("n"))


@query("SELECT coalesce(o_orderstatus, '?') AS status, count(*) AS n FROM orders GROUP BY 1")
def group_counts(t):
    return t.orders.groupBy(F.coalesce("o_orderstatus", F.lit("?")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS pairs, count(DISTINCT l_suppkey) AS suppliers, max(l_orderkey) AS greatest FROM lineitem")
def count_distinct_struct(t):
    return t.lineitem.agg(F.count_distinct(F.struct("l_orderkey", "l_linenumber")).alias("pairs"), F.count_distinct("l_suppkey").alias("suppliers"), F.max("l_orderkey").alias("greatest"))


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_pairs(t):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query("SELECT event_type, count(json_extract(props, '$.k')) AS n_k, count(json_extract(props, '$.missing')) AS n_missing FROM events GROUP BY 1")
def json_presence(t):
    has = lambda path: F.count_if(F.get_json_object("props", path).isNotNull())
    return t.events.groupBy("event_type").agg(has("$.k").alias("n_k"), has("$.missing").alias("n_missing"))


@query("SELECT 'k' AS key, sum(json_extract(props, '$.k')::DOUBLE) AS total, count(json_extract(props, '$.k')) AS n FROM events HAVING sum(json_extract(props, '$.k')::DOUBLE) > 0")
def json_key_sums(t):
    return serve.key_sums(t.events, F.from_json("props", "map<string,double>"))


@query("SELECT n_regionkey AS region, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS total, count_if(c_acctbal > 0) AS positive FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def sum_by_label(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupBy(F.col("n_regionkey").alias("region")).agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("total"), F.count_if(F.col("c_acctbal") > 0).alias("positive"))


@query("SELECT o_orderpriority, count_if(o_orderstatus = 'F') AS \"F\", count_if(o_orderstatus = 'O') AS \"O\", count_if(o_orderstatus = 'P') AS \"P\" FROM orders GROUP BY 1")
def pivot_counts(t):
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)


@query("SELECT count(DISTINCT source) AS sources, count(DISTINCT lang) AS langs, count(*) AS n FROM documents")
def header_counts(t):
    return t.documents.agg(F.count_distinct("source").alias("sources"), F.count_distinct("lang").alias("langs"), F.count(F.lit(1)).alias("n"))


@query("SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS orders FROM orders GROUP BY 1")
def grouped_lists(t):
    return t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list("o_orderkey")), ",").alias("orders"))


@query("SELECT event_type, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 3) AS percent FROM events GROUP BY 1")
def tally_percent(t):
    from pyspark.sql import Window

    counts = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("event_type", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 3).alias("percent"))


CUSTOMERS = "SELECT c_custkey, c_acctbal, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2"


def _customers(t):
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey", "c_acctbal").agg(F.count("o_orderkey").alias("n"))


@query(f"""WITH b AS (SELECT * FROM ({CUSTOMERS}) ORDER BY n DESC, c_custkey LIMIT 20)
SELECT c_custkey, row_number() OVER (ORDER BY n DESC, c_custkey)::INT AS place_1, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey)::INT AS place_2, (row_number() OVER (ORDER BY n DESC, c_custkey) - row_number() OVER (ORDER BY c_acctbal DESC, c_custkey))::INT AS shift FROM b""")
def rank_shift(t):
    return serve.rank_shift(_customers(t), "c_custkey", "n", "c_acctbal", 20).select("c_custkey", "place_1", "place_2", "shift")


@query("SELECT o_orderkey, round(s, 6) AS share, greatest(1.0::DOUBLE, round(100 * s, 1)) AS bar FROM (SELECT o_orderkey, o_totalprice / max(o_totalprice) OVER (PARTITION BY o_orderpriority) AS s FROM orders)")
def share_of_max(t):
    return serve.share_of_max(t.orders, "o_totalprice", "o_orderpriority").select("o_orderkey", F.round("share", 6).alias("share"), "bar")


@query("""SELECT l_orderkey, l_linenumber, ratio, row_number() OVER (ORDER BY ratio DESC NULLS LAST, l_orderkey, l_linenumber)::INT AS place
FROM (SELECT l_orderkey, l_linenumber, l_quantity / nullif(l_discount, 0) AS ratio FROM (SELECT * FROM lineitem ORDER BY l_quantity DESC, l_orderkey, l_linenumber LIMIT 20))""")
def ratio_topk(t):
    rows = t.lineitem.withColumn("key", F.struct("l_orderkey", "l_linenumber"))
    return serve.ratio_top(rows, "key", "l_quantity", "l_discount", 20).select("l_orderkey", "l_linenumber", "ratio", "place")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 500")
def page_of_rows(t):
    return serve.sorted_by(t.orders, "o_totalprice", True, "o_orderkey").select("o_orderkey", "o_totalprice").limit(500)


@query("SELECT doc_id FROM documents WHERE n_chars BETWEEN 600 AND 2800 AND lang IS NOT NULL AND NOT regexp_matches(text, 'Licensed') ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT 1")
def featured_entry(t):
    rows = t.documents.where(F.col("n_chars").between(600, 2800) & F.col("lang").isNotNull() & ~F.col("text").rlike("Licensed"))
    return rows.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").select("doc_id").limit(1)


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND (o_totalprice > 300000 OR o_orderpriority = '1-URGENT') AND o_orderkey - 1 >= 0 AND o_orderkey IS NOT NULL")
def predicates(t):
    price = F.col("o_totalprice")
    keep = F.col("o_orderstatus").isin("F", "P") & ((price > 300000) | (F.col("o_orderpriority") == "1-URGENT")) & (F.col("o_orderkey") - 1 >= 0) & F.col("o_orderkey").isNotNull()
    return t.orders.where(keep).select("o_orderkey")


@query("""SELECT c_custkey, c_custkey || ',' || CASE WHEN contains(x, '"') OR contains(x, ',') THEN '"' || replace(x, '"', '""') || '"' ELSE x END || ',' || c_mktsegment AS line FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN c_name || ', "x"' ELSE c_name END AS x FROM customer)""")
def csv_export(t):
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit(', "x"'))).otherwise(F.col("c_name"))
    return t.customer.select("c_custkey", sinks.csv_line([F.col("c_custkey"), name, F.col("c_mktsegment")]).alias("line"))


@query("""SELECT n_nationkey, '{"id":' || n_nationkey || CASE WHEN n_nationkey % 2 = 0 THEN ',"name":"' || n_name || '"' ELSE '' END || CASE WHEN n_nationkey % 3 = 0 THEN ',"refs":["' || n_name || '"]' ELSE '' END || '}' AS doc FROM nation""")
def web_export(t):
    name = F.nullif(F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(""), F.lit(""))
    refs = F.when(F.col("n_nationkey") % 3 == 0, F.array("n_name")).otherwise(F.array().cast("array<string>"))
    return t.nation.select("n_nationkey", sinks.web_json({"id": F.col("n_nationkey"), "name": name, "refs": sinks.array_or_null(refs)}).alias("doc"))


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_events(t):
    return windowed_counts(t.events, "ts", "event_type", "1 day", "1 hour")


@query("SELECT 'known' AS section, (SELECT count(*) FROM labels) AS n UNION ALL SELECT 'good', count(*) FROM labels WHERE quality = 1 UNION ALL SELECT 'toxic', count(*) FROM labels WHERE toxic = 1")
def plain_report(t):
    return sinks.report(t.labels, {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})


@query("SELECT l_returnflag, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS quantity, sum((l_extendedprice * 100)::BIGINT)::BIGINT AS cents FROM lineitem GROUP BY 1")
def cost_sums(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"))


@query("SELECT conv_id, count(*) AS n, max(text) AS last FROM conversations GROUP BY 1")
def resumed_load(t):
    """Leaves loaded from files as they come; one batch is handed on twice, one leaf's file comes again with what it should have been."""
    files, table = scratch(t.spark), scratch(t.spark)
    rows = t.conversations.select("conv_id", "turn", "text")
    load = replace_leaves(table, ["conv_id"])
    first = rows.withColumn("text", F.when(F.col("conv_id") % 5 == 0, "damaged").otherwise(F.col("text")))
    first.repartition(4, "conv_id").write.json(files)

    def twice(batch, n):
        load(batch, n)
        load(batch, n)

    schema = "conv_id long, turn int, text string"
    stream = new_files(t.spark, files, schema)
    once(stream, scratch(t.spark), twice)
    state = scratch(t.spark)
    once(stream, state, load)
    rows.where("conv_id % 5 = 0").repartition(2, "conv_id").write.mode("append").json(files)
    once(stream, state, load)
    return t.spark.read.schema(schema).parquet(table).groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.max("text").alias("last"))
