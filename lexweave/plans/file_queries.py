"""Round trips: tables written in a format and read back by the library's readers, or through an outside engine's adapter."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexweave import schemas
from lexweave.operators import link
from lexweave.plans.common import Query, registrar
from lexweave.session import scratch, staged
from lexweave.sources import readers, sinks

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
query = registrar(QUERIES, SQL)


LETTERS = "regexp_replace(text, '[^A-Za-z]', '', 'g')"
TURNS = f"SELECT lpad((conv_id % 16 + 1)::VARCHAR, 2, '0') AS vol, conv_id AS leaf, (row_number() OVER (PARTITION BY conv_id ORDER BY turn))::INT AS par_no, {LETTERS} AS text FROM conversations"


def _volumes(t, **options) -> str:
    """Sixteen volumes of markup: a page a conversation, a paragraph a turn, a span a letter."""
    spans = F.regexp_replace(F.regexp_replace("text", "[^A-Za-z]", ""), "(.)", "<span class='c'>$1</span>")
    turns = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", spans.alias("s")))).alias("turns"))
    body = F.array_join(F.transform("turns", lambda x: F.concat(F.lit("<p class='ocr_par' title='"), x["turn"], F.lit("'>\n"), x["s"], F.lit("</p>\n"))), "")
    page = F.concat(F.lit("<div class='ocr_page' id='page_"), F.lpad(F.col("conv_id").cast("string"), 6, "0"), F.lit("'>\n"), body, F.lit("</div>"))
    path = scratch(t.spark)
    turns.select(page.alias("value"), F.lpad((F.col("conv_id") % 16 + 1).cast("string"), 2, "0").alias("vol")).repartition(16, "vol").write.partitionBy("vol").options(**options).text(path)
    return path


@query(f"SELECT * FROM ({TURNS}) WHERE text <> ''")
def hocr_round_trip(t):
    """Gzipped volumes, each read as a whole."""
    return readers.hocr(t.spark, _volumes(t, compression="gzip"), vol=r"vol=(\d{2})").withColumn("leaf", F.col("leaf").cast("long"))


@query(f"SELECT * FROM ({TURNS}) WHERE text <> '' AND leaf IN (0, 1, 2, 17, 33, 40, 64, 99999999)")
def hocr_leaves(t):
    """Plain volumes in ranges of 64 KB, of which a set of leaves is read."""
    got = readers.hocr(t.spark, _volumes(t), vol=r"vol=(\d{2})", split=64 << 10)
    return got.where(F.col("leaf").isin(0, 1, 2, 17, 33, 40, 64, 99999999)).withColumn("leaf", F.col("leaf").cast("long"))


@query("SELECT p_partkey::INT AS leaf, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS page_printed FROM part")
def page_map_round_trip(t):
    path = scratch(t.spark)
    rows = t.part.select(F.col("p_partkey").cast("int").alias("leafNum"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand")).alias("pageNumber"), F.col("p_size").alias("_part"))
    first = rows.select("leafNum", F.lit("overwritten").alias("pageNumber"), F.lit(0).alias("_nth"), "_part").unionByName(rows.withColumn("_nth", F.lit(1)))
    rows = first.groupBy("_part").agg(F.transform(F.array_sort(F.collect_list(F.struct("_nth", "leafNum", "pageNumber"))), lambda x: F.struct(x["leafNum"].alias("leafNum"), x["pageNumber"].alias("pageNumber"))).alias("pages"))
    rows.write.partitionBy("_part").json(path)
    return readers.page_map(t.spark, f"{path}/*")


@query("SELECT lpad((p_partkey % 16 + 1)::VARCHAR, 2, '0') AS vol, p_partkey::INT AS leaf, p_name AS title, CASE WHEN p_partkey % 3 = 0 THEN 'hand' ELSE 'regex' END AS source FROM part")
def index_records_round_trip(t):
    path = scratch(t.spark)
    source = F.when(F.col("p_partkey") % 3 == 0, "hand").when(F.col("p_partkey") % 3 == 1, "")
    rows = t.part.select(F.lpad((F.col("p_partkey") % 16 + 1).cast("string"), 2, "0").alias("vol"), F.col("p_partkey").cast("int").alias("leaf"), F.col("p_name").alias("title"), source.alias("source"))
    sinks.json_lines(rows, path)
    return readers.index_records(t.spark, path).select("vol", "leaf", "title", "source")


@query("""SELECT conv_id::INT AS leaf, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS entry_ordinal, role AS title, text AS description, 0::INT AS n_refs, CASE WHEN turn % 2 = 0 THEN turn::DOUBLE END AS stat FROM conversations""")
def leaf_entries_round_trip(t):
    path = scratch(t.spark)
    rows = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("role").alias("title"), F.col("text").alias("description"), (F.col("turn") % 2 == 0).alias("even")))).alias("e"))
    entries = F.transform("e", lambda x: F.struct(x["title"].alias("title"), x["description"].alias("description"), F.when(x["even"], F.create_map(F.lit("n"), x["turn"].cast("double"))).otherwise(F.create_map().cast("map<string,double>")).alias("stats")))
    rows.select(F.lit("01").alias("vol"), F.col("conv_id").alias("leaf"), entries.alias("entries")).write.json(path)
    got = readers.leaf_documents(t.spark.read.schema(schemas.LEAF).json(path))
    return got.select("leaf", "entry_ordinal", "title", "description", F.size("cross_references").alias("n_refs"), F.col("stats")["n"].alias("stat"))


@query("SELECT lpad((doc_id % 16 + 1)::VARCHAR, 2, '0') AS vol, (doc_id // 16)::INT AS page, md5(text) AS digest FROM documents WHERE trim(text) <> ''")
def page_texts_round_trip(t):
    """A file a text, whose name carries the key."""
    path = scratch(t.spark)
    page = F.floor(F.col("doc_id") / 16).cast("string")
    name = F.concat(F.lit("tomo"), F.lpad((F.col("doc_id") % 16 + 1).cast("string"), 2, "0"), F.lit("_p"), page, F.lit(".txt"))
    sinks.text_files(t.documents.where("text is not null").select(name.alias("name"), "text"), path, "name", "text")
    return readers.page_texts(t.spark, f"{path}/*", r"(\d{2})_p(\d+)\.txt$").select("vol", "page", F.md5("text").alias("digest"))


@query("SELECT n_nationkey::VARCHAR AS id, n_name AS name FROM nation")
def web_payload_round_trip(t):
    path = scratch(t.spark)
    entry = F.create_map(F.lit("id"), F.col("n_nationkey").cast("string"), F.lit("name"), F.col("n_name"))
    t.nation.groupBy("n_regionkey").agg(F.collect_list(entry).alias("entries"), F.count(F.lit(1)).alias("text_total")).write.partitionBy("n_regionkey").json(path)
    return readers.web_payload(t.spark, f"{path}/*").select(F.col("entry")["id"].alias("id"), F.col("entry")["name"].alias("name"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def paged_service(t):
    """A service that answers with pages of a table, here files of JSON lines, fetched with a known total and without one; both give the same rows."""
    path, size = scratch(t.spark), 500
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    total = rows.count()
    link.appended(rows.limit(0).withColumn("nth", F.lit(0).cast("long")), rows.withColumn("nth", F.lit(None).cast("long")), "nth", ["c_custkey"]).withColumn("page", F.floor((F.col("nth") - 1) / size)).drop("nth").repartition("page").write.partitionBy("page").json(path)

    def fetch(offset: int, limit: int) -> tuple[list[dict], bool]:
        from pyarrow import fs

        if offset >= total:
            return [], False
        system, root = fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")
        found = [f for f in system.get_file_info(fs.FileSelector(f"{root}/page={offset // limit}")) if f.base_name.startswith("part-")]
        lines = [line for f in found for line in system.open_input_stream(f.path).read().decode().splitlines()]
        return [json.loads(line) for line in lines], offset + limit < total

    schema = "c_custkey long, c_name string, c_mktsegment string"
    known = staged(readers.paged(t.spark, fetch, schema, page=size, total=total))  # read three times
    followed = readers.paged(t.spark, fetch, schema, page=size)
    return known.intersect(followed).unionByName(known.exceptAll(followed)).unionByName(followed.exceptAll(known))


@query("SELECT page_id, length(html)::BIGINT AS n, starts_with(html, '<!DOCTYPE') AS typed FROM pages")
def adapter_batches(t):
    """An outside engine's place is taken by a function of a batch: what goes in and what must come out is the contract."""

    def engine(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"page_id": batch["page_id"], "n": batch["html"].str.len(), "typed": batch["html"].str.startswith("<!DOCTYPE")})

    return readers.with_adapter(t.pages.select("page_id", "html"), engine, "page_id long, n long, typed boolean")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def replaced_table(t):
    """Loaded twice: the second load replaces the first as a whole."""
    path = scratch(t.spark)
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.replace_table(rows, path)
    sinks.replace_table(rows.where("o_orderstatus = 'F'").drop("o_orderstatus"), path)
    return t.spark.read.parquet(path)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def versioned_table(t):
    path = scratch(t.spark)
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    sinks.replace_version(rows, path)
    sinks.replace_version(rows.where("o_orderstatus <> 'P'"), path)
    return sinks.current(t.spark, path)


@query("SELECT p_partkey, p_brand FROM part")
def json_by_round_trip(t):
    path = scratch(t.spark)
    sinks.json_by(t.part.select("p_partkey", "p_brand"), path, "p_brand")
    return t.spark.read.schema("p_partkey long, p_brand string").json(path)


@query("SELECT p_partkey, p_name || ', \"x\"' AS name, CASE WHEN p_partkey % 2 = 0 THEN p_size END::INT AS size FROM part")
def csv_round_trip(t):
    path = scratch(t.spark)
    sinks.csv(t.part.select("p_partkey", F.concat("p_name", F.lit(', "x"')).alias("name"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size")).alias("size")), path)
    return t.spark.read.schema("p_partkey long, name string, size int").csv(path, header=True, quote='"', escape='"')


@query("SELECT '# ' || n_name || chr(10) || n_nationkey || CASE WHEN n_nationkey % 2 = 0 THEN chr(10) || 'even' ELSE '' END AS value FROM nation")
def text_windows(t):
    return sinks.text_windows(t.nation, F.col("n_name"), [F.col("n_nationkey").cast("string"), F.when(F.col("n_nationkey") % 2 == 0, "even")])


@query("""SELECT n_regionkey, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' AS json FROM nation GROUP BY 1""")
def coordinates_json(t):
    return sinks.json_array(t.nation.select("n_regionkey", "n_nationkey", "n_name"), ["n_nationkey"], "n_regionkey")


PROPOSALS = "SELECT c_custkey, 'c_mktsegment' AS \"column\", 'CHANGED' AS new FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey, 'c_name', 'x' FROM customer WHERE c_custkey % 10 = 0"


def _proposals(t):
    segment = t.customer.where("c_acctbal < 0").select("c_custkey", F.lit("c_mktsegment").alias("column"), F.lit("CHANGED").alias("new"))
    return segment.unionByName(t.customer.where("c_custkey % 10 = 0").select("c_custkey", F.lit("c_name").alias("column"), F.lit("x").alias("new")))


@query(PROPOSALS)
def proposals_dry(t):
    return sinks.applied(t.customer, _proposals(t), ["c_custkey"], apply=False)


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'x' ELSE c_name END AS c_name, CASE WHEN c_acctbal < 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def proposals_applied(t):
    return sinks.applied(t.customer.select("c_custkey", "c_name", "c_mktsegment"), _proposals(t), ["c_custkey"], apply=True)
