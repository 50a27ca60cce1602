"""The queries of the training-data operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import alignment, bit_sliced, byte_bpe, code_books, hash_tree, language, line_crf, main_text, mixing, pq_dedup, set_join, suffix_dedup, token_count
from lexweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.jaccard_components(table(spark, sf_dir, "documents"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = hash_tree.tree(16)
    return hash_tree.shard_by_key(table(spark, sf_dir, "documents"), root, hash_tree.grown(root, 16))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_of(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_books.compressed(table(spark, sf_dir, "embeddings"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_token_counts, op2_byte_bpe, op3_main_text, op4_quality, op5_jaccard_join, op6_mix_sources, op7_shard, op8_top_k, op9_near_vectors, op10_language, op11_alignment, op12_vector_codes, op13_suffix_dedup)}

#: Components of links (a, b) among all keys, for the two queries below.
COMPONENTS = """both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT DISTINCT a AS k, a AS root FROM both_ways UNION SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.k),
part AS (SELECT k, min(root) AS component FROM reach GROUP BY 1)"""



def codes_sql(rounds: int = 2) -> str:
    """Assignments a0, a1 ... to codebooks c0, c1 ..., the last without an update after it."""
    steps = []
    for r in range(rounds + 1):
        far = "list_sum(list_transform(list_zip(p.x, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
        steps.append(f"a{r} AS (SELECT vec_id, label, pos, x, e, d FROM (SELECT p.vec_id, p.label, p.pos, p.x, c.e, {far} AS d FROM p JOIN c{r} c USING (pos)) QUALIFY row_number() OVER (PARTITION BY vec_id, pos ORDER BY d, e) = 1)")
        if r < rounds:
            steps.append(f"m{r} AS (SELECT pos, e, list(f ORDER BY j) AS c FROM (SELECT pos, e, j, floor(sum(x[j]) / count(*))::BIGINT AS f FROM a{r}, range(1, 65) t(j) WHERE j <= len(x) GROUP BY 1, 2, 3) GROUP BY 1, 2)")
            steps.append(f"c{r + 1} AS (SELECT c.pos, c.e, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN m{r} m USING (pos, e))")
    return f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, label, i AS pos, q[i * (len(q) // 16) + 1 : (i + 1) * (len(q) // 16)] AS x FROM v, range(16) t(i)),
c0 AS (SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS e, x AS c FROM p QUALIFY e < 64),
{", ".join(steps)},
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY pos, e)) AS h FROM c{rounds}),
r AS (SELECT vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY pos) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY 1, 2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM r, h"""


#: DuckDB SQL of the queries that SQL can express.
SQL: dict[str, str] = {
    "op5_jaccard_join": rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i+3], ' ') END AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_ FROM s x JOIN s y USING (g) WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_ >= 85 * (x.n + y.n - both_)),
{COMPONENTS}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(p.component, d.doc_id) AS component_id FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN part p ON p.k = d.doc_id""",
    "op8_top_k": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank, vec_id, score FROM (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_inner_product(a.q, b.q) DESC, b.vec_id)::INT AS rank
FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0) WHERE rank <= 20""",
    "op9_near_vectors": f"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_inner_product(a.x, b.x) >= 0.95 * sqrt(list_inner_product(a.x, a.x) * list_inner_product(b.x, b.x))),
{COMPONENTS}, n AS (SELECT a, count(*) AS n FROM both_ways GROUP BY 1)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, coalesce(p.component, v.vec_id) AS component_id, coalesce(p.component, v.vec_id) = v.vec_id AS kept FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN part p ON p.k = v.vec_id""",
    "op12_vector_codes": codes_sql(),
}
