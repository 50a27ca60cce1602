"""Queries of the normalisers, of segmentation and of classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.functions import rules, text
from lexweave.operators import classify, segment
from lexweave.plans.common import Query, registrar

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
query = registrar(QUERIES, SQL)

#: Normalisers over whole texts: name, Column function, SQL of the same. Results are digests, as texts are long.
SZ = "replace(strip_accents({}), 'ß', 'SS')"
PLAIN = {
    "fold_accents": (text.fold_accents, "strip_accents(text)"),
    "search_fold": (text.search_fold, "strip_accents(lower(text))"),
    "compress_alnum": (text.compress_alnum, f"regexp_replace(upper({SZ.format('text')}), '[^A-Z0-9]', '', 'g')"),
    "compress_bare": (text.compress_bare, "regexp_replace(upper({}), '[^A-Z0-9]', '', 'g')".format(SZ.format("regexp_replace(text, '\\([^)]*\\)', '', 'g')"))),
    "compress_alpha": (text.compress_alpha, f"regexp_replace(upper({SZ.format('text')}), '[^A-Z]', '', 'g')"),
    "compressed_lemma": (text.compressed_lemma, f"translate(regexp_replace(upper({SZ.format('text')}), '[^A-Z0-9]', '', 'g'), '10584', 'IOSBA')"),
    "whitespace_collapse": (text.collapse, r"trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'))"),
    "join_broken_words": (text.join_broken_words, r"regexp_replace(text, '(\p{Ll})-[ \t\n\x0B\f\r]+(\p{Ll})', '\1\2', 'g')"),
    "join_hyphens": (text.join_hyphens, r"regexp_replace(text, '([\p{L}\p{N}_])-([\p{L}\p{N}_])', '\1\2', 'g')"),
    "join_hyphens_spaced": (text.join_hyphens_spaced, r"regexp_replace(text, '([\p{L}\p{N}_])-[\s]*([\p{L}\p{N}_])', '\1\2', 'g')"),
    "html_escape": (text.html_escape, "replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')"),
    "excerpt": (text.excerpt, "CASE WHEN length(text) <= 320 THEN text ELSE regexp_replace(CASE WHEN instr(substr(text, 1, 320), ' ') > 0 AND 320 - instr(reverse(substr(text, 1, 320)), ' ') > 220 THEN substr(text, 1, 320 - instr(reverse(substr(text, 1, 320)), ' ')) ELSE substr(text, 1, 320) END, '[,;:][\\s]*$', '') || '…' END"),
    "snippet": (lambda x: text.snippet(x, "the "), "CASE WHEN instr(text, 'the ') > 0 THEN replace(substr(text, greatest(instr(text, 'the ') - 30, 1), instr(text, 'the ') + 150 - greatest(instr(text, 'the ') - 30, 1)), chr(10), ' | ') END"),
    "clean_lead": (text.clean_lead, r"translate(regexp_replace(regexp_extract(text, '^[^\s()-]*'), '[*#|~^]', '', 'g'), 'çñ', 'ÇÑ') || substr(text, length(regexp_extract(text, '^[^\s()-]*')) + 1)"),
    "strip_trailer": (lambda x: text.strip_trailer(x, "All rights reserved\\."), r"regexp_replace(regexp_replace(text, '[\s]*All rights reserved\.[\s]*$', ''), '[\s.,;:]+$', '')"),
    "article_lower": (text.article_lower, f"lower(regexp_extract(text, '^({'|'.join(text.LOWERED_ARTICLES)})')) || substr(text, length(regexp_extract(text, '^({'|'.join(text.LOWERED_ARTICLES)})')) + 1)"),
    "gaz_norm": (text.gaz_norm, "trim(translate(trim(regexp_replace(regexp_replace(upper(replace(strip_accents(regexp_replace(trim(text), '^(" + "|".join(text.ARTICLES).replace("'", "''") + r")', '')), 'ß', 'SS')), '[-/\x{2013}\x{2014}]', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')), '" + text.KEY_SIGNS.replace("'", "''") + "', ''))"),
    "split_particle": (lambda x: text.split_particle(x, "of", "th"), None),
}

#: Rewrites in order: pattern, replacement, label.
REWRITES = [
    ("[%$#&*]{3}", "", "junk marks"),
    ("!!+", "!", "shouting"),
    (r" \| ", " ", "bars"),
    ("All rights reserved[.]", "", "rights"),
    ("[0-9]{16}", "<number>", "long numbers"),
    (" +", " ", "spaces"),
]
_rewritten = "text"
for _pattern, _to, _ in REWRITES:
    _rewritten = f"regexp_replace({_rewritten}, '{_pattern}', '{_to}', 'g')"
PLAIN["rules_rewrite"] = (lambda x: rules.rewrite(x, REWRITES), f"trim({_rewritten})")


def _plain(name: str, function, sql: str | None) -> None:
    def run(t):
        out = function(F.col("text"))
        return t.documents.select("doc_id", F.md5(out).alias("digest"), F.length(out).alias("n"), F.coalesce(out != F.col("text"), F.lit(True)).alias("changed"))

    oracle = f"SELECT doc_id, md5(x) AS digest, length(x)::INT AS n, coalesce(x <> text, true) AS changed FROM (SELECT doc_id, text, {sql} AS x FROM documents)" if sql else None
    query(oracle, name)(run)


for _name, (_function, _sql) in PLAIN.items():
    _plain(_name, _function, _sql)

NAME = "p_name || ' (' || replace(p_brand, 'Brand#', 'n0r') || ')'"


MISREAD = "replace(replace(p_name, 'o', '0'), 's', '5') || ' [x] ' || p_brand || ' (' || p_type || ') v1'"


@query(f"""WITH k AS (SELECT p_partkey, regexp_replace(regexp_replace(lower(trim({MISREAD})), '\\([^)]*\\)', ' ', 'g'), '\\[[^\\]]*\\]', ' ', 'g') AS x FROM part),
one AS (SELECT p_partkey, regexp_replace(regexp_replace(x, '([a-z])1([a-z]|$)', '\\1i\\2', 'g'), '([a-z])1([a-z]|$)', '\\1i\\2', 'g') AS x FROM k),
zero AS (SELECT p_partkey, regexp_replace(regexp_replace(x, '([a-z])0([a-z]|$)', '\\1o\\2', 'g'), '([a-z])0([a-z]|$)', '\\1o\\2', 'g') AS x FROM one),
five AS (SELECT p_partkey, regexp_replace(regexp_replace(x, '([a-z])5([a-z]|$)', '\\1s\\2', 'g'), '([a-z])5([a-z]|$)', '\\1s\\2', 'g') AS x FROM zero),
eight AS (SELECT p_partkey, regexp_replace(regexp_replace(x, '([a-z])8([a-z]|$)', '\\1b\\2', 'g'), '([a-z])8([a-z]|$)', '\\1b\\2', 'g') AS x FROM five)
SELECT p_partkey, trim(regexp_replace(regexp_replace(replace(x, 'v', 'b'), '[^a-z0-9]', ' ', 'g'), ' +', ' ', 'g')) AS link_key FROM eight""")
def link_key(t):
    misread = F.replace(F.replace("p_name", F.lit("o"), F.lit("0")), F.lit("s"), F.lit("5"))
    name = F.concat(misread, F.lit(" [x] "), "p_brand", F.lit(" ("), "p_type", F.lit(") v1"))
    return t.part.select("p_partkey", text.link_key(name).alias("link_key"))


@query(f"""WITH n AS (SELECT p_partkey, {NAME} AS x, p_name AS bare, replace(p_brand, 'Brand#', 'n0r') AS inside FROM part),
v AS (SELECT p_partkey, unnest([x, bare, inside || ' ' || bare, list_aggregate(list_transform(string_split(bare, ' '), lambda w: CASE w WHEN 'hot' THEN 'warm' WHEN 'small' THEN 'little' ELSE w END), 'string_agg', ' ')]) AS y FROM n)
SELECT p_partkey, string_agg(DISTINCT regexp_replace(upper(y), '[^A-Z]', '', 'g'), '|' ORDER BY regexp_replace(upper(y), '[^A-Z]', '', 'g')) AS variants FROM v GROUP BY 1""")
def name_variants(t):
    name = F.concat("p_name", F.lit(" ("), F.replace("p_brand", F.lit("Brand#"), F.lit("n0r")), F.lit(")"))
    return t.part.select("p_partkey", F.array_join(text.name_variants(name, {"hot": "warm", "small": "little"}), "|").alias("variants"))


@query("SELECT p_partkey, CASE WHEN starts_with(p_name, split_part(p_name, ' ', 1)) THEN upper(p_type) || substr(p_name, length(split_part(p_name, ' ', 1)) + 1) END AS title FROM part")
def lemma_swap(t):
    return t.part.select("p_partkey", rules.swap_lead(F.col("p_name"), F.split("p_name", " ")[0], F.upper("p_type")).alias("title"))


@query("SELECT page_id, 'https://archive.example.org/' || lpad((page_id % 16 + 1)::VARCHAR, 2, '0') || '/page/n' || page_id AS link FROM pages")
def url_build(t):
    return t.pages.select("page_id", F.format_string("https://archive.example.org/%s/page/n%d", F.lpad((F.col("page_id") % 16 + 1).cast("string"), 2, "0"), "page_id").alias("link"))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice >= 1000000 THEN round(o_totalprice::DECIMAL(30,6) / 1000000, 1)::DECIMAL(20,1) || 'M'
WHEN o_totalprice >= 1000 THEN CAST(round((o_totalprice::DECIMAL(18,6) * 0.001)::DECIMAL(30,9), 1)::DECIMAL(20,1) AS VARCHAR) || 'K' ELSE CAST(round(o_totalprice::DECIMAL(30,6), 1)::DECIMAL(20,1) AS VARCHAR) END AS compact FROM orders""")
def number_format(t):
    return t.orders.select("o_orderkey", text.compact_number(F.col("o_totalprice")).alias("compact"))


@query("""SELECT conv_id, 'Turns' || chr(10) || string_agg('- ' || role, chr(10) ORDER BY turn) AS section FROM conversations GROUP BY conv_id""")
def template_section(t):
    turns = t.conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    return turns.select("conv_id", text.bullet_section("Turns", F.transform("turns", lambda s: s["role"])).alias("section"))


# Titles of documents: the first line.
TITLE = "regexp_extract(text, '^[^\\n]*')"
STRONG = "Licensed under|All rights reserved"
WEAK = "with|from|this|that|sur|avec|und|nicht|del|como"


@query(f"""SELECT doc_id, CASE WHEN length(text) < 20 THEN 'short_text' WHEN length(t) < 3 OR length(t) > 400 THEN 'title_length'
WHEN length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) < 3 THEN 'few_letters' WHEN regexp_matches(t, '[%$#&*]{{3}}') THEN 'junk'
WHEN length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) >= 0.6 * length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) THEN 'shouting'
WHEN regexp_matches(t, '^(Licensed|All rights)') THEN 'header' END AS reason FROM (SELECT doc_id, text, {TITLE} AS t FROM documents)""")
def quality_reject_reason(t):
    title = F.regexp_extract("text", "^[^\\n]*", 0)
    checks = [
        ("short_text", F.length("text") >= 20),
        ("title_length", F.length(title).between(3, 400)),
        ("few_letters", F.length(F.regexp_replace(title, r"[^\p{L}]", "")) >= 3),
        ("junk", ~title.rlike("[%$#&*]{3}")),
        ("shouting", classify.upper_share(title) < 0.6),
        ("header", ~title.rlike("^(Licensed|All rights)")),
    ]
    return t.documents.select("doc_id", classify.reject_reason(checks).alias("reason"))


@query(f"""SELECT doc_id, len(list_distinct(regexp_extract_all(lower(text), '{WEAK}')))::INT AS n_weak,
regexp_matches(text, '{STRONG}') OR len(list_distinct(regexp_extract_all(lower(text), '{WEAK}'))) >= 2 AS member FROM documents""")
def double_signal(t):
    low = F.lower("text")
    return t.documents.select("doc_id", F.size(classify.weak_signals(low, WEAK)).alias("n_weak"), (F.col("text").rlike(STRONG) | classify.double_signal(low, "(?!)", WEAK)).alias("member"))


@query(f"SELECT doc_id, regexp_matches(text, '{WEAK}') AND NOT regexp_matches(substr(text, 1, 120), '[%$#&*]{{3}}|!!') AS member, regexp_matches(text, 'license|Licen') AS weak FROM documents")
def head_veto(t):
    x = F.col("text")
    return t.documents.select("doc_id", classify.with_head_veto(x, x.rlike(WEAK), "[%$#&*]{3}|!!", 120).alias("member"), x.rlike("license|Licen").alias("weak"))


LABELS = [("Licensed under", "license"), ("All rights", "rights"), ("@[a-z0-9]+", "contact"), ("[0-9]{16}", "number"), ("[%$#&*]{3}", "marks"), (r" \| ", "table"), ("!!", "shouting")]
_CASES = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{name}'" for p, name in LABELS)


@query(f"SELECT doc_id, CASE {_CASES} ELSE 'prose' END AS label FROM documents")
def first_match_label(t):
    return t.documents.select("doc_id", rules.first_label(F.col("text"), LABELS, "prose").alias("label"))


DAMAGE = [("[0-9]", "digit"), ("[^\\p{L}\\p{N} .,]", "sign"), ("^[\\p{Ll}]", "lower_start"), ("(^| )[\\p{L}]( |$)", "lone_letter"), ("^.{0,3}$", "tiny"), ("^.{300,}$", "long")]
_DAMAGE = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{name}'" for p, name in DAMAGE)


@query(f"SELECT doc_id, CASE {_DAMAGE} END AS flag FROM (SELECT doc_id, regexp_replace({TITLE}, '\\([^)]*\\)', '', 'g') AS t FROM documents)")
def damage_flag(t):
    title = text.without_parens(F.regexp_extract("text", "^[^\\n]*", 0))
    return t.documents.select("doc_id", rules.first_label(title, DAMAGE).alias("flag"))


@query("SELECT p_partkey, p_type IN ('ECONOMY', 'STANDARD') AS is_settlement, CASE WHEN p_type IN ('PROMO') THEN 'expect' WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'maybe' ELSE 'other' END AS bucket FROM part")
def membership_buckets(t):
    bucket = F.when(F.col("p_type").isin("PROMO"), "expect").when(F.col("p_brand").isin("Brand#1", "Brand#2"), "maybe").otherwise("other")
    return t.part.select("p_partkey", F.col("p_type").isin("ECONOMY", "STANDARD").alias("is_settlement"), bucket.alias("bucket"))


PLAIN_HTML = r"regexp_replace(html, '<script[^>]*>[\s\S]*?</script>|<style[^>]*>[\s\S]*?</style>', '', 'g')"


@query(f"""SELECT page_id, (i - 1)::INT AS par_no, md5(trim(regexp_replace(regexp_replace(split_part(parts[i], '</p>', 1), '<[^>]*>', ' ', 'g'), '[ \\n\\t\\r]+', ' ', 'g'))) AS digest
FROM (SELECT page_id, parts, unnest(range(2, len(parts) + 1)) AS i FROM (SELECT page_id, string_split({PLAIN_HTML}, '<p>') AS parts FROM pages))""")
def html_paragraphs(t):
    return segment.html_paragraphs(t.pages).select("page_id", "par_no", F.md5("text").alias("digest"))


@query("""SELECT doc_id, i::INT AS nth, before::INT AS start, (before + length(p[i+1]))::INT AS "end", regexp_extract(p[i+1], '^[A-Z][a-z]+', 0) AS lemma, md5(regexp_replace(p[i+1], '^[A-Z][a-z]+', '')) AS body FROM
(SELECT doc_id, p, i, list_sum(list_transform(p[1:i], lambda x: length(x))) AS before FROM (SELECT doc_id, p, unnest(range(1, len(p))) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '([A-Z][a-z]+)', chr(1) || '\\1', 'g'), chr(1)) AS p FROM documents)))""")
def openers(t):
    return segment.openers(t.documents, "doc_id", "text", "[A-Z][a-z]+").select("doc_id", "nth", "start", "end", "lemma", F.md5("body").alias("body"))


@query("""WITH r AS (SELECT row_number() OVER (ORDER BY r_regionkey DESC) AS n, '_' || r_regionkey || '(\\d)' AS pattern, '/' || lower(r_name) || '\\1' AS replacement FROM region WHERE r_regionkey > 0)
SELECT n_name, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(n_name, (SELECT pattern FROM r WHERE n = 1), (SELECT replacement FROM r WHERE n = 1), 'g'), (SELECT pattern FROM r WHERE n = 2), (SELECT replacement FROM r WHERE n = 2), 'g'),
(SELECT pattern FROM r WHERE n = 3), (SELECT replacement FROM r WHERE n = 3), 'g'), (SELECT pattern FROM r WHERE n = 4), (SELECT replacement FROM r WHERE n = 4), 'g')) AS name FROM nation""")
def rules_from_rows(t):
    """Rules kept as rows, applied in order of their priority."""
    row = t.region.where("r_regionkey > 0").select((-F.col("r_regionkey")).alias("priority"), F.concat(F.lit("_"), "r_regionkey", F.lit(r"(\d)")).alias("pattern"), F.concat(F.lit("/"), F.lower("r_name"), F.lit("$1")).alias("replacement"), F.col("r_name").alias("label"))
    return t.nation.select("n_name", rules.rewrite(F.col("n_name"), rules.from_rows(row)).alias("name"))


STRICT = "^([A-Z][a-z]+) ((?:of|the|and) [^.]*)[.]"
LOOSE = "^([^ .]{2,50})[., ]+([^.]*)[.]"


@query(f"""SELECT doc_id, CASE WHEN regexp_matches(text, '{STRICT}') THEN trim(regexp_extract(text, '{STRICT}', 1)) WHEN regexp_matches(text, '{LOOSE}') AND regexp_matches(regexp_extract(text, '{LOOSE}', 2), 'th') THEN trim(regexp_extract(text, '{LOOSE}', 1)) END AS title,
CASE WHEN regexp_matches(text, '{STRICT}') THEN false WHEN regexp_matches(text, '{LOOSE}') AND regexp_matches(regexp_extract(text, '{LOOSE}', 2), 'th') THEN true END AS loose FROM documents""")
def entry_grammar(t):
    return t.documents.select("doc_id", segment.entry(F.col("text"), STRICT, LOOSE, "th").alias("e")).select("doc_id", "e.title", "e.loose")


@query(r"""SELECT doc_id, par_no, md5(p) AS digest FROM (SELECT doc_id, par_no, p, row_number() OVER (PARTITION BY doc_id ORDER BY regexp_matches(p, 'the')::INT DESC, length(p) DESC, par_no) AS place
FROM (SELECT doc_id, (i - 1)::INT AS par_no, trim(regexp_extract(ps[i], '(?m)(?:^[A-Z])(?:.|\n)*', 0), ' ') AS p FROM
(SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT doc_id, regexp_split_to_array(regexp_replace(text, '(?m)^(?:Licensed|All rights).*$', '', 'g'), '\n\s*\n') AS ps FROM documents)) WHERE regexp_matches(ps[i], '(?m)^[A-Z]'))) WHERE place = 1""".replace("\\\\", "\\"))
def best_paragraph(t):
    return segment.best_paragraph(t.documents, "doc_id", "text", "^(?:Licensed|All rights).*$", "^[A-Z]", "the").select("doc_id", "par_no", F.md5("paragraph").alias("digest"))


@query("""WITH have AS (SELECT conv_id, turn, text FROM conversations WHERE turn % 5 <> 3)
SELECT c.conv_id, c.turn, count(h.turn)::INT AS n, md5(coalesce(string_agg(h.text, chr(10) ORDER BY h.turn), '')) AS digest FROM conversations c LEFT JOIN have h ON h.conv_id = c.conv_id AND h.turn BETWEEN c.turn + 1 AND c.turn + 3 AND trim(h.text) <> '' GROUP BY 1, 2""")
def continuation_window(t):
    turns = t.conversations
    got = segment.continuation_windows(turns.where("turn % 5 <> 3"), turns, "conv_id", "turn", "text", 4)
    return got.select("conv_id", "turn", F.size("continuations").alias("n"), F.md5(F.array_join("continuations", "\n")).alias("digest"))


@query("SELECT conv_id, max(CASE WHEN length(text) > 800 THEN 4 ELSE 2 END)::INT AS \"window\" FROM conversations GROUP BY 1")
def window_size(t):
    return segment.window_size(t.conversations, ["conv_id"], F.length("text") > 800)


VOTES = "SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN p_name END AS a, CASE WHEN p_size % 5 = 0 THEN p_type ELSE p_name END AS b, CASE WHEN p_size % 3 = 0 THEN p_brand WHEN p_size % 11 = 0 THEN '' ELSE p_name END AS c, p_name AS d FROM part"


@query(f"""WITH v AS ({VOTES}), p AS (SELECT p_partkey, nullif(a, '') AS a, nullif(b, '') AS b, nullif(c, '') AS c, d FROM v),
n AS (SELECT *, (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT AS n, CASE WHEN a IS NULL THEN '' ELSE 'A' END || CASE WHEN b IS NULL THEN '' ELSE 'B' END || CASE WHEN c IS NULL THEN '' ELSE 'C' END AS who FROM p),
r AS (SELECT p_partkey, d, CASE WHEN n < 2 THEN 'fewer_than_2_sources' WHEN n = 2 AND coalesce(a, b) = coalesce(c, b) THEN 'agree_2_of_2_' || who WHEN n = 2 THEN 'disagree_2_of_2_' || who
WHEN a = b AND b = c THEN 'all_agree' WHEN b = c THEN 'outlier_A' WHEN a = c THEN 'outlier_B' WHEN a = b THEN 'outlier_C' ELSE 'all_differ' END AS verdict,
CASE WHEN n = 2 AND coalesce(a, b) = coalesce(c, b) THEN coalesce(a, b) WHEN n = 3 AND (a = b OR a = c) THEN a WHEN n = 3 AND b = c THEN b END AS consensus FROM n)
SELECT p_partkey, verdict, consensus, coalesce(d = consensus, false) AS agrees FROM r""")
def vote_3way(t):
    size = F.col("p_size")
    a = F.when(size % 7 != 0, F.col("p_name"))
    b = F.when(size % 5 == 0, F.col("p_type")).otherwise(F.col("p_name"))
    c = F.when(size % 3 == 0, F.col("p_brand")).when(size % 11 == 0, "").otherwise(F.col("p_name"))
    verdict, consensus, agrees = classify.vote(a, b, c, F.col("p_name"))
    return t.part.select("p_partkey", verdict.alias("verdict"), consensus.alias("consensus"), agrees.alias("agrees"))
