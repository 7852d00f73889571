"""Queries of the ingesting and reporting operators over whole tables, each beside its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.corpus_view import SQL as CORPUS
from quizloom.corpus_view import corpus_view
from quizloom.functions import text as tx
from quizloom.operators import metadata as md
from quizloom.operators import metrics as mx
from quizloom.operators import reports as rp
from quizloom.session import table
from quizloom.sources import files, layout, lines, parsers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


def _pick(n, *values: str):
    """One of the values by n."""
    return F.get(F.lit(list(values)), (n % len(values)).cast("int"))


def _sql_pick(n: str, *values: str) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][CAST(({n}) % {len(values)} AS INTEGER) + 1]"


@query("SELECT source AS section, count(*) AS n, min(doc_id) AS low, max(doc_id) AS high FROM documents GROUP BY source")
def section_inventory(s, d):
    return rp.section_inventory(table(s, d, "documents").select(F.col("source").alias("section"), F.col("doc_id").alias("num")))


@query("SELECT count(l_discount) AS n, round(avg(least(0.9::DOUBLE + l_discount, 0.99::DOUBLE)), 6) AS mean, round(min(least(0.9::DOUBLE + l_discount, 0.99::DOUBLE)), 6) AS least FROM lineitem")
def confidence_summary(s, d):
    c = rp.confidence_summary(table(s, d, "lineitem").select((F.lit(0.9) + F.col("l_discount").cast("double")).alias("conf")))
    return c.select("n", F.round("mean", 6).alias("mean"), F.round("least", 6).alias("least"))


@query("SELECT count(*) AS n, count(DISTINCT o_custkey) AS n_facts FROM orders")
def distinct_facts(s, d):
    return rp.distinct_facts(table(s, d, "orders"), "o_custkey")


@query("WITH p AS (SELECT CAST(floor(octet_length(encode(html)) / 1024) AS BIGINT) AS kb, CAST((length(html) - length(replace(html, '<p', ''))) / 2 AS BIGINT) AS marks FROM pages) SELECT CASE WHEN marks >= 2 THEN 'OK' ELSE 'FAILED: no marks' END AS state, count(*) AS n, CAST(sum(kb) AS BIGINT) AS kb, CAST(sum(marks) AS BIGINT) AS marks FROM p GROUP BY 1")
def download_totals(s, d):
    return rp.download_totals(rp.download_states(table(s, d, "pages"), "html", "<p", 4))


def _families(s, d):
    return table(s, d, "nation").groupBy(F.col("n_regionkey").cast("int").alias("family")).agg(F.collect_list("n_name").alias("members"))


def _named(s, d):
    n = table(s, d, "nation").select(F.col("n_name").alias("id"), (F.col("n_nationkey") % 3).cast("int").alias("topic"))
    return n.unionByName(table(s, d, "region").select(F.concat(F.lit("region "), "r_name").alias("id"), F.lit(1).alias("topic")))


_NAMED = "named AS (SELECT n_name AS id, CAST(n_nationkey % 3 AS INTEGER) AS topic, CAST(n_regionkey AS INTEGER) AS fam FROM nation UNION ALL SELECT 'region ' || r_name, 1, NULL FROM region)"


@query(f"WITH {_NAMED} SELECT id, topic, fam FROM named")
def family_members(s, d):
    return rp.with_families(_named(s, d), _families(s, d)).select("id", "topic", "fam")


@query(f"WITH {_NAMED} SELECT count(*) AS n, count(*) FILTER (topic <> 0) AS with_topic, count(fam) AS with_family, count(DISTINCT fam) AS families FROM named")
def payload_meta(s, d):
    return rp.payload_meta(rp.with_families(_named(s, d), _families(s, d)))


@query("WITH p AS (SELECT DISTINCT c_custkey AS num FROM customer), g AS (SELECT DISTINCT o_custkey * 2 AS num FROM orders) SELECT num, 'no answer' AS side FROM p WHERE num NOT IN (SELECT num FROM g) UNION ALL SELECT num, 'no question' FROM g WHERE num NOT IN (SELECT num FROM p)")
def unmatched_numbers(s, d):
    return rp.unmatched(table(s, d, "customer").select(F.col("c_custkey").alias("num")), table(s, d, "orders").select((F.col("o_custkey") * 2).alias("num")))


@query(
    """WITH q AS (SELECT l_orderkey AS category, l_linenumber AS num FROM lineitem), g AS (SELECT DISTINCT l_orderkey AS category, l_linenumber AS num FROM lineitem WHERE l_orderkey % 3 > 0 AND l_quantity <= 48),
    a AS (SELECT category, list(DISTINCT num) AS asked FROM q GROUP BY 1), b AS (SELECT category, list(DISTINCT num) AS known FROM g GROUP BY 1),
    j AS (SELECT a.category, known, list_sort(list_filter([1, 2, 3], lambda x: NOT list_contains(asked, x))) AS gaps, list_sort(list_filter(asked, lambda x: NOT list_contains(coalesce(known, []), x)))[1:6] AS outside FROM a LEFT JOIN b ON a.category = b.category)
    SELECT category, CASE WHEN known IS NULL THEN 'no grid' WHEN len(gaps) > 0 THEN 'gaps' WHEN len(outside) > 0 THEN 'outside' ELSE 'complete' END AS state,
           CASE WHEN known IS NULL THEN '' WHEN len(gaps) > 0 THEN array_to_string(gaps, ',') ELSE array_to_string(outside, ',') END AS numbers FROM j"""
)
def category_states(s, d):
    li = table(s, d, "lineitem").select(F.col("l_orderkey").alias("category"), F.col("l_linenumber").alias("num"), "l_quantity")
    return rp.category_states(li, li.where("category % 3 > 0 AND l_quantity <= 48"), 3)


_TITLES = ["Test de fisioterapia del SESPA", "test DE Fisioterapeuta", "Celador de ERA", "", "Auxiliar de enfermeria Monte Naranco", "Tecnico de E.R.A.", "Otra cosa", "Matrona y logopeda"]
_TITLE = _sql_pick("c_custkey", *_TITLES)


@query(f"WITH t AS (SELECT c_custkey, {_TITLE} AS title FROM customer) SELECT c_custkey, title, CASE WHEN trim(title) = '' THEN 'no title' ELSE 'other category' END AS reason FROM t WHERE NOT contains(lower(title), 'test de fisioterap')")
def rejected_pages(s, d):
    return rp.rejects(table(s, d, "customer"), _pick(F.col("c_custkey"), *_TITLES), md.WANTED, "c_custkey")


@query(
    f"""WITH t AS (SELECT c_custkey, upper({_TITLE}) AS t FROM customer) SELECT c_custkey, contains(t, 'TEST DE FISIOTERAP') AS wanted,
    CASE WHEN contains(t, 'CELADOR') THEN 'celador' WHEN contains(t, 'AUXILIAR DE ENFERMER') THEN 'TCAE' WHEN contains(t, 'ENFERMER') THEN 'enfermería' WHEN contains(t, 'FISIOTERAPE') THEN 'fisioterapeuta' WHEN contains(t, 'TECNIC') THEN 'técnico' WHEN contains(t, 'MATRON') THEN 'matrona' END AS category,
    CASE WHEN contains(t, 'CELADOR DE ERA') OR contains(t, 'E.R.A.') THEN 'ERA' WHEN contains(t, 'MONTE NARANCO') THEN 'Hospital Monte Naranco' ELSE 'SESPA' END AS body FROM t"""
)
def mapped_titles(s, d):
    t = _pick(F.col("c_custkey"), *_TITLES)
    return table(s, d, "customer").select("c_custkey", md.wanted_category(t).alias("wanted"), md.first_category(t).alias("category"), md.first_category(t, md.ASTURIAN, "SESPA").alias("body"))


_RAW = ["SAS Andalucia", "Osakidetza", "JCyL", "Hosp Poniente", "Unknown body", "SERIS La Rioja"]


@query(
    f"""WITH r AS (SELECT c_custkey, {_sql_pick('c_custkey', *_RAW)} AS raw FROM customer), m(raw, org, ccaa) AS (VALUES ('SAS Andalucia', 'SAS', 'Andalucía'), ('Osakidetza', 'Osakidetza', 'País Vasco'), ('JCyL', 'JCyL', 'Castilla y León'), ('Hosp Poniente', 'Hospital de Poniente', 'Andalucía'), ('SERIS La Rioja', 'SERIS', 'La Rioja'))
    SELECT c_custkey, coalesce(m.org, r.raw) AS org, coalesce(m.ccaa, '') AS ccaa FROM r LEFT JOIN m ON r.raw = m.raw"""
)
def body_and_region(s, d):
    return table(s, d, "customer").select("c_custkey", md.body_and_region(_pick(F.col("c_custkey"), *_RAW)).alias("b")).select("c_custkey", "b.org", "b.ccaa")


@query("SELECT doc_id, CASE WHEN doc_id % 20 BETWEEN 1 AND 11 THEN CAST(doc_id % 20 AS INTEGER) END AS topic FROM labels")
def general_topics(s, d):
    return table(s, d, "labels").select("doc_id", md.up_to_topic((F.col("doc_id") % 20).cast("int")).alias("topic"))


_LINES = ["BOLETÍN OFICIAL de la provincia", "núm. 12", "El tema trata de leyes", "", "2024-00123", "Programa del curso", "Otra línea"]


@query(f"WITH l AS (SELECT l_orderkey, l_linenumber, {_sql_pick('l_orderkey + l_linenumber', *_LINES)} AS text FROM lineitem) SELECT l_orderkey, l_linenumber, text FROM l WHERE text IN ('El tema trata de leyes', 'Otra línea')")
def lines_without_noise(s, d):
    li = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", _pick(F.col("l_orderkey") + F.col("l_linenumber"), *_LINES).alias("text"))
    return lines.without_noise(li)


@query("SELECT CAST(r_regionkey AS BIGINT) AS doc, 'general' AS section, CAST(n_nationkey % 60 + 1 AS INTEGER) AS num, trim(regexp_replace(n_name || ' of  region ' || n_regionkey, '\\s+', ' ', 'g')) AS text FROM nation JOIN region ON n_regionkey = r_regionkey")
def syllabus_topics(s, d):
    n, r = table(s, d, "nation"), table(s, d, "region")
    heads = r.select(F.col("r_regionkey").cast("long").alias("doc"), F.lit(1).alias("page"), F.lit(0).alias("line_no"), F.lit("PARTE GENERAL").alias("text"))
    topic = n.select(F.col("n_regionkey").cast("long").alias("doc"), F.lit(1).alias("page"), (F.col("n_nationkey") * 2 + 1).cast("int").alias("line_no"), F.concat(F.lit("TEMA "), (F.col("n_nationkey") % 60 + 1).cast("string"), F.lit(": "), "n_name").alias("text"))
    more = n.select(F.col("n_regionkey").cast("long").alias("doc"), F.lit(1).alias("page"), (F.col("n_nationkey") * 2 + 2).cast("int").alias("line_no"), F.concat(F.lit("of  region "), F.col("n_regionkey").cast("string")).alias("text"))
    return lines.syllabus(heads.unionByName(topic).unionByName(more))


@query(f"WITH {CORPUS} SELECT id, resp, 'corpus' AS part FROM corpus WHERE resp_verificada UNION ALL SELECT 'REG-' || c_custkey, upper(substr('abcd', CAST(c_custkey % 4 + 1 AS INTEGER), 1)), 'regional' FROM customer")
def translated_union(s, d):
    a = corpus_view(s, d).where("resp_verificada").select("id", "resp", F.lit("corpus").alias("part"))
    n = F.col("c_custkey")
    raw = table(s, d, "customer").select(F.concat(F.lit("REG-"), n.cast("string")).alias("id"), F.lit("2025").alias("fecha_examen"), F.col("c_name").alias("enunciado"), F.create_map(F.lit("a"), F.col("c_name")).alias("opciones"), F.substring(F.lit("abcd"), (n % 4 + 1).cast("int"), F.lit(1)).alias("respuesta_correcta"), F.concat(F.lit("T"), (n % 9).cast("string")).alias("tema"))
    return a.unionByName(md.translated(raw, {"part": "regional"}).select("id", "resp", "part"))


@query("WITH o AS (SELECT o_custkey % 50 AS k, o_orderstatus AS org, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS fecha FROM orders), p AS (SELECT k, org, coalesce(left(fecha, 4), 's/f') AS y, min(fecha) AS f FROM o GROUP BY 1, 2, 3) SELECT CAST(k AS VARCHAR) AS k, string_agg(org || ' ' || y, ', ' ORDER BY org, f NULLS FIRST) AS sittings FROM p GROUP BY k")
def sittings_in_order(s, d):
    o = table(s, d, "orders").select((F.col("o_custkey") % 50).cast("string").alias("q"), F.col("o_orderstatus").alias("org"), F.when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("fecha"))
    return mx.sittings(o).select("k", F.array_join("sittings", ", ").alias("sittings"))


@query("WITH r AS (SELECT CASE o_orderkey % 6 WHEN 0 THEN 'zeta 7 options' WHEN 1 THEN 'alpha' WHEN 2 THEN 'zeta 9 options' WHEN 3 THEN 'beta' END AS reason, o_orderkey FROM orders), m AS (SELECT regexp_replace(reason, '[0-9]+', 'N', 'g') AS reason, count(*) AS n, min(o_orderkey) AS f FROM r WHERE reason IS NOT NULL GROUP BY 1) SELECT reason, n FROM m ORDER BY n DESC, f LIMIT 2")
def reasons_by_first_met(s, d):
    n = F.col("o_orderkey") % 6
    why = F.when(n == 0, F.lit("zeta 7 options")).when(n == 1, F.lit("alpha")).when(n == 2, F.lit("zeta 9 options")).when(n == 3, F.lit("beta"))
    return mx.reasons(table(s, d, "orders").select("o_orderkey", F.array_compact(F.array(why)).alias("fails")), k=2, order="o_orderkey")


@query(
    """WITH t AS (SELECT o_orderkey, o_orderdate AS t, CASE o_orderkey % 3 WHEN 0 THEN 'on ' || strftime(o_orderdate, '%d-%m-%Y') WHEN 1 THEN 'in 1999 and 2012, 2004' ELSE 'no date' END AS x FROM orders)
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CASE WHEN year(t) >= 2000 THEN strftime(t, '%Y-%m-%d') END WHEN 1 THEN '2012' END AS found, CASE o_orderkey % 3 WHEN 0 THEN strftime(t, '%Y-%m-%d') WHEN 1 THEN '2012-01-01' END AS filled FROM t"""
)
def dates_in_titles(s, d):
    n = F.col("o_orderkey") % 3
    x = F.when(n == 0, F.concat(F.lit("on "), F.date_format("o_orderdate", "dd-MM-yyyy"))).when(n == 1, F.lit("in 1999 and 2012, 2004")).otherwise(F.lit("no date"))
    t = table(s, d, "orders").select("o_orderkey", x.alias("x"))
    return t.select("o_orderkey", tx.iso_date("x").alias("found"), tx.iso_date_or_year("x").alias("filled"))


@query("SELECT c_custkey, CAST(c_custkey AS INTEGER) AS num, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_custkey % 10 AS INTEGER) END AS first FROM customer")
def look_alike_numbers(s, d):
    n = F.col("c_custkey").cast("string")
    return table(s, d, "customer").select("c_custkey", tx.look_alike_number(F.translate(n, "1025", "lOZS")).alias("num"), tx.first_nonzero((F.col("c_custkey") % 10).cast("int")).alias("first"))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(text, 'the') THEN 'en' END, CASE WHEN contains(text, 'der') THEN 'de' END, CASE WHEN contains(text, 'los') THEN 'es' END], lambda x: x IS NOT NULL), '+') AS tags FROM documents")
def text_tags(s, d):
    return table(s, d, "documents").select("doc_id", tx.tags(F.col("text"), {"en": "the", "de": "der", "es": "los"}).alias("tags"))


@query(
    """WITH t AS (SELECT item_id, list_distinct(list_filter(string_split(text, ' '), lambda x: length(x) > 2)) AS t FROM benchmark), j AS (SELECT a.item_id, a.t AS a, CASE WHEN a.item_id % 5 = 0 THEN [] ELSE b.t END AS b FROM t a JOIN t b ON b.item_id = a.item_id + 1)
    SELECT item_id, CASE WHEN len(b) = 0 THEN 0.0::DOUBLE ELSE round(len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))), 6) END AS jaccard, CASE WHEN len(b) = 0 THEN 0.0::DOUBLE ELSE round(len(list_intersect(a, b))::DOUBLE / least(len(a), len(b)), 6) END AS overlap FROM j"""
)
def set_likeness(s, d):
    b = table(s, d, "benchmark").select("item_id", F.array_distinct(F.filter(F.split("text", " "), lambda x: F.length(x) > 2)).alias("t"))
    j = b.select("item_id", F.col("t").alias("a")).join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("t").alias("b")), "item_id")
    j = j.withColumn("b", F.when(F.col("item_id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.col("b")))
    return j.select("item_id", F.round(tx.jaccard(F.col("a"), F.col("b")), 6).alias("jaccard"), F.round(tx.overlap(F.col("a"), F.col("b")), 6).alias("overlap"))


@query(f"WITH {CORPUS} SELECT id, md5(concat_ws(' ', q, array_to_string(opts, ' | '))) AS digest FROM corpus")
def embedding_texts(s, d):
    return corpus_view(s, d).select("id", F.md5(tx.embedding_text(F.col("q"), F.col("opts")).cast("binary")).alias("digest"))


@query(
    """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), j AS (SELECT a.vec_id, a.v AS a, b.v AS b, a.vec_id % 3 = 0 AS solo FROM e a JOIN e b ON b.vec_id = a.vec_id + 1)
    SELECT vec_id, round(list_dot_product(a, b), 5) AS dot, round(a[1] / sqrt(list_dot_product(a, a)), 5) AS unit, round(CASE WHEN solo THEN a[1] ELSE (a[1] + b[1]) / 2 END, 5) AS pooled FROM j"""
)
def vector_functions(s, d):
    e = table(s, d, "embeddings")
    j = e.select("vec_id", F.col("embedding").alias("a")).join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")), "vec_id")
    mask = F.array(F.lit(1), F.when(F.col("vec_id") % 3 == 0, 0).otherwise(1))
    first = lambda v: F.round(F.get(v, F.lit(0)).cast("double"), 5)
    return j.select("vec_id", F.round(tx.dot(F.col("a"), F.col("b")), 5).alias("dot"), first(tx.unit(F.col("a"))).alias("unit"), first(tx.mean_pool(F.array("a", "b"), mask)).alias("pooled"))


@query("SELECT page_id, md5(replace(html, '</', '<\\/')) AS digest, CAST((length(html) - length(replace(html, '<a ', ''))) / 3 AS BIGINT) AS marks, starts_with(html, '%PDF') AS pdf FROM pages")
def page_marks(s, d):
    p = table(s, d, "pages")
    return p.select("page_id", F.md5(tx.script_safe(F.col("html")).cast("binary")).alias("digest"), tx.count_marks(F.col("html"), "<a ").alias("marks"), files.is_pdf(F.col("html").cast("binary")).alias("pdf"))


@query(
    """WITH w AS (SELECT l_orderkey AS doc, l_linenumber % 2 AS page, l_partkey % 2 AS col, l_suppkey % 3 AS line, l_linenumber AS word_no, CASE WHEN l_linenumber = 3 THEN '17' ELSE l_returnflag END AS text, l_quantity::DOUBLE - 5 AS conf FROM lineitem),
    l AS (SELECT doc, page, col, line, string_agg(text, ' ' ORDER BY word_no, text) AS text, avg(conf) / 100 AS conf FROM w WHERE conf >= 0 GROUP BY ALL),
    n AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc, page ORDER BY col, line) AS INTEGER) AS line_no, row_number() OVER (PARTITION BY doc, page ORDER BY col DESC, line DESC) = 1 AS last FROM l)
    SELECT doc, page, line_no, text, round(conf, 6) AS conf FROM n WHERE NOT (last AND regexp_full_match(text, '[0-9]{1,3}'))"""
)
def scanned_lines(s, d):
    w = table(s, d, "lineitem").select(
        F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") % 2).alias("page"), layout.column_of(F.col("l_partkey") % 2 * 60, F.lit(100)).alias("col"), F.lit(1).alias("block"), F.lit(1).alias("par"),
        (F.col("l_suppkey") % 3).alias("line"), F.col("l_linenumber").alias("word_no"), F.when(F.col("l_linenumber") == 3, F.lit("17")).otherwise(F.col("l_returnflag")).alias("text"), (F.col("l_quantity").cast("double") - 5).alias("conf"),
    )
    return layout.scan_lines(w).select("doc", "page", "line_no", "text", F.round("conf", 6).alias("conf"))


@query(
    """WITH c AS (SELECT l_orderkey AS doc, l_linenumber % 3 AS page, CAST(round_even(l_quantity::DOUBLE / 3, 0) AS INTEGER) AS line_no, l_extendedprice AS x0, l_linestatus AS text, l_returnflag = 'A' AS b FROM lineitem WHERE l_linenumber % 3 IN (1, 2) AND l_suppkey % 2 = 0)
    SELECT doc, page, line_no, string_agg(text, '' ORDER BY x0, text) AS text, round(avg(CASE WHEN b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS bold FROM c GROUP BY doc, page, line_no"""
)
def body_lines(s, d):
    c = table(s, d, "lineitem").select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") % 3).alias("page"), F.col("l_quantity").cast("double").alias("top"), F.col("l_extendedprice").alias("x0"), F.col("l_linestatus").alias("text"), (F.col("l_returnflag") == "A").alias("is_bold"), F.when(F.col("l_suppkey") % 2 == 0, F.lit("(0,)")).otherwise(F.lit("(1,)")).alias("colour"))
    return layout.bold_lines(layout.body_chars(c, 1, 2)).select("doc", "page", "line_no", "text", F.round("bold", 6).alias("bold"))


@query(
    """WITH t AS (SELECT l_suppkey AS doc, l_linenumber AS page, l_quantity::DOUBLE * 13 AS x, l_partkey AS y, substr('ABCD', CAST(l_orderkey % 4 + 1 AS INTEGER), 1) AS resp, l_orderkey FROM lineitem WHERE (l_orderkey % 9) * 10 > 30),
    g AS (SELECT *, CASE WHEN x - lag(x) OVER (PARTITION BY doc, page ORDER BY x, y) > 36 THEN 1 ELSE 0 END AS step FROM t),
    c AS (SELECT *, sum(step) OVER (PARTITION BY doc, page ORDER BY x, y ROWS UNBOUNDED PRECEDING) AS col FROM g)
    SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY page, col, y, x, resp) AS INTEGER) AS num, resp FROM c"""
)
def scanned_grid(s, d):
    t = table(s, d, "lineitem").select(F.col("l_suppkey").alias("doc"), F.col("l_linenumber").alias("page"), (F.col("l_quantity").cast("double") * 13).alias("x"), F.col("l_partkey").alias("y"), F.substring(F.lit("ABCD"), (F.col("l_orderkey") % 4 + 1).cast("int"), F.lit(1)).alias("text"), (F.col("l_orderkey") % 9 * 10).alias("conf"), F.lit(600).alias("width"))
    return layout.placed_grid(t)


@query("SELECT r_name AS id, r_regionkey AS n FROM region")
def json_array_rows(s, d):
    r = table(s, d, "region").select(F.col("r_name").alias("id"), F.col("r_regionkey").cast("long").alias("n"))
    return files.array_rows(files.json_array(r, "n"), "json", "struct<id:string,n:bigint>")


@query("SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_in_cache(s, d):
    return files.missing_ids(table(s, d, "documents").select(F.col("doc_id").alias("id")), table(s, d, "labels").select(F.col("doc_id").alias("id")))


@query("SELECT printf('  %-9s: %5d  (%d-%d)', coalesce(source, 'null'), count(*), min(doc_id), max(doc_id)) AS line FROM documents GROUP BY source")
def report_lines(s, d):
    return rp.report(section_inventory(s, d), "  %-9s: %5d  (%d-%d)", "section", "n", "low", "high")


@query("SELECT '<script>var d = {\"id\":' || doc_id || ',\"x\":\"<\\/p>\"};</script>' AS page FROM labels")
def payload_pages(s, d):
    j = F.concat(F.lit('{"id":'), F.col("doc_id").cast("string"), F.lit(',"x":"</p>"}'))
    return table(s, d, "labels").select(files.filled_page("<script>var d = /*DATA*/;</script>", "/*DATA*/", j).alias("page"))


@query(
    r"""WITH RECURSIVE c AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN CAST(turn // 2 + 1 AS INTEGER) END AS num, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
    f AS (SELECT conv_id, i, coalesce(num BETWEEN 1 AND 4, false) AS q, CASE WHEN num BETWEEN 1 AND 4 THEN num + 1 ELSE 1 END AS due FROM c WHERE i = 1
          UNION ALL SELECT c.conv_id, c.i, coalesce(c.num BETWEEN f.due AND f.due + 3, false), CASE WHEN c.num BETWEEN f.due AND f.due + 3 THEN c.num + 1 ELSE f.due END FROM f JOIN c ON c.conv_id = f.conv_id AND c.i = f.i + 1),
    b AS (SELECT c.conv_id, c.i, c.num, f.q, sum(CASE WHEN f.q THEN 1 ELSE 0 END) OVER (PARTITION BY c.conv_id ORDER BY c.i) AS block FROM c JOIN f ON c.conv_id = f.conv_id AND c.i = f.i)
    SELECT CAST(conv_id AS VARCHAR) AS doc, max(CASE WHEN q THEN num END) AS num, CAST(least(count(*) FILTER (num IS NULL), 4) AS INTEGER) AS n_opts FROM b WHERE block > 0 GROUP BY conv_id, block"""
)
def scanned_questions(s, d):
    c = table(s, d, "conversations")
    text = F.when(F.col("role") == "user", F.concat((F.floor(F.col("turn") / 2) + 1).cast("string"), F.lit(". (stem) "), F.col("text"))).otherwise(F.concat(F.lit("a) "), F.col("text")))
    rows = c.select(F.col("conv_id").cast("string").alias("doc"), F.lit(1).alias("page"), F.col("turn").cast("int").alias("line_no"), F.regexp_replace(text, r"\s+", " ").alias("text"), F.lit(0.95).alias("conf"))
    return parsers.parse_scans(rows).select("doc", "num", F.size("opts").alias("n_opts"))


@query(
    r"""WITH n AS (SELECT conv_id, turn, role, CAST(turn // 2 + 1 AS INTEGER) AS num, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS block FROM conversations)
    SELECT conv_id AS doc, max(CASE WHEN role = 'user' THEN num END) AS num, CAST(least(count(*) FILTER (role <> 'user'), 1) AS INTEGER) AS n_opts FROM n WHERE block > 0 GROUP BY conv_id, block HAVING count(*) FILTER (role <> 'user') > 0 OR block = 1"""
)
def sectioned_questions(s, d):
    c = table(s, d, "conversations")
    text = F.when(F.col("role") == "user", F.concat((F.floor(F.col("turn") / 2) + 1).cast("string"), F.lit(" (stem) "), F.col("text"))).otherwise(F.concat(F.lit("A) "), F.col("text")))
    rows = c.select(F.col("conv_id").alias("doc"), F.lit(3).alias("page"), F.col("turn").cast("int").alias("line_no"), F.regexp_replace(text, r"\s+", " ").alias("text"))
    return parsers.parse_sections(rows, [("all", 3, 3, 1, 999)]).select("doc", "num", F.size("opts").alias("n_opts"))


@query()
def link_windows(s, d):
    return layout.link_contexts(table(s, d, "pages"), r'href="([^"]+)"').select("url", "ctx", "page")
