"""Queries that show the fixed patterns, marks and payloads themselves, on texts of the tables that hold them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom import schema
from quizloom.corpus_view import SQL as CORPUS
from quizloom.corpus_view import corpus_view
from quizloom.operators import metadata as md
from quizloom.operators import metrics as mx
from quizloom.operators import payload
from quizloom.schema import Corpus
from quizloom.session import table
from quizloom.sources import files, parsers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: What options and stems end with here: matches of the fixed patterns, and near misses.
ENDS = ["Todas son correctas", "Ninguna es correcta", "todas las anteriores son ciertas", "todas son falsas.", "a) b) y c) son correctas", "Ninguna de ellas", "todas son correctass", "todas"]
SIGNS = ["señale la INCORRECTA", "es falsa", "no es", "excepto", "es falsamente", "noes", "correcta", "exceptos"]


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _list(xs: list[str]) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _signed(s: SparkSession, d: str) -> DataFrame:
    pick = lambda xs: F.get(F.lit(xs), (F.col("pos") % len(xs)).cast("int"))
    return corpus_view(s, d).withColumn("opts", F.concat("opts", F.array(pick(ENDS)))).withColumn("q", F.concat_ws(" ", "q", pick(SIGNS)))


_SIGNED = f"""{CORPUS}, signed AS (SELECT * REPLACE (list_append(opts, {_list(ENDS)}[pos % {len(ENDS)} + 1]) AS opts, concat_ws(' ', q, {_list(SIGNS)}[pos % {len(SIGNS)} + 1]) AS q) FROM corpus)"""
_WILD = mx.WILDCARD.replace("(?iu)", "(?i)")
_NEGATIVE = mx.NEGATIVE.replace("(?iu)", "(?i)")


@query(f"WITH {_SIGNED} SELECT count(*) AS n, count(*) FILTER (w) AS n_with, round(count(*) FILTER (w) / greatest(count(*), 1), 6) AS rate FROM (SELECT len(list_filter(opts, lambda o: regexp_matches(o, '{_WILD}'))) > 0 AS w FROM signed)")
def wildcards_by_default(s, d):
    return mx.wildcard_presence(Corpus(_signed(s, d)))


@query(f"WITH {_SIGNED} SELECT CASE WHEN regexp_matches(q, '{_NEGATIVE}') THEN 'negative' ELSE 'positive' END AS sign, count(*) AS n, {', '.join(f'''count(*) FILTER (resp = '{x}') AS n_{x.lower()}''' for x in 'ABCD')} FROM signed WHERE resp_verificada GROUP BY 1")
def negations_by_default(s, d):
    return mx.negation_by_letter(Corpus(_signed(s, d)).verified())


@query("SELECT page_id, starts_with(CASE WHEN page_id % 4 = 0 THEN '%PDF-1.' || page_id % 8 || html WHEN page_id % 4 = 1 THEN ' %PDF' || html ELSE html END, '%PDF') AS pdf FROM pages")
def pdf_marks(s, d):
    """Pages, some of them behind the first bytes of a PDF."""
    k = F.col("page_id") % 4
    content = F.when(k == 0, F.concat(F.lit("%PDF-1."), (F.col("page_id") % 8).cast("string"), F.col("html"))).when(k == 1, F.concat(F.lit(" %PDF"), F.col("html"))).otherwise(F.col("html"))
    return table(s, d, "pages").select("page_id", files.is_pdf(content.cast("binary")).alias("pdf"))


_TITLE = "nullif(trim(regexp_replace(replace(replace(regexp_extract({0}, '(?is)<title[^>]*>(.*?)</title>', 1), '&quot;', '\"'), '&amp;', '&'), '\\s+', ' ', 'g')), '')"


@query(f"SELECT page_id, {_TITLE.format('html')} AS title, {_TITLE.format('left(html, 120)')} AS early FROM pages")
def titles_within(s, d):
    """Titles of pages, and those that end within the first 120 code points."""
    return table(s, d, "pages").select("page_id", md.page_title(F.col("html")).alias("title"), md.page_title(F.col("html"), 120).alias("early"))


@query(f"""WITH {CORPUS}, r AS (
  SELECT id, q, opts, resp, org, CAST(year AS VARCHAR) || '-05-01' AS fecha, CASE WHEN pos % 3 > 0 THEN CAST(pos % 44 AS INTEGER) END AS tema, CASE WHEN pos % 4 = 0 THEN pos % 100 END AS fam,
         CASE pos % 5 WHEN 0 THEN 'autonomico' WHEN 1 THEN '' END AS amb, CASE WHEN pos % 10 = 0 THEN ccaa END AS cat, CASE WHEN pos % 2 = 0 THEN array_to_string(opts, ' ') END AS ctx FROM corpus WHERE resp IN ('A', 'B', 'C', 'D')
), base AS (
  SELECT *, CAST(to_json({{'id': id, 'q': q, 'o': opts, 'r': resp, 'tema': tema, 'fam': fam, 'org': org, 'a': left(fecha, 4)}}) AS VARCHAR) AS j FROM r
)
SELECT id, left(j, length(j) - 1) || CASE WHEN amb <> '' THEN ',"amb":' || to_json(amb) ELSE '' END || CASE WHEN cat <> '' THEN ',"cat":' || to_json(cat) ELSE '' END || CASE WHEN ctx <> '' THEN ',"ctx":' || to_json(left(ctx, 700)) ELSE '' END || '}}' AS json FROM base""")
def payload_rows(s, d):
    """Whole questions with keys that only some have; the options' text stands for a context."""
    c = corpus_view(s, d).where(F.col("resp").isin(schema.LETTERS))
    k = lambda n: F.col("pos") % n
    c = c.withColumns({
        "fecha": F.concat(F.col("year").cast("string"), F.lit("-05-01")), "tema_primario": F.when(k(3) > 0, k(44).cast("int")),
        "ambito": F.when(k(5) == 0, F.lit("autonomico")).when(k(5) == 1, F.lit("")), "categoria_origen": F.when(k(10) == 0, F.col("ccaa")), "contexto": F.when(k(2) == 0, F.array_join("opts", " ")),
    })
    families = corpus_view(s, d).where(k(4) == 0).select("id", k(100).alias("family"))
    return payload.compact(c, families)


_TIDY = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
_LINED = f"{CORPUS}, flat AS (SELECT pos AS doc, org, {_TIDY.format('q')} AS q, list_transform(opts, lambda o: {_TIDY.format('o')}) AS o FROM corpus WHERE q IS NOT NULL)"


def _flat(s: SparkSession, d: str) -> DataFrame:
    one = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    return corpus_view(s, d).where("q IS NOT NULL").select(F.col("pos").alias("doc"), "org", one(F.col("q")).alias("q"), F.transform("opts", one).alias("o"))


def _lines(df: DataFrame, *pages: tuple[int, list]) -> DataFrame:
    """doc, page, line_no, text of arrays of lines."""
    line = lambda page: lambda t, i: F.struct(F.lit(page).alias("page"), (i + 1).alias("line_no"), t.alias("text"))
    return df.select("doc", F.inline(F.concat(*[F.transform(F.concat(*lines), line(page)) for page, lines in pages])))


def _lettered(letters: str) -> Column:
    return F.transform(F.slice("o", 1, len(letters)), lambda t, i: F.concat(F.substring(F.lit(letters), i + 1, F.lit(1)), F.lit(") "), t))


@query(f"""WITH {_LINED}, per AS (SELECT *, array_to_string(o, ' | ') AS opts, 101 + doc % 50 AS n FROM flat)
SELECT doc, 'theory' AS section, CAST(1 + doc % 100 AS INTEGER) AS num, CAST(3 AS INTEGER) AS page, '(' || q || ')' || CASE WHEN len(o) = 0 THEN ' ' || n || ' (on ' || q || ')' ELSE '' END AS q, opts, NULL AS context FROM per
UNION ALL SELECT doc, 'practice', CAST(n AS INTEGER), CAST(22 AS INTEGER), '(on ' || q || ')', opts, 'CASO PRÁCTICO 1: ' || org FROM per WHERE len(o) > 0""")
def sectioned_paper(s, d):
    """A paper a document: a question in each of two sections, the second behind a case study, with sheets' lines between."""
    asks = lambda n, text: F.array(F.concat(n.cast("string"), F.lit(" ("), text, F.lit(")")))
    sheet = F.array(F.lit("Página 3 de 9"))
    first = [sheet, asks(F.col("doc") % 100 + 1, F.col("q")), _lettered("ABCD"), sheet]
    second = [F.array(F.concat(F.lit("CASO PRÁCTICO 1: "), F.col("org"))), asks(F.col("doc") % 50 + 101, F.concat(F.lit("on "), F.col("q"))), _lettered("ABCD")]
    found = parsers.parse_sections(_lines(_flat(s, d), (3, first), (22, second)), [("theory", 3, 21, 1, 100), ("practice", 22, 34, 101, 150)])
    return found.select("doc", "section", "num", "page", "q", F.array_join("opts", " | ").alias("opts"), "context")


@query(f"""WITH {_LINED} SELECT doc, CAST(1 AS INTEGER) AS num, '(' || q || ')' AS q, CASE WHEN len(o) > 0 THEN trim(o[1] || CASE WHEN len(o) > 1 THEN ' c) ' || o[2] ELSE '' END) || CASE WHEN len(o) > 2 THEN ' | ' || o[3] || CASE WHEN len(o) > 3 THEN ' ' || trim('9) ' || o[4]) ELSE '' END ELSE '' END ELSE '' END AS opts FROM flat""")
def booklet_questions(s, d):
    """A booklet's question a document: an option whose letter isn't due goes on with the one before it."""
    first = [F.array(F.concat(F.lit("1. ("), F.col("q"), F.lit(")"))), _lettered("acb9")]
    rows = _lines(_flat(s, d), (1, first)).withColumn("conf", F.lit(0.9))
    return parsers.parse_scans(rows, strict_letters=True).select("doc", "num", "q", F.array_join("opts", " | ").alias("opts"))
