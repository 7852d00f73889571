"""Forms read out of whole pages, with SQL that reads the same html."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.session import table
from quizloom.sources import parsers


def page_forms(s: SparkSession, d: str) -> DataFrame:
    """Forms appended to whole pages, some without an end, with comments, inline tags and references."""
    p = table(s, d, "pages")
    n = lambda m, k=0: (F.col("page_id") % m + k).cast("string")
    option = lambda i, x: F.concat(
        F.lit("<input value=\"a > b\" type='radio' onclick=\"respuesta"), F.when(F.col("page_id") % 4 == i, F.lit("('Correcto')")).otherwise(F.lit("('Incorrecto')")),
        F.lit(f'">{x}) the  <i>answer</i> {i} of '), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, F.lit("<br>")).otherwise(F.lit("")),
    )
    html = F.concat(
        F.col("html"), F.lit('<FORM name="pregunta_'), n(90), F.lit("\" class='q'><p>"), n(90, 1), F.lit(". <b>What is</b> "), F.col("url"), F.lit("<br/>said &amp;amp; done?</p><p>not this</p>"),
        F.when(F.col("page_id") % 3 == 0, F.lit("<!-- <input type=radio> -->")).otherwise(F.lit("")), *[option(i, x) for i, x in enumerate("abcd")],
        F.when(F.col("page_id") % 5 == 0, F.lit("")).otherwise(F.lit("</form>")), F.lit("<form><input type=text name=q></form>"),
    )
    found = parsers.page_forms(p.withColumn("html", html))
    return found.select("file", "place", "form", "stem", F.array_join("marks", " | ").alias("marks"), F.array_join("texts", " | ").alias("texts"))


PAGE_FORMS_SQL = r"""
WITH appended AS (
  SELECT url, html || '<FORM name="pregunta_' || page_id % 90 || '" class=''q''><p>' || (page_id % 90 + 1) || '. <b>What is</b> ' || url || '<br/>said &amp;amp; done?</p><p>not this</p>'
    || CASE WHEN page_id % 3 = 0 THEN '<!-- <input type=radio> -->' ELSE '' END
    || array_to_string(list_transform([0, 1, 2, 3], lambda i: '<input value="a > b" type=''radio'' onclick="respuesta' || CASE WHEN i = page_id % 4 THEN '(''Correcto'')' ELSE '(''Incorrecto'')' END || '">'
       || substr('abcd', i + 1, 1) || ') the  <i>answer</i> ' || i || ' of ' || page_id || CASE WHEN page_id % 2 = 0 THEN '<br>' ELSE '' END), '')
    || CASE WHEN page_id % 5 = 0 THEN '' ELSE '</form>' END || '<form><input type=text name=q></form>' AS html
  FROM pages
), split AS (
  SELECT url, unnest(string_split_regex(html, '(?i)<form\b')[2:]) AS part FROM appended
), bodies AS (
  SELECT url, regexp_extract(part, '(?i)name="([^"]*)"', 1) AS form, string_split_regex(regexp_replace(part, '(?s)<!--.*?-->', '', 'g'), '(?i)</form')[1] AS body FROM split
), radios AS (
  SELECT *, list_filter(string_split_regex(body, '(?i)<input\b')[2:], lambda x: contains(x, 'type=''radio''')) AS r, regexp_extract(body, '(?is)<p>(.*?)</p>', 1) AS p FROM bodies
)
SELECT url AS file, CAST(1 AS INTEGER) AS place, form,
  trim(regexp_replace(replace(replace(regexp_replace(p, '<[^>]*>', ' ', 'g'), '&amp;', '&'), '&amp;', '&'), '\s+', ' ', 'g')) AS stem,
  array_to_string(list_transform(r, lambda x: regexp_extract(x, 'onclick="([^"]*)"', 1)), ' | ') AS marks,
  array_to_string(list_transform(r, lambda x: trim(regexp_replace(regexp_replace(regexp_replace(x, '^[^"]*"[^"]*"[^"]*"[^"]*">', ''), '<[^>]*>', '', 'g'), '\s+', ' ', 'g'))), ' | ') AS texts
FROM radios WHERE len(r) > 0
"""

QUERIES = {"page_forms": page_forms}
SQL = {"page_forms": PAGE_FORMS_SQL}
