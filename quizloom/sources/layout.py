"""Lines and answer grids from what page readers give: words, characters and letters with their places.

Every relation carries its document: pages of two documents never merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Colours of body text, height of a row of characters, least confidence of a grid's letter, gap between its columns as a share of the width.
BLACK = ["(0.0,)", "(0,)", "0", "0.0", "None"]
ROW, LEAST_CONF, GAP = 3, 30, 0.06


def column_of(x: str | Column, width: str | Column) -> Column:
    """0 for the left half of a page, 1 for the right: pages set in two columns are read half by half."""
    x, width = (F.col(c) if isinstance(c, str) else c for c in (x, width))
    return F.when(x < F.floor(width / 2), F.lit(0)).otherwise(F.lit(1))


def scan_lines(words: DataFrame) -> DataFrame:
    """doc, page, line_no, text, conf from scanned words (doc, page, block, par, line, word_no, text, conf; col if pages have columns).

    Blank and null words, and those of negative confidence, are no text. conf is the mean over 100. A
    page's last line goes if it is a page number alone. Lines are numbered from 1 on each page, columns
    left to right. An empty table gives no rows.
    """
    if "col" not in words.columns:
        words = words.withColumn("col", F.lit(0))
    kept = words.where((F.col("conf") >= 0) & (F.trim("text") != ""))
    texts = F.array_sort(F.collect_list(F.struct("word_no", "text")))
    lines = kept.groupBy("doc", "page", "col", "block", "par", "line").agg(F.array_join(F.transform(texts, lambda x: x.text), " ").alias("text"), (F.avg("conf") / 100).alias("conf"))
    place = Window.partitionBy("doc", "page").orderBy("col", "block", "par", "line")
    numbered = lines.withColumn("line_no", F.row_number().over(place)).withColumn("last", F.lead("line").over(place).isNull())
    return numbered.where(~(F.col("last") & F.regexp_like(F.trim("text"), F.lit(r"^\d{1,3}$")))).select("doc", "page", "line_no", "text", "conf")


def body_chars(chars: DataFrame, first: int, last: int, colours: list[str] = BLACK) -> DataFrame:
    """Characters of pages first to last that have a colour of body text (column colour, as text; null counts as None)."""
    return chars.where(F.col("page").between(first, last) & F.coalesce(F.col("colour").cast("string"), F.lit("None")).isin(colours))


def bold_lines(chars: DataFrame) -> DataFrame:
    """doc, page, line_no, text, bold from characters (doc, page, top, x0, text, is_bold): rows by thirds of their height, left to right, with the share of bold ones."""
    row = F.rint(F.col("top") / ROW).cast("int")
    c = F.array_sort(F.collect_list(F.struct("x0", "text")))
    return chars.groupBy("doc", "page", row.alias("line_no")).agg(F.array_join(F.transform(c, lambda x: x.text), "").alias("text"), F.avg(F.coalesce("is_bold", F.lit(False)).cast("double")).alias("bold"))


def placed_grid(letters: DataFrame) -> DataFrame:
    """doc, num, resp from a scanned grid's letters (doc, page, x, y, text, conf, width).

    Letters A to D of a confidence over LEAST_CONF count. A step in x of more than GAP of the page's
    width begins a column; letters are numbered from 1 by page, column and height (then x and letter).
    """
    kept = letters.where(F.trim("text").isin("A", "B", "C", "D") & (F.col("conf") > LEAST_CONF))
    across = Window.partitionBy("doc", "page").orderBy("x", "y")
    step = F.when(F.col("x") - F.lag("x").over(across) > F.col("width") * GAP, 1).otherwise(0)
    in_column = kept.withColumn("step", step).withColumn("column", F.sum("step").over(across.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    down = Window.partitionBy("doc").orderBy("page", "column", "y", "x", F.trim("text"))
    return in_column.select("doc", F.row_number().over(down).alias("num"), F.trim("text").alias("resp"))


def link_contexts(pages: DataFrame, pattern: str, around: int = 400, page: str = "page_id", html: str = "html") -> DataFrame:
    """url, ctx, page: of each link that group 1 of the pattern finds, the text around it, tags taken out; of a url met often the longest, then the first met.

    The place of each match comes from the lengths of what lies between matches, so a page is one row.
    """
    found, between = F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), F.split(F.col(html), pattern)
    urls = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    p = pages.where(F.col(html).isNotNull()).select(F.col(page).alias("page"), F.col(html).alias("html"), F.arrays_zip(found.alias("m"), F.slice(between, F.lit(1), F.size(found)).alias("b"), urls.alias("u")).alias("z"))
    kind = "array<struct<url:string,ctx:string,place:int>>"

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["b"])
        end = start + F.length(x["m"])
        low = F.greatest(start - around, F.lit(0))
        text = F.substring(F.col("html"), low + 1, end + around - low)
        text = F.trim(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", " "), r"\s+", " "))
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(F.struct(x["u"].alias("url"), text.alias("ctx"), start.alias("place")))).cast(kind).alias("out"))

    met = p.select("page", F.inline(F.aggregate("z", F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), step)["out"]))
    best = F.max_by(F.struct("ctx", "page"), F.struct(F.length("ctx"), -F.col("page"), -F.col("place")))
    return met.groupBy("url").agg(best.alias("b")).select("url", "b.ctx", "b.page")
