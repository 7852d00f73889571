"""Questions, syllabi and indexes from relations of lines, by windows: no document's lines need Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: What opens a question, an option, a topic of a list, a topic and a section of a syllabus; and lines that repeat on each sheet.
NUMBER, OPTION, TOPIC = r"^\s*(\d{1,3})\s*\.\s*-?\s+", r"^\s*[a-dA-D]\s*\)\s*", r"^\s*(\d{1,2})\.\s+(.*)$"
SYLLABUS_TOPIC, SECTION = r"^\s*TEMA\s+(\d{1,2})\s*[:.]\s*(.*)$", r"^\s*(PARTE GENERAL|TEMARIO ESPEC[ÍI]FICO|PARTE ESPEC[ÍI]FICA)\s*$"
NOISE = r"(?i)^\s*(BOLET[ÍI]N OFICIAL|núm\.\s*\d+|https://sede|\d{4,}-\d{4,}|\.dóC|ANEXO|PROGRAMA)"
#: Fixed value: where a topic's first sentence ends.
SENTENCE = r"(?<=[a-záéíóúñ0-9)])[.:]\s"


def _joined(column: str = "text"):
    lines = F.array_sort(F.collect_list(F.struct("page", "line_no", F.trim(column).alias("t"))))
    return F.trim(F.array_join(F.transform(lines, lambda x: x.t), " "))


def bold_questions(lines: DataFrame, bold: float = 0.5, number: str = NUMBER, option: str = OPTION) -> DataFrame:
    """doc, num, printed, page, q, opts, misnumbered from lines (doc, page, line_no, text, bold).

    A bold line with a number opens a block, a plain line with a letter an option; other plain
    lines go on with the open option, bold ones with the stem. A block without options is no
    question: its number and text go to the stem before it, unless it is the first. Questions are
    then numbered from 1; misnumbered tells where the printed number differs. Lines before any
    block, and null texts, are left out.
    """
    w = Window.partitionBy("doc").orderBy("page", "line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_bold = F.coalesce(F.col("bold") >= bold, F.lit(False))
    flagged = lines.where("text IS NOT NULL").withColumns({"opens": is_bold & F.regexp_like("text", F.lit(number)), "opt": ~is_bold & F.regexp_like("text", F.lit(option)), "heavy": is_bold})
    in_block = flagged.withColumn("block", F.sum(F.col("opens").cast("int")).over(w)).where("block > 0")
    of_block = Window.partitionBy("doc", "block").orderBy("page", "line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = in_block.withColumn("seg", F.sum(F.col("opt").cast("int")).over(of_block)).withColumn("seg", F.when(F.col("heavy"), 0).otherwise(F.col("seg")))
    bare = F.when(F.col("opens"), F.regexp_replace("text", number, "")).when(F.col("opt"), F.regexp_replace("text", option, "")).otherwise(F.col("text"))
    printed = F.when(F.col("opens"), F.regexp_extract("text", number, 1).cast("int"))
    parts = dealt.withColumns({"bare": bare, "printed": printed}).groupBy("doc", "block", "seg").agg(_joined("bare").alias("t"), F.max("printed").alias("printed"), F.min("page").alias("page"))
    opts = F.array_sort(F.collect_list(F.when(F.col("seg") > 0, F.struct("seg", "t"))))
    blocks = parts.groupBy("doc", "block").agg(F.max(F.when(F.col("seg") == 0, F.col("t"))).alias("stem"), F.max("printed").alias("printed"), F.min("page").alias("page"), F.transform(opts, lambda x: x.t).alias("opts"))
    by_block = Window.partitionBy("doc").orderBy("block")
    starts = (F.size("opts") > 0) | (F.row_number().over(by_block) == 1)
    led = blocks.withColumn("starts", starts).withColumn("num", F.sum(F.col("starts").cast("int")).over(by_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"))
    piece = F.when(F.col("starts"), F.col("stem")).otherwise(F.concat(F.col("printed").cast("string"), F.lit(". "), F.col("stem")))
    whole = F.array_sort(F.collect_list(F.struct("block", piece.alias("t"))))
    first = lambda c: F.max(F.when(F.col("starts"), F.col(c)))
    out = led.groupBy("doc", "num").agg(first("printed").alias("printed"), first("page").alias("page"), F.trim(F.array_join(F.transform(whole, lambda x: x.t), " ")).alias("q"), first("opts").alias("opts"))
    return out.withColumn("misnumbered", F.col("printed") != F.col("num"))


def without_noise(lines: DataFrame, noise: str = NOISE) -> DataFrame:
    """Lines that are neither null, blank nor noise."""
    return lines.where((F.trim("text") != "") & ~F.regexp_like("text", F.lit(noise)))


def syllabus(lines: DataFrame, noise: str = NOISE, section: str = SECTION, topic: str = SYLLABUS_TOPIC) -> DataFrame:
    """doc, section, num, text of numbered topics from lines (doc, page, line_no, text); what follows goes on with the open topic, a section closes it.

    Noise, blank and null lines are left out, as are those outside all sections; an empty table gives no rows.
    """
    kept = without_noise(lines, noise)
    w = Window.partitionBy("doc").orderBy("page", "line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_section, is_topic = F.regexp_like("text", F.lit(section)), F.regexp_like("text", F.lit(topic))
    specific = F.when(F.upper("text").contains("ESPEC"), F.lit("specific")).otherwise(F.lit("general"))
    k = kept.withColumns({"head": is_section, "section": F.last(F.when(is_section, specific), ignorenulls=True).over(w), "run": F.sum(F.when(is_section | is_topic, 1).otherwise(0)).over(w)})
    k = k.where("NOT head AND section IS NOT NULL").withColumns({"num": F.when(is_topic, F.regexp_extract("text", topic, 1).cast("int")), "bare": F.when(is_topic, F.regexp_extract("text", topic, 2)).otherwise(F.col("text"))})
    out = k.groupBy("doc", "section", "run").agg(F.max("num").alias("num"), F.regexp_replace(_joined("bare"), r"\s+", " ").alias("text"))
    return out.where("num IS NOT NULL").drop("run")


def topic_names(lines: DataFrame, text: str = "text", order: str = "line_no", most: int = 70) -> DataFrame:
    """topic, name: the first sentence of each numbered line, cut; of a number met twice the last line's."""
    t = F.trim(text)
    named = lines.where(F.regexp_like(t, F.lit(TOPIC))).select(F.regexp_extract(t, TOPIC, 1).cast("int").alias("topic"), F.regexp_extract(t, TOPIC, 2).alias("rest"), F.col(order).alias("o"))
    first = F.get(F.split("rest", SENTENCE, 2), F.lit(0))
    return named.withColumn("name", F.left(F.trim(first), F.lit(most))).groupBy("topic").agg(F.max_by("name", "o").alias("name"))


def feed_entries(df: DataFrame, column: str = "value", pattern: str = r"(?i)colecci[óo]n|completa|online|[íi]ndice") -> DataFrame:
    """title, url of a JSON feed's entries whose title matches; url: the first alternate link, null if none. Broken JSON has no entries."""
    shape = "feed struct<entry: array<struct<title: struct<`$t`: string>, link: array<struct<rel: string, href: string>>>>>"
    e = df.select(F.explode(F.from_json(column, shape)["feed"]["entry"]).alias("e")).select(F.col("e.title.`$t`").alias("title"), F.col("e.link").alias("link"))
    return e.where(F.regexp_like("title", F.lit(pattern))).select("title", F.get(F.filter("link", lambda x: x.rel == "alternate"), F.lit(0))["href"].alias("url"))
