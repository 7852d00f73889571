"""Metadata of exam pages: agreement of title and index, precedence of sources, records of another layout."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.functions.text import fold, tidy

#: What an index calls a body, and its name and region.
BODIES = {
    "SAS Andalucia": ("SAS", "Andalucía"), "Osakidetza": ("Osakidetza", "País Vasco"), "SCS Cantabria": ("SCS", "Cantabria"),
    "SCS Canarias": ("SCS", "Canarias"), "SESCAM CLM": ("SESCAM", "Castilla-La Mancha"), "Red Sanitaria Militar": ("Red Sanitaria Militar", "Estatal"),
    "SERIS La Rioja": ("SERIS", "La Rioja"), "SES Extremadura": ("SES", "Extremadura"), "SMS Murcia": ("SMS", "Murcia"),
    "SACYL CyL": ("SACYL", "Castilla y León"), "SALUD Aragon": ("SALUD", "Aragón"), "JCyL": ("JCyL", "Castilla y León"),
    "SERMAS Madrid": ("SERMAS", "Madrid"), "IB-Salut Baleares": ("IB-Salut", "Baleares"), "DGA Aragon": ("DGA", "Aragón"),
    "Hosp Poniente": ("Hospital de Poniente", "Andalucía"),
}
#: Patterns of a title's category, of its body, and of the category that is looked for.
CATEGORIES = [
    (r"(?i)CELADOR", "celador"), (r"(?i)TCAE|AUXILIAR DE ENFERMER", "TCAE"), (r"(?i)ENFERMER", "enfermería"), (r"(?i)ADMINISTRATIV", "administrativo"),
    (r"(?i)FISIOTERAPE", "fisioterapeuta"), (r"(?i)T[ÉéEe]CNIC", "técnico"), (r"(?i)MATRON", "matrona"), (r"(?i)LOGOPED", "logopeda"),
]
ASTURIAN = [(r"(?i)\bE\.?R\.?A\.?\b|ESTABLECIMIENTOS RESIDENCIALES", "ERA"), (r"(?i)MONTE NARANCO", "Hospital Monte Naranco")]
WANTED = r"(?i)test de fisioterap"

#: A hint of another body counts against a title only if it is longer than this.
SHORT_HINT = 4


def _folded(hint: str) -> str:
    """A hint as fold() would give it."""
    return "".join(c for c in unicodedata.normalize("NFKD", hint.lower()) if not unicodedata.combining(c))


def org_agrees(title: Column, org: Column, hints: dict[str, list[str]]) -> Column:
    """True if a folded title names the org, false if it names another one of hints only, null if it is silent or the org unknown."""
    folded = fold(title)
    any_of = lambda hs: reduce(lambda a, b: a | b, [folded.contains(h) for h in hs], F.lit(False))
    low = {k: [_folded(h) for h in hs] for k, hs in hints.items()}
    out = None
    for k, hs in low.items():
        others = [h for j, more in low.items() if j != k for h in more if len(h) > SHORT_HINT]
        says = F.when(any_of(hs), F.lit(True)).when(any_of(others), F.lit(False))
        out = F.when(org == k, says) if out is None else out.when(org == k, says)
    return F.lit(None).cast("boolean") if out is None else out


def dates_agree(index: Column, title: Column) -> Column:
    """Whether two dates are equal or one holds the other's year; true where either is missing or empty."""
    missing = F.coalesce(index, F.lit("")).eqNullSafe("") | F.coalesce(title, F.lit("")).eqNullSafe("")
    return missing | (index == title) | F.contains(title, F.left(index, F.lit(4))) | F.contains(index, F.left(title, F.lit(4)))


def body_and_region(raw: Column, bodies: dict[str, tuple[str, str]] = BODIES) -> Column:
    """struct(org, ccaa) of an index's text for a body; of an unknown one the text itself and no region; null counts as empty."""
    text = F.coalesce(raw, F.lit(""))
    known = F.create_map(*[x for k, (org, region) in bodies.items() for x in (F.lit(k), F.struct(F.lit(org).alias("org"), F.lit(region).alias("ccaa")))])
    return F.coalesce(F.try_element_at(known, text), F.struct(text.alias("org"), F.lit("").alias("ccaa")))


def first_category(title: Column, rules: list[tuple[str, str]] = CATEGORIES, default: str | None = None) -> Column:
    """The name of the first pattern that the title matches, else the default; a null title has the default."""
    return F.coalesce(*[F.when(F.regexp_like(title, F.lit(p)), F.lit(n)) for p, n in rules], F.lit(default))


def wanted_category(title: Column, pattern: str = WANTED) -> Column:
    """Whether a title names the category looked for; a null title doesn't."""
    return F.coalesce(F.regexp_like(title, F.lit(pattern)), F.lit(False))


def up_to_topic(topic: Column, last: int = 11) -> Column:
    """The topic if it is of the general part, 1 to last; else null."""
    return F.when((topic <= last) & (topic != 0), topic)


def first_given(*sources: Column) -> Column:
    """The first source that is neither null nor empty: an override, the index, the title."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in sources])


def translated(df: DataFrame, fixed: dict[str, object]) -> DataFrame:
    """Records of the regional layout (options as a map, answer in lower case, topic as T9) in the corpus layout; fixed: constant fields."""
    opts = F.transform(F.array(*[F.lit(x) for x in "abcd"]), lambda k: F.coalesce(F.try_element_at("opciones", k), F.lit("")))
    out = df.select("id", F.col("fecha_examen").alias("fecha"), F.col("enunciado").alias("q"), opts.alias("opts"), F.upper(F.coalesce("respuesta_correcta", F.lit(""))).alias("resp"), F.regexp_replace("tema", "^T+", "").try_cast("int").alias("tema_primario"))
    return out.withColumns({c: F.lit(v) for c, v in fixed.items()})


def page_title(html: Column, first: int | None = None) -> Column:
    """A page's title, tidied, looked for in its first code points only if a number is given; null without one."""
    head = html if first is None else F.left(html, F.lit(first))
    title = F.regexp_extract(head, r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.nullif(F.trim(F.regexp_replace(tidy(title), r"\s+", " ")), F.lit(""))
