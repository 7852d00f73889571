"""Text keys and scalar functions as column expressions."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folding() -> tuple[str, str]:
    """Latin characters whose compatibility decomposition, without marks, is one other character."""
    a, b = [], []
    for x in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(x)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(x):
            a.append(chr(x))
            b.append(base)
    return "".join(a), "".join(b)


_FROM, _TO = _folding()
#: What decomposes to several characters.
SEVERAL = {"ﬁ": "fi", "ﬂ": "fl", "…": "...", "½": "1⁄2", "¼": "1⁄4", "¾": "3⁄4", "ĳ": "ij"}


def fold(c) -> Column:
    """Lower case without diacritics, punctuation kept."""
    low = F.lower(c)
    out = F.translate(low, _FROM, _TO)
    for a, b in SEVERAL.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    # ASCII needs no more than lower case
    return F.when(F.octet_length(low) == F.length(low), low).otherwise(F.regexp_replace(out, r"\p{Mn}", ""))


def fold_upper(c) -> Column:
    return F.upper(fold(c))


def spaced(folded) -> Column:
    """Folded text with other characters than a-z, 0-9 and spaces to spaces, spaces collapsed and trimmed."""
    return F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " "))


def unmarked(folded) -> Column:
    """As spaced, but such characters are taken out; white space is only replaced where that changes it."""
    return F.trim(F.regexp_replace(F.regexp_replace(folded, r"[^a-z0-9\s]+", ""), r"\s{2,}|[\t\n\x0B\f\r]", " "))


def key(c) -> Column:
    """fold, other characters than a-z, 0-9 and spaces to spaces, spaces collapsed and trimmed."""
    return spaced(fold(c))


def key_removed(c) -> Column:
    """As key, but such characters are taken out."""
    return unmarked(fold(c))


def stem_key(c) -> Column:
    """File stem, lower case, only a-z and 0-9."""
    stem = F.regexp_replace(F.regexp_extract(c, r"([^/\\]*)$", 1), r"\.[^.]*$", "")
    return F.regexp_replace(F.lower(stem), "[^a-z0-9]", "")


def tidy(c) -> Column:
    """Common entities decoded, no-break spaces to spaces, white space collapsed."""
    #: Entities that remain in scraped pages.
    pairs = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"), (" ", " ")]
    out = c if isinstance(c, Column) else F.col(c)
    for a, b in pairs:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def without_option_letter(c) -> Column:
    return F.regexp_replace(c, r"^\s*[a-fA-F]\s*[\)\.\-]\s+", "")


def leading_number(c) -> Column:
    """The number that opens a stem; null if none."""
    return F.expr("nullif('', '')").cast("int") if c is None else F.nullif(F.regexp_extract(c, r"^\s*(\d{1,3})\s*[\.\)\-]", 1), F.lit("")).cast("int")


def after_number(c) -> Column:
    return F.regexp_replace(c, r"^\s*\d{1,3}\s*[\.\)\-]\s*", "")


def first_nonzero(*cs: Column) -> Column:
    """The first that is neither null nor 0."""
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in cs])


def letter(index: Column) -> Column:
    """0 to A, 1 to B, up to F; else null."""
    return F.when(index.between(0, 5), F.substring(F.lit("ABCDEF"), index + 1, F.lit(1)))


def look_alike_number(c, short: bool = False) -> Column:
    """Digits out of scanned look-alikes; null if something else is left. short: bars and letters for 1 and 0 only."""
    table = ("|IilOo", "111100") if short else ("|IilOoSsBZz", "11110055822")
    return F.try_to_number(F.translate(F.regexp_replace(c, r"\s", ""), *table), F.lit("999999999")).cast("int")


def year_of(c) -> Column:
    """The first four characters of a date or year; 's/f' if there are none."""
    return F.coalesce(F.nullif(F.left(c, F.lit(4)), F.lit("")), F.lit("s/f"))


def iso_date(c) -> Column:
    """dd-mm-yyyy or dd/mm/yyyy within a text as ISO; else its largest year of 20xx; else null."""
    m = lambda i: F.regexp_extract(c, r"(\d{1,2})[-/](\d{1,2})[-/](20\d{2})", i)
    whole = F.concat_ws("-", m(3), F.lpad(m(2), 2, "0"), F.lpad(m(1), 2, "0"))
    return F.when(m(3) != "", whole).otherwise(F.array_max(F.regexp_extract_all(c, F.lit(r"\b(20\d{2})\b"))))


def iso_date_or_year(c) -> Column:
    """dd-mm-yyyy within a text as ISO; else the first of January of its largest year of 19xx or 20xx; else null."""
    m = lambda i: F.regexp_extract(c, r"(\d{2})-(\d{2})-(\d{4})", i)
    year = F.array_max(F.regexp_extract_all(c, F.lit(r"\b(20\d{2}|19\d{2})\b")))
    return F.when(m(3) != "", F.concat_ws("-", m(3), m(2), m(1))).otherwise(F.concat(year, F.lit("-01-01")))


def tags(c, patterns: dict[str, str]) -> Column:
    """Names of the patterns that a text matches, joined by +."""
    return F.array_join(F.array_compact(F.array(*[F.when(F.regexp_like(c, F.lit(p)), F.lit(n)) for n, p in patterns.items()])), "+")


def ascii_bounds(pattern: str) -> str:
    r"""The pattern with \b as a bound of a-z, A-Z, 0-9 and _ alone, whatever the version of Java takes for a letter there; so SQL engines see it."""
    return re.sub(r"\\(.)", lambda m: r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))" if m[1] == "b" else m[0], pattern, flags=re.S)


def masked_digits(c) -> Column:
    return F.regexp_replace(c, r"\d+", "N")


def token_set(c, stop: list[str]) -> Column:
    """Distinct folded words longer than two letters that aren't stop words."""
    words = F.regexp_extract_all(fold(c), F.lit("[a-z0-9ñ]{3,}"), F.lit(0))  # a replacement costs many times a match
    return F.array_except(words, F.array(*map(F.lit, stop)).cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(common / F.size(F.array_union(a, b)))


def overlap(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b)))


def evidence(c, folded: Column, pattern: str, before: int = 30, after: int = 40) -> Column:
    """The text around the first match; the place is that in the folded text."""
    at = F.regexp_instr(folded, F.lit(pattern))
    start = F.greatest(at - before, F.lit(1))
    width = F.length(F.regexp_substr(folded, F.lit(pattern)))
    return F.when(at > 0, F.substring(c, start, at + width + after - start))


def embedding_text(q, opts) -> Column:
    return F.concat_ws(" ", q, F.array_join(opts, " | "))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    norm = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: x / norm)


def mean_pool(vectors: Column, mask: Column) -> Column:
    """The mean of the vectors whose mask is 1; zeros if none is. vectors: array of arrays of one length."""
    count = F.greatest(F.aggregate(mask, F.lit(0.0), lambda s, x: s + x.cast("double")), F.lit(1e-9))
    masked = F.zip_with(vectors, mask, lambda v, m: F.transform(v, lambda x: x.cast("double") * m.cast("double")))
    zeros = F.transform(F.get(vectors, F.lit(0)), lambda x: F.lit(0.0))
    return F.transform(F.aggregate(masked, zeros, lambda s, v: F.zip_with(s, v, lambda a, b: a + b)), lambda x: x / count)


def count_marks(c, mark: str) -> Column:
    """How often a text holds a mark, without overlaps; null: 0."""
    return F.coalesce((F.length(c) - F.length(F.replace(F.col(c) if isinstance(c, str) else c, F.lit(mark), F.lit("")))) / len(mark), F.lit(0)).cast("long")


def script_safe(c) -> Column:
    return F.replace(c, F.lit("</"), F.lit("<\\/"))
