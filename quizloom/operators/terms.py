"""Many terms at once: one automaton over all of them reads each text once, however many there are."""

from __future__ import annotations

import array
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.session import ship

#: The automaton goes to each task: so many terms and code points at most.
MOST, MOST_CHARS = 200_000, 8 << 20

_built: dict[tuple[str, ...], ahocorasick.Automaton] = {}


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    """Each text leads to the numbers of its terms: (as a prefix, as a whole word). A worker keeps one automaton."""
    if terms not in _built:
        numbers: dict[str, list[int | None]] = {}
        for i, t in enumerate(terms):
            prefix = t.endswith("~")
            numbers.setdefault(t[:-1] if prefix else t, [None, None])[0 if prefix else 1] = i
        a = ahocorasick.Automaton()
        for text, (prefix, whole) in numbers.items():
            if text:
                a.add_word(text, (len(text), prefix, whole))
        a.make_automaton()
        _built.clear()
        _built[terms] = a
    return _built[terms]


def found(text: str | None, terms: tuple[str, ...]) -> list[int]:
    """Numbers, in order, of the terms that a text has between word bounds (a prefix: after one). An empty term is in no text."""
    automaton = _automaton(terms)
    if not text or not len(automaton):
        return []
    seen, n = set(), len(text)
    for last, (size, prefix, whole) in automaton.iter(text):
        if (prefix is None or prefix in seen) and (whole is None or whole in seen):
            continue
        first = last - size + 1
        if (first > 0 and _word(text[first - 1])) == _word(text[first]):
            continue
        if prefix is not None:
            seen.add(prefix)
        if whole is not None and (last + 1 < n and _word(text[last + 1])) != _word(text[last]):
            seen.add(whole)
    return sorted(seen)


def found_in(texts: pa.Array, terms: tuple[str, ...]) -> pa.Array:
    """found() of each text of a batch, of which one at a time is a string."""
    numbers, sizes = array.array("i"), array.array("i")
    for t in texts:
        hits = found(t.as_py(), terms)
        numbers.extend(hits)
        sizes.append(len(hits))
    ends = array.array("i", accumulate(sizes, initial=0))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers, pa.int32()))


class Terms:
    """Folded terms in order, each once; one that ends in ~ stands for words that begin so, another for itself between word bounds.

    Null and empty terms are left out. More than MOST terms, or MOST_CHARS code points, are refused: such a
    list is a table, to be joined with the texts' words.
    """

    def __init__(self, spark: SparkSession, terms: list[str]):
        self.terms = tuple(dict.fromkeys(t for t in terms if t and t != "~"))
        if len(self.terms) > MOST or sum(map(len, self.terms)) > MOST_CHARS:
            raise ValueError("too many terms for one automaton; join a table of them with the texts' words")
        self.number = {t: i for i, t in enumerate(self.terms)}
        ship(spark)

    @classmethod
    def of(cls, table: DataFrame, column: str = "term") -> Terms:
        """The terms of a table's column, in order of code points."""
        rows = table.select(F.col(column).cast("string").alias("t")).distinct().limit(MOST + 1).collect()
        return cls(table.sparkSession, sorted(r.t for r in rows if r.t))

    def hits(self, text: Column) -> Column:
        """array<int>: the numbers of the terms that a folded text has, in order; null and empty texts have none.

        A batch stays in Arrow: a worker holds no second copy of its texts.
        """
        terms = self.terms

        @F.arrow_udf("array<int>")
        def udf(s: pa.Array) -> pa.Array:
            return found_in(s, terms)

        return udf(text)

    def names(self, numbers: Column) -> Column:
        """The terms of an array of numbers."""
        every = F.lit(list(self.terms))
        return F.transform(numbers, lambda i: F.get(every, i))


def term_counts(df: DataFrame, terms: Terms, text: Column) -> DataFrame:
    """term, n: how many rows of df have each term; terms that none has are there with 0."""
    spark = df.sparkSession
    per = df.select(F.explode(terms.hits(text)).alias("i")).groupBy("i").agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(i, t) for i, t in enumerate(terms.terms)], "i int, term string")
    return every.join(per, "i", "left").select("term", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
