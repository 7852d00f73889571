"""Topic queries at full size: hundreds of terms, a table of pattern rules, staged rules; tables of terms and rules come from the documents' own words."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.corpus_view import SQL as CORPUS
from quizloom.corpus_view import corpus_view
from quizloom.functions import text as tx
from quizloom.operators import classify as cl
from quizloom.operators import rules as rl
from quizloom.operators.terms import Terms, term_counts
from quizloom.session import scratch, table
from quizloom.sources import strict

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Single words and pairs of the term table, its topics, and the rules of the two rule tables.
WORDS, PAIRS, TOPICS, PATTERNS, STAGED = 300, 100, 44, 28, 60
STAGES = ["norm", "tie", "tool", "word"]


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


_STRICT = f"""{CORPUS}, ids AS (
  SELECT *, CASE WHEN pos % 17 = 6 THEN 'D-' || lpad(CAST(pos - 1 AS VARCHAR), 9, '0') ELSE id END AS ident, pos % 17 AS k FROM corpus
), per AS (
  SELECT CASE WHEN k <> 5 THEN ident END AS id, unnest(list_filter(CASE WHEN k = 5 THEN ['unreadable JSON'] ELSE [
    CASE WHEN k = 7 THEN 'missing reserva' END, CASE WHEN k = 8 THEN 'verification not boolean' END,
    CASE WHEN (resp_verificada OR k = 8) AND NOT coalesce(CASE WHEN k = 2 THEN 'Z' ELSE resp END IN ('A', 'B', 'C', 'D'), false) THEN 'verified without a valid letter' END,
    CASE WHEN NOT resp_verificada AND k = 2 THEN 'letter without verification' END,
    CASE WHEN k = 9 OR opts IS NULL OR len(opts) = 0 THEN 'no options' END, CASE WHEN k = 1 OR q IS NULL OR trim(regexp_replace(q, '\\s+', ' ', 'g')) = '' THEN 'empty stem' END,
    CASE WHEN k = 3 THEN 'confidence outside 0 to 1' END, CASE WHEN k = 4 THEN 'penalty outside 0 to 1' END, CASE WHEN k = 7 THEN 'reserve not boolean' END] END, lambda x: x IS NOT NULL)) AS why
  FROM ids
), twice AS (
  SELECT ident AS id, 'repeated id' AS why FROM ids WHERE k <> 5 QUALIFY row_number() OVER (PARTITION BY ident ORDER BY pos) > 1
)"""


@query(f"WITH {_STRICT} SELECT * FROM per UNION ALL SELECT * FROM twice")
def strict_failures(s, d):
    """The corpus written as JSON lines with faults of each kind, then checked as it is read."""
    c = corpus_view(s, d)
    k = F.col("pos") % 17
    ident = F.when(k == 6, F.concat(F.lit("D-"), F.lpad((F.col("pos") - 1).cast("string"), 9, "0"))).otherwise(F.col("id"))
    record = F.struct(
        ident.alias("id"), "org", "ccaa", F.lit("2020-01-01").alias("fecha"), F.lit(None).cast("string").alias("turno"), F.col("pos").cast("int").alias("num"), F.lit(None).cast("string").alias("bloque"),
        F.when(k == 1, F.lit(" ")).otherwise(F.col("q")).alias("q"), F.when(k == 9, F.array().cast("array<string>")).otherwise(F.col("opts")).alias("opts"),
        F.when(k == 2, F.lit("Z")).otherwise(F.col("resp")).alias("resp"), "resp_verificada", F.when(k == 3, F.lit(1.5)).otherwise(F.col("conf")).alias("conf"),
        F.lit("html").alias("origen"), F.when(k == 4, F.lit(7.0)).otherwise(F.col("penalizacion")).alias("penalizacion"), "reserva",
    )
    json = F.to_json(record, {"ignoreNullFields": "false"})
    json = F.when(k == 5, F.left(json, F.length(json) - 2)).when(k == 7, F.regexp_replace(json, r',"reserva":(true|false)\}$', "}")).when(k == 8, F.regexp_replace(json, r'"resp_verificada":(true|false)', '"resp_verificada":"yes"')).otherwise(json)
    folder = f"{scratch(s)}/parts-{uuid.uuid4().hex}"
    lines = c.select(json.alias("value"))
    for n in range(3):  # three parts, as Spark writes them
        lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == n).write.mode("append").text(folder, lineSep="\n")
    return strict.failures(s, folder, (), "*.txt").select("id", F.regexp_replace("why", ", first in .*$", "").alias("why"))


def terms_table(s: SparkSession, d: str) -> DataFrame:
    """r, term, topic, weight: the WORDS most frequent words of four letters or more, every fourth as a prefix, and the PAIRS most frequent pairs of neighbours."""
    text = table(s, d, "documents").select(tx.fold("text").alias("t"))

    def top(pattern: str, n: int) -> list[str]:
        w = text.select(F.explode(F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).alias("w")).groupBy("w").agg(F.count("*").alias("c"))
        return [r.w for r in w.orderBy(F.desc("c"), "w").limit(n).collect()]

    words = [w[:4] + "~" if r % 4 == 3 else w for r, w in enumerate(top("[a-z]{4,}", WORDS))]
    rows = [(r, t, r % TOPICS + 1, 1 + r % 2) for r, t in enumerate(words)]
    rows += [(WORDS + r, t, (WORDS + r) % TOPICS + 1, 1 + (WORDS + r) % 2) for r, t in enumerate(top("[a-z]{3,} [a-z]{3,}", PAIRS))]
    return s.createDataFrame(rows, "r int, term string, topic int, weight int")


FOLDED = "replace(strip_accents(lower({0})), 'ß', '0')"
TERMS = f"""folded AS (SELECT strip_accents(lower(text)) AS t FROM documents
), singles AS (
  SELECT w, row_number() OVER (ORDER BY c DESC, w) - 1 AS r FROM (SELECT w, count(*) AS c FROM (SELECT unnest(regexp_extract_all(t, '[a-z]{{4,}}')) AS w FROM folded) GROUP BY w)
), pairs AS (
  SELECT w, row_number() OVER (ORDER BY c DESC, w) - 1 + {WORDS} AS r FROM (SELECT w, count(*) AS c FROM (SELECT unnest(regexp_extract_all(t, '[a-z]{{3,}} [a-z]{{3,}}')) AS w FROM folded) GROUP BY w)
), terms AS (
  SELECT CAST(r AS INTEGER) AS r, CASE WHEN r < {WORDS} AND r % 4 = 3 THEN left(w, 4) || '~' ELSE w END AS term, CAST(r % {TOPICS} + 1 AS INTEGER) AS topic, CAST(1 + r % 2 AS INTEGER) AS weight
  FROM (SELECT * FROM singles WHERE r < {WORDS} UNION ALL SELECT * FROM pairs WHERE r < {WORDS + PAIRS})
), patterns AS (
  SELECT DISTINCT term, CASE WHEN term LIKE '%~' THEN '\\b' || left(term, length(term) - 1) ELSE '\\b' || term || '\\b' END AS p FROM terms
)"""


@query(f"WITH {TERMS}, docs AS (SELECT {FOLDED.format('text')} AS t FROM documents) SELECT p.term, count(d.t) AS n FROM patterns p LEFT JOIN docs d ON regexp_matches(d.t, p.p) GROUP BY p.term")
def term_hits(s, d):
    return term_counts(table(s, d, "documents"), Terms.of(terms_table(s, d)), tx.fold("text"))


_LEXICON = f"""{CORPUS}, {TERMS}, texts AS (
  SELECT id, {FOLDED.format('q')} AS s, {FOLDED.format("array_to_string(opts, ' ')")} AS o FROM corpus
), met AS (
  SELECT t.id, p.term, regexp_matches(t.s, p.p) AS own, coalesce(regexp_matches(t.o, p.p), false) AS other FROM texts t, patterns p WHERE t.s IS NOT NULL
), points AS (
  SELECT m.id, l.topic, sum(CASE WHEN own THEN weight WHEN other AND weight >= 2 THEN 1 ELSE 0 END) AS p FROM met m JOIN terms l ON l.term = m.term WHERE own OR other GROUP BY ALL HAVING sum(CASE WHEN own THEN weight WHEN other AND weight >= 2 THEN 1 ELSE 0 END) > 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY p DESC, topic) AS k FROM points
), two AS (
  SELECT c.id, coalesce(a.p, 0) AS p1, coalesce(b.p, 0) AS p2, a.topic AS t1, b.topic AS t2
  FROM corpus c LEFT JOIN placed a ON a.id = c.id AND a.k = 1 LEFT JOIN placed b ON b.id = c.id AND b.k = 2
), decided AS (
  SELECT id, CAST(CASE WHEN p1 >= 2 AND p1 > p2 THEN t1 END AS INTEGER) AS topic, CAST(CASE WHEN p1 >= 2 THEN t2 END AS INTEGER) AS second_topic,
         CASE WHEN p1 = 0 THEN 'none' WHEN p1 < 2 THEN 'weak' WHEN p1 = p2 THEN 'tie' ELSE 'lexicon:' || CAST(CAST(p1 AS BIGINT) AS VARCHAR) END AS why
  FROM two
)"""


@query(f"WITH {_LEXICON} SELECT id, topic, second_topic, why FROM decided")
def lexicon_topics(s, d):
    return cl.classify(corpus_view(s, d), [], cl.Lexicon.of(terms_table(s, d))).select("id", "topic", "second_topic", "why")


def pattern_table(s: SparkSession, d: str) -> DataFrame:
    """ord, name, pattern, topic of PATTERNS rules of three forms over the words of the term table."""
    t = F.regexp_replace("term", "~$", "")
    words = terms_table(s, d).where(F.col("r") < WORDS).select("r", t.alias("w"))
    at = lambda k: words.select((F.col("r") - k).alias("x"), F.col("w").alias(f"w{k}"))
    three = at(40).join(at(41), "x").join(at(42), "x").where((F.col("x") >= 0) & (F.col("x") % 9 == 0)).withColumn("ord", (F.col("x") / 9 + 1).cast("int")).where(F.col("ord") <= PATTERNS)
    form = F.col("ord") % 3
    either = F.concat(F.lit(r"\b"), "w40", F.lit(r"\b|\b"), "w41", F.lit(r"\b"))
    near = F.concat(F.lit("("), "w40", F.lit("|"), "w41", F.lit(")[^.]{0,40}("), "w42", F.lit(")"))
    pattern = F.when(form == 0, either).when(form == 1, F.concat(F.lit(r"\b"), "w40")).otherwise(near)
    return three.select("ord", F.concat(F.lit("rule "), F.col("ord").cast("string")).alias("name"), pattern.alias("pattern"), (F.col("ord") % 10 + 1).cast("int").alias("topic"))


_PATTERNS = f"""{CORPUS}, {TERMS}, bare AS (SELECT r, replace(term, '~', '') AS w FROM terms WHERE r < {WORDS}
), rule AS (
  SELECT CAST((a.r - 40) // 9 + 1 AS INTEGER) AS ord, a.w AS a, b.w AS b, c.w AS c FROM bare a JOIN bare b ON b.r = a.r + 1 JOIN bare c ON c.r = a.r + 2 WHERE a.r >= 40 AND (a.r - 40) % 9 = 0 AND (a.r - 40) // 9 < {PATTERNS}
), rules AS (
  SELECT ord, 'rule ' || ord AS name, CAST(ord % 10 + 1 AS INTEGER) AS topic,
         CASE ord % 3 WHEN 0 THEN '\\b' || a || '\\b|\\b' || b || '\\b' WHEN 1 THEN '\\b' || a ELSE '(' || a || '|' || b || ')[^.]{{0,40}}(' || c || ')' END AS p FROM rule
), stems AS (SELECT id, {FOLDED.format('q')} AS s FROM corpus
), met AS (SELECT t.id, r.ord, r.name, r.topic, row_number() OVER (PARTITION BY t.id ORDER BY r.ord) AS k FROM stems t JOIN rules r ON regexp_matches(t.s, r.p))"""


@query(f"WITH {_PATTERNS} SELECT r.ord, r.name, r.topic, count(*) FILTER (k = 1) AS hits, count(*) FILTER (k > 1) AS shadowed FROM rules r LEFT JOIN met m ON m.ord = r.ord GROUP BY ALL")
def rule_table_report(s, d):
    return rl.PatternRules.of(pattern_table(s, d)).report(corpus_view(s, d))


@query(f"WITH {_PATTERNS} SELECT c.id, m.name AS rule, m.topic FROM corpus c LEFT JOIN met m ON m.id = c.id AND m.k = 1")
def rule_table_topics(s, d):
    return rl.PatternRules.of(pattern_table(s, d)).apply(corpus_view(s, d)).select("id", "rule", "topic")


def staged_table(s: SparkSession, d: str) -> DataFrame:
    """stage_order, stage, ord, topic, groups, reason of STAGED rules: from rare terms to frequent ones, those of the stage tie with two groups."""
    names = {r.r: r.term for r in terms_table(s, d).collect()}  # WORDS + PAIRS rows
    rows = []
    for j in range(STAGED):
        stage = j * len(STAGES) // STAGED
        some = lambda *ks: [names[r] for k in ks if (r := WORDS + PAIRS - 1 - 6 * j - k) in names]
        joint = STAGES[stage] == "tie"
        groups = [some(2, 0, 1), some(5, 4, 3)] if joint else [some(2, 0, 1)]
        rows.append((stage, STAGES[stage], j, j % TOPICS + 1, groups, f"tie {j}" if joint else f'{STAGES[stage]} "{{}}"'))
    return s.createDataFrame(rows, "stage_order int, stage string, ord int, topic int, groups array<array<string>>, reason string")


_STAGED = f"""{CORPUS}, {TERMS}, slots AS (
  SELECT j, j * {len(STAGES)} // {STAGED} AS stage, g, pos, {WORDS + PAIRS} - 1 - 6 * j - k AS r
  FROM (SELECT unnest(range({STAGED})) AS j), (VALUES (1, 1, 2), (1, 2, 0), (1, 3, 1), (2, 1, 5), (2, 2, 4), (2, 3, 3)) AS v(g, pos, k)
  WHERE g = 1 OR j * {len(STAGES)} // {STAGED} = 1
), need AS (SELECT s.j, s.stage, s.g, s.pos, t.term FROM slots s JOIN terms t ON t.r = s.r
), sizes AS (SELECT j, stage, count(DISTINCT g) AS groups FROM slots GROUP BY ALL
), texts AS (
  SELECT id, 1 AS scope, {FOLDED.format("coalesce(q, '')")} AS t FROM corpus UNION ALL SELECT id, 2, {FOLDED.format("coalesce(q, '') || ' || ' || coalesce(array_to_string(opts, ' | '), '')")} FROM corpus
), met AS (
  SELECT t.id, t.scope, p.term FROM texts t JOIN patterns p ON p.term IN (SELECT term FROM need) AND regexp_matches(t.t, p.p)
), held AS (
  SELECT m.id, m.scope, n.j, n.stage, arg_min(n.term, n.pos) FILTER (n.g = 1) AS term, count(DISTINCT n.g) AS g FROM met m JOIN need n ON n.term = m.term GROUP BY ALL
), won AS (
  SELECT h.* FROM held h JOIN sizes s ON s.j = h.j AND s.groups = h.g QUALIFY row_number() OVER (PARTITION BY id ORDER BY scope, h.j) = 1
), staged AS (
  SELECT c.id, CAST(w.j % {TOPICS} + 1 AS INTEGER) AS topic, [{', '.join(f"'{x}'" for x in STAGES)}][w.stage + 1] AS stage,
         CASE WHEN w.j IS NULL THEN 'no sign' WHEN w.stage = 1 THEN 'tie ' || w.j ELSE [{', '.join(f"'{x}'" for x in STAGES)}][w.stage + 1] || ' "' || w.term || '"' END AS reason,
         CASE w.scope WHEN 1 THEN 'stem' WHEN 2 THEN 'all' END AS scope
  FROM corpus c LEFT JOIN won w ON w.id = c.id
), gold AS (SELECT 'D-' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS id, CAST(doc_id % {TOPICS} + 1 AS INTEGER) AS topic, CAST(doc_id % 9 + 1 AS INTEGER) AS second FROM labels WHERE doc_id % 3 < 2 UNION ALL SELECT 'X-' || doc_id, 1, NULL FROM labels WHERE doc_id % 50 = 0)"""


@query(f"WITH {_STAGED} SELECT id, topic, stage, reason, scope FROM staged")
def staged_rules(s, d):
    return rl.decide(corpus_view(s, d), rl.staged_rules(staged_table(s, d))).select("id", "topic", "stage", "reason", "scope")


def _gold(s: SparkSession, d: str) -> DataFrame:
    labels = table(s, d, "labels")
    known = labels.where("doc_id % 3 < 2").select(F.concat(F.lit("D-"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("id"), (F.col("doc_id") % TOPICS + 1).cast("int").alias("topic"), (F.col("doc_id") % 9 + 1).cast("int").alias("second"))
    lost = labels.where("doc_id % 50 = 0").select(F.concat(F.lit("X-"), F.col("doc_id").cast("string")).alias("id"), F.lit(1).alias("topic"), F.lit(None).cast("int").alias("second"))
    return known.unionByName(lost)


@query(f"""WITH {_STAGED}, j AS (SELECT g.*, s.topic AS p, s.id IS NOT NULL AS there FROM gold g LEFT JOIN staged s ON s.id = g.id
), n AS (SELECT count(*) FILTER (p = topic OR coalesce(p = second, false)) AS ok, count(*) FILTER (p IS NOT NULL AND NOT (p = topic OR coalesce(p = second, false))) AS wrong, count(*) FILTER (there AND p IS NULL) AS undecided, count(*) FILTER (NOT there) AS missing FROM j)
SELECT ok, wrong, undecided, missing, ok + wrong AS decided, ok + wrong + undecided AS total, round(ok / greatest(ok + wrong, 1), 6) AS agreement, round((ok + wrong) / greatest(ok + wrong + undecided, 1), 6) AS coverage FROM n""")
def staged_rules_agreement(s, d):
    return rl.agreement(_gold(s, d), staged_rules(s, d).select("id", "topic"))
