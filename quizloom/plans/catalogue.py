"""Queries of the question-corpus operators over the driver's tables, each over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizloom import schema
from quizloom.corpus_view import corpus_view
from quizloom.functions import text as tx
from quizloom.operators import classify as cl
from quizloom.operators import metadata as md
from quizloom.operators import metrics as mx
from quizloom.operators import records as rc
from quizloom.operators import similarity as sim
from quizloom.operators import study as st
from quizloom.plans import forms, ingest, shown, topics
from quizloom.plans.oracle import ORACLE
from quizloom.schema import Corpus, Verified
from quizloom.session import cut, table
from quizloom.sources import files, lines, parsers
from quizloom.streaming.ingest import daily_counts

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: Parameters of the queries on the synthetic tables; the operators take any.
WILD = r"\b(all|none|the|los|der)\b"
NEGATIVE = r"\b(not|no|nicht|pas|is)\b"
RULES = [("law", r"\b(the|les)\b.*\bof\b", 1), ("place", r"\bder\b", 2), ("person", r"\blos\b", 3)]
LEXICON = {4: [("ent~", 2), ("que", 1)], 5: [("ein", 2), ("er~", 1)], 6: [("con", 2), ("es~", 1)], 7: [("is", 2), ("th~", 1)]}
FOREIGN, HOME, LEGAL = r"\b(the|les|los)\b", r"\b(is|est)\b", r"\b(of|de|der)\b"
SCOPE = r"\b(with|avec|mit|con)\b"
#: Words that tell nothing about a question.
STOP = ["the", "and", "for", "los", "las", "der", "die", "das", "les", "des", "que", "con"]


def query(f: Callable[[SparkSession, str], DataFrame]):
    _QUERIES[f.__name__] = f
    return f


def _verified(s: SparkSession, d: str) -> Verified:
    return Corpus(corpus_view(s, d)).verified()


@query
def letter_distribution(s, d):
    return mx.letter_distribution(_verified(s, d))


@query
def inventory_by_org(s, d):
    return mx.inventory(Corpus(corpus_view(s, d)), "org")


@query
def inventory_grouping_sets(s, d):
    return mx.inventory_sets(Corpus(corpus_view(s, d)), "org", "ccaa", "year")


@query
def penalty_histogram(s, d):
    return mx.penalty_histogram(Corpus(corpus_view(s, d)))


@query
def best_letter_ev(s, d):
    return mx.best_letter_ev(_verified(s, d))


@query
def negation_by_letter(s, d):
    return mx.negation_by_letter(Verified(_verified(s, d).df.withColumn("q", tx.fold("q"))), NEGATIVE)


@query
def wildcard_presence(s, d):
    c = corpus_view(s, d)
    return mx.wildcard_presence(Corpus(c.withColumn("opts", F.transform("opts", tx.fold))), WILD)


@query
def wildcard_hit_rate(s, d):
    c = corpus_view(s, d)
    return mx.wildcard_hits(Corpus(c.withColumn("opts", F.transform("opts", tx.fold))).verified(), WILD)


@query
def length_bias_stats(s, d):
    return mx.length_bias(_verified(s, d))


@query
def length_bias_p(s, d):
    return mx.length_bias_p(_verified(s, d))


def _stems(s, d):
    return table(s, d, "documents").select(F.col("text").alias("q"), F.col("source").alias("org"), (2000 + F.col("doc_id") % 25).cast("int").alias("year"), F.col("doc_id").alias("pos"))


@query
def recurrence_topk(s, d):
    return mx.recurrence_top(_stems(s, d))


@query
def recurrence_counts(s, d):
    return mx.recurrence_counts(_stems(s, d))


@query
def qa_recurrence(s, d):
    per = corpus_view(s, d).groupBy(tx.key("q").alias("k")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(F.regexp_replace("id", "[0-9]{3}$", ""))), ",").alias("origins"))
    return per.where("n > 1").orderBy(F.desc("n"), "k").limit(5)


def _records(s, d):
    c = corpus_view(s, d)
    bad = F.col("pos") % 11
    return c.select(
        "id", "org", "ccaa", F.col("year").cast("string").alias("fecha"), F.lit("libre").alias("turno"), F.lit(1).alias("num"), F.lit("comun").alias("bloque"),
        F.when(bad == 1, F.lit(" ")).otherwise(F.col("q")).alias("q"), "opts", F.when(bad == 2, F.lit("Z")).otherwise(F.col("resp")).alias("resp"), "resp_verificada",
        F.when(bad == 3, F.lit(1.5)).otherwise(F.col("conf")).alias("conf"), F.lit("html").alias("origen"), F.when(bad == 4, F.lit(7.0)).otherwise(F.col("penalizacion")).alias("penalizacion"), "reserva",
    )


@query
def validate_records(s, d):
    r = _records(s, d)
    return r.select("id", F.array_join(schema.violations(r), "; ").alias("fails"))


@query
def quarantine_split(s, d):
    r = _records(s, d)
    clean, kept_back = rc.quarantine(r.withColumn("fails", schema.violations(r)))
    a = clean.agg(F.lit("clean").alias("part"), F.count("*").alias("n"), F.count_if("resp_verificada").alias("n_verified"))
    return a.unionByName(kept_back.agg(F.lit("quarantine").alias("part"), F.count("*").alias("n"), F.count_if("resp_verificada").alias("n_verified")))


@query
def reason_histogram(s, d):
    r = _records(s, d)
    return mx.reasons(r.withColumn("fails", schema.violations(r)))


@query
def first_wins_dedupe(s, d):
    docs = table(s, d, "documents").withColumn("k", F.md5(tx.key("text").cast("binary")))
    return rc.first_wins(docs, ["k"], ["doc_id"]).select("k", "doc_id", "source")


@query
def collision_anti(s, d):
    docs = cut(table(s, d, "documents").select("doc_id", "source", F.md5(tx.key("text").cast("binary")).alias("k")), "keyed")  # texts are read once, their keys thrice
    known = table(s, d, "benchmark").select(F.md5(tx.key("text").cast("binary")).alias("k"))
    fresh, collided = rc.new_and_collided(docs, known, "k", ["doc_id"])
    return fresh.select("doc_id", F.lit("new").alias("state")).unionByName(collided.select("doc_id", F.lit("collided").alias("state")))


@query
def title_category(s, d):
    title = F.trim(F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), r"\s+", " "))
    p = table(s, d, "pages").select("page_id", tx.tidy(title).alias("title"))
    kind = F.when(F.regexp_like(F.lower("title"), F.lit("the|of")), "english").when(F.regexp_like(F.lower("title"), F.lit("der|ein")), "german").when(F.regexp_like(F.lower("title"), F.lit("les|que")), "romance").otherwise("other")
    return p.select("page_id", "title", kind.alias("category"))


@query
def title_entities(s, d):
    p = table(s, d, "pages")
    return p.select(F.explode(F.regexp_extract_all("html", F.lit(r"&[a-z]+;"), F.lit(0))).alias("entity")).groupBy("entity").agg(F.count("*").alias("n"))


@query
def link_context_longest(s, d):
    p = table(s, d, "pages")
    one = p.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r'<a [^>]*href="[^"]*"[^>]*>[^<]*'), F.lit(0))).alias("a"))
    one = one.select("page_id", F.regexp_extract("a", 'href="([^"]*)"', 1).alias("url"), F.regexp_extract("a", ">([^<]*)$", 1).alias("ctx"))
    w = Window.partitionBy("url").orderBy(F.desc(F.length("ctx")), "page_id", "ctx")
    return one.withColumn("r", F.row_number().over(w)).where("r = 1").select("url", "ctx", "page_id")


@query
def index_left_match(s, d):
    pages = table(s, d, "pages").select("page_id", "url")
    index = table(s, d, "documents").select(F.concat(F.when(F.col("doc_id") % 3 == 0, F.lit("Page-")).otherwise(F.lit("page__")), (F.col("doc_id") - F.col("doc_id") % 2).cast("string"), F.lit(".html")).alias("slug"), F.col("source").alias("org"), F.col("doc_id").alias("row"))
    left = pages.withColumn("file", F.concat(F.lit("raw/page_"), F.col("page_id").cast("string"), F.lit(".htm")))
    return rc.lookup(left, index, tx.stem_key("file"), tx.stem_key("slug"), ["row"]).select("page_id", "slug", "org")


def _grid(s, d):
    return table(s, d, "labels").select(F.col("doc_id").alias("num"), F.substring(F.lit("ABCD"), (F.col("doc_id") % 4 + 1).cast("int"), F.lit(1)).alias("resp"))


@query
def answer_join(s, d):
    q = table(s, d, "documents").select(F.col("doc_id").alias("num"), "source")
    return rc.with_answers(q, _grid(s, d)).select("num", "source", "resp", "resp_verificada")


@query
def answer_upsert(s, d):
    rect = table(s, d, "documents").select(F.col("doc_id").alias("num"), F.when(F.col("doc_id") % 10 == 0, F.lit("D")).alias("resp"))
    return rc.upsert(_grid(s, d), rect)


@query
def answer_gaps(s, d):
    q = table(s, d, "documents").select(F.col("doc_id").alias("num"))
    return q.join(_grid(s, d).select("num"), "num", "left_anti")


@query
def complete_categories(s, d):
    c = corpus_view(s, d).select("id", "org", "ccaa", "year", (F.size("opts") == 4).alias("four"))
    return rc.whole_groups(c.withColumn("g", F.concat_ws("-", "org", "ccaa", "year")), "g", F.col("four")).select("id", "g")


@query
def turn_blocks(s, d):
    return rc.blocks(table(s, d, "conversations"), "conv_id", "turn", F.col("role") == "user", "text").select("conv_id", F.col("block").cast("long").alias("block"), "first", "n", F.length("text").cast("long").alias("chars"))


@query
def context_carry_forward(s, d):
    c = rc.carry_forward(table(s, d, "conversations"), "conv_id", "turn", F.when(F.col("role") == "user", F.col("text")), "context")
    return c.select("conv_id", "turn", F.length("context").cast("long").alias("context_chars"))


@query
def gap_islands(s, d):
    e = table(s, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    i = rc.islands(e, "user_id", ["us", "event_id"], lambda a, b: b - a > 3_600_000_000)
    return i.groupBy("user_id", F.col("island").cast("long").alias("island")).agg(F.count("*").alias("n"), F.min("us").alias("first_us"))


@query
def numbering_gaps_dupes(s, d):
    return mx.numbering(table(s, d, "lineitem"), "l_orderkey", "l_linenumber")


@query
def number_gaps(s, d):
    return rc.gaps(table(s, d, "labels").select(F.pmod("doc_id", F.lit(8)).alias("g"), F.col("doc_id").cast("long").alias("num")), "g", "num")


@query
def numbering_jumps(s, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    li = table(s, d, "lineitem").withColumn("before", F.lag("l_linenumber").over(w))
    return li.where("l_linenumber - before > 1").select("l_orderkey", "before", "l_linenumber")


@query
def rules_first_match(s, d):
    c = table(s, d, "documents").select("doc_id", tx.fold("text").alias("f"))
    r = cl.first_rule(F.col("f"), RULES)
    return c.select("doc_id", r["name"].alias("rule"), r["topic"].alias("topic"))


@query
def lexicon_score_decision(s, d):
    return cl.classify(corpus_view(s, d), RULES, LEXICON).select("id", "topic", "second_topic", "why")


def _gold(s, d):
    return table(s, d, "labels").select(F.concat(F.lit("D-"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("id"), (F.col("doc_id") % 7 + 1).cast("int").alias("topic"), (F.col("doc_id") % 5 + 1).cast("int").alias("second"))


@query
def classifier_eval(s, d):
    return cl.evaluate(_gold(s, d), cl.classify(corpus_view(s, d), RULES, LEXICON))


@query
def confusion_topk(s, d):
    return cl.confusions(_gold(s, d), cl.classify(corpus_view(s, d), RULES, LEXICON))


@query
def rule_cascade(s, d):
    return cl.rule_cascade(corpus_view(s, d), [RULES[:1], RULES[1:]]).select("id", "topic")


@query
def foreign_filter(s, d):
    docs = table(s, d, "documents")
    return docs.where(cl.foreign(tx.fold("text"), FOREIGN, HOME, LEGAL)).select("doc_id")


@query
def scope_evidence(s, d):
    return cl.scope(table(s, d, "documents").withColumnRenamed("text", "q"), SCOPE).where("in_scope").select("doc_id", "evidence")


@query
def token_jaccard_pairs(s, d):
    b = table(s, d, "benchmark")  # each item whole, and its first two thirds
    start = F.left("text", F.floor(F.length("text") * 2 / 3).cast("int"))
    b = b.select((F.col("item_id") * 2).alias("item_id"), "text").unionByName(b.select((F.col("item_id") * 2 + 1).alias("item_id"), start.alias("text")))
    b = b.select("item_id", tx.token_set("text", STOP).alias("t"))
    return sim.jaccard_pairs(b, "item_id", "t", 0.5).select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query
def leader_clusters(s, d):
    q = table(s, d, "documents").select("doc_id", tx.token_set("text", STOP).alias("t"))
    return sim.leaders(q, "doc_id", "t", 0.8)


@query
def cosine_pairs(s, d):
    return sim.cosine_pairs(table(s, d, "embeddings"), "vec_id", "embedding", 0.65).select("a", "b", F.round("distance", 4).alias("distance"))


@query
def cosine_index_pairs(s, d):
    p = sim.cosine_pairs_indexed(table(s, d, "embeddings"), "vec_id", "embedding", 0.5)
    return p.select("a", "b", F.round("distance", 4).alias("distance"))


@query
def threshold_sweep(s, d):
    p = sim.cosine_pairs(table(s, d, "embeddings"), "vec_id", "embedding", 0.7)
    return p.select(F.explode(F.lit([0.5, 0.55, 0.6, 0.65, 0.7])).alias("threshold"), "distance").groupBy("threshold").agg(F.count_if(F.col("distance") < F.col("threshold")).alias("n_pairs"))


@query
def average_linkage_families(s, d):
    return sim.families(table(s, d, "embeddings"), "vec_id", "embedding", 0.6)


@query
def recency_weight(s, d):
    c = corpus_view(s, d).groupBy("org").agg(F.count("*").alias("n"), F.sum(mx.recency(F.col("year"))).alias("w"))
    return c.select("org", "n", F.round("w", 6).alias("weight"), F.round(F.col("w") / F.greatest("n", F.lit(1)), 3).alias("mean_weight"))


@query
def topic_weights_laplace(s, d):
    topics = table(s, d, "nation").select((F.col("n_nationkey") + 1).cast("int").alias("topic"))
    counts = table(s, d, "labels").groupBy((F.col("doc_id") % 20 + 1).cast("int").alias("topic")).agg(F.count("*").alias("n"))
    return mx.laplace_weights(counts, topics, 65)


@query
def family_summary(s, d):
    docs = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.md5(tx.key("text").cast("binary")).alias("family"), F.col("lang").alias("topic"), F.col("source").alias("org"), (2000 + F.col("doc_id") % 25).cast("int").alias("year"), F.col("doc_id").alias("pos"))
    f = mx.family_summary(docs, "family", least=2)
    return f.select("family", "n", "majority", F.size("topics").cast("long").alias("n_topics"), F.array_join("orgs", ",").alias("orgs"), "n_sittings", F.round("weight", 6).alias("weight"), F.array_join("members", ",").alias("members"))


@query
def migrate_defaults(s, d):
    old = corpus_view(s, d).select("id", "resp", F.when(F.col("pos") % 4 == 0, F.col("conf")).alias("conf"))
    new = schema.with_defaults(old)
    return new.select("id", "resp", "resp_verificada", "conf", "origen", "revisar", "penalizacion", "reserva", "changed")


@query
def compact_payload(s, d):
    c = corpus_view(s, d).where(F.col("resp").isin(schema.LETTERS))
    ctx = F.left(F.get("opts", F.lit(0)), F.lit(700))  # the context is cut, the question is whole
    return c.select("id", "q", ctx.alias("ctx"), F.size("opts").cast("long").alias("n_opts"), (F.expr("locate(resp, 'ABCD')") - 1).cast("long").alias("r"), F.when(F.col("ccaa") != "", F.col("ccaa")).alias("c"))


@query
def payload_json(s, d):
    c = corpus_view(s, d).where(F.col("resp").isin(schema.LETTERS))
    return files.payload(c.select("id", "q", "opts", "resp"))


@query
def union_parts(s, d):
    a = table(s, d, "documents").select(F.col("doc_id").alias("n"), F.lit("documents").alias("part"))
    b = table(s, d, "benchmark").select(F.col("item_id").alias("n"), F.col("text").alias("extra"), F.lit("benchmark").alias("part"))
    return a.unionByName(b, allowMissingColumns=True).groupBy("part").agg(F.count("*").alias("n"), F.count("extra").alias("n_extra"))


@query
def set_difference(s, d):
    return table(s, d, "documents").select("doc_id").subtract(table(s, d, "labels").select("doc_id"))


@query
def set_intersection(s, d):
    return table(s, d, "documents").select("doc_id").intersect(table(s, d, "labels").select("doc_id"))


@query
def hash_sample(s, d):
    return rc.hash_sample(table(s, d, "documents"), "doc_id", 20).select("doc_id")


@query
def normalised_keys(s, d):
    f = table(s, d, "documents").select("doc_id", tx.fold("text").alias("f"))  # folded once for all three
    return f.select("doc_id", F.md5(tx.spaced("f").cast("binary")).alias("spaced"), F.md5(tx.unmarked("f").cast("binary")).alias("removed"), F.md5(F.col("f").cast("binary")).alias("folded"))


@query
def scalar_functions(s, d):
    c = table(s, d, "customer")
    n = F.col("c_custkey")
    stem = F.concat(n.cast("string"), F.lit(".- Stem of "), F.col("c_name"))
    return c.select("c_custkey", tx.leading_number(stem).alias("num"), tx.after_number(stem).alias("rest"), tx.letter((n % 8).cast("int")).alias("letter"), tx.masked_digits("c_name").alias("masked"), tx.without_option_letter(F.concat(F.lit("b) "), F.col("c_name"))).alias("option"), tx.year_of(F.when(n % 3 == 0, F.lit("2015-03-01")).when(n % 3 == 1, F.lit(""))).alias("year"), F.format_string("%s-%02d-%03d", F.lit("X"), (n % 90).cast("int"), (n % 900).cast("int")).alias("id"))


@query
def grid_scan(s, d):
    o = table(s, d, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.concat(k.cast("string"), F.lit(" "), F.when(k % 5 == 4, F.lit("anulada")).otherwise(F.substring(F.lit("abcd"), (k % 5 + 1).cast("int"), F.lit(1))))), " ").alias("text"))
    return parsers.grid(o, by=("o_custkey",))


@query
def html_questions(s, d):
    p = table(s, d, "pages")
    form = F.concat(F.lit("<form name='pregunta"), F.col("page_id").cast("string"), F.lit("'><p>"), (F.col("page_id") + 1).cast("string"), F.lit(". "), F.col("url"), F.lit("<br/></p>"), *[F.concat(F.lit(f"<input type='radio' onclick=\"respuesta1('{'Correcto' if i == 1 else 'Incorrecto'}')\">{x}) option {i} of "), F.col("page_id").cast("string"), F.lit("<br>")) for i, x in enumerate("abcd")], F.lit("<input type='text' name='resultado'></form>"))
    return parsers.parse_pages(p.withColumn("html", F.concat("html", form))).select("file", "num", "q", F.size("opts").cast("long").alias("n_opts"), "right_index", F.size("fails").cast("long").alias("n_fails"), F.size("warnings").cast("long").alias("n_warnings"))


@query
def daily_event_counts(s, d):
    return daily_counts(table(s, d, "events"))


HINTS = {"en": ["the", "with the"], "de": ["der", "nicht"], "fr": ["les", "avec "], "es": ["los", "pero "]}


@query
def org_title_match(s, d):
    return table(s, d, "documents").select("doc_id", md.org_agrees(F.col("text"), F.col("lang"), HINTS).alias("agrees"))


@query
def date_agreement(s, d):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    said = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy")).when(F.col("o_orderkey") % 3 == 1, F.lit("1995-01-01"))
    return table(s, d, "orders").select("o_orderkey", md.dates_agree(day, said).alias("agrees"))


@query
def bold_question_blocks(s, d):
    c = table(s, d, "conversations")
    text = F.when(F.col("role") == "user", F.concat((F.col("turn") + 1).cast("string"), F.lit(".- "), F.col("text"))).otherwise(F.concat(F.lit("a) "), F.col("text")))
    rows = c.select(F.col("conv_id").alias("doc"), F.lit(1).alias("page"), F.col("turn").alias("line_no"), text.alias("text"), F.when(F.col("role") == "user", 1.0).otherwise(0.0).alias("bold"))
    return lines.bold_questions(rows).select("doc", "num", "printed", F.size("opts").cast("long").alias("n_opts"), "misnumbered")


KAPPA = {"es": 1.0, "fr": 0.75, "de": 0.25}


def _topic(c):
    return (c % 25 + 1).cast("int").alias("topic")


def _syllabus(s, d):
    n = F.col("n_nationkey")
    return table(s, d, "nation").select((n + 1).cast("int").alias("topic"), (n % 3 + 1).cast("double").alias("prior"), (n % 5 + 1).cast("double").alias("hours"))


def _expected(s, d):
    counts = table(s, d, "documents").groupBy(_topic(F.length("source") + F.col("n_chars"))).agg(F.count("*").alias("n"))
    return st.dirichlet_weights(counts, _syllabus(s, d).select("topic", "prior"), 65)


@query
def likelihood_weights(s, d):
    c = corpus_view(s, d)
    return c.groupBy("org").agg(F.count("*").alias("n"), F.round(F.sum(st.likelihood(F.col("year"), F.col("ccaa"), KAPPA)), 6).alias("weight"))


@query
def topic_weights_dirichlet(s, d):
    return _expected(s, d).withColumn("expected", F.round("expected", 6))


@query
def study_priorities(s, d):
    t = _expected(s, d).join(_syllabus(s, d).select("topic", "hours"), "topic")
    return st.priorities(t, 20.0).select("topic", "rank", F.round("ratio", 6).alias("ratio"), "hours_so_far", F.round("coverage", 6).alias("coverage"), "chosen")


@query
def score_by_coverage(s, d):
    t = _expected(s, d).join(_syllabus(s, d).select("topic", "hours"), "topic")
    p = st.priorities(t, 20.0)
    return p.select("rank", F.round(st.mark(F.col("coverage")), 6).alias("mark"), (F.col("coverage") >= st.least_coverage(40.0)).alias("passes"))


@query
def node_mastery(s, d):
    per = table(s, d, "events").groupBy("user_id").agg(F.count_if(F.col("value") >= 50).alias("hits"), F.count_if(F.col("value") < 50).alias("misses"))
    return per.select("user_id", "hits", "misses", F.round(st.mastery(F.col("hits"), F.col("misses")), 6).alias("mastery"))


@query
def node_selection(s, d):
    docs, labels = table(s, d, "documents"), table(s, d, "labels")
    j = docs.join(labels.select("doc_id", "quality"), "doc_id", "left")
    per = j.groupBy(F.concat_ws("-", "source", "lang").alias("node")).agg(F.count_distinct(F.col("doc_id") % 25).alias("recurrence"), F.count_if(F.col("quality") == 1).alias("hits"), F.count_if(F.col("quality") == 0).alias("misses"), F.count("*").alias("n"))
    return st.select_nodes(per.withColumn("ratio", F.lit(2.0) / (F.col("n") % 5 + 1)), 20).select("node", "recurrence", F.round("mastery", 6).alias("mastery"), "score")


@query
def holdout_validation(s, d):
    c = table(s, d, "documents").select(_topic(F.length("source") + F.col("n_chars")), (2000 + F.col("doc_id") % 25).cast("int").alias("year"))
    return st.hold_out(c, 2020, _syllabus(s, d))


@query
def common_share_filter(s, d):
    return st.mostly_specific(table(s, d, "documents"), "source", F.coalesce(F.col("lang") == "fr", F.lit(False)))


@query
def file_quarantine(s, d):
    return st.file_report(table(s, d, "lineitem"), "l_orderkey", "l_linenumber", F.col("l_quantity") > 49)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | ingest.QUERIES | topics.QUERIES | forms.QUERIES | shown.QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLE | ingest.SQL | topics.SQL | forms.SQL | shown.SQL
