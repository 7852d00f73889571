"""DuckDB SQL of the queries in catalogue.py."""

from quizloom.corpus_view import SQL as CORPUS

KEY = "trim(regexp_replace(regexp_replace(strip_accents(lower({0})), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"
FOLD = "strip_accents(lower({0}))"
#: For patterns with word bounds, which here know ASCII letters only: the one other letter of the tables becomes a word character.
FOLD_B = "replace(strip_accents(lower({0})), 'ß', '0')"
RECORDS = (
    CORPUS
    + """, recs AS (
  SELECT id, pos, CASE WHEN pos % 11 = 1 THEN ' ' ELSE q END AS q, opts, CASE WHEN pos % 11 = 2 THEN 'Z' ELSE resp END AS resp, resp_verificada,
         CASE WHEN pos % 11 = 3 THEN 1.5 ELSE conf END AS conf, CASE WHEN pos % 11 = 4 THEN 7.0 ELSE penalizacion END AS penalizacion, reserva
  FROM corpus
), checked AS (
  SELECT id, resp_verificada, list_filter([
    CASE WHEN q IS NULL OR trim(q) = '' THEN 'empty stem' END,
    CASE WHEN opts IS NULL OR len(opts) = 0 THEN 'no options' END,
    CASE WHEN resp_verificada AND NOT coalesce(resp IN ('A', 'B', 'C', 'D'), false) THEN 'verified without a valid letter' END,
    CASE WHEN NOT resp_verificada AND resp IS NOT NULL THEN 'letter without verification' END,
    CASE WHEN NOT conf BETWEEN 0 AND 1 THEN 'confidence outside 0 to 1' END,
    CASE WHEN penalizacion IS NOT NULL AND NOT penalizacion BETWEEN 0 AND 1 THEN 'penalty outside 0 to 1' END], lambda x: x IS NOT NULL) AS fails
  FROM recs
)
"""
)
STEMS = "stems AS (SELECT text AS q, source AS org, CAST(2000 + doc_id % 25 AS INTEGER) AS year, doc_id AS pos FROM documents)"
KEYED = f"keyed AS (SELECT *, {KEY.format('q')} AS k FROM stems WHERE length(q) >= 80)"
V = "resp_verificada"


def _n(c: str, kind: str = "BIGINT") -> str:
    return f"CAST({c} AS {kind})"


def _score(topic_terms: list[tuple[str, int]]) -> str:
    out = []
    for term, w in topic_terms:
        p = rf"\b{term[:-1]}" if term.endswith("~") else rf"\b{term}\b"
        options = f" WHEN regexp_matches(o, '{p}') THEN 1" if w >= 2 else ""
        out.append(f"CASE WHEN regexp_matches(s, '{p}') THEN {w}{options} ELSE 0 END")
    return " + ".join(out)


_LEX = {4: [("ent~", 2), ("que", 1)], 5: [("ein", 2), ("er~", 1)], 6: [("con", 2), ("es~", 1)], 7: [("is", 2), ("th~", 1)]}
_RULE = r"CASE WHEN regexp_matches({0}, '\b(the|les)\b.*\bof\b') THEN {1} WHEN regexp_matches({0}, '\bder\b') THEN {2} WHEN regexp_matches({0}, '\blos\b') THEN {3} END"
CLASSIFIED = (
    CORPUS
    + f""", folded AS (SELECT id, {FOLD_B.format('q')} AS s, {FOLD_B.format("array_to_string(opts, ' ')")} AS o FROM corpus
), points AS (
  SELECT id, {_RULE.format('s', "'law'", "'place'", "'person'")} AS rule, {_RULE.format('s', 1, 2, 3)} AS rule_topic,
         list_sort(list_filter([{', '.join(f"{{'neg': -({_score(t)}), 'ord': {i}, 'topic': {k}}}" for i, (k, t) in enumerate(_LEX.items()))}], lambda x: x.neg < 0)) AS sc
  FROM folded
), best AS (SELECT *, coalesce(-sc[1].neg, 0) AS p1, coalesce(-sc[2].neg, 0) AS p2 FROM points
), classified AS (
  SELECT id, CAST(CASE WHEN rule IS NOT NULL THEN rule_topic WHEN p1 >= 2 AND p1 - p2 >= 1 THEN sc[1].topic END AS INTEGER) AS topic,
         CAST(CASE WHEN rule IS NOT NULL THEN NULL WHEN p1 >= 2 THEN sc[2].topic END AS INTEGER) AS second_topic,
         CASE WHEN rule IS NOT NULL THEN 'rule:' || rule WHEN p1 = 0 THEN 'none' WHEN p1 < 2 THEN 'weak' WHEN p1 - p2 < 1 THEN 'tie' ELSE 'lexicon:' || CAST(p1 AS VARCHAR) END AS why
  FROM best
), gold AS (SELECT 'D-' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS id, CAST(doc_id % 7 + 1 AS INTEGER) AS topic, CAST(doc_id % 5 + 1 AS INTEGER) AS second FROM labels)
"""
)
GRID = "grid AS (SELECT doc_id AS num, substr('ABCD', CAST(doc_id % 4 + 1 AS INTEGER), 1) AS resp FROM labels)"
RECENCY = "power(0.5::DOUBLE, greatest(2026 - year, 0) / 8.0::DOUBLE)"
_TIDY = "{0}"
for _a, _b in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"), (" ", " ")]:
    _TIDY = f"replace({_TIDY}, '{_a}', '{_b}')"

TOPIC = "CAST((length(source) + n_chars) % 25 + 1 AS INTEGER)"
SYLLABUS = f"""
syllabus AS (SELECT CAST(n_nationkey + 1 AS INTEGER) AS topic, CAST(n_nationkey % 3 + 1 AS DOUBLE) AS prior, CAST(n_nationkey % 5 + 1 AS DOUBLE) AS hours FROM nation),
counts AS (SELECT {TOPIC} AS topic, count(*) AS n FROM documents GROUP BY 1),
prior AS (SELECT s.topic, s.hours, coalesce(c.n, 0) AS n, s.prior / sum(s.prior) OVER () * count(*) OVER () AS a FROM syllabus s LEFT JOIN counts c ON s.topic = c.topic),
expected AS (SELECT topic, hours, n, (n + a) / (sum(n) OVER () + sum(a) OVER ()) * 65 AS expected FROM prior),
ranked AS (SELECT *, expected / hours AS ratio, row_number() OVER (ORDER BY expected / hours DESC, topic) AS rank FROM expected),
priorities AS (SELECT *, sum(hours) OVER (ORDER BY rank) AS hours_so_far, sum(expected) OVER (ORDER BY rank) / sum(expected) OVER () AS coverage FROM ranked)
"""

_HINTS = {"en": ["the", "with the"], "de": ["der", "nicht"], "fr": ["les", "avec "], "es": ["los", "pero "]}


def _agrees(org: str) -> str:
    says = lambda hs: "(" + " OR ".join(f"contains(s, '{h}')" for h in hs) + ")"
    others = [h for k, hs in _HINTS.items() if k != org for h in hs if len(h) > 4]
    return f"WHEN lang = '{org}' THEN CASE WHEN {says(_HINTS[org])} THEN true WHEN {says(others)} THEN false END"


ORACLE = {
    "letter_distribution": f"WITH {CORPUS}, v AS (SELECT resp FROM corpus WHERE {V}) SELECT l.letter, count(v.resp) AS n, round(100.0 * count(v.resp) / greatest((SELECT count(*) FROM v), 1), 4) AS pct, count(v.resp) > 0.45 * (SELECT count(*) FROM v) AS suspicious FROM (VALUES ('A'), ('B'), ('C'), ('D')) l(letter) LEFT JOIN v ON v.resp = l.letter GROUP BY l.letter",
    "inventory_by_org": f"WITH {CORPUS} SELECT org, count(*) AS n, {_n(f'count(*) FILTER (NOT {V})')} AS n_unverified, count(*) FILTER (conf < 1.0) AS n_low_conf, count(*) FILTER (reserva) AS n_reserve FROM corpus GROUP BY org",
    "inventory_grouping_sets": f"WITH {CORPUS}, g AS (SELECT 'org' AS dim, org AS value FROM corpus UNION ALL SELECT 'ccaa', ccaa FROM corpus UNION ALL SELECT 'year', CAST(year AS VARCHAR) FROM corpus) SELECT dim, value, count(*) AS n FROM g GROUP BY dim, value",
    "penalty_histogram": f"WITH {CORPUS} SELECT coalesce(printf('%.2f', penalizacion), 'no consta') AS penalty, count(*) AS n FROM corpus GROUP BY 1",
    "best_letter_ev": f"WITH {CORPUS}, per AS (SELECT penalizacion, resp, count(*) AS k, min(pos) AS p FROM corpus WHERE {V} GROUP BY 1, 2), top AS (SELECT *, sum(k) OVER (PARTITION BY penalizacion) AS n, row_number() OVER (PARTITION BY penalizacion ORDER BY k DESC, p) AS r FROM per) SELECT coalesce(printf('%.2f', penalizacion), 'no consta') AS penalty, resp AS letter, {_n('n')} AS n, round(k / n, 6) AS hit_rate, round(k / n - (1 - k / n) * coalesce(penalizacion, 0.0), 6) AS ev FROM top WHERE r = 1",
    "negation_by_letter": f"WITH {CORPUS} SELECT CASE WHEN regexp_matches({FOLD_B.format('q')}, '\\b(not|no|nicht|pas|is)\\b') THEN 'negative' ELSE 'positive' END AS sign, count(*) AS n, count(*) FILTER (resp = 'A') AS n_a, count(*) FILTER (resp = 'B') AS n_b, count(*) FILTER (resp = 'C') AS n_c, count(*) FILTER (resp = 'D') AS n_d FROM corpus WHERE {V} GROUP BY 1",
    "wildcard_presence": f"WITH {CORPUS}, w AS (SELECT len(list_filter(opts, lambda o: regexp_matches({FOLD_B.format('o')}, '\\b(all|none|the|los|der)\\b'))) > 0 AS h FROM corpus) SELECT count(*) AS n, count(*) FILTER (h) AS n_with, round(count(*) FILTER (h) / greatest(count(*), 1), 6) AS rate FROM w",
    "wildcard_hit_rate": f"WITH {CORPUS}, w AS (SELECT resp, list_transform(opts, lambda o: regexp_matches({FOLD_B.format('o')}, '\\b(all|none|the|los|der)\\b')) AS x FROM corpus WHERE {V}), h AS (SELECT coalesce(x[instr('ABCD', resp)], false) AS hit FROM w WHERE list_contains(x, true)) SELECT count(*) AS n, count(*) FILTER (hit) AS hits, round(count(*) FILTER (hit) / greatest(count(*), 1), 6) AS rate FROM h",
    "length_bias_stats": f"WITH {CORPUS}, w AS (SELECT length(opts[instr('ABCD', resp)])::DOUBLE AS own, list_sum(list_transform(opts, lambda o: length(o)))::DOUBLE AS total FROM corpus WHERE {V} AND len(opts) = 4), dd AS (SELECT own - (total - own) / 3 AS d FROM w) SELECT count(d) AS n, round(avg(d), 5) AS mean, round(stddev_samp(d), 5) AS sd, round(avg(d) / (stddev_samp(d) / sqrt(count(d))), 5) AS t FROM dd",
    # A finite sum over the degrees of freedom, whose terms are counted up in a recursion.
    "length_bias_p": f"""WITH RECURSIVE {CORPUS}, w AS (SELECT length(opts[instr('ABCD', resp)])::DOUBLE AS own, list_sum(list_transform(opts, lambda o: length(o)))::DOUBLE AS total FROM corpus WHERE {V} AND len(opts) = 4
), dd AS (SELECT own - (total - own) / 3 AS d FROM w
), st AS (SELECT count(d) AS n, round(avg(d), 5) AS mean, round(stddev_samp(d), 5) AS sd, CASE WHEN count(d) >= 3 AND stddev_samp(d) > 0 THEN round(avg(d) / (stddev_samp(d) / sqrt(count(d))), 5) END AS t FROM dd
), an AS (SELECT *, n - 1 AS v, atan(abs(t) / sqrt(n - 1)) AS o FROM st
), up AS (
  SELECT 0 AS k, CASE WHEN v % 2 = 0 THEN 1.0::DOUBLE ELSE cos(o) END AS term, CASE WHEN v % 2 = 0 THEN 1.0::DOUBLE ELSE cos(o) END AS total FROM an
  UNION ALL
  SELECT k + 1, term * f, total + term * f
  FROM (SELECT k, term, total, CASE WHEN v % 2 = 0 THEN (2 * k + 1)::DOUBLE / (2 * k + 2) ELSE (2 * k + 2)::DOUBLE / (2 * k + 3) END * cos(o) * cos(o) AS f FROM up, an WHERE k < (v - 2 - v % 2) // 2)
)
SELECT n, mean, sd, t, round(1 - (SELECT CASE WHEN v = 1 THEN 2 * o / pi() WHEN v % 2 = 0 THEN sin(o) * total ELSE 2 / pi() * (o + sin(o) * total) END FROM up ORDER BY k DESC LIMIT 1), 6) AS p FROM an""",
    "bold_question_blocks": """WITH l AS (SELECT conv_id AS doc, turn, role = 'user' AS u, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS block FROM conversations WHERE text IS NOT NULL
), b AS (SELECT doc, block, max(CASE WHEN u THEN turn + 1 END) AS printed, count(*) FILTER (NOT u) AS n FROM l WHERE block > 0 GROUP BY ALL
), s AS (SELECT *, n > 0 OR row_number() OVER (PARTITION BY doc ORDER BY block) = 1 AS st FROM b
), k AS (SELECT *, sum(CASE WHEN st THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY block) AS num FROM s)
SELECT doc, CAST(num AS INTEGER) AS num, CAST(max(printed) FILTER (st) AS INTEGER) AS printed, CAST(max(n) FILTER (st) AS BIGINT) AS n_opts, max(printed) FILTER (st) <> num AS misnumbered FROM k GROUP BY doc, k.num""",
    "link_windows": r"""WITH p AS (SELECT page_id, html, string_split_regex(html, 'href="([^"]+)"') AS parts, regexp_extract_all(html, 'href="([^"]+)"', 1) AS urls FROM pages WHERE html IS NOT NULL
), m AS (
  SELECT page_id, html, urls[i] AS url, length(urls[i]) + 7 AS size, list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(urls[1:i - 1], lambda x: length(x) + 7)), 0) AS start
  FROM (SELECT *, unnest(range(1, len(urls) + 1)) AS i FROM p)
), c AS (
  SELECT url, page_id AS page, start, trim(regexp_replace(regexp_replace(substring(html, CAST(greatest(start - 400, 0) + 1 AS BIGINT), CAST(start + size + 400 - greatest(start - 400, 0) AS BIGINT)), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS ctx FROM m
)
SELECT url, ctx, page FROM c QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(ctx) DESC, page, start) = 1""",
    "recurrence_topk": f"WITH {STEMS}, {KEYED}, per AS (SELECT k, count(*) AS n, arg_min(q, pos) AS q, list_sort(list(DISTINCT org || ' ' || year)) AS s FROM keyed GROUP BY k) SELECT left(q, 92) AS q, len(s) AS n_sittings, n, array_to_string(s, ', ') AS sittings FROM (SELECT * FROM per WHERE len(s) > 1 ORDER BY len(s) DESC, q LIMIT 40)",
    "recurrence_counts": f"WITH {STEMS}, {KEYED}, per AS (SELECT k, count(*) AS n, count(DISTINCT org || ' ' || year) AS s FROM keyed GROUP BY k) SELECT count(*) FILTER (s > 1) AS recurrent, count(*) FILTER (s = 1 AND n > 1) AS same_sitting, (SELECT count(*) FROM stems WHERE length(q) < 80) AS short_discarded FROM per",
    "qa_recurrence": f"WITH {CORPUS} SELECT {KEY.format('q')} AS k, count(*) AS n, array_to_string(list_sort(list(DISTINCT regexp_replace(id, '[0-9]{{3}}$', ''))), ',') AS origins FROM corpus GROUP BY 1 HAVING count(*) > 1 ORDER BY n DESC, k LIMIT 5",
    "validate_records": f"WITH {RECORDS} SELECT id, array_to_string(fails, '; ') AS fails FROM checked",
    "quarantine_split": f"WITH {RECORDS} SELECT CASE WHEN len(fails) = 0 THEN 'clean' ELSE 'quarantine' END AS part, count(*) AS n, count(*) FILTER ({V}) AS n_verified FROM checked GROUP BY 1",
    "reason_histogram": f"WITH {RECORDS}, r AS (SELECT regexp_replace(unnest(fails), '[0-9]+', 'N', 'g') AS reason FROM checked) SELECT reason, count(*) AS n FROM r GROUP BY reason ORDER BY n DESC, reason LIMIT 6",
    "first_wins_dedupe": f"SELECT k, doc_id, source FROM (SELECT md5({KEY.format('text')}) AS k, doc_id, source, row_number() OVER (PARTITION BY md5({KEY.format('text')}) ORDER BY doc_id) AS r FROM documents) WHERE r = 1",
    "collision_anti": f"WITH d AS (SELECT doc_id, md5({KEY.format('text')}) AS k FROM documents), n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS r FROM d) SELECT doc_id, CASE WHEN r = 1 AND k NOT IN (SELECT md5({KEY.format('text')}) FROM benchmark) THEN 'new' ELSE 'collided' END AS state FROM n",
    "title_category": f"WITH p AS (SELECT page_id, trim(regexp_replace({_TIDY.format('''trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g'))''')}, '\\s+', ' ', 'g')) AS title FROM pages) SELECT page_id, title, CASE WHEN regexp_matches(lower(title), 'the|of') THEN 'english' WHEN regexp_matches(lower(title), 'der|ein') THEN 'german' WHEN regexp_matches(lower(title), 'les|que') THEN 'romance' ELSE 'other' END AS category FROM p",
    "title_entities": "SELECT entity, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, '&[a-z]+;')) AS entity FROM pages) GROUP BY entity",
    "link_context_longest": """WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href="[^"]*"[^>]*>[^<]*')) AS a FROM pages), o AS (SELECT page_id, regexp_extract(a, 'href="([^"]*)"', 1) AS url, regexp_extract(a, '>([^<]*)$', 1) AS ctx FROM a) SELECT url, ctx, page_id FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY length(ctx) DESC, page_id, ctx) AS r FROM o) WHERE r = 1""",
    "index_left_match": "WITH i AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 'Page-' ELSE 'page__' END || (doc_id - doc_id % 2) || '.html' AS slug, source AS org, doc_id AS row FROM documents), k AS (SELECT *, regexp_replace(lower(regexp_replace(slug, '\\.[^.]*$', '')), '[^a-z0-9]', '', 'g') AS key FROM i), f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY row) AS r FROM k) WHERE r = 1) SELECT p.page_id, f.slug, f.org FROM pages p LEFT JOIN f ON f.key = regexp_replace(lower(regexp_replace(regexp_extract('raw/page_' || p.page_id || '.htm', '([^/]*)$', 1), '\\.[^.]*$', '')), '[^a-z0-9]', '', 'g')",
    "answer_join": f"WITH {GRID} SELECT d.doc_id AS num, d.source, g.resp, g.resp IS NOT NULL AS resp_verificada FROM documents d LEFT JOIN grid g ON d.doc_id = g.num",
    "answer_upsert": f"WITH {GRID}, r AS (SELECT doc_id AS num, CASE WHEN doc_id % 10 = 0 THEN 'D' END AS resp FROM documents) SELECT coalesce(g.num, r.num) AS num, coalesce(r.resp, g.resp) AS resp FROM grid g FULL JOIN r ON g.num = r.num",
    "answer_gaps": "SELECT doc_id AS num FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "complete_categories": f"WITH {CORPUS}, c AS (SELECT id, concat_ws('-', org, ccaa, year) AS g, len(opts) = 4 AS four FROM corpus) SELECT id, g FROM c WHERE g IN (SELECT g FROM c GROUP BY g HAVING bool_and(four))",
    "turn_blocks": "WITH n AS (SELECT *, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS block FROM conversations) SELECT conv_id, block, min(turn) AS first, count(*) AS n, CAST(sum(length(text)) + count(*) - 1 AS BIGINT) AS chars FROM n GROUP BY conv_id, block",
    "context_carry_forward": "SELECT conv_id, turn, length(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)) AS context_chars FROM conversations",
    "gap_islands": "WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS us FROM events), j AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) > 3600000000 THEN 1 ELSE 0 END AS j FROM e), i AS (SELECT *, CAST(sum(j) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM j) SELECT user_id, island, count(*) AS n, min(us) AS first_us FROM i GROUP BY user_id, island",
    "numbering_gaps_dupes": "WITH p AS (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, min(l_linenumber) AS low, max(l_linenumber) AS high, CAST(sum(c) AS BIGINT) AS n, CAST(max(l_linenumber) - min(l_linenumber) + 1 - count(*) AS BIGINT) AS n_gaps, count(*) FILTER (c > 1) AS n_twice FROM p GROUP BY l_orderkey",
    "number_gaps": "WITH s AS (SELECT doc_id % 8 AS g, min(doc_id) AS a, max(doc_id) AS b FROM labels GROUP BY 1), e AS (SELECT g, unnest(generate_series(a, b)) AS num FROM s) SELECT g, num FROM e WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = e.num AND l.doc_id % 8 = e.g)",
    "numbering_jumps": "SELECT l_orderkey, before, l_linenumber FROM (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS before FROM lineitem) WHERE l_linenumber - before > 1",
    "rules_first_match": f"WITH f AS (SELECT doc_id, {FOLD_B.format('text')} AS s FROM documents) SELECT doc_id, {_RULE.format('s', chr(39) + 'law' + chr(39), chr(39) + 'place' + chr(39), chr(39) + 'person' + chr(39))} AS rule, {_RULE.format('s', 1, 2, 3)} AS topic FROM f",
    "lexicon_score_decision": f"WITH {CLASSIFIED} SELECT id, topic, second_topic, why FROM classified",
    "classifier_eval": f"WITH {CLASSIFIED} SELECT count(*) AS total, count(*) FILTER (c.id IS NULL) AS missing, count(*) FILTER (c.topic IS NOT NULL) AS covered, count(*) FILTER (c.topic = g.topic) AS agree, count(*) FILTER (c.topic = g.topic OR c.topic = g.second) AS agree_or_second FROM gold g LEFT JOIN classified c ON g.id = c.id",
    "confusion_topk": f"WITH {CLASSIFIED} SELECT g.topic, c.topic AS p, count(*) AS n FROM gold g JOIN classified c ON g.id = c.id WHERE c.topic <> g.topic GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 8",
    "rule_cascade": f"WITH {CORPUS}, f AS (SELECT id, {FOLD_B.format('q')} AS s, {FOLD_B.format(chr(40) + 'concat_ws(' + chr(39) + ' ' + chr(39) + ', q, array_to_string(opts, ' + chr(39) + ' ' + chr(39) + '))' + chr(41))} AS o FROM corpus) SELECT id, coalesce({_RULE.format('s', 1, 2, 3)}, {_RULE.format('o', 1, 2, 3)}) AS topic FROM f",
    "foreign_filter": f"WITH f AS (SELECT doc_id, {FOLD_B.format('text')} AS s FROM documents) SELECT doc_id FROM f WHERE regexp_matches(s, '\\b(the|les|los)\\b') AND NOT regexp_matches(s, '\\b(is|est)\\b') AND regexp_matches(s, '\\b(of|de|der)\\b')",
    "scope_evidence": f"WITH f AS (SELECT doc_id, text, {FOLD_B.format('text')} AS s FROM documents), m AS (SELECT *, regexp_extract(s, '\\b(with|avec|mit|con)\\b') AS w FROM f WHERE regexp_matches(s, '\\b(with|avec|mit|con)\\b')), a AS (SELECT *, length(regexp_extract(s, '(?s)^(.*?)\\b(with|avec|mit|con)\\b', 1)) + 1 AS pos FROM m) SELECT doc_id, substr(text, greatest(pos - 30, 1), pos + length(w) + 40 - greatest(pos - 30, 1)) AS evidence FROM a",
    "token_jaccard_pairs": f"WITH pieces AS (SELECT item_id * 2 AS item_id, text FROM benchmark UNION ALL SELECT item_id * 2 + 1, left(text, CAST(floor(length(text) * 2 / 3) AS INTEGER)) FROM benchmark), t AS (SELECT item_id, list_distinct(list_filter(string_split_regex(trim(regexp_replace({FOLD.format('text')}, '[^a-z0-9ñ ]', ' ', 'g')), ' +'), lambda x: length(x) > 2 AND x NOT IN ('the', 'and', 'for', 'los', 'las', 'der', 'die', 'das', 'les', 'des', 'que', 'con'))) AS t FROM pieces), p AS (SELECT a.item_id AS a, b.item_id AS b, len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t) - len(list_intersect(a.t, b.t))) AS j FROM t a JOIN t b ON a.item_id < b.item_id) SELECT a, b, round(j, 6) AS jaccard FROM p WHERE j >= 0.5",
    "cosine_pairs": "WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), p AS (SELECT a.vec_id AS a, b.vec_id AS b, 1.0 - list_dot_product(a.v, b.v) AS d FROM e a JOIN e b ON a.vec_id < b.vec_id) SELECT a, b, round(d, 4) AS distance FROM p WHERE d < 0.65",
    "threshold_sweep": "WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), p AS (SELECT 1.0 - list_dot_product(a.v, b.v) AS d FROM e a JOIN e b ON a.vec_id < b.vec_id) SELECT t.threshold, count(*) FILTER (d < t.threshold) AS n_pairs FROM p, (VALUES (0.5::DOUBLE), (0.55::DOUBLE), (0.6::DOUBLE), (0.65::DOUBLE), (0.7::DOUBLE)) t(threshold) WHERE d < 0.7 GROUP BY 1",
    "recency_weight": f"WITH {CORPUS} SELECT org, count(*) AS n, round(sum({RECENCY}), 6) AS weight, round(sum({RECENCY}) / count(*), 3) AS mean_weight FROM corpus GROUP BY org",
    "topic_weights_laplace": "WITH c AS (SELECT CAST(doc_id % 20 + 1 AS INTEGER) AS topic, count(*) AS n FROM labels GROUP BY 1), j AS (SELECT CAST(n_nationkey + 1 AS INTEGER) AS topic, coalesce(c.n, 0) AS n FROM nation LEFT JOIN c ON c.topic = n_nationkey + 1), e AS (SELECT topic, n, round((n + 0.5::DOUBLE) / (sum(n) OVER () + 0.5::DOUBLE * count(*) OVER ()) * 65, 6) AS expected FROM j) SELECT topic, n, expected, row_number() OVER (ORDER BY expected DESC, topic) AS rank FROM e",
    "family_summary": f"WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS id, md5({KEY.format('text')}) AS family, lang, source, CAST(2000 + doc_id % 25 AS INTEGER) AS year, doc_id FROM documents), t AS (SELECT family, lang, count(*) AS k, min(doc_id) AS p FROM d GROUP BY 1, 2), m AS (SELECT family, lang FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY k DESC, p) AS r FROM t) WHERE r = 1) SELECT d.family, count(*) AS n, any_value(m.lang) AS majority, count(DISTINCT d.lang) AS n_topics, array_to_string(list_sort(list(DISTINCT source)), ',') AS orgs, count(DISTINCT source || ' ' || year) AS n_sittings, round(sum({RECENCY}), 6) AS weight, array_to_string(list_sort(list(id)), ',') AS members FROM d JOIN m ON d.family = m.family GROUP BY d.family HAVING count(*) > 1",
    "migrate_defaults": f"WITH {CORPUS} SELECT id, resp, resp IN ('A', 'B', 'C', 'D') AS resp_verificada, coalesce(CASE WHEN pos % 4 = 0 THEN conf END, 1.0::DOUBLE) AS conf, 'html' AS origen, false AS revisar, 0.0::DOUBLE AS penalizacion, false AS reserva, true AS changed FROM corpus",
    "compact_payload": f"WITH {CORPUS} SELECT id, q, left(opts[1], 700) AS ctx, len(opts) AS n_opts, CAST(instr('ABCD', resp) - 1 AS BIGINT) AS r, nullif(ccaa, '') AS c FROM corpus WHERE resp IN ('A', 'B', 'C', 'D')",
    "payload_json": f"WITH {CORPUS} SELECT replace(CAST(to_json({{'id': id, 'q': q, 'opts': opts, 'resp': resp}}) AS VARCHAR), '</', '<\\/') AS json FROM corpus WHERE resp IN ('A', 'B', 'C', 'D')",
    "hash_sample": "SELECT doc_id FROM documents ORDER BY md5('1-' || doc_id), doc_id LIMIT 20",
    "union_parts": "SELECT 'documents' AS part, count(*) AS n, CAST(0 AS BIGINT) AS n_extra FROM documents UNION ALL SELECT 'benchmark', count(*), count(text) FROM benchmark",
    "set_difference": "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels",
    "set_intersection": "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels",
    "normalised_keys": f"SELECT doc_id, md5({KEY.format('text')}) AS spaced, md5(trim(regexp_replace(regexp_replace({FOLD.format('text')}, '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g'))) AS removed, md5({FOLD.format('text')}) AS folded FROM documents",
    "scalar_functions": "SELECT c_custkey, CASE WHEN c_custkey < 1000 THEN CAST(c_custkey AS INTEGER) END AS num, CASE WHEN c_custkey < 1000 THEN regexp_replace(c_custkey || '.- Stem of ' || c_name, '^\\s*\\d{1,3}\\s*[.)-]\\s*', '') ELSE c_custkey || '.- Stem of ' || c_name END AS rest, CASE WHEN c_custkey % 8 <= 5 THEN substr('ABCDEF', CAST(c_custkey % 8 + 1 AS INTEGER), 1) END AS letter, regexp_replace(c_name, '[0-9]+', 'N', 'g') AS masked, c_name AS option, CASE WHEN c_custkey % 3 = 0 THEN '2015' ELSE 's/f' END AS year, printf('X-%02d-%03d', c_custkey % 90, c_custkey % 900) AS id FROM customer",
    "grid_scan": "WITH t AS (SELECT o_custkey, string_agg(o_orderkey || ' ' || CASE WHEN o_orderkey % 5 = 4 THEN 'anulada' ELSE substr('abcd', CAST(o_orderkey % 5 + 1 AS INTEGER), 1) END, ' ' ORDER BY o_orderkey) AS text FROM orders GROUP BY 1), p AS (SELECT o_custkey, unnest(regexp_extract_all(text, '[0-9]+ [a-z]+')) AS p FROM t), s AS (SELECT o_custkey, string_split(p, ' ') AS s FROM p) SELECT o_custkey, CAST(s[1] AS INTEGER) AS num, CASE WHEN upper(s[2]) <> 'ANULADA' THEN upper(s[2]) END AS resp FROM s",
    "html_questions": "SELECT url AS file, CAST(CASE WHEN page_id + 1 <= 999 THEN page_id + 1 WHEN page_id <= 999 THEN page_id ELSE 1 END AS INTEGER) AS num, CASE WHEN page_id + 1 <= 999 THEN url ELSE CAST(page_id + 1 AS VARCHAR) || '. ' || url END AS q, CAST(4 AS BIGINT) AS n_opts, CAST(1 AS INTEGER) AS right_index, CAST(CASE WHEN page_id > 999 THEN 1 ELSE 0 END AS BIGINT) AS n_fails, CAST(CASE WHEN page_id BETWEEN 1 AND 998 THEN 1 ELSE 0 END AS BIGINT) AS n_warnings FROM pages",
    "daily_event_counts": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2",
    "likelihood_weights": f"WITH {CORPUS} SELECT org, count(*) AS n, round(sum(exp(-0.1::DOUBLE * greatest(2026 - year, 0)) * CASE ccaa WHEN 'es' THEN 1.0::DOUBLE WHEN 'fr' THEN 0.75::DOUBLE WHEN 'de' THEN 0.25::DOUBLE ELSE 0.5::DOUBLE END), 6) AS weight FROM corpus GROUP BY org",
    "topic_weights_dirichlet": f"WITH {SYLLABUS} SELECT topic, n, round(expected, 6) AS expected FROM expected",
    "study_priorities": f"WITH {SYLLABUS} SELECT topic, rank, round(ratio, 6) AS ratio, hours_so_far, round(coverage, 6) AS coverage, hours_so_far <= 20 AS chosen FROM priorities",
    "score_by_coverage": f"WITH {SYLLABUS} SELECT rank, round(80.0::DOUBLE * (coverage * 0.85::DOUBLE + (1 - coverage) * 0.25::DOUBLE), 6) AS mark, coverage >= (40 / 80.0::DOUBLE - 0.25::DOUBLE) / (0.85::DOUBLE - 0.25::DOUBLE) AS passes FROM priorities",
    "node_mastery": "SELECT user_id, count(*) FILTER (value >= 50) AS hits, count(*) FILTER (value < 50) AS misses, round((1.0::DOUBLE + count(*) FILTER (value >= 50)) / (2 + count(*) FILTER (value >= 50) + count(*) FILTER (value < 50)), 6) AS mastery FROM events GROUP BY user_id",
    "node_selection": "WITH p AS (SELECT concat_ws('-', source, lang) AS node, count(DISTINCT d.doc_id % 25) AS recurrence, count(*) FILTER (quality = 1) AS h, count(*) FILTER (quality = 0) AS m, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1), q AS (SELECT node, recurrence, (1.0::DOUBLE + h) / (2 + h + m) AS mastery, 2.0::DOUBLE / (n % 5 + 1) AS ratio FROM p) SELECT node, recurrence, round(mastery, 6) AS mastery, round(recurrence * (1 - mastery) * ratio, 6) AS score FROM q ORDER BY score DESC, node LIMIT 20",
    "holdout_validation": f"WITH {SYLLABUS}, y AS (SELECT {TOPIC} AS topic, 2000 + doc_id % 25 AS year FROM documents), per AS (SELECT topic, count(*) FILTER (year <= 2020) AS fit, count(*) FILTER (year = 2021) AS met FROM y GROUP BY topic), j AS (SELECT coalesce(fit, 0) AS fit, coalesce(met, 0) AS met FROM syllabus s LEFT JOIN per ON s.topic = per.topic), k AS (SELECT fit, met, (fit + 0.5::DOUBLE) / (sum(fit) OVER () + 0.5::DOUBLE * count(*) OVER ()) * sum(met) OVER () AS predicted, sum(met) OVER () / count(*) OVER () AS uniform FROM j), o AS (SELECT CAST(sum(fit) AS BIGINT) AS n_fit, CAST(sum(met) AS BIGINT) AS n_test, round(sum(abs(predicted - met)), 6) AS error, round(sum(abs(uniform - met)), 6) AS error_uniform FROM k) SELECT *, error < error_uniform AS beats FROM o",
    "common_share_filter": "SELECT source, count(*) AS n, round(count(*) FILTER (lang = 'fr') / count(*), 6) AS common_share, count(*) FILTER (lang = 'fr') / count(*) <= 0.25 AS kept FROM documents GROUP BY source",
    "file_quarantine": "WITH p AS (SELECT l_orderkey, CAST(max(l_linenumber) AS BIGINT) AS expected, count(DISTINCT l_linenumber) AS extracted, count(*) FILTER (l_quantity > 49) AS n_fails FROM lineitem GROUP BY 1) SELECT *, CASE WHEN expected = extracted AND n_fails = 0 THEN 'clean' ELSE 'quarantine' END AS state FROM p",
    "org_title_match": f"SELECT doc_id, CASE {' '.join(map(_agrees, _HINTS))} END AS agrees FROM (SELECT doc_id, lang, {FOLD.format('text')} AS s FROM documents)",
    "date_agreement": "WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS a, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN '1995-01-01' END AS b FROM orders) SELECT o_orderkey, b IS NULL OR a = b OR contains(b, left(a, 4)) OR contains(a, left(b, 4)) AS agrees FROM o",
}
