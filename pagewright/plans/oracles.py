"""The driver's queries in SQL, for another engine to run on the same tables."""

from __future__ import annotations

BLOCKS = """b AS (SELECT book_id, CAST(k // 5 + 1 AS INT) AS page_num, CAST(k AS INT) AS block_idx, 72.0 + 12 * (k % 5) AS y0, lines[k + 1] AS text
 FROM (SELECT book_id, lines, unnest(range(len(lines))) AS k FROM (SELECT CAST(doc_id AS VARCHAR) AS book_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)))"""
STRIPPED = BLOCKS + """, t AS (SELECT book_id, page_num, block_idx, y0, s AS text FROM (SELECT *, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS s FROM b) WHERE s <> '')"""
WORDS = "list_filter(regexp_split_to_array(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'), '\\s+'), lambda x: x <> '')"
NORMAL = "trim(replace(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9\\\\-]+', ' ', 'g'), '-', ' '))"
KEY = "substr(md5(regexp_replace(lower(regexp_replace(regexp_replace({0}, '(?i)\\b(eq|equation)\\.?\\s*\\d+(\\.\\d+)*[a-z]?\\b', '', 'g'), '(?i)\\(\\s*\\d+(\\.\\d+)*[a-z]?\\s*\\)', '', 'g')), '\\s+', '', 'g')), 1, 16)"
TOKENS = "list_filter(" + WORDS.format("regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9\\\\]', ' ', 'g')") + ", lambda x: length(x) >= 3 AND x NOT IN ('the','and','for','with','from','this','that','are','was','were'))"
USAGE = "CASE WHEN regexp_matches({0}, 'where|let|define|denote|is defined') THEN 'definition' WHEN regexp_matches({0}, '(use|using|from|see|according to)\\s+(eq|equation)') THEN 'reference' ELSE 'application' END"
CONCEPTS = "c AS (SELECT * FROM (SELECT item_id, CAST(item_id AS VARCHAR) AS concept_id, array_to_string(list_slice(" + WORDS.format(NORMAL.format("text")) + ", 1, 3), ' ') AS name, text AS description, CAST(item_id % 9 + 1 AS INT) AS page FROM benchmark) WHERE name <> '')"
RATIO = "len(list_filter(w, lambda x: regexp_matches(x, '=|∑|√|∫|σ|π|θ|λ|\\+|−|×|÷|\\^|\\*\\*|/|\\\\'))) / greatest(len(w), 1)"

PLAIN = "regexp_replace(lower(regexp_replace(regexp_replace({0}, '(?i)\\b(eq|equation)\\.?\\s*\\d+(\\.\\d+)*[a-z]?\\b', '', 'g'), '(?i)\\(\\s*\\d+(\\.\\d+)*[a-z]?\\s*\\)', '', 'g')), '\\s+', '', 'g')"
ONE = "[a-zA-Zα-ωΑ-Ω∫√][_a-zA-Z0-9]*"
TRIM = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
#: Texts made of rows, as the queries make them.
PHRASED = """p AS (SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN p_name || ' = r (' || n || ')' WHEN 1 THEN 'Eq. ' || n WHEN 2 THEN 'Eq. (' || n || ')' WHEN 3 THEN 'Equation ' || n || ' holds' WHEN 4 THEN p_name WHEN 5 THEN '(' || n || ')' WHEN 6 THEN 'y_' || p_partkey % 10 || ' = a + b - c' ELSE 'r_f / x' END AS t FROM (SELECT *, p_size || '.' || p_partkey % 10 AS n FROM part))"""
TRANSCRIPTS = "x AS (SELECT conv_id, 'intro' || chr(10) || string_agg((turn + 1) || '. ' || coalesce(text, ''), chr(10) ORDER BY turn, text) AS t FROM conversations GROUP BY conv_id)"
NUMBERED = """t AS (SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN (conv_id % 9 + 1) || '.' || (turn + 1) WHEN 1 THEN CAST(conv_id % 9 + 1 AS VARCHAR) WHEN 2 THEN 'Unknown' END AS chapter, CASE turn % 4 WHEN 0 THEN 'Q' || conv_id % 30 || '(a)' WHEN 1 THEN conv_id % 30 || '.' || turn WHEN 2 THEN 'a)' ELSE conv_id % 30 || ' b' END AS number,
CASE turn % 5 WHEN 0 THEN '-PS' WHEN 1 THEN '-CFA' WHEN 2 THEN '-CC' WHEN 3 THEN '-OT' ELSE '' END AS suffix, CASE turn % 3 WHEN 0 THEN 'Solution to Question ' || conv_id % 30 || ': ' || coalesce(text, '') WHEN 1 THEN 'answer to ' || conv_id % 30 || ' (b) ' || coalesce(text, '') ELSE conv_id % 30 || ') ' || coalesce(text, '') END AS text FROM conversations)"""
CUED = "coalesce(" + ", ".join(f"CASE WHEN regexp_matches({{0}}, '{f}') THEN regexp_extract({{0}}, '{f}', 1) || regexp_extract({{0}}, '{f}', 2) END" for f in [f"(?i){c}(\\d+)\\s*\\(?([a-z])?\\)?" for c in ("solution\\s+to\\s+(?:question\\s+)?(?:Q\\s*)?", "answer\\s+to\\s+(?:question\\s+)?(?:Q\\s*)?", "for\\s+question\\s+(?:Q\\s*)?")] + ["(?i)question\\s+(?:Q\\s*)?(\\d+)\\s*\\(?([a-z])?\\)?\\s*:"]) + ")"
GRAPH = """s AS (SELECT p_brand AS book_id, 's' || p_partkey AS id, p_partkey AS k, CASE p_size % 6 WHEN 0 THEN 'formula' WHEN 1 THEN 'worked_example' WHEN 2 THEN 'question' WHEN 3 THEN 'solution' WHEN 4 THEN 'derivation' ELSE 'calculation' END AS kind, p_size AS page, p_partkey % 2 = 0 AS defines, lag('s' || p_partkey) OVER w AS before, lead('s' || p_partkey) OVER w AS behind, p_name AS text, nullif(left(trim(regexp_replace(p_name, '\\s+', ' ', 'g')), 200), '') AS short FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey))"""
SOLVED = """q AS (SELECT CAST(conv_id % 20 AS VARCHAR) AS book_id, 'q' || conv_id || '-' || turn AS qid, (conv_id % 3 + 1) || '.' || (turn % 3 + 1) AS qc, coalesce(text, '') AS qt, CAST(turn AS VARCHAR) AS number, conv_id % 3 AS kind, ['f' || turn % 3, 'f' || conv_id % 4] AS qf, conv_id * 100 + turn AS o FROM conversations WHERE role = 'user'),
a AS (SELECT CAST(conv_id % 20 AS VARCHAR) AS book_id, 'a' || conv_id || '-' || turn AS aid, (conv_id % 3 + 1) || '.' || (turn % 2 + 1) AS ac, conv_id % 3 = 2 AS is_check, ['f' || turn % 3] AS af, CASE WHEN conv_id % 2 = 0 THEN 'Solution to Question ' || (turn - 1) || ': ' ELSE (turn - 1) || '. ' END || coalesce(text, '') AS av FROM conversations WHERE role = 'assistant'),
b AS (SELECT *, """ + CUED.format("av") + """ AS cued, nullif(regexp_extract(av, '^\\s*(\\d+)\\s*[.:)]', 1), '') AS lead, list_distinct(""" + WORDS.format("lower(av)") + """) AS aw, list_distinct(list_slice(""" + WORDS.format("lower(av)") + """, 1, 20)) AS a20 FROM a),
r AS (SELECT *, list_distinct(""" + WORDS.format("lower(qt)") + """) AS qw, list_distinct(list_slice(""" + WORDS.format("lower(qt)") + """, 1, 20)) AS q20 FROM q),
m AS (SELECT r.*, b.*, qc = ac AS same, coalesce(kind = 2 AND lead IS NOT NULL AND (number = lead OR ends_with(number, '.' || lead)), false) AS led, coalesce('Ch' || split_part(qc, '.', 1) || '-S' || number = 'Ch' || split_part(ac, '.', 1) || '-S' || cued, false) AS keyed, len(list_intersect(list_distinct(qf), list_distinct(af))) AS shared,
 CASE WHEN len(qw) > 0 AND len(aw) > 0 THEN len(list_intersect(qw, aw)) / len(list_distinct(list_concat(qw, aw))) ELSE 0 END > 0.3 AS alike, CASE WHEN len(q20) > 0 AND len(a20) > 0 THEN len(list_intersect(q20, a20)) / len(list_distinct(list_concat(q20, a20))) ELSE 0 END AS heads FROM r JOIN b USING (book_id) WHERE split_part(qc, '.', 1) = split_part(ac, '.', 1)),
n AS (SELECT *, CASE WHEN led THEN 0.7 ELSE 0 END + CASE WHEN led AND is_check THEN 0.2 ELSE 0 END + CASE WHEN keyed THEN 0.7 ELSE 0 END + CASE WHEN same THEN 0.1 ELSE 0 END + least(0.3, shared * 0.1) + CASE WHEN alike THEN 0.1 ELSE 0 END AS base FROM m),
o AS (SELECT *, round(least(1.0, CAST(base AS DOUBLE) + CASE WHEN base < 0.5 AND heads > 0.6 THEN heads * 0.2 ELSE 0 END), 9) AS score, CASE WHEN led OR keyed THEN 'exact_question_number' WHEN same THEN 'taxonomy_path' WHEN shared > 0 THEN 'equation_anchor' WHEN alike THEN 'variable_overlap' ELSE 'text_similarity' END AS method FROM n),
l AS (SELECT aid AS solution_id, qid AS question_id, score, method FROM (SELECT *, row_number() OVER (PARTITION BY book_id, aid ORDER BY score DESC, o.o) AS k FROM o WHERE score >= 0.75) WHERE k = 1)"""
SHAPED = """p AS (SELECT p_partkey, CASE p_size % 10 WHEN 0 THEN 'Solution to 5: ' || p_name WHEN 1 THEN 'Answer: ' || p_name WHEN 2 THEN p_size || '. thus x = ' || p_size WHEN 3 THEN 'Given r = ' || p_size || ' find the result' WHEN 4 THEN 'x = ' || p_size || chr(10) || 'y = 2 + 3' WHEN 5 THEN 'Concept Check 9.' || p_size || ' what?' WHEN 6 THEN 'Example 2: Given: r = 0.05, T_' || p_size || ' = 10 find PV and compute NPV' WHEN 7 THEN 'Proof: ' || p_name WHEN 8 THEN 'Step 1: ' || p_name || chr(10) || 'step 2. add ' || p_size || chr(10) || '3) end' ELSE '5 solution ' || p_name || ' = 1' END AS t, CASE p_partkey % 3 WHEN 0 THEN 'concept_check_solutions' WHEN 1 THEN 'concept_check' END AS section FROM part)"""
RICH = CONCEPTS + """, k AS (SELECT *, """ + WORDS.format(NORMAL.format("description")) + """ AS w FROM c), d AS (SELECT concept_id, item_id, name, description, page, trim(replace(regexp_replace(lower(description), '[^a-z0-9\\\\-]+', ' ', 'g'), '-', ' ')) AS about, array_to_string(list_slice(w, 4, 5), ' ') AS alias, coalesce(w[6], '') AS tag FROM k)"""
TURNS = """t AS (SELECT conv_id || '-' || turn AS segment_id, CAST(turn + 1 AS INT) AS page_num, lower(coalesce(text, '')) AS body, array_to_string(list_slice(""" + WORDS.format("lower(coalesce(text, ''))") + """, 1, 5), ' ') AS title FROM conversations), u AS (SELECT *, """ + NORMAL.format("body") + """ AS nb, """ + NORMAL.format("title") + """ AS nt FROM t)"""
#: Pairs of turns and concepts, hit by hit, then gate by gate.
GATES = """h AS (SELECT u.*, d.*, contains(' ' || nt || ' ', ' ' || name || ' ') AS tn, alias <> '' AND contains(' ' || nt || ' ', ' ' || alias || ' ') AS ta, contains(' ' || nb || ' ', ' ' || name || ' ') AS bn, alias <> '' AND contains(' ' || nb || ' ', ' ' || alias || ' ') AS ba, length(name) >= 4 AND contains(nb, name) AS pn, length(alias) >= 4 AND contains(nb, alias) AS pa, tag <> '' AND (contains(body, tag) OR contains(title, tag)) AS tg, about <> '' AND contains(nb, about) AS ab, abs(page - page_num) AS far FROM u, d),
g1 AS (SELECT *, CASE WHEN tn THEN 0.6 WHEN ta THEN 0.5 ELSE 0 END + CASE WHEN bn THEN 0.35 ELSE 0 END AS s1 FROM h), g2 AS (SELECT *, s1 < 0.5 AND ba AS second, s1 + CASE WHEN s1 < 0.5 AND ba THEN 0.3 ELSE 0 END AS s2 FROM g1), g3 AS (SELECT *, s2 + CASE WHEN s2 < 0.4 AND pn THEN 0.15 ELSE 0 END AS s3 FROM g2), g4 AS (SELECT *, s3 + CASE WHEN s3 < 0.4 AND pa THEN 0.12 ELSE 0 END AS s4 FROM g3),
g AS (SELECT segment_id, concept_id, item_id, CASE WHEN far > 6 THEN 0 ELSE s4 + CASE WHEN tg THEN 0.05 ELSE 0 END + CASE WHEN ab THEN 0.1 ELSE 0 END + CASE WHEN far = 0 THEN 0.4 WHEN far <= 1 THEN 0.25 WHEN far <= 3 THEN 0.1 ELSE 0 END END AS score, CASE WHEN tn THEN 'exact_match' WHEN ta THEN 'alias' WHEN bn THEN 'exact_match' WHEN second THEN 'alias' ELSE 'heuristic' END AS method FROM g4)"""

ORACLES: dict[str, str] = {
    "block_scan": f"WITH {BLOCKS} SELECT book_id, page_num, block_idx, text FROM b",
    "page_range_scan": f"WITH {BLOCKS} SELECT book_id, count(*) AS n_blocks, min(page_num) AS first_page, max(page_num) AS last_page FROM b WHERE page_num BETWEEN 2 AND 3 GROUP BY book_id",
    "furniture_frequency": f"WITH {BLOCKS}, n AS (SELECT book_id, page_num, lower(regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')) AS norm, len({WORDS.format('text')}) AS w FROM b) SELECT book_id, norm, count(DISTINCT page_num) AS n_pages FROM n WHERE norm <> '' AND w <= 8 GROUP BY ALL HAVING count(DISTINCT page_num) >= 2",
    "furniture_filter": f"""WITH {BLOCKS}, n AS (SELECT *, lower(regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')) AS norm, len({WORDS.format('text')}) AS w FROM b),
f AS (SELECT book_id, norm, count(DISTINCT page_num) AS p FROM n WHERE norm <> '' AND w <= 8 GROUP BY ALL), pages AS (SELECT book_id, count(DISTINCT page_num) AS np FROM b GROUP BY ALL),
m AS (SELECT n.*, coalesce(f.p / pages.np > 0.2, false) AS repeated, (y0 < 84.2 OR y0 + 12 > 757.8) AS edge FROM n JOIN pages USING (book_id) LEFT JOIN f USING (book_id, norm))
SELECT book_id, count(*) AS n_kept, CAST(sum(length(text)) AS BIGINT) AS kept_chars FROM m WHERE NOT (norm <> '' AND (regexp_matches(norm, '^(\\(?\\s*concluded\\s*\\)?\\s*$|\\(?\\s*continued\\s*\\)?\\s*$|\\(?\\s*cont''?d?\\s*\\)?\\s*$|\\(?\\s*continuation\\s*\\)?\\s*$|continued\\s+(on|from)\\s+(next|previous)?\\s*page|see\\s+(next|previous)\\s+page|to\\s+be\\s+continued|(table|figure|exhibit)\\s+[\\d.]+\\s*\\(?\\s*(continued|cont''?d?)\\s*\\)?|(page\\s+)?\\d+\\s*$|\\d+\\s*/\\s*\\d+\\s*$|[-–—]\\s*\\d+\\s*[-–—]\\s*$)') OR (edge AND (repeated OR (length(norm) < 4 AND regexp_full_match(norm, '\\d+')))))) GROUP BY book_id""",
    "furniture_sample": f"WITH {BLOCKS}, p AS (SELECT DISTINCT book_id, page_num FROM b), q AS (SELECT *, count(*) OVER (PARTITION BY book_id) AS n FROM p) SELECT book_id, count(*) AS n_sampled FROM q WHERE page_num - 1 < 25 OR page_num - 1 >= n - 25 OR (n > 50 AND page_num - 1 BETWEEN n // 2 - 12 AND n // 2 + 12) GROUP BY book_id",
    "math_token_ratio": f"WITH {STRIPPED}, x AS (SELECT *, {WORDS.format('text')} AS w FROM t), r AS (SELECT book_id, block_idx, round({RATIO}, 6) AS ratio, len(w) >= 8 AND {RATIO} < 0.2 AS is_prose FROM x) SELECT * FROM r WHERE ratio > 0 OR is_prose",
    "canonical_key": f"WITH {STRIPPED} SELECT book_id, block_idx, {KEY.format('text')} AS canonical_key FROM t",
    "duplicate_of": f"WITH {STRIPPED}, k AS (SELECT *, {KEY.format('text')} AS k FROM t), f AS (SELECT book_id, block_idx, first_value(block_idx) OVER (PARTITION BY book_id, k ORDER BY page_num, y0, block_idx) AS canonical_block FROM k) SELECT * FROM f WHERE block_idx <> canonical_block",
    "usage_classify": f"WITH {BLOCKS}, n AS (SELECT book_id, block_idx, lower(right(coalesce(lag(text) OVER w, ''), 200) || ' ' || left(coalesce(lead(text) OVER w, ''), 200)) AS c FROM b WINDOW w AS (PARTITION BY book_id, page_num ORDER BY block_idx)) SELECT book_id, block_idx, {USAGE.format('c')} AS usage_type FROM n",
    "question_type": """SELECT conv_id, turn, CASE WHEN regexp_matches(t, 'calculate|compute|determine|find|estimate|value|what is the') THEN 'Calculation' WHEN regexp_matches(t, 'case|scenario|situation') THEN 'Case' WHEN regexp_matches(t, 'explain|discuss|analyze|evaluate|compare and contrast') THEN CASE WHEN length(t) > 200 THEN 'Essay' ELSE 'Short Answer' END ELSE 'Mixed' END AS question_type,
regexp_matches(t, '\\?|what\\s+(is|are|would|should)|calculate|compute|determine|find|estimate|explain|discuss|analyze|evaluate|are\\s+the\\s+following\\s+(true|false)|if\\s+.*\\s+what|given\\s+.*\\s+(what|find|calculate)') AS likely FROM (SELECT *, lower(text) AS t FROM conversations WHERE role = 'user')""",
    "section_kinds": f"""WITH {STRIPPED} SELECT book_id, block_idx, CASE WHEN regexp_matches(l, '^problem\\s+sets?') THEN 'problem_set' WHEN regexp_matches(l, '^cfa\\s*(®|problems?)') OR (contains(l, 'cfa') AND contains(l, 'problem')) OR l = 'cfa' THEN 'cfa' WHEN regexp_matches(l, '^solutions?\\s+to\\s+concept\\s+checks?$') THEN 'concept_check_solutions' WHEN regexp_matches(l, '^concept\\s+check$') THEN 'concept_check' WHEN l = 'summary' THEN 'summary' WHEN regexp_matches(l, '^key\\s+terms?$') THEN 'key_terms' WHEN regexp_matches(l, '^key\\s+equations?$') THEN 'key_equations' END AS section,
regexp_matches(left(l, 50), 'proof|derivation|we can show|substituting') AS derivation,
starts_with(l, 'example') OR contains(left(l, 50), 'worked example') OR (contains(left(l, 100), 'given') AND regexp_matches(l, '\\d') AND regexp_matches(l, 'answer|solution|therefore|thus|find|calculate')) AS example,
(len({WORDS.format('text')}) > 20 AND length(regexp_replace(text, '[^=∑√∫σπθλ+−×÷^]', '', 'g')) / length(text) < 0.05) OR (regexp_matches(l, 'risk-averse|mean-variance|investors measure|the risk|the return|the portfolio|we can|it is|this is|that is') AND NOT contains(text, '=') AND NOT regexp_matches(text, '[A-Za-z]\\d|\\d[A-Za-z]')) AS prose FROM (SELECT *, lower(text) AS l FROM t)""",
    "adjacency_edges": f"WITH {STRIPPED}, n AS (SELECT book_id, md5(book_id || '|' || block_idx) AS source_id, md5(book_id || '|' || lead(block_idx) OVER (PARTITION BY book_id ORDER BY block_idx)) AS target_id FROM t) SELECT * FROM n WHERE target_id IS NOT NULL",
    "section_forward_fill": f"WITH {STRIPPED} SELECT book_id, block_idx, last_value(CASE WHEN (regexp_matches(text, '\\p{{Lu}}') AND NOT regexp_matches(text, '\\p{{Ll}}')) OR length(text) < 12 THEN text END IGNORE NULLS) OVER (PARTITION BY book_id ORDER BY block_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading FROM t",
    "variable_candidates": """WITH s AS (SELECT item_id, regexp_extract_all(text, '[A-Za-zα-ωΑ-Ω][A-Za-z0-9_()]*') AS a FROM benchmark), u AS (SELECT item_id, unnest(a) AS symbol, unnest(range(len(a))) AS k FROM s), d AS (SELECT item_id, symbol, min(k) AS k FROM u WHERE length(symbol) <= 15 AND lower(symbol) NOT IN ('the','and','or','is','are','this','that','what','which','where','when','was','were','has','have','been','will','would','should','could','may','might','can','must','shall','for','with','from','to','of','in','on','at','by','if','then','else','let','denote','define','here','log','ln','exp','max','min','sin','cos','tan','sqrt','abs','sum','prod','mean','var','cov') GROUP BY ALL), r AS (SELECT item_id, symbol, row_number() OVER (PARTITION BY item_id ORDER BY k) - 1 AS nth FROM d) SELECT item_id, CAST(nth AS INT) AS nth, symbol FROM r WHERE nth < 20""",
    "best_definition": "WITH v AS (SELECT lower(trim(p_brand)) AS symbol, p_name AS meaning, CASE p_size % 3 WHEN 0 THEN 'heuristic' WHEN 1 THEN 'llm' ELSE 'context' END AS source, p_size % 3 AS r, p_partkey AS seq FROM part), k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY r DESC, length(meaning) DESC, seq) AS n FROM v) SELECT symbol, meaning, source FROM k WHERE n = 1",
    "ngrams": f"""WITH w AS (SELECT item_id, list_filter({WORDS.format(NORMAL.format('text'))}, lambda x: length(x) >= 3 AND x NOT IN ('the','and','for','with','from','this','that','are','was','were','into','over','under','about','between','among','through','using')) AS w FROM benchmark), g AS (SELECT item_id, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, (VALUES (2), (3), (4)) v(n) WHERE len(w) >= n)) SELECT item_id, count(*) AS n, min(phrase) AS least, max(phrase) AS greatest FROM g GROUP BY item_id""",
    "tfidf_weights": f"WITH {CONCEPTS}, k AS (SELECT concept_id, {TOKENS.format('description')} AS w FROM c), u AS (SELECT concept_id, len(w) AS total, unnest(w) AS term FROM k), f AS (SELECT concept_id, term, total, count(*) AS tf FROM u GROUP BY ALL), d AS (SELECT term, count(*) AS df FROM f GROUP BY ALL) SELECT concept_id, term, round(tf / total * (1 + (SELECT count(*) FROM c) / (df + 1)), 6) AS weight FROM f JOIN d USING (term)",
    "tfidf_cosine_top5": f"""WITH {CONCEPTS}, k AS (SELECT concept_id, {TOKENS.format("name || ' ' || '' || ' ' || '' || ' ' || description")} AS w FROM c), u AS (SELECT concept_id, len(w) AS total, unnest(w) AS term FROM k), f AS (SELECT concept_id, term, total, count(*) AS tf FROM u GROUP BY ALL), d AS (SELECT term, count(*) AS df FROM f GROUP BY ALL), n AS (SELECT count(*) AS n FROM c),
cw AS (SELECT concept_id, term, tf / total * (1 + n / (df + 1)) AS weight FROM f JOIN d USING (term), n), q AS (SELECT doc_id, {TOKENS.format('text')} AS w FROM documents), qu AS (SELECT doc_id, len(w) AS total, unnest(w) AS term FROM q), qf AS (SELECT doc_id, term, total, count(*) AS tf FROM qu GROUP BY ALL),
qw AS (SELECT doc_id, term, tf / total * (1 + n / (coalesce(df, 1) + 1)) AS weight FROM qf LEFT JOIN d USING (term), n), qn AS (SELECT doc_id, sqrt(sum(weight * weight)) AS n1 FROM qw GROUP BY ALL), cn AS (SELECT concept_id, sqrt(sum(weight * weight)) AS n2 FROM cw GROUP BY ALL),
dot AS (SELECT doc_id, concept_id, sum(qw.weight * cw.weight) AS dot FROM qw JOIN cw USING (term) GROUP BY ALL), s AS (SELECT doc_id, concept_id, dot / (n1 * n2) AS confidence FROM dot JOIN qn USING (doc_id) JOIN cn USING (concept_id)), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, concept_id) AS p FROM s WHERE confidence > 0.18) SELECT doc_id, concept_id, round(confidence, 6) AS confidence FROM r WHERE p <= 5""",
    "phrase_match": f"WITH {CONCEPTS} SELECT DISTINCT doc_id, concept_id FROM (SELECT doc_id, ' ' || {NORMAL.format('text')} || ' ' AS t FROM documents) JOIN c ON contains(t, ' ' || name || ' ')",
    "page_proximity": f"WITH {BLOCKS}, {CONCEPTS}, p AS (SELECT DISTINCT book_id, page_num FROM b) SELECT book_id, page_num, concept_id, CAST(CASE abs(page - page_num) WHEN 0 THEN 0.4 WHEN 1 THEN 0.25 ELSE 0.1 END AS DOUBLE) AS points FROM p JOIN c ON abs(page - page_num) <= 3",
    "link_dedupe_keep_max": "SELECT o_custkey AS segment_id, o_orderpriority AS concept_id, confidence, place FROM (SELECT *, o_totalprice AS confidence, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS n, min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority) AS place FROM orders) WHERE n = 1",
    "fallback_concept": f"""WITH {CONCEPTS}, cw AS (SELECT concept_id, item_id, list_distinct(regexp_extract_all(lower(name), '[A-Za-z][A-Za-z\\-]+')) AS w FROM c), cu AS (SELECT concept_id, item_id, len(w) AS n, unnest(w) AS w FROM cw), p AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(lower(regexp_extract(html, '<title>([^<]*)</title>', 1)), '[A-Za-z][A-Za-z\\-]+'))) AS w FROM pages), s AS (SELECT page_id, concept_id, item_id, count(*) / n AS share FROM p JOIN cu USING (w) GROUP BY page_id, concept_id, item_id, n), r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY share DESC, item_id) AS k FROM s) SELECT page_id, concept_id FROM r WHERE k = 1""",
    "qa_match": f"""WITH q AS (SELECT conv_id, turn, list_distinct(list_slice({WORDS.format('lower(text)')}, 1, 20)) AS a FROM conversations WHERE role = 'user'), s AS (SELECT conv_id, turn - 1 AS turn, list_distinct(list_slice({WORDS.format('lower(text)')}, 1, 20)) AS b FROM conversations WHERE role = 'assistant') SELECT conv_id, turn, round(CASE WHEN len(a) > 0 AND len(b) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) ELSE 0.0 END, 6) AS alike FROM q JOIN s USING (conv_id, turn)""",
    "unanswered": "SELECT conv_id, turn FROM conversations q WHERE role = 'user' AND NOT EXISTS (SELECT 1 FROM conversations a WHERE a.role = 'assistant' AND a.conv_id = q.conv_id AND a.turn = q.turn + 1)",
    "backlinks": "WITH l AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey), g AS (SELECT CAST(l_suppkey AS VARCHAR) AS formula_id, list(l_partkey ORDER BY l_partkey) AS a FROM l GROUP BY l_suppkey) SELECT formula_id, CAST(len(a) AS INT) AS n, array_to_string(list_slice(a, 1, 3), ',') AS first_ids FROM g",
    "chapter_gap_fill": "WITH p AS (SELECT DISTINCT page_id % 7 + 1 AS a, page_id % 13 + 1 AS k FROM pages WHERE page_id % 13 + 1 NOT IN (1, 3)), m AS (SELECT a, max(k) AS m FROM p GROUP BY a) SELECT number FROM (SELECT a, unnest(range(1, m)) AS k, a || '.' || k AS number FROM m) x WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.a = x.a AND p.k = x.k)",
    "chapter_rollup": "WITH p AS (SELECT page_id % 5 + 1 || '.' || (page_id % 3 + 1) AS n, CAST(page_id % 5 + 1 AS VARCHAR) AS m, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t, page_id FROM pages), q AS (SELECT m AS chapter_number, arg_min(nullif(trim(t), ''), page_id) AS chapter_title, 1 AS chapter_level, NULL AS parent_chapter FROM p GROUP BY m UNION ALL SELECT n, arg_min(nullif(trim(t), ''), page_id), 2, m FROM p GROUP BY n, m) SELECT * FROM q",
    "validation_combine": "SELECT doc_id, round(0.35 * least(q, h) + 0.25 * least(q, h) + 0.15 * least(q * 0.5, h * 0.5, 0.4) + 0.15 * least(c, q) + 0.10 * (c + q) / 2, 6) AS overall FROM (SELECT doc_id, CAST(coalesce(quality, 0) AS DOUBLE) AS q, 1 - CAST(coalesce(toxic, 0) AS DOUBLE) AS c, (q + c) / 2 AS h FROM labels)",
    "best_candidate": "SELECT question_id, nth, score FROM (SELECT l_orderkey AS question_id, l_linenumber AS nth, round(l_discount * 10, 6) AS score, row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_discount * 10 >= 0.7) DESC, l_discount DESC, l_linenumber) AS n FROM lineitem) WHERE n = 1",
    "solution_text": "WITH s AS (SELECT conv_id, turn, role, string_split(regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g'), '. ') AS a FROM conversations WHERE role = 'assistant') SELECT conv_id, turn, md5(array_to_string(list_transform(range(len(a)), lambda i: 'Step ' || (i + 1) || ': ' || a[i + 1]), chr(10)) || chr(10) || chr(10) || 'Final Answer: ' || role) AS text_md5 FROM s",
    "formula_alignment": "SELECT doc_id, (CASE WHEN contains(lower(text), lower(lang)) THEN 1 ELSE 0 END + CASE WHEN contains(lower(text), lower(source)) THEN 1 ELSE 0 END) / 2 AS share FROM documents",
    "batch_ids": "SELECT doc_id, (row_number() OVER (PARTITION BY lang, doc_id % 64 ORDER BY doc_id) - 1) // 10 AS batch_id FROM documents",
    "cache_misses": "SELECT d.doc_id, CASE WHEN EXISTS (SELECT 1 FROM documents e WHERE e.lang = 'en' AND e.source = d.source AND d.lang = 'en') THEN d.source END AS value FROM documents d",
    "review_flags": "SELECT lang, source, bool_or(quality = 0 OR toxic = 1) AS needs_review, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL",
    "type_allowlist": "SELECT upper(event_type) AS segment_type, count(*) AS n FROM events WHERE lower(event_type) IN ('click', 'view', 'purchase') GROUP BY ALL",
    "text_similarity": f"WITH w AS (SELECT item_id, list_distinct({WORDS.format('lower(text)')}) AS w FROM benchmark) SELECT b.item_id, round(CASE WHEN len(a.w) > 0 AND len(b.w) > 0 THEN len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) ELSE 0.0 END, 6) AS alike FROM w a JOIN w b ON b.item_id = a.item_id + 1",
    "embedding_cosine_top5": "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), p AS (SELECT q.vec_id AS query_id, e.vec_id, round(list_sum(list_transform(range(1, len(e.v) + 1), lambda i: e.v[i] * q.v[i])) / (sqrt(list_sum(list_transform(e.v, lambda x: x * x))) * sqrt(list_sum(list_transform(q.v, lambda x: x * x)))), 6) AS cosine FROM e, e q WHERE q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) AS place FROM p) SELECT query_id, vec_id, cosine, CAST(place AS INT) AS place FROM r WHERE place <= 5",
    "header_score": f"""WITH {STRIPPED} SELECT * FROM (SELECT book_id, block_idx, CASE WHEN starts_with(lower(text), 'example') OR starts_with(lower(text), 'concept check') OR regexp_matches(left(text, 20), '[=+\\-*/]') THEN 0 ELSE
(CASE WHEN starts_with(lower(text), 'chapter') THEN 2 ELSE 0 END) + (CASE WHEN regexp_matches(text, '^\\d+(\\.\\d+)+(\\s+|$)') THEN 2 ELSE 0 END) + (CASE WHEN length(text) <= 80 THEN 1 ELSE 0 END) + (CASE WHEN y0 / 842 < 0.25 THEN 1 ELSE 0 END)
+ (CASE WHEN (regexp_matches(text, '\\p{{L}}') AND NOT regexp_matches(text, '(^|\\P{{L}})\\p{{Ll}}|\\p{{L}}\\p{{Lu}}')) OR (regexp_matches(text, '\\p{{Lu}}') AND NOT regexp_matches(text, '\\p{{Ll}}')) THEN 1 ELSE 0 END) END AS score FROM t) WHERE score >= 2""",
    "symbol_weights_top14": """WITH s AS (SELECT lang, doc_id, regexp_extract_all(text, '[A-Za-zα-ωΑ-Ω][A-Za-z0-9_()]*') AS a FROM documents), u AS (SELECT lang, doc_id, unnest(a) AS symbol, unnest(range(len(a))) AS k FROM s), d AS (SELECT lang, doc_id, symbol, min(k) AS k FROM u WHERE length(symbol) <= 15 AND lower(symbol) NOT IN ('the','and','or','is','are','this','that','what','which','where','when','was','were','has','have','been','will','would','should','could','may','might','can','must','shall','for','with','from','to','of','in','on','at','by','if','then','else','let','denote','define','here','log','ln','exp','max','min','sin','cos','tan','sqrt','abs','sum','prod','mean','var','cov') GROUP BY ALL), r AS (SELECT lang, symbol, row_number() OVER (PARTITION BY lang, doc_id ORDER BY k) AS nth FROM d), w AS (SELECT lang, symbol, count(*) AS weight FROM r WHERE nth <= 20 GROUP BY ALL), p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, symbol) AS place FROM w) SELECT lang, symbol, weight, CAST(place AS INT) AS place FROM p WHERE place <= 14""",
    "formula_scan": f"""WITH {BLOCKS}, n AS (SELECT *, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS s FROM b), c AS (SELECT *, right(coalesce(lag(s) OVER w, ''), 200) AS cb, left(coalesce(lead(s) OVER w, ''), 200) AS ca, {WORDS.format('s')} AS ws FROM n WINDOW w AS (PARTITION BY book_id, page_num ORDER BY block_idx)),
h AS (SELECT *, NOT regexp_matches(s, '(?i)https?://|www\\.|\\.com\\b|\\.edu\\b|\\.net\\b') AND NOT regexp_matches(s, '^\\(?\\d+(\\.\\d+)+[a-z]?\\)?$') AND regexp_matches(s, '[=∑√∫σπθλ+−×÷^∂∆]|\\*\\*|[A-Za-z][_(]') AS heuristic, regexp_matches(s, '\\(\\d+\\.\\d+\\)') AS labelled,
len(list_filter(ws, lambda x: regexp_matches(x, '[=∑√∫σπθλ+−×÷^/\\\\()\\[\\]]|\\*\\*|[A-Za-z]\\d+|\\d+[A-Za-z]|[A-Za-z]_[A-Za-z]'))) / greatest(len(ws), 1) AS ratio, len(list_filter(ws, lambda x: regexp_matches(x, '[=∑√∫σπθλ+−×÷^/\\\\]|\\*\\*'))) / greatest(len(ws), 1) AS prose_ratio FROM c WHERE s <> ''),
f AS (SELECT *, contains(s, 'Eq.') OR contains(s, 'Equation') OR labelled AS keyword FROM h), g AS (SELECT *, NOT (length(s) <= 3 AND NOT labelled AND NOT regexp_matches(s, '[=+\\-*/×÷∑∫√]')) AND NOT (NOT regexp_matches(s, '[A-Za-zα-ωΑ-Ω]') AND regexp_full_match(s, '[\\d.\\-%\\s]+') AND len(ws) <= 2 AND NOT labelled) AND NOT (regexp_full_match(s, '[A-Za-z]\\s*=\\s*-?\\d+(\\.\\d+)?') AND NOT labelled) AND (ratio >= 0.3 OR keyword) AND regexp_matches(s, '[=∑√∫σπθλ+−×÷^/\\\\()\\[\\]]|\\*\\*') AS shaped FROM f)
SELECT book_id, block_idx, {KEY.format('s')} AS canonical_key, CASE WHEN labelled THEN regexp_extract(s, '\\(\\d+\\.\\d+\\)') END AS equation_number, {USAGE.format("lower(cb || ' ' || ca)")} AS usage_type FROM g WHERE heuristic OR (shaped AND NOT (len(ws) >= 8 AND prose_ratio < 0.2 AND NOT labelled))""",
    "equation_labels": f"""WITH {PHRASED}, n AS (SELECT *, {PLAIN.format('t')} AS m FROM p), f AS (SELECT *, split_part(m, '=', 1) AS l, substr(m, length(split_part(m, '=', 1)) + 2) AS r FROM n) SELECT p_partkey, CASE WHEN regexp_matches(t, '\\(\\d+\\.\\d+\\)') THEN regexp_extract(t, '\\(\\d+\\.\\d+\\)') WHEN regexp_matches(t, '(Eq\\.|Equation\\s)\\s*\\d+\\.\\d+') THEN '(' || regexp_extract(t, '(Eq\\.|Equation\\s)\\s*(\\d+\\.\\d+)', 2) || ')' END AS number,
regexp_full_match(t, '\\(?\\d+(\\.\\d+)+[a-z]?\\)?') OR regexp_matches(t, '(?i)\\b(eq|equation)\\.?\\s*\\d+(\\.\\d+)+') AS is_label, regexp_full_match(m, '{ONE}') OR regexp_full_match(m, '{ONE}[/×*]{ONE}') OR (contains(m, '=') AND regexp_full_match(l, '{ONE}') AND NOT regexp_matches(r, '(?i)log|ln|exp|sqrt|sin|cos|tan|∫|∑') AND len(regexp_extract_all(r, '[+\\-*/]')) <= 3) AS is_simple FROM f""",
    "reference_markers": """WITH x AS (SELECT conv_id, turn, coalesce(text, '') || ' See Table ' || (turn + 1) || '.' || conv_id % 10 || ' and Appendix B; section 4.' || turn || 'b' AS t FROM conversations), m AS (SELECT conv_id, turn, list_concat(regexp_extract_all(t, '(?i)\\b(Table|Figure|Appendix|Exhibit|Section|Chapter)\\s+([A-Za-z]?\\d+(?:\\.\\d+)*[a-z]?)', 1), regexp_extract_all(t, '(?i)\\b(Appendix)\\s+([A-Z])\\b', 1)) AS a, list_concat(regexp_extract_all(t, '(?i)\\b(Table|Figure|Appendix|Exhibit|Section|Chapter)\\s+([A-Za-z]?\\d+(?:\\.\\d+)*[a-z]?)', 2), regexp_extract_all(t, '(?i)\\b(Appendix)\\s+([A-Z])\\b', 2)) AS b FROM x) SELECT conv_id, turn, CAST(unnest(range(len(a))) AS INT) AS nth, lower(unnest(a)) AS ref_type, unnest(b) AS ref_id FROM m""",
    "split_numbered": f"""WITH {TRANSCRIPTS}, y AS (SELECT conv_id, list_transform(string_split(t, chr(10)), lambda z: {TRIM.format('z')}) AS l FROM x), z AS (SELECT conv_id, unnest(range(1, len(l) + 1)) AS k, l FROM y), f AS (SELECT conv_id, k, l[k] AS line, regexp_matches(array_to_string(l[k:], chr(10)), '^\\d+\\s*[.)]\\s+') AS opens FROM z), g AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY k) AS part FROM f), h AS (SELECT conv_id, part, {TRIM.format("string_agg(line, chr(10) ORDER BY k)")} AS chunk FROM g WHERE part > 0 GROUP BY conv_id, part) SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY part) - 1 AS INT) AS nth, chunk FROM h WHERE chunk <> ''""",
    "question_parts": f"""WITH x AS (SELECT conv_id, turn, list_transform(list_slice({WORDS.format("lower(coalesce(text, ''))")}, 1, 4), lambda z: regexp_replace(z, '[^a-z]', '', 'g')) AS w FROM conversations), y AS (SELECT conv_id, turn, 'A. ' || coalesce(nullif(w[1], ''), 'x') || ' B. ' || coalesce(nullif(w[2], ''), 'x') || ' (a) ' || coalesce(nullif(w[3], ''), 'x') || ' (b) ' || coalesce(nullif(w[4], ''), 'x') AS t FROM x),
z AS (SELECT conv_id, turn, regexp_extract_all(t, '([A-D])\\.', 1) AS cl, string_split_regex(t, '[A-D]\\.') AS cp, regexp_extract_all(t, '\\(([a-z])\\)', 1) AS sl, string_split_regex(t, '\\([a-z]\\)') AS sp FROM y) SELECT conv_id, turn, array_to_string(list_transform(range(1, len(cl) + 1), lambda i: cl[i] || '. ' || {TRIM.format('cp[i + 1]')}), '|') AS choices, array_to_string(list_transform(range(1, len(sl) + 1), lambda i: sl[i] || '=' || {TRIM.format('sp[i + 1]')}), '|') AS subparts FROM z""",
    "parse_pages": """WITH x AS (SELECT l_orderkey, l_linenumber, l_linenumber || '-' || (l_linenumber + l_partkey % 4 - 1) || ', ' || l_suppkey % 7 || '; p. ' || l_linenumber AS t FROM lineitem), y AS (SELECT l_orderkey, l_linenumber, list_transform(string_split_regex(t, '[;,]'), lambda p: trim(p)) AS a FROM x) SELECT l_orderkey, l_linenumber, array_to_string(list_sort(list_distinct(flatten(list_transform(a, lambda p: CASE WHEN contains(p, '-') THEN range(CAST(split_part(p, '-', 1) AS BIGINT), CAST(split_part(p, '-', 2) AS BIGINT) + 1) ELSE list_transform(regexp_extract_all(p, '\\d+'), lambda n: CAST(n AS BIGINT)) END)))), ',') AS pages FROM y""",
    "ref_keys": f"""WITH {NUMBERED}, n AS (SELECT *, regexp_replace(regexp_replace(trim(number), '^\\s*[Qq]\\s*', ''), '[() ]', '', 'g') AS b, CASE WHEN chapter IS NULL OR chapter = 'Unknown' THEN NULL ELSE split_part(chapter, '.', 1) END AS main, {CUED.format('text')} AS cued FROM t), m AS (SELECT *, lower(CASE WHEN regexp_full_match(b, '(?i)\\d+(\\.\\d+)*[a-z]?') THEN b WHEN regexp_matches(b, '\\d') THEN regexp_replace(regexp_extract(b, '(?i)(\\d+\\s*[a-z]?)', 1), '\\s', '', 'g') ELSE b END) AS normal FROM n)
SELECT conv_id, turn, normal, CASE WHEN main IS NOT NULL AND normal <> '' THEN 'Ch' || main || '-Q' || normal || suffix END AS question_key, CASE WHEN main IS NOT NULL AND cued IS NOT NULL THEN 'Ch' || main || '-S' || cued || CASE WHEN turn % 2 = 0 THEN '-CC' ELSE '' END END AS solution_key, cued, nullif(regexp_extract({TRIM.format('text')}, '^\\s*(\\d+)\\s*[.:)]', 1), '') AS leading, CASE WHEN main IS NOT NULL AND normal <> '' THEN 'Ch' || main || '-S' || normal END AS bare_key, nullif(left(regexp_replace({TRIM.format('text')}, '\\s+', ' ', 'g'), 200), '') AS snippet FROM m""",
    "eq_reference_join": """WITH f AS (SELECT p_brand AS book_id, p_size || '.' || p_partkey % 5 AS n, max(p_partkey) AS k FROM part GROUP BY ALL), c AS (SELECT 'c' || c_custkey AS source_id, 'Brand#' || (c_custkey % 25 + 1) AS book_id, 'use Eq. ' || c_custkey % 50 || '.' || c_custkey % 5 || ' and (' || c_custkey % 31 || '.' || c_custkey % 4 || ')' AS t FROM customer), m AS (SELECT source_id, book_id, 0 AS nth, regexp_extract(t, 'Eq\\.\\s*\\(?(\\d+\\.\\d+)\\)?', 1) AS n FROM c UNION ALL SELECT source_id, book_id, 1, regexp_extract(t, '\\((\\d+\\.\\d+)\\)', 1) FROM c), h AS (SELECT source_id, 'f' || k AS target_id, min(nth) AS nth FROM m JOIN f USING (book_id, n) GROUP BY ALL) SELECT source_id, target_id, CAST(row_number() OVER (PARTITION BY source_id ORDER BY nth, target_id) AS INT) AS seq FROM h""",
    "variable_overlap_top3": "WITH n AS (SELECT n_nationkey % 5 AS b, CAST(n_nationkey AS VARCHAR) AS target_id, unnest(['#' || n_nationkey, '00' || n_nationkey]) AS needle FROM nation), s AS (SELECT c_nationkey % 5 AS b, 'c' || c_custkey AS source_id, lower('#' || c_nationkey || ' ' || c_name) AS t FROM customer), o AS (SELECT source_id, target_id, count(*) AS overlap FROM s JOIN n ON s.b = n.b AND contains(t, needle) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY overlap DESC, target_id) AS seq FROM o) SELECT source_id, target_id, overlap, CAST(seq AS INT) AS seq FROM r WHERE seq <= 3",
    "json_props": "SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL WHEN 3 THEN '[' || props || ']' ELSE props END AS json FROM events",
    "typed_edges": f"""WITH {GRAPH}, e AS (SELECT book_id, before AS source_id, id AS target_id, 'NEAR' AS edge_type, 1.0 AS strength, page, NULL AS how, NULL AS snippet, k FROM s UNION ALL SELECT book_id, id, behind, 'NEAR', 1.0, page, NULL, NULL, k FROM s
UNION ALL SELECT book_id, id, 's' || (k + 7), CASE WHEN k % 3 = 0 THEN 'REFERENCES' ELSE 'USES_FORMULA' END, 1.0, page, CASE WHEN k % 3 = 0 THEN 'equation_number' ELSE 'variable_overlap' END, text, k FROM s WHERE kind <> 'formula'
UNION ALL SELECT book_id, id, 's' || (k + 5), 'EXPLAINS', 1.0, page, NULL, NULL, k FROM s WHERE kind = 'derivation' UNION ALL SELECT book_id, id, 's' || (k - 3), 'ANSWER_OF', 1.0, page, 'question_number', short, k FROM s WHERE kind = 'solution'
UNION ALL SELECT book_id, id, 'k' || k % 11, CASE WHEN kind = 'formula' THEN 'DEFINES' ELSE 'WORKED_EXAMPLE_OF' END, (k % 10) / 10, page, NULL, NULL, k FROM s WHERE kind = 'worked_example' OR (kind = 'formula' AND defines)
UNION ALL SELECT book_id, id, 's' || (k - 1), 'DUPLICATE_OF', 1.0, page, 'heuristic', 'canonical_formula_key=' || md5(text), k FROM s WHERE kind = 'formula' AND k % 4 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY source_id, target_id, edge_type ORDER BY k, page) AS n FROM e WHERE source_id IS NOT NULL AND target_id IS NOT NULL)
SELECT book_id, source_id, target_id, edge_type, round(CAST(strength AS DOUBLE), 6) AS strength, CASE WHEN edge_type IN ('DEFINES', 'WORKED_EXAMPLE_OF') THEN CASE k % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'alias' WHEN 2 THEN 'semantic' WHEN 3 THEN 'heuristic' END END AS link_method, page, how, snippet FROM r WHERE n = 1""",
    "answers": f"WITH {SOLVED} SELECT solution_id, question_id, round(score, 6) AS score, method FROM l",
    "answer_statuses": f"WITH {SOLVED} SELECT qid AS segment_id, CASE WHEN EXISTS (SELECT 1 FROM l WHERE l.question_id = qid) THEN 'linked' WHEN kind = 2 AND EXISTS (SELECT 1 FROM a WHERE a.book_id = q.book_id AND a.ac = q.qc) THEN 'ambiguous' ELSE 'not_found_in_book' END AS status FROM q",
    "block_tests": f"""WITH {SHAPED}, x AS (SELECT *, lower(t) AS l, trim(lower(t)) AS s, string_split(t, chr(10)) AS lines FROM p), e AS (SELECT *, starts_with(l, 'example') OR contains(left(l, 50), 'worked example') OR (contains(left(l, 100), 'given') AND regexp_matches(t, '\\d') AND regexp_matches(l, 'answer|solution|therefore|thus|find|calculate')) AS ex, regexp_matches(left(l, 50), 'proof|derivation|we can show|substituting') AS de FROM x),
f AS (SELECT *, length(s) >= 10 AND (coalesce(section = 'concept_check_solutions' AND regexp_matches(s, '^\\d+[.:)]'), false) OR coalesce(section = 'concept_check' AND regexp_matches(s, '^\\d+[.:)]') AND regexp_matches(left(s, 200), 'solution|answer|therefore|thus|we find|we get|='), false) OR ((regexp_matches(left(s, 100), 'solution to|answer to|solution:|answer:') OR regexp_matches(s, '^(solution|answer)\\s+(to\\s+)?(question\\s+)?\\d+') OR regexp_matches(s, '^\\d+\\s+(solution|answer)')) AND NOT ex)) AS so, len(list_filter(lines, lambda y: contains(y, '='))) AS eq, len(list_filter(list_slice(lines, 1, 5), lambda y: regexp_matches(y, '^\\d+[.)]\\s+'))) > 0 AS st FROM e)
SELECT p_partkey, ex AS example, de AS derivation, so AS solution, NOT ex AND NOT de AND NOT so AND ((regexp_matches(t, '\\d') AND contains(t, '=') AND (regexp_matches(t, '[+\\-*/×÷^]') OR eq >= 2) AND (eq >= 2 OR st)) OR (contains(left(l, 100), 'given') AND regexp_matches(t, '\\d') AND contains(t, '=') AND regexp_matches(l, 'therefore|thus|we get|we find|result|answer'))) AS calculation, regexp_matches(s, '^concept\\s+check\\s+\\d+\\.\\d+') AS concept_check,
regexp_matches(l, '\\?|what\\s+(is|are|would|should)|calculate|compute|determine|find|estimate|explain|discuss|analyze|evaluate|are\\s+the\\s+following\\s+(true|false)|if\\s+.*\\s+what|given\\s+.*\\s+(what|find|calculate)') AS problem FROM f""",
    "extractions": f"""WITH {SHAPED}, g AS (SELECT *, regexp_extract(t, '(?is)given[:\\s]+(.*?)(?:\\.|$|find|calculate|determine)', 1) AS z FROM p), h AS (SELECT *, regexp_extract_all(z, '([A-Za-z_][A-Za-z0-9_]*)\\s*[=:]\\s*([0-9.]+)', 1) AS n, regexp_extract_all(z, '([A-Za-z_][A-Za-z0-9_]*)\\s*[=:]\\s*([0-9.]+)', 2) AS v, list_filter(list_transform(string_split(t, chr(10)), lambda y: trim(y)), lambda y: y <> '') AS lines FROM g)
SELECT p_partkey, array_to_string(list_sort(list_transform(range(1, len(n) + 1), lambda i: n[i] || '=' || v[i])), '|') AS given, array_to_string(list_slice(list_distinct_in_order, 1, 5), '|') AS outputs, CASE WHEN regexp_matches(t, '(?im)step\\s+\\d|^\\d+[.)]') THEN array_to_string(list_concat(list_transform(regexp_extract_all(t, '(?im)step\\s+\\d+[.:]\\s*([^\\n]+)', 1), lambda y: trim(y)), list_transform(regexp_extract_all(t, '(?m)^\\d+[.)]\\s*([^\\n]+)', 1), lambda y: trim(y))), '|') END AS steps, array_to_string(list_slice(lines, 1, 8), '|') AS lines
FROM (SELECT *, list_concat(regexp_extract_all(t, '(?i)(?:find|calculate|determine|solve for|compute)\\s+([A-Za-z_][A-Za-z0-9_]*)', 1), regexp_extract_all(t, '([A-Za-z_][A-Za-z0-9_]*)\\s*=\\s*[^=]+$', 1)) AS list_all, list_filter(list_all, lambda y, i: list_position(list_all, y) = i) AS list_distinct_in_order FROM h)""",
    "symbol_tests": """WITH x AS (SELECT p_partkey, CASE p_size % 8 WHEN 0 THEN 'r_' || p_size % 7 WHEN 1 THEN '(' || left(p_name, 3) || '),' WHEN 2 THEN 'alpha' WHEN 3 THEN 'years' WHEN 4 THEN 'σ' WHEN 5 THEN p_brand WHEN 6 THEN ' ab' || p_size % 7 || ': ' ELSE 'Sigma' END AS raw FROM part), y AS (SELECT p_partkey, regexp_replace(trim(raw), '^[\\s(\\[{]+|[\\s)\\]}.,;:%]+$', '', 'g') AS symbol FROM x)
SELECT p_partkey, symbol, lower(symbol) NOT IN ('year', 'years', 'month', 'months', 'day', 'days', 'percent', 'percentage', 'million', 'billion', 'bp', 'bps', 'basis', 'points', 'dollar', 'dollars', 'usd', 'eur', 'yen') AND (lower(symbol) IN ('alpha', 'beta', 'gamma', 'delta', 'sigma', 'theta', 'lambda', 'rho', 'pi', 'mu', 'nu', 'epsilon', 'eta', 'phi', 'psi', 'omega') OR regexp_full_match(symbol, '[A-Za-z]{1,4}|[A-Za-zα-ωΑ-Ω]{1,3}_[A-Za-z0-9]{1,6}|[α-ωΑ-Ω]')) AS valid, lower(symbol) = 'sigma' AS is_sigma FROM y""",
    "chapter_titles": """WITH x AS (SELECT CAST(page_id % 10 AS VARCHAR) AS book_id, page_id, page_id % 3 + 1 AS level, regexp_extract(html, '<title>([^<]*)</title>', 1) AS z, page_id % 12 + 1 AS n, page_id % 5 + 1 AS m FROM pages), y AS (SELECT *, CASE page_id % 4 WHEN 0 THEN 'Chapter ' || n || ': ' || z WHEN 1 THEN n || '.' || m || ' ' || z WHEN 2 THEN n || ' - ' || z ELSE z END AS t FROM x),
e AS (SELECT *, coalesce(nullif(regexp_extract(t, '(?i)\\bchapter\\s+(\\d+)\\b', 1), ''), CASE WHEN level = 1 THEN nullif(regexp_extract(t, '^\\s*(\\d+)\\b', 1), '') END) AS c, nullif(regexp_extract(t, '^\\s*(\\d+(?:\\.\\d+)+)', 1), '') AS s FROM y), f AS (SELECT book_id, page_id, coalesce(c, s) AS number, CASE WHEN c IS NOT NULL THEN regexp_replace(regexp_replace(t, '(?i)\\bchapter\\s+\\d+\\b', '', 'g'), '^[ \\-:\\t]+|[ \\-:\\t]+$', '', 'g') ELSE trim(regexp_replace(t, '^\\s*\\d+(?:\\.\\d+)+', '')) END AS title FROM e WHERE c IS NOT NULL OR s IS NOT NULL) SELECT book_id, number, nullif(arg_max(title, page_id), '') AS title FROM f GROUP BY ALL""",
    "page_titles": f"WITH {BLOCKS}, x AS (SELECT book_id, page_num, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS s, CAST(length(text) % 7 AS DOUBLE) AS size, y0 FROM b), r AS (SELECT *, row_number() OVER (PARTITION BY book_id, page_num ORDER BY size DESC, y0) AS n FROM x WHERE s <> '' AND NOT starts_with(lower(s), 'chapter')) SELECT book_id, page_num, s AS title FROM r WHERE n = 1 AND length(s) >= 5",
    "solution_locations": "WITH p AS (SELECT p_brand || '-' || p_partkey % 20 AS chapter, p_partkey, CASE p_partkey % 7 WHEN 1 THEN 'selected_answers' WHEN 2 THEN 'appendix' WHEN 3 THEN 'end_of_chapter' WHEN 4 THEN 'concept_check_only' WHEN 6 THEN 'end_of_chapter' END AS said FROM part WHERE p_size % 5 = 0) SELECT chapter, coalesce(arg_min(said, p_partkey) FILTER (said IS NOT NULL), 'in_chapter') AS location FROM p GROUP BY chapter",
    "catalog_rows": f"""WITH x AS (SELECT item_id, {WORDS.format(NORMAL.format('text'))} AS w FROM benchmark) SELECT CAST(item_id AS VARCHAR) AS concept_id, array_to_string(list_slice(w, 1, 2), ' ') AS name, array_to_string(list_slice(w, 3, 5), '|') AS aliases, array_to_string(list_slice(w, 6, 8), '|') AS tags, CAST(item_id % 4 AS INT) AS level, array_to_string(range(item_id % 5, item_id % 8 + 1), '|') AS pages FROM x WHERE len(w) > 0""",
    "concept_score": f"WITH {RICH}, {TURNS}, {GATES} SELECT segment_id, concept_id, round(CAST(score AS DOUBLE), 6) AS score, method FROM g WHERE score > 0",
}
