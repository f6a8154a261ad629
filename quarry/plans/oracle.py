"""The SQL each registered query is checked against (DuckDB dialect, over the
pre-registered table views). Bindings are inlined as CTEs."""

from __future__ import annotations

from quarry.operators.terms import INDEX_BLOCK_IDS
from quarry.sources import bindings as B


def _values(vocab) -> str:
    rows = ", ".join(f"('{t}', {i})" for i, t in enumerate(vocab.terms))
    return f"(VALUES {rows})"


TERMS = f"terms(term, pos) AS (SELECT * FROM {_values(B.DOC_TERMS)} v(term, pos))"
ARTICLES = ("articles AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS title, text, "
            "string_split(text, ' ') AS toks FROM documents)")
HITS = ("hits AS (SELECT t.term, t.pos, a.doc_id, a.title FROM articles a "
        "JOIN terms t ON list_contains(a.toks, t.term))")
TERM_CTES = f"WITH {TERMS}, {ARTICLES}, {HITS}"

_SQL: dict[str, str] = {}

_SQL["page_line_parse"] = "SELECT doc_id, CAST(doc_id AS VARCHAR) AS title, text FROM documents"

_SQL["page_file_parse"] = ("SELECT CAST(doc_id AS VARCHAR) AS title, translate(coalesce(text, ''), chr(13) || chr(10), '  ') "
                           "AS text FROM documents")

_SQL["term_doc_count"] = (
    f"SELECT '{B.DOC_TERMS.terms[0]}' AS term, count(*) AS n FROM documents "
    f"WHERE list_contains(string_split(text, ' '), '{B.DOC_TERMS.terms[0]}')")

_SQL["term_rank_zero_filled"] = (
    f"{TERM_CTES}, counts AS (SELECT term, count(*) AS n FROM hits GROUP BY term) "
    "SELECT t.term, coalesce(c.n, 0) AS n FROM terms t LEFT JOIN counts c USING (term) "
    "ORDER BY n DESC, t.pos")

_SQL["term_index"] = f"{TERM_CTES} SELECT term, doc_id, title FROM hits"

_SQL["term_index_blocks"] = (
    f"{TERM_CTES} SELECT term, doc_id // {INDEX_BLOCK_IDS} AS block, count(*) AS n, "
    "string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids FROM hits GROUP BY ALL")

_SQL["term_rank_from_index"] = (
    f"{TERM_CTES} SELECT term, count(*) AS n FROM hits GROUP BY term ORDER BY n DESC, term")

_SQL["term_rank_one_pass"] = _SQL["term_rank_from_index"]

TERM_TABLE = (
    "WITH vocab AS (SELECT DISTINCT term FROM (SELECT unnest(string_split(html, ' ')) AS term FROM pages "
    "UNION ALL SELECT unnest(string_split(text, ' ')) FROM conversations "
    "UNION ALL SELECT unnest(string_split(text, ' ')) FROM benchmark "
    "UNION ALL SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) FROM lineitem) WHERE term <> ''), "
    "toks AS (SELECT DISTINCT doc_id, unnest(string_split(text, ' ')) AS term FROM documents), "
    "hits AS (SELECT term, doc_id FROM toks JOIN vocab USING (term))")
_SQL["term_table_rank"] = f"{TERM_TABLE} SELECT term, count(*) AS n FROM hits GROUP BY term ORDER BY n DESC, term"
_SQL["term_table_rank_zero_filled"] = (
    f"{TERM_TABLE} SELECT v.term, count(h.doc_id) AS n FROM vocab v LEFT JOIN hits h USING (term) GROUP BY v.term "
    "ORDER BY n DESC, term")
_SQL["term_table_index"] = f"{TERM_TABLE} SELECT term, doc_id, CAST(doc_id AS VARCHAR) AS title FROM hits"
_SQL["term_index_ranked"] = (
    f"{TERM_CTES}, spread AS (SELECT term, title, CAST('0x' || md5(title)[1:15] AS BIGINT) AS id FROM hits), "
    "placed AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY id) - 1 AS pos, "
    "count(*) OVER (PARTITION BY term) AS total FROM spread), "
    "cut AS (SELECT *, CAST((pos * CAST(ceil(total / "
    f"{B.RANKED_BLOCK_DOCS}.0) AS BIGINT)) // total AS BIGINT) AS block FROM placed), "
    "steps AS (SELECT *, id - coalesce(lag(id) OVER (PARTITION BY term, block ORDER BY id), id) AS delta FROM cut) "
    "SELECT term, block, count(*) AS n, min(id) AS first_id, string_agg(CAST(delta AS VARCHAR), ',' ORDER BY id) AS deltas, "
    "string_agg(title, ',' ORDER BY id) AS titles FROM steps GROUP BY term, block")


# -- postings ------------------------------------------------------------------
_P = B.POSTING_KMEANS_FIXED
_SPREAD = _P.spread
_M = _P.k // len(B.POSTING_TAGS)

POSTINGS = (
    "postings AS ("
    "SELECT 1 AS posting_type, o_orderkey AS id, CAST(NULL AS BIGINT) AS accepted_answer, "
    "CAST(NULL AS BIGINT) AS parent_id, CAST(0 AS BIGINT) AS score, "
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS tags FROM orders "
    "UNION ALL "
    "SELECT CASE WHEN l_linenumber = 7 THEN 3 ELSE 2 END, "
    f"CAST({B.ANSWER_ID_BASE} + l_orderkey * 10 + l_linenumber AS BIGINT), NULL, "
    "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_orderkey END, "
    f"CAST(trunc(l_quantity) AS BIGINT) - {B.SCORE_OFFSET}, NULL FROM lineitem)")
VALID = ("valid AS (SELECT CASE WHEN posting_type = 1 THEN id ELSE parent_id END AS qid, * "
         "FROM postings WHERE posting_type = 1 OR (posting_type = 2 AND parent_id IS NOT NULL))")
PAIRS = ("pairs AS (SELECT q.qid, q.tags, a.id AS answer_id, a.score AS answer_score "
         "FROM valid q JOIN valid a ON a.qid = q.qid WHERE q.posting_type = 1 AND a.posting_type = 2)")
SCORED = "scored AS (SELECT qid, tags, max(answer_score) AS max_score FROM pairs GROUP BY qid, tags)"
TAGS = f"tags(tag, pos) AS (SELECT * FROM {_values(B.POSTING_TAGS)} v(tag, pos))"
VECTORS = (f"vectors AS (SELECT s.qid AS id, CAST(t.pos AS BIGINT) * {_SPREAD} AS x, s.max_score AS y "
           "FROM scored s JOIN tags t ON s.tags = t.tag)")
HASH = f"md5('{_P.seed}:' || CAST(id AS VARCHAR))"
SEEDS = (f"seeds AS (SELECT CAST((x // {_SPREAD}) * {_M} + rn - 1 AS INTEGER) AS k, id, x, y FROM "
         f"(SELECT *, row_number() OVER (PARTITION BY x ORDER BY {HASH}, id) AS rn FROM vectors) "
         f"WHERE rn <= {_M})")
C0 = "c0 AS (SELECT k, x AS cx, y AS cy FROM seeds)"
POSTING_CTES = f"WITH {POSTINGS}, {VALID}, {PAIRS}, {SCORED}, {TAGS}, {VECTORS}"
SEED_CTES = f"{POSTING_CTES}, {SEEDS}, {C0}"


def _assign(name: str, centres: str) -> str:
    return (f"{name} AS (SELECT id, x, y, k FROM (SELECT v.id, v.x, v.y, c.k, row_number() OVER "
            "(PARTITION BY v.id ORDER BY (v.x - c.cx) * (v.x - c.cx) + (v.y - c.cy) * (v.y - c.cy), c.k) AS rn "
            f"FROM vectors v CROSS JOIN {centres} c) WHERE rn = 1)")


def _means(name: str, assigned: str) -> str:
    return (f"{name} AS (SELECT k, CAST(trunc(sum(x) / count(*)) AS BIGINT) AS cx, "
            "CAST(trunc(sum(y) / count(*)) AS BIGINT) AS cy, count(*) AS n "
            f"FROM {assigned} GROUP BY k)")


def _carry(name: str, old: str, means: str) -> str:
    return (f"{name} AS (SELECT o.k, coalesce(m.cx, o.cx) AS cx, coalesce(m.cy, o.cy) AS cy "
            f"FROM {old} o LEFT JOIN {means} m USING (k))")


def _rounds(n: int) -> str:
    """CTEs a1, m1, c1 ... an, mn, cn: n unrolled k-means rounds from c0."""
    parts = []
    for r in range(1, n + 1):
        parts += [_assign(f"a{r}", f"c{r - 1}"), _means(f"m{r}", f"a{r}"), _carry(f"c{r}", f"c{r - 1}", f"m{r}")]
    return ", ".join(parts)


def _until_still(p) -> str:
    """Recursive CTE `rounds(iter, k, cx, cy, moved)` from `vectors` and the
    centres `c0`: rounds until the movement is below eta."""
    return (
        "pts AS MATERIALIZED (SELECT x, y, count(*) AS w FROM vectors GROUP BY x, y), "
        "start AS MATERIALIZED (SELECT * FROM c0), "
        "rounds(iter, k, cx, cy, moved) AS ("
        "SELECT 0, k, cx, cy, CAST(NULL AS BIGINT) FROM start UNION ALL "
        "SELECT iter, k, nx, ny, CAST(sum((nx - cx) * (nx - cx) + (ny - cy) * (ny - cy)) OVER () AS BIGINT) FROM ("
        "SELECT o.iter + 1 AS iter, o.k, o.cx, o.cy, coalesce(m.cx, o.cx) AS nx, coalesce(m.cy, o.cy) AS ny "
        "FROM rounds o LEFT JOIN (SELECT k, CAST(trunc(sum(x * w) / sum(w)) AS BIGINT) AS cx, "
        "CAST(trunc(sum(y * w) / sum(w)) AS BIGINT) AS cy FROM ("
        "SELECT p.x, p.y, p.w, c.k, row_number() OVER (PARTITION BY p.x, p.y ORDER BY "
        "(p.x - c.cx) * (p.x - c.cx) + (p.y - c.cy) * (p.y - c.cy), c.k) AS rn FROM pts p CROSS JOIN rounds c) "
        "WHERE rn = 1 GROUP BY k) m ON o.k = m.k "
        f"WHERE o.iter < {p.max_iter} AND (o.moved IS NULL OR o.moved >= {p.eta})))")


def _recursive(ctes: str) -> str:
    return ctes.replace("WITH ", "WITH RECURSIVE ", 1)


STILL = f"{_recursive(SEED_CTES)}, {_until_still(B.POSTING_KMEANS)}"
_BP = B.BRAND_KMEANS
_BM = _BP.k // len(B.BRAND_TAGS)
BRANDS = (
    "WITH RECURSIVE scored AS (SELECT p_partkey AS id, p_brand AS tag, "
    "max(CAST(trunc(l_quantity) AS BIGINT) * l_linenumber) AS y FROM part JOIN lineitem ON l_partkey = p_partkey "
    f"GROUP BY ALL), tags(tag, pos) AS (SELECT * FROM {_values(B.BRAND_TAGS)} v(tag, pos)), "
    f"vectors AS (SELECT id, CAST(pos AS BIGINT) * {_BP.spread} AS x, y FROM scored JOIN tags USING (tag)), "
    f"c0 AS (SELECT CAST((x // {_BP.spread}) * {_BM} + rn - 1 AS INTEGER) AS k, x AS cx, y AS cy FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY x ORDER BY md5('{_BP.seed}:' || CAST(id AS VARCHAR)), id) AS rn "
    f"FROM vectors) WHERE rn <= {_BM}), {_until_still(_BP)}")
_LAST = "SELECT k, cx, cy FROM rounds WHERE iter = (SELECT max(iter) FROM rounds)"

_SQL["nearest_of_many"] = (
    "WITH scored AS (SELECT p_partkey AS id, p_brand AS tag, "
    "max(CAST(trunc(l_quantity) AS BIGINT) * l_linenumber) AS y FROM part JOIN lineitem ON l_partkey = p_partkey "
    f"GROUP BY ALL), tags(tag, pos) AS (SELECT * FROM {_values(B.BRAND_TAGS)} v(tag, pos)), "
    f"vectors AS (SELECT id, CAST(pos AS BIGINT) * {_BP.spread} AS x, y FROM scored JOIN tags USING (tag)), "
    f"c AS (SELECT CAST(i AS INTEGER) AS k, i % 15 * 50000 + i % 7 - 3 AS cx, i * 37 % 401 AS cy FROM range({len(B.MANY_CENTRES)}) t(i)), "
    f"{_assign('near', 'c')} SELECT id, x, y, k FROM near")

FIT = f"{SEED_CTES}, {_rounds(_P.max_iter)}"
_CF = f"c{_P.max_iter}"
STATS = (
    f"{FIT}, {_assign('af', _CF)}, "
    "kx AS (SELECT k, x, count(*) AS n FROM af GROUP BY k, x), "
    "dom AS (SELECT k, x, n AS top, size FROM (SELECT k, x, n, CAST(sum(n) OVER (PARTITION BY k) AS BIGINT) AS size, "
    "row_number() OVER (PARTITION BY k ORDER BY n DESC, x) AS rn FROM kx) WHERE rn = 1), "
    "med AS (SELECT k, CAST(trunc(median(y)) AS BIGINT) AS median_score FROM af GROUP BY k), "
    "stats AS (SELECT d.k, t.tag, CAST((d.top * 100) // d.size AS DOUBLE) AS pct, d.size, m.median_score "
    f"FROM dom d JOIN med m USING (k) JOIN tags t ON t.pos = d.x // {_SPREAD})")

_SQL["posting_line_parse"] = f"WITH {POSTINGS} SELECT * FROM postings"
_SQL["posting_file_read"] = _SQL["posting_line_parse"]
_SQL["posting_valid"] = f"WITH {POSTINGS}, {VALID} SELECT * FROM valid"
# written out over the two tables: the plain join needs nothing of the rest
_SQL["qa_pairs"] = (
    "SELECT CAST(o_orderkey AS BIGINT) AS qid, "
    "CAST(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS VARCHAR) AS tags, "
    f"CAST({B.ANSWER_ID_BASE} + l_orderkey * 10 + l_linenumber AS BIGINT) AS answer_id, "
    f"CAST(CAST(trunc(l_quantity) AS BIGINT) - {B.SCORE_OFFSET} AS BIGINT) AS answer_score "
    "FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber <> 7 AND l_returnflag <> 'R'")
_SQL["qa_groups"] = (f"{POSTING_CTES} SELECT qid, count(*) AS n_answers, min(answer_id) AS min_answer_id, "
                     "max(answer_id) AS max_answer_id FROM pairs GROUP BY qid")
# no order has more answers than one part holds
_SQL["qa_grouped_pairs"] = (
    f"{POSTING_CTES} SELECT qid, CAST(0 AS BIGINT) AS part, count(*) AS n_answers, "
    "string_agg(answer_id || ':' || answer_score, ',' ORDER BY answer_id, answer_score) AS answers FROM pairs GROUP BY qid")
_SQL["question_max_score"] = f"{POSTING_CTES} SELECT qid, tags, max_score FROM scored"
_SQL["duplicate_questions"] = (f"WITH {POSTINGS}, {VALID} SELECT id AS qid, count(*) AS n FROM valid "
                               "WHERE posting_type = 1 GROUP BY id HAVING count(*) > 1")
_SQL["tag_score_vectors"] = f"{POSTING_CTES} SELECT id, x, y FROM vectors"
_SQL["seed_sample_per_tag"] = f"{SEED_CTES} SELECT k, id, x, y FROM seeds"
_SQL["seed_sample_global"] = (
    f"{POSTING_CTES} SELECT CAST(row_number() OVER (ORDER BY {HASH}, id) - 1 AS INTEGER) AS k, id, x, y "
    f"FROM vectors ORDER BY {HASH}, id LIMIT {_P.k}")
_SQL["nearest_centre"] = f"{SEED_CTES}, {_assign('a1', 'c0')} SELECT id, x, y, k FROM a1"
_SQL["centre_means"] = f"{SEED_CTES}, {_assign('a1', 'c0')}, {_means('m1', 'a1')} SELECT k, cx, cy, n FROM m1"
_SQL["kmeans_step"] = f"{SEED_CTES}, {_rounds(1)} SELECT k, cx, cy FROM c1"
_SQL["centre_movement"] = (
    f"{SEED_CTES}, {_rounds(1)} SELECT CAST(sum((o.cx - n.cx) * (o.cx - n.cx) + (o.cy - n.cy) * (o.cy - n.cy)) "
    "AS BIGINT) AS movement FROM c0 o JOIN c1 n USING (k)")
_SQL["kmeans_fit"] = f"{FIT} SELECT k, cx, cy FROM {_CF}"
_SQL["kmeans_fit_converged"] = f"{STILL} {_LAST}"
_SQL["kmeans_history"] = f"{STILL} SELECT DISTINCT iter, moved AS movement FROM rounds WHERE iter > 0"
_SQL["kmeans_fit_brands"] = f"{BRANDS} {_LAST}"
_SQL["cluster_dominant_tag"] = f"{STATS} SELECT k, tag FROM stats"
_SQL["cluster_percent"] = f"{STATS} SELECT k, pct FROM stats"
_SQL["cluster_median"] = f"{STATS} SELECT k, median_score FROM stats"
_SQL["cluster_summary"] = f"{STATS} SELECT k, tag, pct, size, median_score FROM stats ORDER BY median_score, k"
_SQL["cluster_report"] = (
    f"{STATS} SELECT k, format('{{:7d}}  {{:<17s}} ({{:<5.1f}}%)      {{:7d}}', median_score, tag, pct, size) "
    "AS line FROM stats")


# -- time use --------------------------------------------------------------------
RESPONDENTS = (
    "respondents AS (SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS tucaseid, "
    "CAST(l_linenumber AS DOUBLE) AS telfs, CAST(1 + l_partkey % 2 AS DOUBLE) AS tesex, "
    "CAST(l_quantity + 15 AS DOUBLE) AS teage, "
    "CAST((l_orderkey * 7 + l_partkey) % 600 AS DOUBLE) AS t010101, "
    "CAST((l_partkey * 11) % 120 AS DOUBLE) AS t110101, "
    "CAST((l_suppkey * 13 + l_orderkey) % 90 AS DOUBLE) AS t180301, "
    "CAST((l_orderkey * 3 + l_linenumber) % 480 AS DOUBLE) AS t050101, "
    "CAST((l_partkey * 5) % 45 AS DOUBLE) AS t180501, "
    "CAST((l_orderkey + l_suppkey) % 200 AS DOUBLE) AS t120301, "
    "CAST((l_partkey + l_linenumber) % 60 AS DOUBLE) AS t181201, "
    "CAST(l_linenumber AS DOUBLE) AS t500101 FROM lineitem)")
RECODES = ("CASE WHEN telfs >= 1 AND telfs < 3 THEN 'working' ELSE 'not working' END AS working, "
           "CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex, "
           "CASE WHEN teage <= 22 THEN 'young' WHEN teage <= 55 THEN 'active' ELSE 'elder' END AS age")
HOURS = ("t010101 / 60 + t110101 / 60 + t180301 / 60 AS primaryNeeds, "
         "t050101 / 60 + t180501 / 60 AS work, t120301 / 60 + t181201 / 60 AS other")
SUMMARY = f"WITH {RESPONDENTS}, summed AS (SELECT {RECODES}, {HOURS} FROM respondents WHERE telfs <= 4)"
GROUPED = (f"{SUMMARY} SELECT working, sex, age, round(avg(primaryNeeds), 1) AS primaryNeeds, "
           "round(avg(work), 1) AS work, round(avg(other), 1) AS other FROM summed "
           "GROUP BY working, sex, age ORDER BY working, sex, age")

KIND = f"CAST(tucaseid AS BIGINT) % {B.DAMAGE_CYCLE}"
_TEXT = {c: f"CAST({c} AS VARCHAR)" for c in B.RESPONDENT_COLUMNS}
_TEXT["t500101"] = f"CASE WHEN {KIND} <> 1 THEN {_TEXT['t500101']} END"
_TEXT["teage"] = f"CASE WHEN {KIND} = 3 THEN '' ELSE {_TEXT['teage']} END"
_TEXT["t110101"] = f"CASE WHEN {KIND} = 4 THEN 'n/a' ELSE {_TEXT['t110101']} END"
DAMAGED = (
    f"WITH {RESPONDENTS}, damaged AS (SELECT concat_ws(',', {', '.join(_TEXT.values())}, "
    f"CASE WHEN {KIND} = 2 THEN '9' END) AS line, "
    f"CASE {KIND} WHEN 1 THEN 'too few fields' WHEN 2 THEN 'too many fields' WHEN 3 THEN 'missing number' "
    "WHEN 4 THEN 'malformed number' ELSE 'accepted' END AS reason, "
    f"CASE {KIND} WHEN 3 THEN 'teage' WHEN 4 THEN 't110101' END AS \"column\" FROM respondents)")
_SQL["wide_lenient_rows"] = f"WITH {RESPONDENTS} SELECT * FROM respondents WHERE {KIND} NOT IN (1, 2, 3, 4)"
_SQL["wide_lenient_rejects"] = f"{DAMAGED} SELECT line, reason, \"column\" FROM damaged WHERE reason <> 'accepted'"
_SQL["wide_lenient_counts"] = f"{DAMAGED} SELECT reason, \"column\", count(*) AS n FROM damaged GROUP BY ALL"
_UNREAD = {"t500101": 1, "teage": 3, "t110101": 4}
_SQL["wide_permissive_counts"] = (
    f"WITH {RESPONDENTS} SELECT count(*) AS n_lines, count(*) FILTER ({KIND} IN (1, 2, 3, 4)) AS n_corrupt, "
    + ", ".join(f"count({c}) FILTER ({KIND} <> {_UNREAD.get(c, -1)}) AS n_{c}" for c in B.RESPONDENT_COLUMNS[1:])
    + " FROM respondents")
_SQL["wide_file_read"] = f"WITH {RESPONDENTS} SELECT * FROM respondents"
_SQL["wide_read"] = f"WITH {RESPONDENTS} SELECT * FROM respondents"
_SQL["respondent_recode"] = f"WITH {RESPONDENTS} SELECT tucaseid, {RECODES} FROM respondents"
_SQL["activity_hours"] = f"WITH {RESPONDENTS} SELECT tucaseid, {HOURS} FROM respondents"
_SQL["respondent_summary"] = f"{SUMMARY} SELECT * FROM summed"
_SQL["summary_grouped"] = GROUPED
_SQL["summary_grouped_sql"] = GROUPED
_SQL["summary_grouped_typed"] = GROUPED


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
