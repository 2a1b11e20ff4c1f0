"""The registered queries restated as DuckDB SQL, as an independent check of their results."""
from __future__ import annotations

from docquery.functions.guards import (
    BLOCKED_TEXT, INJECTION_JUDGED, INJECTION_PATTERNS, INJECTION_REASON, PII_PATTERNS,
    TOXIC_TERMS, TOXICITY_REASON,
)
from docquery.functions.sqlscreen import (
    AGGREGATE_WORDS, BROAD_SCAN, DENIED, EMPTY, NO_RISK, NOT_SELECT, ROUTE_WORDS, STACKED,
    STACKED_AT_RUN, WRITE_WORDS, WRITES,
)
from docquery.functions.text import WHITESPACE
from docquery.operators.rerank import B, K1, SPREAD
from docquery.operators.telemetry import LATENCY_BOUNDS, SCORE_BOUNDS
from docquery.plans.inputs import QUESTIONS, STATEMENTS
from docquery.settings import DEFAULTS

SQL: dict[str, str] = {}
DIM = DEFAULTS.embed_dim


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


BLANK = lit(WHITESPACE)
EDGE_BEFORE, EDGE_AFTER = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"


def cycle(number: str, texts: list[str]) -> str:
    arms = " ".join(f"when {i} then {lit(t)}" for i, t in enumerate(texts))
    return f"case {number} % {len(texts)} {arms} end"


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes)


# ---- derived inputs ----------------------------------------------------------

STATEMENT_LOG = f"""
log as (select event_id, {cycle('event_id', QUESTIONS)} as question,
  {cycle('event_id', STATEMENTS)} as raw_sql from events)"""

ANSWER_LOG = """
alog as (select event_id, ts,
  case when event_type in ('purchase','signup') then 'structured' else 'documents' end as route,
  case event_id % 10 when 0 then 'blocked' when 1 then 'frozen' when 2 then 'denied' else 'executed' end as status,
  value / 100 as latency, (event_id % 101) / 100 as top_score, event_id % 7 = 0 as pii_masked
  from events)"""

APPROVALS = """
asked as (select user_id as request_id, ts, event_id as seq,
  case event_type when 'purchase' then 'request' when 'click' then 'approve' when 'error' then 'deny' end as kind,
  c.question, case when c.error is null then c.cleaned end as sql, coalesce(r.reasons, '') as reasons
  from events join checked c using (event_id) left join risk r using (event_id) where event_type in ('purchase','click','error')),
appr as (select request_id, ts, seq, kind, case when kind = 'request' then question end as question,
  case when kind = 'request' then sql end as sql, case when kind = 'request' then reasons end as reasons from asked),
appr_n as (select *, row_number() over (partition by request_id order by ts, seq) as n from appr),
appr_l as (select request_id, n as lr, ts as created_at, question, sql, reasons from appr_n where kind = 'request'
  qualify row_number() over (partition by request_id order by n desc) = 1),
resolved as (select l.request_id, l.question, l.sql, l.reasons,
  coalesce((select case arg_min(kind, n) when 'approve' then 'approved' when 'deny' then 'denied' end
    from appr_n a where a.request_id = l.request_id and a.n > l.lr), 'pending') as status,
  l.created_at from appr_l l)"""

TRANSCRIPTS = """
md as (select 'conv-' || conv_id as source,
  '# Conversation ' || conv_id || chr(10) || chr(10) || string_agg(
    '## ' || role || ' ' || turn || chr(10) || text, chr(10) || chr(10) order by turn) as text
  from conversations group by conv_id)"""

DOCUMENTS = "docs as (select doc_id::varchar as source, text from documents)"
CORPUS = f"{DOCUMENTS},{TRANSCRIPTS},\ncorpus as (select * from docs union all select * from md)"


# ---- chunking ----------------------------------------------------------------


def sections(texts: str) -> str:
    """`secs(source, section_no, title, body)` of `texts`, line by line."""
    return rf"""
line as (select source, unnest(lines) as line, generate_subscripts(lines, 1) as i from (
  select source, string_split(regexp_replace(text, '\r\n|[\r\x0b\x0c\x1c-\x1e\x85\x{{2028}}\x{{2029}}]', chr(10), 'g'), chr(10)) as lines from {texts})),
headed as (select *, regexp_matches(line, '^#{{1,6}}\s') as is_head from line),
grouped as (select *, sum(is_head::int) over (partition by source order by i) as g from headed),
secs_all as (select source, g,
  coalesce(max(trim(regexp_extract(line, '^#{{1,6}}(\s.*)$', 1), {BLANK})) filter (is_head), '(intro)') as title,
  trim(string_agg(line, chr(10) order by i), {BLANK}) as body from grouped group by source, g),
secs as (select source, (row_number() over (partition by source order by g) - 1)::int as section_no, title, body
  from secs_all where body <> '')"""


def split_levels(start: str, name: str) -> str:
    """Level-by-level splitting of `start(source, g, size, piece)` into `name(source, g, n, piece)`."""
    ctes = [f"{name}_0 as (select source, g, size, [0] as ord, piece from {start})"]
    for i, sep in enumerate(["\n\n", "\n", ". ", " "], start=1):
        s = lit(sep)
        w = len(sep)
        joined = "case when a.open = '' then x.open else a.open || " + s + " || x.open end"
        width = f"case when a.open = '' then length(x.open) else length(a.open) + {w} + length(x.open) end"
        fold = f"""list_reduce(list_transform(string_split(piece, {s}), lambda p: {{'done': []::varchar[], 'open': p}}),
  lambda a, x: case when {width} <= size then {{'done': a.done, 'open': {joined}}}
    when length(x.open) > size then {{'done': list_concat(case when a.open = '' then a.done else list_append(a.done, a.open) end, [x.open]), 'open': ''}}
    else {{'done': case when a.open = '' then a.done else list_append(a.done, a.open) end, 'open': x.open}} end,
  {{'done': []::varchar[], 'open': ''}})"""
        ctes.append(f"""{name}_{i}f as (select source, g, size, ord, piece, case when length(piece) <= size then null else {fold} end as f from {name}_{i - 1}),
{name}_{i} as (select source, g, size, list_append(ord, generate_subscripts(ps, 1)) as ord, unnest(ps) as piece from (
  select source, g, size, ord, case when f is null then [piece] when f.open = '' then f.done else list_append(f.done, f.open) end as ps from {name}_{i}f))""")
    ctes.append(f"""{name}_c as (select source, g, list_append(ord, generate_subscripts(ps, 1)) as ord, unnest(ps) as piece from (
  select source, g, ord, list_transform(range(0, greatest(length(piece), 1), size), lambda b: substr(piece, b::bigint + 1, size)) as ps from {name}_4)),
{name} as (select source, g, row_number() over (partition by source, g order by ord) - 1 as n, piece from {name}_c)""")
    return ",\n".join(ctes)


def plain(texts: str, name: str) -> str:
    """`name(source, n, chunk)`: stripped pieces with the tail of the one before."""
    return f"""
{name}_s as (select source, 0 as g, {DEFAULTS.chunk_size} as size, trim(text, {BLANK}) as piece from {texts}),
{split_levels(f'{name}_s', f'{name}_p')},
{name}_t as (select source, trim(piece, {BLANK}) as piece, n from {name}_p),
{name} as (select source, row_number() over w - 1 as n,
  case when lag(piece) over w is null then piece else right(lag(piece) over w, {DEFAULTS.chunk_overlap}) || ' ' || piece end as chunk
  from {name}_t where piece <> '' window w as (partition by source order by n))"""


# `chunks(source, chunk_no, child, parent, title)` of the whole corpus
CHUNKS = f"""{CORPUS},{sections('corpus')},
multi as (select source from secs group by source having count(*) > 1),
flat as (select * from corpus where source not in (select source from multi)),
{plain('flat', 'pc')},
child_s as (select source, section_no as g, {DEFAULTS.child_size} as size, body as piece from secs where source in (select source from multi)),
{split_levels('child_s', 'cp')},
children as (select c.source, c.g, c.n, trim(c.piece, {BLANK}) as child, s.body as parent, s.title
  from cp c join secs s on s.source = c.source and s.section_no = c.g where trim(c.piece, {BLANK}) <> ''),
chunks as materialized (select source, n::int as chunk_no, chunk as child, chunk as parent, '(document)' as title from pc
  union all select source, (row_number() over (partition by source order by g, n) - 1)::int, child, parent, title from children)"""

SQL["markdown_sections"] = with_(TRANSCRIPTS, sections("md")) + "\nselect source, section_no, title, body from secs"
SQL["recursive_split"] = (
    with_(DOCUMENTS, "st as (select source, 0 as g, 350 as size, text as piece from docs)", split_levels("st", "rs"))
    + "\nselect source, n::int as piece_no, piece from rs"
)
SQL["chunk_overlap"] = f"""select doc_id::varchar as source, (i - 1)::int as chunk_no,
  case when i = 1 then parts[i] else right(parts[i - 1], {DEFAULTS.chunk_overlap}) || ' ' || parts[i] end as chunk
  from (select doc_id, parts, unnest(range(1, len(parts) + 1)) as i from (select doc_id, string_split(text, chr(10)) as parts from documents))"""
SQL["plain_chunks"] = with_(DOCUMENTS, plain("docs", "pc")) + "\nselect source, n::int as chunk_no, chunk from pc"
SQL["parent_child_chunks"] = with_(CHUNKS) + "\nselect source, chunk_no, child, parent, title from chunks"
SQL["ingest_counts_by_source"] = with_(CHUNKS) + "\nselect source, count(*) as n_chunks from chunks group by source"
SQL["ingest_counts_stream"] = SQL["ingest_counts_by_source"] + " having source like 'conv-%'"
SQL["index_write_read"] = (
    with_(CHUNKS)
    + "\nselect source, 2 * count(*) as n_rows, 2 * count(*) as n_ids, count(*) as n_chunks from chunks where source like 'conv-%' group by source"
)
SQL["index_fingerprint_check"] = (
    with_(CHUNKS) + "\nselect count(*) as n_chunks, true as refused from chunks where source like 'conv-%'"
)

# ---- sources -----------------------------------------------------------------

SQL["read_text_documents"] = with_(TRANSCRIPTS) + "\nselect text || chr(10) as text from md"
SQL["rejected_files"] = """select c_mktsegment as segment, 'Unsupported file type: .json' as reason,
  count(distinct coalesce(floor(c_custkey / 1000000.0)::varchar, '')) as n_files from customer group by 1"""
SQL["skipped_files"] = """select distinct c_mktsegment as segment, part, reason from customer,
  (values ('json', 'Unsupported file type: .json'), ('scans', 'No parser for file type: .pdf'), ('blank', 'No text in file')) t(part, reason)"""
SQL["rows_to_text"] = """select n_nationkey,
  'Nation | n_nationkey=' || n_nationkey || ' | n_name=' || n_name || ' | n_regionkey=' || n_regionkey as line from nation"""
SQL["rows_to_text_part"] = """select p_partkey, concat_ws(' | ', 'Part', 'p_partkey=' || p_partkey, 'p_name=' || p_name,
  'p_brand=' || p_brand, 'p_type=' || p_type, case when p_size > 10 then 'p_size=' || p_size end) as line from part"""
SQL["read_question_set"] = "select text as question, 'documents' as expected_route from benchmark"
SQL["vector_dim_check"] = "select count(*) filter (len(embedding) <> 64) as wrong from embeddings"

# ---- retrieval ---------------------------------------------------------------

WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')".format


def term_vectors(rows: str, key: str, text: str, name: str) -> str:
    """`name(key, dim, x)`: hashed word weights, as the single-precision unit vector."""
    return f"""
{name}_w as (select {key}, ('0x' || substr(md5(w), 1, 8))::bigint % {DIM} as dim, 1 + ln(count(*)) as x
  from (select {key}, unnest({WORDS(text)}) as w from {rows}) group by 1, 2),
{name} as materialized (select {key}, dim, (x / sqrt(sum(x * x) over (partition by {key})))::float::double as x from {name}_w)"""


SQL["embed_documents"] = (
    with_(DOCUMENTS, term_vectors("docs", "source", "text", "v"))
    + "\nselect source, dim::int as dim, round(x, 5) as weight from v"
)

LABEL_SCORES = """
flat as (select vec_id, label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i from embeddings),
mean as (select label, i, avg(x) as x from flat group by 1, 2),
dots as (select m.label as question_id, f.vec_id as chunk_id, f.label,
  round(sum(m.x * f.x) / (sqrt(sum(m.x * m.x)) * sqrt(sum(f.x * f.x))), 6) as score
  from flat f join mean m on m.i = f.i group by 1, 2, 3),
ranked as (select *, row_number() over (partition by question_id order by score desc, chunk_id) as cosine_rank from dots)"""
SQL["vector_top_k"] = with_(LABEL_SCORES) + "\nselect question_id, chunk_id, score, cosine_rank from ranked where cosine_rank <= 5"
SQL["rerank_top_n"] = (
    with_(LABEL_SCORES)
    + """,
scored as (select *, round(1 / (1 + exp(-case when question_id = label then 1.0 else -1.0 end)), 6) as rerank_score
  from ranked where cosine_rank <= 20),
final as (select *, row_number() over (partition by question_id order by rerank_score desc, cosine_rank) as final_rank from scored)
select question_id, chunk_id, score, rerank_score, final_rank from final where final_rank <= 5"""
)

INDEXED = f"""{CHUNKS},
ix as materialized (select sha256(concat_ws(chr(31), '0', source, chunk_no, child)) as chunk_id, * from chunks),
{term_vectors('ix', 'chunk_id', 'child', 'cv')},
cnorm as (select chunk_id, sqrt(sum(x * x)) as norm from cv group by 1),
tf as materialized (select chunk_id, w, count(*) as tf from (select chunk_id, unnest({WORDS('child')}) as w from ix) group by 1, 2),
df as (select w, count(*) as df from tf group by 1),
len as (select chunk_id, len({WORDS('child')}) as len from ix),
size as (select count(*) as n, sum(len) / count(*) as mean_len from len)"""


def found(questions: str, p: str) -> str:
    """`{p}_pool` (scored candidates) and `{p}_hit(question_id, place, …)` for `questions(question_id, query)`."""
    k, b = K1, B
    return f"""
{term_vectors(questions, 'question_id', 'query', f'{p}_qv')},
{p}_qn as (select question_id, sqrt(sum(x * x)) as norm from {p}_qv group by 1),
{p}_dot as (select q.question_id, c.chunk_id, sum(q.x * c.x) as dot from {p}_qv q join cv c on c.dim = q.dim group by 1, 2),
{p}_cos as (select d.question_id, d.chunk_id, round(dot / (q.norm * c.norm), 6) as score
  from {p}_dot d join {p}_qn q using (question_id) join cnorm c using (chunk_id)),
{p}_near as materialized (select * from (select *, row_number() over (partition by question_id order by score desc, chunk_id) as cosine_rank
  from {p}_cos) where cosine_rank <= {DEFAULTS.retrieve_k}),
{p}_terms as (select t.question_id, t.w, round(ln(1 + (n - coalesce(df, 0) + 0.5) / (coalesce(df, 0) + 0.5)), 9) as idf
  from (select distinct question_id, unnest({WORDS('query')}) as w from {questions}) t left join df using (w), size),
{p}_whole as (select question_id, sum(idf) as whole from {p}_terms group by 1),
{p}_gain as (select r.question_id, r.chunk_id,
  sum(idf * tf * ({k} + 1) / (tf + {k} * (1 - {b} + {b} * len / mean_len))) as total
  from {p}_near r join len l using (chunk_id) join {p}_terms t using (question_id)
  join tf on tf.chunk_id = r.chunk_id and tf.w = t.w, size group by 1, 2),
{p}_pool as materialized (select r.*, round(1 / (1 + exp(-case when whole > 0 then {SPREAD} * (coalesce(total, 0) / whole - 0.5) else {-SPREAD / 2} end)), 6) as rerank_score
  from {p}_near r left join {p}_whole using (question_id) left join {p}_gain g on g.question_id = r.question_id and g.chunk_id = r.chunk_id),
{p}_hit as materialized (select h.question_id, place, h.chunk_id, score, rerank_score, child, parent, title, source from (
  select *, row_number() over (partition by question_id order by rerank_score desc, cosine_rank) as place from {p}_pool) h
  join ix using (chunk_id) where place <= {DEFAULTS.top_k}),
{p}_ctx as (select question_id, string_agg('[source: ' || source || case when title <> '' then ' | section: ' || title else '' end ||
   ' | score: ' || printf('%.3f', score) || ']' || chr(10) || parent, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by place) as context
  from (select *, row_number() over (partition by question_id, parent order by place) as seen from {p}_hit) where seen = 1 group by 1),
{p}_top as (select question_id, rerank_score as top_score from {p}_hit where place = 1)"""


def covers(needle: str, haystack: str, share: float) -> str:
    n = f"list_distinct({WORDS(needle)})"
    return f"(len({n}) > 0 and len(list_intersect({n}, {WORDS(haystack)})) / len({n}) >= {share})"


BENCH = "asked as (select item_id as question_id, text as question, text as query from benchmark)"
RETRIEVED = with_(INDEXED, BENCH, found("asked", "a"))
GATE = DEFAULTS.grade_gate


def graded(questions: str, p: str) -> str:
    return f"""
{p}_grade as materialized (select *, relevant_ as relevant,
  case when passed then 'top score ' || printf('%.3f', top_score) || ' >= {GATE} (pre-gate)'
    else 'top score ' || printf('%.3f', top_score) || ' below gate; LLM judge said ' || case when relevant_ then 'yes' else 'no' end end as reason
  from (select q.question_id, q.question, q.query, t.top_score, t.top_score >= {GATE} as passed,
    t.top_score >= {GATE} or {covers('q.question', 'c.context', 0.5)} as relevant_
    from {questions} q join {p}_top t using (question_id) join {p}_ctx c using (question_id)))"""


def corrected(questions: str, p: str) -> str:
    """`{p}_final` after one retry of the weak questions, with the hits in `{p}_fhit`."""
    longer = f"list_filter({WORDS('question')}, lambda x: length(x) >= 4)"
    return f"""{found(questions, p + '1')},{graded(questions, p + '1')},
{p}_w as (select question_id, question, unnest({longer}) as w, generate_subscripts({longer}, 1) as i from {p}1_grade where not relevant),
{p}_retry as (select question_id, question, string_agg(w, ' ' order by i) as query from (
  select question_id, question, w, min(i) as i from {p}_w group by 1, 2, 3) group by 1, 2),
{found(f'{p}_retry', p + '2')},{graded(f'{p}_retry', p + '2')},
{p}_final as materialized (select question_id, question, top_score, 1 as attempts, relevant, reason, null::varchar as rewritten from {p}1_grade where relevant
  union all select question_id, question, top_score, 2, relevant, reason, query from {p}2_grade),
{p}_fhit as (select h.* from {p}1_hit h join {p}1_grade g using (question_id) where g.relevant union all select * from {p}2_hit)"""


SQL["lexical_scores"] = RETRIEVED + """
select question_id, source, chunk_id, cosine_rank, score, rerank_score from a_pool join ix using (chunk_id)"""
SQL["two_stage_retrieve"] = RETRIEVED + """
select question_id, place, chunk_id, child as text, score, source, parent, title, rerank_score from a_hit"""
SQL["top_score"] = RETRIEVED + "\nselect question_id, top_score from a_top"
SQL["context_blocks"] = RETRIEVED + "\nselect question_id, context from a_ctx"
SQL["grounded_prompts"] = RETRIEVED + """
select question_id, 'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question: ' || question as prompt
  from a_ctx join asked using (question_id)"""
SQL["linear_answers"] = RETRIEVED + """
select question_id, rerank_score as top_score, 1 as attempts, parent || ' [' || source || ']' as text from a_hit where place = 1"""
SQL["grade_retrieval"] = RETRIEVED + "," + graded("asked", "a") + """
select question_id, top_score, relevant, reason, not passed as used_llm from a_grade"""
CORRECTED = with_(INDEXED, BENCH, corrected("asked", "c"))
SQL["correction_loop"] = CORRECTED + """
select question_id, top_score, attempts, relevant as graded_relevant, reason as grade_reason, rewritten as rewritten_query, hit_ids
  from c_final join (select question_id, string_agg(chunk_id, ',' order by place) as hit_ids from c_fhit group by 1) using (question_id)"""

# ---- routing and statements --------------------------------------------------


def word(text: str, alternatives: str) -> str:
    return rf"regexp_matches({text}, '(?i)\b({alternatives})\b')"


SQL["route_questions"] = with_(STATEMENT_LOG) + f"""
select event_id, case when {word('question', ROUTE_WORDS)} then 'structured' else 'documents' end as route from log"""

FENCE = r"(?is)^```(?:sql)?\s*(.*?)\s*```$"
CHECKED = f"""
fenced as (select *, trim(raw_sql, {BLANK}) as t from log),
bare as (select *, trim(case when regexp_matches(t, {lit(FENCE)}) then regexp_extract(t, {lit(FENCE)}, 1) else t end, '` ' || chr(10)) as unfenced from fenced),
clean as (select *, trim(rtrim(trim(unfenced, {BLANK}), ';'), {BLANK}) as cleaned from bare),
checked as (select *, case when cleaned = '' then {lit(EMPTY)} when contains(cleaned, ';') then {lit(STACKED)}
  when not (lower(cleaned) like 'select%' or lower(cleaned) like 'with%') then {lit(NOT_SELECT)}
  when {word('cleaned', WRITE_WORDS)} then {lit(WRITES)} end as error from clean)"""
SQL["strip_sql_fences"] = with_(STATEMENT_LOG, CHECKED) + "\nselect event_id, unfenced as sql from checked"
SQL["validate_sql_log"] = with_(STATEMENT_LOG, CHECKED) + """
select event_id, error is null as valid, case when error is null then cleaned end as sql, error from checked"""
SQL["execution_check_log"] = with_(STATEMENT_LOG) + f"""
select event_id, error is null as executable, error from (
  select event_id, case when contains(t, ';') then {lit(STACKED_AT_RUN)} when not lower(t) like 'select%' then {lit(NOT_SELECT)} end as error
  from (select event_id, trim(rtrim(trim(raw_sql, {BLANK}), ';'), {BLANK}) as t from log))"""
RISK = f"""
risk as (select *, array_to_string(list_filter([
  case when {word('lower(cleaned)', 'salary')} then 'reads sensitive column ''salary''' end,
  case when {word('lower(cleaned)', 'o_totalprice')} then 'reads sensitive column ''o_totalprice''' end,
  case when not {word('cleaned', AGGREGATE_WORDS + '|where|limit')} then {lit(BROAD_SCAN)} end], lambda x: x is not null), '; ') as reasons
  from checked where error is null)"""
SQL["risk_flags"] = with_(STATEMENT_LOG, CHECKED, RISK) + f"""
select event_id, reasons <> '' as risky, reasons, case when reasons = '' then {lit(NO_RISK)} else reasons end as summary from risk"""
SQL["guarded_select"] = f"""select c_custkey, c_name, c_acctbal from customer order by c_acctbal desc, c_custkey limit {DEFAULTS.sql_max_rows}"""

RESULTS = f"""
results as (
  select {lit(STATEMENTS[0])} as cleaned, 1 as row_count, '[{{"n":' || count(*) || '}}]' as rows_json, null as failure from orders
  union all select {lit('SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus ORDER BY o_orderstatus')},
    count(*)::int, '[' || string_agg('{{"o_orderstatus":"' || o_orderstatus || '","n":' || n || '}}', ',' order by o_orderstatus) || ']', null
    from (select o_orderstatus, count(*) as n from orders group by 1)
  union all select {lit(STATEMENTS[2])}, 0, null, 'query failed to execute: {NOT_SELECT}'
  union all select {lit(STATEMENTS[7])}, count(*)::int, '[' || string_agg('{{"n_name":"' || n_name || '"}}', ',' order by n_name) || ']', null
    from (select n_name from nation order by n_name limit 5)
  union all select {lit(STATEMENTS[8].rstrip(';'))}, count(*)::int,
    '[' || string_agg('{{"c_mktsegment":"' || c_mktsegment || '","n":' || n || '}}', ',' order by c_mktsegment) || ']', null
    from (select c_mktsegment, count(*) as n from customer group by 1)
  union all select {lit(STATEMENTS[11])}, 0, null, 'query failed to execute: TABLE_OR_VIEW_NOT_FOUND'
  union all select {lit(STATEMENTS[12])}, 0, null, 'query failed to execute: expression is not allowed: ExpressionWithUnresolvedIdentifier'
  union all select {lit(STATEMENTS[13])}, 0, null, 'query failed to execute: TABLE_OR_VIEW_NOT_FOUND'
  union all select {lit(STATEMENTS[5])}, count(*)::int,
    '[' || string_agg('{{"o_orderkey":' || o_orderkey || ',"o_totalprice":' || o_totalprice || '}}', ',' order by o_orderkey) || ']', null
    from (select * from orders where o_orderkey < 10 order by o_orderkey limit {DEFAULTS.sql_max_rows})
  union all select {lit(STATEMENTS[6])}, least(count(*), {DEFAULTS.sql_max_rows})::int, null, null from customer)"""
UNSAFE = "could not generate a safe query"


def answered(status: str, sql: str) -> str:
    """The text of a request that was carried out; null where the statement leaves open which rows it returns."""
    refused = "'I couldn''t answer that from the database (' || {} || ').'"
    return (
        f"case when {status} = 'denied' then {refused.format(lit(DENIED))} "
        f"when {sql} is null then {refused.format(lit(UNSAFE))} "
        f"when failure is not null then {refused.format('failure')} else rows_json end"
    )



BRANCH = f"""
branch as (select c.event_id, c.question, case when c.error is null then c.cleaned end as sql,
  case when r.reasons <> '' then ''
    when c.error is not null then 'I couldn''t answer that from the database (could not generate a safe query: ' || c.error || ').'
    when failure is not null then 'I couldn''t answer that from the database (' || failure || ').'
    else rows_json end as text,
  case when r.reasons <> '' then 0 else coalesce(row_count, 0) end as row_count,
  case when r.reasons <> '' then 'frozen' else 'executed' end as status, coalesce(r.reasons, '') as risk_reason
  from checked c left join risk r using (event_id) left join results s on s.cleaned = c.cleaned and c.error is null)"""
SQL["structured_branch_status"] = with_(STATEMENT_LOG, CHECKED, RISK, RESULTS, BRANCH) + """
select event_id as request_id, sql, text, row_count, status, risk_reason from branch"""
SQL["resumed_answers"] = with_(STATEMENT_LOG, CHECKED, RISK, APPROVALS, RESULTS) + f"""
select event_id as request_id, case v.status when 'denied' then 'denied' else 'executed' end as status,
  case when v.status = 'denied' then 0 else coalesce(row_count, 0) end::int as row_count,
  k.reasons as risk_reason, {answered('v.status', 'k.cleaned')} as text
  from risk k join events using (event_id) join resolved v on v.request_id = user_id
  left join results s on s.cleaned = k.cleaned
  where k.reasons <> '' and v.status <> 'pending'"""

# ---- figures -----------------------------------------------------------------

SQL["count_filtered"] = "select count(*) as n from orders where o_orderstatus = 'F'"
SQL["count_per_group"] = "select c_mktsegment, count(*) as n from customer group by 1"
SQL["avg_per_group"] = "select c_mktsegment, round(avg(c_acctbal), 6) as avg_value from customer group by 1"
SQL["median_per_group"] = "select l_returnflag, round(median(l_extendedprice), 6) as median_value from lineitem group by 1"
SQL["sum_per_group"] = "select l_returnflag, round(sum(l_quantity), 6) as sum_value from lineitem group by 1"
SQL["arg_extreme_per_group"] = """with r as (select o_orderpriority, o_orderkey, o_totalprice,
  row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as hi,
  row_number() over (partition by o_orderpriority order by o_totalprice, o_orderkey) as lo from orders)
select o_orderpriority, o_orderkey, o_totalprice, 'highest' as which from r where hi = 1
union all select o_orderpriority, o_orderkey, o_totalprice, 'lowest' from r where lo = 1"""
SQL["most_common_group"] = """with g as (select c_nationkey, count(*) as n from customer group by 1)
(select c_nationkey, n, 'most' as which from g order by n desc, c_nationkey limit 1)
union all (select c_nationkey, n, 'least' from g order by n, c_nationkey limit 1)"""
SQL["filtered_projection"] = "select o_orderkey, o_custkey, o_totalprice from orders where o_orderpriority = '1-URGENT'"
SQL["limited_projection"] = "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10"

# ---- approvals ---------------------------------------------------------------

LEDGER = with_(STATEMENT_LOG, CHECKED, RISK, APPROVALS)
SQL["approvals_current"] = LEDGER + "\nselect request_id, created_at, question, sql, reasons from appr_l"
SQL["approvals_resolved"] = LEDGER + "\nselect request_id, question, sql, reasons, status, created_at from resolved"
SQL["approvals_pending"] = LEDGER + """
select request_id, question, sql, reasons, status, created_at from resolved where status = 'pending' order by created_at, request_id"""
SQL["approval_lookup"] = LEDGER + """
select c_custkey as request_id, question, sql, reasons, status, created_at from customer left join resolved on request_id = c_custkey"""
# A decision is carried out if the event before it is a request; a request waits if no event follows it.
SQL["approvals_stream"] = with_(STATEMENT_LOG, CHECKED, RISK, APPROVALS, RESULTS) + f""",
turns as (select *, lag(kind) over w as before, lag(ts) over w as since, lag(question) over w as asked_question,
  lag(sql) over w as asked_sql, lag(reasons) over w as asked_reasons, lead(kind) over w as after
  from appr window w as (partition by request_id order by ts, seq)),
carried as (select request_id, since as created_at, asked_question as question, asked_sql as sql, asked_reasons as reasons,
  case kind when 'approve' then 'executed' else 'denied' end as status from turns where kind <> 'request' and before = 'request')
select request_id, created_at, question, sql, reasons, status, {answered('status', 'sql')} as text,
  case when status = 'denied' then 0 else coalesce(row_count, 0) end::int as row_count
  from carried left join results s on s.cleaned = sql
union all select request_id, ts, question, sql, reasons, 'pending', null, null from turns where kind = 'request' and after is null"""

# ---- guardrails --------------------------------------------------------------

def injected(text: str) -> str:
    return f"regexp_matches({text}, {lit('(?i)' + '|'.join(INJECTION_PATTERNS))})"


def toxic(text: str) -> str:
    return f"regexp_matches({text}, {lit(f'(?i){EDGE_BEFORE}(?:' + '|'.join(TOXIC_TERMS) + f'){EDGE_AFTER}')})"


SQL["detect_injection"] = with_(STATEMENT_LOG) + f"""
select event_id, case when {injected('question')} then {lit(INJECTION_REASON)} else '' end as injection from log"""
SQL["judge_second_opinion"] = with_(STATEMENT_LOG) + f"""
select event_id, case when {injected('question')} then {lit(INJECTION_REASON)}
  when contains(lower(question), 'leave policy') then {lit(INJECTION_JUDGED)} else '' end as injection from log"""
SQL["detect_toxicity"] = f"select doc_id, case when {toxic('text')} then {lit(TOXICITY_REASON)} else '' end as toxicity from documents"

REASONS = f"""array_to_string(list_filter([case when {injected('question')} then {lit(INJECTION_REASON)} end,
  case when {toxic('question')} then {lit(TOXICITY_REASON)} end], lambda x: x is not null), '; ')"""
SQL["input_firewall"] = with_(STATEMENT_LOG) + f"""
select event_id, reasons = '' as allowed, reasons from (select event_id, {REASONS} as reasons from log)"""

# DuckDB's \b and \w know only ASCII. Other letters are spelled out in ASCII letters
# before matching, between marks that keep them words, and put back afterwards.
HEX, SPELLED = "0123456789ABCDEF", "ghijklmnopqrstuv"


def masked(rows: str, key: str, name: str) -> str:
    """`name(key, text, found)`: masked text and comma-separated entities of `rows`."""
    ctes = [f"""{name}_chars as (select {key}, text, case when regexp_matches(text, '[^\\x00-\\x7f]') then array_to_string(list_transform(string_split(text, ''),
  lambda c: case when unicode(c) > 127 and regexp_matches(c, '[\\p{{L}}\\p{{N}}]') then 'zqx' || translate(lpad(printf('%X', unicode(c)), 6, '0'), '{HEX}', '{SPELLED}') else c end), '') else text end as m from {rows})"""]
    before = f"{name}_chars"
    flags = []
    for entity, pattern in PII_PATTERNS:
        after = f"{name}_{entity.lower()}"
        kept = "".join(f", {f}" for f in flags)
        ctes.append(f"""{after} as (select {key}, regexp_replace(m, {lit(pattern)}, '[{entity}]', 'g') as m,
  regexp_matches(m, {lit(pattern)}) as has_{entity}{kept} from {before})""")
        flags.append(f"has_{entity}")
        before = after
    found = ", ".join(f"case when has_{e} then {lit(e)} end" for e, _ in PII_PATTERNS)
    ctes.append(f"""{name} as (select {key}, case when contains(m, 'zqx') then
  string_split(m, 'zqx')[1] || array_to_string(list_transform(string_split(m, 'zqx')[2:], lambda p: chr(('0x' || translate(p[1:6], '{SPELLED}', '{HEX}'))::int) || p[7:]), '') else m end as text,
  array_to_string(list_filter([{found}], lambda x: x is not null), ',') as found from {before})""")
    return ",\n".join(ctes)


SQL["mask_pii"] = with_(masked("documents", "doc_id", "masked")) + "\nselect doc_id, text, found as pii_found from masked"
OUTPUT = f"""text, found <> '' as pii_masked, {toxic('text')} as toxic,
  array_to_string(list_concat(case when found = '' then [] else list_transform(string_split(found, ','), lambda e: 'masked ' || e) end,
    case when {toxic('text')} then [{lit(TOXICITY_REASON)}] else [] end), '; ') as findings"""
SQL["output_firewall"] = with_(masked("documents", "doc_id", "masked")) + f"\nselect doc_id, {OUTPUT} from masked"

SQL["answer_batch"] = with_(
    STATEMENT_LOG, CHECKED, RISK, RESULTS, BRANCH, INDEXED,
    f"""questions as (select event_id as question_id, question from log union all select -1 - item_id, text from benchmark),
routed as (select *, {REASONS} as reasons, case when {word('question', ROUTE_WORDS)} then 'structured' else 'documents' end as way from questions),
asked as (select sha256(question) as question_id, question, question as query from (select distinct question from routed where reasons = '' and way = 'documents'))""",
    corrected("asked", "c"),
    f"""raw as (
  select r.question_id, 'documents' as route, 'executed' as status, parent || ' [' || source || ']' as text, 0 as row_count, '' as risk_reason, attempts, top_score
    from routed r join c_final f on f.question = r.question and r.way = 'documents' and r.reasons = ''
    join (select question_id as qid, parent, source from c_fhit where place = 1) h on h.qid = f.question_id
  union all select r.question_id, 'structured', b.status, b.text, b.row_count, b.risk_reason, 1, 0.0
    from routed r join branch b on b.event_id = r.question_id where way = 'structured' and r.reasons = ''
  union all select question_id, 'structured', 'executed', 'I couldn''t answer that from the database (could not generate a safe query: {EMPTY}).', 0, '', 1, 0.0
    from routed where way = 'structured' and reasons = '' and question_id < 0)""",
    masked("raw", "question_id", "out"),
) + f"""
select question_id, route, status, o.text, row_count, risk_reason, o.pii_masked, o.findings as guard_findings, attempts, top_score
  from raw join (select question_id, {OUTPUT} from out) o using (question_id)
union all select question_id, 'documents', 'blocked', {lit(BLOCKED_TEXT)}, 0, '', false, reasons, 1, 0.0 from routed where reasons <> ''"""

# ---- evaluation --------------------------------------------------------------

JUDGED = with_(
    INDEXED, BENCH, corrected("asked", "c"), STATEMENT_LOG, CHECKED,
    f"""ans as (
  select question_id, question, parent || ' [' || source || ']' as text, context, 'documents' as route
    from c_final join (select question_id, parent, source from c_fhit where place = 1) using (question_id)
    join (select question_id, string_agg(parent, chr(10) order by place) as context from c_fhit group by 1) using (question_id)
  union all select -1 - event_id, question, question, case when error is null then cleaned else '' end, 'structured' from checked),
items as (select question_id, question, route, {covers('text', 'context', 0.8)}::int::double as faithfulness,
  {covers('question', 'text', 0.3)}::int::double as answer_relevancy, {covers('question', 'context', 0.5)}::int::double as context_precision from ans)""",
)
SQL["eval_context"] = JUDGED + "\nselect question_id, context from ans"
SQL["eval_judgements"] = JUDGED + """
select question_id, faithfulness = 1 as faithfulness, answer_relevancy = 1 as answer_relevancy, context_precision = 1 as context_precision from items"""
SQL["eval_items"] = JUDGED + "\nselect * from items"
METRIC_ROWS = "\nunion all ".join(
    f"select '{m}' as metric, round(coalesce(avg({m}), 0), 6) as score, count(*) as n from items"
    for m in ("faithfulness", "answer_relevancy", "context_precision")
)
SQL["eval_scores"] = JUDGED + "\n" + METRIC_ROWS
SQL["eval_report_rows"] = JUDGED + f"\nselect metric, score from ({METRIC_ROWS})"
SQL["eval_gauges"] = SQL["eval_report_rows"]

# ---- metrics -----------------------------------------------------------------


def buckets(rows: str, value: str, bounds: list[float]) -> str:
    parts = [f"select '{b}' as le, count(*) filter ({value} <= {b}) as n" for b in bounds]
    parts.append("select '+Inf' as le, count(*) as n")
    return "\nunion all ".join(
        f"{p}, count(*) as total, round(coalesce(sum({value}), 0), 6) as value_sum from {rows}" for p in parts
    )


SQL["requests_by_route_status"] = with_(ANSWER_LOG) + "\nselect route, status, count(*) as requests from alog group by 1, 2"
SQL["requests_by_route"] = with_(ANSWER_LOG) + "\nselect route, count(*) as requests from alog group by 1"
SQL["latency_histogram"] = with_(ANSWER_LOG) + "\n" + buckets("alog", "latency", LATENCY_BOUNDS)
SQL["top_score_histogram"] = (
    with_(ANSWER_LOG, "docs as (select * from alog where route = 'documents' and status = 'executed')")
    + "\n" + buckets("docs", "top_score", SCORE_BOUNDS)
)
SQL["guard_event_counts"] = with_(ANSWER_LOG) + """
select count(*) filter (status = 'blocked') as blocks, count(*) filter (pii_masked) as pii_masked,
  count(*) filter (status = 'frozen') as freezes from alog"""
SLIDING = """
win as (select *, time_bucket(interval '1 minute', ts) - to_minutes(b::int) as window_start
  from alog, (select unnest(range(0, 5)) as b))"""
CLOSED = "window_start + interval '5 minutes' <= (select max(ts) - interval '10 minutes' from alog)"
SQL["request_rate_5m"] = with_(ANSWER_LOG, SLIDING) + """
select window_start, route, status, round(count(*) / 300, 9) as rate from win group by 1, 2, 3"""
SQL["request_rate_5m_stream"] = with_(ANSWER_LOG, SLIDING) + f"""
select window_start, route, status, round(count(*) / 300, 9) as rate from win where {CLOSED} group by 1, 2, 3"""
_LE = ", ".join(f"count(*) filter (latency <= {b}) as le_{i}" for i, b in enumerate(LATENCY_BOUNDS))
_ARMS = " ".join(
    f"when le_{i} >= 0.95 * le_{len(LATENCY_BOUNDS)} then {LATENCY_BOUNDS[i - 1] if i else 0.0} + "
    f"({b} - {LATENCY_BOUNDS[i - 1] if i else 0.0}) * ((0.95 * le_{len(LATENCY_BOUNDS)} - {f'le_{i - 1}' if i else 0})"
    f" / (le_{i} - {f'le_{i - 1}' if i else 0}))"
    for i, b in enumerate(LATENCY_BOUNDS)
)


def p95(where: str) -> str:
    return with_(ANSWER_LOG, SLIDING) + f"""
select window_start, round(case {_ARMS} else {LATENCY_BOUNDS[-1]} end, 6) as p
  from (select window_start, {_LE}, count(*) as le_{len(LATENCY_BOUNDS)} from win {where} group by 1)"""


SQL["latency_p95_5m"] = p95("")
SQL["latency_p95_5m_stream"] = p95(f"where {CLOSED}")
SQL["request_counts_stream"] = with_(ANSWER_LOG) + f"""
select window_start, route, status, count(*) as requests, count(*) filter (pii_masked) as pii_masked
  from (select *, time_bucket(interval '5 minutes', ts) as window_start from alog) where {CLOSED} group by 1, 2, 3"""
