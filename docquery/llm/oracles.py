"""DuckDB SQL for the queries that SQL can express."""

from docquery.llm import linerules
from docquery.llm.licences import COMMENT, LINES_TOGETHER, SPDX, TEMPLATES, THRESHOLD

# A word, as the contract of the line rules says.
_WORD = r"[^\x20\x09-\x0D]+"
_TEMPLATE_ROWS = ", ".join(f"({i}, '{name}', '{body}')" for i, (name, body) in enumerate(TEMPLATES))

SQL = {
    "op3_licence_scan": rf"""
with files as (
    select doc_id, coalesce(text, '') as text,
        case when doc_id % 97 = 0 then source || '/LICENSE-' || doc_id || '.txt'
             when doc_id % 40 = 0 then source || '/' || lang || '/' || (doc_id % 50) || '/LICENSE-' || doc_id || '.txt'
             else source || '/' || lang || '/' || (doc_id % 50) || '/' || doc_id || '.txt' end as path
    from documents
), templates(t, licence, body) as (values {_TEMPLATE_ROWS}),
template_tf as (
    select t, licence, term, count(*) as tf
    from (select t, licence, unnest(string_split_regex(lower(body), '[^a-z0-9]+')) as term from templates)
    where term <> '' group by all
), cut as (
    select path, text, string_split(text, chr(10)) as lines,
        regexp_matches(lower(regexp_extract(path, '([^/]*)$', 1)), '^(licen[cs]e|copying|notice)([^a-z].*)?$') as whole
    from files
), headed as (
    select *, list_position(list_transform(lines, lambda x: regexp_matches(x, '{COMMENT}')), false) as code from cut
), parts as (
    select path, pos * 8 + width as n, array_to_string(lines[pos:pos + width - 1], chr(10)) as part
    from (select path, lines, width, unnest(range(1, len(lines) - width + 2)) as pos
        from cut, range(1, {LINES_TOGETHER + 1}) w(width) where len(lines) >= width)
    union all select path, 1, array_to_string(lines[:coalesce(code - 1, len(lines))], chr(10)) from headed
        where coalesce(code - 1, len(lines)) > {LINES_TOGETHER}
    union all select path, 2, text from cut where whole
), part_terms as (
    select path, n, term, count(*) as tf
    from (select path, n, unnest(string_split_regex(lower(part), '[^a-z0-9]+')) as term from parts)
    where term <> '' group by all
), seen as (
    select term, count(distinct path) as n
    from (select path, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) as term from files) where term <> '' group by term
), idf as (
    select term, ln(((select count(*) from files) + 1) / (coalesce(s.n, 0) + 1)) + 1 as idf
    from seen s full join (select distinct term from template_tf) using (term)
), template_size as (
    select t, sqrt(sum(tf * idf * tf * idf)) as size from template_tf join idf using (term) group by t
), weighted as (select path, n, term, tf * idf as w from part_terms join idf using (term)),
part_size as (select path, n, sqrt(sum(w * w)) as size from weighted group by all),
scored as (
    select w.path, m.licence, round(sum(w.w * m.tf * i.idf) / any_value(s.size) / any_value(l.size), 6) as score
    from weighted w join template_tf m on m.term = w.term join idf i on i.term = w.term
    join template_size s on s.t = m.t join part_size l on l.path = w.path and l.n = w.n
    group by w.path, w.n, m.t, m.licence
), tagged as (
    select path, licence, 1.0 as score
    from (select path, unnest(regexp_extract_all(text, '{SPDX}', 1)) as tag from files)
    join (select distinct licence from templates) on lower(licence) = lower(tag)
), own as (
    select path, licence as own_licence, score as own_score
    from (select * from scored where score >= {THRESHOLD} union all select * from tagged)
    qualify row_number() over (partition by path order by score desc, licence) = 1
), given as (
    select regexp_extract(path, '^(.*)/[^/]*$', 1) as above, min_by(own_licence, path) as given
    from own where regexp_matches(lower(regexp_extract(path, '([^/]*)$', 1)), '^(licen[cs]e|copying|notice)([^a-z].*)?$')
    group by above
), placed as (select *, regexp_extract(path, '^(.*)/[^/]*$', 1) as directory from files),
nearest as (
    select d.directory, max_by(g.above, length(g.above)) as above, max_by(g.given, length(g.above)) as given
    from (select distinct directory from placed) d
    join given g on d.directory = g.above or g.above = '' or starts_with(d.directory, g.above || '/')
    group by d.directory
)
select doc_id, p.path, own_licence, own_score, coalesce(own_licence, given) as licence,
    case when own_licence is null then above end as inherited_from
from placed p left join own o on o.path = p.path left join nearest d on d.directory = p.directory
""",
    "op4_line_rules": rf"""
with docs as (
    select doc_id, coalesce(text, '') as text, coalesce(source, '') as host, row_number() over () as rid from documents
), words as (
    select rid, unnest(list) as word, generate_subscripts(list, 1) as pos
    from (select rid, regexp_extract_all(text, '{_WORD}') as list from docs)
), counts as (
    select rid, count(*) as n_words, sum(length(word)) as word_chars from words group by rid
), runs as (
    select rid, pos, list(word) over (partition by rid order by pos rows between current row and 7 following) as run
    from words
), twice as (
    select rid, pos from runs where len(run) = 8
    qualify count(*) over (partition by rid, run) > 1
), repeated as (
    select rid, count(distinct pos + i) as n_repeat_words from twice, range(8) t(i) group by rid
), lines as (
    select rid, host, text, line, pos, len(regexp_extract_all(line, '{_WORD}')) as n,
        array_to_string(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}'), ' ') as norm
    from (select rid, host, text, unnest(list) as line, generate_subscripts(list, 1) as pos
        from (select rid, host, text, string_split(text, chr(10)) as list from docs))
    where regexp_matches(line, '{_WORD}')
), duplicates as (
    select rid, count(*) - count(distinct line) as n_dup_lines from lines group by rid
), hosts as (select host, count(distinct text) as documents from docs group by host),
frequent as (
    select l.host, l.norm from lines l join hosts h on h.host = l.host
    group by l.host, l.norm, h.documents
    having count(distinct l.text) > {linerules.LEAST_DOCUMENTS}
        and count(distinct l.text) > least({linerules.SHARE_OF_HOST} * h.documents, {linerules.MOST_DOCUMENTS})
), removed as (
    select rid, sum(n) as removed_words from lines l join frequent f on f.host = l.host and f.norm = l.norm group by rid
), measured as (
    select doc_id, coalesce(n_words, 0) as n_words, cast(coalesce(word_chars, 0) as bigint) as word_chars,
        cast(length(text) - length(translate(text, '#*$%&|<>', '')) as bigint) as n_symbols,
        coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
        cast(coalesce(removed_words, 0) as bigint) as removed_words
    from docs left join counts using (rid) left join duplicates using (rid) left join repeated using (rid)
    left join removed using (rid)
)
select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and removed_words <= {linerules.MOST_REMOVED} * n_words as kept
from measured
""",
    "op6_chat_format": """
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked as (
    select *,
        coalesce(lag(role) over w = role, false) as goes_on,
        coalesce(lead(role) over w = role, false) as stays,
        replace(replace(role, '&', '&amp;'), '<', '&lt;') as role_out,
        replace(replace(text, '&', '&amp;'), '<', '&lt;') as text_out
    from turns window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    cast(sum(case when goes_on then length('<|next|>') else length('<|turn|><|text|>') + length(role_out) end
        + length(text_out) + case when stays then 0 else length('<|end|>') end) as bigint) as formatted_chars
from marked group by conv_id
""",
    "op10_lsh_forest": rf"""
with recursive docs as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as words
    from documents
), shingles as (
    select distinct doc_id, unnest(case when len(words) = 1 then words
        else list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) end) as shingle
    from docs where len(words) > 0
), sets as (
    select doc_id, count(*) as n, md5(string_agg(shingle, chr(10) order by shingle)) as digest from shingles group by doc_id
), classes as (select digest, min(doc_id) as node, any_value(n) as n from sets group by digest),
members as (select node, shingle from classes join shingles on shingles.doc_id = classes.node),
pairs as (
    select a.node as u, b.node as v, count(*) as shared from members a join members b using (shingle)
    where a.node < b.node group by all
), links as (
    select u, v from pairs join classes cu on cu.node = u join classes cv on cv.node = v
    where 100 * shared >= 80 * (cu.n + cv.n - shared)
), both_ways as (select u, v from links union all select v, u from links),
reach as (
    select node, node as root from classes
    union select b.v, r.root from reach r join both_ways b on b.u = r.node
), named as (select node, min(root) as component_id from reach group by node)
select d.doc_id, coalesce(s.n, 0) as n_shingles, coalesce(m.component_id, d.doc_id) as component_id,
    coalesce(m.component_id, d.doc_id) = d.doc_id as kept
from docs d left join sets s using (doc_id) left join classes c using (digest) left join named m using (node)
""",
    "op12_phrases": r"""
with docs as (
    select row_number() over () as rid, coalesce(lang, 'und') as lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
), pieces as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words
    from (select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from docs)
), counted as (
    select lang, size as words, phrase, count(*) as n
    from (select lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: array_to_string(words[i:i + size - 1], ' '))) as phrase
        from pieces, range(1, 5) t(size) where len(words) >= size)
    group by all
), totals as (select lang, cast(sum(n) as bigint) as n from counted where words = 1 group by lang),
frequent as (select * from counted where n >= 30),
covering as (
    select lang, inner_phrase, max(n) as n from (
        select lang, n, phrase, unnest(list_transform(range(1, words - size + 2), lambda i: array_to_string(string_split(phrase, ' ')[i:i + size - 1], ' '))) as inner_phrase
        from frequent, range(2, 4) t(size) where words > size)
    group by all
), kept as (
    select f.* from frequent f left join covering c on c.lang = f.lang and c.inner_phrase = f.phrase
    where f.words >= 2 and (c.n is null or 100::hugeint * c.n < 80::hugeint * f.n)
), cuts as (
    select k.lang, k.phrase, k.n as a, cut, x.n as l, y.n as r, (2000000::hugeint * k.n) // (x.n + y.n) as score
    from (select *, unnest(range(1, words)) as cut from kept) k
    join frequent x on x.lang = k.lang and x.phrase = array_to_string(string_split(k.phrase, ' ')[:cut], ' ')
    join frequent y on y.lang = k.lang and y.phrase = array_to_string(string_split(k.phrase, ' ')[cut + 1:], ' ')
), lowest as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest
)
select r.lang, rank, phrase, a, l, r.r, t.n, cast(score as bigint) as score
from ranked r join totals t on t.lang = r.lang where rank <= 2000
""",
    "op13_prefix_trie": """
with ordered as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, md5(said)) as pos, said, size from (
        select conv_id, turn, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') as said,
            strlen(coalesce(text, '')) as size
        from conversations where conv_id is not null)
), ids as (
    select conv_id, list_reduce(
        list_concat([4294967295::bigint], flatten(list_transform(string_split(conv_id::varchar, ''),
            lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end) as crc
    from (select distinct conv_id from ordered)
), taken as (select conv_id, xor(crc, 4294967295) % 9 as h from ids),
rebuilt as (
    select t.conv_id, o.pos, o.said, o.size from taken t join ordered o on o.conv_id = t.conv_id - t.conv_id % 5 and o.pos <= t.h
    union all select t.conv_id, 1000000 + o.pos, o.said, o.size from taken t join ordered o on o.conv_id = t.conv_id and o.pos > t.h
), numbered as (
    select conv_id, row_number() over (partition by conv_id order by pos) as depth, said, size from rebuilt
), steps as (
    select conv_id, depth, size, list(md5(said)) over (partition by conv_id order by depth) as path from numbered
    union all select conv_id, 0, 0, [] from taken
), lengths as (select conv_id, max(depth) as length from steps group by conv_id),
nodes as (
    select s.path, s.depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(s.size) as own,
        coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (l.length = s.depth), '') as ends
    from steps s join lengths l using (conv_id) group by s.path, s.depth
), families as (
    select n.*, p.conv_id as parent_conv_id, (select count(*) from nodes c where c.depth = n.depth + 1 and c.path[:n.depth] = n.path) as n_children
    from nodes n left join nodes p on n.depth > 0 and p.depth = n.depth - 1 and p.path = n.path[:n.depth - 1]
), sums as (
    select path[:d] as path, sum(own) as saved, count(*) filter (n_children = 0) as leaves
    from (select *, unnest(range(depth + 1)) as d from families) group by path[:d]
)
select conv_id, depth, parent_conv_id, n_convs, n_children, leaves as n_leaves, cast(saved as bigint) as saved_tokens,
    sha256(ends) as ends_sha256
from families join sums using (path)
""",
}
