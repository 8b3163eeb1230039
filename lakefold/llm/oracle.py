"""SQL that DuckDB runs on the same tables, for the operators that SQL can express."""

from __future__ import annotations

# Words of the mixing contract and their number per document.
_MIX_SIZES = r"""
select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size
from {documents}
"""

# The level rises until the sources that are not full take all that is left; here by trying each
# number of full sources in turn.
_MIX_TARGETS = """
s as (select source, cast(sum(size) as bigint) as source_size from sizes group by source),
w as (
  select *, [5.0::double, 2.0, 1.0][1 + ((row_number() over (order by source nulls last) - 1) % 3)::int] as weight from s
),
o as (select *, row_number() over (order by source_size / weight, source nulls last) as place from w),
levels as (
  select a.place,
    ((select sum(source_size) from o) - 3 * coalesce(sum(b.source_size), 0))::double
      / ((select sum(weight) from o) - coalesce(sum(b.weight), 0)) as level,
    any_value(a.weight) as weight, any_value(a.source_size) as source_size
  from o a left join o b on b.place < a.place group by a.place
),
targets as (
  select source, source_size,
    least(3.0::double * source_size, weight * (select level from levels where level * weight <= 3 * source_size order by place limit 1)) as target
  from o
),
"""

_MIX = (
    "with sizes as (" + _MIX_SIZES + ")," + _MIX_TARGETS + """
rated as (
  select doc_id, size, source_size, target,
    case when source_size > 0 then target / source_size else 0 end as rate,
    ('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null')), 1, 8))::ubigint / 4294967296.0::double as draw
  from sizes join targets on sizes.source is not distinct from targets.source
)
select doc_id, size, source_size, target,
  cast(floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end as bigint) * size as taken
from rated
"""
)

_VECTORS = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.9
),
reach as (select vec_id as node, vec_id as root from v union select b, root from reach join links on node = a),
found as (select node, min(root) as component_id from reach group by node)
select vec_id, (select count(*) from links where a = vec_id) as n_links, component_id, vec_id = component_id as kept
from v join found on node = vec_id
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# All pairs that share a shingle, and everything reachable by links.
_NEAR = r"""
with recursive w as (
  select doc_id, coalesce(regexp_extract_all(""" + _LOWER + r""", '[^\x20\x09-\x0D]+'), []) as w from {documents}
),
sh as (
  select distinct doc_id, s from (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
      else [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)] end) as s from w)
),
sz as (select doc_id, count(*) as n from sh group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as o from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select a, b from pairs join sz x on a = x.doc_id join sz y on b = y.doc_id where 100 * o >= 80 * (x.n + y.n - o)
),
linked as (select a, b from links union all select b, a from links),
reach as (select doc_id as node, doc_id as root from w union select b, root from reach join linked on node = a),
found as (select node, min(root) as component_id from reach group by node)
select w.doc_id, coalesce(n, 0) as n_shingles, component_id
from w join found on node = w.doc_id left join sz on sz.doc_id = w.doc_id
"""

# All runs of 50 words that a second document has, and what they cover.
_REPEATS = r"""
with w as (
  select doc_id, coalesce(regexp_extract_all(""" + _LOWER + r""", '[^\x20\x09-\x0D]+'), []) as w from {documents}
),
runs as (select doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) as run
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from w where len(w) >= 50)),
repeated as (select run from runs group by run having min(doc_id) < max(doc_id)),
hit as (select doc_id, i, i - lag(i) over (partition by doc_id order by i) as gap from runs where run in (select run from repeated)),
part as (select doc_id, i, sum(case when gap <= 50 then 0 else 1 end) over (partition by doc_id order by i) as part from hit),
spans as (select doc_id, part, min(i) - 1 as first, max(i) + 49 as last from part group by doc_id, part),
found as (
  select doc_id, cast(sum(last - first) as bigint) as n_repeated, count(*) as n_spans,
    string_agg(first || ':' || last, ',' order by first) as spans from spans group by doc_id
)
select w.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_repeated, 0)::bigint as n_repeated,
  coalesce(n_spans, 0)::bigint as n_spans, coalesce(spans, '') as spans
from w left join found on w.doc_id = found.doc_id
"""

_LINES = r"""
lines as (
  select doc_id, place, line, lower_ascii as key from (
    select doc_id, place, line,
      translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_ascii
    from (
      select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as place
      from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from {documents})
    )
  )
),
firsts as (select key, min(doc_id) as first_doc from lines where length(key) >= 10 group by key),
judged as (
  select lines.*, coalesce(first_doc < doc_id, false) as dropped from lines left join firsts on lines.key = firsts.key
)
"""

_LINE_DEDUP = "with " + _LINES + """
select doc_id, count(*) as n_lines, cast(sum(dropped::int) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not dropped), '')) as kept_sha256
from judged group by doc_id
"""

# Base32 of the 40 hexadecimal digits of a SHA-1, five digits (20 bits) at a time.
_WARC = """
with p as (select page_id, coalesce(html, '') as html from pages),
h as (select page_id, strlen(html) as payload_bytes, sha1(html) as hex from p),
d as (
  select page_id, payload_bytes, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int, 1)
    for i in range(32)], '') as payload_digest
  from h
),
f as (select *, min(page_id) over (partition by payload_digest) as first_page from d)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when page_id = first_page then 'response' else 'revisit' end as record_type,
  case when page_id <> first_page then first_page end as refers_to
from f
"""

# Every window of every item, looked up at every word of every document.
_HITS = r"""
item_words as (
  select item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
),
doc_words as (
  select doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from {documents}
),
windows as (
  select item_id, n, array_to_string(w[s : s + n - 1], ' ') as phrase
  from (select *, least(len(w), 10) as n, unnest(range(1, greatest(len(w) - 8, 2))) as s from item_words where len(w) > 0)
),
starts as (
  select doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') as phrase
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s
    from doc_words, (select distinct n from windows) where len(w) >= n)
),
matches as (select doc_id, item_id, s, n from starts join windows using (n, phrase))
"""

_DECONTAMINATE = "with " + _HITS + """,
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from matches) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from matches) group by doc_id
)
select d.doc_id, cast(coalesce(len(w), 0) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join hit on d.doc_id = hit.doc_id left join found on d.doc_id = found.doc_id
"""

# CRC-32 (IEEE 802.3, reflected), byte by byte.
_CRC_TABLE = """
crc_steps as (
  select i, i as c, 0 as k from range(256) t(i)
  union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from crc_steps where k < 8
),
crc_table as (select list(c order by i) as crc from crc_steps where k = 8)
"""
_CRC_OF = """xor(list_reduce(
    [('0x' || x)::bigint for x in regexp_extract_all(hex(encode({text})), '..')],
    lambda acc, x: xor(acc >> 8, crc[(xor(acc, x) & 255) + 1]), 4294967295::bigint), 4294967295)"""

# The curve is walked down one bit of each coordinate at a time: reflect and turn the label, undo its Gray code, move on.
_SHARDS = (
    "with recursive " + _CRC_TABLE + """,
d as (
  select row_number() over () as r, doc_id, lang, source, cast(strlen(coalesce(text, '')) + 16 as bigint) as size,
    """ + _CRC_OF.format(text="coalesce(text, '')") + """ as text_crc32
  from documents, crc_table
),
total as (select count(*) as n, min(doc_id)::double as low, max(doc_id)::double as high from d),
langs as (select lang, (coalesce(sum(count(*)) over (order by lang nulls last rows between unbounded preceding and 1 preceding), 0)
  * 16 // (select n from total))::int as cell from d group by lang),
sources as (select source, (coalesce(sum(count(*)) over (order by source nulls last rows between unbounded preceding and 1 preceding), 0)
  * 16 // (select n from total))::int as cell from d group by source),
cells as (
  select r, langs.cell as c0, sources.cell as c1, greatest(0, least(15, length(bin(size)) - 5)) as c2,
    coalesce(least(15, floor((doc_id::double - low) / (high - low + 1.0) * 16)::int), 0) as c3
  from d, total, langs, sources
  where d.lang is not distinct from langs.lang and d.source is not distinct from sources.source
),
walk as (
  select r, c0, c1, c2, c3, 3 as level, 0 as entry, 0 as direction, 0::bigint as curve from cells
  union all
  select r, c0, c1, c2, c3, level - 1,
    xor(entry, ((corner << (direction + 1) % 4) | (corner >> (4 - (direction + 1) % 4))) & 15),
    (direction + [0, 1, 1, 2, 2, 1, 1, 3, 3, 1, 1, 2, 2, 1, 1, 0][digit + 1] + 1) % 4, curve * 16 + digit
  from (
    select *, xor(greatest(digit - 1, 0) // 2 * 2, greatest(digit - 1, 0) // 2) as corner from (
      select *, xor(xor(turned, turned >> 1), xor(turned >> 2, turned >> 3)) as digit from (
        select *, ((label >> (direction + 1) % 4) | (label << (4 - (direction + 1) % 4))) & 15 as turned from (
          select *, xor(entry, ((c0 >> level) & 1) | (((c1 >> level) & 1) << 1) | (((c2 >> level) & 1) << 2) | (((c3 >> level) & 1) << 3)) as label
          from walk where level >= 0))))
),
ranked as (
  select d.*, curve, n, row_number() over (order by curve, doc_id nulls first, text_crc32, size, d.r) - 1 as rank
  from d join walk on d.r = walk.r and level = -1, total
)
select doc_id, size, text_crc32::bigint as text_crc32, 'rows' as law, (rank * 40 // n)::int as shard,
  (rank - ((rank * 40 // n) * n + 39) // 40)::bigint as slot, cast(null as int) as grown_shard, curve
from ranked
"""
)

# Every anchor with every other row.
_HARD_NEGATIVES = """
with v as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * x::double) for x in embedding] as e
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len([1 for x in embedding if x is null or not isfinite(x)]) = 0
),
s as (
  select a.r as ar, a.vec_id as anchor_id, b.r as br, b.vec_id as other_id, a.label = b.label as same,
    list_inner_product(a.e, b.e)::bigint as score
  from v a join v b on a.r <> b.r where a.vec_id % 100 = 0
),
positives as (
  select * from (select *, row_number() over (partition by ar order by score desc, other_id, br) as slot from s where same) where slot <= 5
)
select p.anchor_id, p.other_id as positive_id,
  row_number() over (partition by p.ar, p.slot order by n.score desc, n.other_id, n.br)::int as rank,
  n.other_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join s n on n.ar = p.ar and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify rank <= 10
"""

# Words that are equal without one letter each at the same place, or where one is the other without a letter.
_SPELLING = (
    "with recursive " + _CRC_TABLE + """,
runs as (
  select id, run, count(*) as c from (
    select coalesce(cast(doc_id as varchar), 'null') as id, unnest(regexp_extract_all(""" + _LOWER + """, '[a-zÀ-ÿ]{7,}')) as run
    from documents) group by all
),
hashed as (select run, c, """ + _CRC_OF.format(text="id || ':' || run") + """ as h from runs, crc_table),
words as (
  select word, cast(sum(c) as bigint) as n from (
    select c, case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word
    from hashed) where length(word) >= 7 group by word having sum(c) >= 2
),
less as (select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word as a, b.word as b from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select word, rest from less where rest in (select word from words)
  union select rest, word from less where rest in (select word from words)
),
judged as (
  select a as word, count(*) as n_near, min(struct_pack(m := -b.n, w := b.word)) as best, any_value(w.n) as n
  from near join words w on w.word = near.a join words b on b.word = near.b group by a
),
formed as (
  select word, n_near, case when -best.m >= 10 * n then best.w end as form, case when -best.m >= 10 * n then -best.m end as form_n from judged
),
chain as (
  select word, word as root, 0 as step from words
  union all select chain.word, formed.form, step + 1 from chain join formed on chain.root = formed.word where formed.form is not null
),
last as (select word, arg_max(root, step) as root from chain group by word)
select words.word, form, root, n, coalesce(n_near, 0) as n_near, form_n
from words join last on words.word = last.word left join formed on words.word = formed.word
"""
)

ORACLE: dict[str, str] = {
    "op1_embedding_dedup": _VECTORS,
    "op2_ngram_join": _NEAR.format(documents="documents"),
    "op4_suffix_dedup": _REPEATS.format(documents="documents"),
    "op6_line_dedup": _LINE_DEDUP.format(documents="documents"),
    "op7_decontaminate": _DECONTAMINATE.format(documents="documents"),
    "op8_mix_sources": _MIX.format(documents="documents"),
    "op10_warc": _WARC,
    "op11_hilbert_shards": _SHARDS,
    "op12_hard_negatives": _HARD_NEGATIVES,
    "op13_spelling_variants": _SPELLING,
}


# The stages of the pipeline one after another; each works on all that the one before kept.
PIPELINE = (
    r"with d1 as (select * from documents where regexp_matches(text, '\p{L}')), d2 as (with "
    + _LINES.format(documents="d1")
    + """
  , kept as (
    select doc_id, coalesce(string_agg(line, chr(10) order by place) filter (not dropped), '') as text from judged group by doc_id
  )
  select doc_id, kept.text, lang, source, cast(length(kept.text) as bigint) as n_chars from d1 join kept using (doc_id)
), near as (""" + _NEAR.format(documents="d2") + """),
d3 as (select d2.* from d2 join near on d2.doc_id = near.doc_id where component_id = d2.doc_id),
bad as (with """ + _HITS.format(documents="d3") + """ select distinct doc_id from matches),
d4 as (select * from d3 where doc_id not in (select doc_id from bad)),
taken as (""" + _MIX.format(documents="d4").replace(
        "as bigint) * size as taken", "as bigint) as copies"
    ) + """)
select d4.*, unnest(range(1, copies + 1))::int as copy from d4 join taken on d4.doc_id = taken.doc_id where copies > 0
"""
)
