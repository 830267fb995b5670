"""Expected results in DuckDB SQL, stated without the library's code."""

ASCII_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

DECONTAMINATE = rf"""
with item as (
  select item_id, regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), win as (
  select distinct item_id, least(10, len(w)) as l,
    array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') as win
  from item, unnest(range(1, greatest(2, len(w) - 8))) as t(i)
  where len(w) > 0
), doc as (
  select row_number() over () as rid, doc_id,
    regexp_extract_all({ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), place as (
  select rid, i, l, array_to_string(list_slice(w, i, i + l - 1), ' ') as win
  from doc, (select distinct l from win) lengths, unnest(range(1, len(w) - l + 2)) as t(i)
), hit as (
  select rid, i, place.l, item_id from place join win using (win, l)
), hit_words as (
  select rid, count(distinct i + k) as n_hit
  from (select distinct rid, i, l from hit), unnest(range(0, l)) as t(k) group by rid
), named as (
  select rid, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
  from (select distinct rid, item_id from hit where item_id is not null) group by rid
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc left join hit_words using (rid) left join named using (rid)
"""

MIX = r"""
with recursive doc as (
  select doc_id, coalesce(source, '~~null~~') as source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, 'text:' || text, '')), 1, 13))::bigint as h
  from documents
), src as (
  select source, count(*) as docs, sum(size)::bigint as s,
    row_number() over (order by source = '~~null~~', source) as place
  from doc group by source
), weighed as (
  select *, 2.0::double * s as cap, [3, 1, 2][(place - 1) % 3 + 1] as w from src
), levels as (
  select *, (1.5::double * sum(s) over ()
      - coalesce(sum(cap) over (order by cap / w, place rows between unbounded preceding and 1 preceding), 0))
      / sum(w) over (order by cap / w, place rows between current row and unbounded following) as level
  from weighed
), goal as (
  select source, docs, s, cap, least(cap, coalesce(
    w * (select arg_min(level, cap / w) from levels where cap / w > level), cap)) as target
  from levels
), hist as (
  select source, size, count(*) as n from doc where size > 0 group by all
), newton as (
  select 0 as it, source, docs, s, target, 0.0::double as lam,
    null::double as low, null::double as high
  from goal where target < cap
  union all
  select it + 1, source, docs, s, target,
    case when gap = 0 then lam
      when slope > 0 and lam - gap / slope > coalesce(if(gap < 0, lam, low), '-infinity'::double)
        and lam - gap / slope < coalesce(if(gap > 0, lam, high), 'infinity'::double) then lam - gap / slope
      when if(gap < 0, lam, low) is null then lam - 1 - abs(lam)
      when if(gap > 0, lam, high) is null then lam + 1 + abs(lam)
      else (if(gap < 0, lam, low) + if(gap > 0, lam, high)) / 2 end,
    if(gap < 0, lam, low), if(gap > 0, lam, high)
  from (
    select it, source, docs, s, target, lam, low, high,
      sum(n * size * least(2, exp(least(1.0, lam * size * docs / s)))) - target as gap,
      sum(if(lam * size * docs / s >= ln(2), 0,
        n * size * exp(least(1.0, lam * size * docs / s)) * size * docs / s)) as slope
    from newton join hist using (source) where it < 60
    group by it, source, docs, s, target, lam, low, high
  )
), rated as (
  select doc_id, doc.source, size, s, target, h,
    case when size = 0 then 0.0 when lam is null then 2.0
      else least(2.0, exp(least(1.0, lam * size * docs / s))) end as rate
  from doc join goal using (source)
    left join (select source, lam from newton where it = 60) using (source)
), ranked as (
  select *, floor(rate) as whole,
    floor((h / 4503599627370496.0::double - (rate - floor(rate)) + 1) * 34359738368.0::double)::bigint as o,
    size > 0 and floor(rate) < 2 as rises
  from rated
), cum as (
  select *, sum(whole * size) over (partition by source)
      + sum(if(rises, size, 0)) over (partition by source order by if(rises, o, 99999999999) range unbounded preceding) as upto,
    sum(if(rises, size, 0)) over (partition by source, if(rises, o, 99999999999)) as tied
  from ranked
)
select doc_id, size, s as source_size, target,
  (size * (whole + if(rises and (upto <= target or upto - target < target - (upto - tied)), 1, 0)))::bigint as taken,
  (whole + if(rises and (upto <= target or upto - target < target - (upto - tied)), 1, 0))::bigint as copies
from cum
"""

# Blocks of the scripts written without spaces.
_UNSPACED = (
    r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"
)

LINE_DEDUP = rf"""
with recursive doc as (
  select row_number() over () as rid, doc_id, text, string_split(text, chr(10)) as ls from documents
), line as (
  select rid, doc_id, i as line_no,
    list_transform(regexp_extract_all(ls[i], '[{_UNSPACED}]|[^\x20\x09-\x0D{_UNSPACED}]+'),
      lambda t: if(regexp_matches(t, '[0-9]'), '<*>', t)) as w
  from doc, unnest(range(1, len(ls) + 1)) as u(i)
), leafed as (
  select *, len(w)::varchar || ' ' || array_to_string(w[1:3], ' ') as leaf, array_to_string(w, ' ') as line
  from line where len(w) >= 5
), counted as (
  select leaf, line, any_value(w) as w, count(*) as n, min((doc_id, line_no)) as first,
    len(any_value(w)) - ceil(0.8::double * len(any_value(w)))::bigint as apart, len(any_value(w)) - 3 as free
  from leafed group by leaf, line
), ranked as (
  select *, row_number() over (order by n desc, first, line) as place from counted
), segment as (
  select place, leaf, i,
    array_to_string(w[4 + i * free // (apart + 1) : 3 + (i + 1) * free // (apart + 1)], ' ') as words
  from ranked, unnest(range(0, apart + 1)) as u(i)
), pair as (
  select distinct place, min(place) over (partition by leaf, i, words) as lead from segment
), link as (
  select a.line as a, b.line as b
  from pair join ranked a on a.place = pair.place join ranked b on b.place = pair.lead
  where pair.place <> pair.lead
    and len(list_filter(range(1, len(a.w) + 1), lambda i: a.w[i] = b.w[i])) >= 0.8::double * len(a.w)
), both_ways as (
  select a, b from link union select b, a from link
), reach as (
  select a as line, a as other from both_ways
  union
  select reach.line, both_ways.b from reach join both_ways on both_ways.a = reach.other
), root as (
  select line, min(other) as root from reach group by line
), place as (
  select rid, doc_id, line_no, coalesce(root, line) as template from leafed left join root using (line)
), recurring as (
  select template, min(doc_id) as lo from place
  group by template having min(doc_id) < max(doc_id)
), gone as (
  select rid, list(line_no) as drop_ from place join recurring using (template)
  where doc_id <> lo group by rid
)
select doc_id, coalesce(len(ls), 0)::bigint as n_lines, coalesce(len(drop_), 0)::bigint as n_dropped,
  if(text is null, null, array_to_string(
    list_transform(list_filter(range(1, len(ls) + 1), lambda i: not list_contains(coalesce(drop_, []), i)),
      lambda i: ls[i]), chr(10))) as text
from doc left join gone using (rid)
"""

# The reflected CRC-32 polynomial makes the table; ``{bytes}`` is a list of numbers.
CRC_TABLE = """(
  select list(list_reduce(list_prepend(i, range(8)),
    lambda c, k: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1)) order by i) as t
  from range(256) as bytes(i))"""


def crc32(numbers: str) -> str:
    """crc32 of a list of bytes, with the table of ``CRC_TABLE`` at hand as ``t``."""
    return (
        f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, {numbers}), "
        "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"
    )


def _hashed(*columns: str) -> str:
    parts = (
        f"if({c} is null, '-', octet_length(encode({c}::varchar)) || ':' || {c}::varchar)" for c in columns
    )
    return f"sha256({' || '.join(parts)})"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ID_BYTES = "list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)"

MERKLE = f"""
with recursive leafed as (
  select row_number() over () as rid, doc_id, coalesce('=' || source, '-') as tree,
    {_hashed("doc_id", "source", "lang", "n_chars", "text")} as leaf,
    coalesce({crc32(_ID_BYTES)} % 5 = 0, false) as tampered,
    {_hashed("doc_id", "source", "lang", "n_chars", _LOWERED)} as changed
  from documents, {CRC_TABLE}
), placed as (
  select *, if(tampered, changed, leaf) as shown, count(*) over (partition by tree) as n,
    row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place
  from leafed
), nodes as (
  select tree, 0 as level, place as pos, n, leaf as hash from placed
  union all
  select tree, level + 1, pos >> 4, (n + 15) >> 4, sha256(string_agg(hash, '' order by pos))
  from nodes where n > 1 group by tree, level, pos >> 4, n
), roots as (
  select tree, hash as subroot, row_number() over (order by encode(tree)) - 1 as place, count(*) over () as n
  from nodes where n = 1
), tops as (
  select 0 as level, place as pos, n, subroot as hash from roots
  union all
  select level + 1, pos >> 4, (n + 15) >> 4, sha256(string_agg(hash, '' order by pos))
  from tops where n > 1 group by level, pos >> 4, n
), every as (
  select tree, 0 as part, * exclude (tree) from nodes where n > 1
  union all
  select r.tree, 1, t.level, t.pos, t.n, t.hash from tops t, roots r
    where t.n > 1 and t.pos >> 4 = r.place >> (4 * (t.level + 1))
), steps as (
  select rid, part, level,
    coalesce(string_agg(hash, '' order by pos) filter (pos < mine), '') as before,
    coalesce(string_agg(hash, '' order by pos) filter (pos > mine), '') as after
  from (
    select rid, part, level, pos, hash,
      if(part = 0, p.place, r.place) >> (4 * level) as mine
    from placed p join roots r using (tree) join every e using (tree)
    where e.pos >> 4 = if(part = 0, p.place, r.place) >> (4 * (level + 1))
  ) group by rid, part, level
), numbered as (
  select *, row_number() over (partition by rid order by part, level) as k from steps
), folded as (
  select rid, 0::bigint as k, shown as hash from placed
  union all
  select rid, k + 1, sha256(before || hash || after)
  from folded join (select rid, k - 1 as k, before, after from numbered) using (rid, k)
)
select doc_id, leaf, subroot, (select hash from tops where n = 1) as root,
  coalesce(proof, sha256('')) as proof_sha256, f.hash as folded_root,
  f.hash = (select hash from tops where n = 1) as verified
from placed p join roots using (tree)
  left join (select rid, max(k) as last, sha256(string_agg(before || after, '' order by k)) as proof
             from numbered group by rid) using (rid)
  join folded f on f.rid = p.rid and f.k = coalesce(last, 0)
"""

CHAT = r"""
with turn as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, n, role, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) as t(n, role)
), sized as (
  select *, length(role) + length(text) + length(regexp_replace(role || text, '[^<>\\]', '', 'g'))
    + length('<turn >' || '</turn>') + 2 as chars
  from turn
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
    filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from sized group by conv_id
"""

_RUN_BYTES = """flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
      lambda x: if(unicode(x) < 128, [unicode(x)::bigint],
        [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)]::bigint[])))"""

SPELLING = f"""
with recursive run as (
  select doc_id, run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-z\u00C0-\u00FF]+')) as run from documents)
  where length(run) >= 6 group by doc_id, run
), hashed as (
  select run, n, {crc32(_RUN_BYTES)} as h from run, {CRC_TABLE}
), word as (
  select if(h % 199 = 0, run[:h % length(run)] || run[h % length(run) + 2:], run) as word, sum(n)::bigint as n
  from hashed group by 1 having sum(n) >= 5 and length(word) >= 6
), shorter as (
  select word, n, i, word[:i - 1] || word[i + 1:] as rest
  from word, unnest(range(1, length(word) + 1)) as t(i)
), less as (
  select distinct s.word, s.n, w.word as near, w.n as near_n from shorter s join word w on s.rest = w.word
), pair as (
  select word, n, near, near_n from less
  union all select near, near_n, word, n from less
  union all select a.word, a.n, b.word, b.n from shorter a join shorter b using (i, rest) where a.word <> b.word
), best as (
  select word, count(*) as n_near, arg_min(struct_pack(near := near, near_n := near_n), (-near_n, near)) as b
  from pair group by word
), form as (
  select word.word, n, coalesce(n_near, 0)::bigint as n_near,
    if(b.near_n >= 5 * n, b.near, null) as form, if(b.near_n >= 5 * n, b.near_n, null) as form_n
  from word left join best using (word)
), chain as (
  select word, word as root from form
  union all
  select chain.word, form.form from chain join form on form.word = chain.root where form.form is not null
), root as (
  select chain.word, chain.root from chain join form on form.word = chain.root where form.form is null
)
select word, form, root, n, n_near, form_n from form join root using (word)
"""
