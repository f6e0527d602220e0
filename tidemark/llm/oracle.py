"""SQL for DuckDB with the rows of the queries it can express."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce({{}}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_INDEX_WORDS = f"regexp_extract_all({_LOWER}, '[0-9a-z\\x{{{{80}}}}-\\x{{{{10FFFF}}}}]+')"

OP9 = f"""
with d as (select doc_id, {_INDEX_WORDS.format("text")} as w from documents),
b as (select item_id, {_INDEX_WORDS.format("text")} as w from benchmark),
sized as (select item_id, w, least(len(w), 10) as n from b where len(w) > 0),
win as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as p
  from (select *, unnest(range(1, len(w) - n + 2)) as i from sized)
),
sizes as (select distinct n from win),
places as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as p
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)
),
hits as (select doc_id, item_id, i, n from places join win using (n, p)),
covered as (
  select doc_id, count(distinct k) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as k from hits) group by doc_id
),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
),
tokens as (
  select doc_id, generate_subscripts(w, 1) - 1 as pos, unnest(w) as term from d
),
counted as (select term, count(*) as total from tokens group by term),
planned as (
  select p, n, o, term,
    row_number() over (partition by p order by total, term, o) as turn,
    count(total) over (partition by p) as known
  from (
    select p, n, generate_subscripts(string_split(p, ' '), 1) - 1 as o,
      unnest(string_split(p, ' ')) as term
    from (select distinct p, n from win)
  ) left join counted using (term)
),
rarest as (
  select p, n, o, doc_id, pos from planned join tokens using (term) where turn = 1 and known = n
),
near as (
  select p, doc_id from (
    select r.p, r.n, r.doc_id, r.pos, count(distinct other.turn) as others
    from rarest r
    left join planned other on other.p = r.p and other.turn > 1
    left join tokens t on t.doc_id = r.doc_id and t.term = other.term
    where r.n = 1 or t.pos - r.pos - (other.o - r.o) between -2 and 2
    group by r.p, r.n, r.doc_id, r.pos
  ) where others = n - 1
),
beside as (
  select doc_id, count(distinct item_id) as n_near from near join win using (p) group by doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated, coalesce(n_near, 0) as n_near
from d left join covered using (doc_id) left join items using (doc_id)
  left join beside using (doc_id)
"""

def _times(text: str, part: str) -> str:
    return f"(len({text}) - len(replace({text}, '{part}', ''))) // {len(part)}"


def _escapes(text: str) -> str:
    """How many backslashes the chat format adds to a text: one for each there is,
    and one after each character that begins, or could begin, a control string."""
    parts = ["\\", "<s>", "[s>", "<INST]", "[INST]", "</", "[/", "[<"]
    # Each < before another: all but the last of every run.
    pairs = f"{_times(text, '<')} - len(regexp_extract_all({text}, '<+'))"
    return " + ".join([*(_times(text, part) for part in parts), pairs])


OP3 = f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized as (
  select *, len(text) + {_escapes("text")} + case role
      when 'user' then len('<s>[INST]  [/INST]')
      when 'assistant' then len('<s>  </s>')
      else len('<s><<ROLE>><</ROLE>>  </s>') + len(role) + {_escapes("role")} end as chars,
    case when role = 'assistant' then text else '' end as loss
  from c
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text))
    as turns_sha256,
  cast(sum(len(loss)) as bigint) as loss_chars,
  sha256(string_agg(loss, '' order by turn, role, text)) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id
"""

OP6 = r"""
with d as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
),
windows as (
  select doc_id, i, w[i:i + 2] as p
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d)
),
twice as (select doc_id, p from windows group by doc_id, p having count(*) > 1),
repeats as (
  select doc_id, count(distinct k) as n
  from (select doc_id, unnest(range(i, i + 3)) as k from windows join twice using (doc_id, p))
  group by doc_id
),
m as (
  select d.doc_id, cast(len(w) as bigint) as n_words,
    cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    coalesce(n, 0) as n_repeat_words,
    cast(len(lines) as bigint) as n_lines,
    cast(length(regexp_replace(text, '[^A-Z]', '', 'g')) as bigint) as n_capitals
  from d left join repeats using (doc_id)
),
judged as (
  select *, n_words < 50 as short, 100 * n_repeat_words > 50 * n_words as repeated,
    5 * n_symbols > n_words as symbols, 2 * n_dup_lines > n_lines as lines,
    word_chars < 2 * n_words or word_chars > 20 * n_words as odd,
    2 * n_capitals > word_chars as capitals, n_words = 0 as nothing
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals,
  cast(short as bigint) + 2 * cast(repeated as bigint) + 4 * cast(symbols as bigint)
    + 8 * cast(lines as bigint) + 16 * cast(odd as bigint) + 32 * cast(capitals as bigint)
    + 64 * cast(nothing as bigint) as failed,
  short or repeated as base_failed,
  not (short or repeated or symbols or lines or odd or capitals or nothing) as kept
from judged
"""

OP8 = r"""
with d as (
  select doc_id, md5(text) as text_id, source,
    greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1) as n_tokens
  from documents
),
s as (select source, sum(n_tokens) as tokens from d group by source),
-- The repetition of the smallest source is (largest / smallest share) ** (1 - exponent).
a as (
  select case when max(tokens) <= 2 * min(tokens) then 0.0::double
    else ceil(round((1 - ln(2.0::double) / ln(max(tokens)::double / min(tokens))) * 10000, 3))
      / 10000 end as alpha
  from s
),
p as (
  select source, tokens, pow(tokens::double / (select sum(tokens) from s)::double, alpha) as power
  from s, a
),
w as (
  select source, tokens, round(power / (select sum(power) from p), 9) as weight,
    greatest(tokens, round(power * (select max(tokens::double / power) from p))::bigint) as budget
  from p
),
c as (
  select doc_id, text_id, source, n_tokens, weight, budget, tokens, epoch,
    substr(md5('17|' || doc_id || '|' || text_id), 1, 3) as block,
    md5('17|' || epoch || '|' || doc_id || '|' || text_id) as draw
  from (
    select *, unnest(range(0, ceil(budget::double / tokens::double)::int)) as epoch
    from d join w using (source)
  )
),
blocks as (
  select source, epoch, block, sum(n_tokens) as size, md5('17|' || epoch || '|' || block) as turn
  from c group by source, epoch, block
),
offsets as (
  select source, epoch, block,
    sum(size) over (partition by source, epoch order by turn, block) - size as before
  from blocks
),
placed as (
  select c.*, epoch * tokens + before + sum(n_tokens) over (
    partition by source, epoch, block order by draw, doc_id, text_id
    rows between unbounded preceding and current row) as last
  from c join offsets using (source, epoch, block)
)
select doc_id, text_id, source, n_tokens, weight, cast(epoch as int) as epoch,
  round((last - n_tokens)::double / budget::double, 9) as position
from placed where last <= budget
"""

OP2 = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
),
sized as (select doc_id, w, least(5, len(w)) as n from d where len(w) > 0),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + n - 1], ' ') as p
  from (select *, unnest(range(1, len(w) - n + 2)) as i from sized)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as n
  from shingles x join shingles y on x.p = y.p and x.doc_id < y.doc_id
  group by x.doc_id, y.doc_id
),
links as (
  select a, b from shared join sizes s on s.doc_id = a join sizes t on t.doc_id = b
  where 100 * shared.n >= 85 * (s.n + t.n - shared.n)
),
both_ways as (select a, b from links union all select b, a from links),
reach as (
  select a as doc_id, b as other from both_ways
  union
  select reach.doc_id, l.b from reach join both_ways l on l.a = reach.other
),
found as (
  select d.doc_id, coalesce(n, 0) as n_shingles,
    least(d.doc_id, coalesce(min(other), d.doc_id)) as component_id
  from d left join sizes using (doc_id) left join reach using (doc_id)
  group by d.doc_id, n
)
select doc_id, n_shingles, component_id, doc_id = component_id as kept from found
"""

OP7 = r"""
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
),
windows as (
  select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as p
  from (select *, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50)
),
firsts as (select p, min(doc_id) as first from windows group by p),
cut as (
  select distinct doc_id, unnest(range(i, i + 50)) as k
  from windows join firsts using (p) where first < doc_id
),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as k from d),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by k) as text
  from words anti join cut using (doc_id, k) group by doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words, len(w) - coalesce(n, 0) as n_removed,
  sha256(coalesce(kept.text, '')) as kept_sha256
from d left join kept using (doc_id)
"""

_ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
# Kind, pattern, measured group, least length.
_SECRETS = [
    ("assign", _ASSIGN, 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
]


def _found(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
  select doc, {number} as number, '{kind}' as kind, i, {least} as least,
    len(gaps[i]) as gap, len(found[i]) as size, len(measured[i]) as measured
  from (
    select *, unnest(range(1, len(found) + 1)) as i from (
      select doc, string_split_regex(text, '{pattern}') as gaps,
        regexp_extract_all(text, '{pattern}') as found,
        regexp_extract_all(text, '{pattern}', {group}) as measured
      from d
    )
  )"""


OP11 = f"""
with d as (
  select row_number() over () as doc, doc_id, coalesce(text, '') as text from documents
),
matches as ({" union all ".join(_found(i, *rule) for i, rule in enumerate(_SECRETS))}
),
spans as (
  select *, stop - size as start,
    kind || ':' || cast(stop - size as varchar) || ':' || cast(stop as varchar) as span
  from (
    select *, cast(sum(gap + size) over (partition by doc, number order by i) as bigint) as stop
    from matches
  ) where measured >= least
),
listed as (
  select doc, count(*) filter (number = 0) as n_assign, count(*) filter (number = 1) as n_access,
    count(*) filter (number = 2) as n_hex,
    string_agg(span, ',' order by start, number) filter (number < 3) as base,
    string_agg(span, ',' order by start, number) as spans
  from spans group by doc
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans
from d left join listed using (doc)
"""

OP12 = f"""
with d as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all({_LOWER.format("text")}, '[a-z\\x{{80}}-\\x{{10FFFF}}]+') as w
  from documents
),
uses as (select doc, lang, source, unnest(w) as term from d),
kept as (
  select lang, term, count(*)::hugeint as n from uses
  group by lang, term having count(distinct doc) >= 3
),
langs as (select lang, count(*)::hugeint as v, sum(n)::hugeint as size from kept group by lang),
groups as (select distinct lang, source from d),
own as (
  select lang, source, term, count(*)::hugeint as n from uses semi join kept using (lang, term)
  group by lang, source, term
),
sizes as (
  select lang, source, coalesce(sum(n), 0)::hugeint as size
  from groups left join own using (lang, source) group by lang, source
),
shares as (
  select lang, source, term, coalesce(own.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(own.n, 0) + 1)) // (sizes.size + v) as p,
    1 + (1000000000::hugeint * (kept.n + 1)) // (langs.size + v) as q
  from groups join kept using (lang) left join own using (lang, source, term)
    join sizes using (lang, source) join langs using (lang)
),
pairs as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by a.lang, a.source, b.source
),
rows as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join pairs on pairs.lang = a.lang and pairs.source = a.source and item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q)) // q from shares where n > 0 and p > q
),
ranked as (
  select *, row_number() over (
    partition by lang, source, part order by value desc, encode(item)) as rank
  from rows
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank
from ranked where part = 'pair' or rank <= 200
"""

# The remainder of each byte, and of all bytes of a word.
_CRC_TABLE = """list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))"""

OP13 = f"""
with t as (select {_CRC_TABLE} as crc),
d as (
  select row_number() over () as doc, doc_id, {_INDEX_WORDS.format("text")} as w from documents
),
b as (select {_INDEX_WORDS.format("text")} as w from benchmark),
vocabulary as (
  select word, hex(encode(word)) as h from (
    select unnest(w) as word from d union select unnest(w) from b)
),
buckets as (
  select word, xor(list_reduce(
      [4294967295] || list_transform(range(0, len(h) // 2),
        lambda i: ('0x' || substr(h, cast(2 * i + 1 as int), 2))::bigint),
      lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as bucket
  from vocabulary, t
),
raw as (
  select bucket, count(*) as s from (select unnest(w) as word from d) join buckets using (word)
  group by bucket
),
aim as (
  select bucket, count(*) as t from (select unnest(w) as word from b) join buckets using (word)
  group by bucket
),
gains as (
  select bucket, floor(1000 * ln(
      ((coalesce(t, 0) + 1)::double * ((select coalesce(sum(s), 0) from raw) + 10000)::double)
      / ((coalesce(s, 0) + 1)::double * ((select coalesce(sum(t), 0) from aim) + 10000)::double)
    ))::bigint as gain
  from raw full join aim using (bucket)
),
weights as (
  select doc, cast(sum(gain) as bigint) as weight
  from (select doc, unnest(w) as word from d) join buckets using (word) join gains using (bucket)
  group by doc
),
scored as (
  select doc_id, cast(len(w) as bigint) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000.0::double * ln(-ln((
      ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296.0::double
    )))::bigint as score
  from d left join weights using (doc)
),
ranked as (
  select *, row_number() over (
    partition by n_features >= 20 order by score desc, doc_id, n_features) as place,
    count(*) over (partition by n_features >= 20) as n
  from scored
)
select doc_id, n_features, weight, score,
  case when n_features >= 20 and place <= 10 * n // 100 then place end as rank
from ranked
"""

SQL: dict[str, str] = {
    "op2_minmax_near_dedup": OP2,
    "op3_chat_render": OP3,
    "op6_rule_ledger": OP6,
    "op7_substring_dedup": OP7,
    "op8_source_mix": OP8,
    "op9_decontaminate": OP9,
    "op11_secret_ledger": OP11,
    "op12_source_audit": OP12,
    "op13_importance_resampling": OP13,
}
