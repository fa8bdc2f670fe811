"""DuckDB SQL of the operators on hashed words, over whole texts. CRC-32 is computed in SQL, from its polynomial."""

from __future__ import annotations

UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

CRC_TABLE = """
crc_table as materialized (
  select list(v order by b)::bigint[] as tab from (
    select b, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b::bigint) as v
    from range(256) t(b)) x
)"""


def crc_of(source: str, text: str, columns: str) -> str:
    """``columns`` and ``crc`` (of the UTF-8 bytes of ``text``) of the rows of ``source``."""
    digit = "strpos('0123456789ABCDEF', h[{}]) - 1"
    byte = f"(16 * ({digit.format('2 * i - 1')}) + {digit.format('2 * i')})::bigint"
    return f"""
select {columns}, xor(list_reduce(list_transform(range(1, len(h) // 2 + 1), lambda i: {byte}),
         lambda c, y: xor(c >> 8, tab[1 + (xor(c, y) & 255)]), 4294967295::bigint), 4294967295) as crc
from (select *, hex(encode({text})) as h from {source}) s, crc_table"""


OP11_SQL = "with" + CRC_TABLE + r""", texts as (
  select 'd' as side, doc_id, row_number() over () as r, text from documents
  union all select 'b', null, -row_number() over (), text from benchmark
), words as (
  select side, doc_id, r, regexp_extract_all(translate(coalesce(text, ''), """ + UPPER + ", " + LOWER + r"""),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from texts
), features as (
  select side, r, unnest(w) as f from words
), buckets as (
  select f, crc % 10000 as bucket from (""" + crc_of("(select distinct f from features)", "f", "f") + r""") c
), counts as (
  select bucket, count(*) filter (where side = 'd') as s, count(*) filter (where side = 'b') as t from features join buckets using (f) group by bucket
), gains as (
  select bucket, floor(1000 * ln((t + 1) * ((select sum(s) from counts) + 10000)::bigint
                                 / ((s + 1) * ((select sum(t) from counts) + 10000)::bigint)))::bigint as gain from counts
), weights as (
  select r, sum(gain)::bigint as weight from features join buckets using (f) join gains using (bucket) where side = 'd' group by r
), scored as (
  select r, doc_id, len(w)::bigint as n_features, coalesce(weight, 0) as weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5) / 4294967296)))::bigint as score
  from words left join weights using (r) where side = 'd'
), ranks as (
  select r, row_number() over (order by score desc, doc_id) as rank from scored where n_features >= 20 and doc_id is not null
)
select doc_id, n_features, weight, score,
       case when rank <= (select 10 * count(*) // 100 from ranks) then rank end as rank
from scored left join ranks using (r)
"""

OP12_SQL = "with recursive" + CRC_TABLE + r""", runs as (
  select doc_id, unnest(list_transform(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+'),
           lambda x: translate(x, """ + UPPER + ", " + LOWER + r"""))) as run
  from documents where text is not null
), per_doc as (
  select doc_id, run, count(*) as n, coalesce(doc_id || ':' || run, '') as name from runs where length(run) >= 7 group by doc_id, run
), hashed as (
  select run, n, doc_id, crc from (""" + crc_of("per_doc", "name", "run, n, doc_id") + r""") c
), typed as (
  select n, case when doc_id is not null and crc % 31 = 0
                 then substr(run, 1, (crc % length(run))::int) || substr(run, (crc % length(run))::int + 2) else run end as word
  from hashed
), words as materialized (
  select word, sum(n)::bigint as n from typed where length(word) >= 7 group by word having sum(n) >= 2
), skips as materialized (
  select word, n, i, substr(word, 1, i::int - 1) || substr(word, i::int + 1) as rest from (select *, unnest(range(1, length(word) + 1)) as i from words) x
), pairs as (
  select distinct a, b, m from (
    select x.word as a, y.word as b, y.n as m from skips x join skips y on x.i = y.i and x.rest = y.rest and x.word <> y.word
    union all select x.word, w.word, w.n from skips x join words w on x.rest = w.word
    union all select w.word, x.word, x.n from skips x join words w on x.rest = w.word) p
), best as (
  select a as word, count(*)::bigint as n_near, first(b order by m desc, b) as near, max(m) as near_n from pairs group by a
), forms as materialized (
  select word, n, coalesce(n_near, 0) as n_near, case when near_n >= 10 * n then near end as form, case when near_n >= 10 * n then near_n end as form_n
  from words left join best using (word)
), chain as (
  select word, word as root, form as next from forms
  union all select chain.word, forms.word, forms.form from chain join forms on chain.next = forms.word
)
select forms.word, forms.form, root, n, n_near, form_n from forms join chain on forms.word = chain.word and chain.next is null
"""

OP13_SQL = """
with bytes as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), starts as (
  select doc_id, s, substr(h, 2 * s + 1, 200) as w from (select doc_id, h, unnest(range(0, len(h) // 2 - 99)) as s from bytes) x
), first as (
  select w, min(struct_pack(d := doc_id, s := s)) as f from starts group by w having count(*) > 1
), repeats as (
  select doc_id, s from starts join first using (w) where f.d <> doc_id or f.s <> s
), steps as (
  select doc_id, s, lag(s) over (partition by doc_id order by s) as p from repeats
), numbered as (
  select doc_id, s, sum(case when p is null or s - p > 100 then 1 else 0 end) over (partition by doc_id order by s) as k from steps
), spans as (
  select doc_id, k, min(s) as b, max(s) + 100 as e from numbered group by doc_id, k
), gaps as (
  select doc_id, k, b, e, coalesce(lag(e) over (partition by doc_id order by k), 0) as p from spans
), cut as (
  select doc_id, sum(e - b)::bigint as n_removed, count(*)::bigint as n_spans, max(e) as e,
         string_agg(substr(h, 2 * p + 1, 2 * (b - p)), '' order by k) as kept
  from gaps join bytes using (doc_id) group by doc_id
)
select doc_id, (len(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(case when e is null then h else kept || substr(h, 2 * e + 1) end)) as kept_sha256
from bytes left join cut using (doc_id)
"""
