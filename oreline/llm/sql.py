"""DuckDB twins of the queries that SQL can express.

The classifier, sketches, suffix arrays, graphs, pieces, pages and the shuffled
schedule have none; they are tested against brute force. The window counts of the
line rules are too slow in SQL on whole texts and are tested likewise.
"""

from __future__ import annotations

from oreline.llm.fill_middle import REARRANGED, SEED, SUFFIX_FIRST
from oreline.llm.line_dedup import LEAST_CHARS, LEAST_DOCUMENTS
from oreline.llm.queries import SHARD_BYTES
from oreline.llm.sharding import HASH_BITS

SHARDING = f"""
with sized as (
  select doc_id, octet_length(encode(coalesce(text, ''))) as n_bytes,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null')), 1, 15) as bigint) as h
  from documents),
each as (select *, unnest(range(0, {HASH_BITS + 1})) as depth from sized),
cut as (select *, cast(h >> ({HASH_BITS} - depth) as bigint) as bucket from each),
sums as (
  select depth, bucket, cast(sum(n_bytes) as bigint) as shard_bytes from cut group by all),
fits as (
  select c.doc_id, c.h, c.n_bytes, c.depth, c.bucket, s.shard_bytes,
    row_number() over (partition by c.doc_id, c.h order by c.depth) as k
  from cut c join sums s using (depth, bucket) where s.shard_bytes <= {SHARD_BYTES})
select doc_id, cast(n_bytes as bigint) as n_bytes, cast(depth as integer) as depth,
  case when depth = 0 then '' else right(lpad(bin(bucket), 64, '0'), cast(depth as integer)) end
    as shard_id,
  shard_bytes
from fits where k = 1
"""

CHAT = """
with seen as (
  select conv_id, turn, role, text,
    last_value(case when role = 'user' then turn end ignore nulls)
      over (partition by conv_id order by turn, role, text) as call_turn,
    count(case when role = 'user' then 1 end)
      over (partition by conv_id order by turn, role, text) - 1 as level
  from conversations),
calls as (
  select 'call-' || conv_id || '-' || turn as call_id, turn, text, level from seen
  where role = 'user'),
answers as (
  select 'call-' || conv_id || '-' || coalesce(call_turn, turn) as call_id,
    min(turn) as result_turn, count(*) as n_results, arg_min(text, turn) as content
  from seen where role = 'assistant' group by all)
select coalesce(c.call_id, a.call_id) as call_id,
  case when c.call_id is not null then 'reply' end as tool,
  c.level, a.result_turn, coalesce(a.n_results, 0) as n_results,
  case when c.call_id is null then 'orphan' when a.call_id is null then 'unanswered'
    else 'linked' end as status,
  case when c.call_id is not null then true end as valid,
  case when c.call_id is not null then '' end as errors,
  case when c.call_id is not null then
    '{"arguments":{"text":' || cast(to_json(c.text) as varchar) || ',"turn":' || c.turn
    || '},"id":"' || c.call_id || '","level":' || c.level
    || case when a.content is null then '' else ',"result":' || cast(to_json(a.content) as varchar) end
    || ',"tool":"reply"}' end as json
from calls c full join answers a on c.call_id = a.call_id
"""



def _levels(name: str, many: int) -> str:
    """Common tables ``<name>1`` and so on above ``<name>0(g, place, h)``, of runs of 16.

    Each level has what stands left and right of a node in its run; a group of one
    node stays as it is, with nothing beside it.
    """
    out = []
    for k in range(many):
        out.append(f"""
{name}{k}_runs as (
  select *, count(*) over (partition by g) as n from {name}{k}),
{name}{k}_sides as (
  select a.g, a.place, a.h, a.n,
    coalesce(string_agg(b.h, '' order by b.place) filter (b.place < a.place), '') as before,
    coalesce(string_agg(b.h, '' order by b.place) filter (b.place > a.place), '') as after
  from {name}{k}_runs a join {name}{k}_runs b
    on a.g = b.g and a.place // 16 = b.place // 16 group by all),
{name}{k + 1} as (
  select g, place // 16 as place,
    case when any_value(n) = 1 then any_value(h) else sha256(string_agg(h, '' order by place)) end as h
  from {name}{k}_runs group by g, place // 16)""")
    return ",".join(out)


def _field(name: str) -> str:
    return f"coalesce(strlen(cast({name} as varchar)) || ':' || {name}, '-')"


# Of the unsigned crc32 of a decimal id: bit by bit, with the reversed polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(
    string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)), 4294967295)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _manifest() -> str:
    """Levels are written out: five for the leaves of a source, three for the sources."""
    fields = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
    # Folded level by level, so that no expression holds another one twice.
    steps = ["""
f0 as (select d.*, case when broken then altered else leaf end as f from docs d)"""]
    at = 0
    for name, many, group, place in (("leaf", 5, "p.g", "p.place"), ("top", 3, "0", "p.g")):
        for k in range(many):
            steps.append(f"""
f{at + 1} as (
  select p.* exclude (f, proof), p.proof || s.before || s.after as proof,
    case when s.n = 1 then p.f else sha256(s.before || p.f || s.after) end as f
  from f{at} p join {name}{k}_sides s on s.g = {group} and s.place = {place} // {16**k})""")
            at += 1
    return f"""
with hashed as (
  select doc_id, source, sha256({fields} || {_field("text")}) as leaf,
    sha256({fields} || {_field(f"translate(text, '{_UPPER}', '{_LOWER}')")}) as altered,
    coalesce({_CRC} % 5 = 0, false) as broken
  from documents),
docs as (
  select *, '' as proof, dense_rank() over (order by source nulls first) - 1 as g,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place
  from hashed),
leaf0 as (select g, place, leaf as h from docs),{_levels("leaf", 5)},
top0 as (select 0 as g, g as place, h from leaf5),{_levels("top", 3)},{",".join(steps)}
select doc_id, leaf, leaf5.h as subroot, top3.h as root, sha256(f.proof) as proof_sha256,
  f.f as folded_root, f.f = top3.h as verified
from f{at} f join leaf5 on leaf5.g = f.g cross join top3
"""


MANIFEST = _manifest()

_KEY = f"translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}')"

LINE_DEDUP = f"""
with lines as (
  select row, doc_id, unnest(string_split(text, chr(10))) as line,
    unnest(range(len(string_split(text, chr(10))))) as place
  from (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents)),
keyed as (select *, {_KEY} as key from lines),
common as (
  select key, max(doc_id) as keeper from keyed where length(key) >= {LEAST_CHARS}
  group by key having count(distinct row) >= {LEAST_DOCUMENTS}),
judged as (
  select k.*, c.key is not null and k.doc_id is distinct from c.keeper as gone
  from keyed k left join common c using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from judged group by row, doc_id
"""

_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

FILL_MIDDLE = f"""
with units as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_UNIT}') as u,
    sha256('{SEED}:' || coalesce(cast(doc_id as varchar), 'null')) as h
  from documents),
drawn as (
  select *, len(u) as n,
    list_transform([1, 9, 17, 25], lambda k: cast('0x' || substr(h, k, 8) as bigint)) as d
  from units),
cut as (
  select *, least(d[1] % (n + 1), d[2] % (n + 1)) as a, greatest(d[1] % (n + 1), d[2] % (n + 1)) as b,
    case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
      or d[3] % 100 >= {REARRANGED} then 'plain'
    when d[4] % 100 < {SUFFIX_FIRST} then 'spm' else 'psm' end as form
  from drawn),
parts as (
  select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m,
    array_to_string(u[b + 1:], '') as s
  from cut)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_sharding": SHARDING,
        "op3_chat": CHAT,
        "op11_manifest": MANIFEST,
        "op12_line_dedup": LINE_DEDUP,
        "op13_fill_middle": FILL_MIDDLE,
    }
