"""SQL counterparts for DuckDB of the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"



def _code_rounds(rounds: int) -> str:
    """Assignments and codebooks of each round, unrolled."""
    out = []
    for k in range(rounds + 1):
        out.append(f"""
near{k} as materialized (
  select r, p, min(struct_pack(d := d, e := e)) as best
  from (select a.r, a.p, b.e, list_sum(list_transform(range(1, len(a.u) + 1), lambda i: (a.u[i] - b.u[i]) * (a.u[i] - b.u[i])))::bigint as d
        from parts a join book{k} b using (p))
  group by r, p)""")
        if k < rounds:
            out.append(f"""
sums{k} as (
  select p, e, c, sum(x)::bigint as s, count(*)::bigint as n
  from (select a.p, n.best.e as e, unnest(a.u) as x, generate_subscripts(a.u, 1) as c from parts a join near{k} n using (r, p))
  group by p, e, c),
book{k + 1} as materialized (
  select p, e, coalesce(m.u, b.u) as u
  from book{k} b left join (
    select p, e, list((s - ((s % n) + n) % n) // n order by c) as u from sums{k} group by p, e) m using (p, e))""")
    return ",".join(out)


ORACLES = {
    "op2_mixing": r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('mix-1:' || coalesce(doc_id::varchar, '')) as place
  from documents),
sources as (
  select *, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight
  from (select source, sum(size)::double as source_size from sized group by source)),
ranked as (
  select *, 3.0 * source_size as cap, row_number() over (order by 3.0 * source_size / weight, source nulls last) as k from sources),
levels as (
  select k, cap / weight as ratio,
         (sum(source_size) over () - (sum(cap) over (order by k) - cap)) / (sum(weight) over () - (sum(weight) over (order by k) - weight)) as level
  from ranked),
level as (select level from levels where ratio >= level order by k limit 1),
plan as (
  select source, source_size, least(cap, weight * (select level from level)) as target from ranked),
rates as (
  select *, floor(case when source_size > 0 then target / source_size else 0 end + 1e-12)::bigint as whole from plan),
rests as (
  select *, greatest(0, round(target - whole * source_size))::bigint as rest from rates),
steps as (
  select source, place, sum(n) over (partition by source order by place) - n as before, n
  from (select source, place, sum(size)::bigint as n from sized where size > 0 group by source, place))
select s.doc_id, s.size, r.source_size::bigint as source_size, r.target,
       (r.whole * s.size + case
          when t.before is null then 0
          when t.before + t.n <= r.rest then s.size
          when t.before >= r.rest then 0
          else floor((r.rest - t.before) * s.size / t.n)::bigint end)::bigint as taken
from sized s
join rests r on s.source is not distinct from r.source
left join steps t on s.source is not distinct from t.source and s.place = t.place
""",
    "op9_line_dedup": f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (select *, translate(trim(line, {SPACE}), '{UPPER}', '{LOWER}') as key from lines),
refs as (
  select key, count(distinct doc_id) as n_docs, max(doc_id) as last_doc from keyed where length(key) >= 20 group by key),
judged as (
  select k.*, coalesce(r.n_docs >= 3 and k.doc_id <> r.last_doc, false) as gone
  from keyed k left join refs r on k.key = r.key)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
""",
    "op11_vector_codes": f"""
with kept as materialized (
  select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (
  select r, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] as u from kept, (select unnest(range(8)) as p)),
book0 as materialized (
  select p, e, u from parts join (select r, row_number() over (order by vec_id) - 1 as e from kept order by vec_id limit 16) using (r)),
{_code_rounds(6)},
coded as (
  select r, string_agg(printf('%02x', best.e), '' order by p) as code, sum(best.d)::bigint as error from near6 group by r),
labels as (select label, sum(error)::bigint as label_error from coded join kept using (r) group by label),
books as (
  select sha256(string_agg(array_to_string(u, ','), ',' order by p, e)) as codebooks_sha256 from book6)
select vec_id, code, error, label_error, codebooks_sha256
from kept join coded using (r) join labels on kept.label is not distinct from labels.label, books
""",
}
