"""The same results in plain SQL, written from the operator definitions for a SQL engine."""

from __future__ import annotations

N = 18
F = [f"f{i}" for i in range(N)]
T0 = ("1997-07-01", "1998-01-01")
T1 = ("1997-10-01", "1998-04-01")
MEASURES = F[:11]
LISTS = ["f11", "f14", "f15", "f16"]
LEVELS = ("LEVEL_OF_RISK", "LEVEL_OF_VIGILANCE", "LIST")
LEVEL_VALUES = {
    "LEVEL_OF_RISK": ("PROHIBITED", "HIGH", "HIGH", "STANDARD", "STANDARD", "MEDIUM"),
    "LEVEL_OF_VIGILANCE": ("PROHIBITED", "ENHANCED", "ENHANCED", "STANDARD", "ENHANCED UK/US", "ENHANCED"),
    "LIST": ("PROHIBITED", "RED", "RED", "GREEN", "GREEN", "AMBER"),
}


def listing(window: tuple[str, str]) -> str:
    a, b = window
    return (
        f"select distinct o_custkey, o_orderkey % {N} as flag_no from orders "
        f"where o_orderdate >= timestamp '{a}' and o_orderdate < timestamp '{b}'"
    )


def wide(window: tuple[str, str]) -> str:
    ones = ", ".join(f"max(case when flag_no = {i} then 1 else 0 end) as l{i}" for i in range(N))
    return f"select o_custkey, {ones} from ({listing(window)}) group by o_custkey"


def register(window: tuple[str, str], unnamed: bool = False) -> str:
    name = "case when c_custkey % 97 = 0 then 'CUBA' else upper(c_name) end"
    if unnamed:
        name = f"case when c_custkey % 89 = 0 then null else {name} end"
    flags = ", ".join(
        f"case when l{i} = 1 then 'YES' when c_custkey % 23 = {i} then null else 'NO' end as f{i}" for i in range(N)
    )
    return (
        f"select c_custkey as id, {name} as name_eng, "
        f"case when c_acctbal >= 0 then cast(floor(c_acctbal / 100) as integer) end as cpi_score, {flags} "
        f"from customer left join ({wide(window)}) on c_custkey = o_custkey"
    )


def rule(prefix: str = "") -> str:
    def every(cols, value):
        return "(" + " and ".join(f"{prefix}{c} = '{value}'" for c in cols) + ")"

    def some(cols, value):
        return "(" + " or ".join(f"{prefix}{c} = '{value}'" for c in cols) + ")"

    p = prefix
    return (
        f"case when {p}f13 = 'YES' or {p}name_eng = 'CUBA' then 1 "
        f"when {some(LISTS, 'YES')} and {p}f13 = 'NO' then 2 "
        f"when {some(MEASURES, 'YES')} and {every(LISTS, 'NO')} and {p}f17 = 'NO' then 3 "
        f"when {p}cpi_score >= 50 then 4 "
        f"when ({p}f17 = 'YES' or {p}f12 = 'YES') and {every(MEASURES, 'NO')} and {every(LISTS, 'NO')} then 5 "
        f"else 6 end"
    )


def levelled(source: str) -> str:
    columns = ", ".join(
        "case rule_no " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(LEVEL_VALUES[name], 1)) + f" end as {name}"
        for name in LEVELS
    )
    return f"select * exclude (rule_no), {columns} from (select *, {rule()} as rule_no from ({source}))"


def cells(old: str, new: str, columns) -> str:
    parts = [
        f"select o.id, '{c}' as \"column\", cast(o.{c} as varchar) as old, cast(n.{c} as varchar) as new "
        f"from olds o join news n on o.id = n.id where o.{c} is distinct from n.{c}"
        for c in columns
    ]
    return f"with olds as ({old}), news as ({new}) " + " union all ".join(parts)


DIFF_COLUMNS = ("name_eng", "cpi_score", *F, *LEVELS)
DIFF = cells(levelled(register(T0)), levelled(register(T1)), DIFF_COLUMNS)

POLICY = {
    **{i: "U5" for i in range(8)},
    **{i: "U4" for i in (8, 9, 10)},
    11: "U1", 12: "U3", 13: "U1", 14: "U2", 15: "U3", 16: "U2M", 17: "U2M",
}


def updated(unnamed: bool, by_name: bool = False) -> str:
    """Register T0 after listing T1; rows without a name cannot be listed.

    ``by_name``: the listing holds customer names, which rows called CUBA do not have.
    """
    findable = "name_eng is not null" + (" and name_eng <> 'CUBA'" if by_name else "")
    out = []
    for i in range(N):
        hit = f"(coalesce(l{i}, 0) = 1 and {findable})"
        listed = f"(select count(*) > 0 from t1 where flag_no = {i})"
        matched = (
            f"(select count(*) > 0 from t1 join reg r on r.id = t1.o_custkey "
            f"where t1.flag_no = {i} and {findable})"
        )
        kind = POLICY[i]
        others = {
            "U1": f"when name_eng is null then f{i} else 'NO'",
            "U2": f"when name_eng is null then f{i} else 'NO'",
            "U2M": f"when name_eng is null then f{i} else 'NO'",
            "U3": "else 'NO'",
            "U4": f"when f{i} = 'YES' and name_eng is not null then 'NO' else f{i}",
            "U5": f"when name_eng is null then f{i} else 'NO'",
        }[kind]
        guard = {"U4": matched, "U2M": f"({listed} and {matched})"}.get(kind, listed)
        out.append(f"case when {guard} then case when {hit} then 'YES' {others} end else f{i} end as f{i}")
    return (
        f"with t1 as ({listing(T1)}), reg as ({register(T0, unnamed)}), w as ({wide(T1)}) "
        f"select id, name_eng, cpi_score, {', '.join(out)} from reg left join w on reg.id = w.o_custkey"
    )


def policy(*numbers: int) -> str:
    return f"select id, {', '.join(f'f{i}' for i in numbers)} from ({updated(True)})"


LETTERS = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
ASCII = "AAAAAACEEEEIIIINOOOOOUUUUY"


def fold(x: str) -> str:
    stripped = f"regexp_replace({x}, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g')"
    return f"translate(upper(replace({stripped}, 'ß', 'ss')), '{LETTERS}', '{ASCII}')"


LINES = (
    "select doc_id, cast(pos - 1 as integer) as pos, lines[pos] as line from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as pos "
    "from (select doc_id, string_split(text, chr(10)) as lines from documents))"
)
NAMED = "'CUSTOMER#' || lpad(cast(o_custkey as varchar), 9, '0')"
YES_ROWS = " union all ".join(f"select 'f{i}' as flag, id, name_eng from r where f{i} = 'YES'" for i in range(N))
CHECKED = " union all ".join(
    f"select id, 'f{i}' as \"column\", coalesce(f{i}, 'NO') as old, case when l{i} = 1 then 'YES' else 'NO' end as new "
    f"from r left join w on r.id = w.o_custkey"
    for i in range(N)
)
CHECKED_LISTED = " union all ".join(
    f"select id, 'f{i}' as \"column\", f{i} as old, 'YES' as new from r join w on r.id = w.o_custkey where l{i} = 1"
    for i in range(N)
)
HTML_TEXT = (
    "regexp_replace(replace(replace(replace(replace(replace(regexp_replace({0}, '<[^>]*>', '', 'g'), '&lt;', '<'), "
    "'&gt;', '>'), '&quot;', '\"'), '&nbsp;', chr(160)), '&amp;', '&'), '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g')"
)


def unnested(table: str, key: str, array: str, value: str) -> str:
    return (
        f"select {key}, cast(pos - 1 as integer) as pos, items[pos] as {value} from (select {key}, items, "
        f"unnest(range(1, len(items) + 1)) as pos from (select {key}, {array} as items from {table}))"
    )


def _split_names(text: str, first: bool) -> str:
    trimmed = "regexp_replace({0}, '\\s*\\([^)]*\\)', '', 'g')"
    if not first:
        array = f"list_transform(string_split(trim({trimmed.format(text)}), ','), lambda p: upper(trim(p)))"
    else:
        array = (
            f"list_transform(string_split(replace(upper({text}), ' AND ', ', '), ','), "
            f"lambda p: trim({trimmed.format('p')}))"
        )
    return unnested("part", "p_partkey", array, "name").replace("select p_partkey,", "select p_partkey as key,", 1)


STRIP = "regexp_replace({0}, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g')"
SHORT = "length(line) < 60"


def kept(condition: str, value: str, column: str) -> str:
    """Lines that satisfy a condition, renumbered in order."""
    return (
        f"select doc_id, cast(row_number() over (partition by doc_id order by pos) - 1 as integer) as pos, {value} as {column} "
        f"from ({LINES}) where {condition}"
    )


UNTIL = (
    f"with l as ({LINES}), s as (select doc_id, min(pos) as stop from l where {SHORT} group by doc_id) "
    f"select l.doc_id, pos, {STRIP.format('line')} as text from l left join s on l.doc_id = s.doc_id where stop is null or pos < stop"
)
PAGES_FOR_SCORE = (
    "select *, case when c_acctbal < 0 then 404 when c_nationkey = 7 then 500 else 200 end as status from customer "
    "where c_mktsegment <> 'MACHINERY'"
)


def listed(source: str, flag: str, number: int, extra: tuple[str, ...] = ()) -> str:
    """Names that orders of window T1 list under a flag, and names that every page adds."""
    rows = f"select '{source}' as source, {NAMED} as name, '{flag}' as flag, 'YES' as status from ({listing(T1)}) where flag_no = {number}"
    for name in extra:
        rows += f" union select '{source}', '{name}', '{flag}', 'YES' from ({listing(T1)}) where flag_no = {number}"
    return rows


def parsed(source: str, flags: dict[int, str]) -> str:
    """All flags of every entity that is listed under one of them; rows called CUBA are not found."""
    one = " union all ".join(
        f"select {NAMED} as name, '{flag}' as flag, case when l{i} = 1 then 'YES' else 'NO' end as status from w where {{0}}"
        for i, flag in flags.items()
    )
    some = "(" + " or ".join(f"l{i} = 1" for i in flags) + ") and o_custkey % 97 <> 0"
    return f"with w as ({wide(T1)}) select '{source}' as source, * from ({one.format(some)})"


FR_FLAGS = dict(enumerate((
    "FR_ASSET_FREEZE", "FR_SECTORAL_EMBARGO", "FR_MILITARY_EMBARGO", "FR_INTERNAL_REPRESSION_EQUIPMENT",
    "FR_INTERNAL_REPRESSION", "FR_SECTORAL_RESTRICTIONS", "FR_FINANCIAL_RESTRICTIONS", "FR_TRAVEL_BANS",
)))
EU_FLAGS = dict(enumerate(
    ("EU_ASSET_FREEZE_AND_PROHIBITION_TO_MAKE_FUNDS_AVAILABLE", "EU_INVESTMENTS", "EU_FINANCIAL_MEASURES"), start=8
))

ORACLES: dict[str, str] = {
    "ladder_levels": f"select id, {', '.join(LEVELS)} from ({levelled(register(T1))})",
    "ladder_rule_counts": f"select {rule()} as rule_no, count(*) as n from ({register(T1)}) group by 1",
    "fold_names": f"select doc_id, {fold('text')} as folded from documents",
    "split_names": _split_names("p_name || ' (' || p_brand || '), ' || p_type", False),
    "split_names_first": _split_names("p_name || ' (' || p_brand || ', x), ' || p_type || ' and more'", True),
    "program_tokens": (
        "select distinct token from (select unnest(regexp_split_to_array(upper(o_orderpriority) || '; ' || "
        "o_orderstatus, '[;\\s]\\s*')) as token from orders) where token <> ''"
    ),
    "parse_values": (
        "select c_custkey as id, case when c_acctbal >= 0 then cast(trunc(cast(c_acctbal as decimal(12,2))) as integer) end as score, "
        "case when c_custkey % 7 <> 0 then cast(c_custkey as integer) end as rank, c_custkey % 7 = 0 as rank_error from customer"
    ),
    "alias_resolve": (
        "select c_custkey, coalesce(to_name, n_name) as name from customer join nation on c_nationkey = n_nationkey "
        "left join (values ('NATION_3', 'NATION_30'), ('NATION_4', 'NATION_40'), ('NATION_4', 'NATION_41')) "
        "as a(from_name, to_name) on n_name = from_name"
    ),
    "membership_semi": f"select c_custkey from customer where c_custkey in (select o_custkey from ({listing(T1)}) where flag_no = 0)",
    "membership_anti": f"select c_custkey from customer where c_custkey not in (select o_custkey from ({listing(T1)}) where flag_no = 0)",
    "status_for_all": (
        f"select c_custkey, case when c_custkey in (select o_custkey from ({listing(T1)}) where flag_no = 0) "
        "then 'YES' else 'NO' end as status from customer"
    ),
    "current_flags": (
        f"select name_eng as name, f0, f11 from ({register(T0)}) where name_eng in "
        "(select upper(c_name) from customer where c_acctbal < 0)"
    ),
    "policy_u1": policy(11, 13),
    "policy_u2": policy(14, 16, 17),
    "policy_u3": policy(12, 15),
    "policy_u4": policy(8, 9, 10),
    "policy_u5": policy(*range(8)),
    "policy_u6": (
        "select r.id, case when s_suppkey is null then cpi_score "
        "when s_acctbal >= 0 then cast(floor(s_acctbal / 100) as integer) end as cpi_score "
        f"from ({register(T0)}) r left join supplier on r.id = s_suppkey"
    ),
    "or_merge": (
        f"select o_custkey, o_orderkey % {N} as flag_no, max(case when o_totalprice > 100000 then 'YES' else 'NO' end) as status "
        f"from orders where o_orderdate >= timestamp '{T1[0]}' and o_orderdate < timestamp '{T1[1]}' group by 1, 2"
    ),
    "listing_pivot": "select o_custkey, "
    + ", ".join(f"case when l{i} = 1 then 'YES' else 'NO' end as f{i}" for i in range(N))
    + f" from ({wide(T1)})",
    "update_cells": (
        f"with c as (select {NAMED} as name, o_orderkey % {N} as flag_no, "
        "max(case when o_totalprice > 100000 then 'YES' else 'NO' end) as status from orders "
        f"where o_orderdate >= timestamp '{T1[0]}' and o_orderdate < timestamp '{T1[1]}' group by 1, 2), "
        "w as (select name, " + ", ".join(f"max(case when flag_no = {i} then status end) as s{i}" for i in range(N))
        + " from c group by name) select id, " + ", ".join(f"coalesce(s{i}, f{i}) as f{i}" for i in range(N))
        + f" from ({register(T0)}) r left join w on r.name_eng = w.name"
    ),
    "names_per_flag": (
        f"with r as ({register(T1)}), y as ({YES_ROWS}), d as (select distinct flag, name_eng as name from y) "
        "select flag, count(*) over (partition by flag) as n_names, name from d"
    ),
    "flag_summary": f"with r as ({register(T1)}) {YES_ROWS}",
    "unmatched_names": (
        f"select distinct o_custkey as name from ({listing(T1)}) where o_custkey not in "
        "(select c_custkey from customer where c_mktsegment <> 'BUILDING')"
    ),
    "attribute_lines": (
        "select conv_id, turn, max(case when role = 'user' then turn end) over (partition by conv_id order by turn "
        "rows between unbounded preceding and current row) as open_turn from conversations"
    ),
    "attribute_doc_lines": (
        "select doc_id, cast(pos as integer) as pos, cast(max(case when length(line) < 60 then pos end) over (partition by doc_id order by pos "
        f"rows between unbounded preceding and current row) as integer) as open_pos from ({LINES})"
    ),
    "tag_measures": (
        f"with t as (select doc_id, {fold('line')} as line from ({LINES})) "
        + " union all ".join(
            f"select doc_id, '{flag}' as flag, case when bool_or(regexp_matches(line, '{pattern}')) then 'YES' else 'NO' end as status "
            "from t group by doc_id"
            for pattern, flag in ((r"\bTHE\b", "the"), (r"\bUND\b", "und"), (r"\bLES?\b", "les"))
        )
    ),
    "take_until": (
        f"with l as ({LINES}), s as (select doc_id, min(pos) as stop from l where length(line) < 60 group by doc_id) "
        "select l.doc_id, cast(pos as integer) as pos from l left join s on l.doc_id = s.doc_id where stop is null or pos < stop"
    ),
    "take_until_turns": (
        "select conv_id, turn from conversations c where turn < coalesce((select min(turn) from conversations s "
        "where s.conv_id = c.conv_id and s.role = 'assistant'), turn + 1)"
    ),
    "page_links": unnested("pages", "page_id", "regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)", "href"),
    "list_items": "select page_id, pos, " + HTML_TEXT.format("item") + " as text from ("
    + unnested("pages", "page_id", "regexp_extract_all(html, '<li>(.*?)</li>', 1)", "item") + ")",
    "latest_publication": (
        "select o_orderkey, case when month(o_orderdate) >= 10 then 'october' when month(o_orderdate) >= 6 then 'june' "
        "when month(o_orderdate) >= 2 then 'february' else 'october' end as month, "
        "cast(case when month(o_orderdate) < 2 then year(o_orderdate) - 1 else year(o_orderdate) end as integer) as year from orders"
    ),
    "latest_snapshot": (
        "select o_custkey, o_orderdate, o_orderkey, o_orderstatus from (select *, row_number() over (partition by o_custkey "
        "order by o_orderdate desc, o_orderkey desc) as rn from orders where o_orderdate < timestamp '1998-01-01') where rn = 1"
    ),
    "slug_semi": f"select c_custkey from customer where lower(c_name) in (select lower({NAMED}) from ({listing(T1)}))",
    "match_theta": (
        "select c_custkey from customer join nation on c_nationkey = n_nationkey "
        "where n_name = 'NATION_2' or regexp_matches(n_name, 'NATION_1[0-9]')"
    ),
    "diff_snapshots": DIFF,
    "diff_versions": DIFF,
    "versions_in_place": f"select * from ({register(T1)}) where id not between 301 and 500",
    "transitions": (
        f"select \"column\", old || '->' || new as direction, count(*) as n from ({DIFF}) "
        "where old in ('YES', 'NO') and new in ('YES', 'NO') group by 1, 2"
    ),
    "diff_sentinel": (
        "select cast(-1 as bigint) as id, 'None' as \"column\", 'No changes detected' as old, 'No changes detected' as new"
    ),
    "check_changes_null_as_no": f"with r as ({register(T0)}), w as ({wide(T1)}) select * from ({CHECKED}) where old <> new",
    "check_changes_listed": (
        f"with r as ({register(T0)}), w as ({wide(T1)}) select * from ({CHECKED_LISTED}) where old is distinct from new"
    ),
    "dedupe_last_wins": f"select sha256({fold('text')}) as digest, max(doc_id) as doc_id from documents group by 1",
    "union_listings": (
        f"with a as (select o_custkey, o_orderkey % {N} as flag_no from orders where o_orderdate >= timestamp '{T0[0]}' "
        f"and o_orderdate < timestamp '{T0[1]}'), b as (select o_custkey, o_orderkey % {N} as flag_no from orders "
        f"where o_orderdate >= timestamp '{T1[0]}' and o_orderdate < timestamp '{T1[1]}'), "
        "u as (select o_custkey, flag_no, count(*) as n from (select * from a union all select * from b) group by 1, 2) "
        "select o_custkey, flag_no, n, (o_custkey, flag_no) in (select (o_custkey, flag_no) from (select * from a intersect select * from b)) "
        "as in_both from u"
    ),
    "audit_ids": (
        "select row_number() over (order by id, \"column\") as \"AuditID\", id as \"SanctionsMapId\", \"column\" as \"ColumnName\" "
        f"from ({DIFF}) where old = 'NO' and new = 'YES'"
    ),
    "full_run": cells(levelled(register(T0)), levelled(updated(False)), DIFF_COLUMNS),
    "document_page_lines": f"select doc_id, line from ({LINES}) where doc_id in (select doc_id from documents where length(text) > 0)",
    "first_column": f"select doc_id, pos, {STRIP.format('line')} as name from ({LINES})",
    "first_column_after_header": f"select doc_id, pos, {STRIP.format('line')} as name from ({LINES})",
    "definitions": (
        "select 'https://www.transparency.org/en/countries/' || lower(c_name) as url, status = 200 as has_term, "
        "case when status = 200 and c_custkey % 13 <> 0 then cast(cast(c_acctbal as decimal(12,2)) as varchar) || '/100' end as value "
        f"from ({PAGES_FOR_SCORE})"
    ),
    "bold_headings": kept(f"not ({SHORT})", STRIP.format("line"), "name"),
    "paragraph_after": f"select doc_id, {STRIP.format('text')} as text from documents",
    "bold_items_until": UNTIL,
    "bold_spans": kept(f"not ({SHORT})", STRIP.format("line"), "text"),
    "list_items_after": f"select doc_id, pos, {STRIP.format('line')} as text from ({LINES})",
    "link_titles": kept(f"not ({SHORT})", STRIP.format("'Financial sanctions, ' || line"), "text"),
    "links_after": kept(f"not ({SHORT})", "'https://example.org/a?b=1&c=2'", "href"),
    "first_column_nested": (
        f"select doc_id, 2 * pos as pos, {STRIP.format("line || 'in'")} as name from ({LINES}) "
        f"union all select doc_id, 2 * pos + 1, 'in' from ({LINES})"
    ),
    "link_titles_nested": kept(f"not ({SHORT})", STRIP.format("'Financial sanctions, ' || line"), "text"),
    "links_after_coded": f"select doc_id, pos from ({kept(f'not ({SHORT})', 'line', 'line')})",
    "as_of_publication": """
select o.o_orderkey, p.price
from orders o asof left join (
  select o_custkey, o_orderdate, max(o_totalprice) as price from orders where o_orderpriority = '1-URGENT' group by 1, 2) p
on o.o_custkey = p.o_custkey and o.o_orderdate >= p.o_orderdate
""",
    "match_patterns": r"""
with asked as (
  select s_suppkey, lpad(s_suppkey::varchar, 4, '0') as number, lpad((s_suppkey // 50)::varchar, 2, '0') as part from supplier)
select c_custkey, s_suppkey
from customer join asked on regexp_matches(c_name, case
  when s_suppkey % 50 = 0 then '0[1-3]' || part || '$'
  when s_suppkey % 3 = 0 then '^Customer#0*[1-9]?' || number || '$'
  when s_suppkey % 3 = 1 then '(?:Customer|Supplier)#\d+' || number || '$'
  else number || '[^a-z]?$' end)
""",
    "page_state": f"""
with orders_in as (
  select o_custkey, o_orderkey % {N} as f, timestamp '1998-03-01' as landed from orders, range(2)
  where o_orderdate >= timestamp '{T0[0]}' and o_orderdate < timestamp '{T0[1]}'
  union all
  select o_custkey, o_orderkey % {N}, timestamp '1998-04-01' from orders
  where o_orderdate >= timestamp '{T1[0]}' and o_orderdate < timestamp '{T1[1]}'),
pages as (
  select source, '' as url, landed from orders_in
  join (values (11, 'EU_AML'), (13, 'FATF_CALL'), (14, 'FATF_MONITORING'), (15, 'EU_TAX'), (16, 'FR_TAX'), (17, 'UK')) s(f, source) using (f)
  union all select 'FR_MEASURES', unnest(['index', o_custkey::varchar]), landed from orders_in where f < 8),
current as (select * from pages qualify landed = max(landed) over (partition by source, url))
select source, count(*) as n_pages, count(distinct url) as n_urls, max(landed) as latest from current group by source
""",
    "source_cpi": (
        "select r.id, case when name_eng = 'CUBA' or status is null or status = 404 then null "
        "when status = 500 or c_custkey % 13 = 0 then cpi_score "
        "else cast(trunc(cast(c_acctbal as decimal(12,2))) as integer) end as cpi_score "
        f"from ({register(T0)}) r left join ({PAGES_FOR_SCORE}) p on r.id = p.c_custkey"
    ),
    "source_eu_aml": listed("EU_AML", "EU_AML_HIGH_RISK_COUNTRIES", 11),
    "source_eu_measures": parsed("EU_MEASURES", EU_FLAGS),
    "source_eu_tax": listed("EU_TAX", "EU_LIST_OF_NON_COOPERATIVE_JURISDICTIONS", 15, ("ATLANTIS",))
    + "".join(
        f" union select 'EU_TAX', '{name}', null, 'UNDER WAY' from ({listing(T1)}) where flag_no = 15"
        for name in ("AVALON", "LYONESSE")
    ),
    "source_fatf_call": listed("FATF_CALL", "FATF_HIGH_RISK_JURISDICTIONS_SUBJECT_TO_A_CALL_FOR_ACTION", 13),
    "source_fatf_monitoring": listed("FATF_MONITORING", "FATF_JURISDICTIONS_UNDER_INCREASED_MONITORING", 14, ("NOWHERE",)),
    "source_fr_measures": parsed("FR_MEASURES", FR_FLAGS),
    "source_fr_tax": listed("FR_TAX", "FR_LIST_OF_NON_COOPERATIVE_JURISDICTIONS", 16),
    "source_us_programmes": listed("US", "US_OFAC_SANCTIONS", 12, ("SDGT", "NPWMD")),
    "source_uk": listed("UK", "UK_FINANCIAL_SANCTIONS", 17),
    "run_from_publications": cells(levelled(register(T0)), levelled(updated(False, by_name=True)), DIFF_COLUMNS),
}
