"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import bindings as B
from checks import publications as P
from vigilframe import schema as S
from vigilframe.functions import names as N
from vigilframe.operators import asof, audit, extract, lines, listing, match, patterns, update
from vigilframe.operators.lineage import landed, scratch_path
from vigilframe.operators.ladder import with_levels, with_rule_no
from vigilframe.plans import updaters
from vigilframe.plans.run import changes_of, kind_masks, propose
from vigilframe.schema import BOUND, LEVELS
from vigilframe.sources.versions import VersionedTable
from vigilframe.streaming.state import PageState

Query = Callable[[SparkSession, str], DataFrame]

FLAG_COLUMNS = dict(enumerate(BOUND.flags))
WORD_PATTERNS = ((r"\bTHE\b", "the"), (r"\bUND\b", "und"), (r"\bLES?\b", "les"))


def ladder_levels(spark, sf):
    return with_levels(B.register(spark, sf, B.T1), BOUND).select("id", *LEVELS)


def ladder_rule_counts(spark, sf):
    numbered = with_rule_no(B.register(spark, sf, B.T1), BOUND)
    return numbered.groupBy("rule_no").agg(F.count(F.lit(1)).alias("n"))


def fold_names(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", N.fold_name(F.col("text")).alias("folded"))


def split_names(spark, sf):
    text = F.concat("p_name", F.lit(" ("), "p_brand", F.lit("), "), "p_type")
    part = B.table(spark, sf, "part")
    return part.select(F.col("p_partkey").alias("key"), F.posexplode(N.split_names(text)).alias("pos", "name"))


def split_names_first(spark, sf):
    text = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(", x), "), "p_type", F.lit(" and more"))
    names = N.split_names(text, pre_split=True, and_as_comma=True)
    part = B.table(spark, sf, "part")
    return part.select(F.col("p_partkey").alias("key"), F.posexplode(names).alias("pos", "name"))


def program_tokens(spark, sf):
    text = F.concat(F.upper("o_orderpriority"), F.lit("; "), "o_orderstatus").alias("programme")
    # Programme texts repeat; they are made distinct before they are cut up.
    texts = B.table(spark, sf, "orders").select(text).distinct()
    return texts.select(F.explode(N.program_tokens(F.col("programme"))).alias("token")).distinct()


def parse_values(spark, sf):
    customer = B.table(spark, sf, "customer")
    # Every seventh rank is a fraction, balances below zero have no score.
    score = F.when(F.col("c_acctbal") >= 0, F.concat(F.col("c_acctbal").cast("decimal(12,2)").cast("string"), F.lit("/100")))
    rank = F.concat(
        F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 7 == 0, ".5").otherwise(""), F.lit(" /180")
    )
    return customer.select(
        F.col("c_custkey").alias("id"),
        N.parse_score(F.coalesce(score, F.lit("n.a."))).alias("s"),
        N.parse_rank(rank).alias("r"),
    ).select(
        "id", F.col("s.value").alias("score"), F.col("r.value").alias("rank"), F.col("r.error").alias("rank_error")
    )


def alias_resolve(spark, sf):
    customer = B.table(spark, sf, "customer")
    nation = B.table(spark, sf, "nation")
    names = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.lit("N").alias("source"), F.col("n_name").alias("name")
    )
    aliases = spark.createDataFrame(
        [("N", "NATION_3", "NATION_30"), ("N", "NATION_4", "NATION_40"), ("N", "NATION_4", "NATION_41")],
        "source string, from_name string, to_name string",
    )
    return listing.apply_aliases(names, aliases).select("c_custkey", "name")


def _flag_zero(spark, sf):
    return B.listing(spark, sf, B.T1).where(F.col("flag_no") == 0).select(F.col("o_custkey").alias("name"))


def _customers(spark, sf):
    return B.table(spark, sf, "customer").select("c_custkey")


def membership_semi(spark, sf):
    return match.members(_customers(spark, sf), _flag_zero(spark, sf), "c_custkey")


def membership_anti(spark, sf):
    return match.non_members(_customers(spark, sf), _flag_zero(spark, sf), "c_custkey")


def status_for_all(spark, sf):
    return match.status_for_all(_customers(spark, sf), _flag_zero(spark, sf), "c_custkey")


def current_flags(spark, sf):
    reg = B.register(spark, sf, B.T0)
    asked = B.table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select(F.upper("c_name").alias("name"))
    return match.current_flags(reg, asked, "name_eng", ["f0", "f11"])


def policy_u1(spark, sf):
    return B.after_policies(spark, sf, (S.EU_AML, S.FATF_CALL))


def policy_u2(spark, sf):
    return B.after_policies(spark, sf, (S.FATF_MONITORING, S.FR_TAX, S.UK))


def policy_u3(spark, sf):
    return B.after_policies(spark, sf, (S.US_PROGRAMMES, S.EU_TAX))


def policy_u4(spark, sf):
    return B.after_policies(spark, sf, S.EU_MEASURE_FLAGS)


def policy_u5(spark, sf):
    return B.after_policies(spark, sf, S.FR_MEASURE_FLAGS)


def policy_u6(spark, sf):
    fetched = B.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_acctbal") >= 0, F.floor(F.col("s_acctbal") / 100).cast("int")).alias("cpi_score"),
    )
    reg = B.register(spark, sf, B.T0)
    return update.update_values(reg, fetched, "id", ["cpi_score"]).select("id", "cpi_score")


def or_merge(spark, sf):
    status = F.when(F.col("o_totalprice") > 100000, "YES").otherwise("NO").alias("status")
    flag_no = (F.col("o_orderkey") % B.N_FLAGS).alias("flag_no")
    rows = B.window_orders(spark, sf, B.T1).select("o_custkey", flag_no, status)
    return listing.or_merge(rows, ["o_custkey", "flag_no"])


def listing_pivot(spark, sf):
    return listing.unpack_flags(B.masks(spark, sf, B.T1), ["o_custkey"], BOUND.flags)


def update_cells(spark, sf):
    status = F.when(F.col("o_totalprice") > 100000, "YES").otherwise("NO").alias("status")
    rows = B.window_orders(spark, sf, B.T1).select(
        F.concat(F.lit("CUSTOMER#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("name"),
        F.concat(F.lit("f"), F.col("o_orderkey") % B.N_FLAGS).alias("flag"),
        status,
    )
    reg = B.register(spark, sf, B.T0)
    updated = update.update_cells(reg, rows, BOUND, F.col("name_eng"), BOUND.flags)
    return updated.select("id", *BOUND.flags)


def names_per_flag(spark, sf):
    rows = listing.listing_rows(B.register(spark, sf, B.T1), ["id", "name_eng"], BOUND.flags)
    listed = rows.where(F.col("status") == "YES").select("flag", F.col("name_eng").alias("name"))
    return listing.names_per_flag(listed)


def flag_summary(spark, sf):
    return listing.flag_summary(B.register(spark, sf, B.T1), ["id", "name_eng"], BOUND.flags)


def unmatched_names(spark, sf):
    known = B.table(spark, sf, "customer").where(F.col("c_mktsegment") != "BUILDING").select("c_custkey")
    listed = B.listing(spark, sf, B.T1).select(F.col("o_custkey").alias("name"))
    return match.unmatched_names(listed, known, "c_custkey")


def attribute_lines(spark, sf):
    turns = B.table(spark, sf, "conversations").select("conv_id", "turn", "role")
    opener = F.when(F.col("role") == "user", F.col("turn"))
    carried = lines.attribute_lines(turns, ["conv_id"], "turn", opener, "open_turn")
    return carried.select("conv_id", "turn", "open_turn")


def _short(line):
    return F.length(line) < 60


def attribute_doc_lines(spark, sf):
    docs = B.table(spark, sf, "documents").select("doc_id", "text")
    return lines.attribute_doc_lines(docs, _short).select("doc_id", "pos", "open_pos")


def tag_measures(spark, sf):
    texts = lines.document_lines(B.table(spark, sf, "documents"))
    folded = texts.select("doc_id", N.fold_name(F.col("line")).alias("line"))
    return lines.tag_measures(folded, ["doc_id"], "line", WORD_PATTERNS)


def take_until(spark, sf):
    docs = B.table(spark, sf, "documents").select("doc_id", F.split("text", "\n", -1).alias("items"))
    return docs.select("doc_id", F.posexplode(lines.items_until(F.col("items"), _short)).alias("pos", "line")).drop("line")


def take_until_turns(spark, sf):
    turns = B.table(spark, sf, "conversations").select("conv_id", "turn", "role")
    kept = lines.take_until(turns, ["conv_id"], "turn", F.col("role") == "assistant")
    return kept.select("conv_id", "turn")


def page_links(spark, sf):
    return extract.links(B.table(spark, sf, "pages"), ["page_id"], body="html")


def list_items(spark, sf):
    return extract.list_items(B.table(spark, sf, "pages"), ["page_id"], body="html")


def latest_publication(spark, sf):
    orders = B.table(spark, sf, "orders")
    found = orders.select("o_orderkey", N.latest_publication(F.col("o_orderdate")).alias("p"))
    return found.select("o_orderkey", F.col("p.month").alias("month"), F.col("p.year").alias("year"))


def latest_snapshot(spark, sf):
    orders = B.table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    as_of = F.lit("1997-12-31").cast("timestamp")
    return listing.latest_snapshot(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], as_of)


def slug_semi(spark, sf):
    base = "https://example.org/lists/"
    reg = B.table(spark, sf, "customer").select("c_custkey", "c_name")
    listed = B.listing(spark, sf, B.T1).select(
        F.concat(F.lit(base + "customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("link")
    )
    slug = N.slug_fr(N.fold_name(F.col("c_name")))
    return match.reachable(reg, listed, slug, base).select("c_custkey")


def match_theta(spark, sf):
    customer = B.table(spark, sf, "customer")
    nation = B.table(spark, sf, "nation")
    reg = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    listed = nation.where(F.col("n_nationkey").isin(1, 2)).select(
        F.when(F.col("n_nationkey") == 1, "NATION TEENS").otherwise(F.col("n_name")).alias("name")
    )
    return match.match_names(reg, listed, "c_custkey", "n_name", {"NATION TEENS": "NATION_1[0-9]"})


def _diff(spark, sf):
    old = with_levels(B.register(spark, sf, B.T0), BOUND)
    new = with_levels(B.register(spark, sf, B.T1), BOUND)
    return audit.diff_snapshots(old, new, "id")


def diff_snapshots(spark, sf):
    return _diff(spark, sf)


def _versions(spark):
    return VersionedTable(spark, scratch_path(spark, "register"), "id", width=256)


def diff_versions(spark, sf):
    # Two stored versions compared from the top of their digest trees.
    table = _versions(spark)
    for at, version, base in ((B.T0, "1", None), (B.T1, "2", "1")):
        table.write(landed(with_levels(B.register(spark, sf, at), BOUND)), version, base)
    return table.diff("1", "2")


def versions_in_place(spark, sf):
    # Changed rows put into the key ranges that hold them, customers 301 to 500 taken out.
    table = _versions(spark)
    old, new = (landed(B.register(spark, sf, at)) for at in (B.T0, B.T1))
    table.write(old, "1")
    table.apply("2", "1", new.exceptAll(old).where("id NOT BETWEEN 301 AND 500"), new.where("id BETWEEN 301 AND 500"))
    return table.read("2")


def transitions(spark, sf):
    return audit.transitions(_diff(spark, sf))


def diff_sentinel(spark, sf):
    reg = with_levels(B.register(spark, sf, B.T0), BOUND)
    return audit.with_sentinel(audit.diff_snapshots(reg, reg, "id"))


def check_changes_null_as_no(spark, sf):
    reg = B.register(spark, sf, B.T0)
    hits = B.hits(reg, B.masks(spark, sf, B.T1))
    return audit.check_changes(reg, hits, "id", FLAG_COLUMNS, audit.CheckVariant(null_as_no=True, all_rows=True))


def check_changes_listed(spark, sf):
    reg = B.register(spark, sf, B.T0)
    hits = B.hits(reg, B.masks(spark, sf, B.T1))
    return audit.check_changes(reg, hits, "id", FLAG_COLUMNS, audit.CheckVariant())


def dedupe_last_wins(spark, sf):
    key = F.sha2(N.fold_name(F.col("text")), 256)
    return listing.dedupe_last_wins(B.table(spark, sf, "documents"), key, "doc_id", key_name="digest")


def union_listings(spark, sf):
    """Both windows in one table; rows of the union per (name, flag), and whether both list it."""
    old, new = (B.listing(spark, sf, w) for w in (B.T0, B.T1))
    both = listing.common_names(old, new, ["o_custkey", "flag_no"]).withColumn("in_both", F.lit(True))
    rows = listing.union_listings(old, new).groupBy("o_custkey", "flag_no").agg(F.count(F.lit(1)).alias("n"))
    joined = rows.join(both, ["o_custkey", "flag_no"], "left")
    return joined.select("o_custkey", "flag_no", "n", F.coalesce("in_both", F.lit(False)).alias("in_both"))


def audit_ids(spark, sf):
    changes = landed(audit.transitions_of(_diff(spark, sf), "NO", "YES"))
    rows = audit.audit_rows(changes, "id", F.lit("2024-01-01").cast("timestamp"))
    return rows.select("AuditID", "SanctionsMapId", "ColumnName")


def full_run(spark, sf):
    reg = B.register(spark, sf, B.T0)
    listed = B.masks(spark, sf, B.T1)
    pending = update.proposed(reg, B.hits(reg, listed), listed, BOUND)
    return audit.with_sentinel(changes_of(pending, reg.columns, BOUND))


def document_page_lines(spark, sf):
    return lines.page_lines(P.document_pages(spark, sf), separator="").select("doc_id", "line")


def first_column(spark, sf):
    row = "<tr><td>{}</td><td>1</td></tr>"
    pages = P.line_pages(spark, sf, "<TABLE id='t' class='wide ecl-table'><tr><th>Name</th></tr>", row, row, "</TABLE>")
    return extract.first_column(pages, ["doc_id"], table_class="ecl-table")


def first_column_after_header(spark, sf):
    row = "<tr><td> {} </td><td>1</td></tr>"
    head = "<table><tbody><tr><td>x</td></tr></tbody></table><table><thead><tr><th>La liste SOURCE</th></tr></thead><tbody>"
    pages = P.line_pages(spark, sf, head, row, row, "</tbody></table>")
    return extract.first_column(pages, ["doc_id"], after_header="Liste source")


def definitions(spark, sf):
    found = extract.definitions(P.score_pages(spark, sf), ["url", "status"], {"s": "Score"})
    return found.select("url", F.col("s.has_term").alias("has_term"), F.col("s.value").alias("value"))


def bold_headings(spark, sf):
    pages = P.line_pages(spark, sf, "<h1>t</h1>", "<h3>1. <b>{}</b></h3>", "<h3>{}</h3>", "")
    return extract.bold_headings(pages, ["doc_id"])


def paragraph_after(spark, sf):
    pages = P.text_pages(spark, sf, "<p>a</p><h6 class='cmp-title__text'>Country</h6><div><p>", "</p></div><p>b</p>")
    return extract.paragraph_after(pages, ["doc_id"], "h6", "Country", cls="cmp-title__text")


def bold_items_until(spark, sf):
    pages = P.line_pages(
        spark, sf, "<p class='oj-x'><span class='oj-bold'>no</span></p><p id=d1e39-2-1>I</p>",
        "<p class='oj-x'><span class='oj-bold'>{}</span></p>",
        "<p class='oj-x'><span class='oj-bold'>State of play {}</span></p>", "",
    )
    return extract.bold_items(pages, ["doc_id"], "oj-x", "oj-bold", anchor_id="d1e39-2-1", stop="State of play")


def bold_spans(spark, sf):
    pages = P.line_pages(
        spark, sf, "", "<p class='oj-normal'><span class='oj-bold'>{}</span></p>", "<p class='oj-normal'>{}</p>", ""
    )
    return extract.bold_items(pages, ["doc_id"], "oj-normal", "oj-bold")


def list_items_after(spark, sf):
    head = "<section class='page-section'><h2>Autres</h2><ul><li>no</li></ul><h4>Les Mesures restrictives</h4><p>:</p><ul>"
    pages = P.line_pages(spark, sf, head, "<li>{}</li>", "<li><a href='#'>{}</a>", "</ul></section>")
    return extract.list_items_after(pages, ["doc_id"], "page-section", "Mesures restrictives").drop("section")


def link_titles(spark, sf):
    block = "<div class='gem-c-document-list__item-title'><a href='#'>%s{}</a></div>"
    pages = P.line_pages(spark, sf, "", block % "Financial sanctions, ", block % "Notice ", "")
    return extract.link_titles(pages, ["doc_id"], "gem-c-document-list__item-title", "Financial sanctions")


def links_after(spark, sf):
    head = "<p><a href='no'>no</a></p><h2>1. Les listes</h2><p>"
    pages = P.line_pages(spark, sf, head, "<a class='x' href='https://example.org/a?b=1&amp;c=2'>{}</a>", "{}", "</p>")
    return extract.links(pages, ["doc_id"], after=("h2", "Les listes"))


def first_column_nested(spark, sf):
    """Every cell holds a table of its own, whose rows are rows too."""
    row = "<tr><td>{}<table><tr><td>in</td></tr></table></td><td>1</td></tr>"
    head = "<table><tr><td>no</td></tr></table><table class='ecl-table'>"
    pages = P.line_pages(spark, sf, head, row, row, "</table><table class='ecl-table'><tr><td>no</td></tr></table>")
    return extract.first_column(pages, ["doc_id"], table_class="ecl-table")


def link_titles_nested(spark, sf):
    block = "<div class='block'><div class='icon'><div>x</div></div><p><a href='#'>%s{}</a></p></div>"
    pages = P.line_pages(spark, sf, "<div class='all'>", block % "Financial sanctions, ", block % "Notice ", "</div>")
    return extract.link_titles(pages, ["doc_id"], "block", "Financial sanctions")


def links_after_coded(spark, sf):
    """The anchor is written with references and with tags inside; one that only looks like it comes first."""
    head = "<h2>1. Les regimes</h2><p><a href='no'>no</a></p><h2>1. L<i>es</i> r&eacute;gimes en&nbsp;vigueur</h2><p>"
    pages = P.line_pages(spark, sf, head, "<a href='/{}'>x</a>", "{}", "</p>")
    return extract.links(pages, ["doc_id"], after=("h2", "les régimes")).select("doc_id", "pos")


def page_state(spark, sf):
    """State after three batches of pages: an older issue, a newer one, and the older one again, too late."""
    state = PageState(spark, scratch_path(spark, "state"), buckets=16)
    before = None
    for version, (window, at) in {"a": (B.T0, P.BEFORE), "b": (B.T1, P.AT), "c": (B.T0, P.BEFORE)}.items():
        state.merge(landed(P.pages(spark, sf, window, at)), version, before)
        before = version
    current = state.read(before)
    return current.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_pages"), F.countDistinct("url").alias("n_urls"), F.max("fetched_at").alias("latest")
    )


def as_of_publication(spark, sf):
    """The price that was last given as urgent to an order's customer, at or before the order."""
    orders = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey", "o_orderdate", F.col("o_totalprice").alias("price"))
    found = asof.as_of(orders.select("o_orderkey", "o_custkey", "o_orderdate"), urgent, ["o_custkey"], "o_orderdate", ["price"])
    return found.select("o_orderkey", "price")


def match_patterns(spark, sf):
    """A pattern for every supplier, with and without certain literal parts, against all customers."""
    key = F.col("s_suppkey")
    number = F.lpad(key.cast("string"), 4, "0")
    pattern = (
        F.when(key % 50 == 0, F.concat(F.lit("0[1-3]"), F.lpad((key / 50).cast("int").cast("string"), 2, "0"), F.lit("$")))
        .when(key % 3 == 0, F.concat(F.lit("^Customer#0*[1-9]?"), number, F.lit("$")))
        .when(key % 3 == 1, F.concat(F.lit("(?:Customer|Supplier)#\\d+"), number, F.lit("$")))
        .otherwise(F.concat(number, F.lit("[^a-z]?$")))
    )
    suppliers = B.table(spark, sf, "supplier").select("s_suppkey", pattern.alias("pattern"))
    return patterns.match_patterns(B.table(spark, sf, "customer"), suppliers, "c_custkey", "c_name", pattern_key="s_suppkey")


def source_cpi(spark, sf):
    inputs = replace(P.inputs(spark, sf), pages=P.score_pages(spark, sf))
    values = updaters.cpi_values(inputs)
    updated = update.update_values(inputs.register, values, "id", ["cpi_score"], error="error")
    return updated.select("id", "cpi_score")


def _source(extract_listing):
    return lambda spark, sf: extract_listing(P.inputs(spark, sf))


def run_from_publications(spark, sf):
    inputs = P.inputs(spark, sf)
    # Publications are read once, however often memberships are used further on.
    inputs = replace(inputs, pages=landed(inputs.pages))
    inputs = replace(inputs, issues=landed(updaters.latest_issues(inputs.pages, inputs.at)))
    rows = listing.union_listings(*[s.extract(inputs) for s in updaters.SOURCES])
    masks = landed(kind_masks(rows, updaters.SOURCES, BOUND))
    keys = match.name_keys(inputs.register, "id", updaters.register_keys(BOUND))
    hits = landed(match.resolve_hits(keys, masks, "id"))
    pending = propose(inputs.register, masks, hits, None, updaters.SOURCES, BOUND)
    return changes_of(pending, inputs.register.columns, BOUND)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        ladder_levels, ladder_rule_counts, fold_names, split_names, split_names_first, program_tokens, parse_values,
        alias_resolve, membership_semi, membership_anti, status_for_all, current_flags,
        policy_u1, policy_u2, policy_u3, policy_u4, policy_u5, policy_u6,
        or_merge, listing_pivot, update_cells, names_per_flag, flag_summary, unmatched_names,
        attribute_lines, attribute_doc_lines, tag_measures, take_until, take_until_turns,
        page_links, list_items, latest_publication, latest_snapshot, slug_semi, match_theta,
        diff_snapshots, diff_versions, versions_in_place, transitions, diff_sentinel, check_changes_null_as_no, check_changes_listed,
        dedupe_last_wins, union_listings, audit_ids, full_run,
        document_page_lines, first_column, first_column_after_header, definitions, bold_headings,
        paragraph_after, bold_items_until, bold_spans, list_items_after, link_titles, links_after,
        as_of_publication, match_patterns, page_state, first_column_nested, link_titles_nested, links_after_coded,
        source_cpi, run_from_publications,
    )
}
QUERIES |= {
    f"source_{name}": _source(getattr(updaters, name))
    for name in (
        "eu_aml", "eu_measures", "eu_tax", "fatf_call", "fatf_monitoring", "fr_measures", "fr_tax", "us_programmes", "uk"
    )
}
