"""The ten sources: landed publications to listings.

Every extractor is lazy and returns ``(source, name, flag, status)`` rows (the score source
returns register values instead).  Page bodies are cut up map-side; only names leave the page.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe import reference_data as R
from vigilframe import schema as S
from vigilframe.functions import html as H
from vigilframe.functions import names as N
from vigilframe.operators import extract as X
from vigilframe.operators import lines as L
from vigilframe.operators.listing import apply_aliases, map_names, union_listings
from vigilframe.operators.match import attach_page, pattern_keys, reachable
from vigilframe.operators.update import POLICIES, Policy
from vigilframe.schema import REGISTER, RegisterLayout
from vigilframe.sources.tables import successful

UNDER_WAY = "UNDER WAY"


# Sources that publish many pages, or dated ones: the latest issue is per address, not per source.
BY_ADDRESS = (R.FR_MEASURES, R.FATF_CALL, R.FATF_MONITORING)


def _issue(source: Column) -> Column:
    return F.when(source.isin(*BY_ADDRESS), F.col("url")).otherwise(F.lit(""))


def latest_issues(pages: DataFrame, at: datetime) -> DataFrame:
    """W-03: (source, issue, fetched_at) of the last delivery up to a time, for all sources at once.

    Reads no page body.  One row per source, or per address of the sources above.
    """
    past = successful(pages).where(F.col("fetched_at") <= F.lit(at))
    keyed = past.select("source", _issue(F.col("source")).alias("issue"), "fetched_at")
    return keyed.groupBy("source", "issue").agg(F.max("fetched_at").alias("fetched_at"))


@dataclass(frozen=True)
class Inputs:
    """Everything a run reads.  ``documents``: (doc_id, page_no, text); ``programmes``: (programme).

    ``issues`` is the table of ``latest_issues``, worked out from ``pages`` when not given.
    """

    register: DataFrame
    at: datetime
    pages: DataFrame | None = None
    documents: DataFrame | None = None
    programmes: DataFrame | None = None
    layout: RegisterLayout = REGISTER
    separator: str = "\n"
    issues: DataFrame | None = None

    def delivered(self, source: str) -> DataFrame | None:
        """All delivered pages of a source, older issues included, with their ``issue``."""
        if self.pages is None:
            return None
        own = successful(self.pages.where(F.col("source") == source))
        return own.withColumn("issue", _issue(F.lit(source)))

    def current(self, df: DataFrame, source: str) -> DataFrame:
        """Rows of a source's latest issue.  ``df`` has ``issue`` and ``fetched_at``: pages, or
        rather what was extracted from them, so that bodies need not move."""
        issues = latest_issues(self.pages, self.at) if self.issues is None else self.issues
        own = issues.where(F.col("source") == source)
        if source not in BY_ADDRESS:
            return df.where(F.col("fetched_at") == own.agg(F.max("fetched_at")).scalar())
        return df.join(own.select("issue", "fetched_at"), ["issue", "fetched_at"], "left_semi")

    def latest(self, source: str) -> DataFrame | None:
        """The last delivered page of a source (or per address) up to the time of the run."""
        pages = self.delivered(source)
        return None if pages is None else self.current(pages, source)


@dataclass(frozen=True)
class Source:
    """E-01: one publication, how it becomes a listing, and how the listing is applied.

    ``extract`` returns (source, name, flag, status) or None without input.  ``key`` names the
    register key the names are compared with.  A row without flag only triggers the policy of
    ``trigger``.
    """

    name: str
    extract: Callable[[Inputs], DataFrame | None]
    key: str
    policies: dict[str, Policy] = field(default_factory=dict)
    trigger: str | None = None


def _listing(names: DataFrame, source: str, flag: str | None, status: str = "YES") -> DataFrame:
    """Distinct named rows of one source as a listing."""
    return names.select(
        F.lit(source).alias("source"), "name", F.lit(flag).cast("string").alias("flag"), F.lit(status).alias("status")
    ).where(F.col("name") != "").distinct()


def _aliased(names: DataFrame, source: str) -> DataFrame:
    """Names after the constant alias rows of a source."""
    aliases = F.broadcast(R.alias_table(names.sparkSession, source))
    marked = names.select(F.lit(source).alias("source"), "name")
    return apply_aliases(marked, aliases).select("name")


def cpi_values(inputs: Inputs) -> DataFrame | None:
    """P-01: (key, score, rank, error) of every named register row, from its score page.

    A missing page counts as "not found", which sets both values to NULL; any other failed fetch
    is an error and keeps the row.  If no score page has landed at all, there are no values.
    """
    if inputs.pages is None:
        return None
    layout = inputs.layout
    own = inputs.pages.where((F.col("source") == R.CPI) & (F.col("fetched_at") <= F.lit(inputs.at)))
    found = X.definitions(own, ["url", "status", "fetched_at"], {"s": "Score", "r": "Rank"})
    no_definition = (F.col("s.has_term") & F.col("s.value").isNull()) | (F.col("r.has_term") & F.col("r.value").isNull())
    parsed = found.select(
        "url", "status", "fetched_at", no_definition.alias("cut"),
        N.parse_score(F.col("s.value")).alias("s"), N.parse_rank(F.col("r.value")).alias("r"),
    )
    delivered, missing = F.col("status") == 200, F.col("status") == 404
    bad = F.when(missing, False).when(delivered, F.col("cut") | F.col("s.error") | F.col("r.error")).otherwise(True)
    # Values are parsed before the latest page is chosen: bodies never leave their task.
    page = F.struct(
        "fetched_at",
        bad.alias("error"),
        F.when(delivered, F.col("s.value")).alias("score"),
        F.when(delivered, F.col("r.value")).alias("rank"),
    )
    values = parsed.groupBy("url").agg(F.max(page).alias("page"))
    values = values.select("url", "page.score", "page.rank", "page.error")
    rows = inputs.register.select(layout.key, layout.name_eng).where(F.col(layout.name_eng).isNotNull())
    slug = N.slug_cpi(N.fold_name(F.col(layout.name_eng)))
    with_page = attach_page(rows, values, slug, R.CPI_URL)
    landed = with_page.where(own.exists())
    return landed.select(
        layout.key,
        F.col("score").alias(layout.score),
        *([F.col("rank").alias(layout.rank)] if layout.rank else []),
        F.coalesce("error", F.lit(False)).alias("error"),
    )


def eu_aml(inputs: Inputs) -> DataFrame | None:
    """P-02: first column of the high-risk table."""
    pages = inputs.latest(R.EU_AML)
    if pages is None:
        return None
    cells = X.first_column(pages, [], table_class=R.EU_AML_TABLE)
    names = cells.select(N.fold_name(F.col("name")).alias("name"))
    return _listing(_aliased(names, R.EU_AML), R.EU_AML, S.EU_AML)


def eu_measures(inputs: Inputs) -> DataFrame | None:
    """P-03: measures mentioned under each entity heading of the regime documents."""
    if inputs.documents is None:
        return None
    lines = L.page_lines(inputs.documents, separator=inputs.separator)
    entities = inputs.register.select(
        N.fold_name(F.col(inputs.layout.name_eng), R.RAW_ALIASES).alias("name")
    ).where(F.col("name") != "")
    found = L.entity_measures(lines, entities, R.EU_MEASURE_PATTERNS, "doc_id", R.RAW_ALIASES)
    return found.select(F.lit(R.EU_MEASURES).alias("source"), "name", "flag", "status")


def eu_tax(inputs: Inputs) -> DataFrame | None:
    """P-04: listed names, and names under way (without a flag) whose presence alone counts."""
    pages = inputs.latest(R.EU_TAX)
    if pages is None:
        return None

    def names_of(items: DataFrame, and_as_comma: bool) -> DataFrame:
        names = N.split_names(F.upper("text"), pre_split=True, and_as_comma=and_as_comma)
        split = items.select(F.explode(names).alias("name"))
        return _aliased(split, R.EU_TAX)

    listed = X.bold_items(
        pages, [], R.EU_TAX_LISTED, R.EU_TAX_BOLD, anchor_id=R.EU_TAX_ANCHOR, stop=R.EU_TAX_STOP
    )
    under_way = X.bold_items(pages, [], R.EU_TAX_UNDER_WAY, R.EU_TAX_BOLD)
    return union_listings(
        _listing(names_of(listed, False), R.EU_TAX, S.EU_TAX),
        _listing(names_of(under_way, True), R.EU_TAX, None, UNDER_WAY),
    )


def _fatf_pages(inputs: Inputs, source: str, page: str) -> DataFrame | None:
    """The publication that is current at the time of the run, if it has landed."""
    pages = inputs.latest(source)
    if pages is None:
        return None
    key = N.latest_publication(F.lit(inputs.at)).getField("key")
    return pages.where(F.col("url") == F.concat(F.lit(R.FATF_URL + page), key, F.lit(".html")))


def fatf_call(inputs: Inputs) -> DataFrame | None:
    """P-05: bold level-3 headings of the call-for-action publication."""
    pages = _fatf_pages(inputs, R.FATF_CALL, R.FATF_CALL_PAGE)
    if pages is None:
        return None
    names = X.bold_headings(pages, []).select(N.fold_name(F.col("name")).alias("name"))
    return _listing(_aliased(names, R.FATF_CALL), R.FATF_CALL, S.FATF_CALL)


def fatf_monitoring(inputs: Inputs) -> DataFrame | None:
    """P-06: names in the paragraph after the country heading."""
    pages = _fatf_pages(inputs, R.FATF_MONITORING, R.FATF_MONITORING_PAGE)
    if pages is None:
        return None
    text = X.paragraph_after(pages, [], "h6", R.FATF_HEADING, cls=R.FATF_HEADING_CLASS)
    names = text.select(F.explode(N.split_names(F.col("text"), sep=", ", drop_parentheses=False)).alias("name"))
    return _listing(_aliased(names, R.FATF_MONITORING), R.FATF_MONITORING, S.FATF_MONITORING)


def fr_measures(inputs: Inputs) -> DataFrame | None:
    """P-07: measures on the page of every entity whose page the index links to.

    Names are register names as stored.  Of several that fold to one, the last (greatest key)
    stands for all.  A page without a section of the right class says nothing about its entity.
    """
    if inputs.pages is None:
        return None
    layout = inputs.layout
    pages = inputs.delivered(R.FR_MEASURES)
    index = inputs.current(pages.where(F.col("url") == R.FR_INDEX_URL), R.FR_MEASURES)
    links = X.links(index, [], after=("h2", R.FR_INDEX_HEADING)).select(F.col("href").alias("link"))

    named = inputs.register.where(F.col(layout.name_fr).isNotNull())
    folded = named.groupBy(N.fold_name(F.col(layout.name_fr)).alias("folded")).agg(
        F.max_by(layout.name_fr, layout.key).alias("name")
    )
    slug = N.slug_fr(F.col("folded"), R.FR_SLUGS)
    asked = reachable(folded, links, slug, R.FR_URL)

    # Pages are cut up first; their latest issues are chosen among the (address, mask) rows.
    issue = ["issue", "fetched_at"]
    entity_pages = pages.where(F.col("url") != R.FR_INDEX_URL).select(*issue, "body")
    has_section = F.size(H.elements(H.drop_noise(F.col("body")), "section", cls=R.FR_SECTION)) > 0
    parsed = entity_pages.where(has_section)
    items = X.list_items_after(parsed, issue, R.FR_SECTION, R.FR_MEASURES_HEADING)
    texts = items.select(*issue, N.to_ascii(F.col("text")).alias("text"))
    # A page without items still counts as parsed: all its flags are NO.
    texts = texts.unionByName(parsed.select(*issue, F.lit("").alias("text")))
    tagged = L.tag_measures(texts, issue, "text", R.FR_MEASURE_PATTERNS)
    tagged = inputs.current(tagged, R.FR_MEASURES).select(F.col("issue").alias("url"), "flag", "status")
    addressed = asked.select("name", F.concat(F.lit(R.FR_URL), slug).alias("url"))
    found = addressed.join(tagged, "url")
    return found.select(F.lit(R.FR_MEASURES).alias("source"), "name", "flag", "status")


def fr_tax(inputs: Inputs) -> DataFrame | None:
    """P-08: first column of the table that names its source list."""
    pages = inputs.latest(R.FR_TAX)
    if pages is None:
        return None
    cells = X.first_column(pages, [], after_header=R.FR_TAX_HEADER)
    return _listing(cells.select(N.fold_name(F.col("name")).alias("name")), R.FR_TAX, S.FR_TAX)


def us_programmes(inputs: Inputs) -> DataFrame | None:
    """P-09: tokens of the programme column.  Tokens are single words, so names of several words
    never match.  Programme texts repeat heavily: they are made distinct before they are cut."""
    if inputs.programmes is None:
        return None
    texts = inputs.programmes.select("programme").distinct()
    tokens = texts.select(F.explode(N.program_tokens(F.col("programme"))).alias("name"))
    return _listing(_aliased(tokens, R.US), R.US, S.US_PROGRAMMES)


_UK_NAMES = {old: new for source, old, new in R.ALIASES if source == R.UK}


def uk_name(name: Column) -> Column:
    """A published or stored name in the form the UK list compares: folded, then mapped."""
    return map_names(name, _UK_NAMES)


def uk(inputs: Inputs) -> DataFrame | None:
    """P-10: names in the titles of the regime pages."""
    pages = inputs.latest(R.UK)
    if pages is None:
        return None
    titles = X.link_titles(pages, [], R.UK_TITLE, R.UK_TITLE_TEXT)
    names = N.split_names(N.after_last(F.col("text"), R.UK_PREFIX))
    mapped = titles.select(F.explode(names).alias("name")).select(uk_name(F.col("name")).alias("name"))
    return _listing(mapped, R.UK, S.UK)


def register_keys(layout: RegisterLayout, *, fold: bool = False) -> list[tuple[str, Column]]:
    """Per kind of key, the forms of a register row's name that listed names are compared with.

    ``eng`` and ``fr``: the stored name with ASCII apostrophes (or fully folded, on request);
    ``eng_folded``: always folded, as the names of regime documents are; ``fr_raw``: as stored;
    ``uk``: folded and mapped, or the special listed name it matches.
    """
    eng, fr = F.col(layout.name_eng), F.col(layout.name_fr)
    norm = N.fold_name if fold else N.quote_norm
    keys = [("eng", norm(eng)), ("eng_folded", N.fold_name(eng, R.RAW_ALIASES)), ("fr", norm(fr)), ("fr_raw", fr)]
    return [*keys, *[("uk", c) for c in pattern_keys(uk_name(N.fold_name(eng)), R.UK_PATTERNS)]]


def _policies(*flags: str) -> dict[str, Policy]:
    return {f: POLICIES[f] for f in flags}


SOURCES: tuple[Source, ...] = (
    Source(R.EU_AML, eu_aml, "eng", _policies(S.EU_AML)),
    Source(R.EU_MEASURES, eu_measures, "eng_folded", _policies(*S.EU_MEASURE_FLAGS)),
    Source(R.EU_TAX, eu_tax, "eng", _policies(S.EU_TAX), trigger=S.EU_TAX),
    Source(R.FATF_CALL, fatf_call, "eng", _policies(S.FATF_CALL)),
    Source(R.FATF_MONITORING, fatf_monitoring, "eng", _policies(S.FATF_MONITORING)),
    Source(R.FR_MEASURES, fr_measures, "fr_raw", _policies(*S.FR_MEASURE_FLAGS)),
    Source(R.FR_TAX, fr_tax, "fr", _policies(S.FR_TAX)),
    Source(R.US, us_programmes, "eng", _policies(S.US_PROGRAMMES)),
    Source(R.UK, uk, "uk", _policies(S.UK)),
)


def register_source(
    name: str,
    extract: Callable[[DataFrame], DataFrame],
    flag: str,
    policy: Policy,
    *,
    key: str = "eng",
    sources: tuple[Source, ...] = SOURCES,
) -> tuple[Source, ...]:
    """E-01: the sources with one more.

    ``extract`` turns the latest delivered pages of the source into a table with a ``name``
    column.  ``flag`` may be a column added to the layout's flags.
    """

    def run(inputs: Inputs) -> DataFrame | None:
        pages = inputs.latest(name)
        return None if pages is None else _listing(extract(pages), name, flag)

    return (*sources, Source(name, run, key, {flag: policy}))
