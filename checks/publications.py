"""Publications made from the driver's tables: web pages, documents and programme texts.

Every document becomes a page that shows its lines in some structure; every order of a window
becomes a publication that lists its customer under flag ``o_orderkey % 18`` in the form of the
source that owns the flag.  Nothing is gathered: one row makes one page.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import bindings as B
from vigilframe import reference_data as R
from vigilframe.plans.updaters import Inputs
from vigilframe.schema import BOUND

AT = datetime(1998, 4, 1)
BEFORE = datetime(1998, 3, 1)


def escaped(text: Column) -> Column:
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(ref))
    return text


def line_pages(spark: SparkSession, sf_dir: str, head: str, long_line: str, short_line: str, tail: str) -> DataFrame:
    """(doc_id, body): every line of a document between markup, lines under 60 characters in another."""
    docs = B.table(spark, sf_dir, "documents")

    def shown(line: Column) -> Column:
        def between(markup: str) -> Column:
            left, right = markup.split("{}")
            return F.concat(F.lit(left), escaped(line), F.lit(right))

        return F.when(F.length(line) < 60, between(short_line)).otherwise(between(long_line))

    rows = F.array_join(F.transform(F.split("text", "\n", -1), shown), "")
    return docs.select("doc_id", F.concat(F.lit(head), rows, F.lit(tail)).alias("body"))


def text_pages(spark: SparkSession, sf_dir: str, head: str, tail: str) -> DataFrame:
    docs = B.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.concat(F.lit(head), escaped(F.col("text")), F.lit(tail)).alias("body"))


def document_pages(spark: SparkSession, sf_dir: str, width: int = 700) -> DataFrame:
    """(doc_id, page_no, text): whole documents cut into pages anywhere, also inside lines."""
    docs = B.table(spark, sf_dir, "documents").select("doc_id", "text")
    pages = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / width).cast("int"))
    cut = docs.where(F.length("text") > 0).select("doc_id", "text", F.explode(pages).alias("i"))
    return cut.select(
        "doc_id",
        (F.col("i") + 1).cast("long").alias("page_no"),
        F.substr("text", F.col("i") * width + 1, F.lit(width)).alias("text"),
    )


def _name(upper: bool = True) -> Column:
    return F.concat(F.lit("CUSTOMER#" if upper else "Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))


# Per flag number of a page source: source, address, and markup around the name.
_LISTS = {
    11: (R.EU_AML, "aml", "<table class='x ecl-table'><tr><th>Country</th></tr><tr><td>&nbsp;<b>{}</b>\n</td><td>1</td></tr>"
         "</table><table class='ecl-table'><tr><td>Other</td></tr></table>"),
    13: (R.FATF_CALL, R.FATF_URL + R.FATF_CALL_PAGE + "february-1998.html", "<h3>No bold</h3><h3 id=a>1. <b>{}</b></h3>"),
    14: (R.FATF_MONITORING, R.FATF_URL + R.FATF_MONITORING_PAGE + "february-1998.html",
         "<h6 class='cmp-title__text'>Country</h6><div><p>Nowhere, {}</p><p>Elsewhere</p></div>"),
    15: (R.EU_TAX, "tax", "<p class='oj-ti-grseq-1'><span class='oj-bold'>Early</span></p><p id='d1e39-2-1'>I</p>"
         "<p class='oj-ti-grseq-1'><span class='oj-bold'>{} (a note), Atlantis</span></p><p class='oj-ti-grseq-1'>"
         "<span class='oj-bold'>State of play</span></p><p class='oj-ti-grseq-1'><span class='oj-bold'>Late</span></p>"
         "<p class='oj-normal'><span class='oj-bold'>Avalon and Lyonesse</span></p>"),
    16: (R.FR_TAX, "taxe", "<table><thead><tr><th><b>Liste source (2)</b></th></tr></thead><tbody><tr><td>{}</td></tr></tbody></table>"),
    17: (R.UK, "uk", "<div class='gem-c-document-list__item-title'><a href='/x'>Financial sanctions, {} (regime)</a></div>"
         "<div class='gem-c-document-list__item-title'><a href='/y'>Other notice</a></div>"),
}

_FR_TEXTS = (
    "Gel des avoirs", "Embargo sectoriel", "Embargo militaire", "Équipements de répression interne",
    "Répression interne", "Restrictions sectorielles", "Restrictions financi&egrave;res", "Interdiction de voyager",
)
_EU_TEXTS = ("Asset freeze and prohibition to make funds available", "Investments", "Financial measures")


def pages(spark: SparkSession, sf_dir: str, window: tuple[str, str], at: datetime = AT) -> DataFrame:
    """Landed pages of all web sources for a window of orders, delivered at one time."""
    orders = B.window_orders(spark, sf_dir, window).withColumn("flag_no", F.col("o_orderkey") % B.N_FLAGS)
    number = F.col("flag_no")
    name = _name(upper=False)

    def markup(text: str) -> Column:
        left, right = text.split("{}")
        return F.concat(F.lit(left), name, F.lit(right))

    source, url, body = (F.lit(None).cast("string") for _ in range(3))
    for flag_no, (own, address, text) in _LISTS.items():
        source = F.when(number == flag_no, F.lit(own)).otherwise(source)
        url = F.when(number == flag_no, F.lit(address)).otherwise(url)
        body = F.when(number == flag_no, markup(text)).otherwise(body)

    fr_url = F.concat(F.lit(R.FR_URL), F.lower(name))
    measure = F.element_at(F.array(*[F.lit(t) for t in _FR_TEXTS]), (number + 1).cast("int"))
    fr_body = F.concat(
        F.lit("<section class='page-section'><h2>Contexte</h2><ul><li>gel des avoirs de tous</li></ul>"
              "<h3>Les Mesures restrictives</h3><p>:</p><ul><li>"),
        F.when(number < 8, measure), F.lit("</li></ul></section>"),
    )
    index = F.concat(
        F.lit(f"<h2>{R.FR_INDEX_HEADING} ?</h2><div><p><a class='l' href='"), fr_url, F.lit("'>x</a></p></div>")
    )
    is_fr = number < 8
    kinds = F.array_compact(
        F.array(
            F.when(source.isNotNull(), F.struct(source.alias("source"), url.alias("url"), body.alias("body"))),
            F.when(is_fr, F.struct(F.lit(R.FR_MEASURES).alias("source"), fr_url.alias("url"), fr_body.alias("body"))),
            F.when(is_fr, F.struct(F.lit(R.FR_MEASURES).alias("source"), F.lit(R.FR_INDEX_URL).alias("url"), index.alias("body"))),
        )
    )
    return orders.select(F.inline(kinds)).select(
        "source", "url", F.lit(200).alias("status"), F.lit(at).alias("fetched_at"), "body"
    )


def documents(spark: SparkSession, sf_dir: str, window: tuple[str, str]) -> DataFrame:
    """Regime documents: an entity line, other lines, and the measure of the order's flag."""
    orders = B.window_orders(spark, sf_dir, window)
    number = F.col("o_orderkey") % B.N_FLAGS
    phrase = F.element_at(F.array(*[F.lit(t) for t in _EU_TEXTS]), (number - 7).cast("int"))
    text = F.concat(F.lit("Investments before any entity\n  "), _name(False), F.lit("\nsome words\n"), phrase, F.lit(" apply"))
    return orders.where(number.between(8, 10)).select(
        F.col("o_orderkey").alias("doc_id"), F.lit(1).cast("long").alias("page_no"), text.alias("text")
    )


def programmes(spark: SparkSession, sf_dir: str, window: tuple[str, str]) -> DataFrame:
    orders = B.window_orders(spark, sf_dir, window).where(F.col("o_orderkey") % B.N_FLAGS == 12)
    return orders.select(F.concat(_name(), F.lit("; SDGT  NPWMD")).alias("programme"))


def score_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score page per customer: negative balances are 404, one nation's pages fail, one segment's
    are missing, and every 13th has a score without a definition."""
    customer = B.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "MACHINERY")
    status = (
        F.when(F.col("c_acctbal") < 0, 404).when(F.col("c_nationkey") == 7, 500).otherwise(200)
    )
    score = F.concat(F.lit("<dd> "), F.col("c_acctbal").cast("decimal(12,2)").cast("string"), F.lit("<b>/</b>100 </dd>"))
    body = F.concat(
        F.lit("<dl><dt>Rank</dt><dd>12/180</dd><dt>Score</dt>"),
        F.when(F.col("c_custkey") % 13 != 0, score).otherwise(""), F.lit("</dl>"),
    )
    return customer.select(
        F.lit(R.CPI).alias("source"),
        F.concat(F.lit(R.CPI_URL), F.lower("c_name")).alias("url"),
        status.alias("status"),
        F.lit(AT).alias("fetched_at"),
        F.when(status == 200, body).alias("body"),
    )


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Register T0 with everything published in window T1, after an older issue of window T0."""
    landed = pages(spark, sf_dir, B.T1).unionByName(pages(spark, sf_dir, B.T0, BEFORE))
    return Inputs(
        register=B.register(spark, sf_dir, B.T0),
        at=AT,
        pages=landed,
        documents=documents(spark, sf_dir, B.T1),
        programmes=programmes(spark, sf_dir, B.T1),
        layout=BOUND,
    )
