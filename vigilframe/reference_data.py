"""Alias rows, measure patterns, page addresses and page anchors of the ten sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigilframe import schema as S

# Source names used in every listing, page and alias row.
CPI = "CPI"
EU_AML = "EU_AML"
EU_MEASURES = "EU_MEASURES"
EU_TAX = "EU_TAX"
FATF_CALL = "FATF_CALL"
FATF_MONITORING = "FATF_MONITORING"
FR_MEASURES = "FR_MEASURES"
FR_TAX = "FR_TAX"
US = "US"
UK = "UK"

LONG_KOREA = "DEMOCRATIC PEOPLE'S REPUBLIC OF KOREA (DPRK - NORTH KOREA)"
UK_KOREA = "DEMOCRATIC PEOPLE’S REPUBLIC OF KOREA (DPRK - NORTH KOREA)"

# Fixed values: (source, name as published, name in the register).  Two rows with one
# published name give two names.
ALIASES = (
    (EU_AML, "MYANMAR", "MYANMAR (BURMA)"),
    (EU_AML, "NORTH KOREA", LONG_KOREA),
    (EU_TAX, "RUSSIAN FEDERATION", "RUSSIA"),
    (FATF_CALL, "MYANMAR", "MYANMAR (BURMA)"),
    (FATF_CALL, "DEMOCRATIC PEOPLE'S REPUBLIC OF KOREA (DPRK)", LONG_KOREA),
    (FATF_CALL, "CROATIA, DEMOCRATIC REPUBLIC OF THE CONGO", "CROATIA"),
    (FATF_CALL, "CROATIA, DEMOCRATIC REPUBLIC OF THE CONGO", "REPUBLIC DEMOCRATIC OF THE CONGO"),
    (FATF_MONITORING, "MYANMAR (BURMA)", "MYANMAR"),
    (FATF_MONITORING, LONG_KOREA, "NORTH KOREA"),
    (FATF_MONITORING, "COTE D'IVOIRE", "IVORY COAST"),
    (US, "DPRK", LONG_KOREA),
    (US, "BURMA", "MYANMAR (BURMA)"),
    (UK, "MYANMAR (BURMA)", "MYANMAR"),
    (UK, "TURKIYE", "TÜRKIYE"),
    (UK, "ESWATINI", "SWAZILAND"),
    (UK, "DEMOCRATIC PEOPLE'S REPUBLIC OF KOREA", UK_KOREA),
    (UK, "REPUBLIC OF GUINEA-BISSAU", "GUINEA-BISSAU"),
    (UK, "IRAN", "IRAN RELATING TO NUCLEAR WEAPONS"),
)

# Replaced on the raw text, before folding.
RAW_ALIASES = {"BOSNIA & HERZEGOVINA": "BOSNIA AND HERZEGOVINA"}

# Listed name -> pattern that register names are searched for.
UK_PATTERNS = {UK_KOREA: r"(?i)DEMOCRATIC PEOPLE['’]S REPUBLIC OF KOREA"}

# Fixed values: (pattern, flag).  A pattern that sets two flags has two rows.
EU_MEASURE_PATTERNS = (
    (r"(?i)Asset freeze and prohibition to make funds available", S.EU_MEASURE_FLAGS[0]),
    (r"(?i)Investments", S.EU_MEASURE_FLAGS[1]),
    (r"(?i)Financial measures", S.EU_MEASURE_FLAGS[2]),
)
FR_MEASURE_PATTERNS = (
    (r"(?i)gels? des avoirs|gels d'avoirs", S.FR_MEASURE_FLAGS[0]),
    (r"(?i)embargos? sectoriels?", S.FR_MEASURE_FLAGS[1]),
    (r"(?i)embargos? militaires?", S.FR_MEASURE_FLAGS[2]),
    (r"(?i)embargos sectoriels? et militaires?", S.FR_MEASURE_FLAGS[1]),
    (r"(?i)embargos sectoriels? et militaires?", S.FR_MEASURE_FLAGS[2]),
    (r"(?i)equipements (de )?repression interne", S.FR_MEASURE_FLAGS[3]),
    (r"(?i)(?<!\s)repression interne", S.FR_MEASURE_FLAGS[4]),
    (r"(?i)restrictions sectorielles", S.FR_MEASURE_FLAGS[5]),
    (r"(?i)restrictions financi[eè]res", S.FR_MEASURE_FLAGS[6]),
    (r"(?i)interdictions? de voyager", S.FR_MEASURE_FLAGS[7]),
)

# Addresses that a page is looked up by.
CPI_URL = "https://www.transparency.org/en/countries/"
FR_URL = "https://www.tresor.economie.gouv.fr/services-aux-entreprises/sanctions-economiques/"
FATF_URL = "https://www.fatf-gafi.org/en/publications/High-risk-and-other-monitored-jurisdictions/"
FATF_CALL_PAGE = "Call-for-action-"
FATF_MONITORING_PAGE = "increased-monitoring-"
FR_INDEX_URL = "https://www.tresor.economie.gouv.fr/services-aux-entreprises/sanctions-economiques"
FR_SLUGS = {
    "RUSSIE": "russie-en-lien-avec-la-violation-par-la-russie-de-la-souverainete-"
    "et-de-l-integrite-territoriale-de-l-ukraine"
}

# Class names, ids and heading texts on the published pages.
EU_AML_TABLE = "ecl-table"
EU_TAX_ANCHOR = "d1e39-2-1"
EU_TAX_LISTED = "oj-ti-grseq-1"
EU_TAX_UNDER_WAY = "oj-normal"
EU_TAX_BOLD = "oj-bold"
EU_TAX_STOP = "State of play"
FATF_HEADING_CLASS = "cmp-title__text"
FATF_HEADING = "Country"
FR_INDEX_HEADING = "1. Vous voulez connaître les régimes de sanctions en vigueur"
FR_SECTION = "page-section"
FR_MEASURES_HEADING = "Mesures restrictives"
FR_TAX_HEADER = "Liste source"
UK_TITLE = "gem-c-document-list__item-title"
UK_TITLE_TEXT = "Financial sanctions"
UK_PREFIX = "Financial sanctions,"
US_PROGRAMME_COLUMN = 11
EU_REGIMES = (1, 70)


def alias_table(spark: SparkSession, source: str | None = None) -> DataFrame:
    """The alias rows above as ``alias(source, from_name, to_name)``: a few dozen constants."""
    rows = [r for r in ALIASES if source is None or r[0] == source]
    return spark.createDataFrame(rows, "source string, from_name string, to_name string")
