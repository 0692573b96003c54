"""Table shapes: the register, its 18 three-state flags, listings, pages and the audit log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Flag column names in table order (f0 ... f17).
FR_MEASURE_FLAGS = (
    "FR_ASSET_FREEZE",
    "FR_SECTORAL_EMBARGO",
    "FR_MILITARY_EMBARGO",
    "FR_INTERNAL_REPRESSION_EQUIPMENT",
    "FR_INTERNAL_REPRESSION",
    "FR_SECTORAL_RESTRICTIONS",
    "FR_FINANCIAL_RESTRICTIONS",
    "FR_TRAVEL_BANS",
)
EU_MEASURE_FLAGS = (
    "EU_ASSET_FREEZE_AND_PROHIBITION_TO_MAKE_FUNDS_AVAILABLE",
    "EU_INVESTMENTS",
    "EU_FINANCIAL_MEASURES",
)
EU_AML = "EU_AML_HIGH_RISK_COUNTRIES"
US_PROGRAMMES = "US_OFAC_SANCTIONS"
FATF_CALL = "FATF_HIGH_RISK_JURISDICTIONS_SUBJECT_TO_A_CALL_FOR_ACTION"
FATF_MONITORING = "FATF_JURISDICTIONS_UNDER_INCREASED_MONITORING"
EU_TAX = "EU_LIST_OF_NON_COOPERATIVE_JURISDICTIONS"
FR_TAX = "FR_LIST_OF_NON_COOPERATIVE_JURISDICTIONS"
UK = "UK_FINANCIAL_SANCTIONS"

FLAGS = (
    *FR_MEASURE_FLAGS,
    *EU_MEASURE_FLAGS,
    EU_AML,
    US_PROGRAMMES,
    FATF_CALL,
    FATF_MONITORING,
    EU_TAX,
    FR_TAX,
    UK,
)
FLAG_NO = {flag: i for i, flag in enumerate(FLAGS)}

LEVELS = ("LEVEL_OF_RISK", "LEVEL_OF_VIGILANCE", "LIST")

# Another spelling of a flag that older tables carry; renamed on read.
COLUMN_ALIASES = {"FR_ASSET_FREEEZE": "FR_ASSET_FREEZE"}


@dataclass(frozen=True)
class RegisterLayout:
    """Which columns of a register table play which part.

    Operators take a layout rather than fixed column names, so that any wide table of
    YES/NO/NULL flags can be updated, levelled and audited.  ``flags`` are in flag order.
    """

    key: str
    name_eng: str
    name_fr: str
    score: str
    rank: str | None
    flags: tuple[str, ...]

    def number(self, flag: str) -> int:
        """Position (and mask bit) of a canonical flag name, or of a flag column added to the 18."""
        return FLAG_NO[flag] if flag in FLAG_NO else self.flags.index(flag)

    def flag(self, canonical: str) -> str:
        """This layout's column for one of the 18 canonical flag names."""
        return self.flags[FLAG_NO[canonical]]

    def columns(self, canonical: tuple[str, ...]) -> list[str]:
        return [self.flag(f) for f in canonical]


REGISTER = RegisterLayout(
    key="SanctionsMapId",
    name_eng="COUNTRY_NAME_ENG",
    name_fr="COUNTRY_NAME_FR",
    score="CPI_SCORE",
    rank="CPI_RANK",
    flags=FLAGS,
)

# Short names for registers that are derived from other tables.
BOUND = RegisterLayout(
    key="id",
    name_eng="name_eng",
    name_fr="name_eng",
    score="cpi_score",
    rank=None,
    flags=tuple(f"f{i}" for i in range(len(FLAGS))),
)

REGISTER_SCHEMA = T.StructType(
    [
        T.StructField(REGISTER.key, T.LongType(), False),
        T.StructField(REGISTER.name_eng, T.StringType()),
        T.StructField(REGISTER.name_fr, T.StringType()),
        T.StructField("COUNTRY_CODE_ISO_2", T.StringType()),
        T.StructField("COUNTRY_CODE_ISO_3", T.StringType()),
        T.StructField("CPI_SCORE", T.IntegerType()),
        T.StructField("CPI_RANK", T.IntegerType()),
        *[T.StructField(flag, T.StringType()) for flag in FLAGS],
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("AuditID", T.LongType()),
        T.StructField("SanctionsMapId", T.LongType()),
        T.StructField("ColumnName", T.StringType()),
        T.StructField("OldValue", T.StringType()),
        T.StructField("NewValue", T.StringType()),
        T.StructField("UpdatedAt", T.TimestampType()),
    ]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("body", T.StringType()),
    ]
)

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("flag", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)
