"""Sources: registers, landed pages, documents and programme files, plus schema enforcement."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilframe.reference_data import US_PROGRAMME_COLUMN
from vigilframe.functions.names import strip
from vigilframe.schema import COLUMN_ALIASES, PAGE_SCHEMA, REGISTER_SCHEMA


def read_register(spark: SparkSession, path: str, *, format: str = "parquet", schema: T.StructType = REGISTER_SCHEMA) -> DataFrame:
    """S-01: a register snapshot with the columns and types of ``schema``.

    Older column spellings are accepted; columns the file lacks are NULL; derived level columns
    are never read.  The projection reaches the scan.
    """
    reader = spark.read.option("header", True) if format == "csv" else spark.read
    raw = reader.format(format).load(path)
    present = {COLUMN_ALIASES.get(c, c): c for c in raw.columns}
    return raw.select(
        *[
            (F.col(present[f.name]) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _acceptable(flag: str, width: int) -> Column:
    col = F.col(flag)
    return col.isNull() | (col.isin("YES", "NO") & (F.length(col) <= width))


def enforce_flag_schema(register: DataFrame, flags: Sequence[str], *, width: int = 3) -> tuple[DataFrame, DataFrame]:
    """S-12: rows whose flags are YES, NO or NULL, and the rejected rest."""
    good = reduce(and_, [_acceptable(f, width) for f in flags])
    return register.where(good), register.where(~good)


def read_pages(spark: SparkSession, path: str, source: str | None = None, *, format: str = "parquet") -> DataFrame:
    """S-04: landed pages (source, url, status, fetched_at, body), one source or all."""
    pages = spark.read.schema(PAGE_SCHEMA).format(format).load(path)
    return pages if source is None else pages.where(F.col("source") == source)


def successful(pages: DataFrame) -> DataFrame:
    """Pages that were delivered."""
    return pages.where(F.col("status") == 200)


def read_documents(spark: SparkSession, path: str, *, format: str = "parquet") -> DataFrame:
    """S-06: pages of text documents (doc_id, page_no, text) in one scan of all documents."""
    return spark.read.schema("doc_id long, page_no long, text string").format(format).load(path)


def regimes(docs: DataFrame, first: int, last: int, doc: str = "doc_id") -> DataFrame:
    """S-06: documents in a range of ids; ids without a document are simply absent."""
    return docs.where(F.col(doc).between(first, last))


def read_program_csv(
    spark: SparkSession, path: str, *, column: int = US_PROGRAMME_COLUMN, multi_line: bool = False
) -> DataFrame:
    """S-07: (programme) texts of one column of headered CSV files, upper case, blanks dropped.

    The schema is explicit and one column wider than needed, so that short rows read as NULL
    (and are dropped) whatever the first row looks like.  Quotes inside quoted fields are doubled.
    ``multi_line`` reads fields with line breaks, at the price of one task per file.
    """
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(column + 2)])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    text = F.upper(strip(F.col(f"c{column}")))
    return rows.select(text.alias("programme")).where((F.col("programme") != ""))
