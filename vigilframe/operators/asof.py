"""As-of values for any number of dates at once: what was published last before each row's time.

Rows and publications become one sequence per key, ordered by time, in which the last publication
is carried forward.  The scan works in blocks of time (``carry.py``), so a key that holds a third
of all rows is spread over tasks, and rows are never paired with all publications of their key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.operators.carry import BLOCK_ROWS, carry_forward


def as_of(rows: DataFrame, published: DataFrame, keys: Sequence[str], at: str, values: Sequence[str], *, block: int = BLOCK_ROWS) -> DataFrame:
    """W-03, N-13: ``rows`` with the ``values`` of the key's last publication at or before ``at``.

    Both tables have ``keys`` and the timestamp ``at``.  Of publications at one time the greatest
    values count (in the order given).  Rows before the first publication, and rows with a null
    key or time, have nulls; publications with a null key or time are left out.  Repeated rows
    stay.  Three levels of blocks (65 ms, 71 minutes, 9 years) bound every window.
    """
    known = reduce(and_, [F.col(c).isNotNull() for c in (*keys, at)])
    # A publication comes before the rows of its own time.
    place = F.unix_micros(at) * 2
    latest = published.where(known).groupBy(*keys, place.alias("__pos")).agg(F.max(F.struct(*values)).alias("__value"))
    whole = F.struct(*rows.columns)
    asked = rows.select(*keys, (place + 1).alias("__pos"), F.lit(None).cast(latest.schema["__value"].dataType).alias("__value"), whole.alias("__row"))
    sequence = latest.withColumn("__row", F.lit(None).cast(asked.schema["__row"].dataType)).unionByName(asked)
    carried = carry_forward(sequence, keys, "__pos", "__value", "__last", rows=block, depth=2)
    found = carried.where("__row IS NOT NULL").withColumn("__known", reduce(and_, [F.col(f"__row.{c}").isNotNull() for c in (*keys, at)]))
    return found.select("__row.*", *[F.when(F.col("__known"), F.col(f"__last.{v}")).alias(v) for v in values])
