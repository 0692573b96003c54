"""Mixing sources to target weights: capped water-filling and seeded repetitions, in DataFrame functions only.

Sources share a number of words by weight.  A source whose share is above ``epochs`` times its own
size is clamped there, and what it can't take is reshared among the others by weight, until none
is above.  A document is then taken as many whole times as its source's rate says; of the rest of
the rate, documents in a seeded order are taken once more until the target is full, the last of
them in part (its first words), so that each source's words meet its target exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilframe.operators.lineage import landed

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_sizes(sized: DataFrame, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, weight): weights repeat over sources by code point, null last.

    A row per source, which is what its windows see; words are summed before they meet.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    return totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")))


def water_filled(sources: DataFrame, share: float = 1.0, epochs: float = 3.0) -> DataFrame:
    """Adds ``target``: a share of all words by weight, none above ``epochs`` times the source's size.

    Each round is one aggregate of one row; a source once clamped stays so, and every round but
    the last clamps one at least.  Sources without words get 0.  If the share can't be placed
    (it is above ``epochs`` times everything), all sources are clamped.
    """
    sources = landed(sources)
    cap = F.col("source_size") * F.lit(float(epochs))
    total = sources.agg((F.sum("source_size") * F.lit(float(share))).alias("t")).first().t or 0.0
    level = 0.0
    while True:
        open_ = cap > F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(open_, F.col("weight"))).alias("w"),
            F.sum(F.when(~open_, cap)).alias("used"),
        ).first()
        if not row.w:
            break
        raised = (total - (row.used or 0.0)) / row.w
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)).cast("double"))


def seeded_order(seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def takings(sized: DataFrame, sources: DataFrame, seed: str = "mix-1", digits: int = 3) -> DataFrame:
    """Per source: source_size, target, whole, and where the rest of its target ends in the seeded order.

    Documents before ``edge`` are taken once more, those at it with ``edge_rest`` of their
    ``edge_size`` words.  The order isn't sorted as a whole: its first ``digits`` hex digits make
    bins, bins are summed, and only the bin in which a source's rest ends (one in 16**digits) is
    run through.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = sources.withColumn("whole", F.floor(rate + F.lit(1e-12)).cast("long"))
    rest = F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    plan = plan.withColumn("rest", F.greatest(F.lit(0).cast("long"), rest))
    plan = landed(plan.select("source", "source_size", "target", "whole", "rest"))
    keyed = sized.where("size > 0").select("source", "size", seeded_order(seed).alias("place"))
    keyed = keyed.withColumn("bin", F.substring("place", 1, digits))

    def edges(summed: DataFrame, by: str) -> DataFrame:
        """The step of ``by`` at which the sum of words passes the rest, for sources where one does."""
        before = F.sum("n").over(Window.partitionBy("source").orderBy(by)) - F.col("n")
        return summed.withColumn("before", before).where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("n") > F.col("rest")))

    named = plan.select(F.col("source").alias("s"), "rest")
    bins = keyed.groupBy("source", "bin").agg(F.sum("size").alias("n"))
    first = edges(bins.join(named, bins["source"].eqNullSafe(named["s"])).drop("s"), "bin")
    first = landed(first.select(F.col("source").alias("s"), F.col("bin").alias("b"), (F.col("rest") - F.col("before")).alias("rest")))
    inside = keyed.join(first, keyed["source"].eqNullSafe(first["s"]) & (F.col("bin") == F.col("b")))
    at = edges(inside.groupBy("source", "place", "rest").agg(F.sum("size").alias("n")), "place")
    at = at.select(F.col("source").alias("s"), F.col("place").alias("edge"), (F.col("rest") - F.col("before")).alias("edge_rest"), F.col("n").alias("edge_size"))
    joined = plan.join(at, plan["source"].eqNullSafe(at["s"]), "left")
    # A rest that no document passes takes all of them.
    edge = F.coalesce("edge", F.when(F.col("rest") > 0, F.lit("~")).otherwise(F.lit("")))
    return landed(joined.select(plan["source"].alias("of"), "source_size", "target", "whole", edge.alias("edge"), "edge_rest", "edge_size"))


def with_takings(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """Adds source_size, target, whole and part (words of a further taking) to rows with doc_id, source and size."""
    joined = rows.join(plan, rows["source"].eqNullSafe(plan["of"])).drop("of")
    place = seeded_order(seed)
    share = F.floor(F.col("edge_rest") * F.col("size") / F.col("edge_size")).cast("long")
    part = F.when(place < F.col("edge"), F.col("size")).when(place == F.col("edge"), share).otherwise(F.lit(0).cast("long"))
    return joined.withColumn("part", part).drop("edge", "edge_rest", "edge_size")


def mix_plan(docs: DataFrame, *, weights=WEIGHTS, share: float = 1.0, epochs: float = 3.0, seed: str = "mix-1") -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size) of every row, and the plan per source: all stored."""
    sized = landed(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    sources = water_filled(source_sizes(sized, weights), share, epochs)
    return sized, takings(sized, sources, seed)


def mix(docs: DataFrame, *, seed: str = "mix-1", **how) -> DataFrame:
    """doc_id, source, size, source_size, target, whole and part for every row of ``docs``.

    Null or empty texts have size 0 and take no words.  Rows with a null source are a source of
    their own, last in order.  Rows with the same doc_id share a place in the order, and at the
    edge share the rest by size.  An empty table gives no rows; other columns are ignored.
    """
    sized, plan = mix_plan(docs, seed=seed, **how)
    return with_takings(sized, plan, seed)


def mixed_documents(docs: DataFrame, *, seed: str = "mix-1", **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; a partial taking has the first words only.

    Texts meet a table of one row per source, so they aren't shuffled while that is small.
    Documents without words are taken as often as their source's whole rate says.
    """
    _, plan = mix_plan(docs, seed=seed, **how)
    inner = docs.select(
        F.struct(*docs.columns).alias("row"), "doc_id", "source", "text", word_count(F.col("text")).alias("size")
    )
    rows = with_takings(inner, plan, seed)
    all_words = F.lit(-1).cast("long")
    further = F.when(F.col("part") >= F.col("size"), F.array(all_words)).otherwise(F.array("part"))
    nothing = F.array().cast("array<long>")
    takes = F.concat(F.array_repeat(all_words, F.col("whole").cast("int")), F.when(F.col("part") > 0, further).otherwise(nothing))
    taken = rows.select("row", "text", F.explode(takes).alias("words"))
    leading = F.col("text").rlike(r"^[\x20\x09-\x0D]").cast("int")
    limit = (F.col("words") + 1 + leading).cast("int")
    rest = F.element_at(F.split("text", r"[\x20\x09-\x0D]+", limit), -1)
    first = F.expr("substring(text, 1, length(text) - length(rest))")
    text = F.when(F.col("words") < 0, F.col("text")).otherwise(first)
    cut = taken.withColumn("rest", F.when(F.col("words") >= 0, rest)).withColumn("cut", text)
    return cut.select(*[F.col("cut").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
