"""Tables of patterns against tables of texts, without trying every pattern on every text.

Every pattern is indexed by a few characters that any match must contain, taken from its literal
parts; the ends of the text are characters too, so that what stands at an anchor is found there
only.  Of all such pieces of a pattern the one that the fewest texts contain is taken.  Texts are
joined with patterns on the pieces they contain, and only such candidates are matched.  Patterns
without a literal part are candidates for every text; they are dealt to several groups of texts,
so that no task meets them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A part of so many characters or more is indexed by pieces of the last length, a shorter one as a whole.
PIECES = (2, 3, 4)
_SALTS = 16
_GAP, _START, _END = "\u0000", "\u0002", "\u0003"


def literal_runs(pattern: Column) -> Column:
    """All runs of plain characters that every match of a regular expression contains; none if that is uncertain.

    A run at the start or end of an anchored pattern has a mark of the text's start or end.
    Alternatives outside groups, flags inside the pattern, quoting, groups within groups and
    classes within classes count as uncertain.
    """
    plain = pattern
    for part in (
        r"\\[^a-zA-Z0-9]",  # an escaped sign could be kept, but also be quantified
        r"\\[a-zA-Z0-9](?:\{[^}]*\})?",
    ):
        plain = F.regexp_replace(plain, part, _GAP)
    unsure = pattern.rlike(r"\\[QEpPxuckN0]") | plain.rlike(r"\(\?[a-zA-Z-]|\[[^\]]*\[")
    plain = F.regexp_replace(plain, r"\[\^?\]?[^\]]*\]", _GAP)
    unsure |= plain.rlike(r"\([^()]*\(")
    plain = F.regexp_replace(plain, r"\([^()]*\)", _GAP)
    unsure |= plain.rlike(r"[|]")
    plain = F.regexp_replace(plain, r"^\^(?![?*{])", _START)
    plain = F.regexp_replace(plain, r"\$\z", _END)
    # A character that may be left out or is repeated, with its quantifier; the quantifier of a gap.
    plain = F.regexp_replace(plain, r"\x00\{[^}]*\}|[^\x00](?:[?*][?+]?|\{[^}]*\}[?+]?)", _GAP)
    plain = F.regexp_replace(plain, r"[\x00.^$+?*{}()\[\]]+", _GAP)
    runs = F.filter(F.split(plain, _GAP, -1), lambda p: p != "")
    return F.when(unsure, F.array().cast("array<string>")).otherwise(runs)


def literal_part(pattern: Column) -> Column:
    """The longest run of plain characters that every match of a regular expression contains; '' if none is certain."""
    runs = F.transform(literal_runs(pattern), lambda p: F.translate(p, _START + _END, ""))
    longest = F.array_max(F.transform(runs, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    return F.coalesce(longest, F.lit(""))


def _marked(text: Column) -> Column:
    """The text between marks of its start and end; ``$`` is also found before a last line break."""
    whole = F.concat(F.lit(_START), text, F.lit(_END))
    line = F.regexp_replace(text, r"(?:\r\n|[\n\r\u0085\u2028\u2029])\z", "")
    return F.when(line == text, whole).otherwise(F.concat(whole, F.lit(_START), line, F.lit(_END)))


def _grams(text: Column, n: int) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))


def _pieces(text: Column) -> Column:
    return F.array_distinct(F.concat(*[_grams(text, n) for n in PIECES]))


def _run_pieces(run: Column) -> Column:
    """The longest pieces of a run; none if it is too short."""
    made = F.array().cast("array<string>")
    for n in PIECES:
        made = F.when(F.length(run) >= n, _grams(run, n)).otherwise(made)
    return made


def indexed_patterns(asked: DataFrame, own: DataFrame) -> DataFrame:
    """(__pattern, __piece, __run, __n): of each distinct pattern's pieces one that the fewest texts have, and how many do."""
    runs = asked.select("__pattern", F.explode(literal_runs(F.col("__pattern"))).alias("__run"))
    possible = runs.select("__pattern", "__run", F.explode(F.array_distinct(_run_pieces(F.col("__run")))).alias("__piece"))
    # A pattern with a piece that is in no text matches nothing.
    held = own.select(F.explode(_pieces(F.col("__marked"))).alias("__piece"))
    held = held.join(possible.select("__piece").distinct(), "__piece", "left_semi").groupBy("__piece").agg(F.count(F.lit(1)).alias("__n"))
    counted = possible.join(held, "__piece", "left").withColumn("__n", F.coalesce("__n", F.lit(0)))
    # Of pieces that are as rare the one with the least hash: patterns that begin alike don't share it.
    rarest = F.min(F.struct("__n", F.xxhash64("__piece").alias("__h"), "__piece", "__run")).alias("__least")
    return counted.groupBy("__pattern").agg(rarest).select("__pattern", "__least.__piece", "__least.__run", "__least.__n")


def match_patterns(texts: DataFrame, patterns: DataFrame, key: str, text: str, *, pattern_key: str = "pattern_id", pattern: str = "pattern") -> DataFrame:
    """J-04, X-12: the distinct (key, pattern_key) of texts in which a pattern is found.

    Any number of patterns; each is a regular expression of Java's kind, and one that isn't valid
    raises an error.  Null texts and null patterns match nothing.
    """
    asked = patterns.where(F.col(pattern).isNotNull()).select(F.col(pattern_key), F.col(pattern).alias("__pattern"))
    # A few files of short texts are much work: they are dealt out, not left to as many tasks.
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = texts.where(F.col(text).isNotNull()).select(F.col(key), F.col(text).alias("__text")).repartition(tasks, key, "__text")
    own = own.withColumn("__marked", _marked(F.col("__text")))
    indexed = indexed_patterns(asked.select("__pattern").distinct(), own)
    certain = asked.join(indexed.drop("__n"), "__pattern")
    # What a text contains is met once, however many patterns ask for it.
    wanted = indexed.select("__piece").distinct()
    pieces = own.select(key, "__text", "__marked", F.explode(_pieces(F.col("__marked"))).alias("__piece")).join(wanted, "__piece", "left_semi")
    candidates = pieces.join(certain, "__piece").where(F.contains("__marked", "__run")).select(key, "__text", pattern_key, "__pattern")
    salt = F.pmod(F.xxhash64("__text"), F.lit(_SALTS)).cast("int").alias("__salt")
    short = asked.join(indexed.select("__pattern"), "__pattern", "left_anti")
    loose = short.select(pattern_key, "__pattern", F.explode(F.array(*map(F.lit, range(_SALTS)))).alias("__salt"))
    others = own.select(key, "__text", salt).join(loose, "__salt").select(key, "__text", pattern_key, "__pattern")
    found = candidates.unionByName(others).where(F.regexp_like("__text", F.col("__pattern")))
    return found.select(key, pattern_key).distinct()
