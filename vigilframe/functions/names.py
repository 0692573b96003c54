"""Name normalisation as Column expressions: folding, splitting, tokens, slugs, numbers, dates.

Everything here stays inside the JVM; no Python runs per row.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that str.strip() removes; Spark's trim() alone only knows U+0020.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
WHITESPACE = r"[\s\x0B\x1C-\x1F\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
PARENTHESISED = WHITESPACE + r"*\([^)]*\)"
NON_ASCII = r"[^\x00-\x7F]"

# Letters and marks whose ASCII form does not follow from Unicode decomposition.
_ONE_TO_ONE = {
    "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ł": "L", "ł": "l",
    "Ħ": "H", "ħ": "h", "Ŧ": "T", "ŧ": "t", "ı": "i", "ĸ": "k", "ſ": "s",
    "’": "'", "‘": "'", "‛": "'", "ʼ": "'", "´": "'", "′": "'",
    "“": '"', "”": '"', "‟": '"', "″": '"', "‚": ",", "‹": "<", "›": ">",
    "‐": "-", "‑": "-", "‒": "-", "–": "-",
    "\u00a0": " ", "\u2002": " ", "\u2003": " ", "\u2009": " ", "\u202f": " ", "\u3000": " ",
}
_ONE_TO_MANY = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "ẞ": "SS", "Þ": "Th", "þ": "th",
    "Ĳ": "IJ", "ĳ": "ij", "Ŋ": "NG", "ŋ": "ng", "—": "--", "…": "...", "„": ",,",
    "«": "<<", "»": ">>",
}


def _decomposed() -> dict[str, str]:
    """Latin letters whose ASCII base letter follows from their canonical decomposition."""
    pairs = {}
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFD", char) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            pairs[char] = base
    return pairs


_LETTERS = {**_decomposed(), **_ONE_TO_ONE}
# Characters of the translate() source beyond the target's length are dropped: combining marks.
_MARKS = "".join(chr(c) for c in range(0x0300, 0x0370))
_FROM = "".join(_LETTERS) + _MARKS
_TO = "".join(_LETTERS.values())


def strip(col: Column) -> Column:
    """Remove all leading and trailing white space, tabs, newlines and no-break spaces included."""
    return F.btrim(col, F.lit(BLANKS))


def to_ascii(col: Column) -> Column:
    """Write Latin letters, quotes and dashes in ASCII.

    Pure ASCII text (nearly all of it) takes the short way out.  Characters outside Latin-1,
    Latin Extended-A/B, Latin Extended Additional and common punctuation are left as they are;
    ``has_unfolded`` finds them.
    """
    text = col
    for char, ascii_text in _ONE_TO_MANY.items():
        text = F.replace(text, F.lit(char), F.lit(ascii_text))
    # Few texts hold a character that becomes several; only those take the replacements.
    text = F.when(col.rlike(f"[{''.join(_ONE_TO_MANY)}]"), text).otherwise(col)
    return F.when(col.rlike(NON_ASCII), F.translate(text, _FROM, _TO)).otherwise(col)


def fold_name(col: Column, raw_aliases: Mapping[str, str] | None = None) -> Column:
    """N-01: strip, uppercase, transliterate.  N-02: exact raw texts replaced before that."""
    folded = to_ascii(F.upper(F.replace(strip(col), F.lit("ß"), F.lit("ss"))))
    for raw, name in reversed((raw_aliases or {}).items()):
        folded = F.when(col == raw, F.lit(name)).otherwise(folded)
    return folded


def has_unfolded(col: Column) -> Column:
    """True when a folded text still holds non-ASCII characters (a row for a rejects report)."""
    return col.rlike(NON_ASCII)


def quote_norm(col: Column) -> Column:
    """N-03: typographic apostrophe to ASCII on the register side of a comparison."""
    return F.replace(col, F.lit("’"), F.lit("'"))


def split_names(
    col: Column,
    *,
    sep: str = ",",
    drop_parentheses: bool = True,
    pre_split: bool = False,
    and_as_comma: bool = False,
) -> Column:
    """N-04 to N-07: one text with several names to an array of folded names.

    ``pre_split`` cuts at the separator before parentheses are removed, so a comma inside
    parentheses breaks the name in two.  ``and_as_comma`` also cuts at `` AND ``.
    """
    text = strip(col)
    if and_as_comma:
        text = F.replace(F.upper(text), F.lit(" AND "), F.lit(", "))

    def bare(c: Column) -> Column:
        return strip(F.regexp_replace(c, PARENTHESISED, "")) if drop_parentheses else c

    pieces = F.split(text if pre_split else bare(text), re.escape(sep), -1)
    return F.transform(pieces, lambda p: fold_name(bare(p) if pre_split else p))


def program_tokens(col: Column) -> Column:
    """N-08: tokens between semicolons or white space, folded, blanks dropped."""
    pieces = F.split(F.upper(strip(col)), r"[;\s]\s*", -1)
    tokens = F.transform(pieces, lambda p: fold_name(F.replace(p, F.lit(" "), F.lit(""))))
    return F.filter(tokens, lambda t: t != "")


def after_last(col: Column, marker: str) -> Column:
    """N-09: the stripped text after the last marker; the whole text when there is none."""
    return strip(F.substring_index(col, marker, -1))


def slug_cpi(col: Column) -> Column:
    """N-10: score page slug; parentheses removed, lower case, spaces to hyphens, ASCII."""
    bare = strip(F.regexp_replace(col, r"\(.*?\)", ""))
    return to_ascii(F.replace(F.lower(bare), F.lit(" "), F.lit("-")))


def slug_fr(col: Column, overrides: Mapping[str, str] | None = None) -> Column:
    """N-11: slug of a folded French name; some names have a slug of their own."""
    slug = F.lower(to_ascii(F.replace(col, F.lit(" "), F.lit("-"))))
    for name, own in (overrides or {}).items():
        slug = F.when(col == name, F.lit(own)).otherwise(slug)
    return slug


# What Python's float() takes: digits (with single underscores between them), sign, exponent.
_DIGITS = r"\d(?:_?\d)*"
_FLOAT = rf"(?i)^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?$"
_INTEGER = rf"^[+-]?{_DIGITS}$"
_NOT_FINITE = r"(?i)^[+-]?(?:nan|inf|infinity)$"


def _fraction_head(col: Column) -> Column:
    return F.regexp_replace(strip(F.split_part(col, F.lit("/"), F.lit(1))), "_", "")


def parse_score(col: Column) -> Column:
    """N-12: ``'43.7/100'`` to a struct (value int, error boolean).

    Text that is no number, or no text, is a NULL value without error; NaN, infinity and numbers
    that do not fit are errors (the register row then keeps what it has).
    """
    head = _fraction_head(col)
    value = F.when(head.rlike(_FLOAT), head.try_cast("double"))
    whole = value.try_cast("int")
    error = F.coalesce(head.rlike(_NOT_FINITE) | (value.isNotNull() & whole.isNull()), F.lit(False))
    return F.struct(whole.alias("value"), error.alias("error"))


def parse_rank(col: Column) -> Column:
    """N-12: as ``parse_score``, but a number that is not whole is an error too."""
    head = _fraction_head(col)
    value = F.when(head.rlike(_INTEGER), head.try_cast("int"))
    number = head.rlike(_FLOAT) | head.rlike(_NOT_FINITE)
    error = F.coalesce(number & value.isNull(), F.lit(False))
    return F.struct(value.alias("value"), error.alias("error"))


def latest_publication(date: Column) -> Column:
    """N-13: the last of February, June and October publications at a date.

    A struct of month name, year and the ``<month>-<year>`` key that page addresses end with.
    """
    month = F.month(date)
    name = (
        F.when(month >= 10, F.lit("october"))
        .when(month >= 6, F.lit("june"))
        .when(month >= 2, F.lit("february"))
        .when(month >= 1, F.lit("october"))
    )
    year = F.year(date) - F.when(month < 2, F.lit(1)).otherwise(F.lit(0))
    return F.struct(
        name.alias("month"), year.alias("year"), F.concat_ws("-", name, year.cast("string")).alias("key")
    )


def flag_or_no(col: Column) -> Column:
    """N-14: a flag that was never evaluated reads as NO."""
    return F.coalesce(col, F.lit("NO"))


def flags_differ(left: Column, right: Column, *, ignore_case: bool = False) -> Column:
    """N-15: null-safe inequality of two statuses, optionally ignoring case."""
    if ignore_case:
        left, right = F.lower(left), F.lower(right)
    return ~left.eqNullSafe(right)


def text_matches(col: Column, pattern: str) -> Column:
    """F-08: regular expression search, case ignored."""
    return col.rlike(f"(?i){pattern}")
