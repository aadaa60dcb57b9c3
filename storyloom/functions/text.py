"""Text cleaning and label expressions. Everything but NFKC stays in JVM expressions."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, functions as F, types as T

from storyloom import lexicons
from storyloom.functions.let import let

# The characters that count as white space in the original analysis and
# that Java's fast ASCII ``\\s`` does not know. They become plain spaces first, because
# a regular expression with this class is ten times slower.
OTHER_SPACES = (
    "\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# A letter, digit or underscore, as Python's ``\w``; written out because Java's
# ``\b`` next to letters depends on the JDK.
WORD_BEFORE = r"(?<![\p{L}\p{N}_])"
WORD_AFTER = r"(?![\p{L}\p{N}_])"

MASK = "[MASK]"
# The look-ahead comes first because it fails fastest.
MASK_PATTERN = "(?=[Xx]{2})" + WORD_BEFORE + "[Xx]{2,}" + WORD_AFTER
URL_PATTERN = r"https?://\S+|www\.\S+"
# The look-behind anchors the match at the start of a chunk: same matches, linear time.
EMAIL_PATTERN = r"(?<!\S)\S+@\S+"
# Below U+0100 only these characters change under NFKC, and nothing there combines.
NFKC_UNSTABLE = r"[\xa0\xa8\xaa\xaf\xb2\xb3\xb4\xb5\xb8\xb9\xba\xbc\xbd\xbe\x{100}-\x{10ffff}]"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


@cache
def _nfkc_udf():
    # Built inside a function so that it travels by value and executors need no package.
    def normalise(texts):
        import unicodedata

        return texts.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))

    import pandas as pd

    normalise.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(normalise, T.StringType())


def nfkc(c: Column) -> Column:
    """Unicode NFKC. Only texts it can change are sent to Python; the rest go as null."""
    return F.coalesce(_nfkc_udf()(F.when(c.rlike(NFKC_UNSTABLE), c)), c)


def plain_spaces(c: Column) -> Column:
    return F.translate(c, OTHER_SPACES, " " * len(OTHER_SPACES))


@cache
def control_class() -> str:
    """A pattern for the characters of category C but tab and newline, spelled out as ranges.

    The ranges are those of this Python's Unicode version (``unicodedata.unidata_version``), made here on the driver, so that
    the result does not depend on what the JDK of an executor knows as assigned. Each class asks for the wider range
    first, so that a letter is settled by few comparisons.
    """
    import sys
    import unicodedata

    ranges: list[list[int]] = []
    for i in range(sys.maxunicode + 1):
        if unicodedata.category(chr(i))[0] == "C" and i not in (9, 10):
            if ranges and ranges[-1][1] == i - 1:
                ranges[-1][1] = i
            else:
                ranges.append([i, i])
    spelled = lambda rs: "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in rs)
    low = [r for r in ranges if r[1] < 0x300]
    high = ranges[len(low) :]
    groups = [high[i : i + 24] for i in range(0, len(high), 24)]
    within = "".join(f"[{spelled([[g[0][0], g[-1][1]]])}&&[{spelled(g)}]]" for g in groups)
    return f"[{spelled(low)}]|[\\x{{300}}-\\x{{10ffff}}&&[{within}]]"


def strip_control(c: Column) -> Column:
    """Drop control, format, private, surrogate and unassigned characters but tab and newline."""
    return F.regexp_replace(c, control_class(), "")


def normalize_unicode(c: Column) -> Column:
    return strip_control(nfkc(text_or_empty(c)))


def _replaced_where(c: Column, signs: tuple, pattern: str, by: str) -> Column:
    """``regexp_replace``, but only in texts that hold one of ``signs``, without which the pattern has no match."""

    def of(t: Column) -> Column:
        some = F.contains(t, F.lit(signs[0]))
        for sign in signs[1:]:
            some = some | F.contains(t, F.lit(sign))
        return F.when(some, F.regexp_replace(t, pattern, by)).otherwise(t)

    return let(c, of)


def mask_redactions(c: Column) -> Column:
    return _replaced_where(c, ("xx", "xX", "Xx", "XX"), MASK_PATTERN, MASK)


def strip_urls(c: Column) -> Column:
    return _replaced_where(c, ("http", "www."), URL_PATTERN, "")


def strip_emails(c: Column) -> Column:
    return _replaced_where(c, ("@",), EMAIL_PATTERN, "")


def letters_only(c: Column) -> Column:
    """Everything but a-z and brackets becomes one space; spaces are collapsed and trimmed."""
    # one space before a letter stays as it is, so most words meet no replacement
    return F.trim(F.regexp_replace(c, r"(?! [a-z\[\]])[^a-z\[\]]+", " "))


def collapse_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_text(c: Column, normalise: bool = True) -> Column:
    """Full cleaning: NFKC, mask, URLs, e-mails, lower case, letters only."""
    t = text_or_empty(c)
    if normalise:
        t = nfkc(t)
    return letters_only(F.lower(strip_emails(strip_urls(mask_redactions(plain_spaces(t))))))


def clean_narrative_basic(c: Column) -> Column:
    """Light cleaning that keeps case and punctuation."""
    return collapse_space(strip_emails(strip_urls(mask_redactions(plain_spaces(text_or_empty(c))))))


def remove_word(c: Column, word: str) -> Column:
    return F.regexp_replace(c, WORD_BEFORE + r"\Q" + word + r"\E" + WORD_AFTER, "")


def long_enough(c: Column, minimum: int = 20) -> Column:
    """Rows to keep; a null text counts as too short."""
    return F.coalesce(F.length(c), F.lit(0)) >= minimum


def text_length(c: Column) -> Column:
    return F.length(c)


# Formats tried in turn when a date string is read.
DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")


def parse_date(c: Column, formats=DATE_FORMATS) -> Column:
    """Timestamp of the first format that fits, else null.

    What no format fits is read as a cast would: fractions, offsets, and the text of date and timestamp columns.
    """
    text = c.cast("string")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats], F.try_to_timestamp(text))


def short_product(c: Column, width: int = 35) -> Column:
    return F.substring(F.regexp_replace(c, "Credit reporting.*", "Credit reporting"), 1, width)


def ellipsis(c: Column, longer_than: int, keep: int) -> Column:
    return F.when(
        F.length(c) > longer_than, F.concat(F.substring(c, 1, keep), F.lit("…"))
    ).otherwise(c)


def clip(c: Column, low=None, high=None) -> Column:
    """Clip to a range; null stays null."""
    out = c
    if low is not None:
        out = F.when(out < F.lit(low), F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(out > F.lit(high), F.lit(high)).otherwise(out)
    return out


def response_category(c: Column, table: dict | None = None) -> Column:
    """Short category of a company response; null when it is not listed."""
    from storyloom.functions.lookup import hash_lookup

    return hash_lookup(lexicons.RESPONSE_CATEGORIES if table is None else table, "string")(c)
