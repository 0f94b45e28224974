"""Text cleaning, combination and length measures."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text patterns.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"[\s\x1c-\x1f]"
TAG = r"<[^>]+>"
URL = r"(?U)https?://\S+|www\.\S+"
WORD = r"[\p{L}\p{N}_]++(?:['-]++[\p{L}\p{N}_]++)*+"

# Characters that compatibility composition leaves alone, whatever stands
# next to them: ASCII and the stable part of Latin-1; Latin letters up to
# U+0131, basic Cyrillic, unified ideographs.
NFKC_LATIN = r"\x00-\x7f\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb\xbf-\xff"
NFKC_OTHER = r"\u0100-\u0131\u0400-\u045f\u4e00-\u9fff"
NFKC_STABLE = rf"\A[{NFKC_LATIN}]*+(?:[{NFKC_OTHER}]++[{NFKC_LATIN}]*+)*+\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(_col(c), F.lit(SPACE_CHARS))


def clean_text(c: Column | str) -> Column:
    """Missing text becomes ``""``; the rest is cast to string and stripped."""
    return strip(F.coalesce(_col(c).cast("string"), F.lit("")))


@F.pandas_udf(T.StringType())
def _compose(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def nfkc(c: Column | str) -> Column:
    """Unicode NFKC form.

    Spark has no built-in for it.  Only text with a character that may change
    is handed to Python; all other rows send a null there and stay in the JVM.
    """
    c = _col(c)
    return F.coalesce(_compose(F.when(~c.rlike(NFKC_STABLE), c)), c)


def normalize_text(c: Column | str, *, unicode_form: bool = True) -> Column:
    """NFKC, tags and addresses to a blank, white space collapsed, stripped."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    if unicode_form:
        text = nfkc(text)
    text = F.regexp_replace(text, TAG, " ")
    text = F.regexp_replace(text, URL, " ")
    return F.trim(F.regexp_replace(text, rf"(?U){SPACE}+", " "))


def _quoted(literal: str) -> str:
    return r"\Q" + literal.replace(r"\E", r"\E\\E\Q") + r"\E"


def clean_headline(c: Column | str, publisher: str, *, unicode_form: bool = True) -> Column:
    """Normalized headline without a closing ``- <publisher>``."""
    suffix = rf"(?iu)\s*-\s*{_quoted(publisher)}\s*\z"
    return F.trim(F.regexp_replace(normalize_text(c, unicode_form=unicode_form), suffix, ""))


def clean_body(c: Column | str, publisher: str, *, unicode_form: bool = True) -> Column:
    """Normalized body without an opening ``PLACE (<publisher>) -``."""
    dateline = rf"^[A-Z][A-Za-z .'-]+\s*\({_quoted(publisher)}\)\s*[-—:]?\s*"
    return F.trim(F.regexp_replace(normalize_text(c, unicode_form=unicode_form), dateline, ""))


def join_parts(separator: str, *parts: Column) -> Column:
    """Join the non-empty parts."""
    return F.concat_ws(separator, *[F.nullif(p, F.lit("")) for p in parts])


def baseline_text(*cols: Column | str) -> Column:
    """Stripped fields, blank line between them."""
    return join_parts("\n\n", *[clean_text(c) for c in cols])


def enhanced_text(
    headline: Column | str,
    description: Column | str,
    body: Column | str,
    publisher: str,
    *,
    unicode_form: bool = True,
) -> Column:
    """Cleaned fields joined by a full stop and a blank."""
    return join_parts(
        ". ",
        clean_headline(headline, publisher, unicode_form=unicode_form),
        normalize_text(description, unicode_form=unicode_form),
        clean_body(body, publisher, unicode_form=unicode_form),
    )


def topic_text(headline: Column | str, description: Column | str) -> Column:
    """Stripped headline and description for topic models."""
    return join_parts(". ", clean_text(headline), clean_text(description))


def count_words(c: Column | str) -> Column:
    """Number of word-like tokens; letters of every script count."""
    return F.regexp_count(F.coalesce(_col(c), F.lit("")), F.lit(WORD))


def n_chars(c: Column | str) -> Column:
    return F.length(F.coalesce(_col(c), F.lit("")))


def n_tokens(c: Column | str) -> Column:
    """Number of pieces between white space; 0 for blank text."""
    return F.regexp_count(F.coalesce(_col(c), F.lit("")), F.lit(r"(?U)[^\s\x1c-\x1f]+"))


def add_text_lengths(
    df: DataFrame,
    headline: str,
    description: str,
    body: str,
    publisher: str,
    *,
    unicode_form: bool = True,
) -> DataFrame:
    """Word and character counts of three fields and of the two combined texts."""
    fields = {"headline": headline, "description": description, "body": body}
    counts = {}
    for name, column in fields.items():
        counts[f"{name}_words"] = count_words(column)
        counts[f"{name}_characters"] = n_chars(column)
    counts["baseline_text_characters"] = F.length(baseline_text(headline, description, body))
    counts["enhanced_text_characters"] = F.length(
        enhanced_text(headline, description, body, publisher, unicode_form=unicode_form)
    )
    return df.withColumns(counts)


def truncate_text(c: Column | str, limit: int | None) -> Column:
    """First ``limit`` characters, right-stripped when something was cut."""
    c = _col(c)
    if limit is None:
        return c
    if limit <= 0:
        raise ValueError("limit must be positive")
    cut = F.rtrim(F.substring(c, 1, limit), F.lit(SPACE_CHARS))
    return F.when(F.length(c) > limit, cut).otherwise(c)


def fill_template(template: str, **values: Column) -> Column:
    """Put column values in place of ``{NAME}``; every name must occur."""
    missing = [name for name in values if "{" + name + "}" not in template]
    if missing:
        raise ValueError(f"template lacks placeholders: {', '.join(sorted(missing))}")
    filled = F.lit(template)
    for name, value in values.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), value)
    return filled


def parse_ts(c: Column | str, fmt: str | None = None) -> Column:
    """Timestamp, or null where the text is no date."""
    c = _col(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def year_of(c: Column | str) -> Column:
    return F.year(_col(c))
