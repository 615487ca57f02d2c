"""Text cleaning expressions, all built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as surrounding space, the characters that start a
# new word in title case, and the address and phone patterns.
WHITESPACE = " \t\n\x0b\f\r\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_DELIMITERS = "[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"
PHONE_NOISE = r"[^0-9+\-() \t\n\f\r]"

_AFTER_DELIMITER = r"(?<=[\s" + "".join("\\" + c for c in WORD_DELIMITERS) + "])"


def trim_all(text: Column) -> Column:
    """Drop surrounding white space of any kind, not only blanks."""
    return F.btrim(text, F.lit(WHITESPACE))


def title_case(text: Column) -> Column:
    """Capital after white space and punctuation: `jean-paul` -> `Jean-Paul`."""
    words = F.split(F.lower(text), _AFTER_DELIMITER)
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**31 - 1))),
        "",
    )


def is_blank(text: Column) -> Column:
    """True for null and for text that is empty once trimmed."""
    return F.coalesce(F.length(trim_all(text)) == 0, F.lit(True))


def is_email(text: Column) -> Column:
    return F.coalesce(text.rlike(EMAIL_PATTERN), F.lit(False))


def clean_phone(phone: Column) -> Column:
    """Only digits, `+ - ( )` and white space inside the number remain."""
    return F.regexp_replace(trim_all(phone), PHONE_NOISE, "")
