"""Scalar cleaning expressions (C1-C5, C7, C10-C13, V5, V7). All are native Column expressions: no Python per row."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.isspace() accepts, i.e. what str.strip() removes.
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java regex character-class body.
_WS_CLASS_BODY = (
    "\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
)

# The e-mail shape accepted as valid (whole string, after strip and lower case).
EMAIL_PATTERN = "^[^@" + _WS_CLASS_BODY + "]+@[^@" + _WS_CLASS_BODY + "]+\\.[^@" + _WS_CLASS_BODY + "]+$"

# Minimum number of digits for a phone number to be kept.
PHONE_MIN_DIGITS = 8

# Numbers accepted by the amount coercion: optional sign, digits with optional fraction, optional exponent.
NUMBER_PATTERN = "^[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = "^[+-]?[0-9]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Strip Unicode white space at both ends (Spark's plain ``trim`` only removes spaces)."""
    return F.trim(_col(c), F.lit(WHITESPACE_CHARS))


def normalize_text(c) -> Column:
    """Strip, lower case, blank -> null."""
    s = F.lower(strip_ws(c))
    return F.when(s != F.lit(""), s)


def normalize_phone(c, min_digits: int = PHONE_MIN_DIGITS) -> Column:
    """Keep Unicode decimal digits; fewer than ``min_digits`` -> null. Country codes are kept."""
    digits = F.regexp_replace(strip_ws(c), "(?U)\\D", "")
    return F.when(F.length(digits) >= F.lit(min_digits), digits)


def is_valid_email(c) -> Column:
    """C4: whole-string e-mail shape after strip + lower; null or blank is invalid (never null)."""
    return F.coalesce(F.lower(strip_ws(c)).rlike(EMAIL_PATTERN), F.lit(False))


def clean_email(c) -> Column:
    """C2 + C5: normalised e-mail, null when invalid."""
    n = normalize_text(c)
    return F.when(is_valid_email(n), n)


def coerce_number(c) -> Column:
    """Text -> double, unparsable -> null. The regex guard keeps out ``1.0d``, ``NaN``, ``Infinity``
    which ``try_cast`` would accept."""
    s = strip_ws(_col(c).cast("string"))
    return F.when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))


def coerce_long(c) -> Column:
    """Integer text -> bigint, else null."""
    s = strip_ws(_col(c).cast("string"))
    return F.when(s.rlike(INTEGER_PATTERN), s.try_cast("bigint"))


def pct(part, whole, digits: int = 2) -> Column:
    """``round(100 * part / whole, digits)``; whole = 0 -> null."""
    return F.round(F.try_divide(_col(part).cast("double") * F.lit(100.0), _col(whole).cast("double")), digits)


def quality_grade(score) -> Column:
    """>= 90 A, >= 75 B, >= 60 C, else D."""
    s = _col(score)
    return (F.when(s >= 90, "A").when(s >= 75, "B").when(s >= 60, "C").otherwise("D"))


def traffic_light(score) -> Column:
    """>= 80 green, >= 60 amber, else red."""
    s = _col(score)
    return F.when(s >= 80, "green").when(s >= 60, "amber").otherwise("red")


def repair_email(c) -> Column:
    """V5: ``nameATdomain.tld`` -> ``name@domain.tld`` when the text fails C4, holds exactly one upper-case
    ``AT`` and a dotted domain follows it. Returns the normalised, valid e-mail or null."""
    raw = strip_ws(c)
    at_count = F.size(F.split(raw, "AT")) - F.lit(1)
    candidate = F.lower(F.regexp_replace(raw, "AT", "@"))
    shaped = raw.rlike("^[^@]+AT[^@]+\\.[^@]+$")
    repaired = F.when(
        (~is_valid_email(raw)) & (at_count == 1) & shaped & is_valid_email(candidate), candidate
    )
    return F.coalesce(clean_email(raw), repaired)
