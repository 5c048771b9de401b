"""Cleaning, validation and normalisation of text as Column expressions (no Python in the data path)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinweave.config import VN_MOBILE_PREFIXES

# Validation patterns.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^\+?\p{Nd}+$"
SCRIPT_PATTERN = r"(?is)<script.*?>.*?</script>"
# Characters escaped for HTML, the ampersand first.
HTML_ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))

# The characters counted as white space.
SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
          "\u200a\u2028\u2029\u202f\u205f\u3000")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    return F.btrim(col(c), F.lit(SPACES))


def has_string_value(c) -> Column:
    """True for text with at least one non-space character; NULL is false."""
    return F.coalesce(F.length(strip(c)) > 0, F.lit(False))


def is_valid_email(c) -> Column:
    return F.coalesce(col(c).rlike(EMAIL_PATTERN), F.lit(False))


def is_valid_basic_phone(c) -> Column:
    """Digits, or a plus sign and digits, once surrounding space is gone."""
    return F.coalesce(strip(c).rlike(PHONE_PATTERN), F.lit(False))


def sanitize_text(c) -> Column:
    """Trim, delete script elements, escape the five HTML characters."""
    bare = strip(c)
    out = F.when(bare.contains("<"), F.regexp_replace(bare, SCRIPT_PATTERN, "")).otherwise(bare)
    for plain, escaped in HTML_ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    return out


def normalize_text(c) -> Column:
    return F.lower(strip(F.regexp_replace(col(c), r"(?U)\s+", " ")))


def normalize_phone_e164(c, country_code: str = "84") -> Column:
    """E.164 form of a phone: national numbers (leading 0) get the country code; anything unusable becomes NULL."""
    digits = F.regexp_replace(col(c), r"[^0-9+]", "")
    full = (
        F.when(digits.startswith("+"), digits)
        .when(digits.startswith("00"), F.concat(F.lit("+"), F.substring(digits, 3, 40)))
        .when(digits.startswith("0"), F.concat(F.lit("+" + country_code), F.substring(digits, 2, 40)))
        .when(digits.startswith(country_code), F.concat(F.lit("+"), digits))
    )
    return F.when(full.rlike(r"^\+[1-9][0-9]{7,14}$"), full)


def is_vn_mobile(c) -> Column:
    """True when the number is a ten-digit national mobile number (or the same with +84)."""
    e164 = normalize_phone_e164(c)
    national = F.concat(F.lit("0"), F.substring(e164, 4, 40))
    known = F.substring(national, 1, 3).isin(*VN_MOBILE_PREFIXES)
    return F.coalesce(e164.startswith("+84") & (F.length(national) == 10) & known, F.lit(False))


def query_value(url, name: str) -> Column:
    """Decoded value of one query parameter; a repeated parameter keeps its last value; NULL if absent."""
    query = F.regexp_extract(col(url), r"^[^?#]*\?([^#]*)", 1)
    found = F.regexp_extract(query, rf"^(?:.*&)?{name}=([^&]*)", 1)
    present = query.rlike(rf"(^|&){name}=")
    return F.when(present, F.coalesce(F.try_url_decode(found), found))


def parse_utm(url) -> Column:
    """The five campaign parameters of a URL as a struct."""
    return F.struct(*[query_value(url, f"utm_{n}").alias(f"utm{n}")
                      for n in ("source", "medium", "campaign", "term", "content")])


def mask_value(c, how: str = "mask") -> Column:
    """Hide a value: pattern mask, or a digest that still joins."""
    return F.sha2(col(c), 256) if how == "hash" else F.mask(col(c))
