"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinweave.functions.text import col, has_string_value

# Fixed value: the DNS name space of RFC 4122.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5_dns(c) -> Column:
    """Version-5 UUID of a text in the DNS name space."""
    h = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), F.encode(col(c), "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"),
        variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
    )


def link_id(raw_id, master_id) -> Column:
    return F.sha2(F.concat_ws(":", col(raw_id), col(master_id)), 256)


def event_id_hash(*parts) -> Column:
    """Digest of the parts joined by a bar; a NULL part counts as empty so positions never shift."""
    texts = [F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def fallback_visitor_id(visid, *key_parts) -> Column:
    """The visitor id, or a stable UUID made from the other identifying parts when it is blank."""
    key = F.concat(*[F.coalesce(col(p), F.lit("")) for p in key_parts])
    return F.when(has_string_value(visid), col(visid)).otherwise(uuid5_dns(key))
