"""Set-like arrays, maps and open attributes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinweave.functions.text import col


def ext_attr(attributes, key: str) -> Column:
    """Text of one open attribute, NULL when missing."""
    return F.try_element_at(col(attributes), F.lit(key))


def map_merge(left, right) -> Column:
    """Shallow merge: keys of the right map win, a NULL map counts as empty."""
    empty = F.expr("cast(map() as map<string,string>)")
    a, b = F.coalesce(col(left), empty), F.coalesce(col(right), empty)
    kept = F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k))
    return F.map_concat(kept, b)


def set_append(values, value, exclude=None) -> Column:
    """Append to a sorted distinct array, leaving out NULL, blank and the excluded value."""
    base = F.coalesce(col(values), F.expr("cast(array() as array<string>)"))
    joined = F.concat(base, F.array(col(value)))
    keep = lambda x: x.isNotNull() & (x != "")
    if exclude is not None:
        gone = col(exclude)
        keep = lambda x: x.isNotNull() & (x != "") & ~x.eqNullSafe(gone)
    return F.array_sort(F.array_distinct(F.filter(joined, keep)))


def contains_all(values, wanted: list[str]) -> Column:
    """True when the array holds every wanted value."""
    return F.coalesce(F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), col(values))) == 0, F.lit(False))


def map_contains(attributes, wanted: dict[str, str]) -> Column:
    """True when the map holds every wanted entry."""
    out = F.lit(True)
    for k, v in wanted.items():
        out = out & F.coalesce(ext_attr(attributes, k) == F.lit(v), F.lit(False))
    return out
