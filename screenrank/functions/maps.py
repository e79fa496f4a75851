"""list of (mid, score) pairs -> map, map lookup with a default.

Joins are the scalable form of these lookups (see ``operators.realtime``);
the map functions serve per-row work on already-nested rows, such as reading
one item's score out of a stored recommendation list.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def recs_to_map(recs: str | Column) -> Column:
    """array<struct<mid, score>> -> map<mid, score> (last entry wins on repeats)."""
    c = F.col(recs) if isinstance(recs, str) else recs
    placed = F.array_sort(F.transform(c, lambda x, i: F.struct(x["mid"].alias("mid"), i.alias("i"),
                                                               x["score"].alias("score"))))

    def last_of_its_item(x: Column, i: Column) -> Column:
        following = F.get(placed, i + 1)
        return following.isNull() | (following["mid"] != x["mid"])

    return F.map_from_entries(F.transform(F.filter(placed, last_of_its_item),
                                          lambda x: F.struct(x["mid"], x["score"])))


def lookup(m: str | Column, key: str | Column, default: float = 0.0) -> Column:
    """Score of ``key`` in map ``m``, or ``default`` when absent."""
    mc = F.col(m) if isinstance(m, str) else m
    kc = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.try_element_at(mc, kc), F.lit(default))
