"""Joins that must not multiply rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from holdfast.schema import require_columns
from holdfast.sources.staging import stage

_ROWS = "_rows_of_key"


class RepeatedKeys(ValueError):
    """The right side of a join had several rows for a key; ``surplus`` rows too many."""

    def __init__(self, label: str, keys: Sequence[str], surplus: int):
        super().__init__(f"{label} repeats its keys {list(keys)}: the join would add {surplus} rows")
        self.surplus = surplus


def checked_left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], label: str = "right side"
) -> DataFrame:
    """Every row of ``left`` with the columns of its only match in ``right``, or nulls.

    The right side is first reduced to the left one's keys, so a short left side meets few
    rows, and combined per key, so no row of the left is ever repeated. The number of right
    rows a plain join would have added is counted while the result is written to shared
    storage, in the same pass; :class:`RepeatedKeys` is raised if there are any. Counted are
    rows as they are written, so a task run again counts once. Right rows whose key no left
    row has are not looked at; a null key matches nothing. A column of the right side that
    the left one also has is left out.
    """
    keys = list(keys)
    require_columns(left, keys, "left side")
    require_columns(right, keys, label)
    own = [c for c in right.columns if c not in left.columns]
    named = [F.col(f"`{c}`") for c in own]
    wanted = right.select(*keys, *named).join(left.select(*keys), keys, "left_semi")
    held = F.first(F.struct(*named)).alias("_held") if own else F.lit(None).alias("_held")
    combined = wanted.groupBy(*keys).agg(held, F.count(F.lit(1)).alias(_ROWS))
    joined = left.join(combined, keys, "left")
    columns = [*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"_held.`{c}`").alias(c) for c in own]]
    seen = Observation()
    surplus = F.coalesce(F.sum(F.greatest(F.col(_ROWS) - 1, F.lit(0))), F.lit(0))
    watched = joined.observe(seen, surplus.alias("surplus")).select(*columns)
    result = stage(watched, "joined")
    if seen.get["surplus"]:
        raise RepeatedKeys(label, keys, seen.get["surplus"])
    return result
