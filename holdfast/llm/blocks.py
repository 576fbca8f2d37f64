"""Links inside groups of any size, with no task that holds more than a few blocks of one.

A group of up to ``block`` members is compared whole. A larger one is dealt twice into random
blocks, so members that belong together are joined across blocks through those they share.
Only groups that still hold several components are compared further: the members of the
largest component stay in their block, and each other member visits all blocks. Nothing is
compared that is already known to be connected, and a group gives fewer links than it has
rows, so a family of copies costs in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.components import connected
from holdfast.sources.staging import stage

# Links that a task remembers so as not to repeat them.
_REMEMBERED = 1 << 17


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal first two columns in a sorted stream of batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(2)])
        cuts = np.flatnonzero((ends[1:] != ends[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            key = tuple(ends[a].tolist())
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def links_of(comp: np.ndarray, home: np.ndarray, similar: Callable) -> Iterator[tuple[int, int]]:
    """Positions of one pair for each join of two components. Pairs of two visitors are left
    to their own blocks. ``similar(x, ys)`` says which of ``ys`` are linked with ``x``."""
    labels = np.unique(comp, return_inverse=True)[1]
    for x in range(len(comp) - 1):
        ys = np.flatnonzero(labels[x + 1 :] != labels[x]) + x + 1
        if not home[x]:
            ys = ys[home[ys]]
        if not len(ys):
            continue
        found = ys[similar(x, ys)]
        joined, first = np.unique(labels[found], return_index=True)
        for y in found[first].tolist():
            yield x, y
        if len(joined):
            labels[np.isin(labels, joined)] = labels[x]


def _linker(judge: Callable):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int]] = set()
        fresh: list[tuple[int, int]] = []
        for table in _groups(batches):
            if table.num_rows < 2:
                continue
            ids, comp, home = (table.column(c).to_numpy() for c in ("id", "comp", "home"))
            for x, y in links_of(comp, home, judge(table)):
                pair = int(ids[x]), int(ids[y])
                if pair not in known:
                    known.add(pair)
                    fresh.append(pair)
            if len(fresh) >= 4096:
                yield _pairs(fresh)
                fresh = []
            if len(known) >= _REMEMBERED:
                known = set()
        yield _pairs(fresh)

    return link


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _links(dealt: DataFrame, payload: DataFrame, judge: Callable) -> DataFrame:
    rows = dealt.join(payload, "id").select("group", "part", "id", "comp", "home", *payload.drop("id").columns)
    rows = rows.repartition("group", "part").sortWithinPartitions("group", "part", "id")
    return rows.mapInArrow(_linker(judge), "a long, b long")


def linked_components(
    members: DataFrame, payload: DataFrame, judge: Callable, block: int, overlap: bool = True
) -> DataFrame:
    """(node, component) of all links inside the groups of ``members``.

    ``members`` has (group, id, size), one row per member, with the same size all over a
    group: its number of members, or more where members are heavy. ``payload`` has one row
    per id. ``judge(table)`` gets the payload of one block and returns ``similar`` of
    :func:`links_of`. Without ``overlap`` members are dealt once, which is enough where each is in
    many groups. Nodes without a link are left out.
    """
    parts = F.ceil(F.col("size") / block).cast("int")
    dealt = lambda seed: F.pmod(F.xxhash64("id", "group", F.lit(seed)), parts).cast("int")
    blocks = F.array_distinct(F.array(dealt(1), dealt(2))) if overlap else F.array(dealt(1))
    blocks = F.when(parts == 1, F.array(F.lit(0))).otherwise(blocks)
    first = members.select("group", F.explode(blocks).alias("part"), "id", F.col("id").alias("comp"), F.lit(True).alias("home"))
    found = connected(_links(first, payload, judge))

    large = members.where(F.col("size") > block)
    if large.isEmpty():
        return found
    found = stage(found, "joined")
    named = found.withColumnsRenamed({"node": "id", "component": "comp"})
    large = large.join(named, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    tally = large.groupBy("group", "comp").agg(F.count(F.lit(1)).alias("n"))
    lead = tally.groupBy("group").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("lead"), F.count(F.lit(1)).alias("comps")
    )
    split = large.join(lead.where("comps > 1"), "group").withColumn("parts", parts).withColumn("own", dealt(1))
    visits = F.when(F.col("comp") == F.col("lead"), F.array("own")).otherwise(
        F.sequence(F.lit(0), F.col("parts") - 1)
    )
    second = split.select("group", F.explode(visits).alias("part"), "id", "comp", "own")
    second = second.select("group", "part", "id", "comp", (F.col("part") == F.col("own")).alias("home"))
    more = stage(_links(second, payload, judge), "links")
    if more.isEmpty():
        return found
    return connected(more.union(found.select(F.col("node").alias("a"), F.col("component").alias("b"))))
