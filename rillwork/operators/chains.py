"""Chains of times: from the first time of a group, always on to the first time more than ``hold`` later.

Each step depends on the one before, so a short group is walked in order. A
group too large for one task is cut into segments and walked in parallel:

1. every time learns the time it would go on to (a balanced running value);
2. inside a segment, those steps are followed to the time at which the chain
   would leave the segment, for each time a chain could come in at;
3. the ways through the segments are put together by doubling, so a chain
   through n segments takes log2(n) joins;
4. with its true entry known, each segment is walked once more.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from rillwork.operators.ordered import CELL_SECONDS, SEGMENT, Running, running, same_keys, with_cells
from rillwork.session import keep

# Executors may not have the package installed, so its functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def long_chains(times: DataFrame, keys: Sequence[str], hold: int, cell: float | None = None) -> DataFrame:
    """(keys, ``__at``, ``__next``) of the chain members of every group.

    ``times`` has the columns keys and ``__at`` (microseconds), without
    duplicates; ``cell`` is in seconds.
    """
    keys = list(keys)
    width = int((cell or CELL_SECONDS) * 1_000_000)
    nodes = with_cells(times.select(*keys, "__at"), "__at", width)
    steps = _join(nodes, _next_times(nodes.drop(SEGMENT), keys, hold, width), [*keys, "__at"], "inner")
    # Read by several plans below, so it is written once.
    steps = keep(steps)

    ends = steps.groupBy(*keys, SEGMENT).agg(F.max("__at").alias("__last"))
    leaving = _join(steps, ends, [*keys, SEGMENT], "inner").filter(F.col("__next") > F.col("__last"))
    starts = steps.groupBy(*keys).agg(F.min("__at").alias("__at"))
    entries = (leaving.select(*keys, F.col("__next").alias("__at")).distinct()
               .unionByName(starts).withColumn("__entry", F.lit(True)))
    marked = _join(steps, entries, [*keys, "__at"], "left")

    kinds = [times.schema[k] for k in keys]
    way_schema = T.StructType([*kinds, T.StructField("__at", T.LongType()), T.StructField("__exit", T.LongType())])
    ways = marked.groupBy(*keys, SEGMENT).applyInPandas(_ways_out(keys), way_schema)
    most = steps.groupBy(*keys).agg(F.count_distinct(SEGMENT).alias("n")).agg(F.max("n")).first()[0] or 1
    reached = _follow(starts, keep(ways.filter(F.col("__exit").isNotNull())), keys, most)

    entered = _join(steps, reached.withColumn("__entry", F.lit(True)), [*keys, "__at"], "left")
    chain_schema = T.StructType([*kinds, T.StructField("__at", T.LongType()), T.StructField("__next", T.LongType())])
    return entered.groupBy(*keys, SEGMENT).applyInPandas(_walk(keys), chain_schema)


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equality join in which null keys match, keeping the left key columns."""
    renamed = right.select(*[F.col(c).alias("__r_" + c) if c in keys else F.col(c) for c in right.columns])
    return left.join(renamed, same_keys(keys, "__r_"), how).drop(*["__r_" + k for k in keys])


def _next_times(times: DataFrame, keys: Sequence[str], hold: int, cell: int) -> DataFrame:
    """For every time the first one more than ``hold`` later: the nearest time after a probe row at its due time."""
    rows = times.select(*keys, F.col("__at").alias("__t"), F.lit(0).alias("__probe"))
    probes = times.select(*keys, (F.col("__at") + hold).alias("__t"), F.lit(1).alias("__probe"))
    nearest = Running("last", F.when(F.col("__probe") == 0, F.col("__t")), backward=True, exclusive=True)
    found = running(rows.unionByName(probes), keys, ["__t", "__probe"], {"__next": nearest}, cell)
    return found.filter(F.col("__probe") == 1).select(*keys, (F.col("__t") - hold).alias("__at"), "__next")


def _follow(starts: DataFrame, ways: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """All entries a chain passes: each round doubles the segments a way spans and the entries known."""
    reached, spanned = starts, 1
    while spanned < most:
        further = _join(reached, ways, [*keys, "__at"], "inner")
        reached = keep(reached.unionByName(further.select(*keys, F.col("__exit").alias("__at"))))
        onward = ways.select(*keys, F.col("__at").alias("__from"), F.col("__exit").alias("__at"))
        ways = keep(_join(onward, ways, [*keys, "__at"], "inner").select(
            *keys, F.col("__from").alias("__at"), "__exit"))
        spanned *= 2
    return reached


def _pointers(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted times of a segment, where each goes on to (-1: nowhere), and its place; itself if outside."""
    group.sort_values("__at", inplace=True, ignore_index=True)
    at = group["__at"].to_numpy()
    following = group["__next"].fillna(-1).astype("int64").to_numpy()
    inside = (following >= 0) & (following <= at[-1])
    place = np.where(inside, np.searchsorted(at, following), np.arange(len(at)))
    return at, following, place


def _ways_out(keys: list[str]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        at, following, place = _pointers(group)
        for _ in range(len(at).bit_length()):  # each pass doubles the steps followed
            place = place[place]
        entry = group["__entry"].notna().to_numpy()
        out = pd.Series(following[place[entry]], dtype="Int64")
        return group.loc[entry, keys].reset_index(drop=True).assign(__at=at[entry], __exit=out.mask(out < 0))

    return run


def _walk(keys: list[str]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        at, following, place = _pointers(group)
        walked = []
        for i in np.flatnonzero(group["__entry"].notna().to_numpy()):
            i = int(i)
            walked.append(i)
            while (j := int(place[i])) != i:
                walked.append(j)
                i = j
        out = pd.Series(following[walked], dtype="Int64")
        return group.loc[walked, keys].reset_index(drop=True).assign(__at=at[walked], __next=out.mask(out < 0))

    return run
