"""Event patterns of any number of steps, as a nondeterministic automaton.

``begin("a", cond).next("b", cond).followed_by("c", cond).times(2, 3).followed_by_any("d", cond).lasting(seconds)``

A step is reached strictly (``next``: the very next row), relaxed (``followed_by``: the next row that fits) or relaxed with a choice
(``followed_by_any``: every later row that fits). ``times`` repeats a step, relaxed or ``consecutive``; of a range every number
of repeats counts. Each row that fits the first step begins a match of its own. ``lasting`` is strict: a match
spans less. The conditions are columns, so Spark evaluates them, and the automaton sees one number a row.

Batch: rows are cut into cells of time as long as the limit, and each row goes to its own cell, where it may begin
matches, and to the one before, whose matches it may go on with; so a match is found whole in the cell it begins in, and a key of
any size is spread over its cells. Cells are walked in order over sorted Arrow batches; what is held are the open matches, as
linked rows that all continuations of a match share, and not the rows. Stream: ``streaming.processors.PatternWatch`` runs the same machine.

Rows without a time are in no match. Null conditions are false; null keys are a key.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from rillwork.functions.scalar import epoch_micros, floor_div

# Executors may not have the package installed, so its functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEXT, RELAXED, ANY = "next", "relaxed", "any"
MATCH, TIMEOUT = "match", "timeout"


@dataclass(frozen=True)
class Step:
    name: str
    where: Column
    after: str
    least: int = 1
    most: int = 1
    repeats: str = RELAXED


@dataclass(frozen=True)
class Pattern:
    """Steps in their order; every method gives a new pattern."""

    steps: tuple[Step, ...]
    within: float | None = None

    def _with(self, name: str, where: Column, after: str) -> Pattern:
        if name in [s.name for s in self.steps]:
            raise ValueError(f"two steps are named {name}")
        return replace(self, steps=(*self.steps, Step(name, where, after)))

    def next(self, name: str, where: Column) -> Pattern:
        return self._with(name, where, NEXT)

    def followed_by(self, name: str, where: Column) -> Pattern:
        return self._with(name, where, RELAXED)

    def followed_by_any(self, name: str, where: Column) -> Pattern:
        return self._with(name, where, ANY)

    def times(self, least: int, most: int | None = None, consecutive: bool = False) -> Pattern:
        """The last step ``least`` to ``most`` times."""
        if not 1 <= least <= (most or least):
            raise ValueError("a step is repeated once or more, from the smaller number to the greater")
        last = replace(self.steps[-1], least=least, most=most or least, repeats=NEXT if consecutive else RELAXED)
        return replace(self, steps=(*self.steps[:-1], last))

    def lasting(self, seconds: float) -> Pattern:
        return replace(self, within=seconds)

    def hits(self) -> Column:
        """One bit for each step whose condition the row fits."""
        bits = [F.when(s.where, F.lit(1 << i)).otherwise(0) for i, s in enumerate(self.steps)]
        return sum(bits[1:], bits[0]).cast("long")

    def machine(self) -> Machine:
        if self.within is None:
            raise ValueError("a pattern needs lasting(seconds), so that its open matches end")
        first, states = [], []
        for number, step in enumerate(self.steps):
            first.append(len(states))
            states += [(number, repeat) for repeat in range(1, step.most + 1)]
        edges, ends = [], []
        for at, (number, repeat) in enumerate(states):
            step, on = self.steps[number], []
            if repeat < step.most:
                on.append((at + 1, step.repeats))
            if repeat >= step.least and number + 1 < len(self.steps):
                on.append((first[number + 1], self.steps[number + 1].after))
            edges.append(tuple(on))
            ends.append(repeat >= step.least and number + 1 == len(self.steps))
        return Machine([n for n, _ in states], edges, ends, int(self.within * 1_000_000))


def begin(name: str, where: Column) -> Pattern:
    return Pattern((Step(name, where, NEXT),))


# An open match: when it began, its last row as (row before, step, row), its state, and the edges still open.
Open = tuple[int, tuple, int, tuple]


class Machine:
    """The automaton of a pattern: ``edges`` from state to state, each with how it is reached."""

    def __init__(self, step_of: list[int], edges: list[tuple], ends: list[bool], within: int):
        self.step_of, self.edges, self.ends, self.within = step_of, edges, ends, within
        self.strict = any(how == NEXT for on in edges for _, how in on)

    def feed(self, opened: list[Open], at: int, hits: int, row, may_begin: bool, out: list) -> list[Open]:
        """The open matches after the next row; ``out`` gets (tag, path) of those that end."""
        left, new = [], []
        for match in opened:
            start, path, state, on = match
            if at - start >= self.within:
                self._expired(match, out)
                continue
            kept = []
            for edge in on:
                target, how = edge
                if hits >> self.step_of[target] & 1:
                    new.append((start, (path, self.step_of[target], row), target))
                    if how == ANY:
                        kept.append(edge)
                elif how != NEXT:
                    kept.append(edge)
            if kept:
                left.append(match if len(kept) == len(on) else (start, path, state, tuple(kept)))
        if may_begin and hits & 1:
            new.append((at, (None, 0, row), 0))
        for start, path, state in new:
            if self.ends[state]:
                out.append((MATCH, path))
            if self.edges[state]:
                left.append((start, path, state, self.edges[state]))
        return left

    def expire(self, opened: list[Open], at: int | None, out: list) -> list[Open]:
        """Let the limits of open matches pass up to a time, all of them if it is None."""
        left = []
        for match in opened:
            if at is None or at - match[0] >= self.within:
                self._expired(match, out)
            else:
                left.append(match)
        return left

    def _expired(self, match: Open, out: list) -> None:
        if not self.ends[match[2]]:  # what has been a match already does not run out
            out.append((TIMEOUT, match[1]))


def rows_of(path: tuple) -> list[tuple]:
    """(step, row) of a path, in order."""
    found = []
    while path is not None:
        path, step, row = path
        found.append((step, row))
    return found[::-1]


def matches(df: DataFrame, keys: Sequence[str], order: Sequence[str], pattern: Pattern, columns: Sequence[str]) -> DataFrame:
    """(keys, ``tag``, a column per step): the matches, and with tag ``timeout`` those that ran out of time on the way.

    A step's column is a struct of ``columns``, of a repeated step an array of them; steps that were not reached are null.
    """
    machine, steps = pattern.machine(), pattern.steps
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = [f"k{i}" for i in range(len(keys))]
    width = machine.within
    at = epoch_micros(F.col(order[0]))
    rows = df.filter(F.col(order[0]).isNotNull()).select(
        *[F.col(k).alias(n) for n, k in zip(names, keys)], at.alias("at"), pattern.hits().alias("hits"), F.struct(*columns).alias("row"),
        *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    if not machine.strict:
        rows = rows.filter("hits <> 0")
    cell = floor_div(F.col("at"), width)
    copies = F.explode(F.array(F.struct(cell.alias("cell"), F.lit(True).alias("own")), F.struct((cell - 1).alias("cell"), F.lit(False).alias("own"))))
    rows = rows.select("*", copies.alias("c")).select("*", "c.cell", "c.own").drop("c")
    sorted_rows = rows.repartition(*names, "cell").sortWithinPartitions(*names, "cell", *[f"o{i}" for i in range(len(order))])

    one = T.StructType([T.StructField(c, kinds[c]) for c in columns])
    fields = [T.StructField(n, kinds[k]) for n, k in zip(names, keys)] + [T.StructField("tag", T.StringType())]
    fields += [T.StructField(f"s{i}", one if s.most == 1 else T.ArrayType(one)) for i, s in enumerate(steps)]
    types, single = [to_arrow_type(f.dataType) for f in fields], [s.most == 1 for s in steps]
    walk = _walk(machine, len(names), single, [f.name for f in fields], types)
    found = sorted_rows.select(*names, "cell", "at", "hits", "own", "row").mapInArrow(walk, T.StructType(fields))
    return found.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], "tag", *[F.col(f"s{i}").alias(s.name) for i, s in enumerate(steps)])


def _walk(machine: Machine, n_keys: int, single: list[bool], names: list[str], types: list[pa.DataType]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, opened, done = None, [], []

        def told(key: tuple, out: list) -> None:
            for tag, path in out:
                reached: list[list] = [[] for _ in single]
                for step, row in rows_of(path):
                    reached[step].append(row)
                done.append((*key, tag, *[(r[0] if alone else r) if r else None for alone, r in zip(single, reached)]))
            out.clear()

        def written() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * len(names)
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
            done.clear()
            return made

        out: list = []
        for batch in batches:
            plain = [batch.column(i).to_pylist() for i in range(n_keys + 4)]
            payload = batch.column(n_keys + 4)
            for i, values in enumerate(zip(*plain)):
                group, (at, hits, own) = values[:n_keys + 1], values[n_keys + 1:]
                if group != where:
                    if where is not None:
                        machine.expire(opened, None, out)
                        told(where[:-1], out)
                    where, opened = group, []
                if opened or own and hits & 1:
                    opened = machine.feed(opened, at, hits, payload[i].as_py() if hits else None, own, out)
                    if out:
                        told(where[:-1], out)
            if done:
                yield written()
        if where is not None:
            machine.expire(opened, None, out)
            told(where[:-1], out)
        yield written()

    return run
