"""Patterns of several steps beside an enumeration of all matches."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rillwork.operators import automaton
from rillwork.operators.automaton import ANY, NEXT, RELAXED
from rillwork.streaming import processors as p, runner

T0 = datetime(2024, 1, 1)
SCHEMA = "id long, user_id long, ts timestamp, kind string"


def rows_of(n=160, seed=1, span=900):
    rng = random.Random(seed)
    return [(i, rng.choice([1, 1, 1, 2, None]), T0 + timedelta(seconds=rng.randrange(span)), rng.choice("aabbccd")) for i in range(n)]


def enumerated(rows, pattern, fits):
    """Sorted (key, tag, ids per step) by definition; ``fits[i]`` are the kinds of step i."""
    steps, limit, found = pattern.steps, timedelta(seconds=pattern.within), []
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        by_key.setdefault(r[1], []).append(r)

    def go(key, own, start, path, step, repeat):
        """``path``: (step, place) so far; the last row is in ``step`` for the ``repeat``-th time."""
        last, ends = path[-1][1], repeat >= steps[step].least and step == len(steps) - 1
        ids = [[own[i][0] for s, i in path if s == k] for k in range(len(steps))]
        if ends:
            found.append((key, "match", ids))
        ways = [(step, repeat + 1, steps[step].repeats)] if repeat < steps[step].most else []
        if repeat >= steps[step].least and step + 1 < len(steps):
            ways.append((step + 1, 1, steps[step + 1].after))
        inside = [i for i in range(last + 1, len(own)) if own[i][2] - own[start][2] < limit]
        still_open = False
        for to, again, how in ways:
            fitting = [i for i in inside if own[i][3] in fits[to]]
            if how == NEXT:
                fitting = [i for i in fitting if i == last + 1]
                still_open |= not inside
            elif how == RELAXED:
                fitting = fitting[:1]
                still_open |= not fitting
            else:
                still_open = True
            for i in fitting:
                go(key, own, start, [*path, (to, i)], to, again)
        if still_open and not ends:
            found.append((key, "timeout", ids))

    for key, own in by_key.items():
        for start, r in enumerate(own):
            if r[3] in fits[0]:
                go(key, own, start, [(0, start)], 0, 1)
    return sorted(found, key=str)


def is_in(kinds):
    return F.col("kind").isin(list(kinds))


def built(spec, within):
    """((kinds, how, least, most, consecutive), ...) to a pattern."""
    pattern = None
    for i, (kinds, how, least, most, consecutive) in enumerate(spec):
        name = f"step{i}"
        if pattern is None:
            pattern = automaton.begin(name, is_in(kinds))
        else:
            pattern = {NEXT: pattern.next, RELAXED: pattern.followed_by, ANY: pattern.followed_by_any}[how](name, is_in(kinds))
        if (least, most) != (1, 1):
            pattern = pattern.times(least, most, consecutive)
    return pattern.lasting(within)


SPECS = [
    [("a", NEXT, 1, 1, False)],
    [("a", NEXT, 1, 1, False), ("b", NEXT, 1, 1, False), ("c", RELAXED, 1, 1, False)],
    [("a", NEXT, 1, 1, False), ("b", RELAXED, 1, 1, False), ("ab", NEXT, 1, 1, False), ("d", RELAXED, 1, 1, False)],
    [("a", NEXT, 2, 3, False), ("c", ANY, 1, 1, False)],
    [("a", NEXT, 1, 3, True), ("b", RELAXED, 2, 2, False)],
    [("ab", NEXT, 1, 1, False), ("b", ANY, 1, 2, True), ("c", NEXT, 1, 1, False)],
    [("d", NEXT, 1, 1, False), ("a", ANY, 1, 1, False), ("b", RELAXED, 1, 2, False), ("c", RELAXED, 1, 1, False)],
]


def ids_per_step(row, pattern):
    out = []
    for s in pattern.steps:
        value = row[s.name]
        out.append([] if value is None else [value["id"]] if s.most == 1 else [v["id"] for v in value])
    return out


@pytest.mark.parametrize("spec", SPECS)
@pytest.mark.parametrize("within", [40, 300])
def test_matches_equal_the_enumeration(spark, spec, within):
    rows = rows_of(seed=len(spec))
    pattern = built(spec, within)
    df = spark.createDataFrame([*rows, (999, 1, None, "a")], SCHEMA).repartition(3)
    found = automaton.matches(df, ["user_id"], ["ts", "id"], pattern, ["id", "ts"]).collect()
    got = sorted(((r["user_id"], r["tag"], ids_per_step(r, pattern)) for r in found), key=str)
    want = enumerated(rows, pattern, [s[0] for s in spec])
    assert got == want and (within == 40 or any(w[1] == "match" for w in want))


@pytest.mark.parametrize("spec", [SPECS[1], SPECS[3], SPECS[5], SPECS[6]])
def test_the_stream_finds_the_same(spark, tmp_path, spec):
    rows, pattern = rows_of(seed=4), built(spec, 200)
    arriving = sorted(rows, key=lambda r: (r[2] + timedelta(seconds=r[0] * 7 % 20), r[0]))
    for i in range(4):
        spark.createDataFrame([*arriving[40 * i:40 * i + 40], (2000 + i, 1, None, "a")], SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in{i}"))
    source = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path))
              .withColumn("hits", pattern.hits()).select("ts", "user_id", "hits", "id"))
    out = runner.replay(source, "ts", lambda df: p.keyed(df, ["user_id"], "ts", "25 seconds", ["hits", "id"], p.PatternWatch(pattern.machine())), "watch")
    got = sorted(((r["user_id"], r["tag"], [[i for s, i in zip(r["steps"], r["ids"]) if s == k] for k in range(len(spec))]) for r in out.collect()), key=str)
    assert got == enumerated(rows, pattern, [s[0] for s in spec])


def test_no_rows_and_refused_patterns(spark):
    one = automaton.begin("x", is_in("a"))
    assert automaton.matches(spark.createDataFrame([], SCHEMA), ["user_id"], ["ts", "id"], one.lasting(5), ["id"]).count() == 0
    with pytest.raises(ValueError):
        one.machine()
    with pytest.raises(ValueError):
        one.next("x", is_in("b"))
    with pytest.raises(ValueError):
        one.times(0, 2)


def test_a_hot_key_is_spread_over_cells(spark):
    """Rows of one key go to as many tasks as there are cells; no cell sees more than twice its share."""
    df = spark.range(20_000).select("id", F.lit(1).alias("k"), F.timestamp_seconds(F.col("id")).alias("ts"))
    pattern = automaton.begin("a", F.col("id") % 100 == 0).followed_by("b", F.col("id") % 100 == 7).lasting(60)
    found = automaton.matches(df, ["k"], ["ts", "id"], pattern, ["id"])
    assert found.filter("tag = 'match'").count() == 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
