"""Cells of any width must give what a plain Python loop gives."""

import random

import pytest
from pyspark.sql import functions as F

from rillwork.operators import ordered
from rillwork.operators.ordered import Running, neighbours, number_rows, running


def make_rows(n=400, seed=3):
    """One hot key with a third of the rows, a hot null key, some small keys; ties in ts."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = rnd.choice(["hot"] * 4 + [None] * 3 + ["a", "b", "c", "d", "e"])
        rows.append((i, k, rnd.randrange(60), rnd.choice([None, *range(20)])))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, k string, ts int, v int").repartition(5)


def groups(rows, keyed):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        out.setdefault(r[1] if keyed else 0, []).append(r)
    return out


FOLDS = {
    "sum": lambda vs: sum(vs) if vs else None,
    "count": len,
    "min": lambda vs: min(vs, default=None),
    "max": lambda vs: max(vs, default=None),
    "first": lambda vs: vs[0] if vs else None,
    "last": lambda vs: vs[-1] if vs else None,
}


@pytest.mark.parametrize("per_segment", [None, 7, 40])
@pytest.mark.parametrize("keyed", [True, False])
def test_running_equals_loop(df, rows, per_segment, keyed):
    specs = {}
    for fold in FOLDS:
        for b in (False, True):
            for e in (False, True):
                specs[f"{fold}_{int(b)}{int(e)}"] = Running(fold, F.col("v"), b, e)
    got = running(df, ["k"] if keyed else [], ["ts", "id"], specs, per_segment).collect()
    expected = {}
    for g in groups(rows, keyed).values():
        for i, r in enumerate(g):
            for name in specs:
                fold, flags = name.split("_")
                e = int(flags[1])
                part = list(reversed(g[i + e:])) if flags[0] == "1" else g[:i + 1 - e]
                expected[r[0], name] = FOLDS[fold]([x[3] for x in part if x[3] is not None])
    assert len(got) == len(rows)
    for r in got:
        for name in specs:
            assert r[name] == expected[r["id"], name], (name, r)


@pytest.mark.parametrize("per_segment", [None, 7, 40])
@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("backward", [True, False])
def test_neighbours_equal_loop(df, rows, per_segment, keyed, backward):
    got = neighbours(df, ["k"] if keyed else [], ["ts", "id"], F.col("id"), 3, "near", backward, per_segment)
    expected = {}
    for g in groups(rows, keyed).values():
        for i, r in enumerate(g):
            ids = [x[0] for x in g]
            expected[r[0]] = ids[max(i - 3, 0):i][::-1] if backward else ids[i + 1:i + 4]
    assert {r["id"]: r["near"] for r in got.collect()} == expected


@pytest.mark.parametrize("most", [1, 15, 100])
@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("cell", [None, 1000])
def test_parts_of_any_size_give_the_same_rows(df, rows, keyed, most, cell):
    """Large keys divided, all rows in one cell of their key, many with one and the same first value."""
    specs = {f"{fold}_{int(b)}": Running(fold, F.col("v"), b, True) for fold in FOLDS for b in (False, True)}
    near = {"after": ordered.Near(F.col("id"), 3), "before": ordered.Near(F.col("id"), 1, backward=True)}
    same = df.withColumn("ts", F.when(F.col("ts") % 2 == 0, 7).otherwise(F.col("ts")))
    got = ordered.scan(same, ["k"] if keyed else [], ["ts", "id"], specs | near, cell, most).collect()
    expected = {}
    for g in groups([(i, k, 7 if ts % 2 == 0 else ts, v) for i, k, ts, v in rows], keyed).values():
        for i, r in enumerate(g):
            for name in specs:
                fold, backward = name.split("_")
                part = list(reversed(g[i + 1:])) if backward == "1" else g[:i]
                expected[r[0], name] = FOLDS[fold]([x[3] for x in part if x[3] is not None])
            expected[r[0], "after"] = [x[0] for x in g[i + 1:i + 4]]
            expected[r[0], "before"] = [x[0] for x in g[max(i - 1, 0):i]]
    assert len(got) == len(rows)
    assert all(r[name] == expected[r["id"], name] for r in got for name in [*specs, *near])


def test_a_hot_hour_is_divided(spark):
    """300 000 rows without a key within an hour, a third of them at one time: no part is much larger than asked for."""
    hot = spark.range(300_000).select("id", F.when(F.col("id") % 3 == 0, F.timestamp_seconds(F.lit(1_700_000_000))).otherwise(
        F.timestamp_micros(F.col("id") * 11_000 + 1_699_999_200_000_000)).alias("ts"))
    parts = ordered.in_parts(hot, [], ["ts", "id"], most=10_000).groupBy(ordered.SEGMENT).count().orderBy(ordered.SEGMENT).collect()
    assert len(parts) > 15 and max(r["count"] for r in parts) < 80_000
    numbered = number_rows(hot, [], ["ts", "id"], "rn", most=10_000)
    assert numbered.agg(F.count_distinct("rn"), F.min("rn"), F.max("rn")).first() == (300_000, 1, 300_000)
    assert numbered.sort("rn").limit(150_000).agg(F.max("ts")).first()[0] <= numbered.filter("rn > 150000").agg(F.min("ts")).first()[0]


def test_small_keys_are_not_divided(df):
    parts = ordered.in_parts(df, ["k"], ["ts", "id"]).select(ordered.SEGMENT, "__large").distinct().collect()
    assert [(r["__segment"]["cell"], r["__segment"]["cut"], r["__large"]) for r in parts] == [(0, 0, None)]


def test_a_hot_key_is_spread_over_its_cells(df):
    sizes = ordered.with_cells(df, "ts", 5).groupBy("k", ordered.SEGMENT).count().agg(F.max("count")).first()[0]
    assert sizes <= 40


@pytest.mark.parametrize("keyed", [True, False])
def test_the_plan_has_no_nested_loop_and_the_same_shape_at_every_width(df, keyed):
    shapes = set()
    for cell in (2, 1, 50):
        out = number_rows(df, ["k"] if keyed else [], ["ts", "id"], "rn", cell)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        shapes.add((plan.count("Window"), plan.count("Join"), plan.count("Exchange")))
    assert len(shapes) == 1


def test_order_must_begin_with_a_time_or_whole_number(df):
    with pytest.raises(TypeError):
        number_rows(df, [], ["k", "id"])


def test_times_before_the_epoch_and_null_times(spark):
    rows = [(i, f"19{60 + i}-01-01 00:00:00" if i % 7 else None) for i in range(25)]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    got = {r["id"]: r["rn"] for r in number_rows(df, [], ["ts", "id"]).collect()}
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[0]))
    assert got == {r[0]: n + 1 for n, r in enumerate(want)}
