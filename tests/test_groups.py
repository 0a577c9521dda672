"""Keys of a stream in groups: what the state holds, and how a firing brings rows in order."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from rillwork.streaming import processors as p, runner

def test_state_calls_go_by_groups_and_not_by_keys(spark, tmp_path):
    """Ten thousand keys with rows of several hours wait in one pack a group, and what they remember is one row a group."""
    rows = spark.range(20_000).select(F.col("id").alias("event_id"), (F.col("id") % 10_000).alias("user_id"),
                                      F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7).alias("ts"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = p.keyed(stream, ["user_id"], "ts", "0 seconds", ["event_id"], p.NearFirst(10**7))
    query = runner.start(out, str(tmp_path / "out"), str(tmp_path / "check"), "append", {"availableNow": True})
    query.awaitTermination()
    sizes = [b["stateOperators"][0]["numRowsTotal"] for b in query.recentProgress if b["stateOperators"]]
    assert sizes and max(sizes) <= 6 * p.GROUPS
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10_000


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Map(dict):
    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class Handle:
    """The state of one group, without Spark."""

    def __init__(self):
        self.timers = set()

    def getMapState(self, *_):
        return Map()

    def getValueState(self, *_):
        return Value()

    def listTimers(self):
        return list(self.timers)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Passed:
    def __init__(self, micros):
        self.micros = micros

    def getCurrentWatermarkInMs(self):
        return self.micros // 1000


def started(processor, spark, **kinds):
    """A processor as ``keyed`` prepares it, with state of its own."""
    keys = [n for n in kinds if n.startswith("key")]
    stream = spark.readStream.format("rate").load().select(F.col("timestamp").alias("ts"), *[F.lit(None).cast(k).alias(n) for n, k in kinds.items()])
    p.keyed(stream, keys, "ts", "0 seconds", [n for n in kinds if n not in keys], processor)
    processor.init(Handle())
    return processor


def packs_of(processor, rows, size):
    """Rows as the step before the shuffle packs them, ``size`` Arrow rows a batch; all in one part."""
    names = ["closing", "part", *processor.packed.names]
    columns = list(zip(*[(False, 0, *r) for r in rows]))
    types = [pa.bool_(), pa.int64(), *processor.packed.types]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
    step = p._pack(processor.packed)
    for begin in range(0, len(batch), size):
        yield from (b.to_pandas() for b in step(iter([batch.slice(begin, size)])))


def told(processor, frames):
    found = [pa.ipc.read_record_batch(pa.py_buffer(b), processor.telling).to_pylist() for f in frames for b in f["rows"]]
    return [tuple(r.values()) for rows in found for r in rows], [len(rows) for rows in found]


def test_a_hot_key_is_folded_in_slices(spark, monkeypatch):
    """Rows in any order, firings at several watermarks: the change log is the plain one, and no message holds all of it."""
    rng = random.Random(5)
    for name, value in (("SLICE", 300), ("PIECE", 40), ("MERGED", 200), ("TOLD", 100), ("GATHER", 500)):
        monkeypatch.setattr(p, name, value)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(1, 10**9), i) for i in range(4000)]
    processor = started(p.Retract("key string"), spark, key="string", event_id="long")
    got, sizes, before = [], [], 0
    for until in (3 * 10**8, 6 * 10**8, 10**9):
        # rows come before the watermark passes them, the next part's among them
        part = [r for r in rows if before < r[1] <= until + 10**8]
        part = [r for r in part if not (before and r[1] <= before + 10**8)]
        rng.shuffle(part)
        list(processor.handleInputRows((0,), packs_of(processor, part, 700), Passed(before)))
        found, n = told(processor, processor.handleExpiredTimer((0,), Passed(until), None))
        got, sizes, before = got + found, sizes + n, until
    want, counts = [], {}
    for key, at, i in sorted(rows, key=lambda r: (r[1], r[2])):
        n = counts.get(key, 0)
        want += [(key, at, i, False, n)] * (n > 0) + [(key, at, i, True, n + 1)]
        counts[key] = n + 1
    assert sorted(got, key=str) == sorted(want, key=str)
    assert max(sizes) <= 100 and not processor.waiting


def test_values_are_read_as_rows_have_them():
    """Whole columns come out as ``to_pylist`` gives them, with the same Python types."""
    columns = [pa.array([1, 2, -3]), pa.array([1, None, 3], pa.int32()), pa.array([2**53 + 1, None, -(2**62)]), pa.array([True, False, True]), pa.array([True, None, False]),
               pa.array([0.5, -0.0, 7.25]), pa.array([0.5, None, 7.0]), pa.array([1.5, 2.5, 0.1], pa.float32()), pa.array(["a", None, "\u00e4\0"]), pa.array([[1], None, []]),
               pa.array([None, None, None])]
    columns = [c for column in columns for c in (column, column.slice(1), column.slice(0, 0))]
    for column in columns:
        got, want = p.listed(column), column.to_pylist()
        assert got == want and [type(v) for v in got] == [type(v) for v in want], column.type
    rows = pa.RecordBatch.from_arrays(columns[::3], [f"c{i}" for i in range(len(columns) // 3)])
    assert p._dicts(rows) == rows.to_pylist()


def test_memories_of_a_group_are_kept_by_key(spark, monkeypatch):
    """Untouched keys stay as they are, deadlines fire without rows, nested memory comes back."""
    monkeypatch.setattr(p, "SLICE", 2)
    watch = p.FollowedBy(0.1)
    watch.output_schema = watch.output_schema.replace("user_id long", "user_id double")
    processor = started(watch, spark, key="double", is_first="boolean", is_second="boolean", event_id="long")
    nan = float("nan")
    rows = [(1.0, 10_000, True, False, 1), (nan, 10_010, True, False, 2), (None, 11_000, True, False, 3), (nan, 10_050, False, True, 4), (nan, 10_060, True, False, 5)]
    rows = [(key, 1000 * millis, *marks) for key, millis, *marks in rows]
    list(processor.handleInputRows((0,), packs_of(processor, rows, 2), Passed(0)))
    first, _ = told(processor, processor.handleExpiredTimer((0,), Passed(10_070_000), None))
    assert [r[1:] for r in first] == [(2, 4, "match")]
    assert len(processor.waiting) == 1 and processor.memory.exists()
    second, _ = told(processor, processor.handleExpiredTimer((0,), Passed(20_000_000), None))
    assert sorted(r[1:] for r in second) == [(1, None, "timeout"), (3, None, "timeout"), (5, None, "timeout")]
    assert not processor.memory.exists() and not processor.waiting


def test_an_outer_join_meets_rows_near_in_time(spark, monkeypatch):
    """The key of the join has a cell of time beside the user, so a user's rows are not all paired."""
    from rillwork.plans import stateful

    seen = []
    monkeypatch.setattr(stateful.runner, "replay", lambda source, ts, plan, *_, **__: seen.append(plan(source.withColumn(runner.CLOSING, F.lit(False)))) or seen[0])
    stateful.left_join_stream(spark, "/root/testdata/sf0.001")
    plan = seen[0]._jdf.queryExecution().analyzed().toString()
    assert any("Join LeftOuter" in line and "cell" in line and "right_cell" in line for line in plan.splitlines())


def test_ring_of_values_goes_on_from_its_memory():
    rows = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([10, None, 30]), pa.array([1, 2, 3])], [p.AT, "cents", "event_id"])
    out = []
    assert p.CountSlide(3, 2).on_rows(("u",), (1, [5]), rows, out) == (4, [10, None, 30])
    assert out == [("u", 2, [10, 5]), ("u", 4, [30, None, 10])]
