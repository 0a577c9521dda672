"""Product codes beside plain Lloyd rounds that compare every part with every entry."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from rillwork.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label string, code string, error string, codes string, kind string, part string, vector string"


def apart(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def plain(rows):
    """Sorted (vec_id, code, error, label_error) and the digest."""
    usable = [(v, e, lab) for v, e, lab in rows if e is not None and all(c is not None and math.isfinite(c) for c in e)]
    width = 4 * max(1, -(-max((len(e) for _, e, _ in usable), default=0) // 4))
    kept = []
    for v, e, lab in usable:
        whole = [max(-vc.LIMIT, min(vc.LIMIT, math.floor(1024 * c))) for c in e] + [0] * (width - len(e))
        kept.append((v is None, v or 0, whole, v, lab))
    kept.sort(key=lambda r: r[:3])
    size = width // 4
    cut = [[r[2][p * size:(p + 1) * size] for p in range(4)] for r in kept]
    books = [[list(x[p]) for x in cut[:256]] for p in range(4)]
    for number in range(5):
        codes = [[min((apart(x[p], e), i) for i, e in enumerate(books[p]))[::-1] for p in range(4)] for x in cut]
        if number < 4:
            members = defaultdict(list)
            for x, c in zip(cut, codes):
                for p in range(4):
                    members[p, c[p][0]].append(x[p])
            for (p, i), parts in members.items():
                books[p][i] = [sum(column) // len(parts) for column in zip(*parts)]
    per_label = defaultdict(int)
    for r, c in zip(kept, codes):
        per_label[r[4]] += sum(d for _, d in c)
    out = [(r[3], "".join(f"{i:02x}" for i, _ in c), sum(d for _, d in c), per_label[r[4]]) for r, c in zip(kept, codes)]
    return sorted(out, key=str), hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    found = vc.vector_codes(df).collect()
    want, digest = plain(rows)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found), key=str) == want
    assert {r.codebooks_sha256 for r in found} <= {digest}
    return found


def test_ties_repeats_and_moved_entries(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randint(-3, 3) / 1024 for _ in range(8)], rng.choice(["a", "b", None])) for i in range(700)]
    check(spark, rows + rows[:30])


def test_odd_vectors(spark):
    inf = math.inf
    rows = [(1, [0.5, -0.25, 0.1, 0.9, 0.3], "a"), (2, None, "a"), (3, [0.1, None], "b"), (4, [inf, 1.0], None), (5, [math.nan], None),
            (6, [1e300, -1e300, 1.0, 2.0], None), (7, [], "b"), (None, [0.5] * 5, None), (9, [0.5, -0.25, 0.1, 0.9, 0.3], "a"), (10, [1e5, 3.0], "c")]
    assert len(check(spark, rows)) == 6


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, [math.nan], None)]])
def test_nothing_to_code(spark, rows):
    assert check(spark, rows) == []


def test_many_near_clusters(spark):
    """Parts that leave fixed entries for moved ones, and the other way round, over all rounds."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    rows = [(int(i), (centres[i * i % 40] + rng.normal(scale=0.3, size=16)).tolist(), str(i % 3)) for i in rng.permutation(900)]
    check(spark, rows)


def test_active_entries_find_what_all_entries_would():
    rng = np.random.default_rng(7)
    for trial in range(60):
        points, entries = rng.integers(-4, 5, size=(80, 3)), rng.integers(-4, 5, size=(20, 3))
        codes, far = vc.nearest(points, entries)
        moved = rng.random(20) < (trial % 5) / 4
        after = np.where(moved[:, None], rng.integers(-4, 5, size=(20, 3)), entries)
        got = vc.reassigned(points, codes, far, after, moved)
        want = vc.nearest(points, after)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_distances_of_large_numbers_are_exact():
    points, entries = np.array([[vc.LIMIT, -vc.LIMIT + 1]]), np.array([[-vc.LIMIT, vc.LIMIT], [vc.LIMIT - 1, 7]])
    assert vc.squared_distances(points, entries).tolist() == [[apart(p, e) for e in entries.tolist()] for p in points.tolist()]
