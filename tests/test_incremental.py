"""State + delta equals the full run."""

import os
import random

import pytest
from pyspark.sql import functions as F

from curato.plans.incremental import PickState

SCHEMA = "hotel_id long, image_id long, image_score double, cdn_url string"


def frame(spark, images):
    rows = [(h, i, s, f"u{i}-{s}") for i, (h, s, ok) in images.items() if ok]
    return spark.createDataFrame(rows, SCHEMA)


def best(images):
    out = {}
    for i, (h, s, ok) in images.items():
        if ok:
            key = (s is None, -(s or 0.0), i)
            out[h] = min(out.get(h, (key, i, s)), (key, i, s))
    return {h: (i, s, f"u{i}-{s}") for h, (_, i, s) in out.items()}


def held(state):
    return {r.hotel_id: (r.image_id, r.image_score, r.cdn_url) for r in state.top().collect()}


@pytest.mark.parametrize("k", [1, 3])
def test_updates_equal_the_full_run(spark, tmp_dir, k):
    rng = random.Random(k)

    def record():
        return rng.randrange(12), rng.choice([None, 0.0, 1.0, 2.0, rng.random()]), rng.random() < 0.8

    images = {i: record() for i in range(120)}
    path = os.path.join(tmp_dir, "state")
    state = PickState.build(frame(spark, images), path, k, buckets=5)
    assert held(state) == best(images)
    for step in range(3):
        before, delta = best(images), {}
        for i in [*rng.sample(range(120), 25), *range(200 + step * 5, 203 + step * 5)]:
            old, new = images.get(i), record()
            if old and old[0] != new[0]:
                delta[old[0], i] = (None, False)          # the place it left
            images[i] = new
            delta[new[0], i] = (new[1], new[2])
        for i, (h, _, ok) in list(images.items()):        # the best of some hotels go, one after another
            if ok and h in (1, 2, 3) and before.get(h, (None,))[0] == i:
                images[i] = (h, None, False)
                delta[h, i] = (None, False)
        rows = [(h, i, s, f"u{i}-{s}", ok) for (h, i), (s, ok) in delta.items()]
        asked = []

        def full(hotels, asked=asked):
            asked += [r.hotel_id for r in hotels.collect()]
            return frame(spark, images)

        state, changes = state.update(spark.createDataFrame(rows, SCHEMA + ", candidate boolean"), full)
        after = best(images)
        assert held(state) == after == held(PickState.open(spark, path))
        got = {r.hotel_id: (r.old_image_id, r.new_image_id) for r in changes.collect()}
        want = {h: (before.get(h, (None,))[0], after.get(h, (None,))[0]) for h in set(before) | set(after)}
        assert got == {h: c for h, c in want.items() if c[0] != c[1]}
        if k == 1:
            assert asked                                   # short lists run empty and are rebuilt
    state.vacuum()
    assert held(PickState.open(spark, path)) == best(images)


def test_only_touched_buckets_are_read_and_written(spark, tmp_dir, monkeypatch):
    images = {i: (i % 40, float(i), True) for i in range(400)}
    state = PickState.build(frame(spark, images), os.path.join(tmp_dir, "s"), 2, buckets=16)
    read, real = [], PickState.rows
    monkeypatch.setattr(PickState, "rows", lambda self, b=None: (read.append(b), real(self, b))[1])
    delta = spark.createDataFrame([(7, 7, 900.0, "u", True)], SCHEMA + ", candidate boolean")
    new, changes = state.update(delta, lambda hotels: frame(spark, images))
    assert len(read) == 1 and len(read[0]) == 1            # one hotel, one bucket
    changed = {b for b in new.folders if new.folders[b] != state.folders[b]}
    assert changed == set(read[0]) and [r.new_image_id for r in changes.collect()] == [7]


def test_a_failed_update_leaves_the_state(spark, tmp_dir):
    images = {i: (i % 3, float(i), True) for i in range(9)}
    path = os.path.join(tmp_dir, "s")
    state = PickState.build(frame(spark, images), path, 1, buckets=2)
    delta = spark.createDataFrame([(0, 6, None, None, False)], SCHEMA + ", candidate boolean")

    def full(hotels):
        raise OSError("feed is gone")

    with pytest.raises(OSError):
        state.update(delta, full)
    assert held(PickState.open(spark, path)) == best(images)


def test_hotels_come_and_go(spark, tmp_dir):
    path = os.path.join(tmp_dir, "s")
    state = PickState.build(spark.createDataFrame([], SCHEMA), path, 2, buckets=3)
    with pytest.raises(ValueError):
        state.top()
    schema = SCHEMA + ", candidate boolean"
    state, changes = state.update(spark.createDataFrame([(1, 5, 0.5, "u", True), (2, 6, None, "v", True)], schema),
                                  lambda h: spark.createDataFrame([], SCHEMA))
    assert held(state) == {1: (5, 0.5, "u"), 2: (6, None, "v")} and changes.count() == 2
    empty = spark.createDataFrame([], SCHEMA)
    state, changes = state.update(spark.createDataFrame([(1, 5, None, None, False)], schema), lambda h: empty)
    assert held(state) == {2: (6, None, "v")} and [tuple(r)[:3] for r in changes.collect()] == [(1, 5, None)]
    with pytest.raises(ValueError):
        PickState.open(spark, os.path.join(tmp_dir, "none"))
    with pytest.raises(ValueError):
        PickState.build(spark.createDataFrame([], SCHEMA), path, 0)
