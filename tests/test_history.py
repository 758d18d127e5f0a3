from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from orderloom.operators.changelog import history
from orderloom.streaming.history import merge_history, read_history

COLUMNS = ("product_id", "product_name", "valid_from", "valid_to")


def some_changes(rng, n):
    out = []
    for seq in range(n):
        hour, minute = rng.randrange(24), rng.choice([0, 0, 10, 50])
        op = rng.choice("uuud")
        number = rng.choice([seq, seq, None])
        out.append((rng.choice(["p1", "p2", "p3", None]), rng.choice([f"v{seq}", None]), f"{hour:02d}:{minute:02d}:00", op, number))
    out[3] = ("p1", "timeless", None, "u", 3)
    return out


@pytest.mark.parametrize("slice_hours", [1, 5, 24])
def test_late_and_equal_times_give_the_batch_history(spark, make, tmp_path, slice_hours):
    rng = random.Random(slice_hours)
    changes, path = some_changes(rng, 60), str(tmp_path)
    layout = {"buckets": 2, "slice_hours": slice_hours}
    for n, at in enumerate(range(0, 60, 15)):
        merge_history(path, **layout)(make.changes(*changes[at : at + 15]), n)
        want = rows(history(make.changes(*changes[: at + 15])), *COLUMNS)
        assert rows(read_history(spark, path), *COLUMNS) == want
    # A repeated batch, and one split over tasks, give the same.
    merge_history(path, max_task_rows=3, **layout)(make.changes(*changes[45:]), 3)
    assert rows(read_history(spark, path), *COLUMNS) == want
    assert {p.name for p in (tmp_path / "list").iterdir()} == {"batch=2", "batch=3"}


def written(path, batch):
    return {"/".join(p.parts[-2:]) for p in (path / "data" / f"version={batch}").glob("bucket=*/slice=*")}


def test_only_touched_slots_are_written(spark, make, tmp_path):
    apply = merge_history(str(tmp_path), buckets=1, slice_hours=1)
    apply(make.changes(*[("a", f"v{h}", f"{h:02d}:30:00", "u", h) for h in (0, 5, 9, 20)]), 0)
    assert len(written(tmp_path, 0)) == 4
    # In the middle of the interval of 05:30: its slot and the new one.
    apply(make.changes(("a", "late", "07:00:00", "u", 30)), 1)
    base = min(int(s.rpartition("=")[2]) for s in written(tmp_path, 0))
    assert {int(s.rpartition("=")[2]) - base for s in written(tmp_path, 1)} == {5, 7}
    # Behind the last change of its slot.
    apply(make.changes(("a", "end", "20:40:00", "u", 31)), 2)
    assert {int(s.rpartition("=")[2]) - base for s in written(tmp_path, 2)} == {20}
    # Another key touches its own slot only.
    apply(make.changes(("b", "one", "09:00:00", "u", 32)), 3)
    assert {int(s.rpartition("=")[2]) - base for s in written(tmp_path, 3)} == {9}
    found = read_history(spark, str(tmp_path)).filter("product_id = 'a'").select(
        "product_name", F.hour("valid_from"), F.hour("valid_to")
    )
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1:2] + (r[0],)) == [
        ("v0", 0, 5), ("v5", 5, 7), ("late", 7, 9), ("v9", 9, 20), ("end", 20, None), ("v20", 20, 20)
    ]


def test_empty_batches(spark, make, tmp_path):
    apply = merge_history(str(tmp_path))
    apply(make.changes(), 0)
    assert read_history(spark, str(tmp_path)).count() == 0
    apply(make.changes(("a", "v", "01:00:00", "u", 0)), 1)
    apply(make.changes((None, "v", "01:00:00", "u", 0)), 2)
    assert rows(read_history(spark, str(tmp_path)), "product_id") == [("a",)]
