import random

import pytest

from strata.operators import snapshots

ROWS = "local_path string, row_no bigint, tenure_id string, owner string, area_ha string, extra string"
LEDGER = "resource_id string, local_path string, fetched_at string, snapshot_date string, extra string"


def changes(spark, rows, ledger):
    out = snapshots.snapshot_changes(spark.createDataFrame(rows, ROWS), spark.createDataFrame(ledger, LEDGER), "tenure_id", ["owner", "area_ha"], ["area_ha"])
    return {tuple(r) for r in out.collect()}


def path(day, name="a"):
    return f"lake/raw/X/Y/2024-01-{day:02d}/{name}.csv"


def test_added_removed_changed(spark):
    rows = [(path(1), 1, " A ", "x", "27.50", "e"), (path(1), 2, "B", "x", "1", None), (path(1), 3, "C", None, "2", None), (path(2), 1, "A", "x ", "27.5", None), (path(2), 2, "C", "", "2", None), (path(2), 3, "C", "y", "2", None), (path(2), 9, "D", "X", "n/a", None)]
    ledger = [("r", path(1), "t1", None, "e"), ("r", path(2), "t2", "20240102", None), ("r", path(2), "t2", "20240102", None)]
    assert changes(spark, rows, ledger) == {("r", "2024-01-02", "B", "removed"), ("r", "2024-01-02", "C", "changed"), ("r", "2024-01-02", "D", "added")}


def test_the_file_fetched_last_stands(spark):
    rows = [(path(1), 1, "A", "x", None, None), (path(2, "old"), 1, "A", "y", None, None), (path(2, "new"), 1, "A", "x", None, None)]
    ledger = [("r", path(1), "t1", None, None), ("r", path(2, "old"), "t2", None, None), ("r", path(2, "new"), "t3", None, None)]
    assert changes(spark, rows, ledger) == set()


def test_empty_null_and_case(spark):
    assert changes(spark, [], []) == set()
    rows = [(path(1), 1, None, "x", None, None), (None, 1, "A", "x", None, None), (path(2), None, None, "X", None, None)]
    ledger = [("r", path(1), None, None, None), ("r", path(2), None, None, None), (None, path(2), None, None, None)]
    assert changes(spark, rows, ledger) == {("r", "2024-01-02", "", "changed")}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows, ledger, state = [], [], {}
    for day in range(1, 6):
        for _ in range(12):
            state[f"k{rnd.randrange(20)}"] = f"o{rnd.randrange(4)}"
        for k in rnd.sample(sorted(state), 3):
            del state[k]
        for n, (k, v) in enumerate(state.items()):
            rows.append((path(day), n, k, v, None, None))
        ledger.append(("r", path(day), f"t{day}", None, None))
    at = {d: {r[2]: r[3] for r in rows if r[0] == path(d)} for d in range(1, 6)}
    want = set()
    for d in range(2, 6):
        old, new = at[d - 1], at[d]
        for k in old.keys() | new.keys():
            if old.get(k) != new.get(k):
                want.add(("r", f"2024-01-{d:02d}", k, "added" if k not in old else "removed" if k not in new else "changed"))
    assert changes(spark, rows, ledger) == want
