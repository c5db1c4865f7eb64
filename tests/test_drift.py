import itertools
import json
import random

from strata.operators import drift

RAW = "local_path string, source_table string, row_no bigint, payload string, extra string"
LEDGER = "resource_id string, local_path string, format string, snapshot_date string"


def path(day, suffix="csv"):
    return f"lake/raw/X/Y/2024-01-{day:02d}/f.{suffix}"


def frames(spark, files):
    rows = [(p, "t", k, x, None) for p, lines in files for k, x in enumerate(lines)]
    return spark.createDataFrame(rows, RAW), spark.createDataFrame([("r", p, None, None) for p, _ in files], LEDGER)


def table(n=40, seed=3):
    rnd = random.Random(seed)
    return [(f"G-{k:04d}", rnd.choice("ABCD"), rnd.randrange(1000), f"{rnd.randrange(1900, 2020)}-0{rnd.randrange(1, 9)}-11", f"owner {rnd.randrange(99)}, Inc.") for k in range(n)]


def csv_lines(header, rows, sep=","):
    quote = lambda x: f'"{x}"' if sep in str(x) else str(x)
    return [sep.join(header)] + [sep.join(map(quote, r)) for r in rows]


def test_changes_between_formats(spark):
    rows = table()
    one = csv_lines(["id", "class", "depth", "seen", "owner"], rows)
    two = csv_lines(["OWNER", "Class", "ID", "depth_m", "visited"], [(r[4], r[1], r[0], f"{r[2]}.0", f"03/11/{r[3][:4]}") for r in rows], "\t")
    three = [json.dumps({"type": "Feature", "properties": {"owner": r[4], "id": r[0], "depth_m": r[2], "stage": r[1]}, "geometry": None}) for r in rows]
    raw, ledger = frames(spark, [(path(1), one), (path(2, "tsv"), two), (path(3, "geojson"), three)])
    got = {tuple(r) for r in drift.changes(raw, ledger).collect()}
    want = {
        (path(2, "tsv"), "depth", "depth_m", "renamed"), (path(2, "tsv"), "seen", "visited", "renamed"), (path(2, "tsv"), "seen", "visited", "retyped"),
        (path(2, "tsv"), "depth", "depth_m", "retyped"), (path(3, "geojson"), "class", "stage", "renamed"), (path(3, "geojson"), "visited", "", "removed"), (path(3, "geojson"), "depth_m", "depth_m", "retyped"),
    }
    assert got == {("t", *w) for w in want}


def test_unify_names_fields_as_the_last_file_does(spark):
    rows = table(20)
    one, two = csv_lines(["id", "class"], [r[:2] for r in rows]), csv_lines(["key", "class", "depth"], [r[:3] for r in rows])
    raw, ledger = frames(spark, [(path(1), one), (path(2), two)])
    got = {(r.local_path, r.row_no): r.fields for r in drift.unify(raw, ledger).collect()}
    assert got[(path(1), 1)] == {"key": rows[0][0], "class": rows[0][1]} and got[(path(2), 1)]["depth"] == str(rows[0][2]) and len(got) == 40


def test_unrelated_fields_are_not_renamed(spark):
    rnd = random.Random(1)
    a, b = csv_lines(["id", "lat"], [(f"k{i}", rnd.randrange(90)) for i in range(50)]), csv_lines(["id", "grade"], [(f"k{i}", rnd.randrange(90)) for i in range(50)])
    raw, ledger = frames(spark, [(path(1), a), (path(2), b)])
    assert {r.change_kind for r in drift.changes(raw, ledger).collect()} == {"added", "removed"}


def test_odd_input(spark):
    raw, ledger = frames(spark, [])
    assert drift.changes(raw, ledger).count() == 0 and drift.unify(raw, ledger).count() == 0
    files = [(path(1, "json"), ["[1]", "no json", None, '{"A": null, "b": [1]}']), (path(2), ["a,b,b", '"x ""y"", z",1', "", "1,2,3,4"])]
    raw, ledger = frames(spark, files)
    got = {tuple(r)[2:] for r in drift.changes(raw, ledger).collect()}
    assert ("a", "a", "retyped") in got and len(got) <= 2


def test_assignment_is_optimal():
    rnd = random.Random(5)
    for n, m in [(3, 3), (2, 4), (4, 2), (1, 1)]:
        s = [[rnd.random() for _ in range(m)] for _ in range(n)]
        best = max(sum(s[i][p[i]] for i in range(n)) for p in itertools.permutations(range(m), n)) if n <= m else max(sum(s[p[j]][j] for j in range(m)) for p in itertools.permutations(range(n), m))
        assert abs(sum(s[i][j] for i, j in drift.assign(s)) - best) < 1e-9
    assert drift.assign([]) == []


def test_unified_fields_have_one_type_and_spare_cells_stay(spark):
    one = ["id,depth,seen,note", "+1,2,2001-02-03,a", "2,3,,", "3,4,2001-02-04,b,more,"]
    two = ["id,depth,seen,note", "04,2.50,2001-02-03,7", "5,x"]
    raw, ledger = frames(spark, [(path(1), one), (path(2), [x.replace("x", "6.0") for x in two])])
    got = {(r.local_path[-12:-6], r.row_no): r.fields for r in drift.unify(raw, ledger).collect()}
    assert got == {(k, n): f for k, n, f in [
        (path(1)[-12:-6], 1, {"id": "1", "depth": "2.0", "seen": "2001-02-03", "note": "a"}), (path(1)[-12:-6], 2, {"id": "2", "depth": "3.0", "seen": None, "note": None}),
        (path(1)[-12:-6], 3, {"id": "3", "depth": "4.0", "seen": "2001-02-04", "note": "b", "spare_1": "more", "spare_2": None}),
        (path(2)[-12:-6], 1, {"id": "4", "depth": "2.5", "seen": "2001-02-03", "note": "7"}), (path(2)[-12:-6], 2, {"id": "5", "depth": "6.0", "seen": None, "note": None})]}


def test_a_large_table_beyond_the_broadcast_bound(spark, monkeypatch):
    from strata import util

    rows = table()
    raw, ledger = frames(spark, [(path(1), csv_lines(["id", "class"], [r[:2] for r in rows])), (path(2), csv_lines(["id", "stage"], [r[:2] for r in rows]))])
    want = {tuple(r) for r in drift.changes(raw, ledger).collect()}
    real = util.sized_join
    monkeypatch.setattr(drift, "sized_join", lambda *a, **k: real(*a, **{**k, "most": 0}))
    assert {tuple(r) for r in drift.changes(raw, ledger).collect()} == want == {("t", path(2), "class", "stage", "renamed")}
