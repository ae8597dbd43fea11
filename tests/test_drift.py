import json
from datetime import datetime, timedelta, timezone

import brute_drift
import duckdb
import pytest

from tidewatch.operators import drift

T0 = datetime(2026, 9, 1, tzinfo=timezone.utc)
SCHEMA = "file_id long, line_no int, source string, collector_host string, collected_at timestamp, schema_version int, payload string, value string, tag string"


def lines(spark, files):
    """files: lists of payloads, one list per file, in order; the columns value and tag clash with the operator's own."""
    rows = []
    for f, payloads in enumerate(files):
        for n, p in enumerate(payloads):
            rows.append((f + 1, n, "urlhaus", "h", T0 + timedelta(hours=f), None, p if p is None or isinstance(p, str) else json.dumps(p), "x", "y"))
    return spark.createDataFrame(rows, SCHEMA)


def found(spark, files):
    return {tuple(r) for r in drift.changes(lines(spark, files)).collect()}


def test_added_removed_renamed_retyped(spark):
    a = [{"urlhaus_id": str(i), "size": i, "old": f"v{i}", "gone": 1} for i in range(5)]
    b = [{"urlhaus_id": str(i), "size": str(i), "new": f"v{i}", "fresh": "w"} for i in range(5)]
    assert found(spark, [a, b]) == {(2, "retyped", "size", "size"), (2, "renamed", "old", "new"), (2, "removed", "gone", ""), (2, "added", "", "fresh")}


def test_unreadable_null_and_empty_files(spark):
    a = [{"urlhaus_id": "1", "x": 1}, None, "{broken", "[1]", ""]
    nothing = ["{broken", None]
    assert found(spark, [a, nothing, a]) == set()
    assert found(spark, [[]]) == set()


def test_majority_and_types_of_fields_without_values(spark):
    half = [{"urlhaus_id": "1", "x": 1}, {"urlhaus_id": "2"}]  # x in half of the lines: it doesn't belong
    full = [{"urlhaus_id": "1", "x": 1}, {"urlhaus_id": "2", "x": None}]
    nulls = [{"urlhaus_id": "1", "x": None}, {"urlhaus_id": "2", "x": None}]
    text = [{"urlhaus_id": "1", "x": "a"}, {"urlhaus_id": "2", "x": "b"}]
    assert found(spark, [half, full, nulls, text]) == {(2, "added", "", "x"), (4, "retyped", "x", "x")}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_against_plain_loops(spark, data, sf):
    path = f"{data.rsplit('/', 1)[0]}/{sf}/landed_lines.parquet"
    want = brute_drift.changes(duckdb.sql(f"SELECT file_id, source, collector_host, collected_at, payload FROM read_parquet('{path}')").fetchall())
    got = [tuple(r) for r in drift.changes(spark.read.parquet(path)).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_consistent_table(spark):
    a = [{"urlhaus_id": str(i), "n": i, "old": f"v{i}"} for i in range(4)]
    b = [{"urlhaus_id": str(i), "n": str(i), "new": f"v{i}"} for i in range(3)]
    df = lines(spark, [a, b])
    t = drift.consistent(df)
    rows = {(r["file_id"], r["line_no"], r["original"]): r for r in t.collect()}
    assert len(rows) == 4 * 3 + 3 * 3
    assert rows[1, 0, "old"]["field"] == rows[2, 0, "new"]["field"] == "new"
    assert rows[2, 1, "n"]["as_string"] == "1" and rows[2, 1, "n"]["as_number"] is None and float(rows[2, 1, "n"]["canonical"]) == 1.0
    assert rows[1, 1, "n"]["as_number"] == 1.0 and rows[1, 1, "n"]["tag"] == "number"
    alt = {(r["path"], r["tag"]): r["first_file"] for r in drift.alternatives(df).collect()}
    assert alt["n", "number"] == 1 and alt["n", "string"] == 2


def test_alternatives_of_nested_paths(spark):
    """Every path keeps all of its types, inside objects and arrays too."""
    df = lines(spark, [[{"a": {"b": 1, "c": [1, "x", None, {"d": True}]}}, {}], [{"a": {"b": "1"}, "e": []}]])
    got = {(r["path"], r["tag"]): (r["n_values"], r["first_file"]) for r in drift.alternatives(df).collect()}
    assert got == {("a", "object"): (2, 1), ("a.b", "number"): (1, 1), ("a.b", "string"): (1, 2), ("a.c", "array"): (1, 1), ("a.c[]", "number"): (1, 1), ("a.c[]", "string"): (1, 1), ("a.c[]", "object"): (1, 1), ("a.c[].d", "boolean"): (1, 1), ("e", "array"): (1, 2)}
    assert drift.alternatives(df.limit(0)).count() == 0


def test_changes_come_from_the_fused_schema(spark):
    df = lines(spark, [[{"urlhaus_id": "1", "x": 1}, {}], [{"urlhaus_id": "1", "y": 1}, {"urlhaus_id": "2", "y": 1}]])
    schema = drift.fused(df)
    files, fields = drift.file_schemas(schema)
    assert {(r["file_id"], r["n_lines"]) for r in files.collect()} == {(1, 2), (2, 2)}  # the empty object is a line
    assert {(r["file_id"], r["field"]) for r in fields.collect()} == {(2, "urlhaus_id"), (2, "y")}
    _, fewer = drift.file_schemas(schema.where("path <> 'y' or path is null"))
    assert {(r["file_id"], r["field"]) for r in fewer.collect()} == {(2, "urlhaus_id")}


def test_many_renames_share_one_name(spark):
    """Names are linked through any number of files, without a bound on the links."""
    files = [[{"urlhaus_id": str(i), f"n{9 - f}": f"v{i}"} for i in range(4)] for f in range(6)]
    names = {(r["original"], r["name"]) for r in drift.canonical_names(lines(spark, files), drift.changes(lines(spark, files))).collect()}
    assert names == {(f"n{9 - f}", "n4") for f in range(6)}
