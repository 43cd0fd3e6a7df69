import json

from corpusloom.operators import drift

S = "feed string, file_no int, id string, raw_json string, metrics_json string, path string, field string"


def frame(spark, rows):
    return spark.createDataFrame([(f, n, i, json.dumps(a) if isinstance(a, (dict, list)) else a, json.dumps(b) if isinstance(b, (dict, list)) else b, "clash", "clash") for f, n, i, a, b in rows], S)


ROWS = [
    ("f", 0, "p1", {"text": "x", "n": 1, "user": {"name": "u"}, "old": [1], "empty": [], "nil": None, "same": 5}, {"likes": 3}),
    ("f", 0, "p2", {"text": "y", "n": 2, "same": 5}, None),
    ("f", 0, "p2", {"text": "y", "n": 2, "same": 5}, None),
    ("f", 1, "p1", {"body": "x", "n": "1", "user": {"name": "u", "age": 2.5}, "same": 6}, json.dumps(json.dumps({"loves": 3}))),
    ("f", 1, "p2", {"body": "y", "same": 5}, "{broken"),
    ("f", 1, "p9", {"body": "new"}, ""),
    ("f", 3, "p1", {"other": 1}, None),
    ("g", 1, "p1", {"other": 1}, None),
]


def test_changes(spark):
    got = sorted((r.feed, r.file_no, r.field, r.old_path, r.new_path, r.change) for r in drift.changes(frame(spark, ROWS), ["raw_json", "metrics_json"]).collect())
    assert got == sorted([
        ("f", 1, "raw_json", "text", "body", "renamed"), ("f", 1, "raw_json", "n", "n", "retyped"), ("f", 1, "raw_json", "old", "", "removed"),
        ("f", 1, "raw_json", "", "user.age", "added"), ("f", 1, "metrics_json", "likes", "loves", "renamed"),
    ])


def test_no_rename_without_proof(spark):
    base = [("f", 0, "p1", {"a": 1, "b": 2}, None), ("f", 0, "p2", {"a": 1}, None)]
    differs = [*base, ("f", 1, "p1", {"c": 1, "b": 2}, None), ("f", 1, "p2", {"c": 9}, None)]
    other_posts = [*base, ("f", 1, "p3", {"c": 1}, None)]
    for rows in (differs, other_posts):
        got = {(r.old_path, r.new_path, r.change) for r in drift.changes(frame(spark, rows), ["raw_json"]).collect()}
        assert ("a", "", "removed") in got and ("", "c", "added") in got and not any(c == "renamed" for *_, c in got)


def test_every_proved_pair_is_a_rename(spark):
    rows = [("f", 0, "p1", {"a": 1, "b": 1}, None), ("f", 1, "p1", {"x": 1, "y": 1}, None)]
    got = sorted((r.old_path, r.new_path, r.change) for r in drift.changes(frame(spark, rows), ["raw_json"]).collect())
    assert got == [(o, n, "renamed") for o in "ab" for n in "xy"]


def test_types_and_union(spark):
    rows = [("f", 0, "a", {"x": 1, "y": [1], "z": True, "X": "s"}, None), ("f", 1, "a", {"x": 1.5, "y": ["s"], "z": "no"}, None), ("g", 0, "b", {"x": 3, "y": [{"k": 1}], "w": ["t"], "id": 12345678901234567890123}, None)]
    df = frame(spark, rows)
    u = drift.union_schema(drift.file_members(df, ["raw_json"]))
    types = {r.path: r.type for r in u.collect()}
    assert types == {"x": drift.DEC, "y": drift.A_OTHER, "z": drift.STR, "X": drift.STR, "w": drift.A_STR, "id": drift.BIG}
    t = drift.unified(df, "raw_json", u, ["feed", "id"]).orderBy("feed", "id").collect()
    # "X" and "x" clash in SQL, and "id" with a kept column: both members stay, under another name.
    assert sorted(r.x_2 for r in t) == [1.0, 1.5, 3.0] and t[0].X == "s"
    assert [r.id_2 for r in t] == [None, None, "12345678901234567890123"] and t[0].y == ["1"] and [r.z for r in t] == ["true", "no", None]


def test_empty(spark):
    df = frame(spark, [])
    assert drift.changes(df, ["raw_json"]).count() == 0
    assert drift.union_schema(drift.file_members(df, ["raw_json"])).count() == 0


def test_integers_beyond_64_bits_are_kept(spark):
    big = 10**20
    rows = [(1, "f", 0, "x", '{"a": %d, "b": 1, "c": [1, %d], "d": %d}' % (big, -big, big)), (2, "f", 1, "x", '{"a": 5, "b": 2, "c": [3], "d": 0.5}')]
    df = spark.createDataFrame(rows, "row_id int, feed string, file_no int, id string, j string")
    schema = drift.union_schema(drift.file_members(df, ["j"]))
    assert {r.path: r.type for r in schema.collect()} == {"a": "big integer", "b": "integer", "c": "array of big integers", "d": "string"}
    got = {r.row_id: r for r in drift.unified(df, "j", schema, ["row_id"]).collect()}
    assert got[1].a == str(big) and got[2].a == "5" and got[1].c == ["1", str(-big)] and got[1].d == str(big) and got[2].d == "0.5" and got[2].b == 2
    long = {(r.row_id, r.path): (r.type, r.number, r.text, r.n) for r in drift.unified_rows(df, ["j"], schema, "row_id").collect()}
    assert long == {(r.row_id, r.path): (r.type, r.number, r.text, r.n) for r in drift.unified_rows(df, ["j"], schema, "row_id", small=0).collect()}
    assert long[1, "a"] == ("big integer", None, str(big), None) and long[2, "b"] == ("integer", 2.0, None, None) and long[1, "c"][3] == 2
    # Among the changes both are integers.
    assert [(r.old_path, r.change) for r in drift.changes(df, ["j"]).collect()] == [("d", "retyped")]


def test_more_candidates_than_fit_a_broadcast(spark):
    rows = [("f", 0, f"p{i}", '{"a": %d, "k": {"x": %d}}' % (i, i + 1)) for i in range(20)] + [("f", 1, f"p{i}", '{"b": %d, "k": {"y": %d}}' % (i, i + 1)) for i in range(20)]
    df = spark.createDataFrame(rows, "feed string, file_no int, id string, j string")
    for small in (0, 1000):
        got = {(r.old_path, r.new_path, r.change) for r in drift.changes(df, ["j"], small=small).collect()}
        assert got == {("a", "b", "renamed"), ("k.x", "k.y", "renamed")}
