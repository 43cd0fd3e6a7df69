import json
import random

from corpusloom.operators import records

S = "row_id long, raw string, field string, child_path string"


def brute(rows):
    out = []

    def walk(key, v, path, parent):
        if isinstance(v, dict):
            for k, x in v.items():
                walk(key, x, f"{path}.{k}", parent)
        elif isinstance(v, list):
            for i, x in enumerate(v):
                if x is not None:
                    at = f"{path}[{i}]"
                    out.append((key, at, parent, i))
                    walk(key, x, at, at)

    for key, text in rows:
        try:
            v = json.loads(text, parse_constant=lambda c: 1 / 0)
            while isinstance(v, str):
                v = json.loads(v)
        except (TypeError, ValueError, ZeroDivisionError):
            continue
        walk(key, v, "$", "$")
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(k, t, "clash", "clash") for k, t in rows], S)
    got = records.child_rows(df, "row_id", ["raw"], **kw)
    return sorted((r.row_id, r.child_path, r.parent_path, r.ordinal) for r in got.collect())


EDGE = [None, "", "  ", "[1] x", "[NaN]", '{"a":', "[1,null,2]", '"[3]"', json.dumps(json.dumps([[4], {"x": [5]}])), '{"a":[{"b":[1,{"c":[null]}]},[],{}]}', "7", '"text"', '{"a":[1]}', '{"a":[1]}', '{"a":{"a":[[[1]]]}}', '{"z":"[1]"}', '{"a":"s"}', '{"a":[0.5,true]}']


def test_edge_cases(spark):
    rows = list(enumerate(EDGE)) + [(12, '{"a":[1]}')]
    assert run(spark, rows) == brute(rows)


def test_empty_and_long(spark):
    assert run(spark, []) == []
    rows = [(1, json.dumps({"a": [{"b": list(range(30_000))}]}))]
    assert len(run(spark, rows)) == 30_001


def test_random_trees(spark):
    rng = random.Random(5)

    def tree(d):
        k = rng.random()
        if d == 0 or k < 0.2:
            return rng.choice([None, 1, 2.5, "x", True, "[1]", "a.b"])
        if k < 0.6:
            return [tree(d - 1) for _ in range(rng.randrange(4))]
        return {rng.choice("abcdef"): tree(d - 1) for _ in range(rng.randrange(4))}

    rows = [(i, json.dumps(tree(5))) for i in range(300)]
    assert run(spark, rows) == brute(rows)


def test_maps_share_a_node(spark):
    rows = [(i, json.dumps({"by_id": {f"k{i}_{j}": [j] for j in range(5)}})) for i in range(10)]
    df = spark.createDataFrame([(k, t) for k, t in rows], "row_id long, raw string")
    schema = records.infer_schema(df, ["raw"], map_width=20)
    assert schema == {"raw": {".by_id": {"*": {"[]": {}}}}}
    got = records.child_rows(df, "row_id", ["raw"], schema)
    assert sorted((r.row_id, r.child_path, r.parent_path, r.ordinal) for r in got.collect()) == brute(rows)


def test_child_tables(spark):
    df = spark.createDataFrame([(1, '{"a":[{"b":[1,2]},{"b":[]}]}')], "row_id long, raw string")
    t = records.child_tables(df, "row_id", "raw")
    assert set(t) == {"$", "$.a[*]", "$.a[*].b[*]"}
    parents = {r.child_path for r in t["$.a[*]"].collect()}
    assert {r.parent_path for r in t["$.a[*].b[*]"].collect()} <= parents


def test_flat_tables_hold_the_values(spark):
    rows = [(1, '{"a": 1, "u": {"name": "x", "b": [{"k": 1, "v": "hello", "c": [true, null, "t"]}, {"k": 2.5, "w": {"z": false}}]}, "child_path": "own"}'), (2, '{"a": "text", "u": {"b": []}}'), (3, "[7, 8]"), (4, "{broken"), (5, None), (6, "null")]
    df = spark.createDataFrame(rows, "row_id long, j string")
    t = records.child_tables(df, "row_id", "j")
    assert sorted(t) == ["$", "$.u.b[*]", "$.u.b[*].c[*]", "$[*]"]
    root = {r.row_id: r for r in t["$"].collect()}
    assert sorted(root) == [1, 2, 3] and (root[1].a, root[1].u__name, root[1].child_path_2) == ("1", "x", "own") and root[2].a == "text"
    b = {r.child_path: r for r in t["$.u.b[*]"].collect()}
    assert [(r.k, r.v, r.w__z, r.parent_path, r.ordinal) for _, r in sorted(b.items())] == [(1.0, "hello", None, "$", 0), (2.5, None, False, "$", 1)]
    assert [(r.child_path, r.parent_path, r.ordinal, r.value) for r in t["$.u.b[*].c[*]"].collect()] == [("$.u.b[0].c[0]", "$.u.b[0]", 0, "true"), ("$.u.b[0].c[2]", "$.u.b[0]", 2, "t")]
    assert sorted(r.value for r in t["$[*]"].collect()) == [7, 8]


def test_maps_are_folded_before_they_reach_the_driver(spark):
    rows = [(i, '{"by_id": {"k%d": {"n": %d, "tags": ["t"]}}, "x": 1}' % (i, i)) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, j string").repartition(4)
    tree = records.infer_schema(df, ["j"], map_width=10, typed=True)["j"]
    assert list(tree[".by_id"]) == ["*"] and tree[".x"] == {"=": {"integer": {}}}
    t = records.child_tables(df, "row_id", "j", map_width=10)
    assert sorted(t) == ["$", "$.by_id.*.tags[*]"] and t["$.by_id.*.tags[*]"].count() == 60
    assert {r.row_id: dict(r.others) for r in t["$"].collect()} == {i: {f"by_id.k{i}.n": str(i)} for i in range(60)}
