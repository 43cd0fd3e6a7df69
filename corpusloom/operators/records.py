"""Deeply nested JSON records as flat child tables with parent links.

Two distributed passes:

1. ``infer_schema`` folds the structure of all records into one merged schema: a tree of
   object members and array levels and, where ``typed``, the types of all values.  Each task folds its records
   into one tree, one task for each field folds these, and the result reaches the driver, so what does is bounded by
   the schema, not by the rows.  Objects with more than ``map_width`` member names, over all records, are taken
   for maps: their members share one node ``*`` (paths of rows keep the names).
2. ``child_rows`` explodes each array level of that schema recursively.  Each element
   becomes a row of the child table of its array, with a surrogate key (its path in the
   record), the surrogate key of the nearest enclosing element and its ordinal.  Branches
   of the schema without arrays are never visited.  ``child_records`` adds the values: the members of
   each element through objects (not into arrays, which are tables of their own), and the record itself as the
   root table.  ``child_tables`` gives one flat table an array level with a typed column a member.

Defined results: null, empty, blank or invalid JSON gives no rows; null elements give no
rows but count in the ordinals; null members have no value; a JSON value that is neither object nor array is a root
row with the member ''; members of several types are text in the flat tables; records of any size are handled one at
a time; repeated rows are kept; an empty table gives an empty result; extra columns pass unread.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.jsonvalue import INVALID, parse
from corpusloom.operators.drift import BOOL, DEC, INT, type_of
from corpusloom.session import materialise

_SEP = "\x1f"
_ROWS = 20_000

CHILD_SCHEMA = "field string, table_path string, child_path string, parent_path string, ordinal int, is_container boolean"
_RECORD_SCHEMA = "field string, table_path string, child_path string, parent_path string, ordinal int, members array<struct<member:string,type:string,text:string>>"


def _add(node: dict, value: object, typed: bool, width: int) -> None:
    """Add the structure of ``value`` below ``node``; '[]' is an array level, '*' any member of a map, '=' holds types."""
    if isinstance(value, dict):
        for name, x in value.items():
            if x is not None and (typed or isinstance(x, (dict, list))):
                star = node.get("*")
                _add(node.setdefault("." + name, {}) if star is None else star, x, typed, width)
        _fold(node, width)
    elif isinstance(value, list):
        inner = node.setdefault("[]", {})
        for x in value:
            if x is not None and (typed or isinstance(x, (dict, list))):
                _add(inner, x, typed, width)
    elif typed:
        node.setdefault("=", {})[type_of(value)] = {}


def _fold(node: dict, width: int) -> None:
    if "*" in node or len(node) > width:
        names = [k for k in node if k[0] == "."]
        if names and ("*" in node or len(names) > width):
            star = node.setdefault("*", {})
            for k in names:
                _merge(star, node.pop(k))
            _fold_maps(star, width)


def _fold_maps(node: dict, width: int) -> None:
    _fold(node, width)
    for x in node.values():
        _fold_maps(x, width)


def _paths(node: dict, at: tuple, typed: bool) -> Iterator[tuple]:
    """The paths to array levels and, where ``typed``, to types."""
    for step, sub in node.items():
        here = (*at, step)
        if step == "=":
            yield from ((*here, t) for t in sub)
        else:
            if step == "[]":
                yield here
            yield from _paths(sub, here, typed)


def infer_schema(df: DataFrame, fields: list[str], map_width: int = 1000, typed: bool = False) -> dict[str, dict]:
    """The merged schema of each JSON column: ``{field: tree}``.

    A tree maps steps (``.name``, ``[]`` or ``*``) to subtrees.  It holds only branches with arrays or, where
    ``typed``, all, with the types of values below ``=``.
    """

    def build(rows: Iterator[tuple[str, str]]) -> dict[str, dict]:
        trees: dict[str, dict] = {}
        for f, path in rows:
            node = trees.setdefault(f, {})
            for step in path.split(_SEP):
                node = node.setdefault(step, {})
        for tree in trees.values():
            _fold_maps(tree, map_width)
        return trees

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, dict] = {f: {} for f in fields}
        for batch in batches:
            for f in fields:
                for text in batch.column(f).to_pylist():
                    if text and (typed or "[" in text or "\\u005" in text):
                        value = parse(text)
                        if value is not INVALID and value is not None and (typed or isinstance(value, (dict, list))):
                            _add(trees[f], value, typed, map_width)
        rows = [(f, _SEP.join(p)) for f in fields for p in _paths(trees[f], (), typed)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], ["field", "path"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = build(zip(pdf["field"], pdf["path"], strict=True))
        return pd.DataFrame([(f, _SEP.join(p)) for f, t in tree.items() for p in _paths(t, (), typed)], columns=["field", "path"])

    found = df.select(*fields).mapInArrow(scan, "field string, path string").distinct()
    rows = found.groupBy("field").applyInPandas(merge, "field string, path string").collect()
    return {f: {} for f in fields} | build(sorted((r.field, r.path) for r in rows))


def _merge(into: dict, other: dict) -> None:
    for k, x in other.items():
        _merge(into.setdefault(k, {}), x)


def _explode(value: object, tree: dict, table: str, path: str, parent: str, out: list) -> None:
    if isinstance(value, list):
        element = tree.get("[]")
        if element is None:
            return
        table += "[*]"
        for i, x in enumerate(value):
            if x is None:
                continue
            key = f"{path}[{i}]"
            inner = isinstance(x, (dict, list))
            out.append((table, key, parent, i, inner))
            if inner and element:
                _explode(x, element, table, key, key, out)
    elif isinstance(value, dict):
        rest = tree.get("*")
        if rest is not None:
            for name, x in value.items():
                if isinstance(x, (dict, list)):
                    _explode(x, rest, f"{table}.*", f"{path}.{name}", parent, out)
            return
        for step, sub in tree.items():
            if step != "[]":
                x = value.get(step[1:])
                if isinstance(x, (dict, list)):
                    _explode(x, sub, table + step, path + step, parent, out)


def child_rows(df: DataFrame, key: str, fields: list[str], schema: dict[str, dict] | None = None) -> DataFrame:
    """One row for each non-null array element at any depth of the JSON columns ``fields``.

    Result: ``key`` and ``CHILD_SCHEMA``; ``table_path`` names the child table (indices
    replaced by ``*``), ``child_path`` is the surrogate key within the record,
    ``parent_path`` that of the nearest enclosing element or ``$``.
    """
    trees = infer_schema(df, fields) if schema is None else schema
    key_type = next(f for f in df.schema.fields if f.name == key).dataType.simpleString()

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key)
            index: list[int] = []
            field: list[str] = []
            rows: list[tuple] = []

            def flush(keys=keys, index=index, field=field, rows=rows) -> pa.RecordBatch:
                t, c, p, o, k = zip(*rows, strict=True)
                out = pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(index, pa.int64())), pa.array(field, pa.string()), pa.array(t, pa.string()), pa.array(c, pa.string()), pa.array(p, pa.string()), pa.array(o, pa.int32()), pa.array(k, pa.bool_())],
                    [key, "field", "table_path", "child_path", "parent_path", "ordinal", "is_container"],
                )
                index.clear()
                field.clear()
                rows.clear()
                return out

            for f in fields:
                tree = trees[f]
                if not tree:
                    continue
                for i, text in enumerate(batch.column(f).to_pylist()):
                    if not text or ("[" not in text and "\\u005" not in text):
                        continue
                    value = parse(text)
                    if value is INVALID:
                        continue
                    before = len(rows)
                    _explode(value, tree, "$", "$", "$", rows)
                    n = len(rows) - before
                    if n:
                        index.extend([i] * n)
                        field.extend([f] * n)
                        if len(rows) >= _ROWS:
                            yield flush()
            if rows:
                yield flush()

    return df.select(key, *fields).mapInArrow(explode, f"`{key}` {key_type}, {CHILD_SCHEMA}")


def _values(value: object, at: str, out: list) -> None:
    """(member, type, text) of all scalars of ``value`` through objects, not into arrays."""
    if isinstance(value, dict):
        for name, x in value.items():
            _values(x, f"{at}.{name}" if at else name, out)
    elif value is not None and not isinstance(value, list):
        out.append({"member": at, "type": type_of(value), "text": value if isinstance(value, str) else json.dumps(value)})


def _records(value: object, table: str, path: str, parent: str | None, ordinal: int | None, out: list) -> None:
    """The row of an element (or of the whole record) and of all elements below it."""
    own: list = []
    _values(value, "", own)
    out.append((table, path, parent, ordinal, own))
    _below(value, table, path, path, out)


def _below(value: object, table: str, path: str, element: str, out: list) -> None:
    if isinstance(value, dict):
        for name, x in value.items():
            if isinstance(x, (dict, list)):
                _below(x, f"{table}.{name}", f"{path}.{name}", element, out)
    elif isinstance(value, list):
        for i, x in enumerate(value):
            if x is not None:
                _records(x, table + "[*]", f"{path}[{i}]", element, i, out)


def child_records(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The root row of each valid record and one row for each non-null array element, with their members.

    Result: ``key``, field, table_path, child_path (``$`` for the root), parent_path (null for the root), ordinal and
    ``members``, an array of (member, type, text), text being that of JSON (of strings the string itself).
    """
    key_type = next(f for f in df.schema.fields if f.name == key).dataType.simpleString()
    members = pa.list_(pa.struct([("member", pa.string()), ("type", pa.string()), ("text", pa.string())]))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key)
            index: list[int] = []
            rows: list[tuple] = []

            def flush(keys=keys, index=index, rows=rows) -> pa.RecordBatch:
                columns = list(zip(*rows, strict=True))
                types = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), members)
                out = pa.RecordBatch.from_arrays([keys.take(pa.array(index, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], [key, "field", "table_path", "child_path", "parent_path", "ordinal", "members"])
                index.clear()
                rows.clear()
                return out

            for f in fields:
                for i, text in enumerate(batch.column(f).to_pylist()):
                    value = parse(text) if text else INVALID
                    if value is INVALID or value is None:
                        continue
                    found: list = []
                    _records(value, "$", "$", None, None, found)
                    rows.extend((f, *r) for r in found)
                    index.extend([i] * len(found))
                    if len(rows) >= _ROWS:
                        yield flush()
            if rows:
                yield flush()

    return df.select(key, *fields).mapInArrow(explode, f"`{key}` {key_type}, {_RECORD_SCHEMA}")


def child_members(records: DataFrame, key: str) -> DataFrame:
    """(key, field, child_path, member, type, number, text): one row for each value of ``child_records``."""
    each = records.select(key, "field", "child_path", F.explode("members").alias("m"))
    numeric = F.col("m.type").isin(INT, DEC)
    return each.select(key, "field", "child_path", "m.member", "m.type", F.when(numeric, F.col("m.text").try_cast("double")).alias("number"), F.when(~numeric, F.col("m.text")).alias("text"))


def _columns(node: dict, at: str) -> Iterator[tuple[str, str]]:
    """(member, SQL type) of the scalars below a node, through objects; members of maps have no column of their own."""
    for step, sub in sorted(node.items()):
        if step == "=":
            t = set(sub)
            yield at, "bigint" if t == {INT} else "double" if t <= {INT, DEC} else "boolean" if t == {BOOL} else "string"
        elif step[0] == ".":
            yield from _columns(sub, f"{at}.{step[1:]}" if at else step[1:])


def child_tables(df: DataFrame, key: str, field: str, map_width: int = 1000) -> dict[str, DataFrame]:
    """One flat table for the records of ``field`` (``$``) and for each of its array levels, linked by (key, parent_path).

    Columns: ``key``, child_path, parent_path, ordinal, one typed column a member (dots as ``__``; ``value`` for elements
    that are values themselves; names that clash, ignoring case, get a suffix) and, where objects are taken for maps,
    ``others``, a map of their members.
    """
    schema = infer_schema(df, [field], map_width, typed=True)[field]
    rows = materialise(child_records(df, key, [field]))
    tables: dict[str, DataFrame] = {}

    def put(node: dict, name: str) -> None:
        # Tables below maps are read by pattern, as their paths hold the names.
        like = "^" + re.escape(name).replace(r"\.\*", r"\.[^.\[]*") + "$"
        own = rows.filter(F.col("table_path").rlike(like) if ".*" in name else F.col("table_path") == name)
        own = own.withColumn("_m", F.map_from_entries(F.transform("members", lambda m: F.struct(m["member"], m["text"]))))
        taken = {key.lower(), "child_path", "parent_path", "ordinal", "others"}
        out, known = [], []
        for member, kind in _columns(node, ""):
            base = label = member.replace(".", "__") or "value"
            n = 1
            while label.lower() in taken:
                n += 1
                label = f"{base}_{n}"
            taken.add(label.lower())
            known.append(member)
            out.append(F.try_element_at("_m", F.lit(member)).try_cast(kind).alias(label))
        if _has_map(node):
            out.append(F.map_filter("_m", lambda k, _: ~k.isin(known) if known else F.lit(True)).alias("others"))
        tables[name] = own.select(key, "child_path", "parent_path", "ordinal", *out)

    def walk(node: dict, at: str) -> None:
        for step, sub in node.items():
            here = at + ("[*]" if step == "[]" else ".*" if step == "*" else step)
            if step == "[]":
                put(sub, here)
            if step != "=":
                walk(sub, here)

    put(schema, "$")
    walk(schema, "$")
    return tables


def _has_map(node: dict) -> bool:
    return "*" in node or any(_has_map(x) for k, x in node.items() if k[0] == ".")
