"""Schemas that drift between files: one union table and a log of every change.

1. ``file_members`` reads the members of every file in parallel (each task folds its records
   into sets of (file, path, type) first, so the shuffle carries schemas, not records).
2. ``promote`` folds types through a lattice: integer < big integer < string, integer < decimal number < string, and
   the array types below string; ``union_schema`` gives the one schema of all files.  Integers beyond 64 bits are
   big ones and kept by their digits.
3. ``unified`` casts every record to that schema, member by member, one column a member; ``unified_rows`` gives one row a
   member, for any number of members.
4. ``changes`` compares each file with the one before it and logs added, removed, retyped and
   renamed members in order.  Renames are proved on the posts that both files deliver: the files concerned are
   read a second time, and only hashes of the values of members that vanished or appeared are shuffled, by post.

Defined results: null, blank and invalid JSON and JSON that is no object hold no members;
null values and empty arrays don't count; a file without a predecessor (``file_no`` - 1 of the
same feed) gives no changes; several types of a member in a file are promoted; repeated rows
change nothing; an empty table gives empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.jsonvalue import parse
from corpusloom.session import materialise

INT, DEC, BOOL, STR, A_STR, A_INT, A_OBJ, A_OTHER = "integer", "decimal number", "boolean", "string", "array of strings", "array of integers", "array of objects", "array"
#: Integers that 64 bits can't hold; among the changes they are integers like others.
BIG, A_BIG = "big integer", "array of big integers"
_DDL = {BIG: "string", A_BIG: "array<string>", INT: "bigint", DEC: "double", BOOL: "boolean", STR: "string", A_STR: "array<string>", A_INT: "array<bigint>", A_OBJ: "array<string>", A_OTHER: "array<string>"}


def type_of(value: object) -> str:
    if isinstance(value, bool):
        return BOOL
    if isinstance(value, int):
        return INT if -(2**63) <= value < 2**63 else BIG
    if isinstance(value, float):
        return DEC
    if isinstance(value, str):
        return STR
    kinds = {type_of(x) if not isinstance(x, dict) else A_OBJ for x in value if x is not None}
    if kinds <= {INT, BIG} and BIG in kinds:
        return A_BIG
    return {(STR,): A_STR, (INT,): A_INT, (A_OBJ,): A_OBJ}.get(tuple(kinds), A_OTHER)


def members(value: object, at: str = "") -> Iterator[tuple[str, object]]:
    """(dotted path, value) of each member through objects, not into arrays."""
    for name, x in value.items() if isinstance(value, dict) else ():
        path = f"{at}.{name}" if at else name
        if isinstance(x, dict):
            yield from members(x, path)
        elif x is not None and x != []:
            yield path, x


def promote(types: Column) -> Column:
    """The least type above a set of types (an array column)."""
    only = lambda *names: F.size(F.array_except(types, F.array(*map(F.lit, names)))) == 0
    one = F.when(F.size(types) == 1, types[0])
    return F.coalesce(one, F.when(only(INT, DEC), F.lit(DEC)).when(only(INT, BIG), F.lit(BIG)).when(only(A_INT, A_BIG), F.lit(A_BIG)).when(only(A_STR, A_INT, A_BIG, A_OBJ, A_OTHER), F.lit(A_OTHER)).otherwise(F.lit(STR)))


def file_members(df: DataFrame, fields: list[str], feed: str = "feed", file_no: str = "file_no") -> DataFrame:
    """(feed, file_no, field, path, type): the members of each file, types promoted."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            feeds, files = batch.column(feed).to_pylist(), batch.column(file_no).to_pylist()
            found = set()
            for f in fields:
                for a, b, text in zip(feeds, files, batch.column(f).to_pylist(), strict=True):
                    if text:
                        for path, x in members(parse(text)):
                            found.add((a, b, f, path, type_of(x)))
            if found:
                cols = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.string()) for c in cols[2:])], ["feed", "file_no", "field", "path", "type"])

    read = df.select(F.col(feed).cast("string").alias(feed), F.col(file_no).cast("int").alias(file_no), *fields)
    # A set per batch, merged by a partial and a final aggregation.
    rows = read.mapInArrow(scan, "feed string, file_no int, field string, path string, type string")
    types = rows.groupBy("feed", "file_no", "field", "path").agg(F.sort_array(F.collect_set("type")).alias("types"))
    return types.select("feed", "file_no", "field", "path", promote(F.col("types")).alias("type"))


def union_schema(file_schemas: DataFrame) -> DataFrame:
    """(field, path, type, files): every member of any file under its promoted type."""
    g = file_schemas.groupBy("field", "path").agg(F.sort_array(F.collect_set("type")).alias("types"), F.count(F.lit(1)).alias("files"))
    return g.select("field", "path", promote(F.col("types")).alias("type"), "files")


def unified(df: DataFrame, field: str, schema: DataFrame, keep: list[str], limit: int = 5000) -> DataFrame:
    """All files in one table: ``keep`` plus one column per member of the union schema.

    The schema (not the data) is collected; a table of more than ``limit`` columns raises an error, and
    ``unified_rows`` holds any number of members.  A
    member name that clashes with a kept column or, ignoring case, with another member gets a suffix.
    """
    rows = schema.filter(F.col("field") == field).orderBy("path").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{field} has more than {limit} members")
    taken = {k.lower() for k in keep}
    names = []
    for r in rows:
        name, k = r.path.replace(".", "__"), 1
        while name.lower() in taken:
            k += 1
            name = f"{r.path.replace('.', '__')}_{k}"
        taken.add(name.lower())
        names.append((r.path, name, r.type))

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        at = {p: (i, t) for i, (p, _, t) in enumerate(names)}
        arrow = {"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<bigint>": pa.list_(pa.int64())}
        as_text = lambda x: x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)

        def to(x: object, t: str) -> object:
            if t in (INT, BOOL):
                return x
            if t == DEC:
                return float(x)
            if t in (STR, BIG):
                return as_text(x)
            return x if t == A_INT else [None if y is None else as_text(y) for y in (x if isinstance(x, list) else [x])]

        for batch in batches:
            n = batch.num_rows
            cols: list[list] = [[None] * n for _ in names]
            for k, text in enumerate(batch.column(field).to_pylist()):
                if text:
                    for path, x in members(parse(text)):
                        i, t = at[path]
                        cols[i][k] = to(x, t)
            own = [batch.column(k) for k in keep]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, arrow[_DDL[t]]) for c, (_, _, t) in zip(cols, names, strict=True))], [*keep, *(n for _, n, _ in names)])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields]
    out = ", ".join([*kept, *(f"`{n}` {_DDL[t]}" for _, n, t in names)])
    return df.select(*keep, *([field] if field not in keep else [])).mapInArrow(cast, out)


def unified_rows(df: DataFrame, fields: list[str], schema: DataFrame, key: str, small: int = 100_000) -> DataFrame:
    """(key, field, path, type, number, text, n): one row for each member of each record, under the union schema's
    type: ``number`` for integers and decimal numbers, ``text`` for strings, booleans and big integers, arrays as JSON
    with their number of elements ``n``.  ``small``: members up to which the schema is broadcast."""
    import json

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_text = lambda x: x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)
        for whole in batches:
            for first in range(0, whole.num_rows, 5000):
                batch, rows = whole.slice(first, 5000), []
                for f in fields:
                    for k, text in enumerate(batch.column(f).to_pylist()):
                        if text:
                            for path, x in members(parse(text)):
                                number = isinstance(x, float) or (isinstance(x, int) and not isinstance(x, bool) and abs(x) < 2**63)
                                rows.append((k, f, path, float(x) if number else None, as_text(x), len(x) if isinstance(x, list) else None))
                if rows:
                    k, f, path, number, text, n = zip(*rows, strict=True)
                    own = batch.column(key).take(pa.array(k, pa.int64()))
                    yield pa.RecordBatch.from_arrays([own, pa.array(f, pa.string()), pa.array(path, pa.string()), pa.array(number, pa.float64()), pa.array(text, pa.string()), pa.array(n, pa.int32())], [key, "field", "path", "number", "text", "n"])

    kept = f"`{key}` {df.schema[key].dataType.simpleString()}"
    rows = df.select(key, *fields).mapInArrow(scan, f"{kept}, field string, path string, number double, text string, n int")
    types = materialise(schema.select("field", "path", "type"))
    # The schema goes to the rows while it is small, else both are shuffled by member.
    typed = rows.join(F.broadcast(types) if types.count() <= small else types, ["field", "path"])
    numeric = F.col("type").isin(INT, DEC)
    return typed.select(key, "field", "path", "type", F.when(numeric, F.col("number")).alias("number"), F.when(~numeric, F.col("text")).alias("text"), "n")


def _diff(file_schemas: DataFrame, files: DataFrame) -> DataFrame:
    """(feed, file_no, field, path, old_type, new_type) for members that differ from the file before."""
    kind = F.when(F.col("type") == BIG, INT).when(F.col("type") == A_BIG, A_INT).otherwise(F.col("type"))
    s = file_schemas.select("feed", "file_no", "field", "path", kind.alias("type"))
    new = s.select("feed", "file_no", "field", "path", F.col("type").alias("new_type"), F.lit(None).cast("string").alias("old_type"))
    old = s.select("feed", (F.col("file_no") + 1).alias("file_no"), "field", "path", F.lit(None).cast("string").alias("new_type"), F.col("type").alias("old_type"))
    both = new.unionByName(old).groupBy("feed", "file_no", "field", "path").agg(F.max("old_type").alias("old_type"), F.max("new_type").alias("new_type"))
    follows = files.unionByName(files.withColumn("file_no", F.col("file_no") + 1)).groupBy("feed", "file_no").agg(F.count(F.lit(1)).alias("k")).filter("k = 2")
    return both.filter(~F.col("old_type").eqNullSafe(F.col("new_type"))).join(follows, ["feed", "file_no"], "left_semi")


def _proved(df: DataFrame, fields: list[str], candidates: DataFrame, feed: str, file_no: str, key: str, small: int) -> DataFrame:
    """The ``candidates`` (feed, at, field, old_path, new_path) whose values agree in all rows that both files deliver
    with values there, at least one."""
    side = lambda path, x: candidates.select("feed", "at", "field", F.col(path).alias("path"), F.lit(x).alias("side"))
    wanted = side("old_path", 0).unionByName(side("new_path", 1)).distinct()
    # What each file is read for: (at, side, field, path) of the members concerned; side 0 is the file before.
    per_file = wanted.withColumn("file_no", F.col("at") - 1 + F.col("side")).groupBy("feed", "file_no").agg(F.collect_list(F.struct("at", "side", "field", "path")).alias("wanted"))
    if candidates.count() <= small:
        per_file = F.broadcast(per_file)
    read = df.select(F.col(feed).cast("string").alias("feed"), F.col(file_no).cast("int").alias("file_no"), F.col(key).cast("string").alias("id"), *fields)
    rows = read.filter("id is not null").join(per_file, ["feed", "file_no"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = {f: batch.column(f).to_pylist() for f in fields}
            for k, (a, ident, want) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("feed", "id", "wanted")), strict=True)):
                for f in fields:
                    by_path: dict[str, list] = {}
                    for w in want:
                        if w["field"] == f:
                            by_path.setdefault(w["path"], []).append(w)
                    if by_path and texts[f][k]:
                        for path, x in members(parse(texts[f][k])):
                            if path in by_path:
                                raw = hashlib.blake2b(f"{_kind(x)}\x1f{_canonical(x)}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
                                value = int.from_bytes(raw, "little", signed=True)
                                out.extend((a, w["at"], f, path, w["side"], ident, value) for w in by_path[path])
            if out:
                c = list(zip(*out, strict=True))
                types = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(c, types, strict=True)], ["feed", "at", "field", "path", "side", "id", "value"])

    by = ["feed", "at", "field", "id"]
    values = rows.mapInArrow(scan, "feed string, at int, field string, path string, side int, id string, value long").repartition(*by)
    # One value per row and side: ids delivered twice in one file must agree with themselves.
    each = values.groupBy(*by, "side", "path").agg(F.min("value").alias("low"), F.max("value").alias("high")).groupBy(*by).agg(F.collect_list(F.struct("side", "path", "low", "high")).alias("m"))
    of = lambda x: F.filter("m", lambda e: e["side"] == x)
    agree = lambda o, n: (o["low"] == o["high"]) & (n["low"] == n["high"]) & (o["low"] == n["low"])
    pairs = F.flatten(F.transform(of(0), lambda o: F.transform(of(1), lambda n: F.struct(o["path"].alias("old_path"), n["path"].alias("new_path"), agree(o, n).alias("same")))))
    same = each.select("feed", "at", "field", F.explode(pairs).alias("p")).select("feed", "at", "field", "p.*")
    ok = same.groupBy("feed", "at", "field", "old_path", "new_path").agg(F.min("same").alias("ok")).filter("ok").drop("ok")
    return ok.join(candidates, ["feed", "at", "field", "old_path", "new_path"], "left_semi")


def _kind(x: object) -> str:
    t = type_of(x)
    return {BIG: INT, A_BIG: A_INT}.get(t, t)


def _canonical(x: object) -> str:
    import json

    return json.dumps(x, sort_keys=True)


def changes(df: DataFrame, fields: list[str], feed: str = "feed", file_no: str = "file_no", key: str = "id", file_schemas: DataFrame | None = None, small: int = 100_000) -> DataFrame:
    """(feed, file_no, field, old_path, new_path, change) of each file against the one before.

    ``small``: candidates of renames up to which the list of members wanted is sent to all tasks; beyond, rows are
    shuffled to it by file.
    """
    schemas = file_members(df, fields, feed, file_no) if file_schemas is None else file_schemas
    files = df.select(F.col(feed).cast("string").alias("feed"), F.col(file_no).cast("int").alias("file_no")).distinct()
    # As small as the schemas and used several times.
    diff = materialise(_diff(schemas, files))
    gone = diff.filter("new_type is null").select("feed", F.col("file_no").alias("at"), "field", F.col("path").alias("old_path"), F.col("old_type").alias("type"))
    new = diff.filter("old_type is null").select("feed", F.col("file_no").alias("at"), "field", F.col("path").alias("new_path"), F.col("new_type").alias("type"))
    candidates = materialise(gone.join(new, ["feed", "at", "field", "type"]).drop("type"))
    # Every proved pair is a rename; a member may take part in several.
    renamed = materialise(_proved(df, fields, candidates, feed, file_no, key, small).withColumnRenamed("at", "file_no"))
    used = renamed.select("feed", "file_no", "field", F.explode(F.array(F.struct(F.col("old_path").alias("path"), F.lit(0).alias("side")), F.struct(F.col("new_path").alias("path"), F.lit(1).alias("side")))).alias("u")).select("feed", "file_no", "field", "u.path", "u.side")
    kind = F.when(F.col("new_type").isNull(), "removed").when(F.col("old_type").isNull(), "added").otherwise("retyped")
    rest = diff.withColumn("side", F.when(F.col("new_type").isNull(), 0).when(F.col("old_type").isNull(), 1).otherwise(2)).join(used, ["feed", "file_no", "field", "path", "side"], "left_anti")
    rest = rest.select("feed", "file_no", "field", F.when(F.col("old_type").isNull(), "").otherwise(F.col("path")).alias("old_path"), F.when(F.col("new_type").isNull(), "").otherwise(F.col("path")).alias("new_path"), kind.alias("change"))
    return rest.unionByName(renamed.withColumn("change", F.lit("renamed")))
