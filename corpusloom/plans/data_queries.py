"""Queries of the general data problems over the driver's tables: pN_... with N in 2, 3, 4."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import drift, instants, records
from corpusloom.session import materialise, table

JSON_FIELDS = ["raw_json", "metrics_json", "media_urls_json"]
DRIFT_FIELDS = ["raw_json", "metrics_json"]


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every array element of the posts' JSON columns with the element that encloses it."""
    rows = records.child_rows(table(spark, sf, "posts"), "row_id", JSON_FIELDS)
    return rows.select("row_id", "field", "child_path", "parent_path")


def p2_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Size of each child table: rows, records with any and the longest array."""
    rows = records.child_rows(table(spark, sf, "posts"), "row_id", JSON_FIELDS)
    return rows.groupBy("field", "table_path").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("row_id").alias("n_records"), (F.max("ordinal") + 1).alias("longest"))


def p2_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every value of the posts' JSON columns with the element (or the record, $) that it is a member of."""
    return records.child_members(records.child_records(table(spark, sf, "posts"), "row_id", JSON_FIELDS), "row_id")


def p2_flat(spark: SparkSession, sf: str) -> DataFrame:
    """The flat tables of raw_json that have rows: rows, records and columns of each."""
    tables = records.child_tables(table(spark, sf, "posts"), "row_id", "raw_json")
    sizes = [t.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("row_id").alias("n_records")).select(F.lit(n).alias("table_path"), "n_rows", "n_records", F.lit(len(t.columns) - 4).cast("long").alias("n_columns")) for n, t in tables.items()]
    return functools.reduce(DataFrame.unionByName, sizes).filter("n_rows > 0")


def p3_read(spark: SparkSession, sf: str, beliefs: dict[str, str] | None, strength: float) -> DataFrame:
    posts = table(spark, sf, "posts").select(F.lit("posts").alias("source_table"), "row_id", F.col("account").alias("source"), F.col("timestamp_utc").alias("value"), F.col("account_tz").alias("tz"))
    speeches = table(spark, sf, "speeches").select(F.lit("speeches").alias("source_table"), "row_id", "source", F.col("event_date").alias("value"), F.col("event_tz").alias("tz"))
    both = posts.unionByName(speeches).withColumn("source", F.concat_ws("/", "source_table", "source"))
    return instants.resolve(both, "value", "tz", "source", beliefs=beliefs, strength=strength)


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """The instant of every post and speech; the stated readings are the prior of the mixtures."""
    return p3_read(spark, sf, instants.STATED, 20.0).filter("utc_us is not null").select("source_table", "row_id", "utc_us")


def p3_status(spark: SparkSession, sf: str) -> DataFrame:
    """Without stated readings: how many values are resolved, stand in a fold or gap, stay open or can't be read."""
    return p3_read(spark, sf, None, 2.0).groupBy("source_table", "status").agg(F.count(F.lit(1)).alias("n_rows"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every change of the members of raw_json and metrics_json from file to file of a feed."""
    posts = table(spark, sf, "posts")
    schemas = materialise(drift.file_members(posts, DRIFT_FIELDS))
    return drift.changes(posts, DRIFT_FIELDS, file_schemas=schemas)


def p4_union_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The one schema of all files, with the number of files that have each member."""
    return drift.union_schema(drift.file_members(table(spark, sf, "posts"), DRIFT_FIELDS))


def p4_unified_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """All metrics of all files in one table under the union schema."""
    posts = table(spark, sf, "posts")
    schema = drift.union_schema(materialise(drift.file_members(posts, ["metrics_json"])))
    return drift.unified(posts, "metrics_json", schema, ["row_id", "feed", "file_no", "id"])


def p4_unified(spark: SparkSession, sf: str) -> DataFrame:
    """All members of raw_json and metrics_json of all files under the union schema, one row a member (arrays by their length)."""
    posts = table(spark, sf, "posts")
    schema = drift.union_schema(materialise(drift.file_members(posts, DRIFT_FIELDS)))
    rows = drift.unified_rows(posts, DRIFT_FIELDS, schema, "row_id")
    return rows.select("row_id", "field", "path", "type", "number", F.when(F.col("n").isNull(), F.col("text")).alias("text"), "n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found, "p2_tables": p2_tables, "p2_values": p2_values, "p2_flat": p2_flat, "p3_found": p3_found, "p3_status": p3_status,
    "p4_found": p4_found, "p4_union_schema": p4_union_schema, "p4_unified_metrics": p4_unified_metrics, "p4_unified": p4_unified,
}
_TREE = r"""
with raw as (select row_id, 'raw_json' as field, raw_json as s from posts union all select row_id, 'metrics_json', metrics_json from posts union all select row_id, 'media_urls_json', media_urls_json from posts),
v as (select row_id, field, case when json_type(s) = 'VARCHAR' then s->>'$' else s end as s from raw where s is not null and json_valid(s)),
n as (select row_id, field, t.fullkey, t.path, t.type from (select * from v where json_valid(s)) ok, json_tree(ok.s) t),
e as (select row_id, field, fullkey as child_path, coalesce(nullif(regexp_extract(path, '^(.*\])', 1), ''), '$') as parent_path from n where fullkey like '%]' and type <> 'NULL')"""
_MEMBERS = r"""
with raw as (select feed, file_no, id, 'raw_json' as field, raw_json as s from posts union all select feed, file_no, id, 'metrics_json', metrics_json from posts),
v as (select * replace (case when json_type(s) = 'VARCHAR' then s->>'$' else s end as s) from raw where s is not null and json_valid(s)),
leaf as (select feed, file_no, ok.id as id, field, substr(t.fullkey, 3) as path, t.type as kind, t.value as value from (select * from v where json_valid(s) and json_type(s) = 'OBJECT') ok, json_tree(ok.s) t
  where t.type not in ('OBJECT', 'NULL') and not contains(t.fullkey, '[') and t.value::varchar <> '[]'),
typed as (select feed, file_no, id, field, path, value::varchar as value, case when kind in ('UBIGINT', 'BIGINT', 'HUGEINT') then 'integer' when kind = 'DOUBLE' then 'decimal number' when kind = 'VARCHAR' then 'string' when kind = 'BOOLEAN' then 'boolean'
  else (select case when bool_and(x = 'VARCHAR') then 'array of strings' when bool_and(x in ('UBIGINT', 'BIGINT', 'HUGEINT')) then 'array of integers' when bool_and(x = 'OBJECT') then 'array of objects' else 'array' end
    from (select unnest(list_transform(json_extract(value, '$[*]'), lambda e: json_type(e))) as x) where x <> 'NULL') end as type from leaf),
m as (select feed, file_no, field, path, case when count(distinct type) = 1 then min(type) when bool_and(type in ('integer', 'decimal number')) then 'decimal number' when bool_and(type like 'array%') then 'array' else 'string' end as type from typed group by all)"""
_INSTANTS = r"""
with raw as (select 'posts' as source_table, row_id, timestamp_utc as v, account_tz as home from posts union all select 'speeches', row_id, event_date, event_tz from speeches),
t as (select source_table, row_id, coalesce(home, 'UTC') as home, replace(replace(regexp_replace(regexp_replace(v, '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g'), '^[A-Z][a-z]{2} ([A-Z][a-z]{2} \d\d \d\d:\d\d:\d\d) ([+-]\d{4}) (\d{4})$', '\1 \3 \2'), 'a.m.', 'AM'), 'p.m.', 'PM') as v from raw where v is not null),
z as (select *, case when contains(v, ':') then regexp_extract(v, '(Z|GMT|UTC|EST|EDT|CST|CDT|MST|MDT|PST|PDT|CET|CEST|[+-]\d\d:?\d\d|[A-Z][a-z]+/[A-Za-z_]+)$') else '' end as zone from t),
b as (select *, try_strptime(replace(trim(v[1:length(v) - length(zone)]), ',', '.'), ['%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S.%f', '%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%dT%H:%M', '%Y-%m-%d', '%m/%d/%Y %I:%M %p', '%d.%m.%Y %H:%M',
    '%a. %d %b %Y %H:%M:%S', '%b %d %H:%M:%S %Y', '%b %d. %Y · %I:%M %p', '%B %d. %Y %I:%M %p', '%B %d. %Y', '%d %b %Y']) as wall,
  case when regexp_full_match(v, '\d{14}') then try_strptime(v, '%Y%m%d%H%M%S') end as compact from z),
w as (select source_table, row_id, v, zone, coalesce(compact, case when not regexp_full_match(v, '\d+') then wall end) as ts, case when contains(zone, '/') then zone else home end as place,
  case when zone in ('Z', 'GMT', 'UTC') then 0 when zone = 'EST' then -300 when zone = 'EDT' then -240 when zone = 'CST' then -360 when zone = 'CDT' then -300 when zone = 'MST' then -420 when zone = 'MDT' then -360 when zone = 'PST' then -480 when zone = 'PDT' then -420 when zone = 'CET' then 60 when zone = 'CEST' then 120
    when zone[1] in ('+', '-') then (case zone[1] when '-' then -1 else 1 end) * (zone[2:3]::int * 60 + right(zone, 2)::int) end as fixed from b),
c as (select *, epoch_us(ts) - (epoch_us(ts - interval 6 hours) - epoch_us(timezone(place, ts - interval 6 hours))) as u1, epoch_us(ts) - (epoch_us(ts + interval 6 hours) - epoch_us(timezone(place, ts + interval 6 hours))) as u2 from w),
r as (select source_table, row_id, case when regexp_full_match(v, '\d{1,13}') and length(v) <> 4 then v::bigint * (case when length(v) <= 10 then 1000000 else 1000 end)
  when fixed is not null then epoch_us(ts) - fixed::bigint * 60000000 when timezone(place, make_timestamptz(u1)) = ts or timezone(place, make_timestamptz(u2)) <> ts then u1 else u2 end as utc_us,
    case when (regexp_full_match(v, '\d{1,13}') and length(v) <> 4) or fixed is not null then 'resolved' when ts is null then 'unreadable' when timezone(place, make_timestamptz(u1)) = ts and timezone(place, make_timestamptz(u2)) = ts and u1 <> u2 then 'ambiguous_fold'
      when timezone(place, make_timestamptz(u1)) <> ts and timezone(place, make_timestamptz(u2)) <> ts then 'skipped' else 'resolved' end as status from c)"""
SQL: dict[str, str] = {
    "p3_found": _INSTANTS + " select source_table, row_id, utc_us from r where utc_us is not null",
    "p3_status": _INSTANTS + """ select source_table, coalesce(status, 'unreadable') as status, count(*) as n_rows from (select a.source_table, case when r.utc_us is null then 'unreadable' else r.status end as status
  from (select 'posts' as source_table, row_id from posts union all select 'speeches', row_id from speeches) a left join r using (source_table, row_id)) group by all""",
    "p4_unified": _MEMBERS.replace("select feed, file_no, id, 'raw_json'", "select row_id, feed, file_no, id, 'raw_json'").replace("select feed, file_no, id, 'metrics_json'", "select row_id, feed, file_no, id, 'metrics_json'").replace("select feed, file_no, ok.id as id,", "select row_id, feed, file_no, ok.id as id,").replace("typed as (select feed,", "typed as (select row_id, feed,")
    + """, u as (select field, path, case when count(distinct type) = 1 then min(type) when bool_and(type in ('integer', 'decimal number')) then 'decimal number' when bool_and(type like 'array%') then 'array' else 'string' end as type from m group by 1, 2)
select row_id, field, path, u.type, case when u.type in ('integer', 'decimal number') then value::double end as number,
  case when u.type not in ('integer', 'decimal number') and typed.type not like 'array%' then case when typed.type = 'string' then (value::json)->>'$' else value end end as text, case when typed.type like 'array%' then json_array_length(value)::int end as n
from typed join u using (field, path)""",
    "p4_union_schema": _MEMBERS + """ select field, path, case when count(distinct type) = 1 then min(type) when bool_and(type in ('integer', 'decimal number')) then 'decimal number' when bool_and(type like 'array%') then 'array' else 'string' end as type, count(*) as files from m group by 1, 2""",
    "p4_found": _MEMBERS + r""",
files as (select distinct feed, file_no from posts),
pairs as (select a.feed, a.file_no from files a join files b on a.feed = b.feed and b.file_no = a.file_no - 1),
o as (select m.feed, m.file_no + 1 as file_no, field, path, type from m join pairs p on p.feed = m.feed and p.file_no = m.file_no + 1), n as (select m.* from m join pairs p on p.feed = m.feed and p.file_no = m.file_no),
gone as (select * from o anti join n using (feed, file_no, field, path)), new as (select * from n anti join o using (feed, file_no, field, path)),
vals as (select feed, file_no, field, path, id, min(type || value) as lo, max(type || value) as hi from typed group by all),
proof as (select g.feed, g.file_no, g.field, g.path as old_path, w.path as new_path, bool_and(x.lo = y.lo and x.hi = y.hi and x.lo = x.hi) as ok from gone g join new w on w.feed = g.feed and w.file_no = g.file_no and w.field = g.field and w.type = g.type
  join vals x on x.feed = g.feed and x.file_no = g.file_no - 1 and x.field = g.field and x.path = g.path join vals y on y.feed = g.feed and y.file_no = g.file_no and y.field = g.field and y.path = w.path and y.id = x.id group by all),
r as (select feed, file_no, field, old_path, new_path from proof where ok)
select feed, file_no, field, old_path, new_path, 'renamed' as change from r
union all select feed, file_no, field, path, '', 'removed' from gone g where not exists (select 1 from r where r.feed = g.feed and r.file_no = g.file_no and r.field = g.field and r.old_path = g.path)
union all select feed, file_no, field, '', path, 'added' from new w where not exists (select 1 from r where r.feed = w.feed and r.file_no = w.file_no and r.field = w.field and r.new_path = w.path)
union all select n.feed, n.file_no, n.field, n.path, n.path, 'retyped' from n join o using (feed, file_no, field, path) where n.type <> o.type""",
    "p2_values": _TREE
    + r""", s as (select row_id, field, t.fullkey, coalesce(nullif(regexp_extract(t.fullkey, '^(.*\])', 1), ''), '$') as child_path, t.type, t.atom from (select * from v where json_valid(s)) ok, json_tree(ok.s) t where t.type not in ('OBJECT', 'ARRAY', 'NULL'))
select row_id, field, child_path, substr(fullkey, length(child_path) + 2) as member, case when type in ('UBIGINT', 'BIGINT', 'HUGEINT') then 'integer' when type = 'DOUBLE' then 'decimal number' when type = 'VARCHAR' then 'string' else 'boolean' end as type,
  case when type not in ('VARCHAR', 'BOOLEAN') then atom::double end as number, case when type = 'VARCHAR' then atom->>'$' when type = 'BOOLEAN' then atom::varchar end as text from s""",
    "p2_flat": _TREE
    + r""", ok as materialized (select row_id, s from v where field = 'raw_json' and json_valid(s)),
s as (select row_id, t.fullkey, coalesce(nullif(regexp_extract(t.fullkey, '^(.*\])', 1), ''), '$') as child_path, t.type from ok, json_tree(ok.s) t),
r as (select row_id, '$' as child_path from s where fullkey = '$' and type <> 'NULL' union all select row_id, fullkey from s where fullkey like '%]' and type <> 'NULL'),
m as (select distinct regexp_replace(child_path, '\[\d+\]', '[*]', 'g') as table_path, substr(fullkey, length(child_path) + 2) as member from s where type not in ('OBJECT', 'ARRAY', 'NULL'))
select table_path, count(*) as n_rows, count(distinct row_id) as n_records, (select count(*) from m where m.table_path = x.table_path) as n_columns from (select row_id, regexp_replace(child_path, '\[\d+\]', '[*]', 'g') as table_path from r) x group by 1""",
    "p2_found": _TREE + " select row_id, field, child_path, parent_path from e",
    "p2_tables": _TREE
    + r""" select field, regexp_replace(child_path, '\[\d+\]', '[*]', 'g') as table_path, count(*) as n_rows, count(distinct row_id) as n_records, max(regexp_extract(child_path, '\[(\d+)\]$', 1)::int) + 1 as longest from e group by 1, 2""",
}
