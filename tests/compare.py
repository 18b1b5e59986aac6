"""Compares a Spark query with its SQL twin: columns by name, rows as multisets, exact values."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return db


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(map(_value, v))
    return v


def _kind(t):
    t = str(t).lower()
    if any(w in t for w in ("int", "long", "short", "byte")):
        return "whole"
    if any(w in t for w in ("double", "float", "decimal")):
        return "number"
    if "bool" in t:
        return "flag"
    return "text" if "string" in t or "varchar" in t else t


def compare(spark_df, db, sql):
    """Empty list when equal, else what differs."""
    cur = db.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: _kind(d[1]) for d in cur.description}
    theirs = cur.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} vs {sorted(names)}"]
    mine_kinds = {f.name: _kind(f.dataType.simpleString()) for f in spark_df.schema}
    odd = [f"type of {c}: {mine_kinds[c]} vs {kinds[c]}" for c in names if mine_kinds[c] != kinds[c] and '"null"' not in kinds[c]]
    order = sorted(names)
    mine = Counter(tuple(_value(r[c]) for c in order) for r in spark_df.collect())
    place = {c: i for i, c in enumerate(names)}
    other = Counter(tuple(_value(r[place[c]]) for c in order) for r in theirs)
    if mine != other:
        odd.append(f"{order}: {sum(mine.values())} vs {sum(other.values())} rows")
        odd.append(f"only spark: {sorted((mine - other).items(), key=repr)[:4]}")
        odd.append(f"only sql: {sorted((other - mine).items(), key=repr)[:4]}")
    return odd
