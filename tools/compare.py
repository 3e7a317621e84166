"""Run a query in Spark and its oracle SQL in DuckDB; compare as multisets.

Used by the tests and by ``tools/check_oracle.py``.  Columns are compared by
name (sorted), values after a light normalisation (dates as ISO text,
decimals as plain text, floats as repr).
"""

from __future__ import annotations

import datetime as _dt
import decimal
from collections import Counter

from dayflow.sources.tables import TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


_DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
               "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT",
               "smallint": "SMALLINT", "tinyint": "TINYINT", "timestamp_ntz": "TIMESTAMP"}


def spark_types(df) -> dict:
    out = {}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        out[f.name] = _DUCK_TYPES.get(t, t.upper())
    return out


def duck_types(sql: str, sf_dir: str) -> dict:
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.sql(sql)
    return dict(zip(rel.columns, [str(x) for x in rel.types]))


def spark_rows(df):
    cols = sorted(df.columns)
    rows = df.select(*cols).collect()
    return cols, [tuple(_norm(r[c]) for c in cols) for r in rows]


def duck_rows(sql: str, sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    rows = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(df, sql: str, sf_dir: str) -> tuple[bool, str]:
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(sql, sf_dir)
    if sc != dc:
        return False, f"columns differ: spark={sc} duckdb={dc}"
    st, dt = spark_types(df), duck_types(sql, sf_dir)
    if st != dt:
        diff = {c: (st[c], dt.get(c)) for c in st if st[c] != dt.get(c)}
        return False, f"column types differ: {diff}"
    if len(sr) != len(dr):
        return False, f"row counts differ: spark={len(sr)} duckdb={len(dr)}"
    a, b = Counter(sr), Counter(dr)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        return False, f"values differ ({sum((a - b).values())} rows): spark={only_s} duckdb={only_d}"
    return True, f"{len(sr)} rows"
