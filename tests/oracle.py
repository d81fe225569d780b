"""Compare a query with its SQL over one folder of tables."""

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        if (path := Path(folder) / f"{t}.parquet").exists():
            con.execute(f"create view {t} as select * from '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return con


def plain(x):
    if isinstance(x, Decimal):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.9g}")
    return x.isoformat() if isinstance(x, datetime | date) else list(map(plain, x)) if isinstance(x, list | tuple) else x


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(repr([plain(r[i]) for i in order]) for r in records)


def differences(spark, con, folder, query, sql):
    """'' if names and rows are equal, else what differs."""
    found = query(spark, str(folder))
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    if sorted(names) != sorted(found.columns):
        return f"columns {sorted(found.columns)} and {sorted(names)}"
    own, other = rows(found.columns, found.collect()), rows(names, want.fetchall())
    if own == other:
        return ""
    return f"{own.total()} and {other.total()} rows; only here {list((own - other).items())[:3]}; only there {list((other - own).items())[:3]}"
