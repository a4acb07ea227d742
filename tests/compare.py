"""Compare a Spark query with its SQL on the same parquet tables."""

import glob
import pathlib

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = pathlib.Path(path).stem
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _text(value):
    """Values of equal type and content get equal text."""
    if isinstance(value, float):
        return "<null>" if value != value else f"float {value!r}"
    return "<null>" if value is None else f"{type(value).__name__} {value}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql):
    """None when the results agree, else what differs."""
    got = _rows(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = _rows(columns, result.fetchall())
    if sorted(spark_df.columns) != sorted(columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(columns)}"
    if got != want:
        only_got = sorted(set(got) - set(want))[:2]
        only_want = sorted(set(want) - set(got))[:2]
        return f"{len(got)} rows against {len(want)}; e.g. {only_got} against {only_want}"
    return None
