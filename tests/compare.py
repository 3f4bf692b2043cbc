"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted."""
    frame = frame[sorted(frame.columns)]
    out = pd.DataFrame({c: _text(frame[c]) for c in frame.columns})
    return out.sort_values(list(out.columns), kind="stable").reset_index(drop=True)


def _text(column: pd.Series) -> pd.Series:
    if pd.api.types.is_datetime64_any_dtype(column):
        text = column.dt.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif pd.api.types.is_bool_dtype(column):
        text = column.map({True: "true", False: "false"})
    elif pd.api.types.is_float_dtype(column):
        text = column.map(lambda x: f"{x:.9g}")
    else:
        text = column.map(_scalar)
    return text.astype(object).where(column.notna(), "null")


def _scalar(x) -> str:
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, float):
        return str(int(x)) if x == int(x) else f"{x:.9g}"
    return str(x)[:10] if hasattr(x, "isoformat") and str(x).endswith("00:00:00") else str(x)


def spark_types(df) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns, types and bag of rows, else what differs."""
    relation = con.sql(sql)
    ours = {n: KINDS.get(t, t) for n, t in spark_types(df).items()}
    theirs = dict(zip(relation.columns, (str(t) for t in relation.types)))
    if ours != theirs:
        return f"schema: {sorted(set(ours.items()) ^ set(theirs.items()))}"
    left = canonical(df.toArrow().to_pandas(date_as_object=True))
    right = canonical(relation.to_arrow_table().to_pandas(date_as_object=True))
    if len(left) != len(right):
        return f"rows: {len(left)} != {len(right)}"
    if left.equals(right):
        return None
    rows = (left != right).any(axis=1)
    return f"{int(rows.sum())} rows differ:\n{left[rows].head(3).to_string()}\n{right[rows].head(3).to_string()}"
