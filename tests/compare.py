"""Spark result against SQL result: same columns, types, rows."""

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_timestamp(kind):
        return "timestamp"
    return "string" if pa.types.is_string(kind) or pa.types.is_large_string(kind) else str(kind)


def contents(table: pa.Table) -> tuple[dict[str, str], list[tuple]]:
    names = sorted(table.column_names)
    rows = zip(*[table[name].to_pylist() for name in names])
    kinds = {name: _kind(table.schema.field(name).type) for name in names}
    return kinds, sorted(rows, key=repr)


def assert_same(spark_df, relation) -> int:
    left, right = contents(spark_df.toArrow()), contents(relation.to_arrow_table())
    assert left[0] == right[0], (left[0], right[0])
    assert len(left[1]) == len(right[1]), (len(left[1]), len(right[1]))
    for mine, theirs in zip(left[1], right[1]):
        assert mine == theirs, (mine, theirs)
    return len(left[1])
