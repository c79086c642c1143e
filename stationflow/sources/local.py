"""Small frames of known rows (file lists, per-file counts) built as an
inline table inside the JVM plan.

``spark.createDataFrame(list)`` plans a Python RDD scan, which starts Python
workers to decode the rows; a ``VALUES`` table needs neither, and is sent to
the JVM in one call.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def rows_frame(spark: SparkSession, rows: Sequence[Sequence], schema: "str | T.StructType") -> DataFrame:
    """A DataFrame of ``rows`` with the given schema (DDL string or StructType)."""
    struct = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    names = [f.name for f in struct.fields]
    casts = ", ".join(
        f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`" for i, f in enumerate(struct.fields))
    if not rows:
        nulls = ", ".join("NULL" for _ in names)
        return spark.sql(f"SELECT {casts} FROM VALUES ({nulls}) AS t({', '.join(f'c{i}' for i in range(len(names)))}) WHERE FALSE")
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(f'c{i}' for i in range(len(names)))})")
