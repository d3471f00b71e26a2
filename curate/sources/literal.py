"""Small literal row sets built JVM-side.

``spark.createDataFrame(list)`` plans a Python-backed RDD scan (Python
workers start for a handful of rows); an ``inline`` of a literal array of
structs is planned as a local JVM relation instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: Sequence[Sequence[object]], schema: str) -> DataFrame:
    """A DataFrame of ``rows`` with DDL ``schema`` (e.g. ``"a long, b string"``)."""
    st = T._parse_datatype_string(schema)
    assert isinstance(st, T.StructType)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                       for f in st.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, st.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
