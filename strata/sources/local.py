"""Small fixed-size frames built inside the JVM.

``spark.createDataFrame(list)`` ships the rows through a Python RDD, so
every task that reads them starts a Python worker. ``local_frame`` builds
the same rows as literals (``inline`` of an array of structs): the plan
stays a JVM-side scan inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_frame(spark: SparkSession, rows, schema) -> DataFrame:
    """Rows (tuples) as a DataFrame; ``schema`` is a DDL string or StructType."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    fields = schema.fields
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
