"""Column contracts of the record table and of the golden table."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD_ID = "record_id"
FIELDS = ("first_name", "last_name", "email", "postcode", "city")
RECORD_COLUMNS = (RECORD_ID, *FIELDS)

RECORD_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RECORD_COLUMNS])

CLUSTER_SCHEMA = T.StructType(
    [T.StructField(RECORD_ID, T.StringType(), False), T.StructField("cluster_id", T.StringType(), False)]
)

GOLDEN_SCHEMA = T.StructType(
    [T.StructField("cluster_id", T.StringType(), False)]
    + [T.StructField(c, T.StringType()) for c in FIELDS]
    + [
        T.StructField("source_record_count", T.LongType(), False),
        T.StructField("source_record_ids", T.StringType(), False),
    ]
)
GOLDEN_COLUMNS = tuple(GOLDEN_SCHEMA.fieldNames())
