"""Declared schema of the typed telemetry event."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, nesting and types of the typed "clean"
# telemetry event, read schema-on-read from JSON lines. FLOAT fields of the
# original declaration are read as DOUBLE so that 1.1 stays 1.1 (FLOAT
# widens to 1.100000023841858).
EVENT_SCHEMA = T.StructType([
    T.StructField("clientLanguage", T.StringType()),
    T.StructField("clientTimeMs", T.LongType()),
    T.StructField("details", T.StructType([
        T.StructField("isRetina", T.BooleanType()),
        T.StructField("nativeZoom", T.DoubleType()),
    ])),
    T.StructField("eventId", T.StringType()),
    T.StructField("meta", T.StructType([
        T.StructField("domain", T.StringType()),
        T.StructField("locations", T.ArrayType(T.StringType())),
        T.StructField("pseudoEvents", T.ArrayType(T.StringType())),
        T.StructField("ua", T.StructType([
            T.StructField("browser", T.StringType()),
            T.StructField("browserVersion", T.DoubleType()),
            T.StructField("groups", T.ArrayType(T.StringType())),
        ])),
    ])),
    T.StructField("name", T.StringType()),
    T.StructField("pageViewId", T.StringType()),
    T.StructField("serverTs", T.LongType()),
    T.StructField("sessionId", T.StringType()),
    T.StructField("siteId", T.StringType()),
    T.StructField("ttsState", T.BooleanType()),
    T.StructField("userId", T.StringType()),
    T.StructField("zoomLevel", T.DoubleType()),
])

CORRUPT_COLUMN = "_corrupt_record"
