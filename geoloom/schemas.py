"""Explicit schemas; readers never infer."""

from pyspark.sql import types as T

TAGS = T.MapType(T.StringType(), T.StringType())
POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
GEOM = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("parts", T.ArrayType(T.ArrayType(POINT))),
    ]
)
MEMBER = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("ref", T.LongType()),
        T.StructField("role", T.StringType()),
    ]
)
NODE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("tags", TAGS),
        T.StructField("version", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
WAY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("nodes", T.ArrayType(T.LongType())),
        T.StructField("tags", TAGS),
        T.StructField("geometry", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
RELATION = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("members", T.ArrayType(MEMBER)),
        T.StructField("tags", TAGS),
        T.StructField("version", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
METRIC = T.StructType(
    [
        T.StructField("sample_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("metric_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("labels", TAGS),
        T.StructField("unit", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)
RUN = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("start_time", T.TimestampType(), False),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("source_file", T.StringType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("tiles_generated", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("metadata", TAGS),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
QUALITY_CHECK = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("check_type", T.StringType(), False),
        T.StructField("check_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("result_value", T.DoubleType()),
        T.StructField("threshold_value", T.DoubleType()),
        T.StructField("details", TAGS),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
TILE_META = T.StructType(
    [
        T.StructField("tile_id", T.StringType(), False),
        T.StructField("zoom_level", T.IntegerType(), False),
        T.StructField("tile_x", T.IntegerType(), False),
        T.StructField("tile_y", T.IntegerType(), False),
        T.StructField("format", T.StringType(), False),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("feature_count", T.LongType()),
        T.StructField("bbox", T.StringType()),
        T.StructField("generated_at", T.TimestampType()),
        T.StructField("last_modified", T.TimestampType()),
    ]
)
METRIC_ROW = T.StructType(
    [
        T.StructField("metric_name", T.StringType(), False),
        T.StructField("metric_value", T.DoubleType(), False),
        T.StructField("labels", TAGS),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
ALERT_RULE = T.StructType(
    [
        T.StructField("metric_name", T.StringType(), False),
        T.StructField("warning_threshold", T.DoubleType()),
        T.StructField("critical_threshold", T.DoubleType(), False),
        T.StructField("comparison_operator", T.StringType(), False),
        T.StructField("evaluation_period", T.IntegerType(), False),
        T.StructField("datapoints_to_alarm", T.IntegerType(), False),
    ]
)

# Raw element rows as the XML source delivers them: everything text, attributes with "_".
_XML_TAG = T.ArrayType(
    T.StructType([T.StructField("_k", T.StringType()), T.StructField("_v", T.StringType())])
)
_XML_COMMON = [
    T.StructField("_id", T.StringType()),
    T.StructField("_version", T.StringType()),
    T.StructField("_timestamp", T.StringType()),
    T.StructField("tag", _XML_TAG),
]
XML_NODE = T.StructType(
    _XML_COMMON + [T.StructField("_lat", T.StringType()), T.StructField("_lon", T.StringType())]
)
XML_WAY = T.StructType(
    _XML_COMMON
    + [T.StructField("nd", T.ArrayType(T.StructType([T.StructField("_ref", T.StringType())])))]
)
XML_RELATION = T.StructType(
    _XML_COMMON
    + [
        T.StructField(
            "member",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("_type", T.StringType()),
                        T.StructField("_ref", T.StringType()),
                        T.StructField("_role", T.StringType()),
                    ]
                )
            ),
        )
    ]
)
