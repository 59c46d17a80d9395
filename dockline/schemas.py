"""Explicit schemas of the logical tables and landed documents."""

from pyspark.sql import types as T

STATUS_STATION = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("num_bikes_available", T.IntegerType()),
    T.StructField("num_docks_available", T.IntegerType()),
    T.StructField("is_installed", T.BooleanType()),
    T.StructField("is_renting", T.BooleanType()),
    T.StructField("is_returning", T.BooleanType()),
    T.StructField("last_reported", T.LongType()),
])

INFO_STATION = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("capacity", T.IntegerType()),
])


def _envelope(data: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("last_updated", T.LongType()),
        T.StructField("ttl", T.IntegerType()),
        T.StructField("data", data),
    ])


def _listed(name: str, item: T.DataType) -> T.StructType:
    return _envelope(T.StructType([T.StructField(name, T.ArrayType(item))]))


# Items of a feed are read as JSON text, so that fields beyond the named ones are not lost.
ITEM_FEED = {name: _listed(name, T.StringType()) for name in ("stations", "alerts", "vehicle_types")}
ALERT = T.StructType([
    T.StructField("alert_id", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("summary", T.StringType()),
])
VEHICLE_TYPE = T.StructType([
    T.StructField("vehicle_type_id", T.StringType()),
    T.StructField("form_factor", T.StringType()),
    T.StructField("propulsion_type", T.StringType()),
])
SYSTEM = T.StructType([
    T.StructField("system_id", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("timezone", T.StringType()),
])
SYSTEM_FEED = _envelope(T.StringType())
FEED_LIST = _envelope(T.MapType(T.StringType(), T.StructType([
    T.StructField("feeds", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("url", T.StringType()),
    ]))),
])))

# The typed array that JSON results are parsed back into.
STATION_ARRAY = (
    "array<struct<station_id:string,name:string,lat:double,lon:double,capacity:int,"
    "num_bikes_available:int,num_docks_available:int,is_renting:boolean,is_returning:boolean>>"
)

ZONES = T.StructType([
    T.StructField("Code", T.IntegerType()),
    T.StructField("Arrondisse", T.StringType()),
    T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()),
])

TRIPS = T.StructType([
    T.StructField("start_station_code", T.IntegerType()),
    T.StructField("end_station_code", T.IntegerType()),
    T.StructField("start_date", T.TimestampNTZType()),
])

HISTORY = T.StructType([
    T.StructField("snapshot_time", T.TimestampType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("station_name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("capacity", T.IntegerType()),
    T.StructField("num_bikes_available", T.IntegerType()),
    T.StructField("num_docks_available", T.IntegerType()),
    T.StructField("is_renting", T.BooleanType()),
    T.StructField("utilization_pct", T.DoubleType()),
])

HISTORY_TABLE = T.StructType([*HISTORY.fields, T.StructField("snapshot_date", T.DateType())])

USAGE_LOG = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("question", T.StringType()),
    T.StructField("tool_used", T.StringType()),
    T.StructField("execution_time_ms", T.LongType()),
    T.StructField("success", T.BooleanType()),
])

# The given parquet tables. Stating the types saves a job per table that would
# read footers only to infer them.
GIVEN_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}
