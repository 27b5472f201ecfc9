"""Feed, lookup and envelope schemas.

Every feed keeps `timestamp` as STRING on the wire: producers send either an
ISO-8601 string or an epoch-millisecond number, and decoding it as a number
would null out ISO values. `functions.time.event_time` normalises both."""

from pyspark.sql import types as T

AIR_QUALITY = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("pm25", T.DoubleType()),
    T.StructField("pm10", T.DoubleType()),
    T.StructField("no2", T.DoubleType()),
    T.StructField("aqi", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])

SIGNALS = T.StructType([
    T.StructField("junction_id", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("vehicle_count", T.IntegerType()),
    T.StructField("avg_wait_sec", T.DoubleType()),
    T.StructField("signal_phase", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

BUS_GPS = T.StructType([
    T.StructField("bus_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("occupancy_pct", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
])

SMART_METERS = T.StructType([
    T.StructField("meter_id", T.StringType()),
    T.StructField("ward_id", T.StringType()),
    T.StructField("kwh_reading", T.DoubleType()),
    T.StructField("voltage", T.DoubleType()),
    T.StructField("power_factor", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
])

FEEDS = {
    "air_quality": AIR_QUALITY,
    "signals": SIGNALS,
    "bus_gps": BUS_GPS,
    "smart_meters": SMART_METERS,
}

# Kafka key of each feed: the attribute its producer partitions by.
FEED_KEYS = {
    "air_quality": "sensor_id",
    "signals": "junction_id",
    "bus_gps": "route_id",
    "smart_meters": "ward_id",
}

ZONE_PROFILE = T.StructType([
    T.StructField("zone", T.StringType()),
    T.StructField("population", T.IntegerType()),
    T.StructField("number_of_schools", T.IntegerType()),
])

ROUTE_SCHEDULE = T.StructType([
    T.StructField("route_id", T.StringType()),
    T.StructField("route_name", T.StringType()),
    T.StructField("scheduled_arrival_time", T.StringType()),
    T.StructField("terminal", T.StringType()),
])

KAFKA_ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
