"""Declared schemas of the event streams; nothing is inferred from data.

Fixed values: field names, order and types are those on the wire.
"""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

VEHICLE = StructType([
    StructField("event_id", StringType()),
    StructField("timestamp", StringType()),
    StructField("produced_at", StringType()),
    StructField("intersection_id", StringType()),
    StructField("direction", StringType()),
    StructField("vehicle_count", IntegerType()),
    StructField("vehicle_type", StringType()),
    StructField("average_speed_kmh", DoubleType()),
    StructField("density_level", StringType()),
])

INCIDENT = StructType([
    StructField("event_id", StringType()),
    StructField("timestamp", StringType()),
    StructField("intersection_id", StringType()),
    StructField("incident_type", StringType()),
    StructField("severity", StringType()),
    StructField("estimated_duration_min", IntegerType()),
    StructField("capacity_reduction_factor", DoubleType()),
    StructField("lanes_blocked", IntegerType()),
    StructField("description", StringType()),
])

DECISION = StructType([
    StructField("intersection_id", StringType()),
    StructField("window_start", StringType()),
    StructField("window_end", StringType()),
    StructField("total_vehicles", LongType()),
    StructField("avg_speed_kmh", DoubleType()),
    StructField("worst_severity", StringType()),
    StructField("traffic_mode", StringType()),
    StructField("green_duration_sec", IntegerType()),
    StructField("red_duration_sec", IntegerType()),
    StructField("decision_timestamp", StringType()),
    StructField("e2e_latency_ms", DoubleType()),
])
