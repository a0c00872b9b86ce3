"""Schemas, table definitions and the fixed device maps.

The canonical record every source is normalised into is ``READING``:
``device, area, sensor, value, unit, ts, seq``.  ``seq`` is a total order
tie-break (a Kafka offset, an event id) for anything that depends on arrival
order, because a distributed job has no arrival order of its own.
"""

from __future__ import annotations

from pyspark.sql import types as T

READING = T.StructType([
    T.StructField("device", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("sensor", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

# Superset of the two JSON shapes producers write to the same topic:
# {sensor_id, area, value, timestamp} and {timestamp, sensor, value, count}.
JSON_READING = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("sensor", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("count", T.IntegerType()),
])

# Table definitions with their keys and VARCHAR limits (the DDL).
TABLES = {
    "readings": {
        "schema": T.StructType([
            T.StructField("sensor", T.StringType(), False),
            T.StructField("unit", T.StringType()),
            T.StructField("value", T.DecimalType(5, 2)),
            T.StructField("record_time", T.TimestampNTZType(), False),
        ]),
        "key": ["sensor", "record_time"],
        "varchar": {"sensor": 50, "unit": 50},
        "default_now": ["record_time"],
    },
    "oee": {
        "schema": T.StructType([
            T.StructField("sensor_id", T.StringType(), False),
            T.StructField("up_time", T.DecimalType(5, 2)),
            T.StructField("location", T.StringType()),
            T.StructField("record_time", T.TimestampNTZType(), False),
        ]),
        "key": ["sensor_id", "record_time"],
        "varchar": {"sensor_id": 50, "location": 100},
        "default_now": ["record_time"],
    },
    "locations": {
        "schema": T.StructType([
            T.StructField("location_code", T.StringType(), False),
            T.StructField("site_name", T.StringType()),
            T.StructField("address_number", T.IntegerType()),
        ]),
        "key": ["location_code"],
        "varchar": {"location_code": 100, "site_name": 100},
        "default_now": [],
    },
    "sensor_data": {
        "schema": T.StructType([
            T.StructField("area", T.StringType()),
            T.StructField("sensor_id", T.StringType()),
            T.StructField("avg_value", T.DoubleType()),
            T.StructField("cnt", T.IntegerType()),
            T.StructField("ts", T.LongType()),
        ]),
        "key": [],
        "varchar": {"area": 255, "sensor_id": 255},
        "default_now": [],
    },
}

# ---------------------------------------------------------------------------
# Device register / bit layouts and tag names.  These must
# equal the device programs' layouts for decoded values to be right.
# Each map row is (position, tag, divisor, unit).
# ---------------------------------------------------------------------------

# Water plant input registers (temperature x100, pressures x100, flow x10,
# pH x100, clock seconds mod 65535).
WATER_PLANT_REGISTERS = [
    (0, "temperature", 100.0, "celsius"),
    (1, "inlet_pressure", 100.0, "bar"),
    (2, "outlet_pressure", 100.0, "bar"),
    (3, "flow_rate", 10.0, "lmin"),
    (4, "ph_level", 100.0, "ph"),
    (5, "timestamp", 1.0, "s"),
]

# Water plant holding registers (setpoints).
WATER_PLANT_SETPOINTS = [
    (0, "temp_setpoint", 100.0, "celsius"),
    (1, "pressure_setpoint", 100.0, "bar"),
    (2, "flow_setpoint", 10.0, "lmin"),
]

# Water plant discrete inputs, in bit order.
WATER_PLANT_BITS = [
    "pump_running",
    "valve_open",
    "heater_on",
    "flow_high",
    "temp_alarm",
    "pressure_alarm",
    "emergency_stop",
    "system_healthy",
]

# Two-device server: device 1 is a tank, device 2 a belt; all scaled x100.
TANK_REGISTERS = [(0, "flow_rate", 100.0, "lmin"), (1, "tank_temp", 100.0, "celsius")]
BELT_REGISTERS = [(0, "belt_speed", 100.0, "m/s"), (1, "vibration", 100.0, "mm/s")]
TANK_BITS = ["pump_running", "heater_on"]
BELT_BITS = ["belt_running", "suspension"]

# Units of the ten line-protocol events a plant poll becomes.
POLL_UNITS = [
    ("temperature", "celsius"),
    ("inlet_pressure", "bar"),
    ("outlet_pressure", "bar"),
    ("flow_rate", "lmin"),
    ("ph_level", "ph"),
    ("pump_status", "boolean"),
    ("valve_status", "boolean"),
    ("heater_status", "boolean"),
    ("temp_alarm", "boolean"),
    ("pressure_alarm", "boolean"),
]

# Alarm texts, in the order a console lists them; the last one fires when
# the health bit is *off*.
ALARM_TEXTS = [
    ("temp_alarm", True, "HIGH TEMPERATURE"),
    ("pressure_alarm", True, "HIGH PRESSURE"),
    ("emergency_stop", True, "EMERGENCY STOP ACTIVATED"),
    ("system_healthy", False, "SYSTEM NOT HEALTHY"),
]
ALL_NORMAL = "All systems normal"

# Threshold rules (tag, operator, limit, label) from the device programs.
THRESHOLD_RULES = [
    ("flow_rate", ">", 50.0, "flow_high"),
    ("temperature", ">", 30.0, "temp_alarm"),
    ("inlet_pressure", ">", 4.0, "pressure_alarm"),
]

# The second device server's rules (its flow limit differs).
SECOND_THRESHOLD_RULES = [
    ("flow_rate", ">", 180.0, "flow_alarm"),
    ("temperature", ">", 30.0, "temp_alarm"),
]

# Client tag name -> server tag name (the two naming schemes disagree).
TAG_ALIASES = [
    ("PhLevel", "PhRatio"),
    ("HighFlowAlarm", "FlowAlarm"),
    ("Setpoints", "SetPoints"),
]

# Ordered substring rules for classifying terminal lines; first match wins.
LINE_CLASSES = [("docker", "DOCKER"), ("ls", "NAVIGATION"), ("cd", "NAVIGATION")]
LINE_CLASS_DEFAULT = "OTHER"
