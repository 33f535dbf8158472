"""Column names and types of the frames the operators work on."""

from pyspark.sql import types as T

# The attributes kept from a daily snapshot and the groups built on them.
RAW_ATTRIBUTES = [
    "smart_5_raw", "smart_9_raw", "smart_187_raw", "smart_188_raw", "smart_194_raw",
    "smart_197_raw", "smart_198_raw", "smart_199_raw", "smart_241_raw", "smart_242_raw",
]
MODEL_ATTRIBUTES = RAW_ATTRIBUTES[:8]
WINDOW_ATTRIBUTES = ["smart_5_raw", "smart_187_raw", "smart_197_raw", "smart_198_raw"]
MONTH_ATTRIBUTES = ["smart_5_raw", "smart_187_raw", "smart_197_raw"]

SNAPSHOT_KEY = ["date", "serial_number"]

SNAPSHOT = T.StructType(
    [
        T.StructField("date", T.DateType(), False),
        T.StructField("serial_number", T.StringType(), False),
        T.StructField("model", T.StringType()),
        T.StructField("capacity_bytes", T.LongType()),
        T.StructField("failure", T.IntegerType()),
    ]
    + [T.StructField(name, T.LongType()) for name in RAW_ATTRIBUTES]
)

FEATURE_COLUMNS = (
    MODEL_ATTRIBUTES
    + [f"{a}_{stat}_7d" for a in WINDOW_ATTRIBUTES for stat in ("mean", "std", "max", "delta")]
    + [f"{a}_mean_30d" for a in MONTH_ATTRIBUTES]
    + ["temp_mean_7d", "temp_max_7d", "power_on_hours", "age_days", "capacity_tb"]
)
LABEL_COLUMNS = ["days_to_failure", "will_fail_30d", "will_fail_60d", "failed"]
TRAINING_COLUMNS = ["date", "serial_number", "model"] + FEATURE_COLUMNS + LABEL_COLUMNS

# A scoring request: only the serial number is required.
SCORING_REQUEST = T.StructType(
    [
        T.StructField("serial_number", T.StringType(), False),
        T.StructField("model", T.StringType()),
        T.StructField("capacity_tb", T.DoubleType()),
        T.StructField("age_days", T.IntegerType()),
        T.StructField("power_on_hours", T.LongType()),
    ]
    + [
        T.StructField(name, T.DoubleType())
        for name in FEATURE_COLUMNS
        if name not in ("capacity_tb", "age_days", "power_on_hours")
    ]
)

OP_SETTINGS = [f"op_setting_{i}" for i in range(1, 4)]
SENSORS = [f"sensor_{i}" for i in range(1, 22)]
# Sensors of the turbofan series that never change.
CONSTANT_SENSORS = ["sensor_1", "sensor_5", "sensor_10", "sensor_16", "sensor_18", "sensor_19"]

SENSOR_READINGS = T.StructType(
    [T.StructField("engine_id", T.IntegerType()), T.StructField("cycle", T.IntegerType())]
    + [T.StructField(name, T.DoubleType()) for name in OP_SETTINGS + SENSORS]
)
