"""Column lists and schemas.

Fixed values: the names and orders below must equal the reference's so that
feature vectors line up column for column.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the reference)
# ---------------------------------------------------------------------------
RAW_NUMERIC = ["time", "mode", "voltage_load", "current_load", "temperature_battery"]
LIGHT_COLUMNS = [
    "battery_id", "battery_type", "time", "voltage_load", "current_load",
    "temperature_battery",
]
CYCLE_KEYS = ["battery_id", "battery_type", "cycle"]
CYCLE_MEASURES = ["avg_voltage", "min_voltage", "avg_current", "max_temp", "duration"]
FINAL_COLUMNS = [
    "battery_id", "battery_type", "cycle", "avg_voltage", "min_voltage",
    "avg_current", "max_temp", "duration", "max_cycle", "RUL", "SoH",
    "prev_voltage", "voltage_drop", "prev_temp", "temp_change", "cycle_ratio",
]
PHYSICAL_FEATURES = [
    "avg_voltage", "min_voltage", "avg_current", "duration", "voltage_drop",
    "temp_change", "cycle", "cumul_voltage_drop", "cycle_rank", "cycle_norm",
]
CORR_FEATURES = [
    "avg_voltage", "min_voltage", "avg_current", "duration", "voltage_drop",
    "temp_change", "cycle", "cumul_voltage_drop", "cycle_rank",
]
BATTERY_TYPES = ["regular", "recommissioned", "second_life"]
DISCHARGE_MODE = -1.0
CYCLE_WIDTH = 1000.0
ROLLING_WINDOW = 10
SAVGOL_WINDOW = 11
SEQ_LEN = 20
SEED = 42
FAILURE_THRESHOLD = 0.70
SPLIT_RATIOS = (0.70, 0.20)          # train, val; test takes the rest
SOH_HUBER_DELTA = 0.1
RUL_HUBER_DELTA = 0.05
HEALTHY_ABOVE = 80.0                 # SoH percent; > 80 Healthy
CRITICAL_BELOW = 70.0                # SoH percent; < 70 Critical, else Degraded
SOH_TARGET = "SoH_smoothed"
RUL_TARGET = "rul_ratio"
REQUIRED_READING_FIELDS = [
    "avg_voltage", "min_voltage", "avg_current", "duration", "voltage_drop",
    "temp_change",
]
DEFAULT_READING_CYCLE = 1.0
DEFAULT_READING_CYCLE_RANK = 0.5
# Descriptions carried in the run summary record.
SUMMARY_SMOOTHING = "Savitzky-Golay window=11 polyorder=2"
SUMMARY_SPLIT = "70/20/10 stratified by battery_type"
SUMMARY_RUL_TARGET = "rul_ratio (normalized)"


def with_rolling(features: list[str]) -> list[str]:
    """Physical features followed by ``{f}_mean, {f}_std`` pairs (reference order)."""
    out = list(features)
    for f in features:
        out += [f"{f}_mean", f"{f}_std"]
    return out


FEATURES_30 = with_rolling(PHYSICAL_FEATURES)
FEATURES_27 = with_rolling(CORR_FEATURES)

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
# Raw CSV is read as strings and coerced with try_cast: a column holding any
# text would otherwise infer as string in one file and double in another.
RAW_TELEMETRY_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in RAW_NUMERIC]
)

LIGHT_SCHEMA = T.StructType(
    [T.StructField("battery_id", T.StringType()), T.StructField("battery_type", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in LIGHT_COLUMNS[2:]]
)

_INT_FINAL = {"cycle", "max_cycle", "RUL"}
_STR_FINAL = {"battery_id", "battery_type"}
CYCLE_SCHEMA = T.StructType([
    T.StructField(
        c,
        T.StringType() if c in _STR_FINAL
        else T.IntegerType() if c in _INT_FINAL else T.DoubleType(),
    )
    for c in FINAL_COLUMNS
])

READING_SCHEMA = T.StructType(
    [T.StructField("request_id", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in REQUIRED_READING_FIELDS]
    + [T.StructField("cycle", T.DoubleType()), T.StructField("cycle_rank", T.DoubleType())]
)
