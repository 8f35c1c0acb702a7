"""Table layouts, column aliases and fixed labels shared by the whole package."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --------------------------------------------------------------------------
# Fixed values. Column orders, accepted names, date patterns, labels and the
# cost rate below have to equal what existing trip files and reports use.
# --------------------------------------------------------------------------

TRIP17 = StructType(
    [
        StructField("medallion", StringType()),
        StructField("hack_license", StringType()),
        StructField("pickup_datetime", StringType()),
        StructField("dropoff_datetime", StringType()),
        StructField("trip_time_in_secs", DoubleType()),
        StructField("trip_distance", DoubleType()),
        StructField("pickup_longitude", DoubleType()),
        StructField("pickup_latitude", DoubleType()),
        StructField("dropoff_longitude", DoubleType()),
        StructField("dropoff_latitude", DoubleType()),
        StructField("payment_type", StringType()),
        StructField("fare_amount", DoubleType()),
        StructField("surcharge", DoubleType()),
        StructField("mta_tax", DoubleType()),
        StructField("tip_amount", DoubleType()),
        StructField("tolls_amount", DoubleType()),
        StructField("total_amount", DoubleType()),
    ]
)

REDUCED4 = StructType(
    [
        StructField("medallion", StringType()),
        StructField("hack_license", StringType()),
        StructField("trip_time_in_secs", DoubleType()),
        StructField("total_amount", DoubleType()),
    ]
)

CLASSIC21 = (
    "medallion",
    "hack_license",
    "vendor_id",
    "rate_code",
    "store_and_fwd_flag",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_time_in_secs",
    "trip_distance",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "payment_type",
    "fare_amount",
    "surcharge",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "total_amount",
)

# Twenty columns wide but nineteen names: the last column keeps its generic name.
CLASSIC20 = (
    "medallion",
    "hack_license",
    "vendor_id",
    "rate_code",
    "store_and_fwd_flag",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_time_in_secs",
    "trip_distance",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "payment_type",
    "fare_amount",
    "surcharge",
    "mta_tax",
    "total_amount",
)

CLASSIC17 = (
    "medallion",
    "hack_license",
    "vendor_id",
    "rate_code",
    "store_and_fwd_flag",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_time_in_secs",
    "trip_distance",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "payment_type",
    "fare_amount",
    "total_amount",
)

# Canonical column -> accepted names, first match wins, case does not matter.
ALIASES = {
    "medallion": ("medallion", "medallion_id", "med_id", "taxi_id"),
    "hack_license": ("hack_license", "driver_license", "driver_id", "license"),
    "trip_time_in_secs": ("trip_time_in_secs", "trip_time", "trip_seconds", "duration"),
    "total_amount": ("total_amount", "total_amt", "fare_amount_total", "fare_total", "total"),
}

COST_PER_VCPU_MIN = 0.00079
BYTES_PER_GB = 1024.0**3
SKETCH_RSD = 0.05

# Summary lines: (label, column of the economics row or None for a heading, digits).
# The first style follows the lines of the result itself, the others stand alone.
SUMMARY_STYLES = {
    "economic": (
        ("--- Economic Metrics ---", None, None),
        ("Estimated Cost (USD)", "cost_usd", 4),
        ("Cost per GB Processed (USD/GB)", "cost_per_gb", 6),
        ("Cost per Record (USD/record)", "cost_per_record", 10),
        ("Cost Efficiency (records per $)", "records_per_usd", 2),
        ("--- Performance Metrics ---", None, None),
        ("Total Records", "records", None),
        ("Records per Second", "records_per_sec", 2),
        ("Input Size (GB)", "input_gb", 4),
        ("Runtime (seconds)", "runtime_sec", 2),
        ("Cluster Size (vCPUs)", "vcpus", None),
        ("Staging Parquet", "staging", None),
    ),
    "combined": (
        ("--- Job & Cluster ---", None, None),
        ("Cluster Size (vCPUs)", "vcpus", None),
        ("Runtime (seconds)", "runtime_sec", 2),
        ("--- Dataset ---", None, None),
        ("Total Records (filtered)", "records", None),
        ("Input Size (GB)", "input_gb", 4),
        ("Records per Second", "records_per_sec", 2),
        ("--- Economics (rough) ---", None, None),
        ("Estimated Cost (USD)", "cost_usd", 6),
        ("Cost per GB Processed (USD/GB)", "cost_per_gb", 6),
        ("Cost per Record (USD/record)", "cost_per_record", 12),
        ("Cost Efficiency (records per $)", "records_per_usd", 2),
        ("--- Task Timings ---", None, None),
        ("Task1 Runtime (seconds)", "taxis_sec", 3),
        ("Task2 Runtime (seconds)", "drivers_sec", 3),
    ),
    "short": (
        ("Task", "task", None),
        ("Runtime_sec", "runtime_sec", 2),
        ("Task1_sec", "taxis_sec", 3),
        ("Task2_sec", "drivers_sec", 3),
        ("Rows_raw", "rows_raw", None),
        ("Rows_filtered", "records", None),
        ("Input_GB", "input_gb", 4),
        ("vCPU_min_est", "vcpu_minutes", 2),
        ("Cost_USD_est", "cost_usd", 6),
        ("Records_per_sec", "records_per_sec", 2),
        ("Output_JSON", "output_json", None),
    ),
    "staged": (
        ("Task", "task", None),
        ("CSV Input", "input_path", None),
        ("Staging Parquet", "staging", None),
        ("Rows (staged)", "rows_raw", None),
        ("Rows (filtered)", "records", None),
        ("Runtime (sec)", "runtime_sec", 2),
        ("Task1 Sec", "taxis_sec", 3),
        ("Task2 Sec", "drivers_sec", 3),
        ("Records/sec", "records_per_sec", 2),
        ("Input Size (GB)", "input_gb", 4),
        ("vCPUs est.", "vcpus", None),
        ("Est. Cost (USD)", "cost_usd", 6),
        ("Cost/GB", "cost_per_gb", 6),
        ("Cost/Record", "cost_per_record", 12),
        ("Cost Efficiency (records/$)", "records_per_usd", 2),
        ("Output JSON", "output_json", None),
    ),
}

# {n} is the number of places that were asked for.
RESULT_HEADINGS = {
    "best_hour": "--- Best Hour Result ---",
    "top_drivers": "--- Top {n} Drivers ---",
    "top_taxis": "--- Top {n} Taxis ---",
}
TASKS = {
    "best_hour": "Best hour by surcharge per distance",
    "top_drivers": "Top {n} drivers by $/min",
    "top_taxis": "Top {n} medallions by # distinct drivers",
}
BEST_HOUR_LABELS = ("Best Hour", "Average Ratio")
NO_RESULT_LABEL = "No valid records found"

# --------------------------------------------------------------------------
# End of fixed values.
# --------------------------------------------------------------------------

TRIP17_NAMES = TRIP17.fieldNames()
REQUIRED = REDUCED4.fieldNames()

# What a reader says of the record that a row came from: how many fields it had, and whether the
# row is only there to be counted. The column comes last and goes along until it has been counted.
RECORD = "_record"
RECORD_TYPE = StructType([StructField("fields", IntegerType()), StructField("dropped", BooleanType())])

# Registers (as a power of two) of the sketches that are stored.
SKETCH_SIZE = 12

# Layout name -> (names by position, columns the input must have at least).
LAYOUTS = {
    "trip17": (TRIP17_NAMES, 17),
    "classic21": (CLASSIC21, 21),
    "classic20": (CLASSIC20, 20),
    "classic17": (CLASSIC17, 17),
}

RUNS = StructType(
    [
        StructField("run_id", StringType()),
        StructField("rows_raw", LongType()),
        StructField("records", LongType()),
        StructField("input_bytes", LongType()),
        StructField("runtime_sec", DoubleType()),
        StructField("vcpus", IntegerType()),
        StructField("task", StringType()),
        StructField("input_path", StringType()),
        StructField("staging", StringType()),
        StructField("output_json", StringType()),
        StructField("taxis_sec", DoubleType()),
        StructField("drivers_sec", DoubleType()),
    ]
)

# Columns of a run that need not apply to it; their report lines are left out then.
RUN_OPTIONS = ("task", "input_path", "staging", "output_json", "taxis_sec", "drivers_sec")
