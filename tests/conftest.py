from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

HEADER = (
    "medallion,hack_license,pickup_datetime,dropoff_datetime,trip_time_in_secs,trip_distance,"
    "pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,payment_type,"
    "fare_amount,surcharge,mta_tax,tip_amount,tolls_amount,total_amount"
)
GOLDEN = """\
M1,H1,2013-01-01 05:00:00,2013-01-01 05:10:00,600,2.0,0,0,0,0,CSH,18.0,1.0,0.5,0.0,0.0,20.0
M1,H2,2013-01-01 05:30:00,2013-01-01 05:35:00,300,1.0,0,0,0,0,CSH,9.0,0.5,0.5,0.0,0.0,10.0
M1,H2,2013-01-02 05:45:00,2013-01-02 05:50:00,300,4.0,0,0,0,0,CRD,11.5,0.5,0.5,0.0,0.0,12.5
M2,H1,2013-01-01 17:10:00,2013-01-01 17:30:00,1200,0.5,0,0,0,0,CRD,28.0,1.0,0.5,0.5,0.0,30.0
M2,H3,2013-01-01 17:20:00,2013-01-01 17:21:00,60,2.0,0,0,0,0,CSH,7.5,1.0,0.5,0.0,0.0,9.0
M2,H3,2013-01-01 18:00:00,2013-01-01 18:00:00,0,1.0,0,0,0,0,CSH,4.0,0.5,0.5,0.0,0.0,5.0
M3,H4,not-a-date,2013-01-01 09:02:00,120,1.0,0,0,0,0,CSH,5.0,3.0,0.0,0.0,0.0,8.0
M3,H5,2013-01-01 17:30:00,2013-01-01 17:33:00,180,0,0,0,0,0,CSH,6.0,1.0,0.5,0.0,0.0,7.5
M3,H6,2013-01-01 17:40:00,2013-01-01 17:41:00,abc,1.0,0,0,0,0,CSH,6.0,x,0.5,0.0,0.0,7.5
M4,,2013-01-01 03:00:00,2013-01-01 03:01:00,60,1.0,0,0,0,0,CSH,2.0,0.0,0.0,0.0,0.0,2.0
M1,H1,01/03/2013 05:00:00,01/03/2013 05:05:00,300,1.0,0,0,0,0,CSH,9.0,9.0,0.0,0.0,0.0,9.0
M5,H7
M6
M2,H3,2013-01-01 17:50:00,2013-01-01 17:51:00,60,nan,0,0,0,0,CSH,3.0,1.0,0.5,0.0,0.0,4.0"""


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tripmetrics-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def golden_file(tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text(f"{HEADER}\n{GOLDEN}\n")
    return str(path)


@pytest.fixture
def golden_trips(spark, golden_file):
    from tripmetrics import operators as op
    from tripmetrics import sources

    return op.conform(sources.read_trips(spark, golden_file, "lines"))


SF = "/root/testdata/sf0.001"


@pytest.fixture
def lineitem_trips(spark):
    from tripmetrics.plans import adapters

    return adapters.trips_from_lineitem(adapters.table(spark, SF, "lineitem"))


def rows(df):
    return [tuple(r) for r in df.collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
