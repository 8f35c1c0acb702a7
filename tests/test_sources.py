"""Readers: header rule, compressed text, ragged and quoted CSV, formats."""

import bz2
import gzip

import pytest

from conftest import GOLDEN, HEADER, plan_of, rows
from pyspark.sql import functions as F
from tripmetrics import operators as op
from tripmetrics import sinks, sources
from tripmetrics.plans import jobs
from tripmetrics.sources.scratch import scratch_path


def lines_of(df):
    return sorted(r["value"] for r in df.collect())


def test_header_is_the_first_line_of_the_first_file_and_dropped_everywhere(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("h,k\n1,2\nh,k\n")
    (tmp_path / "c.csv").write_text("h,k\n3,4\n" + "5,6\n" * 1000)
    path = str(tmp_path)
    assert lines_of(sources.read_lines(spark, path)) == ["1,2", "3,4"] + ["5,6"] * 1000
    assert sources.read_lines(spark, path, header=False).count() == 1005
    assert sources.header_line(spark, path) == "h,k"


def test_header_behind_many_empty_and_oddly_named_files(spark, tmp_path):
    for i in range(20):
        (tmp_path / f"a{i:02d}.csv").write_text("")
    with gzip.open(tmp_path / "b.csv.gz", "wt"):
        pass
    (tmp_path / "c d (1)[x]{2}%20.csv").write_text("h,k\n1,2\n")
    (tmp_path / "e.csv").write_text("3,4\nh,k\n")
    assert lines_of(sources.read_lines(spark, str(tmp_path))) == ["1,2", "3,4"]


def test_header_of_an_oddly_named_first_file(spark, tmp_path):
    (tmp_path / "a b (1)[x]{2}%20.csv").write_text("h,k\n1,2\n")
    assert lines_of(sources.read_lines(spark, str(tmp_path))) == ["1,2"]


def test_headerless_file_loses_its_first_trip_and_copies_when_asked_to(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2\n3,4\n1,2\n")
    assert lines_of(sources.read_lines(spark, str(tmp_path))) == ["3,4"]


def test_header_given_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2\nh,k\n3,4\n")
    found = sources.read_lines(spark, str(tmp_path), header="h,k")
    assert lines_of(found) == ["1,2", "3,4"]


def test_blank_first_line_is_a_header_too(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n1,2\n\n")
    assert lines_of(sources.read_lines(spark, str(tmp_path))) == ["1,2"]


def test_empty_input(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert lines_of(sources.read_lines(spark, str(tmp_path))) == []


def test_header_only_input_answers_with_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n")
    trips = op.conform(sources.read_trips(spark, str(tmp_path), "lines"))
    assert rows(op.best_hour(trips)) == []
    assert rows(op.top_taxis(trips)) == []


@pytest.mark.parametrize(("suffix", "opener"), [("gz", gzip.open), ("bz2", bz2.open)])
def test_compressed_text(spark, tmp_path, suffix, opener):
    with opener(tmp_path / f"t.csv.{suffix}", "wt") as f:
        f.write(f"{HEADER}\n{GOLDEN}\n")
    trips = op.normalize(sources.read_trips(spark, str(tmp_path), "lines"))
    assert rows(op.run_facts(trips)) == [(14, 10, 4)]


def test_malformed_records_are_dropped_whatever_is_selected(spark, tmp_path):
    (tmp_path / "a.csv").write_text("m,h,s,t\nA,B,1,2\nA,B\nA,B,3,4,5\nC,D,5,6\n")
    path = str(tmp_path)
    found = sources.read_csv(spark, path)
    assert found.count() == 2
    assert rows(found.select("m")) == [("A",), ("C",)]
    schema = sources.generic_schema(4)
    assert rows(sources.csv_quality(spark, path, schema, header=True)) == [(2, 2, 0)]


def test_quotes_and_inference(spark, tmp_path):
    (tmp_path / "a.csv").write_text('medallion,license,duration,total\n"A,1",B,60,2.5\n')
    df = sources.read_csv(spark, str(tmp_path), infer=True)
    assert dict(df.dtypes)["duration"] == "int"
    assert rows(op.normalize(df)) == [("A,1", "B", 60.0, 2.5)]


def test_permissive_pads_and_a_given_width_cuts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\nd\ne,f,g,h\n")
    want = [("a", "b", "c"), ("d", None, None), ("e", "f", "g")]
    assert rows(sources.read_csv_permissive(spark, str(tmp_path), 3)) == want


def test_the_first_record_decides_no_width(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\nc,"d,e",f\ng,h,i\n')
    widths = {(r["width"], r["lines"]) for r in sources.record_widths(spark, str(tmp_path)).collect()}
    assert widths == {(2, 1), (3, 2)}
    found = rows(sources.read_csv_permissive(spark, str(tmp_path)))
    assert found == [("a", "b", None), ("c", "d,e", "f"), ("g", "h", "i")]


@pytest.mark.parametrize("fmt", ["csv", "csv_permissive", "lines"])
def test_stray_fields_are_an_error_without_a_layout(spark, tmp_path, fmt):
    full = [line for line in GOLDEN.splitlines() if line.count(",") == 16]
    (tmp_path / "a.csv").write_text("\n".join([full[0] + ",,,,", *full]) + "\n")
    with pytest.raises(ValueError, match="21 at most, most often 17"):
        sources.read_trips(spark, str(tmp_path), fmt, header=False)
    trips = sources.read_trips(spark, str(tmp_path), fmt, header=False, layout="trip17")
    assert len(trips.columns) == 17
    assert trips.count() == len(full) + (fmt != "csv")


def test_listing_runs_no_task_and_brings_no_names(spark, tmp_path):
    (tmp_path / "b.txt").write_text("second\n")
    (tmp_path / "a.txt").write_text("")
    (tmp_path / "_hidden").write_text("hidden\n")
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    assert sources.listed_bytes(spark, str(tmp_path / "b.txt")) == 7
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert sources.header_line(spark, str(tmp_path)) == "second"


def test_headerless_csv_falls_through_to_positions(spark, tmp_path):
    full = [line for line in GOLDEN.splitlines() if line.count(",") == 16]
    (tmp_path / "a.csv").write_text("\n".join(full) + "\n")
    trips = op.normalize(sources.read_trips(spark, str(tmp_path), "csv", header=False))
    assert rows(op.top_drivers(trips))[0] == ("H3", 6.5)


def test_parquet_formats_and_lost_names(spark, golden_trips, tmp_path):
    path = str(tmp_path / "p")
    golden_trips.toDF(*[f"x{i}" for i in range(17)]).write.parquet(path)
    found = op.conform(sources.read_trips(spark, path, "parquet"))
    assert rows(op.best_hour(found)) == [(17, 1.25)]
    with pytest.raises(ValueError, match="unknown format"):
        sources.read_trips(spark, path, "xml")


def test_staging_then_reading_equals_no_staging(spark, golden_trips, tmp_path):
    one = sinks.stage_parquet(golden_trips, str(tmp_path / "one"), files=1)
    free = sinks.stage_parquet(golden_trips, sinks.staging_path(str(tmp_path)))
    assert free.endswith("/staging_parquet")
    assert len(list((tmp_path / "one").glob("*.snappy.parquet"))) == 1
    for path in (one, free, one):
        staged = sources.read_staged(spark, path)
        assert staged.schema == golden_trips.schema
        assert sorted(map(str, rows(staged))) == sorted(map(str, rows(golden_trips)))
    assert sinks.stage_parquet(golden_trips.limit(3), one) == one
    assert sources.read_staged(spark, one).count() == 3


def test_scratch_path_follows_the_session(spark, tmp_path):
    old = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    if old:
        assert scratch_path(spark, "x").startswith(f"{old}/tripmetrics/x-")


def sizes_of(path):
    return sorted(f.stat().st_size for f in path.rglob("*.parquet"))


@pytest.mark.parametrize("split", ["200k", "1m", "32m"])
def test_staged_files_have_one_size_at_any_split_size(spark, lineitem_trips, tmp_path, split):
    trips = op.conform(lineitem_trips).withColumn("medallion", F.concat("medallion", F.lit("-"), F.pmod("trip_time_in_secs", F.lit(7)).cast("string")))
    text = str(tmp_path / "in")
    trips.select(F.to_csv(F.struct(*trips.columns)).alias("value")).write.text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.shuffle.partitions")
    advised = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        raw = op.lines_to_columns(spark.read.text(text), 17)
        sinks.stage_parquet(op.conform(raw), str(tmp_path / "out"), file_bytes=100_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == advised
    sizes = sizes_of(tmp_path / "out")
    assert len(sizes) > 2 and sizes[-1] <= 2 * sizes[0]
    assert sources.read_staged(spark, str(tmp_path / "out")).count() == lineitem_trips.count()


def tasks_of(path):
    return {f.name.split("-")[1] for f in path.rglob("*.parquet")}


def many_lines(spark, path):
    """Trip lines of some 90 bytes, every key on a few of them, and some short ones."""
    n = spark.range(0, 30_000, 1, 6).withColumn("k", F.xxhash64("id"))
    cells = [F.concat(F.lit("M"), F.pmod("k", F.lit(700))), F.concat(F.lit("H"), F.pmod("k", F.lit(9_000))), *[F.lit("2013-01-01 05:00:00")] * 2, F.pmod("id", F.lit(900)), *[F.pmod("k", F.lit(1000 + i)) for i in range(12)]]
    line = F.when(F.pmod("id", F.lit(50)) == 0, F.concat_ws(",", *cells[:2])).otherwise(F.concat_ws(",", *cells))
    n.select(line.alias("value")).write.text(path)
    return path


def test_many_staged_files_of_one_size_need_few_tasks(spark, tmp_path):
    text, out = many_lines(spark, str(tmp_path / "in")), tmp_path / "out"
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    staged = jobs.stage(spark, text, str(out), layout="trip17", file_bytes=8 * 1024)
    sizes, tasks = sizes_of(out), tasks_of(out)
    assert len(sizes) >= 8 * len(tasks) and sizes[-1] <= 2 * sizes[0]
    plain = op.conform(op.rename_layout(sources.read_csv_permissive(spark, text, 17), "trip17"))
    assert staged.schema == plain.schema
    assert staged.exceptAll(plain).count() == 0 and plain.exceptAll(staged).count() == 0
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_staging_again_in_files_of_another_size_replaces_all(spark, tmp_path):
    text, out = many_lines(spark, str(tmp_path / "in")), tmp_path / "out"
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for size in (8 * 1024, 32 * 1024, 1024 * 1024, 8 * 1024):
            staged = jobs.stage(spark, text, str(out), layout="trip17", file_bytes=size)
            assert staged.count() == 30_000
            assert any(p.name.startswith("piece=") for p in out.iterdir()) == (size < 1024 * 1024)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)


def test_a_column_called_piece_is_staged_as_it_is(spark, tmp_path):
    rows_ = spark.range(0, 20_000).select(F.col("id").alias("Piece"), F.xxhash64("id").alias("x"))
    sinks.stage_parquet(rows_, str(tmp_path / "out"), file_bytes=8 * 1024, by=("x",), input_bytes=10**9)
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(rows_).count() == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20_000


def test_sized_staging_is_a_rebalance(spark, lineitem_trips, tmp_path):
    plan = lineitem_trips.hint("rebalance", "medallion", "hack_license")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "RoundRobin" not in plan
    with pytest.raises(ValueError, match="not both"):
        sinks.stage_parquet(lineitem_trips, str(tmp_path / "x"), files=2, file_bytes=1000)


def test_staging_days_again_replaces_those_days_only(spark, golden_trips, tmp_path):
    path = str(tmp_path / "days")
    undated = golden_trips.withColumn("pickup_datetime", F.lit("soon"))
    for batch, trips in (
        ("first", golden_trips.filter("pickup_datetime like '2013-01-01%'").union(undated.limit(2))),
        ("second", golden_trips.filter("pickup_datetime not like '2013-01-01%'")),
        ("first", golden_trips.filter("pickup_datetime like '2013-01-01%'").limit(4).union(undated.limit(1))),
    ):
        sinks.stage_days(trips, path, batch)
    staged = sources.read_staged(spark, path)
    assert staged.columns == golden_trips.columns
    by_text = {r[0]: r[1] for r in staged.groupBy(F.substring("pickup_datetime", 1, 10)).count().collect()}
    rest = golden_trips.filter("pickup_datetime not like '2013-01-01%'").groupBy(F.substring("pickup_datetime", 1, 10)).count()
    want = {r[0]: r[1] for r in rest.collect()} | {"2013-01-01": 4, "soon": 1}
    assert by_text == want
    one_day = sources.read_staged(spark, path, days=("2013-01-02", "2013-01-02"))
    assert [r["pickup_datetime"][:10] for r in one_day.collect()] == ["2013-01-02"]
    assert "PartitionFilters: [isnotnull(pickup_day" in plan_of(one_day)


@pytest.mark.parametrize("odd", ["wide", "short"])
@pytest.mark.parametrize("some", [True, False])
def test_odd_records_first_in_one_pass(spark, tmp_path, monkeypatch, odd, some):
    """The lines are made and written once, also where no record is odd."""
    from pyspark.sql import DataFrameWriter
    from tripmetrics.plans.catalogue import QUERIES

    discount, line = (0.10, 5) if odd == "wide" else (0.06, 1)
    items = [(1, 10, 2.0, 30.0, 0.02, 0.01, 1), (1, 11, 3.0, 40.0, discount if some else 0.01, 0.01, line)]
    named = ("l_suppkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, "
             "l_tax double, l_linenumber int")  # fmt: skip
    table = spark.createDataFrame(items, named).withColumns(
        {"l_shipdate": F.lit("2024-01-01 05:00:00").cast("timestamp_ntz"), "l_returnflag": F.lit("N")}
    )
    table.write.parquet(str(tmp_path / "lineitem.parquet"))
    calls, text = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda *a: calls.append(a[1]) or text(*a))
    found = rows(QUERIES[f"csv_first_record_{odd}"](spark, str(tmp_path)))
    assert len(calls) == 1
    assert found == [("M1", 2, 2) if not some else ("M1", 1, 1) if odd == "wide" else ("M1", 2, 1)]
