"""Input size, economics, reports, and whole jobs from a path to an output directory."""

import json
import math

import pytest

from conftest import rows
from tripmetrics import operators as op
from tripmetrics import sinks, sources
from tripmetrics.functions import plain_number, ratio_or_zero
from tripmetrics.plans import jobs
from tripmetrics.schema import RUNS, SUMMARY_STYLES


NO_OPTIONS = (None,) * 6


def text_lines(path):
    parts = sorted(path.glob("part-*"))
    assert len(parts) == 1
    return parts[0].read_text().splitlines()


def json_lines(path):
    parts = sorted(path.glob("part-*"))
    assert len(parts) == 1
    return [json.loads(line) for line in parts[0].read_text().splitlines()]


def test_input_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 1000)
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "b").write_bytes(b"y" * 24)
    (tmp_path / "d" / "e" / "c").write_bytes(b"z" * 6)
    (tmp_path / "_hidden").write_bytes(b"h" * 99)
    folders = sources.input_folders(spark, str(tmp_path))
    assert sorted((r.folder.rsplit("/", 1)[1], r.files, r.bytes) for r in folders.collect()) == [("a", 1, 1000), ("d", 2, 30)]
    assert rows(op.input_bytes(folders)) == [(3, 1030, 1030 / 1024**3)]
    (tmp_path / "none").mkdir()
    assert rows(op.input_bytes(sources.input_folders(spark, str(tmp_path / "none")))) == [(0, None, None)]


@pytest.mark.parametrize("split", ["1m", "128m"])
def test_listing_costs_no_task_at_any_split_size(spark, tmp_path, split):
    for day in range(12):
        (tmp_path / f"day={day}").mkdir()
        (tmp_path / f"day={day}" / "part").write_bytes(b"x" * 1_500_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.sparkContext.setJobGroup(f"listing-{split}", "")
    try:
        folders = sources.input_folders(spark, str(tmp_path))
        assert spark.sparkContext.statusTracker().getJobIdsForGroup(f"listing-{split}") == []
        assert folders.count() == 12 and rows(op.input_bytes(folders))[0][:2] == (12, 18_000_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_economics(spark):
    runs = sources.from_rows(
        spark,
        [
            ("a", 1200, 1000, 1024**3 * 2, 120.0, 6, *NO_OPTIONS),
            ("b", 0, 0, None, 0.0, 6, *NO_OPTIONS),
        ],
        RUNS,
    )
    a, b = sorted(op.economics(runs).collect(), key=lambda r: r["run_id"])
    assert a["vcpu_minutes"] == 12.0
    assert math.isclose(a["cost_usd"], 12 * 0.00079)
    assert math.isclose(a["cost_per_gb"], 6 * 0.00079)
    assert math.isclose(a["cost_per_record"], 12 * 0.00079 / 1000)
    assert math.isclose(a["records_per_usd"], 1000 / (12 * 0.00079))
    assert math.isclose(a["records_per_sec"], 1000 / 120)
    assert b["cost_per_gb"] is None
    assert (b["records_per_sec"], b["cost_per_record"], b["records_per_usd"]) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize(
    "value", [0.0, 1.0, 12345678.9, 0.0004, 0.00012, 9.9e-05, 2.3e-08, 1e-9, -3.25, 1e-10, 150.0, 1e24, 1.25e16, 9007199254740993.0, 0.00012345678901234567]
)
def test_plain_number_prints_like_a_report(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(plain_number("v")).first()[0] == repr(value)


def test_ratio_or_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, -1.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(ratio_or_zero("a", "b")).collect()] == [0.5, 0.0, 0.0, 0.0]


@pytest.mark.parametrize("style", SUMMARY_STYLES)
def test_summary_styles(spark, tmp_path, style):
    options = ("T", "/in", "/st", "/out", 1.23456, None)
    runs = sources.from_rows(spark, [("a", 1200, 1000, 1024**3 * 2, 120.0, 6, *options)], RUNS)
    out = tmp_path / "s"
    report = op.summary(op.economics(runs), style).drop("run_id")
    for _ in range(2):
        sinks.write_summary_text(report, str(out))
    lines = text_lines(out)
    labels = [label for label, column, _ in SUMMARY_STYLES[style] if column != "drivers_sec"]
    assert [line.split("'")[1] for line in lines] == labels
    if style == "economic":
        assert lines[0] == "('--- Economic Metrics ---', '')"
        assert lines[1] == "('Estimated Cost (USD)', 0.0095)"
        assert lines[3] == "('Cost per Record (USD/record)', 9.48e-06)"
        assert lines[6] == "('Total Records', 1000)"
        assert lines[-1] == "('Staging Parquet', '/st')"
    if style == "short":
        assert lines[:3] == ["('Task', 'T')", "('Runtime_sec', 120.0)", "('Task1_sec', 1.235)"]


def test_reports_of_many_runs_are_spread_and_stay_in_order(spark, tmp_path):
    runs = spark.range(40).selectExpr(
        "concat('r', id) run_id", "id rows_raw", "id + 1 records", "id * 1000 input_bytes",
        "double(id + 1) runtime_sec", "4 vcpus",
    )
    reports = op.summary(op.economics(runs))
    out = sinks.write_summary_text(reports, str(tmp_path / "s"), by_run=True)
    assert out == str(tmp_path / "s")
    labels = [label for label, column, _ in SUMMARY_STYLES["economic"] if column != "staging"]
    for i in range(40):
        lines = text_lines(tmp_path / "s" / f"run_id=r{i}")
        assert [line.split("'")[1] for line in lines] == labels
        assert lines[6] == f"('Total Records', {i + 1})"
    together = sinks.write_summary_text(reports, str(tmp_path / "t"))
    found = [line for part in sorted((tmp_path / "t").glob("part-*")) for line in part.read_text().splitlines()]
    assert together == str(tmp_path / "t") and len(list((tmp_path / "t").glob("run_id=*"))) == 0
    assert [line.split("\t")[0] for line in found] == sorted(f"r{i}" for i in range(40) for _ in labels)
    assert [line.split("'")[1] for line in found] == labels * 40


def test_unknown_size_and_lines_that_do_not_apply(spark):
    runs = sources.from_rows(spark, [("a", 1, 1, None, 1.0, 6, *NO_OPTIONS)], RUNS)
    found = {r["label"]: r["value"] for r in op.summary(op.economics(runs)).collect()}
    assert found["Input Size (GB)"] == "None" and found["Cost per GB Processed (USD/GB)"] == "None"
    assert "Staging Parquet" not in found


def test_ranking_json_is_one_ordered_file_and_replaces(spark, golden_trips, tmp_path):
    out = tmp_path / "r"
    for _ in range(2):
        sinks.write_ranking_json(op.top_taxis(golden_trips), str(out))
    assert json_lines(out) == [
        {"medallion": "M3", "num_drivers": 3},
        {"medallion": "M1", "num_drivers": 2},
        {"medallion": "M2", "num_drivers": 2},
        {"medallion": "M5", "num_drivers": 1},
    ]


def test_held_is_released(spark, golden_trips):
    with sinks.held(golden_trips) as kept:
        tables = op.both_rankings_shared(kept)
        assert kept.is_cached
        assert rows(tables["top_taxis"])[0] == ("M1", 2)
        assert "InMemoryTableScan" in tables["top_taxis"]._jdf.queryExecution().toString()
    assert not golden_trips.is_cached


def test_best_hour_job(spark, golden_file, tmp_path):
    written = jobs.run(spark, "best_hour", golden_file, str(tmp_path / "out"))
    assert json_lines(tmp_path / "out" / "best_hour") == [{"hour": 17, "avg_ratio": 1.25}]
    lines = text_lines(tmp_path / "out" / "results_summary")
    assert lines[:4] == [
        "('--- Best Hour Result ---', '')",
        "('Best Hour', 17)",
        "('Average Ratio', 1.25)",
        "('--- Economic Metrics ---', '')",
    ]
    assert "('Total Records', 14)" in lines
    assert set(written) == {"best_hour", "summary"}


@pytest.mark.parametrize("staged", [False, True])
def test_both_job(spark, golden_file, tmp_path, staged):
    jobs.run(
        spark, "both", golden_file, str(tmp_path / "out"), staged=staged, scope="clean",
        style="combined", vcpus=5,
    )
    drivers = json_lines(tmp_path / "out" / "top_drivers_10")
    assert drivers[0] == {"hack_license": "H3", "money_per_min": 6.5}
    taxis = json_lines(tmp_path / "out" / "top_taxis_10")
    assert [t["medallion"] for t in taxis] == ["M1", "M2", "M3"]
    lines = text_lines(tmp_path / "out" / "results_summary")
    assert lines[0] == "('--- Job & Cluster ---', '')"
    assert lines[-2].startswith("('Task1 Runtime (seconds)', ")
    assert "('Total Records (filtered)', 10)" in lines
    assert "('Cluster Size (vCPUs)', 5)" in lines
    assert (tmp_path / "out" / "staging_parquet").exists() == staged


def test_job_without_valid_trips_reports_it(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\nc,d\n")
    jobs.run(spark, "best_hour", str(tmp_path / "in.csv"), str(tmp_path / "out"), layout="trip17")
    lines = text_lines(tmp_path / "out" / "results_summary")
    assert lines[:2] == ["('--- Best Hour Result ---', '')", "('No valid records found', '')"]


# Every kind of job the library answers: what is asked, and with which options.
JOBS = {
    "best hour, lines": ("best_hour", {}),
    "best hour, parquet": ("best_hour", {"fmt": "parquet", "pickup": "cut"}),
    "best hour, staged": ("best_hour", {"fmt": "csv_permissive", "staged": True, "pickup": "multi"}),
    "drivers, lines": ("top_drivers", {}),
    "drivers, parquet": ("top_drivers", {"fmt": "parquet"}),
    "drivers, staged": ("top_drivers", {"fmt": "csv_permissive", "staged": True, "style": "staged"}),
    "taxis, lines": ("top_taxis", {}),
    "taxis, parquet": ("top_taxis", {"fmt": "parquet"}),
    "taxis, lines, approx": (
        "top_taxis",
        {"method": "approx", "scope": "clean", "style": "short"},
    ),
    "taxis, staged, approx": (
        "top_taxis",
        {
            "fmt": "csv_permissive", "staged": True, "method": "approx", "scope": "clean",
            "style": "staged",
        },
    ),
    "both, csv": (
        "both",
        {"fmt": "csv", "infer": True, "method": "approx", "scope": "clean", "style": "combined"},
    ),
    "both, economic": ("both", {"scope": "clean"}),
}


@pytest.mark.parametrize("kind", JOBS)
def test_every_kind_of_job(spark, golden_file, golden_trips, tmp_path, kind):
    question, options = JOBS[kind]
    path = golden_file
    if options.get("fmt") == "parquet":
        path = sinks.stage_parquet(golden_trips, str(tmp_path / "in"))
    if options.get("fmt") == "csv_permissive":
        options = {**options, "layout": "trip17"}
    written = jobs.run(spark, question, path, str(tmp_path / "out"), **options)
    if question == "best_hour":
        best = (5, 2.53125) if options.get("pickup") == "multi" else (17, 1.25)
        assert json_lines(tmp_path / "out" / "best_hour") == [
            {"hour": best[0], "avg_ratio": best[1]}
        ]
    if "top_drivers" in written:
        drivers = [r["hack_license"] for r in json_lines(tmp_path / "out" / "top_drivers_10")]
        assert drivers == ["H3", "H4", "H5", "H2", "H1"]
    if "top_taxis" in written:
        taxis = [r["medallion"] for r in json_lines(tmp_path / "out" / "top_taxis_10")]
        clean = options.get("scope") == "clean"
        assert taxis == (["M1", "M2", "M3"] if clean else ["M3", "M1", "M2", "M5"])
    lines = text_lines(tmp_path / "out" / "results_summary")
    if options.get("style", "economic") == "economic":
        assert lines[0].startswith("('--- ") and "('Total Records', 14)" in lines
    if kind == "both, economic":
        headings = [line for line in lines if "---" in line]
        assert headings == [
            "('--- Top 10 Taxis ---', '')",
            "('--- Top 10 Drivers ---', '')",
            "('--- Economic Metrics ---', '')",
            "('--- Performance Metrics ---', '')",
        ]
    if options.get("style") == "staged":
        assert lines[1] == f"('CSV Input', '{path}')"
        assert lines[2] == f"('Staging Parquet', '{tmp_path}/out/staging_parquet')"
        assert "('Rows (filtered)', 10)" in lines


def test_jobs_refuse_what_they_do_not_know_before_they_write(spark, tmp_path):
    out = tmp_path / "out"
    for wrong in ({"question": "best_day"}, {"question": "both", "style": "loud"}):
        with pytest.raises(ValueError, match="unknown (question|style)"):
            jobs.run(spark, path=str(tmp_path / "none"), out_dir=str(out), **wrong)
    assert not out.exists()


def test_headings_name_the_number_of_places(spark, golden_trips):
    ranking = op.top_drivers(golden_trips, 3)
    labels = [r["label"] for r in op.result_lines(ranking, "top_drivers", 3).collect()]
    assert "--- Top 3 Drivers ---" in labels


REJECT_LINES = ["M1,H1", "M2", "a", *(["M3,H3" + ",0" * 19] * 2)]


@pytest.mark.parametrize("question", ["best_hour", "top_drivers", "top_taxis", "both"])
@pytest.mark.parametrize("fmt", ["lines", "csv", "csv_permissive"])
@pytest.mark.parametrize("staged", [False, True])
def test_rejects_are_counted_in_the_pass_that_parses(spark, tmp_path, monkeypatch, question, fmt, staged):
    """Headers are no records, and no second read measures the text."""
    from conftest import GOLDEN, HEADER

    def no_second_read(*args, **kwargs):
        raise AssertionError("the text is read again")

    monkeypatch.setattr(sources, "record_widths", no_second_read)
    monkeypatch.setattr(op, "line_widths", no_second_read)
    whole = [line for line in GOLDEN.splitlines() if line.count(",") == 16]
    for name, lines in (("a.csv", [*whole, *REJECT_LINES]), ("b.csv", whole[:3])):
        (tmp_path / name).write_text("\n".join([HEADER, *lines]) + "\n")
    written = jobs.run(
        spark, question, str(tmp_path) + "/*.csv", str(tmp_path / "out"), fmt=fmt, header=True,
        layout="trip17", scope="clean", staged=staged, rejects=True,
    )
    (found,) = json_lines(tmp_path / "out" / "rejects")
    records = len(whole) + 3 + len(REJECT_LINES)
    assert found["records_read"] == records
    assert (found["short_records"], found["wide_records"], found["extra_columns"]) == (3, 2, 0)
    dropped = len(REJECT_LINES) if fmt == "csv" else 0
    assert found["rows_raw"] == records - dropped
    assert found["rows_raw"] - found["rows_kept"] == found["rows_rejected"]
    plain = jobs.run(
        spark, question, str(tmp_path) + "/*.csv", str(tmp_path / "plain"), fmt=fmt, header=True,
        layout="trip17", scope="clean", staged=staged,
    )
    for name in set(plain) - {"summary"}:  # counting rejects changes no result
        assert sorted(map(str, spark.read.json(plain[name]).collect())) == sorted(map(str, spark.read.json(written[name]).collect()))


def test_counted_records_come_from_one_text_scan(spark, golden_file):
    trips = op.normalize(sources.read_trips(spark, golden_file, "csv", header=True, records=True), "trip17")
    groups, _ = op.counted_ranking(trips, "top_drivers")
    plan = op.grouped_facts(groups)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    facts = op.grouped_facts(groups).first().asDict()
    assert facts == op.run_facts(trips).first().asDict()
    assert facts["records_read"] == 14 and facts["short_records"] == 2


def test_rejects_of_parquet(spark, golden_trips):
    found = op.reject_facts(op.run_facts(golden_trips), 19).first().asDict()
    assert found == {
        "rows_raw": 14, "rows_kept": 10, "rows_rejected": 4, "records_read": 14, "short_records": 0,
        "wide_records": 0, "extra_columns": 2,
    }


@pytest.mark.parametrize("open_files", [2, 100])
def test_folders_are_written_without_a_sort(spark, tmp_path, monkeypatch, open_files):
    """Rows go to open files; folders past that number still have one file for each task and all their lines."""
    from pyspark.sql import DataFrameWriter

    key, seen, text = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda *a: seen.append(spark.conf.get(key)) or text(*a))
    before = spark.conf.get(key)
    lines = spark.range(0, 1000, 1, 3).selectExpr("id % 7 AS folder", "string(id) AS value").repartition("folder")
    path = sinks.write_text_folders(lines, str(tmp_path / "folders"), "folder", open_files)
    assert seen == [str(open_files)] and spark.conf.get(key) == before
    found = sources.input_folders(spark, path)
    assert sorted((r["folder"][-1], r["files"]) for r in found.collect()) == [(str(k), 1) for k in range(7)]
    assert {(int(r["value"]) % 7, r["folder"]) for r in spark.read.text(path).collect()} == {(k, k) for k in range(7)}
    assert spark.read.text(path).distinct().count() == 1000
