"""For each query, SQL that an independent engine runs on the same tables."""

from __future__ import annotations

from tripmetrics.schema import COST_PER_VCPU_MIN, TRIP17_NAMES

K = "CAST(regexp_extract(props, '[0-9]+') AS DOUBLE)"

TRIPS = """
    SELECT 'M' || l_suppkey AS medallion, 'H' || l_partkey AS hack_license,
           l_quantity * 60 AS trip_time_in_secs, l_extendedprice AS total_amount
    FROM lineitem
"""

# Which line items come out of the dirty text whole, and which of those are clean trips.
_D = "CAST(round(l_discount * 100) AS INTEGER)"
WHOLE = f"{_D} NOT IN (4, 6)"
ENDLESS = f"({_D} = 10 AND l_linenumber IN (1, 2, 3, 4))"
WIDE = f"({_D} = 10 AND l_linenumber = 5)"
CLEAN = f"({_D} NOT IN (0, 4, 5, 6, 7, 9) AND NOT {ENDLESS})"
DIRTY = f"""
    SELECT 'M' || l_suppkey AS medallion,
           CASE WHEN {_D} NOT IN (1, 6) THEN 'H' || l_partkey END AS hack_license,
           l_quantity * 60 AS trip_time_in_secs, l_extendedprice AS total_amount,
           {CLEAN} AS clean, {WIDE} AS wide
    FROM lineitem
"""


def _hourly(where: str) -> str:
    return f"""
        SELECT CAST(hour(ts) AS INTEGER) AS hour, round(avg({K} / value), 6) AS avg_ratio,
               count(*) AS trips
        FROM events WHERE value > 0 AND {where} GROUP BY 1
    """


def _best_hour() -> str:
    return f"""
        SELECT hour, avg_ratio FROM (
            SELECT CAST(hour(ts) AS INTEGER) AS hour, avg({K} / value) AS raw,
                   round(avg({K} / value), 6) AS avg_ratio
            FROM events WHERE value > 0 GROUP BY 1
        ) ORDER BY raw DESC, hour LIMIT 1
    """


def _rates(source: str, where: str = "true") -> str:
    return f"""
        SELECT hack_license, sum(total_amount) AS money,
               sum(trip_time_in_secs) / 60 AS minutes,
               sum(total_amount) / (sum(trip_time_in_secs) / 60) AS money_per_min
        FROM ({source}) WHERE hack_license IS NOT NULL AND {where} GROUP BY 1
    """


def _top_drivers(source: str, where: str = "true") -> str:
    return f"""
        SELECT hack_license, round(raw, 6) AS money_per_min
        FROM (SELECT hack_license, money_per_min AS raw FROM ({_rates(source, where)}))
        ORDER BY raw DESC, hack_license LIMIT 10
    """


def _taxis(source: str, where: str = "true") -> str:
    return f"""
        SELECT medallion, count(DISTINCT hack_license) AS num_drivers
        FROM ({source}) WHERE hack_license IS NOT NULL AND {where} GROUP BY 1
    """


def _top_taxis(source: str, where: str = "true") -> str:
    return f"{_taxis(source, where)} ORDER BY num_drivers DESC, medallion LIMIT 10"


def _both(place: bool, source: str = TRIPS, where: str = "true") -> str:
    number = "row_number() OVER (ORDER BY raw DESC, key)"
    columns = f"ranking, {'place, ' if place else ''}key, round(raw, 6) AS measure"
    return f"""
        WITH drivers AS (
            SELECT 'top_drivers' AS ranking, hack_license AS key, money_per_min AS raw
            FROM ({_rates(source, where)})
        ), taxis AS (
            SELECT 'top_taxis' AS ranking, medallion AS key, CAST(num_drivers AS DOUBLE) AS raw
            FROM ({_taxis(source, where)})
        ), placed AS (
            SELECT *, CAST({number} AS INTEGER) AS place FROM drivers
            UNION ALL SELECT *, CAST({number} AS INTEGER) AS place FROM taxis
        )
        SELECT {columns} FROM placed WHERE place <= 10
    """


def _more(good: str, bad: dict[int, str]) -> str:
    cases = " ".join(f"WHEN {_D} = 10 AND l_linenumber = {n} THEN '{b}'" for n, b in bad.items())
    return f"CASE {cases} ELSE {good} END"


def _dirty_cells(blank: str) -> dict[str, str]:
    """The text fields of the dirty lines; ``blank`` stands for an empty field."""
    day = "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')"
    cells = dict.fromkeys(TRIP17_NAMES, "'0'")
    cells.update(
        medallion="'M' || l_suppkey",
        hack_license=f"CASE {_D} WHEN 1 THEN {blank} ELSE 'H' || l_partkey END",
        pickup_datetime=f"CASE {_D} WHEN 3 THEN 'not-a-date' ELSE {day} END",
        dropoff_datetime=day,
        trip_time_in_secs=f"CASE {_D} WHEN 0 THEN 'abc' WHEN 7 THEN '0' WHEN 9 THEN 'nan' "
        f"ELSE {_more('CAST(l_quantity * 60 AS VARCHAR)', {1: 'inf', 4: '1e400'})} END",
        trip_distance=f"CASE {_D} WHEN 2 THEN 'nan' WHEN 8 THEN '0.0' "
        "ELSE CAST(l_quantity AS VARCHAR) END",
        payment_type="l_returnflag",
        surcharge=_more("CAST(l_tax AS VARCHAR)", {6: "inf", 7: "x"}),
        total_amount=f"CASE {_D} WHEN 5 THEN {blank} ELSE "
        f"{_more('CAST(l_extendedprice AS VARCHAR)', {2: 'inf', 3: '-inf'})} END",
    )
    return cells


def _dirty_table(blank: str, stray: int = 0) -> str:
    columns = [f"CASE WHEN {WIDE} THEN 'x' END AS _c{17 + k}" for k in range(stray)]
    for i, cell in enumerate(_dirty_cells(blank).values()):
        cut = {0: "false", 1: f"{_D} = 6"}.get(i, f"{_D} IN (4, 6)")
        columns.append(f"CASE WHEN {cut} THEN NULL ELSE {cell} END AS _c{i}")
    return f"SELECT {', '.join(columns)} FROM lineitem"


def _text_bytes() -> str:
    cells = list(_dirty_cells("''").values())
    whole = " || ',' || ".join(f"({c})" for c in cells)
    line = (
        f"CASE {_D} WHEN 4 THEN ({cells[0]}) || ',' || ({cells[1]}) WHEN 6 THEN {cells[0]} "
        f"ELSE {whole} || CASE WHEN {WIDE} THEN ',x,x,x,x' ELSE '' END END"
    )
    return f"""
        SELECT input_bytes, round(input_bytes / CAST(1073741824 AS DOUBLE), 9) AS input_gb
        FROM (SELECT CAST(sum(strlen({line}) + 1) AS BIGINT) AS input_bytes FROM lineitem)
    """


def _conform_missing() -> str:
    known = {
        "medallion": "'M' || l_suppkey",
        "hack_license": "'H' || l_partkey",
        "pickup_datetime": "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')",
        "dropoff_datetime": "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')",
        "trip_time_in_secs": "l_quantity * 60",
        "trip_distance": "l_quantity",
    }
    text = ("payment_type",)
    columns = [
        f"{known.get(n) or f'CAST(NULL AS {("VARCHAR" if n in text else "DOUBLE")})'} AS {n}"
        for n in TRIP17_NAMES
    ]
    return f"SELECT {', '.join(columns)} FROM lineitem"


RUNS = f"""
    SELECT *, CAST(records AS DOUBLE) / runtime_sec AS records_per_sec,
           cost_usd / input_gb AS cost_per_gb, cost_usd / records AS cost_per_record,
           records / cost_usd AS records_per_usd
    FROM (
        SELECT *, vcpus * (runtime_sec / 60.0) AS vcpu_minutes,
               vcpus * (runtime_sec / 60.0) * CAST({COST_PER_VCPU_MIN} AS DOUBLE) AS cost_usd,
               input_bytes / CAST(1073741824 AS DOUBLE) AS input_gb
        FROM (
            SELECT o_orderstatus AS run_id, count(*) AS rows_raw,
                   count(*) FILTER (WHERE o_totalprice > 100000) AS records,
                   CAST(sum(o_custkey) * 1000 AS BIGINT) AS input_bytes,
                   CAST(sum(o_orderkey) AS DOUBLE) / CAST(100000 AS DOUBLE) AS runtime_sec,
                   6 AS vcpus
            FROM orders GROUP BY 1
        )
    )
"""


# Report lines of each style as they have to read: label, figure, digits. Written out here, and
# not taken from the schema, so that a wrong label or order there shows.
REPORTS = {
    "economic": """
        --- Economic Metrics ---
        Estimated Cost (USD)|cost_usd|4
        Cost per GB Processed (USD/GB)|cost_per_gb|6
        Cost per Record (USD/record)|cost_per_record|10
        Cost Efficiency (records per $)|records_per_usd|2
        --- Performance Metrics ---
        Total Records|records
        Records per Second|records_per_sec|2
        Input Size (GB)|input_gb|4
        Runtime (seconds)|runtime_sec|2
        Cluster Size (vCPUs)|vcpus
        Staging Parquet|text staging
    """,
    "combined": """
        --- Job & Cluster ---
        Cluster Size (vCPUs)|vcpus
        Runtime (seconds)|runtime_sec|2
        --- Dataset ---
        Total Records (filtered)|records
        Input Size (GB)|input_gb|4
        Records per Second|records_per_sec|2
        --- Economics (rough) ---
        Estimated Cost (USD)|cost_usd|6
        Cost per GB Processed (USD/GB)|cost_per_gb|6
        Cost per Record (USD/record)|cost_per_record|12
        Cost Efficiency (records per $)|records_per_usd|2
        --- Task Timings ---
        Task1 Runtime (seconds)|taxis_sec|3
        Task2 Runtime (seconds)|drivers_sec|3
    """,
    "short": """
        Task|text task
        Runtime_sec|runtime_sec|2
        Task1_sec|taxis_sec|3
        Task2_sec|drivers_sec|3
        Rows_raw|rows_raw
        Rows_filtered|records
        Input_GB|input_gb|4
        vCPU_min_est|vcpu_minutes|2
        Cost_USD_est|cost_usd|6
        Records_per_sec|records_per_sec|2
        Output_JSON|text output_json
    """,
    "staged": """
        Task|text task
        CSV Input|text input_path
        Staging Parquet|text staging
        Rows (staged)|rows_raw
        Rows (filtered)|records
        Runtime (sec)|runtime_sec|2
        Task1 Sec|taxis_sec|3
        Task2 Sec|drivers_sec|3
        Records/sec|records_per_sec|2
        Input Size (GB)|input_gb|4
        vCPUs est.|vcpus
        Est. Cost (USD)|cost_usd|6
        Cost/GB|cost_per_gb|6
        Cost/Record|cost_per_record|12
        Cost Efficiency (records/$)|records_per_usd|2
        Output JSON|text output_json
    """,
}


def _summary(style: str) -> str:
    """All runs' reports, each line after its run and a tab."""
    quote = "''"
    lines = []
    for line in REPORTS[style].strip().splitlines():
        label, _, rest = line.strip().partition("|")
        figure, _, digits = rest.partition("|")
        if not figure:
            value = f"'{quote}{quote}'"
        elif figure.startswith("text "):
            value = f"'{quote}{figure[5:]} of ' || run_id || '{quote}'"
        else:
            value = f"CAST({f'round({figure}, {digits})' if digits else figure} AS VARCHAR)"
        lines.append(
            f"SELECT run_id || chr(9) || '(''{label}'', ' || {value} || ')' AS value FROM runs"
        )
    seconds = "rows_raw / 1000.0::DOUBLE AS taxis_sec, records / 1000.0::DOUBLE AS drivers_sec"
    return f"WITH runs AS (SELECT *, {seconds} FROM ({RUNS})) " + " UNION ALL ".join(lines)


def _hour_report() -> str:
    return f"""
        SELECT '(''Best Hour'', ' || hour || ')' AS value FROM ({_best_hour()})
        UNION ALL
        SELECT '(''Average Ratio'', ' || round(avg_ratio, 4) || ')' FROM ({_best_hour()})
        UNION ALL SELECT '(''Total Records'', ' || count(*) || ')' FROM events
    """


def _read_by_format() -> str:
    return f"""
        SELECT fmt, medallion, count(*) AS trips, round(sum(total_amount), 2) AS money
        FROM ({TRIPS}), (VALUES ('parquet'), ('csv'), ('csv_permissive'), ('lines')) AS f(fmt)
        GROUP BY 1, 2
    """


_FIELDS = f"CASE WHEN {_D} = 4 THEN 2 WHEN {_D} = 6 THEN 1 WHEN {WIDE} THEN 21 ELSE 17 END"


def _counted(where: str) -> str:
    return f"""
        SELECT medallion, count(*) AS trips, count(*) FILTER (WHERE clean) AS clean_trips
        FROM ({DIRTY}) WHERE {where} GROUP BY 1
    """


def _ranking_check(source: str, where: str = "true") -> str:
    """What an approximate top 10 within its bound looks like."""
    return f"""
        SELECT count(*) AS taxis, least(10, count(*)) AS ranked, CAST(0 AS BIGINT) AS off, false AS missed
        FROM ({_taxis(source, where)})
    """


REDUCED = f"SELECT * FROM ({TRIPS})"

REJECTS = f"""
        SELECT count(*) AS rows_raw, count(*) FILTER (WHERE {CLEAN}) AS rows_kept,
               count(*) FILTER (WHERE NOT ({CLEAN})) AS rows_rejected, count(*) AS records_read,
               count(*) FILTER (WHERE NOT ({WHOLE})) AS short_records,
               count(*) FILTER (WHERE {WIDE}) AS wide_records, CAST(0 AS BIGINT) AS extra_columns
        FROM lineitem
    """
STAGED = (
    f"SELECT medallion, count(*) AS trips, count(*) FILTER (WHERE clean) AS "
    f"clean_trips, count(hack_license) AS licenses, "
    f"round(sum(total_amount) FILTER (WHERE clean), 2) AS money FROM ({DIRTY}) GROUP BY 1"
)

ORACLES = {
    "best_hour": _best_hour(),
    "hourly_ratio": _hourly("true"),
    "best_hour_multi_format": _best_hour(),
    "hourly_ratio_multi_format": _hourly("true"),
    "hourly_ratio_cut_text": _hourly("event_type IN ('click', 'purchase')"),
    "hourly_ratio_strict_lines": _hourly("event_type = 'click'"),
    "best_hour_empty": "SELECT 0 AS hour, CAST(0 AS DOUBLE) AS avg_ratio FROM events "
    "WHERE value < 0 AND value > 0",
    "top_drivers": _top_drivers(TRIPS),
    "driver_rates": f"SELECT hack_license, CAST(round(money * 100) AS BIGINT) AS cents, "
    f"CAST(round(minutes * 60) AS BIGINT) AS seconds, round(money_per_min, 9) AS money_per_min "
    f"FROM ({_rates(TRIPS)})",
    "top_drivers_dirty_lines": _top_drivers(DIRTY, "clean"),
    "top_taxis_exact": _top_taxis(TRIPS),
    "taxi_drivers_exact": _taxis(TRIPS),
    "top_taxis_clean_scope": _top_taxis(DIRTY, "clean"),
    "top_taxis_dirty_lines": _top_taxis(DIRTY),
    "approx_error_bound": "SELECT count(DISTINCT l_suppkey) AS taxis, CAST(0 AS BIGINT) AS beyond "
    "FROM lineitem",
    "taxi_driver_pairs": f"SELECT DISTINCT medallion, hack_license FROM ({TRIPS})",
    "both_rankings": _both(place=True),
    "both_rankings_two_tables": _both(place=False),
    "lines_to_columns": _dirty_table("''", stray=4),
    "two_field_lines": f"SELECT CASE WHEN {_D} = 4 THEN 2 WHEN {WIDE} THEN 21 ELSE 17 END AS fields, "
    f"count(*) AS lines FROM lineitem WHERE {_D} <> 6 GROUP BY 1",
    "widest_line": f"SELECT max({_FIELDS}) AS widest FROM lineitem",
    "line_facts": f"SELECT count(*) AS lines, count(*) FILTER (WHERE NOT ({WHOLE})) AS short_lines, "
    f"count(*) FILTER (WHERE {WHOLE} AND NOT {WIDE}) AS full_lines, "
    f"count(*) FILTER (WHERE {WIDE}) AS wide_lines, max({_FIELDS}) AS widest FROM lineitem",
    "parse_numbers": f"SELECT CAST(l_orderkey AS VARCHAR) AS order_text, l_linenumber, "
    f"CASE {_D} WHEN 7 THEN 0.0 ELSE l_quantity * 60 END AS secs, l_quantity AS distance, "
    f"l_extendedprice AS total FROM lineitem WHERE {_D} NOT IN (0, 2, 5, 8, 9) AND NOT {ENDLESS}",
    "layout_trip17": REDUCED,
    "layout_classic21": REDUCED,
    "layout_classic20": REDUCED,
    "layout_classic17": REDUCED,
    "alias_columns": REDUCED,
    "conform_missing": _conform_missing(),
    "conform_extra": "SELECT 'M' || l_suppkey AS medallion, 'H' || l_partkey AS hack_license, "
    "l_quantity * 60 AS trip_time_in_secs, l_extendedprice AS total_amount, "
    "l_quantity AS trip_distance, l_tax AS surcharge FROM lineitem",
    "preview": f"{REDUCED} ORDER BY medallion, hack_license, trip_time_in_secs, total_amount "
    "LIMIT 1",
    "csv_permissive": _dirty_table("NULL"),
    "csv_drop_malformed": f"SELECT medallion, hack_license, trip_time_in_secs, total_amount "
    f"FROM ({DIRTY}) WHERE clean AND NOT wide",
    "csv_quality": f"SELECT count(*) FILTER (WHERE {WHOLE} AND NOT {WIDE}) AS good_rows, "
    f"count(*) FILTER (WHERE NOT ({WHOLE}) OR {WIDE}) AS malformed_rows, CAST(0 AS BIGINT) AS keyless_rows "
    "FROM lineitem",
    "csv_header_inferred": "SELECT 'M' || l_suppkey || ',' || l_returnflag AS medallion, "
    "'H' || l_partkey AS hack_license, l_quantity * 60 AS trip_time_in_secs, "
    "l_extendedprice AS total_amount FROM lineitem",
    "read_by_format": _read_by_format(),
    "stage_parquet": STAGED,
    "ranking_json": _top_drivers(TRIPS),
    "run_facts": f"SELECT count(*) AS rows_raw, count(*) FILTER (WHERE {CLEAN}) AS rows_kept, "
    f"count(*) FILTER (WHERE NOT ({CLEAN})) AS rows_rejected FROM lineitem",
    "input_bytes_text": _text_bytes(),
    "run_economics": f"SELECT run_id, rows_raw, records, round(vcpu_minutes, 4) AS vcpu_minutes, "
    f"round(cost_usd, 6) AS cost_usd, round(input_gb, 6) AS input_gb, "
    f"round(records_per_sec, 4) AS records_per_sec, round(cost_per_gb, 6) AS cost_per_gb, "
    f"round(cost_per_record, 10) AS cost_per_record, round(records_per_usd, 2) AS records_per_usd "
    f"FROM ({RUNS})",
    "summary_text": _summary("economic"),
    "summary_combined": _summary("combined"),
    "summary_short": _summary("short"),
    "summary_staged": _summary("staged"),
    "job_both_rankings": _both(place=False, source=DIRTY, where="clean"),
    "job_staged_drivers": _top_drivers(DIRTY, "clean"),
    "job_best_hour_report": _hour_report(),
    "hourly_ratio_dirty_lines": f"""
        SELECT CAST(hour(l_shipdate) AS INTEGER) AS hour,
               round(avg(l_tax / l_quantity), 6) AS avg_ratio, count(*) AS trips
        FROM lineitem
        WHERE {_D} NOT IN (2, 3, 4, 6, 8) AND NOT ({_D} = 10 AND l_linenumber IN (6, 7)) GROUP BY 1
    """,
    "csv_first_record_wide": _counted("NOT wide"),
    "csv_first_record_short": _counted("true"),
    "lines_one_wide_line": _top_drivers(DIRTY, "clean"),
    "conform_unknown_first_name": "SELECT 'M' || l_suppkey AS medallion, 'H' || l_partkey AS "
    "hack_license, l_quantity * 60 AS trip_time_in_secs, l_extendedprice AS total_amount, "
    "l_quantity AS trip_distance FROM lineitem",
    "job_rejects_csv": f"""
        SELECT count(*) FILTER (WHERE {WHOLE} AND NOT {WIDE}) AS rows_raw,
               count(*) FILTER (WHERE {CLEAN} AND NOT {WIDE}) AS rows_kept,
               count(*) FILTER (WHERE {WHOLE} AND NOT {WIDE} AND NOT {CLEAN}) AS rows_rejected, count(*) AS records_read,
               count(*) FILTER (WHERE NOT ({WHOLE})) AS short_records,
               count(*) FILTER (WHERE {WIDE}) AS wide_records, CAST(0 AS BIGINT) AS extra_columns
        FROM lineitem
    """,
    "job_rejects_staged": REJECTS,
    "csv_many_quoted_fields": "SELECT (s_nationkey + 1) * 800 AS width, count(*) AS lines FROM supplier GROUP BY 1",
    "input_bytes": "SELECT count(DISTINCT l_returnflag) AS files, count(*) * 21 AS input_bytes, "
    "round(count(*) * 21 / CAST(1073741824 AS DOUBLE), 9) AS input_gb FROM lineitem",
    "input_bytes_by_folder": "SELECT strftime(l_shipdate, '%Y%m') AS month, 1 AS files, "
    "CAST(sum(strlen(CAST(l_orderkey AS VARCHAR)) + 1) AS BIGINT) AS bytes FROM lineitem GROUP BY 1",
    "stage_parquet_sized": STAGED,
    "stage_by_day": _hourly("true"),
    "read_staged_days": _hourly("ts >= '2024-01-10' AND ts < '2024-01-13'"),
    "job_rejects": REJECTS,
    "taxi_drivers_within_bound": "SELECT medallion, num_drivers, true AS within_bound "
    f"FROM ({_taxis(DIRTY, 'clean')})",
    "both_shared_within_bound": f"""
        SELECT 'top_taxis' AS ranking, medallion AS key, CAST(num_drivers AS DOUBLE) AS measure,
               CAST(NULL AS DOUBLE) AS minutes, true AS within_bound
        FROM ({_taxis(DIRTY, 'clean')})
        UNION ALL SELECT 'top_drivers', hack_license, round(money, 2), minutes, true FROM ({_rates(DIRTY, 'clean')})
        UNION ALL SELECT 'top_taxis', NULL, least(10, count(*)), NULL, true FROM ({_taxis(DIRTY, 'clean')})
        UNION ALL SELECT 'top_drivers', NULL, least(10, count(*)), NULL, true FROM ({_rates(DIRTY, 'clean')})
    """,
    "top_taxis_approx_within_bound": _ranking_check(TRIPS),
    "sketches_merged_within_bound": "SELECT medallion, num_drivers, true AS within_bound "
    f"FROM ({_taxis(DIRTY, 'clean')})",
    "job_top_taxis_of_batches": _ranking_check(DIRTY, "clean"),
    "top_drivers_null_keys": f"""
        SELECT hack_license, round(raw, 6) AS money_per_min FROM (
            SELECT nullif(hack_license, 'H1') AS hack_license,
                   sum(total_amount) / (sum(trip_time_in_secs) / 60) AS raw
            FROM ({DIRTY}) WHERE clean GROUP BY 1
        ) ORDER BY raw DESC, hack_license LIMIT 100
    """,
    "top_taxis_null_keys": f"""
        SELECT CASE WHEN medallion NOT LIKE 'M1%' THEN medallion END AS medallion,
               count(DISTINCT hack_license) AS num_drivers
        FROM ({DIRTY}) WHERE hack_license IS NOT NULL GROUP BY 1
        ORDER BY num_drivers DESC, 1 LIMIT 10
    """,
}
