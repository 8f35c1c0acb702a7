"""DataFrame operators: shaping, rankings and run facts."""

from tripmetrics.operators.facts import (
    economics,
    input_bytes,
    line_facts,
    reject_facts,
    result_lines,
    run_facts,
    summary,
)
from tripmetrics.operators.rankings import (
    best_hour,
    both_rankings,
    both_rankings_shared,
    counted_ranking,
    driver_rates,
    grouped_facts,
    hourly_ratio,
    in_scope,
    merged_taxi_drivers,
    ranking_check,
    sketch_bound,
    sketch_error,
    taxi_driver_pairs,
    taxi_drivers,
    taxi_sketches,
    top,
    top_drivers,
    top_taxis,
    top_taxis_merged,
)
from tripmetrics.operators.shaping import (
    carried,
    conform,
    csv_fields,
    drop_header,
    extra_columns,
    is_generic,
    layout_for_width,
    line_widths,
    lines_to_columns,
    name_columns,
    normalize,
    preview,
    record,
    rename_layout,
    resolve_aliases,
    restore_names,
    settled_width,
    split_lines,
    two_field_lines,
    value_columns,
    widest_line,
)

__all__ = [
    "best_hour",
    "both_rankings",
    "both_rankings_shared",
    "carried",
    "counted_ranking",
    "conform",
    "csv_fields",
    "driver_rates",
    "grouped_facts",
    "drop_header",
    "economics",
    "extra_columns",
    "hourly_ratio",
    "in_scope",
    "input_bytes",
    "is_generic",
    "layout_for_width",
    "line_facts",
    "reject_facts",
    "line_widths",
    "merged_taxi_drivers",
    "ranking_check",
    "sketch_bound",
    "taxi_sketches",
    "top_taxis_merged",
    "lines_to_columns",
    "name_columns",
    "normalize",
    "preview",
    "record",
    "rename_layout",
    "resolve_aliases",
    "restore_names",
    "settled_width",
    "result_lines",
    "run_facts",
    "sketch_error",
    "split_lines",
    "summary",
    "taxi_driver_pairs",
    "taxi_drivers",
    "top",
    "top_drivers",
    "top_taxis",
    "two_field_lines",
    "value_columns",
    "widest_line",
]
