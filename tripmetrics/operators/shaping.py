"""Bring any trip table to a known layout: lines to columns, names, types."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmetrics.schema import (
    ALIASES,
    CLASSIC21,
    LAYOUTS,
    RECORD,
    REDUCED4,
    REQUIRED,
    TRIP17,
    TRIP17_NAMES,
)

_GENERIC = re.compile(r"_c\d+$")
_KNOWN = {*TRIP17_NAMES, *CLASSIC21, *(alias for names in ALIASES.values() for alias in names)}


# ---------------------------------------------------------------- text lines


def drop_header(lines: DataFrame, header: str | None) -> DataFrame:
    """Drop every line equal to the header line; keep all lines when there is none."""
    if header is None:
        return lines
    return lines.filter(F.col("value") != F.lit(header))


def fields() -> Column:
    """The comma-separated fields of ``value``, empty ones included, quotes not special."""
    return F.split(F.col("value"), ",", -1)


def split_lines(lines: DataFrame) -> DataFrame:
    """One row per line with its fields as the array column ``parts``.

    The split goes through a one-element explode on purpose. As a plain
    projection it would be copied into every filter that is pushed down to the
    text scan, and each line would be split once per filter term.
    """
    return lines.select(F.explode(F.array(fields())).alias("parts"))


def two_field_lines(lines: DataFrame) -> DataFrame:
    """Field arrays of the lines that have at least two fields."""
    return split_lines(lines).filter(F.size("parts") >= 2)


def widest_line(lines: DataFrame) -> DataFrame:
    """One row, ``widest``: the largest number of fields on a line."""
    return lines.agg(F.max(F.size(fields())).alias("widest"))


def line_widths(lines: DataFrame) -> DataFrame:
    """``width`` and ``lines``: how many lines have how many fields."""
    return lines.groupBy(F.size(fields()).alias("width")).agg(F.count(F.lit(1)).alias("lines"))


def settled_width(widths: DataFrame) -> int | None:
    """The one width that lines agree on, short lines aside; None without lines.

    Short lines can be padded. But if some lines are wider than most, taking the
    widest would name all columns by those few lines, and taking another would
    cut fields, so that is an error that lists the counts: give a layout.
    """
    # A row for each width; a table has few, and a handful is enough to tell.
    common = widths.orderBy(F.desc("lines"), F.desc("width")).limit(20).collect()
    if not common:
        return None
    width, widest = common[0]["width"], widths.agg(F.max("width")).first()[0]
    if widest > width:
        counts = {row["width"]: row["lines"] for row in common}
        raise ValueError(
            f"lines disagree in width, {widest} at most, most often {width} (lines by width: "
            f"{counts}); give a layout or a width"
        )
    return width


def csv_fields(value: str | Column) -> Column:
    """The number of fields of a CSV record, commas between quotes not counted.

    Quoted stretches are taken out whole, an unclosed one to the end, and the commas that are left
    are counted: one pass over the record, however many fields it has.
    """
    outside = F.regexp_replace(value, '"[^"]*("|\\z)', "")
    return (F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1).cast("int")


def record(fields: Column, dropped: Column | None = None) -> Column:
    """The column that says what record a row came from."""
    dropped = F.lit(False) if dropped is None else dropped
    return F.struct(fields.cast("int").alias("fields"), dropped.alias("dropped")).alias(RECORD)


def value_columns(df: DataFrame) -> list[str]:
    """The columns of a table without what is said of its records."""
    return [c for c in df.columns if c != RECORD]


def carried(df: DataFrame) -> list[str]:
    """The column about records, where there is one."""
    return [c for c in df.columns if c == RECORD]


def lines_to_columns(
    lines: DataFrame, width: int | None = None, blank_as_null: bool = False, records: bool = False
) -> DataFrame:
    """Text lines as the rectangular string table ``_c0 .. _cN``, short lines padded with null.

    With ``records`` the number of fields of each line goes along.

    Without ``width`` the widest line sets it, which costs one pass over the
    text; give it whenever the layout is known. With ``blank_as_null`` empty
    fields become null, as they do in the CSV reader.
    """
    if width is None:
        width = widest_line(lines).first()["widest"] or len(TRIP17_NAMES)
    cells = [F.get("parts", F.lit(i)) for i in range(width)]
    if blank_as_null:
        cells = [F.nullif(c, F.lit("")) for c in cells]
    about = [record(F.size("parts"))] if records else []
    return split_lines(lines).select(*[c.alias(f"_c{i}") for i, c in enumerate(cells)], *about)


# -------------------------------------------------------------------- layouts


def is_generic(df: DataFrame) -> bool:
    """All columns are called ``_c0, _c1, ...``: the file had no usable names."""
    names = value_columns(df)
    return bool(names) and all(_GENERIC.match(c) for c in names)


def layout_for_width(width: int) -> str | None:
    """Layout by column count: 21 or more, 20, 17, else none fits.

    Seventeen columns mean ``trip17``; ``classic17`` has to be asked for.
    """
    if width >= 21:
        return "classic21"
    return {20: "classic20", 17: "trip17"}.get(width)


def rename_layout(df: DataFrame, layout: str) -> DataFrame:
    """Name the columns by position; columns past the layout keep their names."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}, expected one of {sorted(LAYOUTS)}")
    names, least = LAYOUTS[layout]
    have = value_columns(df)
    if len(have) < least:
        raise ValueError(f"layout {layout} needs {least} columns, the input has {len(have)}")
    return df.toDF(*names, *have[len(names) :], *carried(df))


def restore_names(df: DataFrame, positional: bool = False) -> DataFrame:
    """Name columns by position when no name is a known one.

    Names of any layout and accepted aliases are known: a table with even one of
    them has names of its own and is left alone, wherever its columns stand. Without
    any, a table as wide as a layout (17, 20 or 21 columns) is taken for that layout. At another
    width the names are an error, unless ``positional`` says that the columns are
    those of trip17 in order: fewer columns then get the first names, extra columns are
    dropped (``extra_columns`` tells how many).
    """
    names = value_columns(df)
    if any(name.lower() in _KNOWN for name in names):
        return df
    layout = layout_for_width(len(names)) if len(names) <= len(CLASSIC21) else None
    if layout and not positional:
        return rename_layout(df, layout)
    if not positional:
        raise ValueError(
            f"none of the {len(names)} columns {names[:30]} has a known name, and no layout has that many; "
            "name the columns, give a layout, or say positional=True for trip17 in order"
        )
    kept = len(names) - extra_columns(df)
    # toDF first: the old names may repeat, so they cannot be selected by name.
    by_position = df.toDF(*[f"_p{i}" for i in range(len(names))], *carried(df))
    return by_position.select(
        *[F.col(f"_p{i}").alias(name) for i, name in enumerate(TRIP17_NAMES[:kept])], *carried(df)
    )


def name_columns(df: DataFrame, layout: str | None = None, positional: bool = False) -> DataFrame:
    """Known names for any trip table, without touching its values.

    Generic columns are named by ``layout``, or by their number when none is
    given; a table without any known name by ``restore_names``.
    """
    if is_generic(df):
        layout = layout or layout_for_width(len(value_columns(df)))
        if layout:
            return rename_layout(df, layout)
    return restore_names(df, positional)


def extra_columns(df: DataFrame) -> int:
    """Columns past the trip17 width."""
    return max(0, len(value_columns(df)) - len(TRIP17_NAMES))


def conform(df: DataFrame, schema: StructType = TRIP17, positional: bool = False) -> DataFrame:
    """Exactly the columns and types of ``schema``: restored names, aliases resolved,
    typed nulls for what is missing; values that do not fit their type become null."""
    named = restore_names(df, positional)
    found = _by_alias(named, schema.fieldNames())

    def source(target: StructField) -> Column:
        name = found[target.name]
        return F.lit(None) if name is None else F.col(f"`{name}`")

    return named.select(*[_convert(source(f), f).alias(f.name) for f in schema], *carried(df))


def _by_alias(df: DataFrame, names: Iterable[str]) -> dict[str, str | None]:
    """The column of ``df`` that stands for each name, by the alias table, ignoring case."""
    seen = {c.lower(): c for c in df.columns}
    return {
        name: next((seen[a] for a in ALIASES.get(name, (name,)) if a in seen), None)
        for name in names
    }


def _convert(c: Column, target: StructField) -> Column:
    if isinstance(target.dataType, StringType):
        return c.cast("string")
    return c.try_cast(target.dataType)


# -------------------------------------------------------------------- aliases


def resolve_aliases(df: DataFrame) -> dict[str, str]:
    """Canonical name -> column of ``df``, by the alias table, ignoring case.

    Raises ``ValueError`` that lists every required column that is missing.
    """
    found = _by_alias(df, ALIASES)
    missing = [name for name in REQUIRED if found[name] is None]
    if missing:
        raise ValueError(f"missing required columns {missing}; the input has {df.columns}")
    return found


def normalize(df: DataFrame, layout: str | None = None) -> DataFrame:
    """Any accepted input as the four typed columns of REDUCED4.

    Generic columns are named by ``layout``, or by their number when none is
    given; then the required columns are found by alias and typed.
    """
    if is_generic(df):
        layout = layout or layout_for_width(len(value_columns(df)))
        if layout:
            df = rename_layout(df, layout)
    found = resolve_aliases(df)
    return df.select(
        *[_convert(F.col(f"`{found[f.name]}`"), f).alias(f.name) for f in REDUCED4], *carried(df)
    )


def preview(df: DataFrame, *order: str) -> DataFrame:
    """The first row, for a look at names and values; by ``order`` when given."""
    return (df.orderBy(*order) if order else df).limit(1)
