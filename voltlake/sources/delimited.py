"""Delimited files with a header, bound to a declared schema by column name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.functions.times import utc_time


def cast_value(value: Column, kind: T.DataType) -> Column:
    """Text to the declared type; text that does not fit becomes null, a time without a zone is UTC."""
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.TimestampType):
        return utc_time(value)
    return F.trim(value).try_cast(kind)


def bind_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types, whatever the order in ``df``."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    held = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            (F.col(f.name) if held[f.name] == f.dataType else cast_value(F.col(f.name), f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def empty_text(df: DataFrame, as_null: bool) -> DataFrame:
    """Empty text to null, or null text to empty, in all string columns."""

    def fix(name: str) -> Column:
        column = F.col(name)
        if as_null:
            return F.nullif(column, F.lit("")).alias(name)
        return F.coalesce(column, F.lit("")).alias(name)

    return df.select(
        *[
            fix(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema
        ]
    )


#: How texts without line breaks stand for those with them: a backslash is never followed by another letter.
ESCAPES = {"\\": "\\b", "\n": "\\n", "\r": "\\r"}


def _replaced(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    def fixed(name: str) -> Column:
        column = F.col(name)
        for old, new in pairs:
            column = F.replace(column, F.lit(old), F.lit(new))
        return column.alias(name)

    return df.select(*[fixed(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema])


def escape_text(df: DataFrame) -> DataFrame:
    """Line breaks and backslashes of all string columns written out."""
    return _replaced(df, list(ESCAPES.items()))  # backslashes first


def unescape_text(df: DataFrame) -> DataFrame:
    return _replaced(df, [(new, old) for old, new in reversed(ESCAPES.items())])  # backslashes last


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    names: dict[str, str] | None = None,
    empty_as_null: bool = False,
    sep: str = ";",
    multi_line: bool = False,
    escaped: bool = False,
) -> DataFrame:
    """A file, or all files of a folder, as one table.

    Spark binds a declared CSV schema by position, so everything is read as text under the
    header's names and cast by name. Files of one folder must share one header: a file with
    another one fails the read instead of swapping columns, and so does a line with too few or
    too many fields, whichever columns are asked for. ``names`` renames file columns.
    ``multi_line`` takes line breaks inside quotes; such files are read whole by one task each.
    ``escaped`` reads texts that ``write_table`` has escaped, whose files are split over tasks.
    """
    text = spark.read.options(
        sep=sep, header=True, quote='"', escape='"', enforceSchema=False, multiLine=multi_line,
        mode="FAILFAST", columnPruning=False,
    ).csv(path)
    renamed = (unescape_text(text) if escaped else text).withColumnsRenamed(names or {})
    return bind_by_name(empty_text(renamed, empty_as_null), schema)
