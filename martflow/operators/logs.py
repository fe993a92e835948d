"""App logs: parse, reject, split into start, page and display records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow import schemas

CORRUPT = "_corrupt"


def _parsed(lines: DataFrame, column: str, schema: T.StructType, name: str) -> DataFrame:
    """Add a column of records, parsed from JSON text.

    Numbers come as numbers or as text, so all values are read as text and cast
    afterwards; what cannot be cast is null.  The explode is a fence: a filter
    that is pushed below the projection would parse and cast the text again for
    every field it looks at.
    """
    texts = T.StructType(
        schemas.as_text(schema).fields + [T.StructField(CORRUPT, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    target = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    cast = F.from_json(column, texts, options).try_cast(target)
    return lines.select("*", F.explode(F.array(cast)).alias(name))


def parse_text(
    lines: DataFrame, schema: T.StructType, column: str = "value"
) -> DataFrame:
    """JSON text to typed columns; text that is no such record becomes nulls.

    Other columns of ``lines`` are kept.
    """
    kept = [c for c in lines.columns if c != column]
    parsed = _parsed(lines, column, schema, "_r")
    return parsed.select(*kept, *[F.col("_r")[f].alias(f) for f in schema.names])


def checked_lines(lines: DataFrame) -> DataFrame:
    """Log lines (``value`` text) with their records, parsed once for both uses.

    Keep it (``persist``, or a written table) and take :func:`records_of` and
    :func:`rejects_of` from it.
    """
    parsed = _parsed(lines, "value", schemas.PAGE, "_r")
    usable = (
        F.col(f"_r.{CORRUPT}").isNull()
        & F.col("_r.common.mid").isNotNull()
        & F.col("_r.ts").isNotNull()
    )
    return parsed.withColumn("_usable", F.coalesce(usable, F.lit(False)))


def records_of(checked: DataFrame) -> DataFrame:
    """The records among checked lines, and other columns than ``value``."""
    kept = [c for c in checked.columns if c not in ("value", "_r", "_usable")]
    fields = [F.col("_r")[f].alias(f) for f in schemas.PAGE.names]
    return checked.where("_usable").select(*kept, *fields)


def rejects_of(checked: DataFrame) -> DataFrame:
    """The checked lines that are no records, as they came."""
    return checked.where("NOT _usable").drop("_r", "_usable")


def parse_log(lines: DataFrame) -> DataFrame:
    """Log lines (``value`` text) to records; see :func:`rejected_lines`.

    Columns of ``lines`` other than ``value`` are kept.  A device id and a time
    are required, everything else may be missing.
    """
    return records_of(checked_lines(lines))


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines :func:`parse_log` leaves out, as they came."""
    return rejects_of(checked_lines(lines))


def is_start() -> Column:
    # size() of a null map is null or -1, depending on the session.
    return F.coalesce(F.size("start") > 0, F.lit(False))


def split_start(records: DataFrame) -> DataFrame:
    """Start records; downstream only the ``start`` object matters."""
    return records.where(is_start())


def split_page(records: DataFrame) -> DataFrame:
    """Every record that is no start record, whole."""
    return records.where(~is_start())


def split_display(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per displayed item, with the page it was displayed on.

    Displays of start records do not count.  ``keep`` names columns of the
    record to carry along; by default none is.
    """
    shown = split_page(records).select(
        *(keep or []),
        F.explode("displays").alias("display"),
        F.col("page.page_id").alias("page_id"),
    )
    return shown.select(*(keep or []), "display.*", "page_id")
