"""Shared pieces of the text operators.

Row identity. ``doc_id`` may be null or repeated, so operators that must bring
a decision back to a row use the pair (doc_id, xxhash64(text)): rows that agree
in both are interchangeable, and get the same decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.session import ensure_checkpoint_dir, materialize, read_table, ship_package

# The white space and letters that the contracts name.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

__all__ = ["WHITE", "WORD", "UPPER", "ascii_lower", "ensure_checkpoint_dir", "let", "line_key", "materialize",
           "packed", "read_table", "ready", "shuffle_width", "text_id", "unpacked"]


#: rows here are whole texts: Arrow batches of Spark's 10,000 rows would take 100 MB and more on both sides
ARROW_ROWS = 1000


def ready(spark: SparkSession) -> None:
    """Checkpoint folder registered, package importable in Python workers, Arrow
    batches of at most ``ARROW_ROWS`` rows."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_id(text: Column) -> Column:
    """Second half of a row's identity; null and empty texts count as equal."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, nothing else. ``lower`` does the same, faster, where
    the string is ASCII (as many bytes as code points)."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda variable
    is bound, where an inlined expression would be evaluated at each use."""
    return F.transform(F.array(value), body)[0]


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """(row, needed...): the columns that the operator reads, and all others of the
    caller in one struct, so that an operator's own columns cannot clash with them. No
    column stands there twice."""
    names = {c.lower(): c for c in docs.columns}
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in needed]
    return docs.select(F.struct(*others or [F.lit(None).cast("int").alias("none")]).alias("row"),
                       *[F.col(f"`{names[c]}`").alias(c) for c in needed])


def unpacked(rows: DataFrame, docs: DataFrame, text: Column | None = None, changed: Column | None = None) -> DataFrame:
    """The columns of ``docs`` out of ``packed`` rows; where ``changed``, with ``text`` as
    the new text and n_chars (if there) counted anew."""
    inside, out = set(rows.schema["row"].dataType.names), []
    for field in docs.schema.fields:
        value = F.col("row").getField(field.name) if field.name in inside else F.col(field.name.lower())
        if text is not None and field.name.lower() == "text":
            value = F.when(changed, text).otherwise(value)
        if text is not None and field.name.lower() == "n_chars":
            value = F.when(changed, F.char_length(text).cast(field.dataType)).otherwise(value)
        out.append(value.alias(field.name))
    return rows.select(*out)
