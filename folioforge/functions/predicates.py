"""Row predicates of the audit (F1-F9) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .strings import col_


def valid_folio(c) -> Column:
    """non-empty and not starting with ERROR or HUERFANO."""
    c = col_(c)
    return c.isNotNull() & (c != "") & ~c.startswith("ERROR") & ~c.startswith("HUERFANO")


def known_client(c) -> Column:
    """non-empty and not 'NO DETECTADO'."""
    c = col_(c)
    return c.isNotNull() & (c != "") & (c != C.NOT_DETECTED)


def valid_rotation(c) -> Column:
    """rotation in {0, 90, 180, 270}."""
    return col_(c).isin(*C.ROTATIONS)


def valid_confidence(c) -> Column:
    """confidence within 0..100."""
    return col_(c).between(0, 100)


def valid_role(c) -> Column:
    """page role in the five-role domain."""
    return col_(c).isin(*C.ROLES)


def unsafe_category(c) -> Column:
    """category with '..', '/' or '\\' is refused before cleaning."""
    c = col_(c)
    return c.contains("..") | c.contains("/") | c.contains("\\")


def status_of(confidence) -> Column:
    """F8: 'OK' when confidence > 80, else 'REVISIÓN MANUAL'."""
    return F.when(col_(confidence) > C.OK_THRESHOLD, F.lit(C.STATUS_OK)).otherwise(F.lit(C.STATUS_REVIEW))
