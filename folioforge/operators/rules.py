"""Rule analyzer: the model's stated rules as deterministic operators.

P7 page role by anchors, P8 document page order, P9 segmentation, P10/J4
type by folio prefix, P11 double type, P12 labelled field extraction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import strings as S
from .scans import next_value, prev_value, running_sum

ROLE_RANK = {"INICIO": 0, "UNICA": 0, "INTERMEDIA": 1, "CIERRE": 2, "HUERFANA": 3}


def has_any(text, phrases: list[str]) -> F.Column:
    """True when the lower-cased text contains any lower-cased phrase (whole text)."""
    t = F.lower(S.col_(text))
    return F.exists(F.array(*[F.lit(p.lower()) for p in phrases]), lambda a: F.contains(t, a))


def page_roles(pages: DataFrame, part_cols: list[str], order_col: str,
               header_col: str = "has_header", footer_col: str = "has_footer",
               block: int = 4096) -> DataFrame:
    """INICIO (header), CIERRE (footer), UNICA (both); a page with neither
    is INTERMEDIA when the previous anchored page is an INICIO and the next is
    a CIERRE, else HUERFANA. Prev/next anchors come from blocked scans."""
    h, f = F.col(header_col), F.col(footer_col)
    anchor = (F.when(h & f, F.lit("UNICA")).when(h, F.lit("INICIO")).when(f, F.lit("CIERRE")))
    d = pages.withColumn("_anchor", anchor)
    d = prev_value(d, part_cols, order_col, "_anchor", "_prev", block)
    d = next_value(d, part_cols, order_col, "_anchor", "_next", block)
    role = F.coalesce(F.col("_anchor"),
                      F.when((F.col("_prev") == "INICIO") & (F.col("_next") == "CIERRE"), F.lit("INTERMEDIA"))
                      .otherwise(F.lit("HUERFANA")))
    return d.withColumn("role", role).drop("_anchor", "_prev", "_next")


def segments(roles: DataFrame, part_cols: list[str], order_col: str, block: int = 4096) -> DataFrame:
    """A start (INICIO or UNICA) opens a document: running count of starts."""
    d = roles.withColumn("_start", F.col("role").isin("INICIO", "UNICA").cast("long"))
    return running_sum(d, part_cols, order_col, "_start", "segment", block).drop("_start")


def role_rank(role) -> F.Column:
    """Sort rank INICIO -> INTERMEDIA* -> CIERRE."""
    c = S.col_(role)
    expr = F.lit(3)
    for name, rank in sorted(ROLE_RANK.items(), key=lambda kv: -kv[1]):
        expr = F.when(c == name, F.lit(rank)).otherwise(expr)
    return expr


def folio_prefix(folio) -> F.Column:
    """First letter anywhere in the folio, upper-cased ('' when none)."""
    return F.upper(F.regexp_extract(S.col_(folio), r"(\p{L})", 1))


def prefix_rules(spark, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    rows = rules if rules is not None else C.PREFIX_SEEDS
    return spark.createDataFrame(rows, "prefix string, rule_type string")


def prefix_type(items: DataFrame, rules: DataFrame) -> DataFrame:
    """P10 + J4: when no category is readable, the folio prefix decides the type.

    ``rules`` is the prefix table (one row per letter: bounded by the
    alphabet), so it is broadcast.
    """
    d = items.withColumn("prefix", folio_prefix("folio"))
    d = d.join(F.broadcast(rules), "prefix", "left")
    readable = F.size(F.filter(F.transform(F.split(F.coalesce("categoria", F.lit("")), ","),
                                           lambda x: S.strip_ws(x)), lambda x: x != "")) > 0
    return d.withColumn("tipo", F.when(readable, F.col("categoria"))
                        .otherwise(F.coalesce("rule_type", F.lit(C.NOT_IDENTIFIED))))


def double_type(text, types: list[str] | None = None) -> F.Column:
    """Every type with evidence in the text, joined with ', ' in catalogue order."""
    cats = list(types or C.CATEGORIES)
    t = F.lower(S.col_(text))
    return F.array_join(F.filter(F.array(*[F.lit(c) for c in cats]), lambda c: F.contains(t, F.lower(c))), ", ")


# Fixed label patterns of the header fields (case-insensitive).
FIELD_PATTERNS = {
    "folio": r"(?i)\bfolio\s*[:#]?\s*([A-Za-z]{0,3}-?\d+)",
    "cliente": r"(?i)\bcliente\s*:\s*([^\n,;]+)",
    "rfc": r"(?i)\brfc\s*:\s*([A-Za-z&]{3,4}\d{6}[A-Za-z0-9]{3})",
}


def extract_field(text, name: str) -> F.Column:
    """First labelled value of a header field, or NULL."""
    v = F.regexp_extract(S.col_(text), FIELD_PATTERNS[name], 1)
    return F.when(v == "", F.lit(None)).otherwise(S.strip_ws(v))


def extract_all(text, name: str, patterns: dict[str, str] | None = None) -> F.Column:
    """All labelled values of a header field, distinct, in order of the text
    (array<string>). ``patterns`` overrides the label patterns (group 1 is the value)."""
    pattern = {**FIELD_PATTERNS, **(patterns or {})}[name]
    found = F.regexp_extract_all(S.col_(text), F.lit(pattern), F.lit(1))
    return F.array_distinct(F.filter(F.transform(F.coalesce(found, F.array().cast("array<string>")), S.strip_ws),
                                     lambda x: x != ""))
