"""Text semantics of the audit, as JVM-side Column expressions.

Python's ``str.strip``, ``str.isalnum``, ``re``'s ``\\w``/``\\s`` and
``pathlib``'s ``name``/``stem``/``suffix`` are re-expressed once here with Java
regular expressions so that every operator keeps to whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

# Python's whitespace (str.isspace) as an explicit class; Java's \s is ASCII only.
WS = (r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
# The same set as literal characters, for btrim (no regex on the hot path).
WS_CHARS = "".join(chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                                     *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
# Python's isalnum() plus the underscore: letters and numbers of any script.
WORD = r"\p{L}\p{N}_"
# Characters that are certainly kept by folio_key / folder_name (fast path, no regex).
_ASCII_WORD = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_"
_LATIN1_LETTERS = "".join(chr(c) for c in [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """``str.strip()``: remove Python whitespace from both ends."""
    return F.btrim(col_(c), F.lit(WS_CHARS))


def strip_quotes(c) -> Column:
    """``str.strip("'\\"")``."""
    return F.regexp_replace(col_(c), "^['\"]+|['\"]+$", "")


def clean_name(c) -> Column:
    """Model-returned file name: whitespace, then quotes, stripped (no lower)."""
    return strip_quotes(strip_ws(c))


def basename(c) -> Column:
    """``PurePath(x).name``: last non-empty path component."""
    return F.regexp_extract(col_(c), r"(?s)([^/]*)/*$", 1)


def stem(c) -> Column:
    """``PurePath(x).stem``: basename without its last suffix (a leading dot is no suffix)."""
    return F.regexp_replace(basename(c), r"(?s)^(.+)\.[^.]+$", "$1")


def suffix(c) -> Column:
    """``PurePath(x).suffix`` (empty when there is none)."""
    return F.regexp_extract(basename(c), r"(?s)^.+(\.[^.]+)$", 1)


def _only(c: Column, chars: str) -> Column:
    """True when every character of c is in ``chars`` (translate, no regex)."""
    return F.translate(c, chars, "") == ""


def folio_chars(c) -> Column:
    """Keep letters, digits, '-' and '_' (G1)."""
    c = col_(c)
    return F.when(_only(c, _ASCII_WORD + "-"), c).otherwise(F.regexp_replace(c, f"[^{WORD}-]", ""))


def or_bad_format(kept) -> Column:
    """Nothing left of a folio -> ERROR_FORMATO_INVALIDO (G1)."""
    kept = col_(kept)
    return F.when(kept == "", F.lit(C.ERROR_BAD_FORMAT)).otherwise(kept)


def folio_key(c) -> Column:
    """``or_bad_format(folio_chars(c))``; where every row passes, make ``folio_chars`` a column of its own,
    or it is evaluated twice."""
    return or_bad_format(folio_chars(c))


def folder_name(c) -> Column:
    """Category folder (G10): drop chars outside word/space/'-', strip, spaces -> '_'."""
    c = col_(c)
    kept = strip_ws(F.regexp_replace(c, f"[^{WORD}{WS}-]", ""))
    slow = F.regexp_replace(kept, f"[{WS}]+", "_")
    simple = (_only(c, _ASCII_WORD + _LATIN1_LETTERS + "- ") & ~c.contains("  ")
              & ~c.startswith(" ") & ~c.endswith(" "))
    return F.when(simple, F.translate(c, " ", "_")).otherwise(slow)


def main_category(c) -> Column:
    """Text before the first comma, stripped; empty or NULL -> 'No identificado' (F10)."""
    c = col_(c)
    return (F.when(c.isNull() | (c == ""), F.lit(C.NOT_IDENTIFIED))
            .otherwise(strip_ws(F.substring_index(c, ",", 1))))


def category_list(c) -> Column:
    """Split on ',', strip, drop empties; none -> ['No_identificado'] (G9). Repeats kept.

    Without functions on arrays, which Spark interprets row by row: outer commas
    and white space are trimmed, what lies between two names becomes one comma.
    """
    c = col_(c)
    # nothing to strip where the first and the last character are printable ASCII
    last = F.substring(c, -1, 1)
    bare = (c >= "!") & (c < "\x7f") & (last >= "!") & (last < "\x7f")
    inner = F.when(bare & ~c.startswith(",") & (last != ","), c).otherwise(F.btrim(c, F.lit(WS_CHARS + ",")))
    # a pattern that begins with a comma is looked for fast: the other one only where white space is before a comma
    between = F.when(inner.rlike(f",(?<=[{WS}],)"), F.regexp_replace(inner, f"[{WS}]*,[{WS},]*", ",")) \
        .otherwise(F.regexp_replace(inner, f",[{WS},]*", ","))
    several = F.when(inner == "", F.array(F.lit(C.NOT_IDENTIFIED_FOLDER))).otherwise(F.split(between, ","))
    # without a comma there is one name: nothing to split
    one = F.when(bare, c).when(strip_ws(c) == "", F.lit(C.NOT_IDENTIFIED_FOLDER)).otherwise(strip_ws(c))
    return F.when(~c.contains(","), F.array(one)).otherwise(several)


def output_name(key, version) -> Column:
    """``key.pdf`` for version 1, ``key_v<N>.pdf`` otherwise."""
    key, version = col_(key), col_(version)
    return F.when(version == 1, F.concat(key, F.lit(".pdf"))).otherwise(
        F.concat(key, F.lit("_v"), version.cast("string"), F.lit(".pdf")))


def short_hex(n: int, *parts) -> Column:
    """Deterministic stand-in for a random hex tag: first n hex digits of sha256."""
    return F.substring(F.sha2(F.concat_ws("|", *[col_(p).cast("string") for p in parts]), 256), 1, n)
