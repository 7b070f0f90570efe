"""Substring dedup by unit hashing: the earliest occurrence of a unit stays.

A unit is a line, or a sentence of it: a text is cut behind every newline and
behind every full stop, exclamation or question mark that a blank or tab
follows, so the units concatenate to the text. A unit is normalised to its
words (white space runs are one blank, A-Z lower-cased). Units whose normalised form
has fewer than ``min_chars`` code points always stay: shorter sentences repeat by
chance in any corpus. Code points, not words, so that a line without blanks
(Chinese, Japanese) counts like any other. Units with the same 128-bit digest are
one group over all documents; its first in order of (doc_id, place) stays, the
others are removed. Removed units are told with their original offsets, in code
points, and the document that keeps them; ``without`` cuts them out of the texts.

Digests are grouped by partial aggregation, so a passage held by a third of all
documents shrinks before its shuffle; the groups are a table of their own, so that
AQE can split the join that finds the removed units where a digest is hot. A very
long text is a chunk of its own (some 60 bytes of memory a byte of it).

Defined cases: null and empty texts have no units; rows with null doc_id are
left alone; rows that repeat a doc_id are one document, so equal units at equal
places of them count as one; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, packed, unpacked
from folioforge.llm.words import U64, WHITE_BYTES, chunks, mix, powers, text_bytes, word_hashes

MIN_CHARS = 40
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def units(data: np.ndarray, offsets: np.ndarray, min_chars: int = MIN_CHARS):
    """(text, unit, start, end, words, digest, digest) of the units of texts
    data[offsets[i]:offsets[i+1]], as arrays; start and end in code points."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:][data == 10] = True
    stop = (data == 46) | (data == 33) | (data == 63)
    blank = (data == 32) | (data == 9)
    edge[2:][stop[:-1] & blank[1:] & ~edge[1:-1]] = True
    cuts = np.flatnonzero(edge)
    words, first = word_hashes(data, cuts)
    count = np.diff(first)
    letters = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    text = np.searchsorted(offsets, cuts[:-1], "right") - 1
    from_text = letters[offsets[text]]
    place = np.arange(len(words)) - np.repeat(first[:-1], count)
    inside = np.append(0, np.cumsum(((data & 0xC0) != 0x80) & ~WHITE_BYTES[data]))
    chars = inside[cuts[1:]] - inside[cuts[:-1]] + count - 1  # one blank between words
    some = np.flatnonzero((count > 0) & (chars >= min_chars))
    digests = []
    for base in _BASES:
        power = powers(int(count.max(initial=1)), base)
        sums = np.append(U64(0), np.cumsum(mix(words ^ U64(base)) * power[place], dtype=U64))
        digests.append(mix(sums[first[1:]][some] - sums[first[:-1]][some] + count[some].astype(U64)))
    number = np.arange(len(text)) - np.searchsorted(text, text)
    return (text[some], number[some], (letters[cuts[:-1]] - from_text)[some], (letters[cuts[1:]] - from_text)[some],
            count[some], *digests)


def _unit_rows(min_chars: int):
    def run(batches):
        for b in batches:
            data, offsets = text_bytes(b.column("text"))
            for i, j in chunks(offsets):
                part = offsets[i:j + 1]
                if part[-1] == part[0]:
                    continue
                text, unit, start, end, words, h1, h2 = units(data[part[0]:part[-1]], part - part[0], min_chars)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(text + i)), pa.array(unit.astype(np.int64)), pa.array(start.astype(np.int64)),
                     pa.array(end.astype(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
                    names=["doc_id", "unit", "start", "end", "h1", "h2"])
    return run


def removed_units(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, unit, start, end, first_doc_id, first_unit), a row for each removed unit."""
    rows = materialize(docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _unit_rows(min_chars), "doc_id bigint, unit bigint, start bigint, end bigint, h1 bigint, h2 bigint"), "units")
    groups = materialize(rows.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "unit")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "h1", "h2", "first"), "groups")
    later = rows.join(groups, ["h1", "h2"]).where(
        (F.col("doc_id") != F.col("first.doc_id")) | (F.col("unit") != F.col("first.unit")))
    return later.select("doc_id", "unit", "start", "end", F.col("first.doc_id").alias("first_doc_id"),
                        F.col("first.unit").alias("first_unit"))


def without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` with the removed units cut out of ``text`` at their offsets (and n_chars,
    if there, counted anew where that changes it); every row stays, rows with null
    doc_id as they are. The kept pieces between the cuts are joined as they stand."""
    cuts = removed.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("cuts")).withColumnRenamed(
        "doc_id", "cut_id")
    rows = packed(docs, "doc_id", "text")
    rows = rows.join(cuts, rows["doc_id"] == cuts["cut_id"], "left")
    size = F.char_length("text").cast("bigint")
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("cuts", lambda c: c["end"]))
    ends = F.concat(F.transform("cuts", lambda c: c["start"]), F.array(size))
    kept = F.array_join(F.zip_with(starts, ends, lambda a, b: F.substr("text", (a + 1).cast("int"), (b - a).cast("int"))), "")
    return unpacked(rows, docs, kept, F.col("cuts").isNotNull() & F.col("text").isNotNull())
