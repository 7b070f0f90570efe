"""Archive ingest: flatten ZIP members into raw files.

S1 archive flatten, S2 member filter, S2b path-part filter, S3 flat-name
collisions. Archives are read with Spark's ``binaryFile`` source; members
are listed and read per archive inside ``mapInPandas`` (stdlib ``zipfile``),
so archives are spread over tasks and no member passes through the driver.
"""

from __future__ import annotations

import io

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import strings as S
from ..session import ship_package
from .zip_source import in_batches, members_of

BATCH_BYTES = 16 << 20
MEMBER_SCHEMA = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("ord", T.IntegerType()),
    T.StructField("member", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("error", T.StringType()),
])


def read_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """Archives as rows (path, modificationTime, length, content)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def _explode_zip(batches):
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            for rows in in_batches(members_of(path, io.BytesIO(content)), BATCH_BYTES):
                yield pd.DataFrame(rows, columns=MEMBER_SCHEMA.fieldNames())


def archive_members(archives: DataFrame) -> DataFrame:
    """One row per member of each archive (directories included, bytes NULL); a
    corrupt archive yields one row with ``error`` set, an unreadable member its row
    with ``error`` and no bytes (both go to rejects). An archive is one row here, 2 GB
    at most; ``zip_source.read_members`` reads larger ones, in parallel."""
    ship_package(archives.sparkSession)
    return archives.select("path", "content").mapInPandas(_explode_zip, MEMBER_SCHEMA)


def _starts_with_any(c, prefixes) -> F.Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out


def member_flags(members: DataFrame) -> DataFrame:
    """S2 and S2b as two boolean columns.

    ``keep``: not a directory, basename non-empty, basename not starting with
    an ignored prefix, suffix (lower) allowed. ``keep_path``: the same test of
    the prefix on every path part (the stricter variant).
    """
    m = F.col("member")
    name = S.basename(m)
    allowed = F.lower(S.suffix(m)).isin(*C.ALLOWED_EXTENSIONS)
    is_dir = m.endswith("/")
    keep = ~is_dir & (name != "") & ~_starts_with_any(name, C.IGNORED_PREFIXES) & allowed
    parts = F.filter(F.split(m, "/"), lambda p: (p != "") & (p != "."))
    bad_part = F.exists(parts, lambda p: _starts_with_any(p, C.IGNORED_PREFIXES))
    keep_path = ~is_dir & (name != "") & ~bad_part & allowed
    return members.withColumn("file_name", name).withColumn("keep", keep).withColumn("keep_path", keep_path)


def flat_names(kept: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """S3: a name already taken (by an earlier member, in (archive, ord) order,
    or by ``existing`` names) becomes ``stem_<6 hex>suffix``, checked once.

    The first holder of each name is a map-side-combined aggregate, joined
    back: no window over a possibly hot name.
    """
    first = kept.groupBy("file_name").agg(F.min(F.struct("archive", "ord")).alias("_first"))
    d = kept.join(first, "file_name")
    taken = F.struct("archive", "ord") != F.col("_first")
    if existing is not None:
        ex = existing.select(F.col("file_name").alias("_ex")).distinct().withColumn("_hit", F.lit(True))
        d = d.join(ex, d["file_name"] == ex["_ex"], "left").drop("_ex")
        taken = taken | F.coalesce(F.col("_hit"), F.lit(False))
    tag = S.short_hex(6, "archive", "member", "ord")
    renamed = F.concat(S.stem("file_name"), F.lit("_"), tag, S.suffix("file_name"))
    out = d.withColumn("flat_name", F.when(taken, renamed).otherwise(F.col("file_name")))
    return out.drop("_first", *(["_hit"] if existing is not None else []))
