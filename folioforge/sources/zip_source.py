"""ZIP members as a data source: one archive read by several tasks.

``spark.read.format("zip_members")`` lists the archives under ``path`` and cuts
each into slices of ``slice_bytes`` by its size alone. A slice's task opens the
archive, reads its central directory (at the file's end) and takes the members
whose data begin inside the slice, so a large archive is read in parallel, no byte
range twice, and planning opens no archive. Members come in batches of at most
``batch_bytes`` (a larger member is a batch of its own).

Options: ``path`` (folder, file, or several parted by commas; local, or a URI that
pyarrow's file systems know, such as s3:// or hdfs://), ``glob`` (``*.zip``),
``slice_bytes``, ``batch_bytes``, ``member_filter``: ``none``, ``name`` (S2) or
``path`` (S2b). The filter is applied before a member is unpacked; its result is a
superset of the Catalyst flags' (``archives.member_flags``), which decide.

What cannot be read becomes a row with ``error`` and no content, never a failed
job: a corrupt archive (ord -1), and a member that is encrypted, of unknown
compression, damaged, or larger than a binary cell can be.
"""

from __future__ import annotations

import fnmatch
import io
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import config as C
from ..session import ship_package

SCHEMA = "archive string, ord int, member string, size bigint, content binary, error string"
_ARROW = pa.schema([("archive", pa.string()), ("ord", pa.int32()), ("member", pa.string()), ("size", pa.int64()),
                    ("content", pa.binary()), ("error", pa.string())])
MAX_CELL = 2_000_000_000
BROKEN_ARCHIVE = (zipfile.BadZipFile, EOFError, OSError, ValueError, NotImplementedError)
BROKEN_MEMBER = (zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError, EOFError, OSError, ValueError)


def wanted(member: str, how: str) -> bool:
    """S2 (``name``) or S2b (``path``) on a member name; ``none`` keeps all."""
    if how == "none":
        return True
    if member.endswith("/"):
        return False
    parts = [p for p in member.split("/") if p not in ("", ".")] or [""]
    dot = parts[-1].rfind(".")
    if parts[-1][dot:].lower() not in C.ALLOWED_EXTENSIONS:
        return False
    return not any(p.startswith(tuple(C.IGNORED_PREFIXES)) for p in (parts if how == "path" else parts[-1:]))


def members_of(archive: str, source, low: int = 0, high: int | None = None, how: str = "none", content: bool = True) -> Iterator[tuple]:
    """(archive, ord, member, size, content, error) of the members whose data begin in
    [low, high) of the open file ``source``; a corrupt archive is told by the first slice."""
    try:
        with zipfile.ZipFile(source) as zf:
            for k, info in enumerate(zf.infolist()):
                if info.header_offset < low or (high is not None and info.header_offset >= high) or not wanted(info.filename, how):
                    continue
                data, error = None, None
                if content and not info.filename.endswith("/"):
                    try:
                        if info.file_size > MAX_CELL:
                            raise ValueError(f"{info.file_size} bytes do not fit a cell")
                        data = zf.read(info)
                    except BROKEN_MEMBER as ex:
                        error = f"unreadable member: {type(ex).__name__}: {ex}"
                yield archive, k, info.filename, info.file_size, data, error
    except BROKEN_ARCHIVE as ex:
        if low == 0:
            yield archive, -1, None, None, None, f"corrupt archive: {ex}"


def in_batches(rows: Iterator[tuple], batch_bytes: int, batch_rows: int = 1000) -> Iterator[list[tuple]]:
    """Rows in lists of at most ``batch_bytes`` of content (a larger row alone)."""
    held, size = [], 0
    for row in rows:
        more = len(row[4] or b"")
        if held and (size + more > batch_bytes or len(held) >= batch_rows):
            yield held
            held, size = [], 0
        held.append(row)
        size += more
    if held:
        yield held


@dataclass
class Slice(InputPartition):
    archive: str
    low: int
    high: int | None


def _file_system(path: str):
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class RandomAccess(io.RawIOBase):
    """A pyarrow file with the seeks that ``zipfile`` expects (before the start: OSError)."""

    def __init__(self, source):
        self.source, self.size = source, source.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.source.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        at = offset + (0, self.source.tell(), self.size)[whence]
        if at < 0:
            raise OSError("seek before the start")
        self.source.seek(min(at, self.size))
        return self.source.tell()

    def readinto(self, buffer) -> int:
        data = self.source.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)


class ZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = [p.strip() for p in options.get("path", "").split(",") if p.strip()]
        if not self.paths:
            raise ValueError("zip_members: no path")
        self.glob = options.get("glob", "*.zip")
        self.slice_bytes = int(options.get("slice_bytes", 64 << 20))
        self.batch_bytes = int(options.get("batch_bytes", 16 << 20))
        self.how = options.get("member_filter", "none")
        if self.how not in ("none", "name", "path"):
            raise ValueError(f"zip_members: unknown member_filter {self.how!r}")

    def partitions(self) -> list[Slice]:
        from pyarrow import fs
        out = []
        for path in self.paths:
            files, inner = _file_system(path)
            prefix = path[:len(path) - len(inner)] if path.endswith(inner) else ""
            info = files.get_file_info(inner)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            found = [info] if info.is_file else [
                x for x in files.get_file_info(fs.FileSelector(inner, recursive=True))
                if x.is_file and fnmatch.fnmatch(x.base_name, self.glob)]
            for x in sorted(found, key=lambda x: x.path):
                starts = range(0, max(x.size, 1), self.slice_bytes)
                out += [Slice(prefix + x.path, low, low + self.slice_bytes if low != starts[-1] else None) for low in starts]
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        files, inner = _file_system(partition.archive)
        with files.open_input_file(inner) as source:
            rows = members_of(partition.archive, io.BufferedReader(RandomAccess(source), 1 << 18), partition.low, partition.high, self.how)
            for some in in_batches(rows, self.batch_bytes):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), _ARROW.types)], schema=_ARROW)


class ZipMembers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZipReader:
        return ZipReader(dict(self.options))


def read_members(spark: SparkSession, path: str, member_filter: str = "none", **options) -> DataFrame:
    """(archive, ord, member, size, content, error) of the members of all archives under
    ``path``. With a filter, members it drops are never unpacked, and S2 (or S2b)
    decides exactly; error rows stay."""
    from .archives import member_flags
    ship_package(spark)
    spark.dataSource.register(ZipMembers)
    reader = spark.read.format("zip_members").option("path", path).option("member_filter", member_filter)
    members = reader.options(**{k: str(v) for k, v in options.items()}).load()
    if member_filter == "none":
        return members
    flag = {"name": "keep", "path": "keep_path"}[member_filter]
    return member_flags(members).where(f"{flag} OR ord = -1").drop("file_name", "keep", "keep_path")

