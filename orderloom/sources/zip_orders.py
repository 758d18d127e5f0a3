"""Zipped CSV batches: archives in a folder become order lines.

The file source only lists archives (path and size); its content column is not
read. Tasks then open the archives themselves and stream the members, so memory
use does not grow with archive size. Members of a large archive are spread over
tasks. A broken archive, or a damaged member of one, gives a quarantine row instead
of a failure; the other members are read at any archive size.
"""

from __future__ import annotations

import io
import lzma
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from orderloom.functions.stores import store_of
from orderloom.sources.csv_orders import Ingest, bounded, decode, decode_lines, split_lines

# Archives above this size are spread member by member.
SPLIT_BYTES = 64 * 1024 * 1024
LINES_PER_BATCH = 8192

# What the archive and the codecs raise on damaged data. Failures of the store itself are
# ``StorageFailure`` and end the task, which then runs again.
_BROKEN = (
    zipfile.BadZipFile, zlib.error, lzma.LZMAError, struct.error, UnicodeError, EOFError, OSError,
    NotImplementedError, RuntimeError, ValueError, KeyError,
)


class StorageFailure(Exception):
    """The store could not be read; nothing is known about the archive."""


# Columns of the binary file source; streams need them declared.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"

_PARTS = pa.schema([("path", pa.string()), ("member", pa.string()), ("error", pa.string())])
_LINES = pa.schema(
    [("path", pa.string()), ("member", pa.string()), ("line", pa.string()), ("error", pa.string())]
)


class _RandomAccess(io.RawIOBase):
    """An Arrow file as a plain Python one: a bad seek is an ``OSError``."""

    def __init__(self, file) -> None:
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            self._file.seek(offset, whence)
        except ValueError as e:
            raise OSError(str(e)) from e
        return self._file.tell()

    def readinto(self, buffer) -> int:
        try:
            data = self._file.read(len(buffer))
        except OSError as e:
            raise StorageFailure(str(e)) from e
        buffer[: len(data)] = data
        return len(data)

    def close(self) -> None:
        if not self.closed:
            self._file.close()
        super().close()


def _open(path: str) -> io.BufferedReader:
    """Open a file for random access."""
    store, inner = store_of(path)
    try:
        file = store.open_input_file(inner)
    except OSError as e:
        raise StorageFailure(f"{path}: {e}") from e
    return io.BufferedReader(_RandomAccess(file), 1 << 20)


def _members(archive: zipfile.ZipFile) -> list[str]:
    """Data members: like the folder source, skip names starting with ``.`` or ``_``."""
    return [
        info.filename
        for info in archive.infolist()
        if not info.is_dir() and not any(p[:1] in "._" for p in info.filename.split("/") if p)
    ]


def _list_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path, size in zip(batch["path"].to_pylist(), batch["length"].to_pylist()):
            if size <= SPLIT_BYTES:
                rows.append((path, None, None))
                continue
            try:
                with _open(path) as raw, zipfile.ZipFile(raw) as archive:
                    rows.extend((path, name, None) for name in _members(archive))
            except _BROKEN as e:
                rows.append((path, None, f"bad zip: {e}"))
        yield _batch(rows, _PARTS)


def _member_lines(archive: zipfile.ZipFile, path: str, name: str) -> Iterator[tuple]:
    """The lines of a member; where it is damaged, one row that says how many came before."""
    n = 0
    try:
        with archive.open(name) as member:
            for line in io.TextIOWrapper(member, encoding="utf-8", errors="replace"):
                yield path, name, line.rstrip("\n"), None
                n += 1
    except _BROKEN as e:
        yield path, name, None, f"bad member after {n} lines: {e}"


def _archive_lines(path: str, member: str | None) -> Iterator[tuple]:
    """The lines of one member or of all: a damaged one does not end the others."""
    try:
        with _open(path) as raw, zipfile.ZipFile(raw) as archive:
            for name in [member] if member is not None else _members(archive):
                yield from _member_lines(archive, path, name)
    except _BROKEN as e:
        yield path, member, None, f"bad zip: {e}"


def _read_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for path, member, error in zip(*(batch[c].to_pylist() for c in ("path", "member", "error"))):
            found = [(path, None, None, error)] if error is not None else _archive_lines(path, member)
            for row in found:
                rows.append(row)
                if len(rows) >= LINES_PER_BATCH:
                    yield _batch(rows, _LINES)
                    rows = []
        if rows:
            yield _batch(rows, _LINES)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
    )


def unzip_lines(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Expand listed archives ``(path, length)`` to ``(path, member, line, error)`` rows."""
    spark = files.sparkSession
    tasks = tasks or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    parts = files.select("path", "length").mapInArrow(
        _list_parts, "path string, member string, error string"
    )
    # Rows here are names only; a fixed count keeps them from being merged into one task.
    return parts.repartition(tasks, "path", "member").mapInArrow(
        _read_lines, "path string, member string, line string, error string"
    )


def read_zip_orders(spark: SparkSession, path: str) -> Ingest:
    """All zip archives in a folder; other files are ignored."""
    files = spark.read.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.zip").load(path)
    return decode_lines(unzip_lines(files))


def stream_zip_orders(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> Ingest:
    """A folder watched for new zip archives. Producers must move finished files in."""
    return split_lines(stream_zip_intake(spark, path, max_files_per_trigger))


def stream_zip_intake(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, archive: str | None = None
) -> DataFrame:
    """The same, as one stream of decoded rows. ``archive`` as in ``bounded``."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.zip")
    reader = bounded(reader, archive)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return decode(unzip_lines(reader.load(path)))
