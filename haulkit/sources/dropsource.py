"""Drops as a Spark data source (A1, A2), in batch and as a stream.

`spark.read.format("drops")` reads every file of a folder whose name matches a
pattern in one scan, however many headers there are.  A partition is a group of small
files or a stretch of a large one; its task reads each file's header line and aligns the
columns by name, so neither headers nor lines pass through the driver, which lists file names
and sizes only.  Cells that do not parse, "NA" and empty cells are NULL, as are columns that a file
lacks; columns that the schema lacks are skipped.  SOURCE_FILE, if the schema has it, is
the file's name.

Quoted cells may hold commas but no line breaks, as a stretch begins at the first line
after its first byte.  Files are opened through Arrow's file systems (local or shared
folders, object stores); `drops.read_drop` reads those that only Spark reaches.
"""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

# Bytes of a partition, and of a piece that a task holds.
PART, PIECE = 64 << 20, 8 << 20
LINEAGE = "SOURCE_FILE"


class Stretch(InputPartition):
    """Stretches (path, from byte, to byte) that one task reads."""

    def __init__(self, files: list[tuple[str, int, int]]):
        self.files = files


def _file_system(folder: str):
    """(Arrow file system, path in it) of a folder given as path or URI."""
    from pyarrow import fs
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), unquote("/" + folder[5:].lstrip("/"))
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def listed(folder: str, pattern: str) -> list[tuple[str, int, int]]:
    """(path, size, time of change in ns) of files in the folder, or in folders of parts in it, whose name matches the regex."""
    from pyarrow import fs
    system, root = _file_system(folder)
    rx, out = re.compile(pattern), []
    for info in system.get_file_info(fs.FileSelector(root)):
        if info.base_name[0] in "._" or not rx.search(info.base_name):
            continue
        inner = system.get_file_info(fs.FileSelector(info.path)) if info.type == fs.FileType.Directory else [info]
        out += [(f.path, f.size, f.mtime_ns or 0) for f in inner if f.type == fs.FileType.File and f.base_name[0] not in "._" and f.size]
    return sorted(out)


def stretches(files: Sequence[tuple[str, int, int]], part: int) -> list[Stretch]:
    """Files cut into stretches of `part` bytes at most, small ones gathered."""
    groups: list[list[tuple[str, int, int]]] = []
    room = 0
    for path, size, _ in files:
        for at in range(0, size, part):
            length = min(part, size - at)
            if length > room:
                groups.append([])
                room = part
            groups[-1].append((path, at, at + length))
            room -= length
    return [Stretch(g) for g in groups]


def _pieces(f, start: int, end: int, header: int, size: int) -> Iterator[bytes]:
    """Whole lines that begin in [start, end), a few MB at a time; the header's bytes are left out."""
    at = max(start, header)
    if at > header:
        f.seek(at - 1)
        at += len(f.readline()) - 1  # a line that begins before the stretch belongs to the one before
    f.seek(at)
    while at < end:
        lines = f.read(min(PIECE, end - at))
        if not lines:
            return
        if not lines.endswith(b"\n"):
            lines += f.readline()
        at += len(lines)
        yield lines


def _cells(column, kind):
    """A column of text as another type, NULL where a cell does not parse."""
    import pyarrow as pa
    import pyarrow.compute as pc
    column = pc.utf8_trim_whitespace(column)
    if pa.types.is_string(kind):
        return column
    try:
        return pc.cast(column, kind)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        pass
    out = []
    for cell in column.to_pylist():
        try:
            out.append(None if cell is None else pa.scalar(cell).cast(kind).as_py())
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
            out.append(None)
    return pa.array(out, kind)


class DropReader(DataSourceReader):
    """Batch reader: options path, pattern and partBytes."""

    def __init__(self, schema: StructType, options: dict):
        self.schema, self.folder, self.pattern = schema, options["path"], options.get("pattern", ".")
        self.part = int(options.get("partbytes", options.get("partBytes", PART)))

    def partitions(self) -> Sequence[InputPartition]:
        return stretches(listed(self.folder, self.pattern), self.part) or [Stretch([])]

    def read(self, partition: Stretch):
        import pyarrow as pa
        import pyarrow.csv as pc_csv
        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(self.schema)
        system, _ = _file_system(self.folder)
        for path, start, end in partition.files:
            with io.BufferedReader(system.open_input_file(path), 1 << 20) as f:
                first = f.readline()
                names = [c.strip() for c in next(csv.reader([first.decode("utf-8-sig").strip()], skipinitialspace=True), [])]
                if not names:
                    continue
                # a name that stands twice counts once
                unique = [n if n not in names[:k] else f"{n}\0{k}" for k, n in enumerate(names)]
                known = [n for n in target.names if n in unique]
                for lines in _pieces(f, start, end, len(first), PIECE):
                    if not lines.strip():
                        continue
                    table = pc_csv.read_csv(
                        pa.BufferReader(lines), pc_csv.ReadOptions(column_names=unique, block_size=len(lines) + 1),
                        pc_csv.ParseOptions(invalid_row_handler=lambda row: "skip"),
                        pc_csv.ConvertOptions(column_types={n: pa.string() for n in unique}, include_columns=known or unique[:1],
                                              null_values=["", "NA"], strings_can_be_null=True))
                    n = table.num_rows
                    columns = [_cells(table.column(c).combine_chunks(), target.field(c).type) if c in known else
                               pa.array([path.rsplit("/", 1)[-1]] * n) if c == LINEAGE else pa.nulls(n, target.field(c).type) for c in target.names]
                    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
                    for at in range(0, n, 10_000):
                        yield pa.RecordBatch.from_arrays([c.slice(at, 10_000) for c in columns], target.names)


class DropStreamReader(DropReader, DataSourceStreamReader):
    """Stream reader: a batch has the files that changed since the one before, by time of change and name."""

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = listed(self.folder, self.pattern)
        time, path = max(((t, p) for p, _, t in files), default=(-1, ""))
        return {"time": time, "path": path}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        low, high = ((o["time"], o["path"]) for o in (start, end))
        return stretches([f for f in listed(self.folder, self.pattern) if low < (f[2], f[0]) <= high], self.part) or [Stretch([])]

    def commit(self, end: dict) -> None:
        json.dumps(end)  # nothing is kept: offsets are plain values


class DropSource(DataSource):
    """`format("drops")`: a schema must be given."""

    @classmethod
    def name(cls) -> str:
        return "drops"

    def reader(self, schema: StructType) -> DataSourceReader:
        return DropReader(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return DropStreamReader(schema, self.options)


def _with_lineage(schema: StructType, lineage: bool) -> StructType:
    return StructType([*schema.fields]).add(LINEAGE, "string") if lineage else schema


def scan_drops(spark: SparkSession, folder: str, pattern: str, schema: StructType, lineage: bool = True, part: int = PART) -> DataFrame:
    """A1 + A2 in one scan: the drops of a kind as one DataFrame, columns aligned by name."""
    spark.dataSource.register(DropSource)
    return (spark.read.format("drops").schema(_with_lineage(schema, lineage)).option("pattern", pattern)
            .option("partBytes", part).load(folder))


def stream_drops(spark: SparkSession, folder: str, pattern: str, schema: StructType, lineage: bool = True, part: int = PART) -> DataFrame:
    """The same as a stream; a file must be whole when it appears (write it elsewhere and move it)."""
    spark.dataSource.register(DropSource)
    return (spark.readStream.format("drops").schema(_with_lineage(schema, lineage)).option("pattern", pattern)
            .option("partBytes", part).load(folder))


__all__ = ["DropSource", "scan_drops", "stream_drops"]
