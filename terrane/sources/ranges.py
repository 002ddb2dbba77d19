"""Extracts read in ranges of blobs: a large file by many tasks, with kinds and keys dropped where they are decoded.

    ranges.register(spark)
    spark.read.format("map_extract").option("keys", "place,highway").load("file:///data/country.pbf").where("kind = 'w'")

Blobs say how long they are, so the driver finds them by reading some bytes of each and deals runs of them to tasks; a
task reads its run alone. Paths are those that pyarrow opens (local folders, and URIs of stores that it has a driver for).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage

from ..runtime import ship
from .binary import Broken, fields
from .extract import _KINDS, _MEMBERS, _blob, _field, objects, written

SCHEMA = "path string, kind string, id long, lat double, lon double, tags map<string,string>, refs array<long>, members array<struct<type:string,ref:long,role:string>>"
_ARROW = pa.schema([("path", pa.string()), ("kind", pa.string()), ("id", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64()), ("tags", pa.map_(pa.string(), pa.string())), ("refs", pa.list_(pa.int64())), ("members", _MEMBERS)])
#: Bytes of a run, about; a blob's header and contents are no larger than the format's own limits.
RUN, MOST_HEADER, MOST_BLOB = 32 << 20, 64 << 10, 32 << 20
#: Objects handed on together.
BATCH = 10_000


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def files_of(path: str) -> list[str]:
    """The file of a path, or those of a folder (no hidden ones), in order."""
    fs, at = _open(path)
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    own = [at] if info.type == pafs.FileType.File else sorted(f.path for f in fs.get_file_info(pafs.FileSelector(at, recursive=True)) if f.type == pafs.FileType.File and not f.base_name.startswith((".", "_")))
    head = path[: len(path) - len(at)] if path.endswith(at) else ""
    return [head + p for p in own]


def places_of_blobs(path: str) -> list[tuple[int, int]]:
    """(place, bytes) of each blob of a file, by its header alone."""
    fs, at = _open(path)
    out, pos = [], 0
    with fs.open_input_file(at) as f:
        size = f.size()
        while pos < size:
            n = int.from_bytes(f.read_at(4, pos))
            if not 0 < n <= MOST_HEADER or pos + 4 + n > size:
                raise Broken(f"{path}: no blob's header at byte {pos}")
            body = int(next((v for k, _, v in fields(bytes(f.read_at(n, pos + 4))) if k == 3), 0))
            if body > MOST_BLOB or pos + 4 + n + body > size:
                raise Broken(f"{path}: the blob at byte {pos} is cut short")
            out.append((pos, 4 + n + body))
            pos += 4 + n + body
    return out


@dataclass
class Run(InputPartition):
    """Blobs side by side in a file."""

    path: str
    start: int
    size: int


def runs_of(path: str, most: int = RUN) -> list[Run]:
    out: list[Run] = []
    for pos, size in places_of_blobs(path):
        if out and out[-1].size + size <= most:
            out[-1].size += size
        else:
            out.append(Run(path, pos, size))
    return out


class ExtractReader(DataSourceReader):
    """Runs of blobs; `kind` filters are taken over and dropped from the plan."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.most = options["path"], int(options.get("range_bytes", RUN))
        self.keys = frozenset(k for k in options.get("keys", "").split(",") if k)
        self.kinds = frozenset(_KINDS)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("kind",):
                self.kinds &= {f.value}
            elif isinstance(f, In) and f.attribute == ("kind",):
                self.kinds &= set(f.value)
            elif isinstance(f, IsNotNull) and f.attribute in (("kind",), ("id",), ("path",)):
                continue  # they never are
            else:
                yield f

    def partitions(self) -> list[Run]:
        return [r for p in files_of(self.path) for r in runs_of(p, self.most)]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        fs, at = _open(partition.path)
        with fs.open_input_file(at) as f:
            data = bytes(f.read_at(partition.size, partition.start))
        rows: list[tuple] = []
        for o in objects(data, self.kinds):
            if not self.keys or any(k in self.keys for k, _ in o[4]):
                rows.append((partition.path, *o))
            if len(rows) >= BATCH:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


@dataclass
class Written(WriterCommitMessage):
    """A task's file of blobs, and the least and greatest object in it."""

    path: str
    count: int
    first: tuple[int, int]
    last: tuple[int, int]


class ExtractWriter(DataSourceWriter):
    """A file of blobs for each task, joined by the driver after all of them are there, or removed.

    Rows have to come in the format's order: nodes, ways, relations, each by falling id never; `ordered` sorts them so.
    """

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.overwrite, self.time = options["path"], overwrite, int(options.get("time", 0))
        self.block = int(options.get("block", 8000))

    def _parts(self) -> tuple[pafs.FileSystem, str]:
        fs, at = _open(self.path)
        return fs, f"{at}.parts"

    def write(self, iterator: Iterator) -> Written:
        from pyspark import TaskContext

        fs, folder = self._parts()
        fs.create_dir(folder, recursive=True)
        task = TaskContext.get()
        name = f"{folder}/{task.partitionId():06}-{task.taskAttemptId()}"
        count, first, last = 0, (9, 0), (-1, 0)
        with fs.open_output_stream(name) as out:
            held: list = []
            for row in iterator:
                at = _KINDS.index(row["kind"]), row["id"]
                if at <= last:
                    raise ValueError(f"{row['kind']}{row['id']} comes after {_KINDS[last[0]]}{last[1]}")
                if held and (held[0]["kind"] != row["kind"] or len(held) >= self.block):
                    out.write(_blocks(held))
                    held = []
                held.append(row)
                first, last, count = min(first, at), at, count + 1
            if held:
                out.write(_blocks(held))
        return Written(name, count, first, last)

    def commit(self, messages: list[Written | None]) -> None:
        fs, at = _open(self.path)
        told = sorted((m for m in messages if m and m.count), key=lambda m: m.first)
        try:
            for a, b in zip(told, told[1:], strict=False):
                if a.last >= b.first:
                    raise ValueError("tasks wrote objects out of order")
            if not self.overwrite and fs.get_file_info(at).type != pafs.FileType.NotFound:
                raise FileExistsError(self.path)
            with fs.open_output_stream(f"{at}.new") as out:
                out.write(header_blob(self.time))
                for m in told:
                    with fs.open_input_stream(m.path) as part:
                        while chunk := part.read(1 << 20):
                            out.write(chunk)
            fs.move(f"{at}.new", at)
        finally:
            self._clean()

    def abort(self, messages: list[Written | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        fs, folder = self._parts()
        if fs.get_file_info(folder).type != pafs.FileType.NotFound:
            fs.delete_dir(folder)


def header_blob(time: int) -> bytes:
    return _blob("OSMHeader", _field(4, b"OsmSchema-V0.6") + _field(4, b"DenseNodes") + _field(16, b"terrane") + _field(32, time), False)


def _blocks(rows: list) -> bytes:
    """Objects of one kind as a block."""
    tags = lambda r: dict(r["tags"] or {})
    nodes = [(r["id"], r["lat"], r["lon"], tags(r)) for r in rows if r["kind"] == "n"]
    ways = [(r["id"], list(r["refs"] or ()), tags(r)) for r in rows if r["kind"] == "w"]
    rels = [(r["id"], tags(r), [(m["type"], m["ref"], m["role"]) for m in r["members"] or ()]) for r in rows if r["kind"] == "r"]
    return written(nodes, ways, rels, 0, head=False)


def ordered(rows, parts: int | None = None):
    """Objects in the order of an extract, dealt to tasks by ranges of it: what `map_extract` can be written from."""
    from pyspark.sql import functions as F

    order = [F.array_position(F.array(*map(F.lit, _KINDS)), F.col("kind")), F.col("id")]
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order)


class ExtractSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "map_extract"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ExtractReader:
        return ExtractReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> ExtractWriter:
        return ExtractWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Makes `map_extract` known to the session, and its filters pushed down."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ExtractSource)
