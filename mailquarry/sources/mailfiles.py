"""Whole files as rows: a Spark data source over any file system that pyarrow reaches, listings without contents, and a committed writer."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatch
from itertools import batched
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import Accumulator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "mailfiles"
SCHEMA = "path string, modificationTime timestamp, length long, content binary"
#: Bytes that one task reads, what opening a file counts as, files that one task lists, and bytes of a batch.
PARTITION_BYTES, OPEN_COST, LISTED_FILES, BATCH_BYTES = 64 << 20, 64 << 10, 50_000, 8 << 20
LISTERS = 16
#: Tasks that list the folders of one depth at most, and names of a folder that such a task holds at a time.
LISTING_TASKS, NAMES_AT_ONCE = 200, 10_000
#: Rows of a batch that are Python objects at a time.
AT_ONCE = 256
ATTEMPTS = "_attempts"
_names = ["path", "modificationTime", "length", "content"]
#: Files of a listing, in the columns of ``File``.
LISTED = "path string, modified long, length long"
_listed = pa.schema([("path", pa.string()), ("modified", pa.int64()), ("length", pa.int64()), ("folder", pa.bool_())])
_types = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", tz="UTC")), ("length", pa.int64()), ("content", pa.binary())])


class File(NamedTuple):
    """A listed file."""

    path: str
    modified: int
    length: int


class Files(InputPartition):
    """The files of one task."""

    def __init__(self, files: list[File]) -> None:
        super().__init__(0)
        self.files = files


def opened(uri: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what stands before that path in a URI."""
    system, path = fs.FileSystem.from_uri(uri)
    head = uri[: uri.find("://") + 3] if "://" in uri else "file:" if uri.startswith("file:") else ""
    if isinstance(system, fs.LocalFileSystem):
        head = "file://"
    elif head and not uri[len(head) :].startswith(path):
        head += uri[len(head) :].partition("/")[0]
    return system, path, head


def listing_of(uris: Sequence[str], glob: str | None = None) -> list[File]:
    """Every file at or below the paths, empty ones too, once each and by path. Folders are listed many at a time; one that does not exist is an error."""
    found: dict[str, File] = {}

    def note(head: str, x: fs.FileInfo) -> None:
        if not glob or fnmatch(x.base_name, glob):
            found[head + x.path] = File(head + x.path, (x.mtime_ns or 0) // 1000, x.size)

    with ThreadPoolExecutor(LISTERS) as pool:
        for uri in uris:
            system, path, head = opened(uri)
            (top,) = system.get_file_info([path])
            if top.type == fs.FileType.NotFound:
                raise FileNotFoundError(uri)
            if top.type == fs.FileType.File:
                note(head, top)
                continue
            folders = [path]
            while folders:
                entries = [x for part in pool.map(lambda p, s=system: s.get_file_info(fs.FileSelector(p)), folders) for x in part]
                for x in entries:
                    if x.type == fs.FileType.File:
                        note(head, x)
                folders = [x.path for x in entries if x.type == fs.FileType.Directory]
    return [found[p] for p in sorted(found)]


def plan(files: Sequence[File], most_bytes: int, open_cost: int, most_files: int) -> list[Files]:
    """Runs of the listing of about so many bytes, or so many files; a file over that has a task of its own."""
    parts: list[list[File]] = []
    size = 0
    for x in files:
        if not parts or size + x.length + open_cost > most_bytes or len(parts[-1]) >= most_files:
            parts.append([])
            size = 0
        parts[-1].append(x)
        size += x.length + open_cost
    return [Files(p) for p in parts]


def _batches(files: Iterator[File], with_content: bool, count: Callable[[], None] = lambda: None) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    systems: dict[str, tuple[fs.FileSystem, str]] = {}
    for x in files:
        data = None
        if with_content:
            top = x.path[: x.path.find("/", x.path.find("://") + 3) + 1]
            if top not in systems:
                system, _, head = opened(top if "://" in top else x.path)
                systems[top] = system, head
            system, head = systems[top]
            with system.open_input_stream(x.path[len(head) :] if x.path.startswith(head) else opened(x.path)[1]) as stream:
                data = stream.read()
            count()
        rows.append((x.path, x.modified, x.length if data is None else len(data), data))
        size += len(data or b"")
        if size >= BATCH_BYTES or len(rows) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _types.types, strict=True)], schema=_types)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _types.types, strict=True)], schema=_types)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.uris = json.loads(options["paths"]) if options.get("paths") else [options["path"]]
        self.glob = options.get("pathglobfilter") or options.get("pathGlobFilter")
        self.content = str(options.get("content", "true")).lower() != "false"
        self.most = int(options.get("maxPartitionBytes") or options.get("maxpartitionbytes") or PARTITION_BYTES)

    def partitions(self) -> list[InputPartition]:
        files = listing_of(self.uris, self.glob)
        parts = plan(files, self.most, OPEN_COST, LISTED_FILES) if self.content else plan([f._replace(length=0) for f in files], LISTED_FILES, 1, LISTED_FILES)
        if not self.content:
            at = iter(files)
            parts = [Files([next(at) for _ in p.files]) for p in parts]
        return parts or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        yield from _batches(iter(partition.files), self.content)


class MailFiles(DataSource):
    """``spark.read.format("mailfiles")``: a row per file below ``path``, or of the JSON list ``paths``; empty files too.

    Options: ``pathGlobFilter`` (of file names), ``maxPartitionBytes``, ``content`` (false: the listing alone, no file is opened).
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, content: bool = True, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(path, modificationTime, length, content) of every file at or below the paths, in tasks of about ``partition_bytes``.

    Empty files are rows too. A file listed twice is one row; a path that does not exist is an error. Without ``content`` no file is opened.
    """
    spark.dataSource.register(MailFiles)
    uris = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format(FORMAT).option("paths", json.dumps(uris)).option("content", str(content).lower()).option("maxPartitionBytes", partition_bytes)
    return (reader.option("pathGlobFilter", glob) if glob else reader).load()


def _entries(system: fs.FileSystem, folder: str) -> Iterator[fs.FileInfo]:
    """What lies in a folder. Of a local one some names are held at a time; pyarrow lists those of other stores whole."""
    if not isinstance(system, fs.LocalFileSystem):
        yield from system.get_file_info(fs.FileSelector(folder))
        return
    with os.scandir(folder) as found:
        for some in batched((x.path for x in found), NAMES_AT_ONCE):
            yield from system.get_file_info(list(some))


def hidden(name: str) -> bool:
    """Whether Spark's own file sources pass over a file or folder of this name."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def list_files(spark: SparkSession, uri: str, staging: str, glob: str | None = None) -> DataFrame:
    """``LISTED`` of every file below a folder, hidden ones left out, as tasks have listed them: only counts reach the driver.

    A job for each depth of folders, which leaves a table under ``staging``. One folder is one task's work.
    """
    system, root, head = opened(uri)
    (top,) = system.get_file_info([root])
    if top.type != fs.FileType.Directory:
        raise FileNotFoundError(uri)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _, head = opened(uri)
        folders = (path for batch in batches for path in batch.column(0).to_pylist())
        entries = (x for path in folders for x in _entries(system, path.removeprefix(head)) if not hidden(x.base_name))
        kept = (x for x in entries if x.type == fs.FileType.Directory or x.type == fs.FileType.File and (not glob or fnmatch(x.base_name, glob)))
        rows = ((head + x.path, (x.mtime_ns or 0) // 1000, x.size or 0, x.type == fs.FileType.Directory) for x in kept)
        for some in batched(rows, NAMES_AT_ONCE):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), _listed.types, strict=True)], schema=_listed)

    job, schema, tables = uuid.uuid4().hex, f"{LISTED}, folder boolean", []
    folders, n = spark.range(1).select(F.lit(head + root).alias("path")), 1
    while n:
        tables.append(f"{staging.rstrip('/')}/listing-{job}/{len(tables)}")
        folders.repartition(min(n, LISTING_TASKS)).mapInArrow(run, schema).write.parquet(tables[-1])
        folders = spark.read.schema(schema).parquet(tables[-1]).where("folder").select("path")
        n = folders.count()
    return spark.read.schema(schema).parquet(*tables).where("NOT folder").drop("folder")


def contents(listing: DataFrame, partition_bytes: int = PARTITION_BYTES, opened_files: Accumulator | None = None) -> DataFrame:
    """The files of a listing (path, modificationTime, length) with their contents: only these are opened. ``opened_files`` counts them."""
    rows = listing.select("path", F.unix_micros("modificationTime").alias("modified"), "length")
    total = rows.agg(F.sum(F.col("length") + OPEN_COST)).head()[0] or 0
    rows = rows.repartition(max(1, -(-total // partition_bytes)), "path")
    return with_contents(rows, opened_files)


def with_contents(rows: DataFrame, opened_files: Accumulator | None = None) -> DataFrame:
    """The files of ``LISTED`` with their contents, in the tasks that have their rows; the rows may be a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = (File(*x) for batch in batches for x in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
        yield from _batches(files, True, (lambda: opened_files.add(1)) if opened_files is not None else (lambda: None))

    return rows.mapInArrow(run, SCHEMA)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of ``AT_ONCE`` rows, so that no more of it than that stands as Python objects."""
    return (batch.slice(at, AT_ONCE) for at in range(0, batch.num_rows, AT_ONCE))


def clean_key(key: str) -> str:
    """A key as a path below the target: parts that stand for folders, or for nothing, become underscores."""
    return "/".join("_" * max(1, len(x)) if x in ("", ".", "..") else x for x in key.split("/"))


def _attempted(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Every content to a file of this attempt alone; (key, order, attempt, length)."""
    system, root, _ = opened(folder)
    own = f"{root}/{uuid.uuid4().hex}"
    system.create_dir(own, recursive=True)
    n = 0
    for batch in (part for whole in batches for part in slices(whole)):
        keys, orders, data = (batch.column(k).to_pylist() for k in range(3))
        names = [f"{own}/{n + i}" for i in range(len(keys))]
        n += len(keys)
        for name, content in zip(names, data, strict=True):
            with system.open_output_stream(name) as stream:
                stream.write(content or b"")
        yield pa.RecordBatch.from_arrays([pa.array(map(clean_key, keys), pa.string()), pa.array(orders, pa.string()), pa.array(names, pa.string()), pa.array([len(x or b"") for x in data], pa.int64())], ["key", "rank", "attempt", "length"])


def _moved(batches: Iterator[pa.RecordBatch], target: str) -> Iterator[pa.RecordBatch]:
    """Attempt files to their places. One that is gone was moved by an earlier run of this task, if its place holds as many bytes."""
    system, root, _ = opened(target)
    for batch in batches:
        keys, attempts, lengths = (batch.column(k).to_pylist() for k in range(3))
        for key, attempt, length in zip(keys, attempts, lengths, strict=True):
            place = f"{root}/{key}"
            (source, there) = system.get_file_info([attempt, place])
            if source.type == fs.FileType.NotFound:
                if there.type != fs.FileType.File or there.size != length:
                    raise FileNotFoundError(f"{attempt}, which {key} was to come from")
                continue
            system.create_dir(place.rpartition("/")[0], recursive=True)
            if there.type == fs.FileType.File and not isinstance(system, fs.LocalFileSystem):
                system.delete_file(place)
            system.move(attempt, place)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], ["key", "length"])


def write_files(rows: DataFrame, target: str, staging: str, key: str = "key", content: str = "content", order: str | None = None) -> DataFrame:
    """Write every content to the file ``target``/key, on the executors; returns (key, length) of what was written.

    Two jobs. The first writes contents to files of its attempts, below ``target``/_attempts, and their names to a table under
    ``staging``, where Spark commits only what tasks that ended well have said. The second moves the files of that table into
    place; run again, it goes on where it was. So a task that is killed, or runs twice, leaves no part of a file and no second one in place, and a
    first job that fails leaves nothing: its attempts are deleted. Nothing but counts reaches the driver.

    Of several rows of one key the one last in ``order`` (by default of the content's hash) is written. Null content gives an
    empty file, null keys are left out. Files that are there already are replaced.
    """
    spark, job = rows.sparkSession, uuid.uuid4().hex
    attempts, table = f"{target.rstrip('/')}/{ATTEMPTS}/{job}", f"{staging.rstrip('/')}/attempts-{job}"
    last = F.col(order).cast("string") if order else F.sha2(F.col(content).cast("binary"), 256)
    picked = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), last.alias("rank"), F.col(content).cast("binary").alias("content"))
    system, root, _ = opened(attempts)
    try:
        picked.mapInArrow(lambda b: _attempted(b, attempts), "key string, rank string, attempt string, length long").write.parquet(table)
        named = spark.read.schema("key string, rank string, attempt string, length long").parquet(table)
        best = named.groupBy("key").agg(F.max(F.struct("rank", "attempt", "length")).alias("x")).select("key", "x.attempt", "x.length")
        done = f"{staging.rstrip('/')}/written-{job}"
        best.mapInArrow(lambda b: _moved(b, target), "key string, length long").write.parquet(done)
    finally:
        (there,) = system.get_file_info([root])
        if there.type == fs.FileType.Directory:
            system.delete_dir(root)
        top = root.rpartition("/")[0]
        if not system.get_file_info(fs.FileSelector(top, allow_not_found=True)):
            (rest,) = system.get_file_info([top])
            if rest.type == fs.FileType.Directory:
                system.delete_dir(top)
    return spark.read.schema("key string, length long").parquet(done)
