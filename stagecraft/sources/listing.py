"""Stage listings as data sources: every file, empty and hidden-named ones too.

Spark's own file scans leave out zero-length files and names that begin with
``_`` or ``.``, so a listing made with them is not the stage. These sources list
directories themselves: the planner goes down the tree until there are enough
folders to share out, and each task walks the folders that it was given, on an
executor, and hands on Arrow batches. No file is opened.

``stage_listing`` is the batch source. ``stage_files`` is the stream: its offset
is the number of an entry in a log of its own, and an entry holds the files
(name, time, size) of one step, at most ``limit`` of them. An entry is written
before its offset is told, so a restarted query finds the same files under the
same numbers (an entry that it had not taken goes with the next one). A file counts as new if its name, time and size were not seen
together before.

The classes are pickled by value: executors need pyarrow, not this package.
"""

from __future__ import annotations

import json
import sys
import urllib.parse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "path string, modificationTime timestamp, length long"
#: Rows of one Arrow batch, and files of one task of the stream.
BATCH_ROWS, TASK_FILES = 8192, 64
#: File systems that can be listed from a Python worker.
LISTABLE = ("file", "hdfs", "s3", "s3a", "s3n", "gs", "gcs")
_MARKER = "_SUCCESS"


def _open(uri: str):
    """(file system, path in it, prefix that turns its paths into URIs)."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), uri, "file:"
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
    authority, slash, path = rest.removeprefix("//").partition("/")
    if scheme == "hdfs":
        fs, _ = pafs.FileSystem.from_uri(f"hdfs://{authority}/")
        return fs, slash + path, f"hdfs://{authority}"
    fs, _ = pafs.FileSystem.from_uri(f"{'gs' if scheme.startswith('g') else 's3'}://{urllib.parse.quote(authority)}")
    return fs, f"{authority}/{path}", f"{scheme}://"


def _list(fs, folder: str) -> tuple[list, list[str]]:
    """(files, folders) directly below a folder; a file is its own listing."""
    info = fs.get_file_info(folder)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"no such stage prefix: {folder}")
    if info.type == pafs.FileType.File:
        return [info], []
    found = fs.get_file_info(pafs.FileSelector(folder))
    return [f for f in found if f.type == pafs.FileType.File], [f.path for f in found if f.type == pafs.FileType.Directory]


def _staged(info, local: bool) -> bool:
    """Markers of finished jobs and the checksum files of Hadoop's local file system are no staged files."""
    name = info.base_name
    return name != _MARKER and not (local and name.startswith(".") and name.endswith(".crc"))


def _walk(uri: str, below: bool):
    """(uri, time in microseconds, size) of the files of a folder, and of those below it too."""
    fs, top, prefix = _open(uri)
    local, folders = prefix == "file:", [top]
    while folders:
        files, more = _list(fs, folders.pop())
        for f in files:
            if _staged(f, local):
                yield prefix + f.path, f.mtime_ns // 1000 if f.mtime_ns is not None else None, f.size
        if below:
            folders += more


def _batches(rows):
    """Arrow batches of listed files."""
    held = []

    def batch():
        names, times, sizes = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(times, pa.timestamp("us", "UTC")), pa.array(sizes, pa.int64())],
                                          names=["path", "modificationTime", "length"])
    for row in rows:
        held.append(row)
        if len(held) >= BATCH_ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


class Folder(InputPartition):
    """One folder: its own files, or all below it."""

    def __init__(self, uri: str, below: bool):
        self.uri, self.below = uri, below


def _share_out(uris: list[str], wanted: int) -> list[Folder]:
    """Folders for at least ``wanted`` tasks where the tree has as many: those gone through already give their own files only."""
    out, level = [], list(dict.fromkeys(uris))
    while level and len(level) < wanted:
        below = []
        for uri in level:
            fs, top, prefix = _open(uri)
            files, folders = _list(fs, top)
            if any(_staged(f, prefix == "file:") for f in files):
                out.append(Folder(uri, False))
            below += [prefix + f for f in folders]
        level = below
    return out + [Folder(uri, True) for uri in level]


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.uris, self.wanted = json.loads(options["paths"]), int(options.get("tasks", "32"))

    def partitions(self):
        return _share_out(self.uris, self.wanted) or [InputPartition(None)]

    def read(self, partition):
        if isinstance(partition, Folder) or hasattr(partition, "uri"):
            yield from _batches(_walk(partition.uri, partition.below))


class Entry(InputPartition):
    """Some files of a log entry."""

    def __init__(self, files: list):
        self.files = files


class StageFilesReader(DataSourceStreamReader):
    """New files in steps of at most ``limit``; see the module text."""

    def __init__(self, options):
        self.uris, self.log = json.loads(options["paths"]), options["log"].rstrip("/")
        self.limit, self.newest = int(options.get("limit", "1000")), options.get("newestfirst", "false") == "true"
        self.last, self.seen = None, set()

    def _file(self, number: int) -> str:
        return f"{self.log}/{number:012d}.json"

    def _entry(self, number: int) -> list:
        fs, path, _ = _open(self._file(number))
        with fs.open_input_stream(path) as f:
            return [tuple(x) for x in json.loads(f.read().decode())]

    def _recover(self) -> None:
        """What the log holds: numbers without gaps, each written whole."""
        fs, folder, _ = _open(self.log)
        fs.create_dir(folder, recursive=True)
        names = sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(folder)) if f.base_name.endswith(".json"))
        self.last = 0
        for name in names:
            self.seen.update(self._entry(int(name[:-5])))
            self.last = int(name[:-5])

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        if self.last is None:
            self._recover()  # an entry that the query has not taken yet goes with the next one
        fresh = sorted({f for uri in self.uris for f in _walk(uri, True)} - self.seen,
                       key=lambda f: (f[1] if f[1] is not None else -1, f[0]), reverse=self.newest)[:self.limit]
        if fresh:
            fs, path, _ = _open(self._file(self.last + 1))
            with fs.open_output_stream(path + ".tmp") as f:
                f.write(json.dumps(fresh).encode())
            fs.move(path + ".tmp", path)
            self.seen.update(fresh)
            self.last += 1
        return {"entry": self.last}

    def partitions(self, start: dict, end: dict):
        files = [f for n in range(int(start["entry"]) + 1, int(end["entry"]) + 1) for f in self._entry(n)]
        return [Entry(files[i:i + TASK_FILES]) for i in range(0, len(files), TASK_FILES)] or [Entry([])]

    def read(self, partition):
        yield from _batches(partition.files)

    def commit(self, end: dict) -> None:
        pass


class StageListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "stage_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return ListingReader(self.options)


class StageFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "stage_files"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema):
        return StageFilesReader(self.options)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
