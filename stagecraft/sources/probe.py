"""Which files of a failed load cannot be read: one job that reads each by itself on the executors.

A Spark read fails as a whole and names one file at most. Here every file is
opened alone and read to its end in pieces, and its error is a row of the
result. Files are dealt over all tasks; nothing is kept of what is read.

What a Python worker cannot judge (stores that only Spark's JVM opens, formats
and codecs other than those below) has no row; the caller looks for those by
other means.
"""

from __future__ import annotations

import bz2
import gzip
import sys

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import listing

PIECE = 1 << 20
#: Names that Spark reads through a codec, by their end (fixed values).
CODECS = {".gz": gzip.open, ".bz2": bz2.open}
OTHER_CODECS = (".deflate", ".snappy", ".lz4", ".zst", ".zstd", ".lzo", ".xz", ".Z")
MISSING = "File not found"


def _read(uri: str, columnar: bool) -> None:
    """Read a file to its end; raises what is wrong with it."""
    fs, path, _ = listing._open(uri)
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        raise FileNotFoundError(MISSING)
    if columnar:
        with fs.open_input_file(path) as source:
            for _ in pq.ParquetFile(source).iter_batches(batch_size=8192):
                pass
        return
    with fs.open_input_stream(path, compression=None) as source:
        codec = next((c for end, c in CODECS.items() if path.endswith(end)), None)
        stream = codec(source, "rb") if codec else source
        while stream.read(PIECE):
            pass


def _probe(columnar: bool):
    def probe(batches):
        for batch in batches:
            names, errors = [], []
            for uri in batch.column(0).to_pylist():
                try:
                    _read(uri, columnar)
                except Exception as e:  # noqa: BLE001 - any error of a single file is that file's error
                    lines = [x.strip() for x in str(e).splitlines() if x.strip()]
                    names.append(uri)
                    errors.append(lines[0] if lines else type(e).__name__)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(errors, pa.string())], names=["path", "error"])
    return probe


def can_probe(path: str, file_format: str) -> bool:
    scheme, colon, _ = path.partition(":")
    known = scheme in listing.LISTABLE if colon and "/" not in scheme else path.startswith("/")
    text = file_format in ("csv", "json", "text")
    return known and (text and not path.endswith(OTHER_CODECS) or file_format == "parquet")


def failing_files(spark: SparkSession, paths: list[str], file_format: str) -> DataFrame:
    """(path, error) of the files that cannot be read to their end."""
    paths = [p for p in paths if can_probe(p, file_format)]
    tasks = min(max(len(paths), 1), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.range(1).select(F.explode(F.lit(paths).cast("array<string>")).alias("path")).repartition(tasks)
    return rows.mapInArrow(_probe(file_format == "parquet"), "path string, error string")


# Executors need pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
