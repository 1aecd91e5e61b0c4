"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_root, work_dir

#: Bytes of text that one Python step holds at a time; longer batches are cut.
SLICE_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package: they need not find it in their own path."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(context, "_stagecraft_shipped", False) or not root.is_dir():
        return
    handle, name = tempfile.mkstemp(prefix="stagecraft-", suffix=".zip")  # Spark serves it to the executors
    os.close(handle)
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(name)
    context._stagecraft_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) only: other columns never reach Python."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def text_slices(batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of at most ``limit`` bytes of text, or one longer text.

    The first column holds the ids, the second the texts.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(1)).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + (size or 0) > limit:
                part = batch.slice(start, i - start)
                yield part.column(0).to_pylist(), part.column(1).to_pylist()
                start, held = i, 0
            held += size or 0
        if start < len(sizes):
            part = batch.slice(start)
            yield part.column(0).to_pylist(), part.column(1).to_pylist()


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a Spark schema text (on the driver: it is parsed by the session)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def give_back() -> None:
    """Unused memory of the Arrow pool and of the C heap goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def per_text(docs: DataFrame, schema: str, make: Callable[[], Callable[[list, list[str]], list]],
             limit: int = SLICE_BYTES, close: Callable[[], None] | None = None) -> DataFrame:
    """Apply ``make()(ids, texts) -> columns`` (lists or Arrow arrays) to slices of ``doc_id`` and ``text``.

    ``make`` runs once per task, so tables and caches are set up on the executor;
    ``close`` runs at the task's end. Workers serve later stages too, so what a
    task no longer needs is given back.
    """
    target = arrow_schema(schema)

    def run(batches):
        step = make()
        try:
            for ids, texts in text_slices(batches, limit):
                columns = step(ids, texts)
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                     for c, f in zip(columns, target)], schema=target)
        finally:
            if close:
                close()
            give_back()

    return id_and_text(docs).mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from lost executors."""
    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_EDGE = re.compile(r"[\x1c-\x1f]")
#: White space of the word tokenizer (Unicode's White_Space, fixed values).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPLIT = re.compile(f"[{SPACE}]+")


def space_chunks(text: str) -> list[str]:
    """Maximal runs without white space.

    ``str.split`` also cuts at four control characters that are not white
    space; texts with them take the slower pattern.
    """
    if _EDGE.search(text):
        return [c for c in _SPLIT.split(text) if c]
    return text.split()


__all__ = ["SLICE_BYTES", "SPACE", "id_and_text", "per_text", "read_table", "shared_root",
           "space_chunks", "stored", "text_slices"]
