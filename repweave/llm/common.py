"""Helpers the corpus operators share: reading tables, shared folders, Arrow batches."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repweave.session import checkpoint_dir

#: Bytes of one Arrow batch that a Python worker holds; bounds its memory for any text length.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that reach Python by bytes, not only by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch() -> Iterator[list[str]]:
    """Lists the shared folders that are named inside, in their order, and deletes at the end those still listed."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for path in made:
            delete_folder(path)


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/repweave-llm/{tag}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write a frame once below the shared folder and read it back: the lineage is cut and
    a lost executor costs no recomputation of what stands before."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder, from a URI or a plain path."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return pafs.LocalFileSystem(), path[5:].replace("///", "/", 1) if path.startswith("file:///") else path[5:]
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def write_file(path: str, data: bytes) -> None:
    """Write a shared file atomically, so that a repeated or speculative task does no harm."""
    files, name = open_fs(path)
    files.create_dir(os.path.dirname(name), recursive=True)
    part = f"{name}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(part, compression=None) as out:
        out.write(data)
    files.move(part, name)


def delete_folder(path: str) -> None:
    """Delete a shared folder, if it was written at all."""
    files, name = open_fs(path)
    if files.get_file_info(name).type == pafs.FileType.Directory:
        files.delete_dir(name)


def read_file(path: str) -> bytes:
    files, name = open_fs(path)
    with files.open_input_file(name) as f:
        return f.read()


def raw(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of a string column; NULL is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """The strings of a column; NULL is the empty text."""
    return [x or "" for x in column.to_pylist()]


def column_index(schema: pa.Schema, name: str) -> int:
    """The place of a column, found as Spark finds it: exactly, or else in any case."""
    at = schema.get_field_index(name)
    return at if at >= 0 else [n.lower() for n in schema.names].index(name.lower())


def hashable(df: DataFrame) -> list:
    """All columns of a frame and which of them are NULL, as expressions that can be hashed (maps as JSON)."""
    cells = []
    for c, kind in df.dtypes:
        cell = F.col(f"`{c}`")
        cells += [F.to_json(F.struct(cell)) if "map<" in kind or "variant" in kind else cell, cell.isNull()]
    return cells


def relengthened(rb: pa.RecordBatch, text_col: str, chars_col: str | None, changed: dict[int, str]) -> pa.RecordBatch:
    """The batch with some texts replaced, and ``chars_col`` of those rows alone."""
    if not changed:
        return rb
    for name, value in ((text_col, lambda t: t), (chars_col, len)):
        if name:
            values = rb.column(column_index(rb.schema, name)).to_pylist()
            for i, t in changed.items():
                values[i] = value(t)
            rb = replaced(rb, name, values)
    return rb


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)


def replaced(rb: pa.RecordBatch, name: str, values: list) -> pa.RecordBatch:
    """The batch with one column's values replaced, all other columns as they came."""
    i = column_index(rb.schema, name)
    columns = list(rb.columns)
    columns[i] = pa.array(values, type=rb.schema.field(i).type)
    return pa.RecordBatch.from_arrays(columns, schema=rb.schema)


def dump(obj: dict) -> str:
    return json.dumps(obj, ensure_ascii=False, sort_keys=True)
