"""Shared folder, code shipping and block tables used by the operators.

A *block* is a bounded run of input rows kept together as one Arrow payload, so
that several passes over the same rows agree on their order without sorting.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

PACKAGE = __name__.split(".")[0]
BLOCK_BYTES = 4 << 20
BLOCK_SCHEMA = "block_id bigint, payload binary"


def prepare(spark: SparkSession) -> SparkSession:
    """Ship this package to the executors and bound the Arrow batches, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_care_shipped", None) is None:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="care-code-"), f"{PACKAGE}_code.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join(PACKAGE, os.path.relpath(full, root)))
        sc.addPyFile(path)
        sc._care_shipped = path
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets a scratch folder."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if getattr(sc, "_care_scratch", None) is None:
        sc._care_scratch = "file://" + tempfile.mkdtemp(prefix="care-shared-")
    return sc._care_scratch


def new_folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/care-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives a lost executor."""
    spark = df.sparkSession
    path = new_folder(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._care_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for table in tables:
        spark, path = table.sparkSession, table._care_path
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(jvm_path, True)


def release(result: DataFrame) -> None:
    """Delete the tables that an operator left for its lazy ``result`` (``_care_made``), once it is written."""
    for kind, made in getattr(result, "_care_made", ()):
        if kind == "table":
            result.sparkSession.sql(f"DROP TABLE IF EXISTS {made}")
        else:
            dropped(made)


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array as one uint8 vector, and its row offsets (null: empty)."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.fill_null("").cast(pa.large_string())
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[array.offset:array.offset + len(array) + 1]
    if not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def block_cuts(lengths: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Row ranges whose summed lengths stay within ``limit`` (a longer row stands alone)."""
    cuts, start, total = [], 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > limit:
            cuts.append((start, i))
            start, total = i, 0
        total += n
    if len(lengths) > start:
        cuts.append((start, len(lengths)))
    return cuts


def to_payload(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_payload(payload) -> pa.RecordBatch:
    with pa.ipc.open_stream(pa.py_buffer(payload)) as reader:
        return reader.read_next_batch()


def pack_blocks(df: DataFrame, text: str = "text", limit: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``df`` as blocks of at most ``limit`` text bytes: ``block_id``, ``payload`` (all columns)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seq = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, seq
            table = pa.Table.from_batches(held).combine_chunks()
            row = pa.RecordBatch.from_arrays([pa.array([base + seq], pa.int64()), pa.array([to_payload(table.to_batches()[0])], pa.binary())], ["block_id", "payload"])
            held, size, seq = [], 0, seq + 1
            return row

        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            _, offsets = text_bytes(column)
            for a, b in block_cuts(np.diff(offsets), limit):
                more = int(offsets[b] - offsets[a])
                if held and size + more > limit:
                    yield flush()
                held.append(batch.slice(a, b - a))
                size += more
        if held:
            yield flush()

    return df.mapInArrow(pack, BLOCK_SCHEMA)


def tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(columns: list[str], name: str) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name
