"""Token-ID output: Arrow files of fixed-size-list batches.

Documents are range-partitioned by id; each task encodes its range in order and
writes one *shard*: an Arrow file whose rows are sequences of ``length`` ids
(``ids``) with a bit-packed mask (``mask``: 1 real, 0 padding; only a shard's
last row is padded), and beside it an index file (``doc_id``, ``start``,
``n_tokens``).  Both are uncompressed, so a memory map gives any row without a
copy.  A task writes under a fresh name and only shards named in the manifest
count, so a retried or duplicated task leaves no wrong data.

Defined cases: null text is empty (only the end id); a null ``doc_id`` sorts
first; rows with one ``doc_id`` are ordered by text; an empty table gives no
shards; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from care_analytics.llm.common import new_folder, prepare, shuffle_tasks, written
from care_analytics.llm.units import encoder

MANIFEST = "shard long, path string, n_docs long, n_tokens long"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class ShardWriter:
    """One shard: sequences of ``length`` ids and the index of its documents."""

    def __init__(self, path: str, length: int, dtype: str):
        self.length, self.dtype = length, np.dtype(dtype)
        kind = pa.uint32() if self.dtype.itemsize == 4 else pa.uint16()
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.kind = kind
        fs, local = pafs.FileSystem.from_uri(path)
        fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
        self.files = [fs.open_output_stream(local), fs.open_output_stream(local + ".index")]
        self.sequences = pa.ipc.new_file(self.files[0], self.schema)
        self.index = pa.ipc.new_file(self.files[1], INDEX)
        self.rest = np.zeros(0, self.dtype)
        self.n_tokens = self.n_docs = 0

    def _rows(self, ids: np.ndarray, real: int) -> None:
        n = len(ids) // self.length
        mask = np.ones(len(ids), bool)
        mask[real:] = False
        self.sequences.write_batch(pa.record_batch([
            pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))
        assert n * self.length == len(ids)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> None:
        self.index.write_batch(pa.record_batch([
            doc_ids.cast(pa.int64()), pa.array(offsets[:-1] + self.n_tokens, pa.int64()), pa.array(np.diff(offsets), pa.int64())], schema=INDEX))
        self.n_docs += len(doc_ids)
        self.n_tokens += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // self.length * self.length
        if whole:
            self._rows(ids[:whole], whole)
        self.rest = ids[whole:]

    def close(self) -> None:
        if len(self.rest):
            self._rows(np.concatenate([self.rest, np.zeros(self.length - len(self.rest), self.dtype)]), len(self.rest))
        for x in (self.sequences, self.index, *self.files):
            x.close()


class ShardReader:
    """Random access to the sequences of a shard; local files are memory-mapped, nothing is copied."""

    def __init__(self, path: str):
        fs, local = pafs.FileSystem.from_uri(path)
        opened = (lambda p: pa.memory_map(p)) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file
        self.sequences, self.index = pa.ipc.open_file(opened(local)), pa.ipc.open_file(opened(local + ".index"))
        self.length = self.sequences.schema.field("ids").type.list_size
        sizes = [self.sequences.get_batch(i).num_rows for i in range(self.sequences.num_record_batches)]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.first[-1])

    def _batch(self, row: int) -> tuple[pa.RecordBatch, int]:
        b = int(np.searchsorted(self.first, row, side="right")) - 1
        return self.sequences.get_batch(b), row - int(self.first[b])

    def ids(self, row: int) -> np.ndarray:
        """Sequence ``row`` as a view of the file."""
        batch, i = self._batch(row)
        return batch.column(0).slice(i, 1).flatten().to_numpy(zero_copy_only=True)

    def mask(self, row: int) -> np.ndarray:
        batch, i = self._batch(row)
        return batch.column(1).slice(i, 1).flatten().to_numpy(zero_copy_only=False)

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the shard, ids), reading one batch of sequences at a time."""
        at, held, b = 0, np.zeros(0, "<u4"), 0
        for i in range(self.index.num_record_batches):
            docs = self.index.get_batch(i).to_pydict()
            for doc, start, n in zip(*docs.values()):
                parts = [held[start - at:]]
                have = len(parts[0])
                while have < n:
                    batch = self.sequences.get_batch(b)
                    flat = batch.column(0).flatten().to_numpy(zero_copy_only=True)
                    if b + 1 == self.sequences.num_record_batches:
                        flat = flat[batch.column(1).flatten().to_numpy(zero_copy_only=False)]
                    parts.append(flat)
                    have += len(flat)
                    b += 1
                at, held = start, np.concatenate(parts) if len(parts) > 1 else parts[0]
                yield doc, start, held[:n]


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, length: int = 1024, end_id: int = 0, shards: int | None = None) -> DataFrame:
    """Write the shards of ``docs`` (doc_id, text); the manifest, one row per shard in document order."""
    spark = prepare(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out, path = TaskContext.get().partitionId(), None, ""
        coder = encoder(tokenizer)
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.arrow"
                out = ShardWriter(path, length, coder.dtype)
            out.add(batch.column(0), *coder.encode_ended(batch.column(1), end_id))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "n_docs": [out.n_docs], "n_tokens": [out.n_tokens]})

    rows = (docs.select("doc_id", "text")
            .repartitionByRange(shards or shuffle_tasks(spark), "doc_id")
            .sortWithinPartitions("doc_id", "text"))
    return written(rows.mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Documents read back from the shards: doc_id, start (over all shards), n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    # one row per shard: the running sum over the manifest is bounded by the number of files
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select("shard", "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows: list[tuple] = []
                for doc, start, ids in ShardReader(path).documents():
                    rows.append((doc, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return (shards.repartition(shuffle_tasks(spark), "shard")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_files_digest(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    return read_token_files(write_token_files(docs, tokenizer, new_folder(prepare(spark), "tokens")))
