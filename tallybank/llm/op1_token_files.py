"""Token ids as Arrow stream files of equal-length sequences.

A folder holds, for each range of doc_id, `ids-<n>.arrow` and `docs-<n>.arrow`, and one table `manifest`.

- `ids-<n>.arrow` is an Arrow stream. Its batches have the columns `ids` and `mask`, both fixed-size lists of `length`
  values. The tokens of the documents follow each other without gaps; `mask` is false on the padding after the last one.
  Every batch but the last holds `batch_rows` sequences, so all of them take the same number of bytes. A reader that
  has seen the first one finds any other by a multiplication and maps it without copying.
- `docs-<n>.arrow` has for each document its id, its first token within the file, and its number of tokens.
- `manifest` has one row per file: its number and how many ids and documents it holds.

Documents are in ascending doc_id order, null ids first, equal ids by text. A null or empty text has only the end id.
An empty table gives an empty manifest. Columns other than doc_id and text are not read. Files get their names when
they are complete, and a task that runs again writes the same bytes, so lost executors and repeated tasks do no harm.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybank.llm.token_ids import TextEncoder
from tallybank.llm.words import text_bytes

LENGTH = 1024
BATCH_ROWS = 64
DOCS = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])


def schema_of(length: int, vocabulary: int) -> pa.Schema:
    """Ids take two bytes if the vocabulary allows it."""
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """One pair of files. Tokens are kept until they fill a batch."""

    def __init__(self, folder: str, number: int, schema: pa.Schema, batch_rows: int):
        self.place, root = fs.FileSystem.from_uri(folder)
        self.names = [f"{root}/{kind}-{number:06d}.arrow" for kind in ("ids", "docs")]
        self.drafts = [f"{name}.{uuid.uuid4().hex}" for name in self.names]
        self.sinks = [self.place.open_output_stream(draft) for draft in self.drafts]
        self.schema, self.length = schema, schema.field("ids").type.list_size
        self.kind = schema.field("ids").type.value_type.to_pandas_dtype()
        self.most = self.length * batch_rows
        self.streams = [ipc.new_stream(self.sinks[0], schema), ipc.new_stream(self.sinks[1], DOCS)]
        self.waiting: list[np.ndarray] = []
        self.held = self.total = self.documents = 0

    def add(self, doc_ids: list[int | None], encoded: list[np.ndarray]) -> None:
        sizes = np.array([len(x) for x in encoded], np.int64)
        first = self.total + np.cumsum(sizes) - sizes
        columns = [pa.array(doc_ids, pa.int64()), pa.array(first), pa.array(sizes)]
        self.streams[1].write_batch(pa.record_batch(columns, schema=DOCS))
        self.total += int(sizes.sum())
        self.documents += len(sizes)
        for ids in encoded:
            self.waiting.append(ids.astype(self.kind))
            self.held += len(ids)
            if self.held >= self.most:
                self._flush()

    def _flush(self, last: bool = False) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.kind)
        whole = len(ids) - len(ids) % self.most
        for at in range(0, whole, self.most):
            self._batch(ids[at : at + self.most], self.most)
        rest = ids[whole:]
        if last and len(rest):
            padded = -(-len(rest) // self.length) * self.length
            self._batch(np.pad(rest, (0, padded - len(rest))), len(rest))
            rest = rest[:0]
        self.waiting, self.held = [rest], len(rest)

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        lists = [pa.FixedSizeListArray.from_arrays(values, self.length) for values in (pa.array(ids), mask)]
        self.streams[0].write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> tuple[int, int]:
        self._flush(last=True)
        for stream, sink in zip(self.streams, self.sinks, strict=True):
            stream.close()
            sink.close()
        for draft, name in zip(self.drafts, self.names, strict=True):
            self.place.move(draft, name)
        return self.total, self.documents


class SequenceReader:
    """Random access to one file. Arrays are views of the mapped file, where the file system can map."""

    def __init__(self, folder: str, number: int):
        place, root = fs.FileSystem.from_uri(folder)
        name = f"{root}/ids-{number:06d}.arrow"
        if isinstance(place, fs.LocalFileSystem):
            self.source = pa.memory_map(name)
        else:
            self.source = place.open_input_file(name)
        self.schema = ipc.read_schema(self.source)
        self.length = self.schema.field("ids").type.list_size
        self.begin = self.source.tell()
        self.batch_rows, self.step = 1, 1
        if self.begin < self.source.size() - 8:
            self.batch_rows = ipc.read_record_batch(ipc.read_message(self.source), self.schema).num_rows
            self.step = self.source.tell() - self.begin
        with place.open_input_stream(f"{root}/docs-{number:06d}.arrow") as stream:
            self.docs = ipc.open_stream(stream).read_all()
        self.batch = lru_cache(2)(self._batch)

    def _batch(self, k: int) -> pa.RecordBatch:
        self.source.seek(self.begin + k * self.step)
        return ipc.read_record_batch(ipc.read_message(self.source), self.schema)

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence `k` of the file."""
        batch, row = self.batch(k // self.batch_rows), k % self.batch_rows
        ids, mask = (batch.column(c)[row].values for c in (0, 1))
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def span(self, first: int, count: int) -> Iterator[np.ndarray]:
        """Tokens first .. first + count, as one view per batch."""
        per_batch = self.batch_rows * self.length
        while count > 0:
            k, skip = divmod(first, per_batch)
            ids = self.batch(k).column(0).flatten().to_numpy()[skip : skip + count]
            yield ids
            first, count = first + len(ids), count - len(ids)


def write_sequences(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, length: int = LENGTH, batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """Encode the texts of `docs` (doc_id, text) into `folder` and return the manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder.of(tokenizer)
        writer, number = None, TaskContext.get().partitionId()
        for batch in batches:
            if writer is None:
                writer = SequenceWriter(folder, number, schema_of(length, encoder.vocabulary), batch_rows)
            data, at = text_bytes(batch.column(1))
            ids = batch.column(0).to_pylist()
            for row in range(0, len(ids), 256):
                parts = [data[a:b].tobytes() for a, b in zip(at[row : row + 256], at[row + 1 : row + 257], strict=False)]
                writer.add(ids[row : row + 256], [encoder.encode(part, end_id) for part in parts])
        # The tables of remembered words are bounded: the next task of this worker goes on with them.
        if writer is not None:
            n_ids, n_docs = writer.close()
            yield pa.record_batch({"file": [number], "n_ids": [n_ids], "n_docs": [n_docs]})

    spark = docs.sparkSession
    make_folder(spark, folder)
    (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
        .mapInArrow(write, "file long, n_ids long, n_docs long")
        .write.parquet(f"{folder}/manifest")
    )
    return spark.read.schema("file long, n_ids long, n_docs long").parquet(f"{folder}/manifest")


def make_folder(spark: SparkSession, folder: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)


def read_documents(folder: str, manifest: DataFrame) -> DataFrame:
    """Each document's place among all ids, its number of ids and their checksum, from the files.

    The running total over the files has one small row per file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch["file"].to_pylist(), batch["base"].to_pylist(), strict=True):
                reader = SequenceReader(folder, file)
                for docs in reader.docs.to_batches(max_chunksize=10_000):
                    firsts, counts = docs["first"].to_numpy(), docs["n_tokens"].to_numpy()
                    sums = np.empty(len(firsts), np.int64)
                    for row, (first, count) in enumerate(zip(firsts.tolist(), counts.tolist(), strict=True)):
                        crc = 0
                        for ids in reader.span(first, count):
                            crc = zlib.crc32(ids.astype("<u4"), crc)
                        sums[row] = crc
                    yield pa.record_batch(
                        {"doc_id": docs["doc_id"], "start": base + firsts, "n_tokens": counts, "ids_crc32": sums}
                    )

    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    spread = files.repartition(max(1, manifest.count()), "file")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
