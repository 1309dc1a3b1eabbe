"""Token ids as Arrow files of equal-length sequences, with zero-copy random access.

Documents are range-sorted by id, so that the ids of all files, one file after the other, are those
of all documents in ascending order. A task writes one file in Arrow's file format: record
batches of `BATCH` sequences, each a fixed-size list of `LENGTH` ids, with a fixed-size list of
booleans that is false where the last sequence of a file is padded. A reader maps the file and gets
any sequence as a view, without decoding what stands before it.

Files get a name of their own per attempt. Only those that a successful task reports are in
the index, so a lost executor or a repeated task leaves nothing wrong behind.

Ids are stored with 16 bits where the vocabulary allows, otherwise with 32.

Defined results: a null or empty text is the end id alone. Rows with a null doc_id come last.
Rows of one doc_id are ordered by a hash of their texts. An empty table has no files and gives
an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.tokens import encoder, with_end
from goldleaf.llm.words import sliced
from goldleaf.session import scratch, written

LENGTH = 2048
BATCH = 64
END = 0
SLICE = 4 << 20
INDEX = "doc_id long, n_tokens long, place long, part int, file string"


def _schema(length: int, kind: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


class _Writer:
    """Appends ids to one file, a record batch at a time."""

    def __init__(self, uri: str, length: int, kind: pa.DataType) -> None:
        from pyarrow import fs

        self.length, self.schema, self.kind = length, _schema(length, kind), kind
        files, path = fs.FileSystem.from_uri(uri)
        self.sink = files.open_output_stream(path)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.rest = np.zeros(0, dtype=kind.to_pandas_dtype())

    def _batch(self, ids: np.ndarray, held: int) -> None:
        mask = np.arange(len(ids)) < held
        self.out.write_batch(
            pa.RecordBatch.from_arrays(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
                    pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
                ],
                schema=self.schema,
            )
        )

    def add(self, ids: np.ndarray) -> None:
        self.rest = np.concatenate([self.rest, ids.astype(self.rest.dtype)])
        step = self.length * BATCH
        full = len(self.rest) // step
        for i in range(full):
            self._batch(self.rest[i * step : (i + 1) * step], step)
        self.rest = self.rest[full * step :].copy()

    def close(self) -> None:
        if len(self.rest):
            padded = np.zeros(-(-len(self.rest) // self.length) * self.length, dtype=self.rest.dtype)
            padded[: len(self.rest)] = self.rest
            self._batch(padded, len(self.rest))
        self.out.close()
        self.sink.close()


class SequenceFile:
    """Random access to one file: sequences by number, and runs of ids by place."""

    def __init__(self, uri: str) -> None:
        from pyarrow import fs

        files, path = fs.FileSystem.from_uri(uri)
        source = pa.memory_map(path) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(path)
        self.reader = pa.ipc.open_file(source)
        self.length = self.reader.schema.field("ids").type.list_size
        self._at, self._ids, self._mask = -1, None, None

    def _load(self, number: int) -> None:
        if number != self._at:
            batch = self.reader.get_batch(number)
            self._at = number
            self._ids = batch.column(0).flatten().to_numpy()
            self._mask = batch.column(1)

    def sequence(self, number: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of one sequence, the ids as a view of the file."""
        self._load(number // BATCH)
        at = number % BATCH
        return self._ids[at * self.length : (at + 1) * self.length], self._mask[at].values

    def ids(self, place: int, count: int) -> np.ndarray:
        """So many ids from a place on."""
        step, out = self.length * BATCH, []
        while count:
            self._load(place // step)
            some = self._ids[place % step : place % step + count]
            out.append(some)
            place, count = place + len(some), count - len(some)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, np.uint32)


def write_sequences(
    docs: DataFrame, folder: str, path: str, end: int = END, length: int = LENGTH, word_ends: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Write the files into a folder that all executors reach; returns their index, a row per document.

    The index tells each document's id, number of ids, file, the file's number in the global
    order, and the place of its first id in the file.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("_d"), F.col(text).alias("_t")).withColumn("_x", F.xxhash64("_t"))
    order = [F.col("_d").asc_nulls_last(), F.col("_x")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, out, at = encoder(path, word_ends), None, 0
        part = TaskContext.get().partitionId()
        uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
        kind = pa.uint16() if coder.tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16 else pa.uint32()
        for batch in batches:
            for rows, texts in sliced(batch, "_t", SLICE):
                out = out or _Writer(uri, length, kind)
                ids, counts = with_end(*coder.encode(texts), end)
                out.add(ids)
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(counts),
                        pa.array(at + np.cumsum(counts) - counts),
                        pa.array(np.full(n, part, dtype=np.int32)),
                        pa.array([uri] * n),
                    ],
                    names=["doc_id", "n_tokens", "place", "part", "file"],
                )
                at += int(counts.sum())
        if out:
            out.close()

    ranged = plain.repartitionByRange(*order).sortWithinPartitions(*order).select("_d", "_t")
    return written(ranged.mapInArrow(work, INDEX), "sequence-index")


def read_documents(index: DataFrame) -> DataFrame:
    """Read every document's ids back from the files: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32."""
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    # One row per file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("part").alias("_part"), F.coalesce(F.sum("held").over(before), F.lit(0)).alias("_start"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, None
        for batch in batches:
            crcs = []
            for place, count, file in zip(*(batch.column(c).to_pylist() for c in ("place", "n_tokens", "file"))):
                if file != name:
                    name, held = file, SequenceFile(file)
                crcs.append(zlib.crc32(held.ids(place, count).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(crcs, pa.int64())], names=[*batch.schema.names, "ids_crc32"]
            )

    read = index.mapInArrow(work, INDEX + ", ids_crc32 long")
    return read.join(F.broadcast(starts), F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("_start") + F.col("place")).cast("long").alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    folder = scratch(docs.sparkSession, "sequences")
    return read_documents(write_sequences(docs, _made(docs, folder), path))


def _made(docs: DataFrame, folder: str) -> str:
    """The folder, made through Hadoop's file systems so that it exists wherever it lies."""
    jvm = docs.sparkSession._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(docs.sparkSession._jsc.hadoopConfiguration()).mkdirs(where)
    return folder
