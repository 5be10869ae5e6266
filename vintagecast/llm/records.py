"""Token ids in files of length-delimited binary records with an offset index.

A record is ``length (u64) | masked crc32 of the length (u32) | payload |
masked crc32 of the payload (u32)``, all little-endian.  The payload of a
document is ``doc_id (i64, the least for null) | width of an id in bytes (u8) |
ids`` with two bytes an id where the vocabulary allows it.  Beside every file
``part-N.rec`` lies ``part-N.idx``: per record its document, its place in the
file, its length and its number of ids, so that records can be read in any
order without scanning.

Documents are dealt by ranges of doc_id, so files in order hold ascending ids.
A task writes files under a name of its own; only files that the manifest
names count, so a task that is run again leaves nothing in the result.

Defined cases: null or empty text is the end id alone; rows that repeat a
``doc_id`` stand in the order of their texts; a null ``doc_id`` comes first; an
empty table gives an empty manifest; other columns don't matter.
"""

from __future__ import annotations

import random
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import parts_for, scratch, small_batches, staged
from .encode import encoder

END_ID = 0
NULL_ID = -(2**63)
#: A task starts a new file after so many bytes.
FILE_BYTES = 64 << 20
_HEAD, _DOC = struct.Struct("<QI"), struct.Struct("<qB")
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u4"), ("n_tokens", "<u4")])


def masked(data: bytes) -> int:
    """crc32, rotated and shifted, so that checksums of data that holds checksums stay sound."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def frames(data: bytes, name: str = "") -> Iterator[tuple[int, bytes]]:
    """(place, payload) of every record; raises ValueError where a checksum or the end doesn't fit."""
    at = 0
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError(f"{name}: cut off at {at}")
        length, check = _HEAD.unpack_from(data, at)
        end = at + 12 + length
        if masked(data[at : at + 8]) != check or end + 4 > len(data):
            raise ValueError(f"{name}: bad length at {at}")
        payload = data[at + 12 : end]
        if masked(payload) != struct.unpack_from("<I", data, end)[0]:
            raise ValueError(f"{name}: bad payload at {at}")
        yield at, payload
        at = end + 4


def pack_document(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return _DOC.pack(NULL_ID if doc_id is None else doc_id, width) + ids.astype(f"<u{width}").tobytes()


def unpack_document(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, width = _DOC.unpack_from(payload)
    return (None if doc_id == NULL_ID else doc_id), np.frombuffer(payload, f"<u{width}", offset=_DOC.size)


MANIFEST = "part int, number int, path string, n_docs long, n_tokens long, n_bytes long"


def _write(path: str, folder: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        width = 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 else 4
        part, own = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        fs, root = pafs.FileSystem.from_uri(folder)
        number, out, index, size, made = 0, None, [], 0, []

        def close() -> None:
            nonlocal number, out, index, size
            out.close()
            with fs.open_output_stream(f"{root}/{name()}.idx") as f:
                f.write(np.array(index, INDEX).tobytes())
            made.append((part, number, f"{name()}.rec", len(index), sum(x[3] for x in index), size))
            number, out, index, size = number + 1, None, [], 0

        name = lambda: f"part-{part:06d}-{number:04d}-{own}"
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(f"{root}/{name()}.rec", buffer_size=1 << 20)
                ids = np.append(enc.encode(text.as_py()), np.uint32(end_id))
                record = frame(pack_document(doc_id, ids, width))
                out.write(record)
                index.append((NULL_ID if doc_id is None else doc_id, size, len(record), len(ids)))
                size += len(record)
                if size >= FILE_BYTES:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*made)) or [[]] * 6, [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 3])], names=[x.split()[0] for x in MANIFEST.split(", ")])

    return write


def write_records(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encodes and writes all documents to ``folder`` (a URI that all executors
    reach) and returns the staged manifest with every file's first token."""
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = docs.repartitionByRange(parts_for(docs, "text"), "doc_id").sortWithinPartitions("doc_id", "text")
    made = staged(dealt.mapInArrow(_write(tokenizer, folder, end_id), MANIFEST), "manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return made.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, data, first in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
            rows = []
            for _, payload in frames(data.as_py(), path):
                doc_id, ids = unpack_document(payload)
                rows.append((doc_id, first, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                first += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_records(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document of the files in the manifest, every checksum tested: doc_id,
    start (ids before it), n_tokens, ids_crc32."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.rec").load(folder).select("path", "content")
    named = F.element_at(F.split("path", "/"), -1)
    listed = manifest.select(F.col("path").alias("_path"), "first")
    files = files.join(F.broadcast(listed), named == F.col("_path"))  # one narrow row for each file
    return files.select("path", "content", "first").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def shuffled(folder: str, names: list[str], seed: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of the files in a seeded random order, each read by its place in
    the index (a helper of loaders; one file's index at a time is small)."""
    fs, root = pafs.FileSystem.from_uri(folder)
    places = []
    for i, name in enumerate(names):
        with fs.open_input_file(f"{root}/{name.removesuffix('.rec')}.idx") as f:
            places += [(i, int(x["offset"]), int(x["length"])) for x in np.frombuffer(f.read(), INDEX)]
    random.Random(seed).shuffle(places)
    files = [fs.open_input_file(f"{root}/{name}") for name in names]
    for i, at, length in places:
        files[i].seek(at)
        ((_, payload),) = frames(files[i].read(length), names[i])
        yield unpack_document(payload)


def token_records(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes the documents' records and reads them back: doc_id, start,
    n_tokens (with the end id), ids_crc32."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "records")
    manifest = staged(write_records(docs, tokenizer, folder, end_id), "manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_records(spark, folder, manifest)
