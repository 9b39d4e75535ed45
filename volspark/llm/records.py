"""Token ids in length-delimited binary files, with an index for reads in any order.

A shard is two files. ``shard-NNNNNN.rec`` holds records one after the other:

    length of the data, u64 | masked checksum of those 8 bytes, u32 | data | masked checksum, u32

and the data are: id of the document, i64; 1 if it is null, u8; bytes per token id, u8; the token
ids. ``shard-NNNNNN.idx`` holds for each record its place and its number of ids, both u64. All
numbers are little-endian. A checksum is the CRC-32 of zlib turned right by 15 bits plus a
constant, so that checksums of data that hold checksums stay useful. Ids take two bytes if the
vocabulary has at most 65,536 entries, else four.

Tasks write a shard under a name of their own and rename it when it is whole; a repeated task
writes the same bytes. A manifest (Parquet) tells the shards, their order and their sizes.

Defined results: documents are in ascending order of id, null ids first, ties by a hash of their text; a
null or empty text is the end id alone; repeated rows are records of their own; an empty table
makes no record. Texts are encoded whole. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..checkpoint import ensure_checkpoint_dir
from .corpus import parts
from .tokens import as_ids, kept

LENGTH, SUM, HEAD, ENTRY = "<Q", "<I", "<qBB", "<QQ"
MASK = 0xA282EAD8
#: Records handed to Spark together, and texts encoded together, hold about so many bytes.
BATCH_BYTES = 4 << 20
#: Bytes that are read from a file at once.
READ_BYTES = 1 << 18
RECORD = "shard int, position long, doc_id long, start long, n_tokens long, ids binary"
COLUMNS = pa.schema(
    [("shard", pa.int32()), *((c, pa.int64()) for c in ("position", "doc_id", "start", "n_tokens")), ("ids", pa.binary())]
)


def masked(data: bytes) -> int:
    check = zlib.crc32(data)
    return (((check >> 15) | (check << 17)) + MASK) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    length = struct.pack(LENGTH, len(data))
    return b"".join((length, struct.pack(SUM, masked(length)), data, struct.pack(SUM, masked(data))))


def unframe(read) -> bytes:
    """The next record's data; ``read`` gives that many bytes. Raises on a damaged record."""
    length = read(struct.calcsize(LENGTH))
    if len(length) < struct.calcsize(LENGTH) or struct.unpack(SUM, read(struct.calcsize(SUM)))[0] != masked(length):
        raise ValueError("damaged record: its length")
    data = read(struct.unpack(LENGTH, length)[0])
    if struct.unpack(SUM, read(struct.calcsize(SUM)))[0] != masked(data):
        raise ValueError("damaged record: its data")
    return data


def serialise(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return struct.pack(HEAD, doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()


def parse(data: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, null, width = struct.unpack_from(HEAD, data)
    return None if null else doc_id, np.frombuffer(data, f"<u{width}", offset=struct.calcsize(HEAD)).astype("<u4")


def filesystem(folder: str):
    """The file system of a folder's URI (local, HDFS, S3, GCS) and its path there."""
    from pyarrow import fs

    if folder.startswith("file:"):
        return fs.LocalFileSystem(), folder.removeprefix("file:").replace("//", "/", 1).replace("//", "/")
    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


def shared_folder(spark: SparkSession) -> str:
    """A new folder where all executors read and write."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/records-{uuid.uuid4().hex}"


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Encode every text, add the end id, and write records in ascending order of ``doc_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        encoder = kept(tokenizer)
        width = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        end = np.array([end_id], dtype="<u4").tobytes()
        name, own = f"{root}/shard-{shard:06d}", f"{root}/.shard-{shard:06d}-{attempt}"
        records = tokens = place = 0
        with store.open_output_stream(f"{own}.rec") as rec, store.open_output_stream(f"{own}.idx") as idx:
            for keys, texts in parts(batches, BATCH_BYTES):
                framed, entries = [], []
                for key, raw in zip(keys.to_pylist(), encoder.encode_all(texts)):
                    ids = as_ids(raw + end)
                    data = frame(serialise(key, ids, width))
                    framed.append(data)
                    entries.append(struct.pack(ENTRY, place, len(ids)))
                    records, tokens, place = records + 1, tokens + len(ids), place + len(data)
                rec.write(b"".join(framed))
                idx.write(b"".join(entries))
        for kind in ("rec", "idx"):
            store.move(f"{own}.{kind}", f"{name}.{kind}")
        if records:
            columns = [pa.array([shard], pa.int32()), pa.array([records], pa.int64()), pa.array([tokens], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "records", "tokens"])

    ordered = docs.select("doc_id", "text").orderBy("doc_id", F.xxhash64("text"))
    texts = ordered.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    manifest = texts.mapInArrow(run, "shard int, records long, tokens long")
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest, with the number of ids in all earlier shards (a row per shard)."""
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.parquet(f"{folder}/manifest").withColumn(
        "start", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))
    )


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    group, size = [], 0
    for row in rows:
        group.append(row)
        size += len(row[-1])
        if size > BATCH_BYTES:
            yield _batch(group)
            group, size = [], 0
    if group:
        yield _batch(group)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), COLUMNS)], schema=COLUMNS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    return (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All records in the order of the files: shard, position, doc_id, start, n_tokens, ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        store, root = filesystem(folder)
        for shard, records, start in _rows(batches):
            with store.open_input_stream(f"{root}/shard-{shard:06d}.rec", buffer_size=READ_BYTES) as rec:
                for position in range(records):
                    doc_id, ids = parse(unframe(rec.read))
                    yield shard, position, doc_id, start, len(ids), ids.tobytes()
                    start += len(ids)

    table = shards(spark, folder).select("shard", "records", "start")
    spread = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return table.repartition(spread, "shard").mapInArrow(lambda b: _batches(rows(b)), RECORD)


def read_shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """All records in a random order that ``seed`` fixes, each fetched at its place by the index."""

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = filesystem(folder)
        for batch in batches:
            for shard, start in zip(batch["shard"], batch["start"]):
                with store.open_input_stream(f"{root}/shard-{shard:06d}.idx") as idx:
                    index = np.frombuffer(idx.read(), "<u8").reshape(-1, 2).astype(np.int64)
                yield pd.DataFrame(
                    {
                        "shard": shard,
                        "position": np.arange(len(index)),
                        "place": index[:, 0],
                        "start": start + np.cumsum(index[:, 1]) - index[:, 1],
                    }
                )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        store, root = filesystem(folder)
        files = {}
        for shard, position, place, start in _rows(batches):
            if shard not in files:
                if len(files) > 64:
                    files.popitem()[1].close()
                files[shard] = store.open_input_file(f"{root}/shard-{shard:06d}.rec")
            rec = files[shard]
            rec.seek(place)
            doc_id, ids = parse(unframe(rec.read))
            yield shard, position, doc_id, start, len(ids), ids.tobytes()

    index = shards(spark, folder).mapInPandas(entries, "shard int, position long, place long, start long")
    turn = F.xxhash64(F.lit(seed), "shard", "position")
    return index.orderBy(turn, "shard", "position").mapInArrow(lambda b: _batches(rows(b)), RECORD)
