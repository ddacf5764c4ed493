"""Token ids on disk: documents in order, ids in patched frame-of-reference blocks.

A table of token files holds one row per segment. A segment is a run of whole documents in
ascending ``doc_id``; its ``payload`` is a series of blocks of ``BLOCK`` ids, the last one
shorter, and ``blocks`` lists the byte at which each block starts, so a reader can go to any id
without decoding what stands before it. A block is

    minimum u32 | ids u16 | exceptions u16 | width u8 | packed (ids x width bits) |
    places of exceptions u16 ... | values of exceptions u32 ...

all little-endian. The width holds the given percentile of (id - minimum); larger values are
exceptions. Rows keep ``shard`` (a range of doc_ids), ``segment`` and ``first`` (ids of the
shard before the segment); shard totals give global positions.

NULL and empty texts are documents that hold only the end id. Repeated doc_ids stay separate
documents beside each other, in order of their text; a NULL doc_id comes first. An empty table
gives an empty file table. Further columns of the input are ignored.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batch, kept_in_worker, map_batches, utf8
from .pieces import Pieces, Recent, load_config, share

BLOCK = 4096
# A segment is closed once it holds so many ids; one document is never split over segments.
SEGMENT_IDS = 1 << 16
PERCENTILE = 97.0

_HEAD = struct.Struct("<IHHB")
_SEGMENT = pa.schema(
    [
        ("shard", pa.int32()),
        ("segment", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("blocks", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)
_SEGMENT_SQL = (
    "shard int, segment int, first long, n_ids long, doc_ids array<long>, lengths array<long>, blocks array<long>, payload binary"
)


def _pack(values: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def _unpack(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * width)
    padded = np.zeros((n, 32), np.uint8)
    padded[:, :width] = bits.reshape(n, width)
    return np.packbits(padded, axis=1, bitorder="little").view("<u4").ravel()


def encode_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of 1 to ``BLOCK`` unsigned 32-bit ids."""
    low = int(ids.min())
    over = (ids - np.uint32(low)).astype(np.uint32)
    place = max(0, int(np.ceil(len(over) * percentile / 100)) - 1)
    width = int(np.partition(over, place)[place]).bit_length()
    places = np.flatnonzero(over >> np.uint32(width)) if width < 32 else np.empty(0, int)
    kept = over & np.uint32((1 << width) - 1)
    return b"".join(
        (
            _HEAD.pack(low, len(ids), len(places), width),
            _pack(kept, width) if width else b"",
            places.astype("<u2").tobytes(),
            over[places].astype("<u4").tobytes(),
        )
    )


def decode_block(data: bytes, at: int = 0) -> np.ndarray:
    """The ids of the block that starts at byte ``at``."""
    low, n, odd, width = _HEAD.unpack_from(data, at)
    at += _HEAD.size
    packed = (n * width + 7) // 8
    over = _unpack(data[at : at + packed], n, width) if width else np.zeros(n, np.uint32)
    at += packed
    if odd:
        over[np.frombuffer(data, "<u2", odd, at)] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
    return over + np.uint32(low)


def encode_blocks(ids: np.ndarray) -> tuple[bytes, list[int]]:
    """Payload and block starts."""
    parts, starts, at = [], [], 0
    for i in range(0, len(ids), BLOCK):
        part = encode_block(ids[i : i + BLOCK])
        starts.append(at)
        parts.append(part)
        at += len(part)
    return b"".join(parts), starts


def decode_blocks(payload: bytes, starts: list[int]) -> np.ndarray:
    return np.concatenate([decode_block(payload, s) for s in starts]) if starts else np.empty(0, np.uint32)


def _encoder(config: str, end_id: int):
    """A function from UTF-8 text to its ids, the end id last."""
    pieces = Pieces(config)
    if not pieces.known:
        return lambda text: np.array([*pieces.encode(text.decode()), end_id], np.uint32)
    small = max(pieces.library.get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16
    code, kind = ("H", np.uint16) if small else ("I", np.uint32)

    def packed(ids: list[int]) -> bytes:
        return array(code, ids).tobytes()

    found = Recent(lambda piece: packed(pieces.merge(piece))).__getitem__
    end = packed([end_id])

    def encode(text: bytes) -> np.ndarray:
        return np.frombuffer(b"".join([*pieces.spread(text, found, packed), end]), kind).astype(np.uint32)

    return encode


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode all texts and write the file table to ``path``, which must not exist.

    Rows are range-partitioned by ``doc_id``, so every task writes a run of documents; ranges are
    as many as ``spark.sql.shuffle.partitions`` or fewer, as adaptive execution joins small ones.
    """
    spark = docs.sparkSession
    shared = share(spark, load_config(tokenizer))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        config = shared.value
        encode = kept_in_worker(("token files", hash(config), end_id), lambda: _encoder(config, end_id))
        shard, segment, first = 0, 0, 0
        ids, names, held = [], [], 0

        def close():
            payload, starts = encode_blocks(np.concatenate(ids))
            row = [[shard], [segment], [first], [held], [names], [[len(x) for x in ids]], [starts], [payload]]
            return batch(_SEGMENT, *row)

        for rows in batches:
            shards = rows.column("shard")
            if len(shards):
                shard = shards[0].as_py()
            for name, text in zip(rows.column("doc_id").to_pylist(), utf8(rows.column("text")), strict=True):
                own = encode(text)
                ids.append(own)
                names.append(name)
                held += len(own)
                if held >= SEGMENT_IDS:
                    yield close()
                    segment, first = segment + 1, first + held
                    ids, names, held = [], [], 0
        if ids:
            yield close()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
        .withColumn("shard", F.spark_partition_id())
    )
    map_batches(ordered, segments, _SEGMENT_SQL).write.option("compression", "uncompressed").parquet(path)


def shard_starts(files: DataFrame) -> DataFrame:
    """Ids before each shard. One row per writing task, so it may be broadcast."""
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document; ``ids`` are little-endian u32."""
    files = spark.read.schema(_SEGMENT_SQL).parquet(path)
    out = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                row = {n: rows.column(n)[i] for n in ("shard", "first", "doc_ids", "lengths", "blocks")}
                row = {n: v.as_py() for n, v in row.items()}
                ids = decode_blocks(rows.column("payload")[i].as_py(), row["blocks"]).astype("<u4").tobytes()
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                yield batch(
                    out,
                    row["doc_ids"],
                    [row["shard"]] * len(ends),
                    row["first"] + starts,
                    row["lengths"],
                    [ids[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)],
                )

    found = map_batches(files, documents, "doc_id long, shard int, at long, n_tokens long, ids binary")
    starts = F.broadcast(shard_starts(files))
    return found.join(starts, "shard", "left").select("doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids")
