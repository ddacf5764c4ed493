"""Removal of lines that many documents share, decided on sorted line hashes.

A line's key is the line stripped of ASCII white space at both ends, with A-Z in lower case.
Tasks send one row (hash of the key, document) per document and key. The rows are
range-partitioned on (hash, document) and sorted inside each range, later documents first, so
one key may spread over many ranges. A pass over the sorted ranges then streams: the first
document of a key keeps its lines, all others lose them once the key is known to stand in
enough documents. Only keys that cross a range's border need figures of other ranges; there are
at most two of them per range. The result is one compressed keep bitmap per document that loses
lines, not text.

Keys are compared by a 128-bit hash. A NULL or empty text is one empty line. Documents are
counted by ``doc_id`` (NULL is one document, below all others): rows that repeat a doc_id count
once, and each of them is treated by its own text. Without documents nothing is dropped. Extra
columns stay outside; results are joined back by (doc_id, row key).
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import materialise
from .common import batch, bounded_batches, map_batches, row_key, utf8

_SPACES = b" \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCS = 3
# Stands for a NULL doc_id while sorting.
_NO_ID = -(1 << 63)


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACES).lower()  # bytes.lower() changes A-Z only


def _long_enough(key: bytes, chars: int) -> bool:
    return len(key) >= chars and (key.isascii() or len(key.decode()) >= chars)


def _rows_of_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h, doc, row, places): the lines of a document that have one key."""
    out = pa.schema([("h", pa.binary()), ("doc", pa.int64()), ("row", pa.int64()), ("places", pa.list_(pa.int32()))])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found: list[list] = [[], [], [], []]
            for doc, row, text in zip(
                rows.column("doc").to_pylist(), rows.column("row").to_pylist(), utf8(rows.column("text")), strict=True
            ):
                keys = defaultdict(list)
                for place, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    if _long_enough(key, min_chars):
                        keys[key].append(place)
                for key, places in keys.items():
                    for column, value in zip(found, (xxhash.xxh3_128_digest(key), doc, row, places), strict=True):
                        column.append(value)
            yield batch(out, *found)

    source = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"),
        row_key().alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    return map_batches(source, lines, "h binary, doc long, row long, places array<int>")


def _sorted_ranges(rows: DataFrame) -> DataFrame:
    order = ["h", F.col("doc").desc(), "row"]
    # Ranges are cut by (hash, document) only, so rows of one document and key stay together.
    ranged = rows.repartitionByRange("h", F.col("doc").desc()).sortWithinPartitions(*order)
    return materialise(ranged.withColumn("part", F.spark_partition_id()), "lines")


def _borders(ranges: DataFrame) -> dict[int, dict[bytes, tuple[int, bool]]]:
    """Per range and border-crossing key: documents in all ranges, and whether an earlier range has it.

    At most two keys per range cross a border, so the result is bounded by the number of ranges.
    """
    spans = ranges.groupBy("part").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).orderBy("part").collect()
    crossing = {a["hi"] for a, b in zip(spans, spans[1:], strict=False) if bytes(a["hi"]) == bytes(b["lo"])}
    if not crossing:
        return {}
    keys = ranges.sparkSession.createDataFrame([(bytes(h),) for h in crossing], "h binary")
    held = (
        ranges.join(F.broadcast(keys), "h", "left_semi")
        .select("part", "h", "doc")
        .distinct()
        .groupBy("part", "h")
        .agg(F.count("*").alias("n"))
        .collect()
    )
    total, first = defaultdict(int), {}
    for r in held:
        h = bytes(r["h"])
        total[h] += r["n"]
        first[h] = min(first.get(h, r["part"]), r["part"])
    out: dict[int, dict[bytes, tuple[int, bool]]] = defaultdict(dict)
    for r in held:
        h = bytes(r["h"])
        out[r["part"]][h] = (total[h], first[h] < r["part"])
    return dict(out)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, row, places): lines to drop, one row per document and key."""
    ranges = _sorted_ranges(_rows_of_lines(docs, min_chars))
    borders = ranges.sparkSession.sparkContext.broadcast(_borders(ranges))
    out = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("places", pa.list_(pa.int32()))])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, key, seen, last, total, waiting = None, None, 0, None, 0, []
        for rows in batches:
            drop: list[tuple] = []
            columns = [rows.column(n).to_pylist() for n in ("part", "h", "doc", "row", "places")]
            for p, h, doc, row, places in zip(*columns, strict=True):
                if p != part or h != key:
                    # Files hold one range each and are read in order; a range may be read in several tasks.
                    part, key, last, waiting = p, h, None, []
                    total, later = borders.value.get(p, {}).get(h, (0, False))
                    seen = 1 if later else 0  # an earlier range holds the keeper
                if doc != last:
                    seen, last = seen + 1, doc
                if seen == 1:
                    continue
                waiting.append((doc, row, places))
                if max(seen, total) >= min_docs:
                    drop += waiting
                    waiting = []
            if drop:
                yield batch(out, *zip(*drop, strict=True))

    # A written range may come back in pieces; ranges are bounded, so each goes to one task again.
    whole = ranges.repartition("part").sortWithinPartitions("part", "h", F.col("doc").desc(), "row")
    return map_batches(whole, stream, "doc long, row long, places array<int>")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, row, keep): a compressed bitmap for every document that loses lines.

    Bit i, lowest first, says whether line i stays; lines past the last bit stay.
    """

    @arrow_udf("binary")
    def bitmap(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            maps = []
            for places in lists.to_pylist():
                keep = np.ones(-(-(max(places) + 1) // 8) * 8, np.uint8)  # whole bytes
                keep[places] = 0
                maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
            yield pa.array(maps, pa.binary())

    dropped = dropped_lines(docs, min_chars, min_docs)
    return dropped.groupBy("doc", "row").agg(bitmap(F.flatten(F.collect_set("places"))).alias("keep"))


def keep_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``kept`` (the text without dropped lines), ``n_lines`` and ``n_dropped``."""
    bounded_batches(docs.sparkSession)

    @arrow_udf("struct<kept:string,n_dropped:long>")
    def apply(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, maps in batches:
            kept, counts = [], []
            for text, packed in zip(utf8(texts), maps.to_pylist(), strict=True):
                if packed is None:
                    kept.append(None)
                    counts.append(0)
                    continue
                lines = text.split(b"\n")
                keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), bitorder="little")
                stay = [line for i, line in enumerate(lines) if i >= len(keep) or keep[i]]
                kept.append(b"\n".join(stay).decode())
                counts.append(len(lines) - len(stay))
            yield pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(counts, pa.int64())], ["kept", "n_dropped"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = [c for c in docs.columns if c not in ("kept", "n_lines", "n_dropped")]
    keyed = docs.select(
        *names, F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("__doc"), row_key().alias("__row")
    )
    maps = bitmaps.select(F.col("doc").alias("__doc"), F.col("row").alias("__row"), F.col("keep").alias("__keep"))
    joined = keyed.join(maps, ["__doc", "__row"], "left")
    # Only texts that lose lines leave the JVM.
    done = joined.withColumn("__a", apply(F.when(F.col("__keep").isNotNull(), text), F.col("__keep")))
    return done.select(
        *names,
        F.coalesce(F.col("__a.kept"), text).alias("kept"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.col("__a.n_dropped").alias("n_dropped"),
    )
