"""Runs of repeated words: maximal stretches with a smallest period, by tiles per octave of periods.

A document's words become numbers. For each octave of periods q, from 2^k up to 2^(k+1), the
document is covered by overlapping tiles, one around every border c, the multiples of 2^k. A run of
four periods matches itself shifted by q over at least 3 * 2^k words, so it holds a border whose
next 2^(k+1) words match; tiles without such a match (compared by block hashes, all at once) are
skipped. In the others two Z-functions from the border, one forward and one backward, give the stretch
that matches for every q of the octave, and a period that is a multiple of a smaller one is left out.
The fragments of all tiles are shuffled by document and period, and stitched where they touch.

The tiles of a document of up to ``LONG_BYTES`` are solved where it is read. A longer one is first exploded into
slices of tiles, dealt over all tasks. Work is n log n in a document's words.

Defined cases: words are runs without ASCII white space; a NULL, empty or short text has no runs;
repeated rows are documents of their own, ids may be NULL; an empty table gives no rows; further
columns of the input are ignored. Exponents are told apart exactly for documents of up to 2^26 words.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import materialise
from .common import batch, bounded_batches, map_batches, mix64, utf8

# A run has at least so many words and so many periods. The tiles rest on PERIODS >= 4.
WORDS, PERIODS = 6, 4
# Words ahead of its border that a tile holds, in units of its octave.
AHEAD = 8
LONG_BYTES = 8 << 20
_POWERS = mix64(np.arange(1, 64, dtype=np.uint64)) | np.uint64(1)
# Words of a slice of a long document, besides its margins; at least 32 of the octave's least period.
SLICE_WORDS = 1 << 18


def codes_of(texts: list[list[bytes]]) -> tuple[list[np.ndarray], int]:
    """Numbers that are equal where words are, and a number above all of them."""
    number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(texts)))}
    return [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in texts], len(number)


def z_function(s: list[int]) -> list[int]:
    """For every place, how far the sequence from there agrees with its beginning."""
    n = len(s)
    z = [0] * n
    z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve_tile(codes: np.ndarray, border: int, k: int, wanted: list[int]) -> Iterator[tuple[int, int, int, bool]]:
    """(q, start, end, least): words of the tile that equal the word q later, for each wanted q of the
    octave, and whether q is the least period there."""
    unit = 1 << k
    forward = z_function(codes[border : border + AHEAD * unit].tolist())
    behind = codes[max(0, border - unit) : border][::-1].tolist()
    around = codes[max(0, border - unit) : border + 2 * unit][::-1].tolist()
    backward = z_function([*behind, -1, *around])[len(behind) + 1 :] if behind else [0] * len(around)
    # A period below the octave that the next 2 * unit words have: its multiples are no smallest periods.
    small = next((p for p in range(1, unit) if forward[p] >= 2 * unit - p), 0)
    for q in wanted:
        if forward[q] >= 2 * unit:
            yield q, border - min(backward[2 * unit - q], len(behind)), border + forward[q], not small or q % small > 0


def solve(codes: np.ndarray, octaves: tuple[int, int], own: tuple[int, int]) -> list[tuple[int, int, int]]:
    """Fragments (q, start, end) from the borders in ``own``; those that touch are joined."""
    n = len(codes)
    found: dict[int, list] = defaultdict(list)
    hashes = mix64(codes + 1)
    with np.errstate(over="ignore"):
        for k in range(octaves[1]):
            unit = 1 << k
            if n < 3 * unit:
                break
            # Hashes of the next 2 * unit words from each place.
            hashes = hashes[:-unit] * _POWERS[k] + hashes[unit:]
            if k < octaves[0]:
                continue
            # Those of the places of the next unit, against that of the border.
            rows = -(-len(hashes) // unit)
            table = np.zeros(rows * unit, np.uint64)
            table[: len(hashes)] = hashes
            table = table.reshape(rows, unit)
            same = table[1:] == table[:-1, :1]
            if not len(same):
                continue
            same[-1, len(hashes) - (rows - 1) * unit :] = False
            # How far each period is known to match; a border is passed over if the next one still lies in all of that.
            reach: dict[int, int] = {}
            for j in np.flatnonzero(same.any(axis=1)).tolist():
                border = j * unit
                if not own[0] <= border < own[1]:
                    continue
                wanted = (np.flatnonzero(same[j]) + unit).tolist()
                if border + unit < own[1] and all(reach.get(q, 0) >= border + 3 * unit for q in wanted):
                    continue
                for q, start, end, least in solve_tile(codes, border, k, wanted):
                    reach[q] = end
                    if least:
                        last = found[q]
                        if last and start <= last[-1][2]:
                            last[-1] = (q, last[-1][1], max(last[-1][2], end))
                        else:
                            last.append((q, start, end))
    return [f for per in found.values() for f in per]


def solve_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, as fragments. Texts of as many octaves are solved behind each other, with a
    word of its own between two; no fragment reaches over it, as it is longer than its period."""
    codes, free = codes_of(texts)
    found: list[list] = [[] for _ in texts]
    groups: dict[int, list[int]] = defaultdict(list)
    for i, own in enumerate(codes):
        if len(own) >= WORDS:
            groups[octaves_of(len(own))].append(i)
    for top, members in groups.items():
        starts = np.cumsum([0, *(len(codes[i]) + 1 for i in members)])
        line = np.concatenate([part for at, i in enumerate(members) for part in (codes[i], [free + at])])
        for q, start, end in solve(line, (0, top), (0, len(line))):
            if end - start + q >= max(WORDS, PERIODS * q):
                at = int(np.searchsorted(starts, start, side="right")) - 1
                found[members[at]].append((q, start - int(starts[at]), end - int(starts[at])))
    return found


def octaves_of(n: int) -> int:
    """Octaves that a run of ``n`` words can reach."""
    return max(0, n // PERIODS).bit_length()


def slices(n: int, words: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(lowest octave, end of octaves, first word, end of words, first border, end of borders) of a long document."""
    low, top = 0, octaves_of(n)
    while low < top:
        high = max(low + 1, min(top, (words // 32).bit_length()))
        unit = 1 << (high - 1)
        step = -(-max(words, 32 * unit) // unit) * unit
        for at in range(0, n, step):
            first = max(0, at - unit)
            yield low, high, first, min(n, at + step + AHEAD * unit), at, min(n, at + step)
        low = high


_SOLVED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("fragments", pa.list_(pa.list_(pa.int64()))),
        ("pending", pa.bool_()),
        ("words", pa.binary()),
        ("words_sha256", pa.string()),
    ]
)


def _solved(docs: DataFrame, long_bytes: int) -> DataFrame:
    """One row per document: its words' number and checksum, its runs, and its words if it has any.

    Fragments of a document that is solved at once are whole, so those that are no runs are left
    out. A longer document is ``pending``: its words come along unsolved.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            given = utf8(rows.column("text"))
            texts = [t.split() for t in given]  # on bytes, this knows ASCII only
            pending = [len(t) > long_bytes for t in given]
            found = solve_texts([[] if p else words for words, p in zip(texts, pending, strict=True)])
            joined = [b" ".join(words) for words in texts]
            kept = [j if f or p else None for j, f, p in zip(joined, found, pending, strict=True)]
            yield batch(
                _SOLVED, rows.column("doc_id"), [len(t) for t in texts], found, pending, kept, [hashlib.sha256(j).hexdigest() for j in joined]
            )

    kind = "doc_id long, n long, fragments array<array<long>>, pending boolean, words binary, words_sha256 string"
    return map_batches(docs, run, kind)


def _long_fragments(docs: DataFrame, words: int) -> DataFrame:
    """(id, q, s, e) of documents (id, words): slices are dealt over tasks and solved apart."""
    out = pa.schema([("id", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("at", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("codes", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name, text in zip(rows.column("id").to_pylist(), rows.column("words").to_pylist(), strict=True):
                codes = codes_of([text.split()])[0][0].astype("<i4")
                for low, high, start, stop, first, last in slices(len(codes), words):
                    yield batch(out, [name], [low], [high], [start], [first - start], [last - start], [codes[start:stop].tobytes()])

    found = pa.schema([("id", pa.int64()), ("q", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for r in rows.to_pylist():
                codes = np.frombuffer(r["codes"], "<i4").astype(np.int64)
                parts = solve(codes, (r["low"], r["high"]), (r["first"], r["last"]))
                if parts:
                    q, s, e = zip(*parts, strict=True)
                    yield batch(found, [r["id"]] * len(q), q, np.array(s) + r["at"], np.array(e) + r["at"])

    kind = "id long, low int, high int, at long, first long, last long, codes binary"
    dealt = map_batches(docs.select("id", "words"), cut, kind).repartition("id", "low", "at")
    return map_batches(dealt, run, "id long, q long, s long, e long")


def stitched(fragments: DataFrame) -> DataFrame:
    """(id, start, length, period) of every run: fragments (id, q, s, e) of a document and period, joined where they touch."""
    ordered = W.partitionBy("id", "q").orderBy("s", "e")
    before = F.max("e").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    begun = F.sum((before.isNull() | (F.col("s") > before)).cast("int")).over(ordered.rowsBetween(W.unboundedPreceding, 0))
    whole = fragments.withColumn("piece", begun).groupBy("id", "q", "piece").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    runs = whole.select("id", F.col("s").alias("start"), (F.col("e") - F.col("s") + F.col("q")).alias("length"), F.col("q").alias("period"))
    return runs.where((F.col("length") >= WORDS) & (F.col("length") >= PERIODS * F.col("period")))


def _collapsed(words: pa.Array, runs: pa.Array) -> pa.Array:
    """The words that no run repeats."""
    out = []
    for text, own in zip(words.to_pylist(), runs.to_pylist(), strict=True):
        parts = text.split(b" ")
        change = np.zeros(len(parts) + 1, np.int64)
        for r in own:
            change[r["start"] + r["period"]] += 1
            change[r["start"] + r["length"]] -= 1
        out.append(b" ".join(parts[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()))
    return pa.array(out, pa.binary())


def _no_runs():
    return F.array().cast("array<struct<start:bigint,period:bigint,length:bigint>>")


def periodic_runs(docs: DataFrame, long_bytes: int = LONG_BYTES, slice_words: int = SLICE_WORDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id``, ``n_words``, ``runs`` and what is left of the words.

    ``runs`` are structs (start, period, length) in that order. ``collapsed`` holds the words that no
    run repeats, joined by one space; it is NULL where every word stays. ``collapsed_sha256`` is never NULL.
    """
    bounded_batches(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Ids are fixed by the files they are written to.
    solved = materialise(_solved(given, long_bytes).withColumn("id", F.monotonically_increasing_id()), "periods")
    long = solved.where("pending")
    parts = solved.select("id", F.explode("fragments").alias("f"))
    fragments = parts.select("id", *[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(("q", "s", "e"))])
    if not long.select("id").isEmpty():
        fragments = fragments.unionByName(_long_fragments(long, slice_words))
    runs = stitched(fragments).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    # Only documents that may have runs are shuffled with their words.
    words = solved.where("words IS NOT NULL").drop("fragments", "pending")
    found = words.join(runs, "id", "left").withColumn("runs", F.coalesce("runs", _no_runs()))
    left = arrow_udf(_collapsed, "binary")(F.col("words"), F.col("runs"))
    collapsed = F.when(F.size("runs") > 0, left.cast("string"))
    found = found.withColumn("collapsed", collapsed).drop("words")
    others = solved.where("words IS NULL").drop("fragments", "pending", "words").withColumns({"runs": _no_runs(), "collapsed": F.lit(None).cast("string")})
    digest = F.coalesce(F.sha2("collapsed", 256), F.col("words_sha256"))
    out = found.unionByName(others)
    return out.select("doc_id", F.col("n").alias("n_words"), "runs", "collapsed", digest.alias("collapsed_sha256"))
