"""Fill-in-middle transformation over chunks whose borders follow the content.

A text is cut by a rolling hash into chunks, so passages that many documents share give the same
chunks wherever they stand. A chunk is summarised once: its number of code points, whether it holds
a sentinel, and its first and last bytes, with which sentinels that cross a border are seen. The
summaries are kept by hash and content, up to a bound, and taken only if the content is the same.
Adding the chunks' counts gives a text's length and the chunk that a document cut falls into; only
that chunk is looked at byte by byte.

Defined cases: a NULL text is empty, an empty text and one that holds a sentinel stay plain; a NULL
id draws as the empty id; repeated rows come out alike; an empty table gives no rows. Texts of any
length are hashed a ``SEGMENT`` at a time. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import bounded_batches, mix64, utf8

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
PLAIN, PSM, SPM = "plain", "psm", "spm"

# The rolling hash covers so many bytes; a chunk ends where its upper bits are zero, one byte in 512.
WINDOW = 32
_BITS = 9
LEAST, MOST = 128, 4096
# Bytes hashed at a time.
SEGMENT = 1 << 20
# Bytes of chunks in one generation of a task's cache.
CACHE_BYTES = 8 << 20

_GEAR = mix64(np.arange(1, 257, dtype=np.uint64))


def _ends(data: np.ndarray) -> np.ndarray:
    """Places in ``data`` after which the rolling hash of the last ``WINDOW`` bytes asks for a border."""
    h, step = _GEAR[data], 1
    while step < WINDOW:
        longer = h.copy()
        longer[step:] += h[:-step] << np.uint64(step)
        h, step = longer, step * 2
    return np.flatnonzero(h >> np.uint64(64 - _BITS) == 0) + 1


def borders(text: bytes) -> list[int]:
    """Ends of the chunks of a text, the last one its length."""
    data, cuts, last = np.frombuffer(text, np.uint8), [], 0
    for at in range(0, len(data), SEGMENT):
        before = max(0, at - WINDOW)
        for end in (_ends(data[before : at + SEGMENT]) + before).tolist():
            if end <= at:
                continue
            while end - last > MOST:
                last += MOST
                cuts.append(last)
            if end - last >= LEAST:
                last = end
                cuts.append(last)
    while len(data) - last > MOST:
        last += MOST
        cuts.append(last)
    if len(data) > last:
        cuts.append(len(data))
    return cuts


def _leads(chunk: bytes) -> np.ndarray:
    """Places of bytes that begin a code point."""
    return np.flatnonzero(np.frombuffer(chunk, np.uint8) & 0xC0 != 0x80)


def _marked(data: bytes) -> bool:
    return any(m in data for m in _MARKS)


class Summaries:
    """(code points, holds a sentinel) per chunk, kept in two generations of bounded size."""

    def __init__(self, most: int = CACHE_BYTES):
        self.most, self.held, self.now, self.older = most, 0, {}, {}
        self.shared = 0

    def of(self, chunk: bytes) -> tuple[int, bool]:
        key = xxhash.xxh3_64_intdigest(chunk)
        known = self.now.get(key) or self.older.get(key)
        if known is not None and known[0] == chunk:
            self.shared += 1
        else:
            known = chunk, len(_leads(chunk)), _marked(chunk)
        if key not in self.now:
            if self.held > self.most:
                self.now, self.older, self.held = {}, self.now, 0
            self.now[key] = known
            self.held += len(chunk)
        return known[1:]


def measured(text: bytes, summaries: Summaries) -> tuple[list[int], np.ndarray, bool]:
    """Ends of the chunks, code points up to each end, and whether a sentinel occurs."""
    ends, counts, marked, start, tail = borders(text), [], False, 0, b""
    reach = max(map(len, _MARKS)) - 1
    for end in ends:
        chunk = text[start:end]
        n, own = summaries.of(chunk)
        counts.append(n)
        marked = marked or own or _marked(tail + chunk[:reach])
        tail, start = (tail + chunk[-reach:])[-reach:], end
    return ends, np.cumsum(counts, dtype=np.int64), marked


def located(text: bytes, ends: list[int], upto: np.ndarray, place: int) -> int:
    """The byte at which code point ``place`` begins, or the text's length."""
    k = int(np.searchsorted(upto, place, side="right"))
    if k == len(ends):
        return len(text)
    start, before = (ends[k - 1], int(upto[k - 1])) if k else (0, 0)
    return start + int(_leads(text[start : ends[k]])[place - before])


def arranged(text: bytes, draws: tuple[int, int, int, int], rate: int, spm: int, summaries: Summaries) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends, upto, marked = measured(text, summaries)
    n = int(upto[-1]) if ends else 0
    if not n or marked or draws[2] % 100 >= rate:
        return n, PLAIN, None, None, text
    first, second = sorted(d % (n + 1) for d in draws[:2])
    a, b = (located(text, ends, upto, k) for k in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = _MARKS
    if draws[3] % 100 < spm:
        return n, SPM, first, second - first, b"".join((s, suffix, p, prefix, m, middle))
    return n, PSM, first, second - first, b"".join((p, prefix, s, suffix, m, middle))


def draws(doc_id: str, seed: str) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed, a colon and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


_KIND = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"


def fill_in_middle(docs: DataFrame, seed: str = "1", rate: int = 90, spm: int = 20, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``rate`` percent of the texts are arranged, ``spm`` percent of these with the suffix first.
    """
    bounded_batches(docs.sparkSession)

    @arrow_udf(_KIND)
    def arrange(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        summaries = Summaries()
        for texts, *numbers in batches:
            drawn = zip(*(c.to_pylist() for c in numbers), strict=True)
            rows = [arranged(t, d, rate, spm, summaries) for t, d in zip(utf8(texts), drawn, strict=True)]
            n, form, prefix, middle, output = zip(*rows, strict=True) if rows else ([],) * 5
            parts = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            yield pa.StructArray.from_arrays(
                [*parts, pa.array(output, pa.binary()).cast(pa.string())], ["n", "form", "prefix_chars", "middle_chars", "output"]
            )

    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    given = docs.withColumn("__f", arrange(F.col(text), *draws(doc_id, seed)))
    return given.drop(*names).select("*", *[F.col(f"__f.{c}").alias(c) for c in names]).drop("__f")


def restored(form: str = "form", output: str = "output") -> Column:
    """The text that an output was made of. Sentinels only stand where they were put, so a split finds the parts."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    swapped = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    straight = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    return F.when(F.col(form) == PSM, straight).when(F.col(form) == SPM, swapped).otherwise(F.col(output))
