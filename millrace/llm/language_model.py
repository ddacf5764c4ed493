"""Language-model scores by deleted interpolation.

The probability of a word after another one is a mixture of maximum-likelihood estimates: of the
pair, of the word alone, and a uniform share for words never seen. The mixture depends on how often
the word before was seen, in buckets by powers of two. Its weights come from expectation-maximisation
on held-out counts: one training fold is deleted from the counts, and its own words are the events.

Texts are dealt by a hash into stretches of about ``STRETCH`` words, so that a pair is handled once
a stretch and not at each place. A stretch asks for the counts of its different words and pairs:
sorted 64-bit keys with its own counts, packed per range of keys. Each range is summed in one task,
which packs the totals in the order of every stretch's keys. A stretch then reads its texts again
beside its answers. Both times the texts of a task are compressed together per stretch before they are shuffled. Nothing of the model passes through the driver but its three totals and a table
of events on a grid of bounded size; every count covers all training texts.

Defined cases: words are runs without ASCII white space, A-Z in lower case, and one end per text, so
a NULL or empty text has one token; an id of NULL counts as the empty id; repeated rows are
documents of their own; without training texts every token has probability 1; without the deleted
fold the three estimates weigh alike. A text longer than a stretch is scored in parts that are
added. Words and pairs are told apart by 64-bit hashes. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import batch, map_batches, mix64, row_key, utf8
from .pieces import Recent

FOLDS = 7
HELD_OUT = 2
# The training fold whose words the weights are fitted on.
DELETED = 3
# Words of a stretch, and bytes of text that hold about as many.
STRETCH = 1 << 21
STRETCH_BYTES = 8 << 20
# Bytes of text that a task holds to compress them per stretch, and most of one piece.
HELD_BYTES = 32 << 20
PIECE_BYTES = 1 << 18
# Keys of a range; ranges are a power of two.
RANGE_KEYS = 1 << 21
# Steps of the events' grid per factor of two, and its width.
STEP, REACH = 4, 64
ROUNDS = 60

_BEFORE, _AFTER = (int(f) for f in mix64(np.array([11, 12], np.uint64)) | np.uint64(1))
_END = xxhash.xxh3_64_intdigest(b"")
_START = xxhash.xxh3_64_intdigest(b" ")
_CODEC = "zstd"


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text modulo ``FOLDS``."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(FOLDS)).cast("int")


def _packed(values: np.ndarray) -> bytes:
    """Sorted keys as steps, counts as they are; bytes of like weight stand together."""
    raw = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(4, "little") + pa.compress(raw, _CODEC, asbytes=True)


def _unpacked(data: bytes, kind) -> np.ndarray:
    n, width = int.from_bytes(data[:4], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(data[4:], n * width, _CODEC, asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(width, n).T.copy().view(kind).ravel()


def _keys_packed(keys: np.ndarray) -> bytes:
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _keys_unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


@dataclass
class Part:
    """Some texts' tokens: hashes, the hash before each, the text each belongs to."""

    words: np.ndarray
    before: np.ndarray
    text: np.ndarray

    def asked(self) -> np.ndarray:
        """The words, and the one before them where the first text began in an earlier part."""
        return np.append(self.words, self.before[0])

    def pairs(self) -> np.ndarray:
        return mix64(self.before * np.uint64(_BEFORE) + self.words * np.uint64(_AFTER))


def parts_of(texts: Iterable[tuple[int, bytes]], hashes: Recent, most: int) -> Iterator[Part]:
    """Numbered texts in parts of at most ``most`` tokens; a longer text goes on in the next part."""
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    total = 0

    def close() -> Part:
        number, words, before = zip(*held, strict=True)
        return Part(np.concatenate(words), np.concatenate(before), np.repeat(number, list(map(len, words))))

    for number, text in texts:
        found = text.lower().split()  # on bytes, both know ASCII only
        words = np.empty(len(found) + 1, np.uint64)
        words[:-1] = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
        words[-1] = _END
        before = np.concatenate((np.array([_START], np.uint64), words[:-1]))
        at = 0
        while at < len(words):
            take = min(most - total, len(words) - at)
            held.append((number, words[at : at + take], before[at : at + take]))
            total, at = total + take, at + take
            if total == most:
                yield close()
                held, total = [], 0
    if held:
        yield close()


def _stretches(rows: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows of each stretch, which stand together, one after another."""
    names = ("stretch", *columns)

    def each():
        for r in rows:
            yield from zip(*(r.column(n).to_pylist() for n in names), strict=True)

    return groupby(each(), key=lambda r: r[0])


_PIECE = pa.schema([("stretch", pa.int64()), ("docs", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64())), ("trains", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())), ("texts", pa.binary())])


def _pieces(placed: DataFrame) -> DataFrame:
    """Texts (stretch, doc, row, trains, text) compressed in pieces (stretch, docs, rows, trains, sizes, texts) of one stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        bytes_of: dict[int, int] = {}

        def closed(stretches: list[int]) -> Iterator[pa.RecordBatch]:
            for k in range(0, len(stretches), 64):
                rows = []
                for stretch in stretches[k : k + 64]:
                    docs, keys, trains, texts = zip(*held.pop(stretch), strict=True)
                    del bytes_of[stretch]
                    rows.append((stretch, docs, keys, trains, list(map(len, texts)), pa.compress(b"".join(texts), _CODEC, asbytes=True)))
                yield batch(_PIECE, *zip(*rows, strict=True))

        for rows in batches:
            given = (rows.column(n).to_pylist() for n in ("stretch", "doc", "row", "trains"))
            for stretch, doc, row, trains, text in zip(*given, utf8(rows.column("text")), strict=True):
                held.setdefault(stretch, []).append((doc, row, trains, text))
                bytes_of[stretch] = bytes_of.get(stretch, 0) + len(text)
                if bytes_of[stretch] >= PIECE_BYTES:
                    yield from closed([stretch])
            if sum(bytes_of.values()) >= HELD_BYTES:
                yield from closed(list(held))
        yield from closed(list(held))

    return map_batches(placed, run, "stretch long, docs array<long>, rows array<long>, trains array<boolean>, sizes array<int>, texts binary")


def _in_order(pieces: Iterable[tuple]) -> list[tuple[int | None, int, bool, bytes]]:
    """(doc, row, trains, text) of all pieces (docs, rows, trains, sizes, texts) of a stretch, by doc and row."""
    found = []
    for docs, keys, trains, sizes, data in pieces:
        texts, at = pa.decompress(data, sum(sizes), _CODEC, asbytes=True), 0
        for doc, row, trained, size in zip(docs, keys, trains, sizes, strict=True):
            found.append((doc, row, trained, texts[at : at + size]))
            at += size
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


_ASKED = pa.schema([("stretch", pa.int64()), ("part", pa.int32()), ("pair", pa.bool_()), ("slot", pa.int32()), ("keys", pa.binary()), ("own", pa.binary())])


def _asked(placed: DataFrame, ranges: int, most: int) -> DataFrame:
    """What each stretch asks for: (stretch, part, pair, slot, keys, own), with its own training counts."""
    bits = ranges.bit_length() - 1

    def ask(stretch: int, number: int, pair: bool, keys: np.ndarray, trained: np.ndarray) -> Iterator[pa.RecordBatch]:
        distinct, inverse = np.unique(keys, return_inverse=True)
        own = np.bincount(inverse, weights=trained, minlength=len(distinct)).astype(np.uint32)
        slots = (distinct >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(distinct), np.int64)
        edges = np.searchsorted(slots, np.arange(ranges + 1))
        for slot in np.flatnonzero(np.diff(edges)).tolist():
            some = slice(edges[slot], edges[slot + 1])
            yield batch(_ASKED, [stretch], [number], [pair], [slot], [_keys_packed(distinct[some])], [_packed(own[some])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Recent(xxhash.xxh3_64_intdigest)
        for stretch, rows in _stretches(batches, _PIECE.names[1:]):
            texts = _in_order(r[1:] for r in rows)
            flags = np.array([r[2] for r in texts], np.float64)
            numbered = ((i, r[3]) for i, r in enumerate(texts))
            for number, part in enumerate(parts_of(numbered, hashes, most)):
                trained = flags[part.text]
                yield from ask(stretch, number, False, part.asked(), np.append(trained, 0.0))
                yield from ask(stretch, number, True, part.pairs(), trained)

    return map_batches(placed, run, "stretch long, part int, pair boolean, slot int, keys binary, own binary")


_ANSWERS = pa.schema([("stretch", pa.int64()), ("part", pa.int32()), ("pair", pa.bool_()), ("slot", pa.int32()), ("all", pa.binary()), ("rest", pa.binary()), ("n", pa.int64()), ("kinds", pa.int64()), ("deleted", pa.int64())])


def _answered(asked: DataFrame) -> DataFrame:
    """Totals in the order of each question's keys: ``all``, and ``rest`` without the deleted fold.

    One row per range has no stretch: its tokens ``n``, how many different ``kinds``, tokens ``deleted``.
    """

    def close(key, held) -> Iterator[pa.RecordBatch]:
        pair, slot = key
        keys = [_keys_unpacked(k) for _, _, k, _ in held]
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        own = np.concatenate([_unpacked(o, np.uint32) for *_, o in held]).astype(np.float64)
        gone = np.concatenate([np.full(len(k), s < 0) for k, (s, *_) in zip(keys, held, strict=True)])
        every = np.bincount(inverse, weights=own, minlength=len(distinct)).astype(np.int64)
        deleted = np.bincount(inverse, weights=own * gone, minlength=len(distinct)).astype(np.int64)
        yield batch(_ANSWERS, [None], [0], [pair], [slot], [None], [None], [every.sum()], [(every > 0).sum()], [deleted.sum()])
        at = 0
        for k, (stretch, number, *_) in zip(keys, held, strict=True):
            mine, at = inverse[at : at + len(k)], at + len(k)
            rest = _packed((every - deleted)[mine]) if stretch < 0 else None
            yield batch(_ANSWERS, [stretch], [number], [pair], [slot], [_packed(every[mine])], [rest], [None], [None], [None])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for rows in batches:
            for stretch, number, pair, slot, keys, own in zip(*(rows.column(n).to_pylist() for n in _ASKED.names), strict=True):
                if (pair, slot) != key:
                    if held:
                        yield from close(key, held)
                    key, held = (pair, slot), []
                held.append((stretch, number, keys, own))
        if held:
            yield from close(key, held)

    dealt = asked.repartition("pair", "slot").sortWithinPartitions("pair", "slot", "stretch", "part")
    kind = "stretch long, part int, pair boolean, slot int, all binary, rest binary, n long, kinds long, deleted long"
    return map_batches(dealt, run, kind)


@dataclass(frozen=True)
class Sizes:
    """Training tokens, different ones, training texts; the last two figures without the deleted fold."""

    tokens: int
    kinds: int
    texts: int
    rest_tokens: int
    rest_texts: int


def _beside(placed: DataFrame, answers: DataFrame, figures: str) -> DataFrame:
    """Texts and answers of each stretch in one partition, answers first."""
    pieces = _pieces(placed)
    given = answers.where("stretch IS NOT NULL").select(
        "stretch", F.lit(0).alias("kind"), "part", "pair", "slot", F.col(figures).alias("figures"), *[F.lit(None).cast(t).alias(c) for c, t in pieces.dtypes[1:]]
    )
    texts = pieces.select(
        "stretch", F.lit(1).alias("kind"), F.lit(0).alias("part"), F.lit(False).alias("pair"), F.lit(0).alias("slot"), F.lit(None).cast("binary").alias("figures"), *pieces.columns[1:]
    )
    return given.unionByName(texts).repartition("stretch").sortWithinPartitions("stretch", "kind", "part", "pair", "slot")


def _looked_up(batches: Iterator[pa.RecordBatch], most: int, texts: int) -> Iterator[tuple]:
    """(stretch, ids, part, counts of words, of words before, of pairs) of every part.

    The start of a text was seen as often as there are training ``texts``.
    """
    hashes = Recent(xxhash.xxh3_64_intdigest)
    for stretch, rows in _stretches(batches, ("kind", "part", "pair", "figures", *_PIECE.names[1:])):
        answers: dict[tuple[int, bool], list[bytes]] = {}
        docs: list[int | None] = []

        def numbered():
            pieces = []
            for _, kind, part, pair, figures, *piece in rows:
                if kind == 0:
                    answers.setdefault((part, pair), []).append(figures)
                else:
                    pieces.append(piece)
            for doc, _, _, text in _in_order(pieces):
                docs.append(doc)
                yield len(docs) - 1, text

        for number, part in enumerate(parts_of(numbered(), hashes, most)):
            words, at = np.unique(part.asked(), return_inverse=True)
            counts = np.concatenate([_unpacked(a, np.int64) for a in answers.pop((number, False))])
            pairs, pair_at = np.unique(part.pairs(), return_inverse=True)
            pair_counts = np.concatenate([_unpacked(a, np.int64) for a in answers.pop((number, True))])
            if len(words) != len(counts) or len(pairs) != len(pair_counts):
                raise RuntimeError("texts changed while they were scored")
            before = counts[np.roll(at, 1)[:-1]]  # at ends with the word before the first one
            before[part.before == _START] = texts
            yield stretch, docs, part, counts[at[:-1]], before, pair_counts[pair_at]


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + log2 of its count."""
    return np.where(count > 0, np.log2(np.maximum(count, 1)).astype(np.int64) + 1, 0)


def estimates(words: np.ndarray, before: np.ndarray, pairs: np.ndarray, tokens: int, kinds: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Estimates of a token from its pair and alone, and the uniform one."""
    two = np.where(before > 0, pairs / np.maximum(before, 1), 0.0)
    return two, words / max(tokens, 1), 1 / (kinds + 1)


def _grid(ratio: np.ndarray) -> np.ndarray:
    """Steps above the uniform estimate, -1 for an estimate of zero."""
    with np.errstate(divide="ignore"):
        steps = np.rint(STEP * np.log2(ratio))
    return np.where(ratio > 0, np.clip(steps, -REACH, STEP * REACH) + REACH, -1).astype(np.int64)


def _events(placed: DataFrame, answers: DataFrame, sizes: Sizes, most: int) -> DataFrame:
    """(bucket, two, one, n): the deleted fold's tokens by context bucket and their two estimates on the grid."""
    out = pa.schema([("b", pa.int64()), ("two", pa.int64()), ("one", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, words, before, pairs in _looked_up(batches, most, sizes.rest_texts):
            two, one, flat = estimates(words, before, pairs, sizes.rest_tokens, sizes.kinds)
            wide = STEP * REACH + REACH + 2
            cell, n = np.unique((bucket(before) * wide + _grid(two / flat) + 1) * wide + _grid(one / flat) + 1, return_counts=True)
            yield batch(out, cell // (wide * wide), cell // wide % wide - 1, cell % wide - 1, n)

    found = map_batches(_beside(placed.where("stretch < 0"), answers.where("stretch < 0"), "rest"), run, "b long, two long, one long, n long")
    return found.groupBy("b", "two", "one").agg(F.sum("n").alias("n"))


def fit_weights(b: np.ndarray, two: np.ndarray, one: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (pair, word, uniform) per bucket by expectation-maximisation; buckets lean on the whole where they are small."""

    def figure(steps):
        return np.where(steps < 0, 0.0, 2.0 ** ((steps - REACH) / STEP))

    shares = np.column_stack((figure(two), figure(one), np.ones(len(b))))

    def climbed(rows: np.ndarray, prior: np.ndarray, strength: float) -> np.ndarray:
        w, p, c = prior.copy(), shares[rows], n[rows]
        for _ in range(rounds):
            given = p * w
            given *= (c / given.sum(axis=1))[:, None]
            w = given.sum(axis=0) + strength * prior
            w /= w.sum()
        return w

    most = int(b.max()) if len(b) else 0
    whole = climbed(np.arange(len(b)), np.full(3, 1 / 3), 3.0)
    table = np.tile(whole, (max(most, 64) + 1, 1))
    for k in range(len(table)):
        rows = np.flatnonzero(b == k)
        # A context more frequent than any held-out one is trusted like the most frequent of them.
        table[k] = climbed(rows, whole, 10.0) if len(rows) else table[max(k - 1, 0)]
    # Nothing is known of a pair whose first word was never seen.
    table[0] = (0.0, *(table[0, 1:] / table[0, 1:].sum()))
    return table


def language_model_scores(docs: DataFrame, stretch_words: int = STRETCH, stretch_bytes: int = STRETCH_BYTES, range_keys: int = RANGE_KEYS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Scores are log10 probabilities of a text; the base is the words' add-one estimate.
    """
    number = fold()
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"), (number != HELD_OUT).alias("trains"), (number == DELETED).alias("deleted")
    )
    totals = keyed.groupBy("deleted").agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count("*").alias("rows"), F.sum(F.col("trains").cast("int")).alias("texts")
    )
    by = {r["deleted"]: r for r in totals.collect()}

    def stretches(r) -> int:
        return max(1, -(-(r["bytes"] + 4 * r["rows"]) // stretch_bytes)) if r else 1

    texts = sum(r["texts"] for r in by.values())
    rest_texts = texts - (by[True]["texts"] if True in by else 0)
    # Stretches of the deleted fold are negative.
    place = F.xxhash64("doc", row_key())
    stretch = F.when(F.col("deleted"), -1 - F.pmod(place, F.lit(stretches(by.get(True))))).otherwise(F.pmod(place, F.lit(stretches(by.get(False)))))
    placed = keyed.select(stretch.alias("stretch"), "doc", row_key().alias("row"), "trains", "text")
    held = sum(r["bytes"] for r in by.values())
    ranges = 1 << max(0, (held // 6 // range_keys).bit_length())
    ordered = _pieces(placed).repartition("stretch").sortWithinPartitions("stretch")
    answers = materialise(_answered(_asked(ordered, ranges, stretch_words)), "counts")
    of_words = answers.where("stretch IS NULL AND NOT pair").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "kinds", "deleted")]).first()
    sizes = Sizes(of_words["n"], of_words["kinds"], texts, of_words["n"] - of_words["deleted"], rest_texts)
    cells = _events(placed, answers, sizes, stretch_words).toArrow()  # at most a grid
    weights = fit_weights(*(cells.column(c).to_numpy().astype(np.int64) for c in ("b", "two", "one", "n")))
    if not sizes.tokens:
        weights = np.tile(np.array([0.0, 0.0, 1.0]), (len(weights), 1))
    out = pa.schema([("stretch", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("own", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, docs, part, words, before, pairs in _looked_up(batches, stretch_words, sizes.texts):
            two, one, flat = estimates(words, before, pairs, sizes.tokens, sizes.kinds)
            w = weights[bucket(before)]
            own = np.log10(w[:, 0] * two + w[:, 1] * one + w[:, 2] * flat)
            base = np.log10((words + 1) / (sizes.tokens + sizes.kinds + 1))
            first = np.flatnonzero(np.diff(part.text, prepend=-1))
            sums = [np.add.reduceat(x, first) for x in (np.ones(len(words), np.int64), (words > 0).astype(np.int64), base, own)]
            numbers = part.text[first]
            yield batch(out, np.full(len(first), at), numbers, [docs[i] for i in numbers.tolist()], *sums)

    kind = "stretch long, place long, doc_id long, n_tokens long, n_known long, base double, own double"
    scored = map_batches(_beside(placed, answers, "all"), run, kind)
    whole = scored.groupBy("stretch", "place").agg(
        F.first("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("own").alias("score")
    )
    return whole.select(
        "doc_id", (fold() == HELD_OUT).alias("held_out"), "n_tokens", "n_known", F.lit(sizes.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
