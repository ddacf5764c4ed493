"""Toxicity scores from class-conditional Kneser-Ney models.

Two models of a word's letters, one per class, give the probability of each letter after the
``CONTEXT`` letters before it, with the word's start and end as letters. Each class interpolates
its own discounted counts with one shared model of shorter contexts, made of continuation counts
pooled over both classes, so an expression that a class has rarely seen falls back to the same
figure on both sides. A word's evidence is the difference of its log-likelihoods. A document is
compared per letter, over its whole length and over its most suspicious window of words, and by
its ``STRONGEST`` different words with the most evidence, as one word may be enough, beside
the number of its different words.

Every letter of a word counts, however rarely its entry was seen. A letter that neither class has seen
after a known context has the same shared probability in both, so its evidence is the difference
of the backoff masses, one figure per context; after a context that neither has seen it is 0.
Counts come from every distinct labelled training text; copies of a text count once. A model of a counted, bounded size is
broadcast as sorted 64-bit keys of its entries; a larger one is joined to the distinct words on Spark.

These figures of a document are turned into a score by a logistic curve, fitted on at most
``CALIBRATION_ROWS`` different labelled texts (the lowest hashes) of all training folds, each compared
by models of the other training folds; the models that score are trained on all of them.

Defined cases: NULL and empty texts, and texts without letters, have no evidence and get the
score of that; labels with a NULL class are no labels, and a doc_id with several labels is toxic
if one of them says so; texts repeated under several ids train once; a NULL doc_id has no label but is scored.
With no labels of one class every score is the share of toxic labels (0.5 without labels).
Extra columns of the input stay; result columns replace those of the same name.
"""

from __future__ import annotations

import heapq
import math
import re
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..session import materialise, release
from .common import BROADCAST_BYTES, batch, bounded_batches, broadcast_if_counted, kept_in_worker, map_batches, mix64, utf8

CONTEXT = 5
SHARED_CONTEXT = 2
DISCOUNT = 0.75
STRIDE = 12  # a window is two strides of words
STRONGEST = 3
# Entries of a broadcast model: a key and a figure of 8 bytes each.
BLOCK_ENTRIES = BROADCAST_BYTES // 16
CALIBRATION_ROWS = 20_000
FOLDS = 5

_WORD = re.compile(r"[^\W\d_]+")
_START, _END = "<", ">"
# Stands for any letter that neither class has seen after a context.
_UNSEEN = "\0"
# Factors of a letter and of those before it in the key of an entry.
_FACTORS = mix64(np.arange(1, CONTEXT + 2, dtype=np.uint64)) | np.uint64(1)
_CACHE = 150_000
_FLUSH = 100_000


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text modulo ``FOLDS``. Fold 0 is held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS))


def words_of(text: bytes) -> list[str]:
    return _WORD.findall(text.decode().lower())


def entries_of(word: str) -> list[str]:
    """Context and letter of each letter of a word, joined; the letter is the last one."""
    s = _START + word + _END
    return [s[max(0, i - CONTEXT) : i + 1] for i in range(1, len(s))]


def _counts_per_task(df: DataFrame, key: str, columns: tuple[str, ...], spread) -> DataFrame:
    """Sums per task of what ``spread`` makes of a row, then over tasks; tables in tasks are bounded."""
    out = pa.schema([(key, pa.string()), ("ct", pa.int64()), ("co", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for rows in batches:
            for row in zip(*(rows.column(c).to_pylist() for c in columns), strict=True):
                for name, t, o in spread(*row):
                    pair = held[name]
                    pair[0] += t
                    pair[1] += o
                if len(held) >= _FLUSH:
                    yield batch(out, held.keys(), *zip(*held.values(), strict=True))
                    held.clear()
        if held:
            yield batch(out, held.keys(), *zip(*held.values(), strict=True))

    return map_batches(df, run, f"{key} string, ct long, co long").groupBy(key).agg(F.sum("ct").alias("ct"), F.sum("co").alias("co"))


def letter_counts(texts: DataFrame) -> DataFrame:
    """(fold, entry, ct, co): how often toxic and ordinary texts of (text, toxic, fold) hold each entry."""

    def words(text, toxic, fold):
        for w in words_of((text or "").encode()):
            yield (f"{fold}{w}", 1, 0) if toxic else (f"{fold}{w}", 0, 1)

    def letters(word, ct, co):
        for e in entries_of(word[1:]):
            yield word[0] + e, ct, co

    found = _counts_per_task(_counts_per_task(texts, "word", ("text", "toxic", "fold"), words), "entry", ("word", "ct", "co"), letters)
    return found.select(F.expr("left(entry, 1)").cast("int").alias("fold"), F.expr("substring(entry, 2)").alias("entry"), "ct", "co")


def model_entries(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(entry, evidence), for each value of ``by`` a model of its own: difference of the classes' log-probabilities of every entry that a class has
    seen, and of any other letter after each context (``_UNSEEN``)."""
    if not by:
        return model_entries(counts.withColumn("variant", F.lit(0)), ("variant",)).drop("variant")
    c = counts.withColumns(
        {
            "context": F.expr("substring(entry, 1, length(entry) - 1)"),
            "letter": F.expr("right(entry, 1)"),
        }
    ).withColumn("near", F.expr(f"right(context, {SHARED_CONTEXT})"))
    own = c.groupBy(*by, "context").agg(
        F.sum("ct").alias("nt"),
        F.sum("co").alias("no"),
        F.sum((F.col("ct") > 0).cast("int")).alias("kt"),
        F.sum((F.col("co") > 0).cast("int")).alias("ko"),
    )
    # Figures of letters and of short contexts: as many as there are letters, not texts.
    follow = c.groupBy(*by, "near", "letter").agg(F.count("*").alias("cont"))
    after = follow.groupBy(*by, "near").agg(F.sum("cont").alias("cont_all"), F.count("*").alias("cont_kinds"))
    single = follow.groupBy(*by, "letter").agg(F.sum("cont").alias("one"))
    every = single.groupBy(*by).agg(F.sum("one").alias("all"), F.count("*").alias("letters"))
    single = single.join(every, list(by))
    d = F.lit(DISCOUNT)
    shared = follow.join(after, [*by, "near"]).join(single, [*by, "letter"])
    low = (F.col("one") + 0.5) / (F.col("all") + 0.5 * F.col("letters"))
    p = (F.col("cont") - d) / F.col("cont_all") + d * F.col("cont_kinds") / F.col("cont_all") * low
    shared = shared.select(*by, "near", "letter", p.alias("shared"))

    def mass(n: str, k: str) -> Column:
        return F.when(F.col(n) > 0, d * F.col(k) / F.col(n)).otherwise(1.0)

    def probability(n: str, k: str, of: str) -> Column:
        seen = F.when(F.col(n) > 0, F.greatest(F.col(of) - d, F.lit(0.0)) / F.col(n)).otherwise(0.0)
        return seen + mass(n, k) * F.col("shared")

    full = c.join(own, [*by, "context"]).join(shared, [*by, "near", "letter"])
    evidence = F.log(probability("nt", "kt", "ct")) - F.log(probability("no", "ko", "co"))
    unseen = F.log(mass("nt", "kt")) - F.log(mass("no", "ko"))
    return full.select(*by, "entry", evidence.alias("evidence")).unionByName(
        own.select(*by, F.concat("context", F.lit(_UNSEEN)).alias("entry"), unseen.alias("evidence"))
    )


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def keys_of(entries: Iterable[str]) -> np.ndarray:
    """64-bit keys of entries, whose letter is the last one."""
    codes = _codes("".join(e.rjust(CONTEXT + 1, _UNSEEN) for e in entries)).reshape(-1, CONTEXT + 1)
    return (codes * _FACTORS[::-1]).sum(1, dtype=np.uint64)


def letter_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the entries of all words, one after another, and of ``_UNSEEN`` after the same contexts."""
    gap = _UNSEEN * CONTEXT
    codes = _codes("".join(f"{gap}{_START}{w}{_END}" for w in words))
    at = np.flatnonzero((codes != 0) & (codes != ord(_START)))
    before = np.zeros(len(at), np.uint64)
    for i in range(1, CONTEXT + 1):
        before += codes[at - i] * _FACTORS[i]
    return before + codes[at] * _FACTORS[0], before


class WordEvidence:
    """Evidence of words; those in use stay, in two generations."""

    def __init__(self, keys: np.ndarray, figures: np.ndarray):
        self.keys, self.figures = keys, figures
        self.now: dict[str, float] = {}
        self.older: dict[str, float] = {}

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Each key once and in order: neighbours in the model are then found one after another.
        keys, place = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return (self.keys[at] == keys)[place], self.figures[at][place]

    def _made(self, words: list[str]) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(words))
        seen, context = letter_keys(words)
        hit, figures = self._find(seen)
        missed = np.flatnonzero(~hit)
        known, masses = self._find(context[missed])
        figures[missed] = np.where(known, masses, 0.0)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        return np.add.reduceat(figures, np.cumsum(lengths) - lengths)

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.now) >= _CACHE:
            self.now, self.older = {}, self.now
        now = self.now
        if new := [w for w in dict.fromkeys(words) if w not in now]:
            older = self.older
            now.update((w, older[w]) for w in new if w in older)
            if new := [w for w in new if w not in now]:
                now.update(zip(new, self._made(new).tolist(), strict=True))
        return np.fromiter(map(now.__getitem__, words), np.float64, len(words))


# The strongest of many different words is stronger by chance than that of few, so their number counts too.
FIGURES = ("whole", "window", *(f"{kind}{i}" for kind in ("word", "log") for i in range(1, STRONGEST + 1)), "kinds")


def compared(words: list[str], evidence: np.ndarray) -> tuple[float, ...]:
    """``FIGURES``: evidence per letter of the text and of its best window, that of its strongest words, how many words differ."""
    if not words:
        return (0.0,) * len(FIGURES)
    letters = np.fromiter(map(len, words), np.float64, len(words)) + 1
    at = np.arange(0, len(words), STRIDE)
    e, n = np.add.reduceat(evidence, at), np.add.reduceat(letters, at)
    best = e[0] / n[0] if len(at) == 1 else ((e[1:] + e[:-1]) / (n[1:] + n[:-1])).max()
    by_word = dict(zip(words, evidence.tolist(), strict=True))
    strong = heapq.nlargest(STRONGEST, by_word.values())
    strong += [0.0] * (STRONGEST - len(strong))
    return (float(e.sum() / n.sum()), float(best), *strong, *(math.log1p(max(0.0, s)) for s in strong), math.log1p(len(by_word)))


@dataclass(frozen=True)
class Model:
    """A named broadcast of sorted keys and figures, or else a table of (entry, evidence)."""

    entries: DataFrame
    name: str = ""
    shared: object = None


def load_model(entries: DataFrame, block_entries: int = BLOCK_ENTRIES) -> Model:
    """Broadcast a model (a written table) of at most ``block_entries`` entries; a larger one stays a table."""
    spark, model = entries.sparkSession, entries
    if model.count() > block_entries:
        return Model(model)
    out = pa.schema([("key", pa.int64()), ("evidence", pa.float64())])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield batch(out, keys_of(rows.column("entry").to_pylist()).view(np.int64), rows.column("evidence"))

    found = map_batches(model, keyed, "key long, evidence double").toArrow()
    keys = found.column("key").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Model(model, uuid.uuid4().hex, spark.sparkContext.broadcast((keys[order], found.column("evidence").to_numpy()[order])))


def _joined(docs: DataFrame, model: DataFrame) -> DataFrame:
    """``docs`` with ``__w``, the evidence of each different word, without a model in tasks."""
    # Equal texts have equal words; their hash stands for them.
    text_key = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))

    @arrow_udf("array<string>")
    def words(texts: pa.Array) -> pa.Array:
        return pa.array([list(dict.fromkeys(words_of(t))) for t in utf8(texts)], pa.list_(pa.string()))

    @arrow_udf("array<string>")
    def letters(words: pa.Array) -> pa.Array:
        return pa.array([entries_of(w) for w in words.to_pylist()], pa.list_(pa.string()))

    per_text = docs.select(text_key.alias("__k"), F.explode(words("text")).alias("word")).distinct()
    entry = per_text.select("word").distinct().select("word", F.explode(letters("word")).alias("entry"))
    seen = model.withColumnRenamed("evidence", "seen")
    unseen = model.select(F.col("entry").alias("any"), F.col("evidence").alias("unseen"))
    context = F.concat(F.expr("substring(entry, 1, length(entry) - 1)"), F.lit(_UNSEEN))
    figures = entry.join(seen, "entry", "left").withColumn("any", context).join(unseen, "any", "left")
    known = figures.groupBy("word").agg(F.sum(F.coalesce("seen", "unseen", F.lit(0.0))).alias("evidence"))
    found = per_text.join(known, "word").groupBy("__k").agg(F.collect_list(F.struct("word", "evidence")).alias("__w"))
    return docs.withColumn("__k", text_key).join(found, "__k", "left").drop("__k")


def with_comparison(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``__c``, a struct of ``FIGURES``."""
    bounded_batches(docs.sparkSession)
    kind = "struct<" + ",".join(f"{f}:double" for f in FIGURES) + ">"

    def figures(found: list[tuple]) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array([f[i] for f in found], pa.float64()) for i in range(len(FIGURES))], list(FIGURES))

    if model.shared is not None:
        name, shared = model.name, model.shared

        @arrow_udf(kind)
        def at_once(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            evidence = kept_in_worker(("toxicity", name), lambda: WordEvidence(*shared.value))
            for texts in batches:
                cut = [words_of(t) for t in utf8(texts)]
                evidence.of(list(dict.fromkeys(chain.from_iterable(cut))))  # new words of the batch, all at once
                yield figures([compared(words, evidence.of(words)) for words in cut])

        return docs.withColumn("__c", at_once(F.col("text")))

    @arrow_udf(kind)
    def finish(texts: pa.Array, known: pa.Array) -> pa.Array:
        found = []
        for text, pairs in zip(utf8(texts), known, strict=True):
            words, evidence = words_of(text), {p["word"]: p["evidence"] for p in pairs.as_py() or []}
            found.append(compared(words, np.array([evidence[w] for w in words], float)))
        return figures(found)

    return _joined(docs, model.entries).withColumn("__c", finish(F.col("text"), F.col("__w"))).drop("__w")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Coefficients of a logistic curve by Newton's method; the last one is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])

    def cost(w: np.ndarray) -> float:
        return np.logaddexp(0, x @ w).sum() - y @ (x @ w) + ridge / 2 * w @ w

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        while cost(w + step) > cost(w) and np.abs(step).max() >= 1e-9:
            step /= 2
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


# Brings the figures to a like scale, so that the curve's fit is well conditioned.
_SCALE = (20.0, 20.0, *(1 / 3,) * STRONGEST, *(1.0,) * STRONGEST, 0.5)


def toxicity(docs: DataFrame, labels: DataFrame, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (0 to 1) and ``predicted``; trained on ``labels``."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = materialise(known.withColumn("fold", fold()).where("fold > 0"), "labels")
    rows = known.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    held_out = F.coalesce(fold() == 0, F.lit(False))
    names = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    if not 0 < rows["toxic"] < rows["n"]:
        share = rows["toxic"] / rows["n"] if rows["n"] else 0.5
        out = docs.select(*names, held_out.alias("held_out"), F.lit(share).alias("score"))
        return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

    texts = docs.select("doc_id", "text")
    classes = known.withColumnRenamed("doc_id", "__id")
    trained = broadcast_if_counted(classes, rows["n"], 32)
    labelled = texts.join(trained, texts["doc_id"] == trained["__id"])
    # A text that was copied trains once, in the fold of its lowest id.
    once = labelled.groupBy(F.xxhash64("text").alias("h")).agg(F.min("doc_id").alias("__id"), F.max("toxic").alias("toxic"))
    once = materialise(once.select("__id", "toxic", fold("__id").alias("fold")), "train")
    own = broadcast_if_counted(once, rows["n"], 32)
    counts = materialise(letter_counts(texts.join(own, texts["doc_id"] == own["__id"]).select("text", "toxic", "fold")), "letters")

    # Variant 0 is trained on all training folds and scores; each other one leaves out the fold of its number.
    variants = F.explode(F.array(*[F.lit(v) for v in range(FOLDS)])).alias("variant")
    parts = counts.select(variants, "fold", "entry", "ct", "co").where("variant <> fold")
    parts = materialise(parts.groupBy("variant", "entry").agg(F.sum("ct").alias("ct"), F.sum("co").alias("co")), "counts")
    entries = materialise(model_entries(parts, ("variant",)), "toxicity")
    release(counts, parts)

    sample = F.broadcast(once.orderBy(F.xxhash64("__id"), "__id").limit(CALIBRATION_ROWS))  # at most CALIBRATION_ROWS
    sample = texts.join(sample, texts["doc_id"] == F.col("__id")).select("text", "toxic", "fold").limit(CALIBRATION_ROWS)
    sample, seen = materialise(sample, "sample"), []
    for left_out in range(1, FOLDS):
        unseen = load_model(entries.where(F.col("variant") == left_out).drop("variant"), block_entries)
        seen.append(with_comparison(sample.where(F.col("fold") == left_out), unseen).select("__c.*", "toxic").toArrow())
        if unseen.shared is not None:
            unseen.shared.destroy()
    seen = pa.concat_tables(seen)
    release(sample, once)
    model = load_model(entries.where("variant = 0").drop("variant"), block_entries)
    x = np.column_stack([seen.column(f).to_numpy() for f in FIGURES]) * _SCALE
    y = seen.column("toxic").to_numpy().astype(float)
    weights = fit_logistic(x, y)
    *weights, constant = (float(v) for v in weights)
    total = F.lit(constant)
    for figure, scale, weight in zip(FIGURES, _SCALE, weights, strict=True):
        total = total + F.col(f"__c.{figure}") * (scale * weight)
    score = 1 / (1 + F.exp(-total))
    out = with_comparison(docs.select(*names), model).withColumns({"held_out": held_out, "score": score}).drop("__c")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
