"""Benchmark decontamination by a prefix-filtered join, in DataFrame functions only.

Every window of ``WINDOW`` consecutive words of a benchmark item (a shorter item is one window)
must be contained whole, so of its words in order of rarity only the first, the rarest in the
corpus, has to be joined: a text without that word cannot hold the window. The word's place in
the window and in the text fix where the window would start; starts outside the text are left
out, and the words there are compared one by one.

Words are runs of a-z, 0-9 and characters beyond ASCII after A-Z were lower-cased. Rarity counts
all words of all documents. The benchmark's words and windows are counted and broadcast only
while they are small; beyond that the same joins shuffle.

Defined cases: a NULL or empty text or item has no words, no windows and no hits; documents are
rows of one (doc_id, text): rows that repeat both get the same result each; items of one item_id
count as one item; a NULL item_id is not listed; empty tables give no hits. Extra columns stay;
result columns replace those of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .common import broadcast_if_counted, row_key

WINDOW = 10
# What stands between words, once A-Z are lower-cased and before. Cutting there takes less than
# half the time of matching the words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str = "text") -> Column:
    c = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # lower() is much faster and does the same for pure ASCII.
    low = F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))
    return F.array_remove(F.split(low, GAP, -1), "")


def n_words(text: str = "text") -> Column:
    c = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.size(F.array_remove(F.split(c, RAW_GAP, -1), "")).cast("long")


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(wid, item_id, window): the distinct windows of each item."""
    items = benchmark.select("item_id", words().alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (
        items.withColumn("start", F.explode(starts))
        .select("item_id", F.slice("words", F.col("start"), size).alias("window"))
        .distinct()
        .withColumn("wid", F.xxhash64("window"))
    )


def rarest_words(texts: DataFrame, windows: DataFrame) -> DataFrame:
    """(word, at, wid, window): each window under its rarest word; ``at`` is the word's place in it."""
    placed = windows.dropDuplicates(["wid"]).select("wid", "window", F.posexplode("window").alias("at", "word"))
    vocabulary = materialise(placed.select("word").distinct(), "vocabulary")
    size = vocabulary.agg(F.count("*").alias("n"), F.coalesce(F.max(F.octet_length("word")), F.lit(0)).alias("w")).first()
    wanted = broadcast_if_counted(vocabulary, size["n"], size["w"] + 32)
    seen = texts.select(F.explode("words").alias("word")).join(wanted, "word").groupBy("word").agg(F.count("*").alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")
    return (
        placed.join(seen, "word", "left")
        .groupBy("wid")
        .agg(F.min(rarity).alias("first"), F.first("window").alias("window"))
        .select("first.word", "first.at", "wid", "window")
    )


def window_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc, row, start, size, wid): windows found in texts; ``start`` counts words from 0."""
    texts = docs.select(F.col("doc_id").alias("doc"), row_key().alias("row"), words().alias("words"))
    prefix = materialise(rarest_words(texts, windows), "prefix")
    size = prefix.agg(F.count("*").alias("n"), F.coalesce(F.max(F.length(F.array_join("window", " "))), F.lit(0)).alias("w")).first()
    wanted = broadcast_if_counted(prefix, size["n"], 4 * size["w"] + 200)
    start = F.col("place") - F.col("at")
    length = F.size("window")
    return (
        texts.select("doc", "row", "words", F.posexplode("words").alias("place", "word"))
        .join(wanted, "word")
        .where((start >= 0) & (start + length <= F.size("words")))
        .where(F.slice("words", F.when(start >= 0, start + 1).otherwise(1), length) == F.col("window"))
        .select("doc", "row", start.alias("start"), length.alias("size"), "wid")
    )


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``n_items``, ``item_ids`` (sorted as text) and ``contaminated``."""
    windows = materialise(item_windows(benchmark, size), "windows")
    hits = materialise(window_hits(docs, windows).distinct(), "hits")
    before = W.partitionBy("doc", "row").orderBy("start", "size").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    fresh = F.greatest(end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.lit(0))), F.lit(0))
    covered = hits.select("doc", "row", fresh.alias("fresh")).groupBy("doc", "row").agg(F.sum("fresh").alias("n_hit"))
    found = (
        hits.select("doc", "row", "wid").distinct()
        .join(windows.where("item_id IS NOT NULL").select("wid", F.col("item_id").cast("string").alias("item")), "wid")
        .groupBy("doc", "row")
        .agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    )
    result = covered.join(found, covered["doc"].eqNullSafe(found["doc"]) & (covered["row"] == found["row"]), "left").select(
        covered["doc"].alias("__doc"), covered["row"].alias("__row"), "n_hit", "item_ids"
    )
    own = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")
    names = [c for c in docs.columns if c not in own]
    keyed = docs.select(F.struct(*names).alias("given"), F.col("doc_id").alias("doc"), row_key().alias("row"), n_words().alias("n_words"))
    joined = keyed.join(result, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("row") == F.col("__row")), "left")
    items = F.coalesce("item_ids", F.array().cast("array<string>"))
    return joined.select(
        "given.*",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("item_ids"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )
