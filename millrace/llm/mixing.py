"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: sources in code point order (NULL last) get repeating weights and share all words; a
target stops at ``MAX_REPEATS`` times its source's words and the rest is shared again by weight.
Sorted by (cap / weight) the capped sources come first, so running sums give the result at once.

Schedule: slot n stands for one block of ``block`` words. Its van der Corput point falls into one
source's part of the cumulative targets; the k-th slot of a source takes the k-th block of that
source. The source's documents lie shuffled on a line that repeats them, cut into equal blocks,
so a document's second copy comes only after all others had their first. Sources that a point
never reached often enough get closing slots, and the last block ends at the target.

Everything is DataFrame functions. Running sums go in two steps, per hash bucket and over bucket
totals, so that a source may hold any share of all rows. One row per source is the only thing
sorted in one task.

Defined cases: a NULL or empty text has 0 words and is never taken; a NULL source is a source of
its own; repeated rows are separate documents; a NULL doc_id is a value like others; an empty
table gives no rows. Columns are chosen by name; others are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise
from .common import broadcast_if_counted, row_key

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 512
# Documents or slots per bucket of a running sum.
BUCKET_ROWS = 4096
SPACE = r"[\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), SPACE, -1), "")).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(sid, source, source_size, weight, target) from (source, size). ``sid`` counts sources from 0."""
    whole, cap = W.partitionBy(), F.col("source_size") * max_repeats
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("sid", place)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod("sid", F.lit(len(weights))) + 1)
    ratio = cap / F.col("weight")
    before = W.orderBy("ratio", "sid").rowsBetween(W.unboundedPreceding, -1)

    def rest(of: Column) -> Column:
        return F.sum(of).over(whole) - F.coalesce(F.sum(of).over(before), F.lit(0))

    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    capped = (
        sources.withColumn("weight", weight)
        .withColumn("ratio", ratio)
        .withColumn("capped", left > F.col("ratio") * rest(F.col("weight")))
    )
    free = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole)
    spent = F.coalesce(F.sum(F.when(F.col("capped"), cap)).over(whole), F.lit(0))
    share = (F.sum("source_size").over(whole) - spent) / free
    target = F.when(F.col("capped"), cap.cast("double")).otherwise(F.col("weight") * share)
    return capped.select("sid", "source", "source_size", "weight", target.alias("target"))


def _running(df: DataFrame, order: list, value: str, name: str, number: str | None = None) -> DataFrame:
    """Sum of ``value`` over earlier rows of the same ``sid``, rows ordered by bucket and ``order``."""
    totals = df.groupBy("sid", "bucket").agg(F.sum(value).alias("__n"))
    before = W.partitionBy("sid").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("sid", "bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = W.partitionBy("sid", "bucket").orderBy(*order)
    own = F.coalesce(F.sum(value).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    out = df.withColumn("__own", own)
    if number:
        out = out.withColumn(number, F.row_number().over(inside))
    return out.join(offsets, ["sid", "bucket"]).withColumn(name, F.col("__before") + F.col("__own")).drop("__before", "__own")


def _point(n: Column) -> Column:
    """The van der Corput point of ``n`` in base 2: its bits mirrored behind the point."""
    mirrored = F.conv(F.reverse(F.lpad(F.bin(n), 52, "0")), 2, 10).cast("long")
    return mirrored / F.lit(float(1 << 52))


def schedule(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, sid, block): which block of which source each slot of the mix takes."""
    spark = sources.sparkSession
    whole = W.partitionBy()
    upto = W.orderBy("sid").rowsBetween(W.unboundedPreceding, W.currentRow)
    need = F.ceil(F.col("goal") / block)
    parts = sources.select("sid", need.alias("need"), F.sum(need).over(upto).alias("upto"), F.sum(need).over(whole).alias("slots"))
    total = sources.agg(F.coalesce(F.sum(need), F.lit(0)).alias("slots"), F.count("*").alias("n")).first()
    slots, cells = int(total["slots"]), 4 << int(total["n"]).bit_length()
    lo, hi = (F.col("upto") - F.col("need")) / F.col("slots"), F.col("upto") / F.col("slots")
    # Every grid cell lists the sources whose part reaches into it.
    grid = (
        parts.where("need > 0")
        .select("sid", "need", lo.alias("lo"), hi.alias("hi"))
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * cells), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))))
    )
    points = spark.range(slots).select(F.col("id").alias("slot"), _point(F.col("id")).alias("u"))
    points = points.withColumns({"cell": F.floor(F.col("u") * cells), "bucket": F.floor(F.col("slot") / BUCKET_ROWS), "one": F.lit(1)})
    hits = points.join(grid, "cell").where("u >= lo AND u < hi").select("slot", "sid", "need", "bucket", "one")
    ranked = _running(hits, ["slot"], "one", "block").where("block < need").select("slot", "sid", "block")
    got = parts.join(hits.groupBy("sid").agg(F.count("*").alias("got")), "sid", "left").where("need > coalesce(got, 0)")
    short = got.select("sid", F.explode(F.sequence(F.coalesce("got", F.lit(0)), F.col("need") - 1)).alias("block"), "upto")
    closing = short.select((F.lit(slots) + F.col("upto") + F.col("block")).alias("slot"), "sid", "block")
    return ranked.unionByName(closing)


def mix(docs: DataFrame, block: int = BLOCK_WORDS, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 42) -> DataFrame:
    """Pieces of the mix: one row per document and taken block, or a row without ``slot`` if nothing is taken.

    Columns: ``doc_id, key, row, size, source_size, target, slot, block, from_word, words``. ``row``
    tells input rows apart, ``key`` stands for the text; ``slot`` orders the mix.
    """
    sized = materialise(
        docs.select(
            "doc_id", "source", row_key().alias("key"), n_words().alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("h")
        ),
        "sized",
    )
    targets = materialise(source_targets(sized.select("source", "size"), weights, max_repeats), "targets")
    goal = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * max_repeats)
    sources = targets.withColumn("goal", goal)
    buckets = max(1, sized.count() // BUCKET_ROWS)
    known = broadcast_if_counted(sources.withColumnRenamed("source", "__source"), sources.count(), 256)
    placed = sized.join(known, sized["source"].eqNullSafe(F.col("__source"))).drop("__source", "source")
    placed = placed.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    lined = _running(placed, ["h", "doc_id", "size"], "size", "at", number="number")

    spans = F.filter(
        F.array(
            *[
                F.struct(
                    (F.col("at") + e * F.col("source_size")).alias("a"),
                    F.least(F.col("at") + e * F.col("source_size") + F.col("size"), F.col("goal")).alias("z"),
                )
                for e in range(max_repeats)
            ]
        ),
        lambda x: x["z"] > x["a"],
    )

    def cut(x: Column) -> Column:
        first, last = F.floor(x["a"] / block), F.floor((x["z"] - 1) / block)
        return F.transform(
            F.sequence(first, last),
            lambda k: F.struct(
                k.alias("block"),
                (F.greatest(x["a"], k * block) - x["a"]).alias("from_word"),
                (F.least(x["z"], (k + 1) * block) - F.greatest(x["a"], k * block)).alias("words"),
            ),
        )

    row = F.struct("sid", "bucket", "number").alias("row")
    pieces = lined.select(
        "doc_id", "key", row, "size", "source_size", "target", "sid", F.explode_outer(F.flatten(F.transform(spans, cut))).alias("p")
    ).select("doc_id", "key", "row", "size", "source_size", "target", "sid", "p.*")
    slots = schedule(sources, block)
    return pieces.join(slots, ["sid", "block"], "left").drop("sid")


def taken_words(pieces: DataFrame) -> DataFrame:
    """Per document of the input: the words the mix takes of it, repeats counted."""
    words = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("words"))), F.lit(0)).cast("long")
    return (
        pieces.groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("key").alias("key"),
            F.first("size").alias("size"),
            F.first("source_size").alias("source_size"),
            F.first("target").alias("target"),
            words.alias("taken"),
        )
        .drop("row")
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix as whole documents with all their columns, one row per copy.

    A document comes as often as the mix takes its words, rounded to whole copies; only the one
    document of a source at which its target ends is taken in part. Texts are not cut.
    """
    copies = F.floor(F.col("taken") / F.col("size") + 0.5)
    taken = taken_words(mix(docs, **how)).where("taken > 0").groupBy("doc_id", "key").agg(F.sum(copies).alias("__copies"))
    taken = taken.where("__copies > 0").select(F.col("doc_id").alias("__id"), F.col("key").alias("__text"), "__copies")
    given = docs.select(F.struct(*docs.columns).alias("given"), "doc_id", row_key().alias("__key"))
    joined = given.join(taken, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__text")))
    # Rows equal in id and text count together in __copies.
    once = joined.groupBy("__id", "__text").agg(F.first("given").alias("given"), F.first("__copies").alias("__copies"))
    return once.select("given", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("given.*")
