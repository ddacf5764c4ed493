"""Exact n-gram Jaccard links and their components, by signature trees.

A document's set holds its distinct five-word shingles. Equal sets are one class, and only classes
are compared. Two alike sets must share one of the first elements of both, in any order common to
all sets (a set of n needs n - ceil(0.8 n) + 1 of them). The order puts elements seen in several
documents last and those of common words late, so that few sets meet by chance or by a passage
they quote. Classes that share such an element, directly or through others, form a cluster;
clusters are found on ids alone, by connected components. Sets are then gathered per cluster, in
blocks of a bounded number of elements, and each block is searched with a signature tree (see
``signature_tree``).

A cluster of one block is then done. A larger one is cut into blocks by size class and hash. One
set of each component of each block is compared first; then the sets outside the cluster's
largest component visit those blocks that hold a set listed with them under one element and size class, so
the members of a huge group of copies are read once and not paired with each other. Only links
that connect components are made, never all pairs. Each of these steps first moves sketches, two to
four bits an element, which give an upper bound of every overlap; elements are moved only for sets
that the bound leaves a possible partner, so sets in a cluster by chance are not moved whole.

Frequencies are only used for that order. They are counted in stretches of a task's documents, and
kept in tables of ``SLOTS`` levels and in a bitmap of bounded size, in which rare elements may take
the place of others. Any tables give the same links.

Defined cases: words are runs without ASCII white space after A-Z were lower-cased; a text with
fewer than five words is one shingle; a NULL or empty text has an empty set and links with
nothing; rows that repeat a doc_id are documents of their own; a NULL doc_id is never a
component's id unless it is alone (then NULL); an empty table gives no rows. Elements and sets
are compared by 64-bit hashes. Extra columns stay; result columns replace those of the same name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, release
from .common import batch, broadcast_if_counted, map_batches, mix64, row_key, utf8
from .components import components
from .signature_tree import link, may_link, sketch

SHINGLE = 5
PERCENT = 80
SLOTS = 1 << 20
# Most slots of a bitmap: 32 MB.
FLAG_SLOTS = 1 << 28
# Elements or words counted together, and how often an element, and a word, must occur there to be reported.
STRETCH = 1 << 21
SEEN_ELEMENTS = 2
SEEN_WORDS = 32
# Elements reported so often get a level.
FREQUENT = 64
# Sizes of one class differ by less than this factor; alike sets are at most one class apart.
CLASS = 1.26
# Sets and elements of a block; the elements of one take 32 MB in a worker.
BLOCK_SETS = 2048
BLOCK_ELEMENTS = 1 << 22

# Words of more bytes are hashed one by one.
LONG_WORD = 64

# Masks of the lowest 0 to 8 bytes of a number.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_FACTORS = (np.arange(1, 33, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a text, in order; eight bytes of all words are taken in at a time."""
    low = np.frombuffer(text.lower() + bytes(8), np.uint8)  # on bytes, lower() knows ASCII only
    given = low[:-8]
    space = np.ones(len(given) + 2, bool)
    space[1:-1] = (given == 32) | (given - np.uint8(9) < 5)  # ASCII white space: a blank, and 9 to 13
    change = np.flatnonzero(space[1:] != space[:-1])
    at, sizes = change[::2], change[1::2] - change[::2]
    eight = np.ndarray(len(given) + 1, "<u8", low, strides=(1,))
    hashes = mix64(mix64(sizes) ^ (eight[at] & _MASKS[np.minimum(sizes, 8)]))
    done, more = 8, np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD))
    while len(more):
        hashes[more] = mix64(hashes[more] ^ (eight[at[more] + done] & _MASKS[np.minimum(sizes[more] - done, 8)]))
        done += 8
        more = more[sizes[more] > done]
    for k in np.flatnonzero(sizes > LONG_WORD).tolist():
        hashes[k] = xxhash.xxh3_64_intdigest(low[at[k] : at[k] + sizes[k]].tobytes())
    return hashes


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """``np.unique`` for the few hashes of a text."""
    hashes = np.sort(hashes)
    first = np.ones(len(hashes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    return hashes[first]


def _sums(words: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += words[k : len(words) - size + 1 + k] * _FACTORS[k]
    return mix64(total)


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A 64-bit hash of every shingle, in order; fewer words than ``size`` are one shingle."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    return _sums(words, size) if n >= size else mix64(_sums(words, n) + np.uint64(n))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    return _distinct(shingle_hashes(word_hashes(text)))


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(11)).astype(np.int64) % SLOTS


def set_id(elements: np.ndarray) -> int:
    """Signed 64-bit id of a set; -1 if it is empty."""
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63) if len(elements) else -1


def set_and_firsts(text: bytes, order: tuple, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """A text's set, and the elements of which an alike set must share one: rare ones first, then by hash.

    ``order`` is what ``frequencies`` gives. An element's rank depends on it and the element alone.
    """
    words = word_hashes(text)
    found = shingle_hashes(words)
    at = np.argsort(found)
    elements = found[at]
    first = np.ones(len(at), bool)
    first[1:] = elements[1:] != elements[:-1]
    elements, at = elements[first], at[first]
    n = len(elements)
    if n < 2:
        return elements, elements
    levels, repeated = order
    common = levels[1][_slots(words)].astype(np.int64)
    weight = sum(common[k : len(common) - SHINGLE + 1 + k] for k in range(SHINGLE))[at]
    # One number holds all that ranks an element: levels of 8 bits, a flag, a sum below 2048, and its place by hash.
    rank = (levels[0][_slots(elements)].astype(np.int64) << 1 | _flagged(repeated, elements.view(np.int64))) << 11 | weight
    rank = rank << 40 | np.arange(n)
    most = n - (percent * n + 99) // 100 + 1
    if most < n:
        rank = np.partition(rank, most - 1)[:most]
    return elements, elements[np.sort(rank) & ((1 << 40) - 1)]


def frequencies(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Two rows of levels per slot, about log2 of how often the most frequent element, or word, was
    seen, and a bitmap of elements seen more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("kind", pa.int32()), ("h", pa.int64()), ("n", pa.int64())])
        held: tuple[list, list] = ([], [])

        def counted(kind: int, least: int) -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held[kind]), return_counts=True)
            held[kind].clear()
            often = n >= least
            return batch(out, np.full(often.sum(), kind), values[often].view(np.int64), n[often])

        def both():
            if held[0]:
                yield counted(0, SEEN_ELEMENTS)
                yield counted(1, SEEN_WORDS)

        total = 0
        for rows in batches:
            for text in utf8(rows.column("text")):
                words = word_hashes(text)
                held[0].append(_distinct(shingle_hashes(words)))
                held[1].append(words)
                total += len(words)
                if total >= STRETCH:
                    total = 0
                    yield from both()
        yield from both()

    seen = map_batches(docs.select(F.col("text").cast("string").alias("text")), run, "kind int, h long, n long")
    sums = materialise(seen.groupBy("kind", "h").agg(F.sum("n").alias("n")), "seen")
    slot = F.pmod(F.shiftrightunsigned("h", 11), F.lit(SLOTS)).cast("int")
    level = F.floor(F.log2(F.max("n"))).cast("int") + 1
    # At most 2 * SLOTS rows.
    found = sums.where(f"kind = 1 OR n >= {FREQUENT}").groupBy("kind", slot.alias("slot")).agg(level.alias("level")).toArrow()
    levels = np.zeros((2, SLOTS), np.uint8)
    levels[found["kind"].to_numpy(), found["slot"].to_numpy()] = found["level"].to_numpy()
    return levels, _flags(sums.where("kind = 0").select("h"))


def _document_sets(docs: DataFrame, order) -> DataFrame:
    """(doc, row, sid, n, firsts) per document."""
    out = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("sid", pa.int64()), ("n", pa.int64()), ("firsts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            both = [set_and_firsts(t, order.value) for t in utf8(rows.column("text"))]
            ids, sizes = [set_id(e) for e, _ in both], [len(e) for e, _ in both]
            yield batch(out, rows.column("doc"), rows.column("row"), ids, sizes, [f.view(np.int64) for _, f in both])

    return map_batches(docs.select("doc", "row", "text"), run, "doc long, row long, sid long, n long, firsts array<long>")


def _class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(CLASS))).cast("long")


def _listed(sets: DataFrame, percent: int, *more: str) -> DataFrame:
    """(key, sid, *more): a key stands for an element and a size class, and lists sets that may be alike by it.

    The first element that two alike sets share stands so early in both that the rest suffices:
    a set of n with the element at place i has no larger partner than (n - i) * (1 + 1/p) - n.
    Sets are therefore listed under (element, size class), and under the next class only if a
    partner of that size is possible.
    """
    shared = sets.select("sid", *more, F.col("n").cast("int").alias("n"), F.posexplode("firsts").alias("i", "h"))
    largest = (F.col("n") - F.col("i")) * (100 + percent) / percent - F.col("n")
    own = _class(F.col("n"))
    classes = F.when(largest >= F.pow(F.lit(CLASS), own + 1), F.array(own, own + 1)).otherwise(F.array(own))
    return shared.select("sid", *more, "h", F.explode(classes).alias("c")).select(F.xxhash64("h", "c").alias("key"), "sid", *more)


def _clusters(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(sid, cluster): classes (sid, n, firsts) connected by shared first elements; classes alone are left out.
    Also the table of keys that list several sets.

    Lists are reduced to their least and largest set before they are shuffled. Two sets are then an
    edge; only the members of longer lists are looked for again.
    """
    listed = _listed(sets, percent)
    hubs = listed.groupBy("key").agg(F.min("sid").alias("a"), F.max("sid").alias("b"), F.count("*").alias("m"))
    hubs = materialise(hubs.where("a < b"), "hubs")
    longer = hubs.where("m > 2").select("key", "a")
    others = listed.join(broadcast_if_counted(longer, longer.count(), 48), "key").where("sid <> a").select("a", F.col("sid").alias("b"))
    found = components(hubs.select("a", "b").unionByName(others))
    return found.select(F.col("node").alias("sid"), F.col("root").alias("cluster")), hubs


def _flags(values: DataFrame) -> np.ndarray:
    """A bitmap of hash slots that hold a value of the only column, 16 slots a value.

    It is bounded by ``FLAG_SLOTS``: beyond that, slots hold several values, and more than wanted
    pass the test.
    """
    slots = min(FLAG_SLOTS, max(1 << 16, 1 << (16 * values.count()).bit_length()))
    slot = F.pmod(values[values.columns[0]], F.lit(slots))
    parts = (
        values.select(slot.alias("s"))
        .select(F.shiftright("s", 15).alias("bucket"), F.col("s").bitwiseAND(F.lit(32767)).alias("bit"))
        .groupBy("bucket")
        .agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
    )
    parts = materialise(parts, "flags")
    flags = np.zeros(-(-slots // 32768) << 12, np.uint8)
    # Each partition that is fetched is a job of the driver; one for every 4 MB of the bitmap.
    for p in parts.coalesce(max(1, slots >> 25)).toLocalIterator():
        bits = np.frombuffer(bytes(p["bits"]), np.uint8)
        flags[p["bucket"] << 12 : (p["bucket"] << 12) + len(bits)] = bits
    release(parts)
    return flags[: slots // 8]


def _flagged(flags: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values % (len(flags) * 8)
    return (flags[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _gathered(docs: DataFrame, members: DataFrame, sketches: bool = False) -> DataFrame:
    """(sid, n, cluster, class, block, bits, elements) of ``members``, whose documents are cut into shingles again; repeated rows repeat.

    ``bits`` are NULL unless ``sketches`` are wanted. A counted, bounded table of members is broadcast,
    so that texts stay where they are.
    """
    given = ["sid", "n", "cluster", "class", "block"]
    out = pa.schema([(c, pa.int64()) for c in given] + [("bits", pa.binary()), ("elements", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            elements = [shingles(t) for t in utf8(rows.column("text"))]
            bits = [sketch(e) if sketches else None for e in elements]
            yield batch(out, *(rows.column(c) for c in given), bits, [e.tobytes() for e in elements])

    own = members.select(F.col("doc").alias("__doc"), F.col("row").alias("__row"), *given)
    own = broadcast_if_counted(own, members.count(), 160)
    found = docs.join(own, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("row") == F.col("__row")))
    kind = "sid long, n long, cluster long, class long, block long, bits binary, elements binary"
    return map_batches(found.select("text", *given), run, kind)


def _by_block(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list]]:
    """Each (cluster, block) with its rows (sid, side, *columns), which stand together; a repeated row counts once."""
    key, held, last = None, [], None
    for rows in batches:
        for cluster, block, sid, side, *more in zip(*(rows.column(n).to_pylist() for n in ("cluster", "block", "sid", "side", *columns)), strict=True):
            if (cluster, block) != key:
                if held:
                    yield key, held
                key, held, last = (cluster, block), [], None
            if (side, sid) == last:
                continue
            last = side, sid
            held.append((sid, side, *more))
    if held:
        yield key, held


def _blocked(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select("cluster", "block", "sid", "side", *columns).repartition("cluster", "block").sortWithinPartitions("cluster", "block", "side", "sid")


def _possible(blocks: DataFrame, percent: int, guests: bool = False) -> DataFrame:
    """Rows (cluster, block, sid, known, side) of ``blocks``, which hold sketches, that may be alike to a set
    of another component in their block; with ``guests``, also of the other side."""
    out = pa.schema([(c, pa.int64()) for c in ("cluster", "block", "sid", "known")] + [("side", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, held in _by_block(batches, ("known", "n", "bits")):
            ids, side, known, sizes, bits = zip(*held, strict=True)
            labels = np.arange(len(ids)) if known[0] is None else np.array(known, np.int64)
            left = np.flatnonzero(may_link(list(bits), np.array(sizes, np.int64), percent, labels, np.array(side) if guests else None)).tolist()
            if left:
                yield batch(out, [key[0]] * len(left), [key[1]] * len(left), *([x[k] for k in left] for x in (ids, known, side)))

    return map_batches(_blocked(blocks, "known", "n", "bits"), run, "cluster long, block long, sid long, known long, side boolean")


def _searched(blocks: DataFrame, percent: int, labels: bool = False, guests: bool = False) -> DataFrame:
    """Links found in each (cluster, block), streamed block by block.

    Rows are (cluster, block, sid, elements, known, side). A row (a, b) that is ``linked`` says
    that a and b are alike; with ``labels`` others say that ``a`` is in the component of ``b`` in
    its block. With ``guests`` only sets of different sides are compared.
    """
    out = pa.schema([("cluster", pa.int64()), ("block", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

    def search(key, held) -> Iterable[pa.RecordBatch]:
        ids, sets, known, side = zip(*held, strict=True)
        if (len(ids) < 2 and not labels) or (guests and not any(side)):
            return
        ids = np.array(ids, np.int64)
        start = np.arange(len(ids)) if known[0] is None else np.array(known, np.int64)
        sides = np.array(side) if guests else None
        found = link(list(sets), percent, start, sides)
        rows = [(int(ids[i]), int(ids[j]), True) for i, j in found]
        if labels:
            names = np.arange(len(ids))
            for i, j in found:
                a, b = names[i], names[j]
                names[names == max(a, b)] = min(a, b)
            rows += [(int(s), int(ids[r]), False) for s, r in zip(ids, names, strict=True)]
        if rows:
            a, b, linked = zip(*rows, strict=True)
            yield batch(out, [key[0]] * len(rows), [key[1]] * len(rows), a, b, linked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, held in _by_block(batches, ("elements", "known")):
            yield from search(key, [(sid, np.frombuffer(data, np.uint64), known, side) for sid, side, data, known in held])

    return map_batches(_blocked(blocks, "elements", "known"), run, "cluster long, block long, a long, b long, linked boolean")


def _narrowed(large: DataFrame, placed: DataFrame, percent: int, made: list[DataFrame], labels: bool = False, guests: bool = False) -> DataFrame:
    """``_searched`` for the sets of ``large`` that ``placed`` (cluster, block, sid, known, side) puts into blocks.

    Sketches are searched first; sets without a possible partner are left out, and have no label.
    """
    placed = materialise(placed.distinct(), "places")
    sketches = large.select("sid", "n", "bits").join(broadcast_if_counted(placed, placed.count(), 64), "sid")
    left = materialise(_possible(sketches, percent, guests), "possible")
    whole = large.select("sid", "elements").join(broadcast_if_counted(left, left.count(), 64), "sid")
    found = materialise(_searched(whole, percent, labels, guests), "links")
    made += [placed, left, found]
    return found


def _links(docs: DataFrame, classes: DataFrame, hubs: DataFrame, members: DataFrame, percent: int, made: list[DataFrame]) -> DataFrame:
    """(a, b): links that connect all alike sets of (cluster, large, class, block, sid, doc, row, n).

    What was written for them is added to ``made``, to be released once the links were read.
    """
    new = [F.lit(None).cast("long").alias("known"), F.lit(False).alias("side")]
    alone = ["cluster", "block", "sid", *new]
    single = _searched(_gathered(docs, members.where("NOT large")).select(*alone, "elements"), percent).select("a", "b")
    if members.where("large").isEmpty():
        return single
    large = materialise(_gathered(docs, members.where("large"), sketches=True), "blocks")
    of_large = large.select("cluster", "block", "sid", "n").distinct()
    first = _narrowed(large, large.select(*alone), percent, made, labels=True)
    label = first.where("NOT linked").select(F.col("a").alias("sid"), F.col("b").alias("label"))
    labelled = materialise(of_large.join(label, "sid", "left").withColumn("label", F.coalesce("label", "sid")), "labels")
    # One set of each component of each block; so many that they need blocks themselves are salted again.
    heads = labelled.where("sid = label")
    spread = heads.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_ELEMENTS)).alias("spread"))
    heads = heads.join(spread, "cluster").select("cluster", F.pmod(F.xxhash64("sid"), "spread").alias("block"), "sid", *new)
    second = _narrowed(large, heads, percent, made, labels=True)
    merged = second.where("NOT linked").select(F.col("a").alias("label"), F.col("b").alias("root"))
    named = labelled.join(merged, "label", "left").select("sid", "cluster", "block", F.coalesce("root", "label").alias("root"))
    most = named.groupBy("cluster", "root").agg(F.count("*").alias("m")).groupBy("cluster").agg(F.max_by("root", F.struct("m", "root")).alias("most"))
    named = materialise(named.join(most, "cluster"), "labels")
    # A set outside its cluster's largest component visits the blocks of sets that are listed with it.
    keys = broadcast_if_counted(hubs.select("key"), hubs.count(), 32)
    mine = classes.join(broadcast_if_counted(named, named.count(), 64), "sid")
    listed = _listed(mine, percent, "block", "root", "most").join(keys, "key", "left_semi")
    hosts = listed.select("key", F.col("block").alias("visited")).distinct()
    guests = listed.where("root <> most").select("key", "sid", "block")
    visits = materialise(guests.join(hosts, "key").where("visited <> block").select("sid", "visited").distinct(), "visits")
    visiting = named.join(visits, "sid").select("cluster", F.col("visited").alias("block"), "sid", F.col("root").alias("known"), F.lit(True).alias("side"))
    visited = named.join(visiting.select("cluster", "block").distinct(), ["cluster", "block"], "left_semi")
    own = visited.select("cluster", "block", "sid", F.col("root").alias("known"), F.lit(False).alias("side"))
    third = _narrowed(large, own.unionByName(visiting), percent, made, guests=True)
    made += [large, labelled, named, visits]
    for found in (first, second, third):
        single = single.unionByName(found.where("linked").select("a", "b"))
    return single


def _placed(members: DataFrame) -> DataFrame:
    """``members`` with ``large``, ``class`` and ``block``: where each set of a cluster is searched."""
    per = [F.count("*").alias("m"), F.sum("n").alias("size")]
    salts = F.ceil(F.greatest(F.col("m") / BLOCK_SETS, F.col("size") / BLOCK_ELEMENTS))
    whole = members.groupBy("cluster").agg(*per).select("cluster", (salts > 1).alias("large"))
    classed = members.join(whole, "cluster").withColumn("class", F.when(F.col("large"), _class(F.col("n"))).otherwise(F.lit(0).cast("long")))
    cells = classed.where("large").groupBy("cluster", "class").agg(*per).select("cluster", "class", salts.alias("salts"))
    salt = F.pmod(F.xxhash64("sid"), F.coalesce("salts", F.lit(1)).cast("long"))
    # Blocks are numbered by class, then salt.
    return classed.join(cells, ["cluster", "class"], "left").withColumn("block", F.shiftleft(F.col("class"), 32) + salt).drop("salts")


def memberships(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc, row, n_shingles, component_id, root): one row per row of ``docs`` (doc_id, text).

    ``root`` tells components apart where ids repeat; it is NULL for empty sets.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc"), row_key().alias("row"), F.col("text").cast("string").alias("text"))
    order = spark.sparkContext.broadcast(frequencies(keyed))
    sets = materialise(_document_sets(keyed, order), "sets")
    full = sets.where("n > 0")
    # Copies are combined before the shuffle; a class has the same first elements in all of them.
    # NULL ids give way to others: the least id of a class, then of a component.
    first = F.min(F.struct(F.col("doc").isNull().alias("absent"), "doc", "row", "n")).alias("m")
    classes = full.groupBy("sid").agg(first, F.any_value("firsts").alias("firsts")).select("sid", "m.*", "firsts").drop("absent")
    classes = materialise(classes, "classes")
    clusters, hubs = _clusters(classes, percent)
    clusters = materialise(clusters, "clusters")
    # Read four times to place sets; written, they are joined once.
    members = materialise(classes.drop("firsts").join(clusters, "sid"), "members")
    placed = materialise(_placed(members), "placed")
    release(members)
    made = [clusters, hubs, placed]
    roots = components(_links(keyed, classes, hubs, placed, percent, made))
    release(*made)
    lowest = classes.select("sid", "doc")
    named = lowest.join(roots, lowest["sid"] == roots["node"], "left").select("sid", F.coalesce("root", "sid").alias("root"), "doc")
    least = named.groupBy("root").agg(F.min("doc").alias("component_id"))
    of_class = named.select("sid", "root").join(least, "root").select("sid", "root", "component_id")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc"))
    return sets.join(of_class, "sid", "left").select(
        "doc", "row", F.col("n").alias("n_shingles"), component.alias("component_id"), "root"
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with ``n_shingles`` and ``component_id``, the least doc_id reachable by links."""
    found = memberships(docs, percent).drop("root").withColumnsRenamed({"doc": "__doc", "row": "__row"}).distinct()
    names = [c for c in docs.columns if c not in ("n_shingles", "component_id")]
    given = docs.select(F.struct(*names).alias("given"), F.col("doc_id").cast("long").alias("doc"), row_key().alias("row"))
    joined = given.join(found, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("row") == F.col("__row")))
    return joined.select("given.*", "n_shingles", "component_id")


def one_per_component(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with the document of least doc_id of every component; texts without words all stay.

    Rows of a component that repeat that doc_id are reduced to one of them.
    """
    found = memberships(docs, percent).where(F.col("doc").eqNullSafe(F.col("component_id")))
    least = F.min(F.struct("row", "m")).alias("least")
    kept = found.groupBy("root", "doc", "row").agg(F.count("*").alias("m")).groupBy("root", "doc").agg(least)
    kept = materialise(kept.select(F.col("doc").alias("__doc"), F.col("least.row").alias("__row"), F.col("least.m").alias("__m")), "kept")
    # Counted and bounded, it is broadcast, so that texts stay where they are; only rows that are repeated are grouped.
    own = broadcast_if_counted(kept, kept.count(), 32)
    given = docs.select(F.struct(*docs.columns).alias("given"), F.col("doc_id").cast("long").alias("doc"), row_key().alias("row"))
    joined = given.join(own, F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("row") == F.col("__row")))
    once = joined.where("__m = 1").select("given.*")
    if kept.where("__m > 1").isEmpty():
        return once
    again = joined.where("__m > 1").groupBy("__doc", "__row").agg(F.first("given").alias("given"))
    return once.unionByName(again.select("given.*"))
