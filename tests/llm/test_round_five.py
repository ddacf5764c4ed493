"""What near-duplicate search asks of the driver, and how words are hashed."""

import random
import time

import numpy as np

from millrace.llm import components, jaccard


def test_bitmap_takes_few_jobs_whatever_the_partitions(spark):
    """A partition fetched is a job of the driver; there was one for each."""
    rng = np.random.default_rng(3)
    values = rng.integers(-(1 << 62), 1 << 62, 3000)
    given = spark.createDataFrame([(int(v),) for v in [*values, -1, 0, 1, 32767, 32768, 65535, 65536]], "h long")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 60)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("bitmap", "bitmap")
    try:
        flags = jaccard._flags(given)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("bitmap")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(jobs) < 12
    held = np.array([r.h for r in given.collect()])
    wanted = np.zeros(len(flags) * 8, bool)
    wanted[held % len(wanted)] = True
    assert (np.unpackbits(flags, bitorder="little") == wanted).all()
    assert jaccard._flagged(flags, held).all()


def test_a_round_of_components_plans_one_contraction(spark, monkeypatch):
    """The driver keeps every plan; a round's read its edges 12 times."""
    scans, write = [], components.materialise

    def seen(df, label):
        scans.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
        return write(df, label)

    monkeypatch.setattr(components, "materialise", seen)
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)] + [(k, k + 1) for k in range(400, 440)] + [(7, 7)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert scans and max(scans) <= 3
    least = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in least:
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert found == least


def test_words_are_hashed_at_once():
    """Equal words have equal hashes, others have not, whatever their length and neighbours."""
    rng = random.Random(6)
    made = [bytes(rng.choice(b"abAB\0\xc3\xa4\x1c\x85") for _ in range(rng.choice([1, 7, 8, 9, 15, 16, 17, 24, 63, 64, 65, 200]))) for _ in range(3000)]
    made += [b"\0" * k for k in range(1, 70)]
    seen: dict[bytes, int] = {}
    for _ in range(200):
        text = b"".join(rng.choice(made) + rng.choice([b" ", b"\n", b"\t \r", b"\x0b", b"\x0c"]) for _ in range(rng.randrange(40)))
        words = text.lower().split()
        hashes = jaccard.word_hashes(text).tolist()
        assert len(hashes) == len(words)
        assert all(seen.setdefault(w, h) == h for w, h in zip(words, hashes, strict=True))
    assert len(set(seen.values())) == len(seen) > 2000
    assert not len(jaccard.word_hashes(b"")) and not len(jaccard.word_hashes(b" \n"))


def test_words_seen_once_are_hashed_in_little_time():
    """It took several times what cutting the text takes, a call for every new word."""
    rng = random.Random(7)
    texts = [" ".join(f"{rng.randrange(16**7):x}" for _ in range(500)).encode() for _ in range(400)]

    def spent(work) -> float:
        began = time.thread_time()
        for t in texts:
            work(t)
        return time.thread_time() - began

    cut = min(spent(lambda t: t.lower().split()) for _ in range(5))
    assert min(spent(jaccard.word_hashes) for _ in range(5)) < 6 * cut


def test_ranks_are_those_of_the_order():
    """Rare elements first, then those that occur once, of rarer words, of lower hash."""
    rng = np.random.default_rng(8)
    order = rng.integers(0, 256, (2, jaccard.SLOTS)).astype(np.uint8), rng.integers(0, 256, 1 << 13).astype(np.uint8)
    for n in (0, 1, 4, 5, 6, 30, 400):
        text = " ".join(f"w{k}" for k in rng.integers(0, 40, n)).encode()
        words = jaccard.word_hashes(text)
        elements, at = np.unique(jaccard.shingle_hashes(words), return_index=True)
        found, firsts = jaccard.set_and_firsts(text, order)
        assert found.tolist() == elements.tolist()
        if len(elements) > 1:
            level = order[0][0][jaccard._slots(elements)].tolist()
            flag = jaccard._flagged(order[1], elements.view(np.int64)).tolist()
            weight = [int(order[0][1][jaccard._slots(words[k : k + 5])].sum()) for k in at]
            ranked = sorted(zip(level, flag, weight, elements.tolist(), strict=True))
            assert firsts.tolist() == [r[-1] for r in ranked][: len(elements) - (80 * len(elements) + 99) // 100 + 1]
