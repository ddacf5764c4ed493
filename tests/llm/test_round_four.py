"""What near-duplicate search moves, and texts packed for the language model."""

import random
from itertools import combinations

import numpy as np

from millrace.llm import jaccard, language_model
from millrace.llm.signature_tree import alike, may_link, sketch


def test_sketches_leave_out_no_alike_sets():
    rng = np.random.default_rng(5)
    sets = []
    for size in (1, 2, 5, 30, 31, 33, 64, 200, 260, 1000, 1100):
        own = rng.integers(0, 1 << 63, size).astype(np.uint64)
        for change in (0, 1, size // 9, size // 5, size // 2):
            sets.append(np.unique(np.concatenate((own[change:], rng.integers(0, 1 << 63, change).astype(np.uint64)))))
    sizes = np.array([len(s) for s in sets])
    labels = np.arange(len(sets))
    side = rng.random(len(sets)) < 0.5
    grouped = labels // 3
    for names, sides in ((labels, None), (grouped, None), (labels, side)):
        found = may_link([sketch(s) for s in sets], sizes, 80, names, sides)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if names[i] != names[j] and (sides is None or sides[i] != sides[j]) and alike(a, b, 80):
                    assert found[i] and found[j]
    strangers = [np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64)) for _ in range(50)]
    assert not may_link([sketch(s) for s in strangers], np.array([len(s) for s in strangers]), 80, np.arange(50)).any()


def test_elements_of_a_cluster_by_chance_stay(spark, monkeypatch):
    """Texts quote the same passages, so they are one cluster, but only the last is alike to another."""
    rng = random.Random(2)
    passages = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) for _ in range(12)]
    texts = [f"{a} {b}" for a, b in combinations(passages, 2)] + [f"{passages[0]} {passages[1]} more"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    moved, search = [], jaccard._searched

    def counted(blocks, *args, **kw):
        moved.append(blocks.count())
        return search(blocks, *args, **kw)

    monkeypatch.setattr(jaccard, "_searched", counted)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 8)
    found = {r.doc: r.component_id for r in jaccard.memberships(docs).collect()}
    assert found == {i: i for i in range(66)} | {66: 0}
    assert len(moved) > 1 and sum(moved) <= 12


def test_kept_documents_move_no_text(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(20)]
    given = [(i, t, f"s{i}") for i, t in enumerate(texts + texts[:5])] + [(99, None, "n")]
    schema = "doc_id long, text string, source string"
    kept = jaccard.one_per_component(spark.createDataFrame(given, schema))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert sorted(r.doc_id for r in kept.collect()) == [*range(20), 99]
    twice = jaccard.one_per_component(spark.createDataFrame(given + given[:3] + given[-1:], schema))
    assert sorted(r.doc_id for r in twice.collect()) == [*range(20), 99]


def test_texts_are_shuffled_in_compressed_pieces(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"word{i}é" for i in range(300)]
    given = [(i % 3, None if i == 7 else i, i * 31 % 101, i % 5 > 0, None if i == 8 else " ".join(rng.choices(words, k=rng.randrange(200)))) for i in range(90)]
    placed = spark.createDataFrame(given, "stretch long, doc long, row long, trains boolean, text string")
    raw = sum(len((t or "").encode()) for *_, t in given)
    for piece, held in ((1 << 18, 32 << 20), (1000, 32 << 20), (1 << 18, 5000)):
        monkeypatch.setattr(language_model, "PIECE_BYTES", piece)
        monkeypatch.setattr(language_model, "HELD_BYTES", held)
        pieces = language_model._pieces(placed.coalesce(1)).collect()
        for stretch in range(3):
            found = language_model._in_order(tuple(p)[1:] for p in pieces if p.stretch == stretch)
            wanted = sorted((g[1:] for g in given if g[0] == stretch), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
            assert found == [(d, r, t, (x or "").encode()) for d, r, t, x in wanted]
        if piece > 1000 and held > 5000:
            assert len(pieces) == 3 and sum(len(p.texts) for p in pieces) < raw / 2
