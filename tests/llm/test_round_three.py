"""Fill-in-middle, periodic runs and language-model scores against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import infill, language_model, periods
from millrace.llm.queries import QUERIES, planted_periods

from ..conftest import SF
from . import brute

TABLE = "doc_id long, text string, n string, form string, runs string, row string, stretch string"


def table(spark, rows):
    return spark.createDataFrame([(d, t, "x", "y", "z", "r", "s") for d, t in rows], TABLE)


def odd_texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    body = [" ".join(rng.choices(words, k=rng.randrange(1, 80))) for _ in range(40)]
    block = " ".join(words[:7])
    return [
        (None, None),
        (None, "no id"),
        (1, ""),
        (2, " \n\t "),
        (3, "ab"),
        (4, "a <P> mark"),
        (5, "almost <S< M> and <P"),
        (6, "é́ \U0001f600 ß ＡＢＣ " * 50),
        (7, "The END the"),
        (8, "x " * 500),
        (9, f"{block} " * 9 + "tail"),
        (9, f"{block} " * 9 + "tail"),
        (10, body[0] + " " + "p q r " * 30 + body[1] + " " + "p p q " * 11),
        (11, "<" + "P" * 3000 + ">\n" + body[2] * 20),
        (12, "a\x0bb\x0cc\rd   e f"),
        *[(20 + i, t) for i, t in enumerate(body)],
        *[(80 + i, body[0] + " shared " * (i + 3) + body[1]) for i in range(12)],
    ]


# --- fill-in-middle -----------------------------------------------------------------------------


def plain_infill(doc, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not n or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return doc, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_infill(spark):
    rows = odd_texts()
    out = infill.fill_in_middle(table(spark, rows))
    assert out.columns == ["doc_id", "text", "runs", "row", "stretch", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = out.withColumn("back", infill.restored()).collect()
    key = repr
    got = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in found]
    assert sorted(got, key=key) == sorted((plain_infill(*r) for r in rows), key=key)
    assert all(r["back"] == (r["text"] or "") for r in found)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(table(spark, [])).count() == 0


def test_infill_rates(spark):
    docs = table(spark, [(i, f"text {i}") for i in range(300)])
    assert infill.fill_in_middle(docs, rate=0).where("form <> 'plain'").count() == 0
    assert infill.fill_in_middle(docs, rate=100, spm=100).where("form <> 'spm'").count() == 0
    assert infill.fill_in_middle(docs, seed="2").exceptAll(infill.fill_in_middle(docs)).count() > 0


@pytest.mark.parametrize("segment", [64, 1000, 1 << 20])
def test_chunks_follow_content(monkeypatch, segment):
    rng = random.Random(7)
    monkeypatch.setattr(infill, "SEGMENT", segment)
    shared = "".join(rng.choices("abcdefgh é\n", k=30_000)).encode()
    one, two = b"head" * 40 + shared, "other bégin".encode() * 90 + shared + b"end"
    for text in (one, two, b"", b"x", b"y" * 20_000):
        ends = infill.borders(text)
        assert ends == sorted(set(ends)) and (ends[-1] if ends else 0) == len(text)
        sizes = np.diff([0, *ends])
        assert all(s <= infill.MOST for s in sizes) and all(s >= infill.LEAST for s in sizes[:-1])
    chunks = [{t[a:b] for a, b in zip([0, *infill.borders(t)], infill.borders(t), strict=False)} for t in (one, two)]
    assert len(chunks[0] & chunks[1]) > 0.8 * len(chunks[0])
    summaries, small = infill.Summaries(), infill.Summaries(most=4096)
    for t in (one, two, one):
        assert infill.measured(t, small)[0] == infill.borders(t)
        ends, upto, marked = infill.measured(t, summaries)
        assert upto[-1] == len(t.decode()) and not marked
        for place in rng.sample(range(len(t.decode())), 50):
            assert len(t[: infill.located(t, ends, upto, place)].decode()) == place
        assert infill.located(t, ends, upto, int(upto[-1])) == len(t)
    assert summaries.shared > len(infill.borders(one))
    assert sum(len(c) for c, *_ in small.now.values()) < 4096 + 2 * infill.MOST


def test_marks_across_chunks(monkeypatch):
    monkeypatch.setattr(infill, "LEAST", 1)
    monkeypatch.setattr(infill, "MOST", 1)
    for text, marked in ((b"ab<P>c", True), (b"<M>", True), (b"<M", False), (b"<<S>>", True), (b"<P >", False)):
        assert infill.measured(text, infill.Summaries())[2] is marked


def test_colliding_chunks(monkeypatch):
    monkeypatch.setattr(infill.xxhash, "xxh3_64_intdigest", lambda chunk: 1)
    summaries = infill.Summaries()
    assert [summaries.of(c) for c in (b"a", "éé".encode(), b"<P>", b"a")] == [(1, False), (2, False), (3, True), (1, False)]


# --- periodic runs ------------------------------------------------------------------------------


def plain_runs(words):
    """(start, period, length), by comparing the words with themselves at every shift."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and j > i:
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, q, m) for (s, m), q in found.items())


def plain_collapse(words, runs):
    gone = {i for s, q, m in runs for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng, n):
    """Words with runs inside runs."""
    words = []
    while len(words) < n:
        block = rng.choices("abcd" if rng.random() < 0.5 else [f"v{i}" for i in range(60)], k=rng.randrange(1, 14))
        if rng.random() < 0.4:
            block = block * rng.randrange(2, 6) + rng.choices("ab", k=rng.randrange(3))
        words += block * rng.choice((1, 1, 2, 4, 5, 9)) + block[: rng.randrange(len(block))]
    return words[:n]


def test_solver_against_all_shifts():
    rng = random.Random(11)
    texts = [repetitive(rng, rng.randrange(0, 400)) for _ in range(300)]
    texts += [["a"] * n for n in (0, 1, 5, 6, 7, 64, 333)] + [list("ab") * 41, list("aab") * 30 + list("ab") * 9]
    fib = ["a", "ab"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    texts += [list(fib[-1]), list((fib[5] * 7 + "c") * 5)]
    for words, found in zip(texts, periods.solve_texts([[w.encode() for w in t] for t in texts]), strict=True):
        assert sorted((s, q, e - s + q) for q, s, e in found) == plain_runs(words)


def test_runs(spark):
    rng = random.Random(5)
    rows = [*odd_texts(), *[(200 + i, " ".join(repetitive(rng, 900))) for i in range(6)], (300, "a b " * 3000 + "c"), (300, "a b " * 3000 + "c")]
    expected = []
    for doc, text in rows:
        words = brute.WORD.findall(text or "")
        runs = plain_runs(words)
        left = plain_collapse(words, runs)
        expected.append((doc, len(words), runs, left if runs else None, brute.sha(left)))
    for more in ({}, {"long_bytes": 300, "slice_words": 64}):
        out = periods.periodic_runs(table(spark, rows), **more)
        assert out.columns == ["doc_id", "n_words", "runs", "collapsed", "collapsed_sha256"]
        got = [(r[0], r[1], [tuple(x) for x in r[2]], r[3], r[4]) for r in out.collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert periods.periodic_runs(table(spark, [])).count() == 0


def test_slices_cover_all_octaves():
    for n, words in ((100, 64), (5000, 64), (100_000, 1 << 12)):
        seen = defaultdict(list)
        for low, high, start, stop, first, last in periods.slices(n, words):
            for k in range(low, high):
                seen[k].append((first, last))
                assert first % (1 << k) == 0 and start % (1 << k) == 0
                assert start <= max(0, first - (1 << k)) and stop >= min(n, last + (1 << k))
        assert sorted(seen) == list(range(periods.octaves_of(n)))
        for own in seen.values():
            own.sort()
            assert own[0][0] == 0 and own[-1][1] == n and all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False))


def test_runs_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    planted = {r["doc_id"]: r["text"] for r in planted_periods(docs).collect()}
    found = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(found) == len(texts)
    for doc, text in texts.items():
        words, h = brute.WORD.findall(text or ""), zlib.crc32(str(doc).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            assert planted[doc] == " ".join(words)
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[2] / r[1], -r[0], -r[1])) if runs else (None,) * 3
        expected = {
            "n_runs": len(runs),
            "start": best[0],
            "length": best[2],
            "period": best[1],
            "exponent_milli": 1000 * best[2] // best[1] if runs else None,
            "runs_sha256": brute.sha("".join(f"{s},{m},{q}\n" for s, q, m in runs)),
            "collapsed_sha256": brute.sha(plain_collapse(words, runs)),
        }
        assert {k: found[doc][k] for k in expected} == expected


# --- language model -----------------------------------------------------------------------------


def plain_scores(rows):
    """Counts in dictionaries, events of the deleted fold one by one, weights by the operator's own EM."""

    def tokens(text):
        return [w.encode() for w in brute.WORD.findall((text or "").translate(brute.LOWER))] + [b""]

    def fold(doc):
        return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7

    def counted(some):
        one, two = Counter(), Counter()
        for _, text in some:
            t = tokens(text)
            one.update(t)
            two.update(zip([None, *t], t, strict=False))
        return one, two, len(some)

    train = [r for r in rows if fold(r[0]) != 2]
    full, rest = counted(train), counted([r for r in train if fold(r[0]) != 3])
    kinds = len(full[0])

    def shares(counts, text):
        one, two, texts = counts
        n, t = one.total(), tokens(text)
        for v, w in zip([None, *t], t, strict=False):
            c = texts if v is None else one[v]
            yield c, two[v, w] / c if c else 0.0, one[w] / max(n, 1), 1 / (kinds + 1)

    events = Counter()
    for doc, text in rows:
        if fold(doc) == 3:
            for c, two, one, flat in shares(rest, text):
                b = c.bit_length()
                events[b, *(int(language_model._grid(np.array([x / flat]))[0]) for x in (two, one))] += 1
    cells = np.array([(*k, n) for k, n in events.items()], np.int64).reshape(-1, 4)
    weights = language_model.fit_weights(*cells.T) if full[0] else np.tile([0.0, 0.0, 1.0], (70, 1))
    for doc, text in rows:
        t = tokens(text)
        score = sum(math.log10(weights[c.bit_length()] @ np.array([two, one, flat])) for c, two, one, flat in shares(full, text))
        base = sum(math.log10((full[0][w] + 1) / (full[0].total() + kinds + 1)) for w in t)
        yield doc, fold(doc) == 2, len(t), sum(w in full[0] for w in t), full[0].total(), base, score


def same_scores(got, expected):
    got, expected = sorted(got, key=repr), sorted(expected, key=repr)
    # Sums differ in the last digits, so rows are matched by their exact columns first.
    by = defaultdict(list)
    for r in got:
        by[tuple(r[:5])].append(r[5:])
    for e in expected:
        near = [x for x in by[e[:5]] if np.allclose(x, e[5:], rtol=1e-9, atol=1e-9)]
        assert near, e
        by[e[:5]].remove(near[0])
    assert not any(by.values())


@pytest.mark.parametrize("more", [{}, {"stretch_words": 7, "stretch_bytes": 200, "range_keys": 16}, {"stretch_words": 1}])
def test_scores(spark, more):
    rows = odd_texts()
    got = [tuple(r) for r in language_model.language_model_scores(table(spark, rows), **more).collect()]
    same_scores(got, list(plain_scores(rows)))


@pytest.mark.parametrize("ids", [[], [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:4], [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 not in (2, 3)][:9]])
def test_scores_without_some_folds(spark, ids):
    rows = [(i, f"some words of {i} some") for i in ids]
    got = [tuple(r) for r in language_model.language_model_scores(table(spark, rows)).collect()]
    same_scores(got, list(plain_scores(rows)))


def test_scores_of_the_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op13_lm_scores"](spark, SF)
    got = [tuple(r) for r in found.collect()]
    same_scores(got, list(plain_scores(docs)))
    held = found.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_mixture_is_a_distribution():
    rng = np.random.default_rng(1)
    n = 500
    cells = (rng.integers(0, 9, n), rng.integers(-1, 200, n), rng.integers(-1, 120, n), rng.integers(1, 50, n))
    weights = language_model.fit_weights(*cells)
    assert np.allclose(weights.sum(axis=1), 1) and (weights >= 0).all() and weights[0, 0] == 0


def test_packing():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    assert (language_model._keys_unpacked(language_model._keys_packed(keys)) == keys).all()
    for kind in (np.uint32, np.int64):
        counts = rng.integers(0, 1000, 77).astype(kind)
        assert (language_model._unpacked(language_model._packed(counts), kind) == counts).all()
