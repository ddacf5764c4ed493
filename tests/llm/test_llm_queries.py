"""Registered queries over the supplied tables, against SQL or plain versions."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm.queries import ORACLES, QUERIES, TOKENIZER

from ..compare import compare, connect
from ..conftest import SF
from . import brute


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, ORACLES[name]) == []


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_token_counts(spark, texts):
    tok = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    for r in QUERIES["op2_token_counts"](spark, SF).collect():
        n = len(tok.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 2048)


def test_token_files(spark, texts):
    check_token_files(QUERIES["op9_token_files"](spark, SF).collect(), sorted(texts.items()))


def check_token_files(found, expected):
    tok, start = Tokenizer.from_file(public_tokenizers.path(TOKENIZER)), 0
    for r, (doc, text) in zip(sorted(found, key=lambda r: r["start"]), expected, strict=True):
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_mix(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()
    sizes, source = {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.WORD.findall(r["text"] or ""))
        source[r["doc_id"]] = r["source"]
    goal, taken = brute.targets(sizes), dict.fromkeys(sizes, 0)
    for r in QUERIES["op3_source_mix"](spark, SF).collect():
        own = source[r["doc_id"]]
        taken[own] += r["taken"]
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[own]
        assert abs(r["target"] - goal[own]) < 1e-6
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in sizes)


def test_toxicity_of_held_out_rows(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op1_toxicity"](spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    hits = sum(p and t for p, t in held)
    assert hits / sum(t for _, t in held) > 0.85
    assert hits / sum(p for p, _ in held) > 0.95
    clean = [r["predicted"] for r in rows if labels.get(r["doc_id"]) == 0]
    assert sum(clean) <= 0.01 * len(clean)


def check_whole_mix(given, taken):
    """Words per source against the plain targets; one document of a source is rounded."""
    sizes, largest, got = {}, {}, {}
    for r in given:
        n = len(brute.WORD.findall(r["text"] or ""))
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
        largest[r["source"]] = max(largest.get(r["source"], 0), n)
    for r in taken:
        got[r["source"]] = got.get(r["source"], 0) + len(brute.WORD.findall(r["text"]))
    for source, goal in brute.targets(sizes).items():
        assert abs(got.get(source, 0) - goal) <= largest[source] + 0.5, source


def test_pipeline_edges(spark):
    """NULLs, empty texts, repeated rows and clashing columns through every stage; then an empty table."""
    clash = ["score", "predicted", "held_out", "n_words", "component_id", "taken", "given", "contaminated"]
    words = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"other{i}" for i in range(40))
    texts = [(1, None, "a"), (2, "", None), (3, words, "a"), (3, words, "a"), (4, words + " more", None), (5, other, "b"), (None, None, "b")]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in clash)
    docs = spark.createDataFrame([(*t, *[f"{c}-{t[0]}" for c in clash]) for t in texts], schema)
    left = {"toxicity": 7, "near_duplicates": 5, "decontamination": 5}
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
        if name == "token_files":
            break
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert all(r[c] == f"{c}-{r['doc_id']}" for r in rows for c in clash)
        if name in left:
            assert len(rows) == left[name]
            docs = out
        else:
            assert {r["doc_id"] for r in rows} == {3, 5}


def test_pipeline_stages(spark):
    """Each stage against a plain version of itself on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, None
    benchmark = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name == "token_files":
            check_token_files(out.collect(), sorted(rows))
            break
        assert out.columns == columns
        out = out.cache()
        left = sorted((r["doc_id"], r["text"]) for r in out.collect())
        assert set(left) <= set(rows)
        if name == "toxicity":
            rejected = {r["doc_id"] for r in QUERIES["op1_toxicity"](spark, SF).collect() if r["predicted"]}
            assert left == sorted(r for r in rows if r[0] not in rejected)
        elif name == "near_duplicates":
            groups = brute.jaccard_components(rows)
            assert [d for d, _ in left] == sorted({g for _, n, g in groups if n} | {d for d, n, _ in groups if not n})
        elif name == "decontamination":
            assert left == sorted(r for r, c in zip(rows, brute.contamination(rows, benchmark), strict=True) if not c[-1])
        elif name == "source_mix":
            assert max(left.count(x) for x in set(left)) <= 3
            check_whole_mix(docs.collect(), out.collect())
        docs, before = out, left
    assert before
    assert corpus_pipeline.run(spark, SF).count() == len(before)
