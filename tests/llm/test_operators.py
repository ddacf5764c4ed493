"""Operators against plain versions on odd rows: NULLs, empty and very long texts, ties, repeats, clashing columns."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import chat, components, decontam, jaccard, line_dedup, mixing, quality, secrets, signature_tree, token_counts, token_files, toxicity
from millrace.llm.pieces import Pieces, load_config, whole_tokens
from millrace.session import release, scratch_path

from . import brute

PATH = public_tokenizers.path("word_bpe_49k.json")
KEY = "AKIA" + "A1B2C3D4" * 3
LINE = "  This line is LONG enough to count \t"
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
CLASH = "doc_id long, text string, source string, row long, doc string, n_tokens string, score string, kept string, given string, h string"


def odd_rows():
    """(doc_id, text, source)."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    body = [" ".join(rng.choices(words, k=60)) for _ in range(6)]
    texts = [
        None,
        "",
        " \n\t",
        "one",
        "ONE",
        "one two three",
        LONG,
        LONG,
        LONG + " end",
        *body,
        body[0],
        body[0].upper(),
        body[0] + " tail",
        " ".join(body[1].split()[:-2] + ["x", "y"]),
        f"{LINE}\nshort\n{LINE}\n{body[2]}",
        f"{LINE.lower()}\nshort",
        f"a\n{LINE.strip()}",
        f"\n{LINE}\n",
        f"{body[3]} {PASSAGE} {body[4]}",
        PASSAGE.upper().replace(" ", ", "),
        "mu lambda kappa",
        "é É ñ Straße ΑΣ İ ﬁ     x́ 日本語 😀 <|endoftext|>a<|startoftext|>",
        "I'll don't it's 123 4.5 a_b \x1c \x00 \x85",
        f'password = "hunter22" secret=token: abcdefgh TOKEN:abc api_key:{"Z" * 8}',
        f"{KEY} xAKIA12 {'0123456789abcdef' * 2} token=token=abcdefgh passwd  : 12345",
        "ſecret=abcdefgh toKen=abcdefgh sécret secret='äöü'",
        "be " * 200,
        "# * $ % & | < > " * 20,
    ]
    rows = [(i, t, [None, "b", "a", "é", "z"][i % 5]) for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, body[5], "a"), (None, None, None), (9, "another text of the same id", "b")]


@pytest.fixture(scope="module")
def rows():
    return odd_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    wide = [(*r, 7, "d", "t", "s", "k", "g", "h") for r in rows]
    return spark.createDataFrame(wide, CLASH).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CLASH)


def same(df, expected):
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == sorted(expected, key=repr)


# Token counts and files


def test_whole_tokens_are_proved():
    tok = Tokenizer.from_file(PATH)
    whole = whole_tokens(load_config(PATH))
    assert len(whole) > 20_000
    for w in sorted(whole)[::97]:
        assert len(tok.encode(w, add_special_tokens=False).ids) == 1


def test_pieces_equal_the_library():
    pieces, rng = Pieces(load_config(PATH)), random.Random(1)
    alphabet = list("abcXYZ019'’.,-_!#é È ß ſ İ Σ ς ª ² ¼ ﬁ́ ­İŉµŸ\n\t\x0b\x1c\x85 ") + ["<|endoftext|>", "'s", "'LL"]
    cut = 0
    for _ in range(6000):
        text = "".join(rng.choices(alphabet[: rng.choice([14, 40, len(alphabet)])], k=rng.randint(1, 9)))
        cut += pieces.cut(text) is not None
        got = pieces.spread(text.encode(), pieces.merge, list)
        assert [i for ids in got for i in ids] == pieces.encode(text), repr(text)
    assert cut > 1000
    for c in map(chr, range(0x180)):
        got = pieces.spread(f"a{c}b{c.upper()}".encode(), pieces.merge, list)
        assert [i for ids in got for i in ids] == pieces.encode(f"a{c}b{c.upper()}"), repr(c)


def test_token_counts(docs, rows, empty):
    tok = Tokenizer.from_file(PATH)
    got = token_counts.count_tokens(docs, PATH, limit=5).select("doc_id", "n_bytes", "n_tokens", "over_limit")
    counts = [(d, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for d, t, _ in rows]
    same(got, [(*c, c[2] > 5) for c in counts])
    assert token_counts.count_tokens(empty, PATH, limit=5).count() == 0


def test_blocks_round_trip():
    rng = np.random.default_rng(3)
    for n in (1, 2, 4095, 4096):
        for top in (1, 2, 255, 256, 40_000, 1 << 32):
            ids = rng.integers(0, top, n).astype(np.uint32)
            ids[rng.integers(0, n, 3)] = (1 << 32) - 1
            for percentile in (1, 50, 97, 100):
                assert np.array_equal(token_files.decode_block(b"??" + token_files.encode_block(ids, percentile), 2), ids)


def test_patches_shrink_blocks():
    ids = np.full(4096, 9, np.uint32)
    ids[::100] = 1 << 30
    assert len(token_files.encode_block(ids)) < 4096


def test_token_files(spark, docs, rows, empty):
    tok = Tokenizer.from_file(PATH)
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, path, PATH, end_id=1)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for r, (doc, text, _) in zip(got, order, strict=True):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (doc, start, len(ids))
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        start += len(ids)
    other = scratch_path(spark, "tokens")
    token_files.write_token_files(empty, other, PATH, end_id=1)
    assert token_files.read_token_files(spark, other).count() == 0


# Mixing


def check_mix(taken, sizes, block):
    goal = brute.targets(sizes)
    for source, group in taken.items():
        assert all(t <= 3 * s for s, t in group)
        assert sum(s for s, _ in group) == sizes[source]
        assert abs(sum(t for _, t in group) - goal[source]) <= 0.5


def test_mix(docs, rows, empty):
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.WORD.findall(t or ""))
    for block in (7, 512):
        pieces = mixing.mix(docs, block=block)
        got = mixing.taken_words(pieces).collect()
        again = mixing.taken_words(mixing.mix(docs.repartition(5), block=block)).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, again))
        assert sorted((r["size"] for r in got)) == sorted(len(brute.WORD.findall(t or "")) for _, t, _ in rows)
        by_size = {v: k for k, v in sizes.items()}
        assert len(by_size) == len(sizes)
        taken: dict = {}
        for r in got:
            taken.setdefault(by_size[r["source_size"]], []).append((r["size"], r["taken"]))
            assert abs(r["target"] - brute.targets(sizes)[by_size[r["source_size"]]]) < 1e-6
        check_mix(taken, sizes, block)
        slots = [r["slot"] for r in pieces.where("slot IS NOT NULL").select("slot").distinct().collect()]
        assert len(slots) == sum(-(-int(t + 0.5) // block) for t in brute.targets(sizes).values())
    assert mixing.taken_words(mixing.mix(empty)).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


def test_mixed_documents(docs):
    taken = {}
    for r in mixing.taken_words(mixing.mix(docs)).collect():
        copies = int(r["taken"] / r["size"] + 0.5) if r["size"] else 0
        taken[r["doc_id"], r["size"]] = taken.get((r["doc_id"], r["size"]), 0) + copies
    got: dict = {}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        key = r["doc_id"], len(brute.WORD.findall(r["text"]))
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in taken.items() if n}


def test_schedule_is_even(spark):
    data = [(0, "a", 900, 5, 500.0, 500), (1, "b", 900, 2, 200.0, 200), (2, "c", 900, 1, 100.0, 100)]
    sources = spark.createDataFrame(data, "sid int, source string, source_size long, weight int, target double, goal long")
    slots = [r["sid"] for r in mixing.schedule(sources, block=1).orderBy("slot").collect()]
    assert len(slots) == 800
    for start in range(0, 640, 64):
        part = slots[start : start + 64]
        assert abs(part.count(0) - 40) <= 4 and abs(part.count(1) - 16) <= 4


# Chat


def test_escape_round_trip():
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choices(["\\", "<", "|", "<|end|>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "\n", "a", "<s>", "part|>"], k=rng.randint(0, 8)))
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROL)


def test_parts_are_flattened(spark):
    parts = [
        ("text", "look <|end|>", None, None, None, None, None),
        ("image", None, "img://1", 57, 28, None, None),
        ("text", "<", None, None, None, None, None),
        ("text", "|", None, None, None, None, None),
        ("audio", None, "aud://2", None, None, 1.5, None),
        ("document", None, "doc://3", None, None, None, 2),
    ]
    turns = spark.createDataFrame(
        [(1, 0, "user", parts), (1, 1, "assistant", parts[:1]), (1, 2, "user", None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>"
    )
    formatted = chat.format_turns(turns)
    first, second, third = formatted.orderBy("turn").collect()
    role, read = chat.read_turn(first["formatted"])
    assert (role, read) == ("user", ["look <|end|>", "<|image:0|>", "<", "|", "<|audio:1|>", "<|document:2|>"])
    assert [(a["kind"], a["ref"], a["tokens"]) for a in first["attachments"]] == [("image", "img://1", 3), ("audio", "aud://2", 38), ("document", "doc://3", 1200)]
    assert first["expanded_tokens"] == 1241 and (first["loss_from"], first["loss_to"]) == (0, 0)
    assert chat.unescape(second["formatted"][second["loss_from"] : second["loss_to"]]) == "look <|end|>"
    assert chat.read_turn(third["formatted"]) == ("user", [""])


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b\\"), (1, 0, "user", None), (None, 0, None, "x"), (2, 0, "assistant", ""), (2, 0, "assistant", ""), (1, None, "system", "s")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("extra", F.lit(1))
    got = chat.read_conversations(chat.format_turns(turns.withColumn("parts", chat.text_parts(F.col("text"))))).collect()
    found = {r["conv_id"]: r for r in got}
    assert found[1]["turns_sha256"] == brute.sha("system\ns\nuser\n\nassistant\nb\\\n")
    assert (found[1]["n_turns"], found[1]["loss_chars"], found[1]["loss_sha256"]) == (3, 2, brute.sha("b\\"))
    assert found[2]["n_turns"] == 2 and found[None]["turns_sha256"] == brute.sha("\nx\n")
    none = turns.where("false").withColumn("parts", chat.text_parts(F.col("text")))
    assert chat.read_conversations(chat.format_turns(none)).count() == 0


# Secrets


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]{24,}") == ()
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == ((frozenset({"aki", "kia"}),),)
    assert secrets.trigram_query("ab(c|d)?e+xyz.foo") == ((frozenset({"xyz"}),), (frozenset({"foo"}),))
    both = secrets.trigram_query("(foo|bar)x")
    assert both == ((frozenset({"arx", "bar"}), frozenset({"foo", "oox"})),)


def test_secrets(docs, rows, empty):
    found = secrets.find_secrets(docs)
    base = [r.kind for r in secrets.BASE]
    got = found.select("doc_id", secrets.listed(F.filter("secrets", lambda s: s["kind"].isin(base))))
    same(got, [(d, brute.base_secrets(t)) for d, t, _ in rows])
    assert set(docs.columns) | {"secrets"} == set(found.columns)
    assert secrets.find_secrets(empty).count() == 0


def test_secrets_beyond_the_broadcast_bound(spark, docs, monkeypatch):
    """Candidates that do not fit a broadcast meet their texts by a shuffle of candidate texts; same result."""
    whole = sorted(map(str, secrets.find_secrets(docs).collect()))
    monkeypatch.setattr(secrets, "BROADCAST_BYTES", -1)
    moved = secrets.find_secrets(docs)
    assert "Union" in moved._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, moved.collect())) == whole


def test_many_secrets_in_one_text(spark):
    """Spans of more matches than a chunk holds, against the plain version."""
    texts = [" ".join(f"token=abc{i:05d}é" for i in range(n)) for n in (1, 127, 128, 129, 1000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.find_secrets(df, secrets.BASE).select("doc_id", secrets.listed(F.col("secrets")))
    assert {r[0]: r[1] for r in found.collect()} == {i: brute.base_secrets(t) for i, t in enumerate(texts)}


def test_more_secrets(spark):
    texts = [f"gh{'p'}_{'Zq' * 20}", "-----BEGIN RSA PRIVATE KEY-----", f"eyJ{'a' * 12}.{'b' * 12}.{'c' * 12} end", f"é sk_live_{'x' * 16}", "gh_ eyj sk_live_"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: r[1] for r in secrets.find_secrets(df).select("doc_id", secrets.listed(F.col("secrets"))).collect()}
    assert got == {0: "code_host:0:44", 1: "private_key:0:31", 2: "web_token:0:41", 3: "payment:2:26", 4: ""}


# Decontamination


def test_contamination(spark, docs, rows, empty):
    items = [(1, PASSAGE), (2, "kappa LAMBDA mu"), (2, PASSAGE + " nu"), (3, None), (4, " "), (10, "mu"), (None, "one two"), (5, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    columns = ["doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256), "contaminated"]
    same(decontam.contamination(docs, benchmark).select(*columns), brute.contamination([r[:2] for r in rows], items))
    assert decontam.contamination(empty, benchmark).count() == 0
    assert decontam.contamination(docs, benchmark.where("false")).where("contaminated").count() == 0


# Jaccard


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(i, i + 1) for i in range(1000, 1060)]
    group = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                group[a] = group[b] = min(group[a], group[b])
    same(components.components(spark.createDataFrame(edges, "a long, b long")), list(group.items()))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signature_tree():
    rng = np.random.default_rng(1)
    for _ in range(15):
        sets = []
        for _ in range(rng.integers(1, 7)):
            base = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 150))).astype(np.uint64))
            for _ in range(rng.integers(1, 20)):
                x = base.copy()
                k = rng.integers(0, len(base) // 5 + 1)
                x[rng.choice(len(base), k, replace=False)] = rng.integers(0, 2**63, k).astype(np.uint64)
                sets.append(np.unique(x))
        label = list(range(len(sets)))

        def joined(label, i, j):
            a, b = max(label[i], label[j]), min(label[i], label[j])
            return [b if x == a else x for x in label]

        got = list(label)
        for i, j in signature_tree.link(sets, 80):
            got = joined(got, i, j)
        for i in range(len(sets)):
            for j in range(i):
                n = len(np.intersect1d(sets[i], sets[j]))
                if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                    label = joined(label, i, j)
        assert got == label


@pytest.mark.parametrize("block", [3, 2048])
def test_near_duplicates(spark, docs, rows, empty, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    same(jaccard.near_duplicates(docs).select("doc_id", "n_shingles", "component_id"), brute.jaccard_components([r[:2] for r in rows]))
    assert jaccard.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [5, 2048])
def test_many_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rng = random.Random(7)
    rows = []
    for g in range(4):
        base = [f"{g}-{rng.randint(0, 40)}" for _ in range(rng.randint(20, 90))]
        for _ in range(40):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 9)}"
            rows.append((len(rows), " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same(jaccard.memberships(df).select("doc", "n_shingles", "component_id"), brute.jaccard_components(rows))
    one = jaccard.one_per_component(df)
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({r[2] for r in brute.jaccard_components(rows)})


# Quality


def test_quality(docs, rows, empty):
    ledger = quality.rule_ledger(docs)
    same(ledger.select("doc_id", *quality.MEASURES[:5]), [(d, *brute.quality(t)) for d, t, _ in rows])
    passed = quality.apply_policy(ledger, quality.CURRENT)
    assert passed.where("kept").count() == sum(1 for r in ledger.collect() if not r["failed_bits"] & quality.CURRENT.mask())
    assert quality.rule_ledger(empty).count() == 0


def test_ablation(docs):
    ledger = quality.rule_ledger(docs).cache()
    bits = [r["failed_bits"] & quality.CURRENT.mask() for r in ledger.collect()]
    expected = []
    for i, rule in enumerate(quality.RULES):
        failed = sum(1 for b in bits if b >> i & 1)
        if rule.name in quality.CURRENT.rules and failed:
            expected.append((rule.name, failed, sum(1 for b in bits if b == 1 << i)))
    same(quality.ablation(ledger, quality.CURRENT), expected)
    alone = {rule: n for rule, _, n in expected}
    names = {1 << i: rule.name for i, rule in enumerate(quality.RULES)}
    beside = quality.with_sole_rule(ledger.withColumn("n_alone", F.lit("clash")), quality.CURRENT).collect()
    for r in beside:
        sole = names.get(r["failed_bits"] & quality.CURRENT.mask())
        assert (r["sole_rule"], r["n_alone"]) == (sole, alone.get(sole))
    assert len(beside) == len(bits)


def test_stored_ledger_reads_no_texts(docs):
    ledger = quality.stored_ledger(docs)
    for frame in (quality.ablation(ledger, quality.BASE), quality.apply_policy(ledger, quality.BASE)):
        assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
    same(quality.ablation(ledger, quality.BASE), [tuple(r) for r in quality.ablation(quality.rule_ledger(docs), quality.BASE).collect()])
    release(ledger)


# Lines


@pytest.mark.parametrize("partitions", [1, 4, 9])
def test_line_dedup(spark, docs, rows, empty, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = [(100 + i, f"{'A line that everybody has got'}\nown {i}\n{LINE if i % 2 else ''}", None) for i in range(60)]
        wide = docs.unionByName(spark.createDataFrame([(*m, 0, "", "", "", "", "", "") for m in many], CLASH))
        kept = line_dedup.keep_lines(wide, line_dedup.keep_bitmaps(wide))
        got = kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256))
        same(got, brute.line_dedup([r[:2] for r in [*rows, *many]]))
        assert line_dedup.keep_lines(empty, line_dedup.keep_bitmaps(empty)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# Toxicity


def toxic_corpus(spark, n=900):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdeinorst", k=rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(20, 150))
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randint(2, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["grumpf", "Zwark"]) + rng.choice(["", "ig", "en", "!!"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_toxicity_learns(spark):
    docs, labels, truth = toxic_corpus(spark)
    got = toxicity.toxicity(docs.withColumn("score", F.lit("old")), labels).collect()
    held = [r for r in got if r["held_out"]]
    assert 100 < len(held) < 260
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    split = toxicity.toxicity(docs, labels, block_entries=40).collect()
    a, b = ({r["doc_id"]: r["score"] for r in x} for x in (got, split))
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_toxicity_of_odd_rows(spark, docs, rows, empty):
    _, labels, _ = toxic_corpus(spark, 200)
    got = toxicity.toxicity(docs, labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (3, 1)], "doc_id long, toxic int")))
    found = got.select("doc_id", "score", "predicted", "held_out").collect()
    assert len(found) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert toxicity.toxicity(empty, labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(docs, labels.where("false")).collect()} == {0.5}


def plain_evidence(counts, word):
    """A word's log-likelihood ratio, each letter's probability written out for both classes."""
    near, single = {}, {}
    for e in counts:
        near.setdefault(e[:-1][-toxicity.SHARED_CONTEXT :], {}).setdefault(e[-1], []).append(e)
        single[e[-1]] = single.get(e[-1], 0) + 1
    d, total = toxicity.DISCOUNT, sum(single.values()) + 0.5 * len(single)

    def probability(e, side):
        after = near.get(e[:-1][-toxicity.SHARED_CONTEXT :], {})
        kinds, n = len(after), sum(map(len, after.values()))
        p = (single.get(e[-1], 0) + 0.5) / total
        p = max(len(after.get(e[-1], ())) - d, 0) / n + d * kinds / n * p if n else p
        own = [c[side] for x, c in counts.items() if x[:-1] == e[:-1] and c[side]]
        return max(counts.get(e, (0, 0))[side] - d, 0) / sum(own) + d * len(own) / sum(own) * p if own else p

    return sum(math.log(probability(e, 0) / probability(e, 1)) for e in toxicity.entries_of(word))


def test_toxicity_scores_every_letter(spark):
    """Rare entries, contexts of one class, unseen letters and unseen contexts all count in full."""
    texts = [("grumpf zwarkig", True), ("grund und grube und grau", False), ("ok grumbel", True), ("okapi über", False)]
    counted = toxicity.letter_counts(spark.createDataFrame([(*t, 1) for t in texts], "text string, toxic boolean, fold int"))
    counts = {r["entry"]: (r["ct"], r["co"]) for r in counted.collect()}
    model = toxicity.model_entries(counted)
    words = ["grumpf", "grumpx", "zwarkig", "zwarkel", "grund", "grube", "xyz", "okapi", "über", "q"]
    expected = [plain_evidence(counts, w) for w in words]
    assert sum(abs(x) > 0.01 for x in expected) >= 8
    broadcast = toxicity.load_model(model)
    assert broadcast.shared is not None and toxicity.load_model(model, 10).shared is None
    assert np.allclose(toxicity.WordEvidence(*broadcast.shared.value).of(words), expected, atol=1e-9)
    docs = spark.createDataFrame([(w,) for w in words], "text string")
    for kept in (broadcast, toxicity.load_model(model, 10)):
        found = {r["text"]: r["__c"]["word1"] for r in toxicity.with_comparison(docs, kept).collect()}
        assert np.allclose([found[w] for w in words], expected, atol=1e-9)
