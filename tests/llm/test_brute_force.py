"""Operators without SQL against slow versions written from their definitions."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from closepass.llm import (
    chat,
    decontamination,
    languages,
    near_duplicates,
    packing,
    repeated_spans,
    secrets,
    token_files,
    tokens,
    toxicity,
)
from closepass.llm import words as W

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


# --- secrets: base spans ---


def plain_base(text):
    found = []
    for m in re.finditer(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 8:
            found.append((m.start(2), 0, m.start(2), m.end(2), m.start(), m.end()))
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        found += [(m.start(), kind, m.start(), m.end(), m.start(), m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return found


def test_base_spans_of_odd_texts(spark):
    rng = random.Random(11)
    parts = ["password", "Token", "API_KEY", "apikey", "=", ": ", '"', "'", "AKIA", "ABCDEF0123456789", "0123456789abcdef" * 2, "é", "中", "x" * 8, " ", "\n", "-._=", "secret"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(400)] + [None, "", "AKIA" * 3000]
    rows = {r.doc_id: r for r in secrets.scan(documents(spark, texts)).collect()}
    for k, text in enumerate(texts):
        base = plain_base(text or "")
        counts = [sum(f[1] == kind for f in base) for kind in range(3)]
        assert [rows[k].n_assign, rows[k].n_access, rows[k].n_hex] == counts, text
        named = ",".join(f"{('assign', 'access', 'hex')[kind]}:{a}:{b}" for a, kind, b in sorted((f[4], f[1], f[5]) for f in base))
        assert rows[k].base_sha256 == hashlib.sha256(named.encode()).hexdigest(), text


# --- languages: the chosen set ---


def test_mixtures_against_all_subsets():
    rng = np.random.default_rng(3)
    grid = [np.array(g) / 20 for g in itertools.product(range(21), repeat=3) if sum(g) == 20]
    for trial in range(25):
        own = rng.random(3) * (rng.random(3) < 0.6)
        if not own.any():
            own[0] = 1
        own /= own.sum()
        kind = rng.choice(3, size=60, p=own)
        p = rng.uniform(0.001, 0.05, (60, 3))
        p[np.arange(60), kind] = rng.uniform(0.5, 1, 60)
        n = rng.integers(1, 3, 60).astype(float)
        share = languages.mixture(p, n, np.array([0, 60]))[0]
        assert share.sum() == pytest.approx(1)

        def value(g):
            return (n * np.log(np.maximum(p @ g, 1e-300))).sum() / 2 - languages.PENALTY * np.count_nonzero(g)

        best = max(grid, key=value)
        # as good as the best of any set of languages, and the set is the same unless two sets are as good
        assert value(share) >= value(best) - 0.3
        if value(best) - max(value(g) for g in grid if ((g > 0) != (best > 0)).any()) > 0.5:
            assert ((share > 0) == (best > 0)).all() and np.abs(share - best).max() < 0.1


# --- near duplicates: classes ---


def plain_classes(texts):
    """The least id of each class, from all pairs by plain longest common subsequences of shingles."""
    cut = []
    for t in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        cut.append([tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else [])
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(cut)), 2):
        a, b = cut[i], cut[j]
        if a != b:
            if min(len(a), len(b)) < 0.8 * max(len(a), len(b)) or not a or not b:
                continue
            row = [0] * (len(b) + 1)
            for x in a:
                before = 0
                for k, y in enumerate(b):
                    row[k + 1], before = (before + 1 if x == y else max(row[k + 1], row[k])), row[k + 1]
            if row[-1] < 0.8 * (len(a) + len(b) - row[-1]) - 1e-9:
                continue
        lo, hi = sorted((top(i), top(j)))
        root[hi] = lo
    return [top(i) for i in range(len(texts))]


def test_classes_match_all_pairs(spark):
    rng = random.Random(8)
    texts = [None, "", "one", "ONE!", "a b c d e"]
    for _ in range(14):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice((6, 8, 12, 40, 90)))]
        for _ in range(rng.randrange(1, 9)):
            other = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 25))):
                k = rng.randrange(len(other))
                change = rng.randrange(3)
                other[k : k + 1] = [] if change == 0 else [f"n{rng.randrange(99)}"] if change == 1 else [other[k], "more"]
            texts.append(" ".join(other))
        halves = base[len(base) // 2 :] + base[: len(base) // 2]
        texts.append(" ".join(halves))
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(documents(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == plain_classes(texts)


# --- toxicity: the network ---


def test_forward_pass_is_that_of_plain_loops():
    network = toxicity.Network(4)
    rng = np.random.default_rng(4)
    network.embed = rng.normal(0, 1, network.embed.shape)
    texts = [rng.integers(0, len(network.embed), (n, 1 + len(toxicity.STEMS))) for n in (0, 1, 2, 7, 0, 30)]
    bounds = np.append(0, np.cumsum([len(t) for t in texts]))
    cells = np.concatenate(texts)
    vectors = network.embed[cells].sum(axis=1)
    rows = [(vectors @ f[m]).astype(np.float32) for f in network.filters for m in range(len(f))]
    got = network.pooled(rows, bounds)
    for k, text in enumerate(texts):
        want = []
        for width, filters in zip(toxicity.LENGTHS, network.filters):
            for j in range(toxicity.FILTERS):
                best = 0.0
                for i in range(len(text)):
                    parts = [network.embed[text[i + m]].sum(axis=0) @ filters[m, :, j] for m in range(width) if i + m < len(text)]
                    best = max(best, sum(parts) + network.shift[toxicity.LENGTHS.index(width) * toxicity.FILTERS + j])
                want.append(best)
        assert got[k] == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_training_rows_are_drawn_once_and_whole(spark, monkeypatch):
    texts = [f"text {k} {'nasty' if k % 3 == 0 else 'kind'}" for k in range(300)] + ["twice", "twice"]
    docs = documents(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))
    docs = docs.unionByName(docs.where("doc_id = 300"))  # a repeated row
    labels = spark.range(301).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("toxic"), F.lit(1).alias("quality"))
    labels = labels.unionByName(labels.where("doc_id = 300")).unionByName(labels.where("doc_id = 1").withColumn("toxic", F.lit(None)))
    want = docs.join(labels, "doc_id").where("toxic in (0, 1)").select("doc_id", "text", "lang", "toxic")
    got = toxicity.labelled(docs, labels)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 304
    monkeypatch.setattr(toxicity, "LANGUAGE_ROWS", 5)
    assert 20 < toxicity.labelled(docs, labels, 20).count() < 200
    empty = toxicity.fit(toxicity.labelled(docs.limit(0), labels))
    assert toxicity.scored(docs.limit(0), empty).collect() == []


# --- chat: long conversations, odd rows ---


def test_long_and_odd_conversations(spark):
    turns = [(1, k, "user" if k % 3 < 2 else "assistant", f"t{k}<|end|>\\") for k in range(5000)]
    odd = [(None, None, None, None), (2, 0, "assistant", ""), (2, 0, "assistant", ""), (3, 1, "user", "x" * 1_000_000)]
    rows = spark.createDataFrame(turns + odd, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.formatted(rows).select("*", chat.read_back(F.col("formatted")).alias("turns")).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [t[2:] for t in turns]
    shown = [got[1].formatted[s.start : s.end].replace("<\\|", "<|").replace("\\\\", "\\") for s in got[1].loss]
    assert shown == [t[3] for t in turns if t[2] == "assistant"]
    assert [(t.role, t.text) for t in got[None].turns] == [("", "")] and got[None].loss == []
    assert [(s.start, s.end) for s in got[2].loss] == [(25, 25), (33, 33)] and len(got[3].turns[0].text) == 1_000_000
    assert chat.formatted(rows.limit(0)).collect() == []


# --- empty tables ---


def test_empty_tables(spark):
    none = documents(spark, ["x"]).limit(0)
    items = spark.createDataFrame([(1, "some benchmark words")], "item_id long, text string")
    model = languages.fit(none)
    for got in (
        secrets.scan(none),
        secrets.without_secrets(none),
        languages.identify(none, model),
        near_duplicates.near_duplicates(none),
        repeated_spans.without_repeats(none),
        decontamination.contamination(none, items),
        decontamination.contamination(none, items.limit(0)),
        toxicity.scored(none, toxicity.Classifier(None)),
        token_files.read_token_files(token_files.write_token_files(none, tokens.default_path(), 2)),
        packing.packed(none, tokens.default_path()),
    ):
        assert got.collect() == []
    assert [r.n_hit for r in decontamination.contamination(documents(spark, ["a b c"]), items.limit(0)).collect()] == [0]


# --- the pipeline: names that clash ---


def test_stages_take_any_other_columns(spark, monkeypatch, tmp_path):
    texts = [" ".join(f"w{i}" for i in range(40))] * 2 + ["quite another text of words", None]
    names = ("_id", "_kept", "_found", "found", "class_id", "text_id", "_doc_id", "_text")
    docs = documents(spark, texts).withColumns({n: F.col("doc_id") * 10 for n in names})
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    assert all(r[n] == r.doc_id * 10 for r in kept.collect() for n in names)
    spark.createDataFrame([(1, "another text of words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [0, 1, 3]
    masked = corpus_pipeline.mask_secrets(spark, docs, "")
    assert masked.columns == docs.columns and masked.count() == 4


def test_shingles_of_blocks_are_those_of_texts():
    data = "one two three four five six".encode()
    w = W.words_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    at, _ = W.shingles(w, 5)
    assert at.tolist() == [0, 1]
