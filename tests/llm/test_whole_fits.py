"""Fits learn from every row that they may learn from, and go over a block's bytes once."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from closepass.llm import languages, toxicity
from closepass.llm import words as W


def marked(spark, n, words=6):
    """Rows of random words, every third of them with a telling one."""
    random = np.random.default_rng(3)
    texts = [" ".join([f"w{k}" for k in random.integers(0, 300, words)] + ["nasty"] * (i % 3 == 0)) for i in range(n)]
    rows = [(i, t, "en", int(i % 3 == 0)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")


def test_all_labelled_rows_are_learned_from(spark, monkeypatch):
    rows = marked(spark, 6000)
    kept = toxicity.labelled(rows.drop("toxic"), rows.select("doc_id", "toxic"))
    assert kept.count() == 6000
    seen = {}
    network, calibrate = toxicity._network, toxicity._calibrate
    monkeypatch.setattr(toxicity, "_network", lambda r, *x: seen.update(learned=r.count()) or network(r.limit(50), *x))
    monkeypatch.setattr(toxicity, "_calibrate", lambda c, r: seen.update(kept=r.count()) or calibrate(c, r))
    toxicity.fit(kept)
    assert seen["learned"] + seen["kept"] == 6000 and abs(seen["kept"] - 1500) < 150


def test_learning_in_parts_does_not_depend_on_the_dealing(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PART_ROWS", 150)
    rows = marked(spark, 900)
    one, other = toxicity.fit(rows.repartition(1)), toxicity.fit(rows.orderBy("text").repartition(5))
    assert one.threshold == other.threshold and (one.table == other.table).all()
    got = toxicity.scored(rows, one).join(rows, "doc_id").where("predicted = toxic").count()
    assert got > 880


def test_thresholds_count_all_rows():
    low = np.array([-1.0, 0.0, 2.0])
    zeros, ones = np.array([5, 1, 1]), np.array([1, 0, 9])
    assert toxicity.best_threshold(low, low + 0.5, zeros, ones) == 1.25


def test_languages_count_all_rows(spark):
    rows = spark.range(4000).select(F.lit("ab cd").alias("text"), F.lit("xx").alias("lang"))
    assert languages.fit(rows).words.tolist() == [8000]
    many = spark.range(120).select(F.lit("ab").alias("text"), F.format_string("l%03d", "id").alias("lang"))
    assert len(languages.fit(many).languages) == 120


# --- the cost of a block ---


def test_bytes_of_a_block_are_summed_once_for_all_hashes(monkeypatch):
    words = ["Ab", "déjà", "wording", "words", "a", "ab"]
    text = " ".join(words * 20)
    column = pa.array([text, None, "", "wording"])
    (_, bounds, data), = W.blocks(column)
    classifier, summed = toxicity.Classifier(toxicity.Network()), []
    cumsum = np.cumsum
    monkeypatch.setattr(np, "cumsum", lambda x, *a, **k: summed.append(len(x) == len(data)) or cumsum(x, *a, **k))
    logit, _ = classifier.scorer()(data, bounds)
    assert summed.count(True) == 1 and logit[1] == logit[2]
    summed.clear()

    class Start:
        value = toxicity.Network().parameters()

    rows = {"part": pa.array([0] * 4), "text": column, "toxic": pa.array([1, 0, 1, 0], pa.int32())}
    list(toxicity._learned(Start, 1, 0, (1.0, 1.0))([pa.RecordBatch.from_pydict(rows)]))
    assert summed.count(True) == 1


def test_words_of_a_block_are_hashed_as_spans_of_it():
    random = np.random.default_rng(5)
    letters = list("abcdeé -")
    texts = ["".join(letters[k] for k in random.integers(0, len(letters), n)) for n in (0, 300, 1, 5, 900)]
    (_, bounds, data), = W.blocks(pa.array(texts))
    w, values = W.words_of(data, bounds), W.BYTE_VALUES[data]
    assert (w.hash == W.span_hashes(values, w.start, w.end)).all()
    at = np.arange(len(w.hash))[::3]
    for size, got in zip((1, 4, 6), W.beginnings(w, at, (1, 4, 6))):
        assert (got == W.span_hashes(values, w.start[at], np.minimum(w.end[at], w.start[at] + size))).all()
    values, place, which = W.distinct(w.hash)
    assert (values == np.unique(w.hash)).all() and (w.hash[place] == values).all() and (values[which] == w.hash).all()
    assert [len(x) for x in W.distinct(w.hash[:0])] == [0, 0, 0]


def test_responses_leave_other_texts_alone():
    network, random = toxicity.Network(), np.random.default_rng(6)
    bounds = np.append(0, np.cumsum([0, 1, 2, 0, 3, 40, 1, 0]))
    n = bounds[-1]
    rows = [random.normal(0, 1, (n, toxicity.FILTERS)).astype(np.float32) for _ in range(sum(toxicity.LENGTHS))]
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
    want, j = [], 0
    for k in toxicity.LENGTHS:
        own = rows[j].copy()
        for m in range(1, k):
            own[: n - m] += rows[j + m][m:] * (left[: n - m] > m)[:, None]
        want.append(own)
        j += k
    want = np.concatenate(want, axis=1) + network.shift.astype(np.float32)
    assert (network.responses(rows, bounds) == want.T).all()
    for cut in (0, 1, 2):
        assert network.pooled([r[:cut] for r in rows], np.array([0, 0, cut])).shape == (2, want.shape[1])
