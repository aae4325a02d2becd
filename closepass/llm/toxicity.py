"""Toxicity scores by a convolutional text classifier in numpy.

A word's embedding is the sum of hashed cells for the word and for its beginnings of 4 to 6 bytes, so
inflected forms share most of it.  Filters over one to
three words are max-pooled over the whole text and weighed into one logit.

The network learns from three in four of all labelled rows, the thresholds from all the others; no row is left out.
Rows are dealt by a hash into parts of about `PART_ROWS`.  In each of `ROUNDS` rounds every part starts from the
network so far and goes over its rows with Adam, in a task of its own; then each parameter moves by the mean
over the parts that moved it.  Rows of the rarer label weigh more, so both labels weigh the same in all.
A threshold is that with the fewest errors on the rows kept for it, which are counted by language and cell of the
logit (`GRID` cells a unit).  A language with fewer than `LEAST_FOR_LANGUAGE` such rows of a label takes the
threshold of all.  A score is the logistic of the logit less the threshold of the language that the text itself is
most likely in, so 0.5 is the threshold everywhere.

Scoring adds up one precomputed table row for each word and filter place, so its memory does not depend on the
corpus, and every text is scored whole.

Defined cases: null and empty texts, and texts without words, get the score of a document without any
filter response; without labels of both kinds every score is 0; equal texts get equal scores; a document
with several label rows is learned from once for each; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closepass.llm import languages as L
from closepass.llm import words as W
from closepass.llm.samples import chosen
from closepass.llm.store import give_back, mapped, stored

PART_ROWS = 8192  # rows that one task learns from at a time
PART_CHARS = 1 << 23  # or fewer, of long texts
ROUNDS = 3  # of learning in parts; a single part needs one
APART = 4  # one in so many rows is kept for the thresholds
EXACT = 1 << 20  # moves are added up as integers of this fraction, so their order does not matter
GRID = 256  # cells of a logit's unit
FARTHEST = 128  # logits beyond share a cell
CELLS = 1 << 15  # of each kind of hashed cell
STEMS = (4, 5, 6)  # bytes
WIDTH = 8  # of an embedding
FILTERS = 8  # of each length
LENGTHS = (1, 2, 3)
EPOCHS = 8
DROPPED = 0.3  # share of the words left out of a fitting step
BATCH = 32
LEAST_STEPS = 800  # few rows are gone over more often
RATE = 0.01
LANGUAGE_ROWS = 200  # of each language and label, if a number of rows is asked for
LEAST_FOR_LANGUAGE = 30  # documents of each label to give a language a threshold of its own


def _cells(w: W.Words, at: np.ndarray) -> np.ndarray:
    """The cells of the words `at`: of the word and of its beginnings, each kind in a table of its own."""
    out = np.empty((len(at), 1 + len(STEMS)), dtype=np.int32)
    for k, h in enumerate([w.hash[at], *W.beginnings(w, at, STEMS)]):
        out[:, k] = h & np.uint64(CELLS - 1)
        out[:, k] += k * CELLS
    return out


def _looked_up(table: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The sum of the table rows of the cells of each word."""
    total = table.take(cells[:, 0], axis=0)
    for k in range(1, cells.shape[1]):
        total += table.take(cells[:, k], axis=0)
    return total


class Network:
    def __init__(self, seed: int = 1):
        random = np.random.default_rng(seed)
        total = FILTERS * len(LENGTHS)
        self.embed = random.normal(0, 0.01, ((1 + len(STEMS)) * CELLS, WIDTH))
        self.filters = [random.normal(0, 0.5, (k, WIDTH, FILTERS)) for k in LENGTHS]
        self.shift = np.zeros(total)
        self.weights = random.normal(0, 0.3, total)
        self.bias = np.zeros(1)

    def parameters(self) -> np.ndarray:
        """All parameters in rows of WIDTH, those of the embeddings first."""
        rest = np.concatenate([*(f.ravel() for f in self.filters), self.shift, self.weights, self.bias])
        return np.concatenate([self.embed, np.append(rest, np.zeros(-len(rest) % WIDTH)).reshape(-1, WIDTH)])

    def take(self, parameters: np.ndarray):
        """Sets all parameters, given as `parameters` gives them."""
        self.embed = parameters[: len(self.embed)].copy()
        rest = parameters[len(self.embed) :].ravel()
        at = 0
        for values in (*self.filters, self.shift, self.weights, self.bias):
            values[...] = rest[at : at + values.size].reshape(values.shape)
            at += values.size

    def responses(self, rows: list[np.ndarray], bounds: np.ndarray) -> np.ndarray:
        """(filters, words); rows[j]: (words, filters) parts; a filter of length k at word i adds part m of word i + m."""
        n = bounds[-1]
        left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)  # words up to the end of the text
        out, j = np.empty((self.shift.size, n), dtype=np.float32), 0
        for c, k in enumerate(LENGTHS):
            own = out[c * FILTERS : (c + 1) * FILTERS]
            own[...] = rows[j].T
            for m in range(1, k):
                edge = np.flatnonzero(left[: n - m] <= m)  # the word m places on is of another text
                held = own[:, edge]
                own[:, : n - m] += rows[j + m].T[:, m:]
                own[:, edge] = held
            j += k
        out += self.shift.astype(np.float32)[:, None]
        return out

    def pooled(self, rows: list[np.ndarray], bounds: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each text, 0 if none is above; also for empty texts."""
        out = np.zeros((len(bounds) - 1, self.shift.size))
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            out[full] = np.maximum(np.maximum.reduceat(self.responses(rows, bounds), bounds[:-1][full], axis=1), 0).T
        return out

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed=2, weigh=(1.0, 1.0)):
        """texts: cells of the words of each document; weigh: of a row of label 0 and of label 1."""
        random = np.random.default_rng(seed)
        weight = np.asarray(weigh)[labels.astype(np.int64)]
        names = ["shift", "weights", "bias"]
        moments = {k: (np.zeros_like(getattr(self, k)), np.zeros_like(getattr(self, k))) for k in names}
        moments["embed"] = (np.zeros_like(self.embed), np.zeros_like(self.embed))
        for c, f in enumerate(self.filters):
            moments[c] = (np.zeros_like(f), np.zeros_like(f))
        step = 0

        def adam(value, slope, moment, at=slice(None)):
            first, second = moment
            first[at] = 0.9 * first[at] + 0.1 * slope
            second[at] = 0.99 * second[at] + 0.01 * slope**2
            value[at] -= RATE * (first[at] / (1 - 0.9**step)) / (np.sqrt(second[at] / (1 - 0.99**step)) + 1e-8)

        for _ in range(epochs):
            order = random.permutation(len(texts))
            for i in range(0, len(order), BATCH):
                step += 1
                chosen = [k for k in order[i : i + BATCH] if len(texts[k])]
                if not chosen:
                    continue
                parts = [texts[k][random.random(len(texts[k])) >= DROPPED] for k in chosen]
                parts = [p if len(p) else texts[k] for p, k in zip(parts, chosen)]
                bounds = np.append(0, np.cumsum([len(p) for p in parts]))
                cells = np.concatenate(parts)
                vectors = _looked_up(self.embed, cells)
                rows = [(f[m].T @ vectors.T).astype(np.float32).T for f in self.filters for m in range(len(f))]
                response = self.responses(rows, bounds)
                # the first place of the largest response: of each document and filter
                place = np.stack([i + response[:, i:j].argmax(axis=1) for i, j in zip(bounds[:-1], bounds[1:])])
                best = np.take_along_axis(response.T, place, axis=0)
                pooled = np.maximum(best, 0).astype(np.float64)
                error = 1 / (1 + np.exp(-(pooled @ self.weights + self.bias))) - labels[chosen]
                error *= weight[chosen] / len(chosen)
                back = error[:, None] * self.weights * (best > 0)
                slope = np.zeros_like(vectors)
                d_filters = [np.zeros_like(f) for f in self.filters]
                for c, f in enumerate(self.filters):
                    own = slice(c * FILTERS, (c + 1) * FILTERS)
                    for m in range(len(f)):
                        p = place[:, own] + m
                        g = np.where(p < bounds[1:, None], back[:, own], 0.0)
                        p = np.minimum(p, len(vectors) - 1)
                        d_filters[c][m] = np.einsum("dj,djw->wj", g, vectors[p])
                        np.add.at(slope, p.ravel(), (g[:, :, None] * f[m].T).reshape(-1, WIDTH))
                moved = np.flatnonzero(slope.any(axis=1))
                touched, which = np.unique(cells[moved].ravel(), return_inverse=True)
                d_embed = np.zeros((len(touched), WIDTH))
                np.add.at(d_embed, which.ravel(), np.repeat(slope[moved], cells.shape[1], axis=0))
                adam(self.embed, d_embed, moments["embed"], touched)
                for c, f in enumerate(self.filters):
                    adam(f, d_filters[c], moments[c])
                adam(self.shift, back.sum(axis=0), moments["shift"])
                adam(self.weights, error @ pooled + 1e-4 * self.weights, moments["weights"])
                adam(self.bias, np.array([error.sum()]), moments["bias"])

    def tables(self) -> list[np.ndarray]:
        """For each filter place: the response part of each cell."""
        return [(self.embed @ f[m]).astype(np.float32) for f in self.filters for m in range(len(f))]


class Classifier:
    """A fitted network with its thresholds."""

    def __init__(self, network: Network | None, languages: L.Model | None = None):
        self.network, self.languages = network, languages
        self.thresholds = np.zeros(len(languages.languages) if languages else 0)
        self.calibrated = np.zeros(len(self.thresholds), dtype=bool)  # languages with a threshold of their own
        self.threshold = 0.0
        if network is not None:
            self.table = np.concatenate(network.tables(), axis=1)
            network.embed = None  # the table holds what scoring needs

    def scorer(self):
        """A function of (bytes, bounds) that gives (logit, language index or -1) of each text of a block."""
        words = L.WordTable(self.languages) if self.languages and self.languages.languages else None

        def run(data, bounds):
            w = W.words_of(data, bounds)
            n = len(bounds) - 1
            distinct, first, which = W.distinct(w.hash)
            parts = np.ascontiguousarray(_looked_up(self.table, _cells(w, first)).T).take(which, axis=1)
            rows = [parts[j : j + FILTERS].T for j in range(0, len(parts), FILTERS)]
            pooled = self.network.pooled(rows, w.bounds)
            language = np.full(n, -1)
            full = np.flatnonzero(np.diff(w.bounds))
            if words and len(full):
                log_p, _ = words.look_up(distinct, lambda k: L._spelt(data, w, first[k]))
                language[full] = np.add.reduceat(log_p.take(which, axis=0), w.bounds[:-1][full], axis=0).argmax(axis=1)
            return pooled @ self.network.weights + self.network.bias, language

        return run

    def score(self, logit: np.ndarray, language: np.ndarray) -> np.ndarray:
        own = np.append(self.thresholds, self.threshold)[language]
        return 1 / (1 + np.exp(-np.clip(logit - own, -30, 30)))


def best_threshold(low: np.ndarray, high: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> float:
    """The middle of the widest gap among the thresholds with the fewest errors.

    low, high: the bounds of ascending cells of the logit; zeros, ones: the rows of each label in them.
    """
    errors = np.append(0, np.cumsum(ones)) + np.append(np.cumsum(zeros[::-1])[::-1], 0)
    begins, ends = np.append(low[0] - 2, high), np.append(low, high[-1] + 2)
    ties = np.flatnonzero(errors == errors.min())
    k = ties[np.argmax((ends - begins)[ties])]
    return float(begins[k] + ends[k]) / 2


def _learned(shared, epochs: int, turn: int, weigh):
    """How far each part moves each row of parameters, by its rows (part, draw, text, toxic), which lie together."""

    def learn(part: int, texts: list[np.ndarray], labels: list[np.ndarray]) -> pa.RecordBatch:
        network, before = Network(), shared.value
        network.take(before)
        network.fit(texts, np.concatenate(labels), epochs, [turn, part], weigh)
        moved = network.parameters() - before
        at = np.flatnonzero(moved.any(axis=1))
        moved = np.rint(moved[at] * EXACT).astype(np.int64)
        names = ["cell", *(f"m{k}" for k in range(WIDTH))]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (at, *moved.T)], names)

    def run(batches):
        part, texts, labels = None, [], []
        for batch in batches:
            parts, toxic = batch.column("part").to_numpy(), batch.column("toxic").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
            for i, j in zip(edges[:-1], edges[1:]):
                if i == j:
                    continue
                if texts and parts[i] != part:
                    yield learn(part, texts, labels)
                    texts, labels = [], []
                part = int(parts[i])
                labels.append(toxic[i:j])
                for _, bounds, data in W.blocks(batch.column("text").slice(i, j - i)):
                    w = W.words_of(data, bounds)
                    cells = _cells(w, np.arange(len(w.hash)))
                    texts += [cells[a:b] for a, b in zip(w.bounds[:-1], w.bounds[1:])]
        if texts:
            yield learn(part, texts, labels)

    return run


def _network(rows: DataFrame, counts: dict[int, int], chars: int) -> Network:
    """The network learned from all `rows` (doc_id, text, toxic); counts: rows of each label."""
    network, n = Network(), sum(counts.values())
    if not n:
        return network
    parts = max(1, -(-n // PART_ROWS), -(-chars // PART_CHARS))
    turns = ROUNDS if parts > 1 else 1
    # about LEAST_STEPS steps of each part in all
    epochs = max(1, round(LEAST_STEPS * BATCH * parts / (turns * n))) if parts > 1 else max(EPOCHS, -(-LEAST_STEPS * BATCH // n))
    weigh = tuple(n / (2 * max(counts[label], 1)) for label in (0, 1))
    draw = F.xxhash64("doc_id", "text")
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id", "text"), F.lit(parts))
    # written in order of parts, so each lies whole in a file and texts move once for all rounds
    dealt = stored(
        rows.select(part.alias("part"), draw.alias("draw"), "text", "toxic")
        .repartition(parts, "part")
        .sortWithinPartitions("part", "draw", "toxic")
    )
    for turn in range(turns):
        before = network.parameters()
        shared = rows.sparkSession.sparkContext.broadcast(before)  # of fixed size
        moves = (
            dealt.transform(
                mapped, _learned(shared, epochs, turn, weigh), "cell long, " + ", ".join(f"m{k} long" for k in range(WIDTH))
            )
            .groupBy("cell")
            .agg(F.count("*").alias("n"), *(F.sum(f"m{k}").alias(f"m{k}") for k in range(WIDTH)))
            .toArrow()  # at most a row for each row of parameters
        )
        total = np.stack([moves[f"m{k}"].to_numpy() for k in range(WIDTH)], axis=1)
        before[moves["cell"].to_numpy()] += total / EXACT / moves["n"].to_numpy()[:, None]
        network.take(before)
        shared.destroy()
    return network


def _logits(classifier):
    """Language index and cell of the logit of each text."""

    def run(batches):
        score = classifier.value.scorer()
        for batch in batches:
            for row, bounds, data in W.blocks(batch.column("text")):
                logit, language = score(data, bounds)
                cell = np.floor(np.clip(logit, -FARTHEST, FARTHEST) * GRID).astype(np.int64)
                toxic = batch.column("toxic").slice(row, len(cell))
                yield pa.RecordBatch.from_arrays([pa.array(language), pa.array(cell), toxic], ["language", "cell", "toxic"])

    return run


def _calibrate(classifier: Classifier, rows: DataFrame):
    """Sets the thresholds by all `rows` (text, toxic), of each language and of all."""
    shared = rows.sparkSession.sparkContext.broadcast(classifier)
    cells = (
        rows.select("text", "toxic")
        .transform(mapped, _logits(shared), "language long, cell long, toxic int")
        .groupBy("language", "cell")
        .agg(F.sum(1 - F.col("toxic")).alias("zeros"), F.sum("toxic").alias("ones"))
        .orderBy("cell")
        .toArrow()  # at most a row for each language and cell
    )
    language, cell, zeros, ones = (cells[c].to_numpy() for c in ("language", "cell", "zeros", "ones"))
    if len(cell):
        distinct, which = np.unique(cell, return_inverse=True)
        all_zeros, all_ones = (np.bincount(which, weights=x) for x in (zeros, ones))
        classifier.threshold = best_threshold(distinct / GRID, (distinct + 1) / GRID, all_zeros, all_ones)
    for k in range(len(classifier.thresholds)):
        own = language == k
        low = cell[own] / GRID
        enough = min(zeros[own].sum(), ones[own].sum()) >= LEAST_FOR_LANGUAGE
        found = best_threshold(low, low + 1 / GRID, zeros[own], ones[own]) if enough else classifier.threshold
        classifier.thresholds[k], classifier.calibrated[k] = found, enough
    shared.destroy()


def fit(rows: DataFrame, fit_rows: int | None = None) -> Classifier:
    """`rows`: doc_id, text, lang, toxic to learn from, all of them.

    With `fit_rows` the network learns from about so many rows of each label, the thresholds from all others.
    """
    labelled = rows.where("toxic in (0, 1)").withColumn("toxic", F.col("toxic").cast("int"))
    learns = F.pmod(F.xxhash64(F.lit("apart"), "doc_id", "text"), F.lit(APART)) != 0
    if fit_rows is not None:
        learns = learns & chosen(labelled, "toxic", fit_rows, "doc_id", "text")
    counts = {
        r["toxic"]: r
        for r in labelled.groupBy("toxic")
        .agg(
            F.count_if(learns).alias("n"),
            F.coalesce(F.sum(F.when(learns, F.length("text"))), F.lit(0)).alias("chars"),
        )
        .collect()
    }
    if len(counts) < 2:
        return Classifier(None)
    network = _network(
        labelled.where(learns).select("doc_id", "text", "toxic"),
        {label: counts[label]["n"] for label in (0, 1)},
        sum(r["chars"] for r in counts.values()),
    )
    classifier = Classifier(network, L.fit(rows.select("doc_id", "text", "lang")))
    _calibrate(classifier, labelled.where(~learns))
    give_back()
    return classifier


def _scores(classifier: Classifier, column: pa.Array, score=None) -> np.ndarray:
    if classifier.network is None:
        return np.zeros(len(column))
    parts = [classifier.score(*score(data, bounds)) for _, bounds, data in W.blocks(column)]
    return np.concatenate(parts) if parts else np.zeros(0)


def scored(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """Per document: doc_id, score, predicted."""
    shared = documents.sparkSession.sparkContext.broadcast(classifier)  # of fixed size

    def run(batches):
        own = shared.value
        score = own.scorer() if own.network is not None else None
        for batch in batches:
            s = _scores(own, batch.column("text"), score)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return documents.select("doc_id", "text").transform(mapped, run, "doc_id long, score double, predicted int")


def without_toxic(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """The documents with a score below 0.5, all columns as they are."""
    shared = documents.sparkSession.sparkContext.broadcast(classifier)

    def run(batches):
        own = shared.value
        score = own.scorer() if own.network is not None else None
        for batch in batches:
            yield batch.filter(pa.array(_scores(own, batch.column("text"), score) < 0.5))

    return documents.transform(mapped, run, documents.schema)


def labelled(documents: DataFrame, labels: DataFrame, fit_rows: int | None = None) -> DataFrame:
    """The rows to fit from: doc_id, text, lang, toxic of all labelled documents, stored.

    With `fit_rows` they are about `fit_rows` of each label, twice `LANGUAGE_ROWS` of each language and label, and
    `fit_rows` of each language.
    """
    marks = labels.select("doc_id", "toxic").where("toxic in (0, 1)")
    # merged at any size, so a small run moves texts as a large one does
    rows = stored(documents.select("doc_id", "text", "lang").join(marks.hint("merge"), "doc_id"))
    if fit_rows is None:
        return rows
    rows = rows.withColumn("pair", F.concat_ws(" ", F.col("toxic").cast("string"), "lang"))
    taken = F.lit(False)
    for label, most in (("toxic", fit_rows), ("pair", 2 * LANGUAGE_ROWS), ("lang", fit_rows)):
        # not the hash that `fit` draws by
        taken = taken | F.coalesce(chosen(rows, label, most, F.lit("draw"), "doc_id", "text"), F.lit(False))
    return rows.where(taken).drop("pair")


def training_rows(spark, sf_dir: str) -> DataFrame:
    """All labelled documents outside the held-out fold."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0
    return labelled(documents.where(rest), labels.where(rest))


def op10_convolutional_toxicity(spark, sf_dir: str) -> DataFrame:
    classifier = fit(training_rows(spark, sf_dir))
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    return scored(documents, classifier).select("doc_id", held_out.alias("held_out"), "score", "predicted")
