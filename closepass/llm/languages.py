"""Language proportions of documents by expectation-maximisation over a mixture of n-gram models.

Each language has an interpolated character trigram model.  A document is a mixture: each of its words
comes from one language, with the likelihood of its trigrams.  Expectation-maximisation estimates the
proportions.  The language set is chosen by penalised likelihood: from all languages, the least is
dropped as long as half the log-likelihood lost is below the penalty for a language.

The models count the n-grams of all rows that may be learned from, of every language in them; n-grams are hashed
into `BINS` cells, so the size of a language's model is fixed.

Defined cases: null text, and text without a letter, is `und` with score 0; without any labelled document
everything is `und`; repeated rows each get a row; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closepass.llm import words as W
from closepass.llm.store import mapped

BINS = 1 << 15
PENALTY = 3.0
ROUNDS = 12
KEPT_WORDS = 300_000
PRIOR = 0.5


def _grams(words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(word of each place, cells of its trigram, bigram and character) of all words, end to end."""
    words = [w.lower() for w in words]
    sizes = np.array([len(w) + 3 for w in words])
    code = np.frombuffer("".join(f"\x02\x02{w}\x03" for w in words).encode("utf-32-le"), dtype=np.uint32)
    code = code.astype(np.uint64)
    ends = np.cumsum(sizes)
    place = W.ragged(ends - sizes + 2, sizes - 2)
    two = code[place - 1] * np.uint64(0x1000003) + code[place] + np.uint64(1 << 40)
    three = two + code[place - 2] * np.uint64(0x9E3779B1) + np.uint64(1 << 41)
    cells = [(W.mixed(x) % np.uint64(BINS)).astype(np.int64) for x in (three, two, code[place])]
    return np.repeat(np.arange(len(words)), sizes - 2), cells


def _spelt(data: np.ndarray, w: W.Words, at: np.ndarray) -> list[str]:
    text = data.tobytes()
    return [text[s:e].decode() for s, e in zip(w.start[at].tolist(), w.end[at].tolist())]


def _count(languages: list[str]):
    at = {name: i for i, name in enumerate(languages)}

    def run(batches):
        total = np.zeros((3, len(languages), BINS))
        for batch in batches:
            langs = np.array([at[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for row, bounds, data in W.blocks(batch.column("text")):
                w = W.words_of(data, bounds)
                _, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
                if not len(first):
                    continue
                present, own = np.unique(langs[row : row + len(bounds) - 1], return_inverse=True)
                times = np.zeros((len(present), len(first)))
                np.add.at(times, (own[w.row], which), 1)
                word, cells = _grams(_spelt(data, w, first))
                for level in range(3):
                    for k, counts in zip(present, times):
                        total[level, k] += np.bincount(cells[level], weights=counts[word], minlength=BINS)
        level, lang, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [level, lang, cell, total[level, lang, cell].astype(np.int64)], ["level", "lang", "cell", "n"]
        )

    return run


class Model:
    """Smoothed counts: log P(character | two before), for each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.counts = counts.astype(np.float64)
        self.total = self.counts[2].sum(axis=1)
        end = (W.mixed(np.array([3], dtype=np.uint64)) % np.uint64(BINS)).astype(np.int64)
        self.words = self.counts[2][:, end[0]]  # each word ends once

    def log_likelihoods(self, words: list[str]) -> np.ndarray:
        """Of each word, for each language."""
        word, (three, two, one) = _grams(words)
        begins = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        out = np.empty((len(words), len(self.languages)))
        for k in range(len(self.languages)):
            c3, c2, c1 = self.counts[0, k][three], self.counts[1, k][two], self.counts[2, k][one]
            # the count of a context is that of the shorter n-gram that ends one character earlier
            before2, before1 = np.append(0, c2[:-1]), np.append(0, c1[:-1])
            before2[begins] = before1[begins] = self.words[k]
            p1 = (c1 + PRIOR) / (self.total[k] + PRIOR * 256)
            p2 = (c2 + 2 * p1) / (np.maximum(before1, c2) + 2)
            p3 = (c3 + 2 * p2) / (np.maximum(before2, c3) + 2)
            out[:, k] = np.add.reduceat(np.log(p3), begins)
        return out


def fit(rows: DataFrame) -> Model:
    """`rows`: text, lang to learn from, all of them."""
    rows = rows.where("lang is not null and text is not null")
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    counts = np.zeros((3, len(languages), BINS), dtype=np.int64)
    cells = (
        rows.select("lang", "text")
        .transform(mapped, _count(languages), "level long, lang long, cell long, n long")
        .groupBy("level", "lang", "cell")
        .agg(F.sum("n").alias("n"))
    )
    found = cells.toArrow()  # at most 3 x languages x BINS rows
    level, lang, cell, n = (found[c].to_numpy() for c in ("level", "lang", "cell", "n"))
    counts[level, lang, cell] = n
    return Model(languages, counts)


def _maximise(p: np.ndarray, n: np.ndarray, at: np.ndarray, share: np.ndarray, rounds: int):
    """(proportions, log-likelihood) of each document; entries at[d] to at[d + 1] are its distinct words."""
    lengths = np.diff(at)
    total = np.add.reduceat(n, at[:-1])
    for _ in range(rounds):
        part = p * np.repeat(share, lengths, axis=0)
        part *= (n / np.maximum(part.sum(axis=1), 1e-300))[:, None]
        share = np.add.reduceat(part, at[:-1], axis=0) / total[:, None]
    mixed = np.maximum((p * np.repeat(share, lengths, axis=0)).sum(axis=1), 1e-300)
    return share, np.add.reduceat(n * np.log(mixed), at[:-1])


def mixture(p: np.ndarray, n: np.ndarray, at: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Proportions of the chosen languages of each document (0 for the others)."""
    docs, kinds = len(at) - 1, p.shape[1]
    share, score = _maximise(p, n, at, np.full((docs, kinds), 1 / kinds), ROUNDS)
    going = np.arange(docs)
    for _ in range(kinds - 1):
        if not len(going):
            break
        own = share[going]
        held = np.where(own > 0, own, np.inf)
        trial = own.copy()
        trial[np.arange(len(going)), held.argmin(axis=1)] = 0
        going = going[trial.sum(axis=1) > 0]
        trial = trial[trial.sum(axis=1) > 0]
        trial /= trial.sum(axis=1, keepdims=True)
        lengths = np.diff(at)[going]
        rows = W.ragged(at[:-1][going], lengths)
        begins = np.append(0, np.cumsum(lengths))
        if not len(rows):
            break
        fewer, less = _maximise(p[rows], n[rows], begins, trial, ROUNDS)
        better = (score[going] - less) / 2 < penalty
        share[going[better]], score[going[better]] = fewer[better], less[better]
        going = going[better]
    return share


class WordTable:
    """Log-likelihoods and letter flags of words, scored once in each task; forgotten when it grows large."""

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self):
        self.known = np.zeros(0, dtype=np.uint64)
        self.table = np.zeros((0, len(self.model.languages)))
        self.letters = np.zeros(0, dtype=bool)

    def look_up(self, hashes: np.ndarray, spell) -> tuple[np.ndarray, np.ndarray]:
        """hashes: distinct and sorted; spell(indices): the words themselves."""
        if len(self.known) > KEPT_WORDS:
            self._clear()
        at = np.searchsorted(self.known, hashes)
        held = np.zeros(len(hashes), dtype=bool)
        low = at < len(self.known)
        held[low] = self.known[at[low]] == hashes[low]
        new = np.flatnonzero(~held)
        if len(new):
            words = spell(new)
            self.table = np.insert(self.table, at[new], self.model.log_likelihoods(words), axis=0)
            self.letters = np.insert(self.letters, at[new], [any(map(str.isalpha, x)) for x in words])
            self.known = np.insert(self.known, at[new], hashes[new])
            at = np.searchsorted(self.known, hashes)
        return self.table[at], self.letters[at]


def _predict(model: Model):
    def run(batches):
        words = WordTable(model)
        for batch in batches:
            n = batch.num_rows
            names, score = np.full(n, -1), np.zeros(n)
            shares = np.zeros((n, len(model.languages)))
            for row, bounds, data in W.blocks(batch.column("text")) if model.languages else ():
                w = W.words_of(data, bounds)
                if not len(w.hash):
                    continue
                distinct, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
                log_p, letter = words.look_up(distinct, lambda k: _spelt(data, w, first[k]))
                use = letter[which]
                pairs, times = np.unique(w.row[use] * len(distinct) + which[use], return_counts=True)
                if not len(pairs):
                    continue
                doc, word = pairs // len(distinct), pairs % len(distinct)
                docs, at = np.unique(doc, return_index=True)
                scaled = log_p[word]
                p = np.exp(scaled - scaled.max(axis=1, keepdims=True))
                found = mixture(p, times.astype(np.float64), np.append(at, len(doc)))
                shares[row + docs] = found
                names[row + docs] = found.argmax(axis=1)
                score[row + docs] = np.clip(found.max(axis=1), 0, 1)
            langs = pa.array([model.languages[k] if k >= 0 else "und" for k in names], pa.string())
            mix = [
                [{"lang": m, "share": float(s)} for m, s in zip(model.languages, row) if s > 0] for row in shares
            ]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), langs, pa.array(score), pa.array(mix, kind)],
                ["doc_id", "lang_pred", "score", "mixture"],
            )

    return run


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, lang_pred, score (its share of the words), mixture (lang, share)."""
    return documents.select("doc_id", "text").transform(
            mapped,
        _predict(model), "doc_id long, lang_pred string, score double, mixture array<struct<lang: string, share: double>>"
    )


def op3_mixture_language(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    model = fit(documents.where(F.coalesce(fold, F.lit(0)) != 1).select("text", "lang"))
    held_out = F.coalesce(fold == 1, F.lit(False))
    return identify(documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "mixture")
