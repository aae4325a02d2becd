"""Near-duplicate documents by Order MinHash over 5-word shingles, verified by banded alignment.

A document is the sequence of its word shingles, each labelled with its occurrence number.  Each of
`SKETCHES` sketches takes the `TAKE` labelled shingles that hash least and keeps them in text order, so
two documents agree in a sketch only if they share these shingles in the same order: the chance follows
edit similarity.  At the similarity 0.8 one sketch of long texts agrees with a chance of about 0.8**TAKE, so defaults
miss a pair at the threshold with a chance of about 3e-6.  Shingles are drawn without replacement, so of short texts
more are missed: 6e-5 of the pairs of 9 shingles with 8 in common, 2e-5 of those with 12 of 15 in all.

Shorter pairs are found exactly: up to 9 shingles in all, two texts at the similarity 0.8 differ in one
shingle, so one of them is the other without it.  Hashes of texts without one shingle are joined with those of
whole texts; each has one whole text at most.

Documents that share a sketch are candidates, and so are those.  A pair is linked if the alignment of its shingle
sequences (longest common subsequence m within the band that the similarity leaves) has
m / (n1 + n2 - m) >= `SIMILARITY`.

Equal word sequences are one text from the start.  In the buckets of the first sketches every text is compared
with one pivot, then, in all buckets, the texts whose pivot is in another component, and last all pairs
of a bucket whose texts are still in different components: nothing is left out, and a large group of copies
costs a few comparisons a member.  Exact
necessary bounds (lengths; differing bits of a shingle parity map, at most the number of differing
shingles) cut pairs inside the join.

Defined cases: null text is empty; texts without words are one class; a text of fewer than five words
is one shingle; rows with the same doc_id are one document; a row with a null doc_id is a document of its own text,
named by `document_id`, a number from 2**62 on made of the text: text_id and class_id are such a number where no
lower doc_id has the same words or is linked; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closepass.llm import words as W
from closepass.llm.components import stars
from closepass.llm.store import mapped, stored

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 24
TAKE = 4
PARITY_LONGS = 32  # a power of two
FIRST_BANDS = 4  # sketches whose pivots are compared before any component is known


def document_id() -> Column:
    """doc_id, or for a null one a number made of the text."""
    number = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return F.coalesce("doc_id", number)


def sequences(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, hashes): the shingle sequence of each row of a block, in text order."""
    w = W.words_of(data, bounds)
    at, value = W.shingles(w, SHINGLE)
    short = np.diff(w.bounds)
    rows = w.row[at]
    for r in np.flatnonzero((short > 0) & (short < SHINGLE)):
        a, b = w.bounds[r], w.bounds[r + 1]
        whole = W.mixed(np.sum(w.hash[a:b] * W.powers(W.BASE, SHINGLE + 1)[1 : b - a + 1], keepdims=True))
        rows, value = np.append(rows, r), np.append(value, whole)
    order = np.argsort(rows, kind="stable")
    return np.searchsorted(rows[order], np.arange(len(bounds))), value[order]


def labelled(bounds: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Hashes of (shingle, number of its occurrence in the row)."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((value, row))
    v, r = value[order], row[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))
    out = np.empty_like(value)
    out[order] = W.mixed(v + (np.arange(len(v)) - first).astype(np.uint64) * np.uint64(W.INVERSE))
    return out


def order_sketches(labels: np.ndarray, seeds: np.ndarray, take: int) -> np.ndarray:
    """One hash for each seed: the `take` least labelled shingles under it, in text order."""
    n = len(labels)
    out = np.empty(len(seeds), dtype=np.uint64)
    step = max(1, (1 << 20) // max(n, 1))
    for i in range(0, len(seeds), step):
        hashed = W.mixed(labels[None, :] ^ seeds[i : i + step, None])
        if n > take:
            at = np.sort(np.argpartition(hashed, take - 1, axis=1)[:, :take], axis=1)
        else:
            at = np.broadcast_to(np.arange(n), (len(hashed), n))
        total = np.zeros(len(hashed), dtype=np.uint64)
        for k in range(at.shape[1]):
            total = W.mixed(total + labels[at[:, k]])
        out[i : i + step] = total
    return out


def one_apart(similarity: float) -> int:
    """The largest number of shingles in all of two texts at which `similarity` leaves one of them to differ."""
    return int(np.ceil(2 / (1 - similarity) - 1e-9)) - 1 if similarity < 1 else 0


def _sketch_rows(sketches: int, take: int, most: int):
    top = np.uint64(65 - (64 * PARITY_LONGS).bit_length())
    seeds = W.mixed(np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            same = np.zeros((2, n), dtype=np.uint64)
            size = np.zeros(n, dtype=np.int64)
            found = np.zeros((n, sketches), dtype=np.uint64)
            parity = np.zeros((n, PARITY_LONGS), dtype=np.uint64)
            less: list[list[int]] = [[] for _ in range(n)]
            for row, bounds, data in W.blocks(batch.column("text")):
                at, value = sequences(data, bounds)
                labels = labelled(at, value)
                for r in range(len(bounds) - 1):
                    own = labels[at[r] : at[r + 1]]
                    i = row + r
                    size[i] = len(own)
                    if not len(own):
                        continue
                    odd = np.flatnonzero(np.bincount((own >> top).astype(np.int64), minlength=64 * PARITY_LONGS) & 1)
                    np.bitwise_or.at(parity[i], odd >> 6, np.uint64(1) << (odd & 63).astype(np.uint64))
                    order = W.powers(W.BASE, len(own) + 1)[1:]
                    same[0, i] = np.sum(value[at[r] : at[r + 1]] * order)
                    same[1, i] = np.sum(W.mixed(value[at[r] : at[r + 1]]) * order)
                    found[i] = order_sketches(own, seeds, take)
                    if 1 < len(own) <= most:
                        short = value[at[r] : at[r + 1]]
                        parts = [np.sum(np.delete(short, k) * order[:-1]) for k in range(len(own))]
                        less[i] = W.signed(np.unique(np.array(parts, dtype=np.uint64))).tolist()
            lists = [
                pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), W.signed(x.ravel()))
                for x in (found, parity)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("id"), W.signed(same[0]), W.signed(same[1]), size, *lists, pa.array(less, pa.list_(pa.int64()))],
                ["doc_id", "id", "same1", "same2", "n", "sketches", "parity", "less"],
            )

    return run


def alignment(a: np.ndarray, b: np.ndarray, similarity: float) -> float:
    """m / (len(a) + len(b) - m), where m is the longest common subsequence of a and b within the band
    outside which an alignment cannot reach `similarity`; 0 if it is not reached."""
    n, total = min(len(a), len(b)), len(a) + len(b)
    need = int(np.ceil(similarity * total / (1 + similarity) - 1e-9))
    if n < need:
        return 0.0
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    m = head + tail
    if m + min(len(a), len(b)) < need:
        return 0.0
    if len(a) and len(b):
        band = total - 2 * need  # positions of a match differ by no more
        masks: dict[int, int] = {}
        for j, x in enumerate(b.tolist()):
            masks[x] = masks.get(x, 0) | 1 << j
        # bit-parallel row by row: a cleared bit j says that the best length grows at b[j]
        full = (1 << len(b)) - 1
        row = full
        window = (1 << (2 * band + 1)) - 1
        for i, x in enumerate(a.tolist()):
            hit = masks.get(x, 0)
            if hit:
                hit &= window << (i - band) if i >= band else window >> (band - i)
                if hit:
                    met = row & hit
                    row = ((row + met) | (row - met)) & full
        m += len(b) - row.bit_count()
    return m / (total - m) if m >= need else 0.0


def _linked(similarity: float):
    def run(batches):
        for batch in batches:
            sides = []
            for name in ("text_a", "text_b"):
                rows = []
                for _, bounds, data in W.blocks(batch.column(name)):
                    at, value = sequences(data, bounds)
                    rows += [value[at[r] : at[r + 1]] for r in range(len(bounds) - 1)]
                sides.append(rows)
            likeness = pa.array([alignment(x, y, similarity) for x, y in zip(*sides)], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), likeness], ["a", "b", "similarity"]
            )

    return run


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b, similarity) among `pairs`; only texts that occur in a pair are shuffled twice."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = stored(texts.join(wanted, texts.id == wanted.doc_id).select(wanted.doc_id, "text"))
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}")), side)
    rows = pairs.transform(mapped, _linked(similarity), "a long, b long, similarity double")
    return stored(rows.where(F.col("similarity") >= similarity))


def _could_reach(similarity: float) -> Column:
    """Necessary for a pair: the sum of both lengths bounds the number of differing shingles."""
    most = F.col("x.n") + F.col("y.n")
    differing = sum(
        (F.bit_count(F.col(f"x.p{k}").bitwiseXOR(F.col(f"y.p{k}"))) for k in range(PARITY_LONGS)), F.lit(0)
    )
    slack = F.lit((1 - similarity) / (1 + similarity)) * most + 1e-6
    return (F.abs(F.col("x.n") - F.col("y.n")) <= slack) & (differing <= slack)


def _ordered(rows: DataFrame, one: str, other: str) -> DataFrame:
    return rows.select(F.greatest(one, other).alias("a"), F.least(one, other).alias("b")).distinct()


def near_duplicates(
    documents: DataFrame, similarity: float = SIMILARITY, sketches: int = SKETCHES, take: int = TAKE
) -> DataFrame:
    """(doc_id, text_id, class_id) per document: text_id is the least doc_id with the same words, class_id
    the least of all that are linked to it, directly or through others (`document_id` for those without one)."""
    documents = documents.select("doc_id", document_id().alias("id"), "text")
    # copies of a text without a doc_id have one name
    unnamed = documents.where("doc_id is null").select("id", "text").distinct()
    sources = documents.where("doc_id is not null").select("id", "text").unionByName(unnamed)
    schema = "doc_id long, id long, same1 long, same2 long, n long, sketches array<long>, parity array<long>, less array<long>"
    most = one_apart(similarity)
    rows = stored(documents.transform(mapped, _sketch_rows(sketches, take, most), schema))
    same = ["same1", "same2", "n"]
    texts = stored(
        rows.groupBy(*same)
        .agg(F.min(F.struct("id", "sketches", "parity", "less")).alias("t"))
        .select(*same, F.col("t.id").alias("text_id"), "t.sketches", "t.parity", "t.less")
    )
    parity = [F.element_at("parity", k + 1).alias(f"p{k}") for k in range(PARITY_LONGS)]
    members = texts.where("n > 0").select(
        "text_id", "n", F.posexplode("sketches").alias("band", "value")
    )
    # each bucket draws its pivot by a hash, so that a text meets another one in each of its buckets
    drawn = F.min(F.struct(F.xxhash64("text_id", "band").alias("draw"), "text_id")).alias("drawn")
    shared = stored(members.groupBy("band", "value").agg(F.count("*").alias("size"), drawn).where("size > 1"))
    shared = shared.select("band", "value", F.col("drawn.text_id").alias("pivot"))
    buckets = stored(members.join(shared, ["band", "value"]).select("band", "value", "text_id", "pivot"))
    bounded = texts.select("text_id", "n", *parity)

    def sides(pairs: DataFrame) -> DataFrame:
        x = bounded.alias("x")
        y = bounded.alias("y")
        return (
            pairs.join(x, F.col("x.text_id") == F.col("a"))
            .join(y, F.col("y.text_id") == F.col("b"))
            .where(_could_reach(similarity))
            .select("a", "b")
        )

    first = buckets.where((F.col("text_id") != F.col("pivot")) & (F.col("band") < FIRST_BANDS))
    # short texts: those that are another one without one shingle
    longer = texts.where(F.size("less") > 0).select("text_id", "n", F.explode("less").alias("whole"))
    shorter = texts.where((F.col("n") > 0) & (F.col("n") < most)).select(
        F.col("text_id").alias("pivot"), F.col("n").alias("_n"), F.col("same1").alias("whole")
    )
    short = longer.join(shorter, "whole").where("n = _n + 1 and text_id <> pivot")
    first = first.select("text_id", "pivot").unionByName(short.select("text_id", "pivot"))
    tested = stored(_ordered(first, "text_id", "pivot"))
    links = _verified(stored(sides(tested)), sources, similarity).select("a", "b")
    roots = stars(links)

    def joined_by(links: DataFrame) -> DataFrame:
        """The components (node, root) of `roots` together with further links."""
        known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        return stars(known.unionByName(links.select("a", "b")))

    def still_open() -> DataFrame:
        """Buckets that hold several components, with the component of each text."""
        placed = buckets.join(roots.withColumnRenamed("node", "text_id"), "text_id", "left").withColumn(
            "root", F.coalesce("root", "text_id")
        )
        several = placed.groupBy("band", "value").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        several = stored(several.where("lo < hi").select("band", "value"))
        return stored(placed.join(several, ["band", "value"]))

    # of all bands: texts whose pivot is in another component
    opened = still_open()
    heads = opened.where("text_id = pivot").select("band", "value", F.col("root").alias("pivot_root"))
    second = opened.join(heads, ["band", "value"]).where("root <> pivot_root")
    second = stored(_ordered(second, "text_id", "pivot").join(tested, ["a", "b"], "left_anti"))
    roots = joined_by(_verified(stored(sides(second)), sources, similarity))

    # what is still open: all pairs of texts of different components
    opened = stored(still_open().join(bounded, "text_id"))
    x, y = opened.alias("x"), opened.alias("y")
    across = x.join(
        y,
        (F.col("x.band") == F.col("y.band"))
        & (F.col("x.value") == F.col("y.value"))
        & (F.col("x.text_id") > F.col("y.text_id"))
        & (F.col("x.root") != F.col("y.root"))
        & _could_reach(similarity),
    ).select(F.col("x.text_id").alias("a"), F.col("y.text_id").alias("b"))
    across = across.distinct().join(tested.unionByName(second), ["a", "b"], "left_anti")
    more = _verified(stored(across), sources, similarity)
    roots = joined_by(more).select(F.col("node").alias("text_id"), F.col("root").alias("class_id"))
    named = texts.join(roots, "text_id", "left").select(
        *(F.col(k).alias(f"_{k}") for k in same), "text_id", F.coalesce("class_id", "text_id").alias("class_id")
    )
    on = [rows[k] == named[f"_{k}"] for k in same]
    return rows.join(named, on).select("doc_id", "text_id", "class_id")


def op8_order_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
