"""Benchmark decontamination by a prefix-filtered set join.

Every item is cut into windows of `window` consecutive words; an item of fewer words is one window.  A
window is a set of shingles.  Its shingles are ordered by how often they occur in all documents, and
as a window counts only when all of it occurs, its rarest shingle alone is the necessary prefix.
Documents report the places of such shingles; these are joined with the windows on the shingle, cut by
length and position (the window must lie inside the document) and verified word by word.

Fixed-size bit filters keep places without any item shingle out of the shuffle.  With a larger
benchmark they let more places through, which costs time and never changes the result.

Defined cases: null text has no words; a null item has no words and no window; repeated documents each
get their row; repeated items count by their item_id; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closepass.llm import words as W
from closepass.llm.store import mapped, stored

WINDOW = 10
SHINGLE = 5
FILTER_BITS = 22


def _item_windows(window: int, shingle: int):
    def run(batches):
        for batch in batches:
            out = {"item_id": [], "words": [], "shingles": []}
            ids = batch.column("item_id").cast(pa.string()).to_pylist()
            for row, bounds, data in W.blocks(batch.column("text")):
                w = W.words_of(data, bounds)
                low = W.LOWER[data].tobytes()
                texts = [low[s:e].decode() for s, e in zip(w.start, w.end)]
                grams = {}
                for r in range(len(bounds) - 1):
                    a, b = w.bounds[r], w.bounds[r + 1]
                    n = int(min(window, b - a))
                    if not n:
                        continue
                    size = min(shingle, n)
                    if size not in grams:
                        at, value = W.shingles(w, size)
                        grams[size] = dict(zip(at.tolist(), W.signed(value).tolist()))
                    for i in range(a, b - n + 1):
                        out["item_id"].append(ids[row + r])
                        out["words"].append(" ".join(texts[i : i + n]))
                        out["shingles"].append(
                            [
                                {"size": size, "hash": grams[size][j], "place": j - i}
                                for j in range(i, i + n - size + 1)
                            ]
                        )
            yield pa.RecordBatch.from_pydict(out, schema=ITEM_ARROW)

    return run


ITEM_ARROW = pa.schema(
    [
        ("item_id", pa.string()),
        ("words", pa.string()),
        ("shingles", pa.list_(pa.struct([("size", pa.int32()), ("hash", pa.int64()), ("place", pa.int32())]))),
    ]
)
ITEM_SCHEMA = "item_id string, words string, shingles array<struct<size int, hash long, place int>>"


def _filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bit for each of two probes of each hash; at most 2**(bits - 6) rows reach the driver."""
    probes = hashes.select(F.explode(F.array(*(_probe(F.col("hash"), k, bits) for k in (0, 1)))).alias("bit"))
    rows = (
        probes.groupBy(F.shiftright("bit", 6).alias("slot"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("word"))
        .collect()
    )
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    for slot, word in rows:
        out[slot] = word
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def _probe(hash: Column, k: int, bits: int) -> Column:
    return F.shiftrightunsigned(hash, 64 - bits - k * bits).bitwiseAND(F.lit((1 << bits) - 1))


def _held(known: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    first, second = (known[(hashes >> np.uint64(64 - bits - k * bits)) & mask] for k in (0, 1))
    return first & second


def _hits(batch: pa.RecordBatch, sizes: list[int], known: np.ndarray, bits: int):
    """For each block: words, and (word index, hash) of shingles that the filter knows."""
    for row, bounds, data in W.blocks(batch.column("text")):
        w = W.words_of(data, bounds)
        found = []
        for size in sizes:
            at, value = W.shingles(w, size)
            held = _held(known, value, bits)
            found.append((at[held], value[held], size))
        yield row, bounds, data, w, found


def _counts(sizes, known, bits):
    def run(batches):
        for batch in batches:
            values = [v for *_, found in _hits(batch, sizes, known, bits) for _, v, _ in found]
            if values:
                hashes, n = np.unique(np.concatenate(values), return_counts=True)
                yield pa.RecordBatch.from_arrays([W.signed(hashes), n], ["hash", "n"])

    return run


def _places(sizes, known, bits, window, shingle):
    kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64()), ("from", pa.int64()), ("near", pa.string())]))

    def run(batches):
        for batch in batches:
            n_words = np.zeros(batch.num_rows, dtype=np.int64)
            places = [None] * batch.num_rows
            for row, bounds, data, w, found in _hits(batch, sizes, known, bits):
                n_words[row : row + len(bounds) - 1] = np.diff(w.bounds)
                low = None
                for at, value, _ in found:
                    for i, h in zip(at.tolist(), W.signed(value).tolist()):
                        low = low if low is not None else W.LOWER[data].tobytes()
                        r = w.row[i]
                        a = max(w.bounds[r], i - window + 1)
                        b = min(w.bounds[r + 1], i + window)
                        near = b" ".join(low[w.start[j] : w.end[j]] for j in range(a, b)).decode()
                        if places[row + r] is None:
                            places[row + r] = []
                        first = w.bounds[r]
                        places[row + r].append({"hash": h, "at": i - first, "from": a - first, "near": near})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(n_words), pa.array(places, type=kind)],
                ["doc_id", "key", "n_words", "places"],
            )

    return run


def occurrences(
    documents: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """(rows, found): rows has doc_id, key, n_words for each document; found has doc_id, key, item_id,
    start (word), length for each window of an item that occurs in a document."""
    items = items.select("item_id", "text")
    item_windows = stored(items.transform(mapped, _item_windows(window, shingle), ITEM_SCHEMA))
    grams = item_windows.select(F.explode("shingles").alias("s")).select("s.*").distinct()
    sizes = sorted(r[0] for r in grams.select("size").distinct().collect())  # at most `shingle` values
    docs = documents.select("doc_id", F.xxhash64("text").alias("key"), "text")
    known = _filter(grams, filter_bits)
    counts = (
        docs.select("text")
        .transform(mapped, _counts(sizes, known, filter_bits), "hash long, n long")
        .groupBy("hash")
        .agg(F.sum("n").alias("n"))
    )
    # each distinct window by its rarest shingle; one whose shingle occurs nowhere cannot occur
    ordered = (
        item_windows.select("words", F.explode("shingles").alias("s"))
        .select("words", "s.size", "s.hash", "s.place")
        .join(counts, "hash")
        .groupBy("words")
        .agg(F.min(F.struct("n", "hash", "place")).alias("rarest"), F.count_distinct("place").alias("kinds"))
    )
    lengths = F.size(F.split("words", " "))
    prefixes = stored(
        ordered.select(
            F.col("rarest.hash").alias("hash"),
            F.col("rarest.place").cast("long").alias("place"),
            "words",
            lengths.cast("long").alias("length"),
        ).where(F.col("kinds") == F.greatest(F.lit(1), F.col("length") - shingle + 1))
    )
    chosen = _filter(prefixes.select("hash").distinct(), filter_bits)
    arrow = "array<struct<hash: long, at: long, from: long, near: string>>"
    rows = stored(
        docs.transform(
            mapped,
            _places(sizes, chosen, filter_bits, window, shingle), f"doc_id long, key long, n_words long, places {arrow}"
        )
    )
    hits = rows.where("places is not null").select("doc_id", "key", "n_words", F.explode("places").alias("p"))
    hits = hits.select("doc_id", "key", "n_words", "p.*")
    start = F.col("at") - F.col("place")
    inside = (start >= F.col("from")) & (start + F.col("length") <= F.col("n_words"))  # length and position
    same = F.array_join(F.slice(F.split("near", " "), (start - F.col("from") + 1).cast("int"), F.col("length").cast("int")), " ")
    found = (
        hits.join(prefixes, "hash")
        .where(inside)
        .where(same == F.col("words"))
        .select("doc_id", "key", start.alias("start"), "length", "words")
    )
    return rows.drop("places"), found.join(item_windows.select("item_id", "words").distinct(), "words").drop("words")


def contamination(documents: DataFrame, items: DataFrame, **parameters) -> DataFrame:
    """Per document: doc_id, key, n_words, spans (hit words: from, to), n_hit, item_ids (sorted)."""
    rows, found = occurrences(documents, items, **parameters)
    # one row per place and item set: a place is counted once, however many items have the window
    per_document = found.groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end")))).alias("pieces"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
    )
    zero = F.expr("CAST(array() AS array<struct<start: bigint, end: bigint>>)")

    def add(spans: Column, x: Column) -> Column:
        last = F.try_element_at(spans, F.lit(-1))
        longer = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end")))
        return F.when(
            (F.size(spans) > 0) & (last["end"] >= x["start"]),
            F.concat(F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0))), longer),
        ).otherwise(F.concat(spans, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end")))))

    spans = F.aggregate("pieces", zero, add)
    per_document = per_document.select(
        F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), spans.alias("spans"), "item_ids"
    )
    joined = rows.join(
        per_document, rows.doc_id.eqNullSafe(F.col("_doc")) & rows.key.eqNullSafe(F.col("_key")), "left"
    )
    length = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return joined.select(
        "doc_id",
        "key",
        "n_words",
        F.coalesce("spans", zero).alias("spans"),
        F.coalesce(length, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.expr("CAST(array() AS array<string>)")).alias("item_ids"),
    )


def op5_prefix_decontamination(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(documents, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = """
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(i) WHERE len(w) > 0),
places AS (
  SELECT doc_id, i, k.n, array_to_string(w[i:i + k.n - 1], ' ') AS s
  FROM lowered, (SELECT DISTINCT n FROM windows) k, unnest(range(1, len(w) - k.n + 2)) t(i)),
found AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN windows v ON p.s = v.s AND p.n = v.n),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + n)) t(j) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
