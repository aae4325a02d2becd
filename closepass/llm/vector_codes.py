"""Product codes of vectors in integers, with Drake and Hamerly's adaptive bounds.

A component x counts as the integer floor(256 * x).  Vectors are cut into `PARTS` equal parts, each with a codebook of
`ENTRIES` that starts as that part of the vectors with the least ids; `ROUNDS` times every part goes to its nearest entry (squared
distance, ties to the lower index) and every entry becomes the floor of its parts' mean.

The first assignment compares a part with all entries and writes, with the vector, its b closest entries in order, a lower
bound of the distance to each, and one outer bound for all other entries.  After entries have moved,
each bound is lowered by how far its entry moved, the outer one by the farthest move, and bounds are kept in order
by taking each no larger than the next.  The distance to the own entry is taken anew in integers; only entries
whose bound does not exceed it are uncertain, and these stand first in the list, so they are verified
by integer distance and the others are not looked at.  A part whose outer bound does not exceed it is
compared with all entries again.  The list shrinks, between ENTRIES / 4 and ENTRIES / 8 entries, to what 99 of 100 parts of the
rows written together were verified to.  Bounds are rounded down and compared with a margin, so they decide about work,
never about a result.

Spark holds the vectors and bounds; a task adds up its own parts by entry, and only these sums, one number for each
component of a codebook, reach the driver.

Defined cases: vectors that are null, empty, or hold a null or non-finite component take no part, nor do vectors of another
length than that of the least id; a length that 16 does not divide is filled up with zeros; with
fewer than 64 vectors the codebooks have fewer entries; rows of one id are vectors each, the codebooks take them in the order of
their components; a null id comes last there; an empty table gives no row; components so large that squared distances have no exact
double raise ValueError; other columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closepass.llm.store import mapped, stored

PARTS = 16
ENTRIES = 64
SCALE = 256
ROUNDS = 2
COVERED = 0.99  # share of parts whose verified entries the next list must hold

BOUNDS_SCHEMA = "values binary, code binary, near binary, low binary, outer binary, error long"


def nearest(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances, (part, vector, entry), of parts (vector, part, width) to book (part, entry, width)."""
    x = parts.transpose(1, 0, 2)
    cross = x @ book.transpose(0, 2, 1)
    return (x * x).sum(axis=2)[:, :, None] - 2 * cross + (book * book).sum(axis=2)[:, None, :]


def lowered(x: np.ndarray) -> np.ndarray:
    """As 32-bit numbers that are no larger."""
    y = x.astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-np.inf)), y)


class Assigner:
    """Assigns parts to the entries of `book`; `old` is the book that the bounds it is given hold for."""

    def __init__(self, book: np.ndarray, old: np.ndarray | None = None):
        self.book = book.astype(np.float64)
        self.entries = book.shape[1]
        self.moved = None
        if old is not None:  # rounded up
            self.moved = np.sqrt(((self.book - old) ** 2).sum(axis=2)) * (1 + 1e-12)
        self.most, self.least = max(1, self.entries // 4), max(1, self.entries // 8)

    def whole(self, parts: np.ndarray, width: int):
        """(near, squared distances, outer) of (vector, part, width) against all entries; (vector, part, ...) each."""
        # distance and index as one integer, so ties go to the lower index
        keys = nearest(parts, self.book).astype(np.int64) * self.entries + np.arange(self.entries)
        if width < self.entries:
            keys = np.partition(keys, width, axis=2)
            outer = np.sqrt(keys[:, :, width] // self.entries)
        else:
            outer = np.full(keys.shape[:2], np.inf)
        first = np.sort(keys[:, :, :width], axis=2).transpose(1, 0, 2)
        return first % self.entries, first // self.entries, outer.T

    def first(self, parts: np.ndarray):
        near, squared, outer = self.whole(parts, self.most)
        return near, squared[:, :, 0], np.sqrt(squared), outer, self.most

    def again(self, parts: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
        """(near, squared distance, low, outer, b) from the last ones; near[:, :, 0] is the entry assigned before."""
        n, count, b = near.shape
        part = np.arange(count)[None, :, None]
        outer = outer - self.moved.max(axis=1)
        low = low - self.moved[part, near]
        low = np.minimum.accumulate(np.append(low, outer[:, :, None], axis=2)[:, :, ::-1], axis=2)[:, :, :0:-1]
        own = ((parts - self.book[part[:, :, 0], near[:, :, 0]]) ** 2).sum(axis=2)
        reach = np.sqrt(own) * (1 + 1e-6) + 1e-6
        depth = np.maximum((low <= reach[:, :, None]).sum(axis=2), 1)
        squared = np.full((n, count, b), np.inf)
        squared[:, :, 0] = own
        v, p, j = np.nonzero((np.arange(b) < depth[:, :, None]) & (np.arange(b) > 0))
        squared[v, p, j] = ((parts[v, p] - self.book[p, near[v, p, j]]) ** 2).sum(axis=1)
        best = np.lexsort((near, squared), axis=2)[:, :, :1]
        low = np.where(np.isfinite(squared), np.sqrt(squared), low)
        chosen = np.take_along_axis(squared, best, axis=2)[:, :, 0]
        np.put_along_axis(low, best, -np.inf, axis=2)  # the assigned entry stands first
        order = np.argsort(low, axis=2, kind="stable")
        near, low = np.take_along_axis(near, order, axis=2), np.take_along_axis(low, order, axis=2)
        low[:, :, 0] = np.sqrt(chosen)
        # bounds are in order, so an entry outside the list can be nearest only if all of the list was uncertain
        open_ends = (depth == b) & (outer <= reach)
        width = int(np.quantile(depth, COVERED, method="higher")) if n else self.least
        width = min(b, max(self.least, width))
        if width < b:
            outer = np.minimum(outer, low[:, :, width:].min(axis=2))
            near, low = near[:, :, :width], low[:, :, :width]
        for p in range(count):
            v = np.flatnonzero(open_ends[:, p])
            if len(v):
                one = Assigner.__new__(Assigner)
                one.book, one.entries = self.book[p : p + 1], self.entries
                near_p, squared_p, outer_p = one.whole(parts[v, p : p + 1], width)
                near[v, p], chosen[v, p] = near_p[:, 0], squared_p[:, 0, 0]
                low[v, p], outer[v, p] = np.sqrt(squared_p[:, 0]), outer_p[:, 0]
        return near, chosen.astype(np.int64), low, outer, width


def _written(values: np.ndarray, near, squared, low, outer) -> list[pa.Array]:
    def packed(x):
        return pa.array([row.tobytes() for row in np.ascontiguousarray(x)], pa.binary())

    return [
        packed(values.astype("<i8")),
        packed(near[:, :, 0].astype(np.uint8)),
        packed(near.astype(np.uint8)),
        packed(lowered(low)),
        packed(lowered(outer)),
        pa.array(squared.astype(np.int64).sum(axis=1)),
    ]


def _bounds(parts: np.ndarray, batch: pa.RecordBatch, rows: np.ndarray, b: int):
    """(near, low, outer) of the rows of a batch whose lists have b entries."""

    def column(name, kind, *shape):
        data = b"".join(batch.column(name).take(pa.array(rows)).to_pylist())
        return np.frombuffer(data, dtype=kind).reshape(len(rows), PARTS, *shape)

    return column("near", np.uint8, b).astype(np.int64), column("low", "<f4", b).astype(np.float64), column("outer", "<f4").astype(np.float64)


def integers(column: pa.Array, length: int) -> np.ndarray:
    """(vector, part, width) integers of whole vectors of `length` components."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).reshape(-1, length)
    width = -(-length // PARTS)
    if len(x) and width * (2 * np.abs(x).max() + 1) ** 2 >= 1 << 53:
        raise ValueError("vector components are too large for exact squared distances")
    x = np.pad(x, ((0, 0), (0, width * PARTS - length)))
    return x.reshape(-1, PARTS, width)


def _first(vector: str, kept: list[str], length: int, book: np.ndarray):
    def run(batches):
        assigner = Assigner(book)
        for batch in batches:
            parts = integers(batch.column(vector), length)
            if len(parts):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), *_written(parts, *assigner.first(parts)[:-1])],
                    [*kept, "values", "code", "near", "low", "outer", "error"],
                )

    return run


def _again(kept: list[str], book: np.ndarray, old: np.ndarray):
    def run(batches):
        assigner = Assigner(book, old)
        for batch in batches:
            values = batch.column("values").to_pylist()
            lengths = np.array([len(x) // PARTS for x in batch.column("near").to_pylist()], dtype=np.int64)
            for b in np.unique(lengths):
                rows = np.flatnonzero(lengths == b)
                parts = np.frombuffer(b"".join(values[r] for r in rows), "<i8").reshape(len(rows), PARTS, -1).astype(np.float64)
                found = assigner.again(parts, *_bounds(parts, batch, rows, int(b)))
                taken = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*(taken.column(c) for c in kept), *_written(parts, *found[:-1])],
                    [*kept, "values", "code", "near", "low", "outer", "error"],
                )

    return run


def _sums(shape: tuple[int, int, int]):
    """Sums and numbers of the parts of each entry, one row a codebook component, once a task."""

    def run(batches):
        total, n = np.zeros(shape, dtype=np.int64), np.zeros(shape[:2], dtype=np.int64)
        for batch in batches:
            rows = batch.num_rows
            values = np.frombuffer(b"".join(batch.column("values").to_pylist()), "<i8").reshape(rows, shape[0], shape[2])
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(rows, shape[0])
            part = np.broadcast_to(np.arange(shape[0]), code.shape)
            np.add.at(total, (part, code), values)
            np.add.at(n, (part, code), 1)
        used = np.flatnonzero(np.repeat(n.ravel(), shape[2]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(total.ravel()[used]), pa.array(n.ravel()[used // shape[2]])], ["cell", "total", "n"]
        )

    return run


def moved(assigned: DataFrame, book: np.ndarray) -> np.ndarray:
    """The book with each entry replaced by the floor of its parts' mean; entries without parts stay."""
    sums = assigned.select("values", "code").transform(mapped, _sums(book.shape), "cell long, total long, n long")
    new = book.copy()
    for cell, total, n in sums.groupBy("cell").agg(F.sum("total"), F.sum("n")).collect():  # the size of a book
        new.ravel()[cell] = total // n
    return new


def compressed(vectors: DataFrame, key: str, vector: str, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """All columns but the vector with `code` (a byte for each part) and `error`; and the books (part, entry, width)."""
    kept = [c for c in vectors.columns if c != vector]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema if f.name in kept)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    least = whole.orderBy(F.col(key).asc_nulls_last(), vector).limit(ENTRIES).select(vector).toArrow()[vector].to_pylist()
    if not least:
        return vectors.select(*kept).withColumns({"code": F.lit(b""), "error": F.lit(0).cast("long")}).where("false"), np.zeros((PARTS, 0, 0), np.int64)
    length = len(least[0])
    least = pa.array([x for x in least if len(x) == length])
    book = integers(least, length).transpose(1, 0, 2).astype(np.int64)
    schema = f"{kinds}, {BOUNDS_SCHEMA}"
    same = whole.where(F.size(vector) == length)
    state = stored(same.transform(mapped, _first(vector, kept, length, book), schema))
    for k in range(rounds):
        new = moved(state, book)
        state = state.transform(mapped, _again(kept, new, book), schema)
        if k == rounds - 1:
            state = state.select(*kept, "code", "error")
        state, book = stored(state), new
    return state.select(*kept, "code", "error"), book


def book_hash(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def op11_drake_hamerly_codes(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    codes, book = compressed(vectors, "vec_id", "embedding")
    totals = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(book_hash(book)).alias("codebooks_sha256"),
    )


def oracle(rounds: int = ROUNDS) -> str:
    parts = [
        """whole AS (SELECT vec_id, label, embedding AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "least AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, e) - 1 AS entry FROM whole QUALIFY entry < 64)",
        "size AS (SELECT len(e) AS d, (len(e) + 15) // 16 AS w FROM least WHERE entry = 0)",
        f"""vectors AS (SELECT row_number() OVER () AS id, vec_id, label, e, list_concat(
    list_transform(e, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT), list_transform(range(w * {PARTS} - d), lambda x: 0::BIGINT)) AS v
  FROM whole, size WHERE len(e) = d)""",
        f"parts AS MATERIALIZED (SELECT id, p, list_slice(v, p * w + 1, p * w + w) AS v FROM vectors, size, range({PARTS}) t(p))",
        f"""book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id NULLS LAST, e) - 1 AS entry, parts.v AS c
  FROM vectors JOIN parts USING (id) QUALIFY entry < {ENTRIES})""",
    ]
    for k in range(rounds + 1):
        parts.append(f"""near{k} AS MATERIALIZED (SELECT id, p, min(
    list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT * {ENTRIES} + entry) AS best
  FROM parts JOIN book{k} USING (p) GROUP BY id, p)""")
        if k < rounds:
            parts.append(f"""mean{k} AS (SELECT p, entry, list(m ORDER BY k) AS c FROM (
    SELECT p, best % {ENTRIES} AS entry, k, (sum(v[k])::BIGINT - ((sum(v[k])::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS m
    FROM near{k} JOIN parts USING (id, p), (SELECT unnest(range(1, w + 1)) AS k FROM size) GROUP BY p, entry, k) GROUP BY p, entry)""")
            parts.append(f"""book{k + 1} AS MATERIALIZED (SELECT p, entry, coalesce(m.c, b.c) AS c
  FROM book{k} b LEFT JOIN mean{k} m USING (p, entry))""")
    parts.append(f"""codes AS (SELECT id, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY p) AS code,
  sum(best // {ENTRIES})::BIGINT AS error FROM near{rounds} GROUP BY id)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, entry)) FROM book{rounds}) AS codebooks_sha256
FROM vectors JOIN codes USING (id)"""
