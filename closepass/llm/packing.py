"""Best-two-fit packing of token sequences.

Documents are encoded, each with an end id, and only those longer than a sequence are cut: into a first
piece of what is left over and full pieces.  Packing depends on lengths only, and there are no more than
`size` of them, so the plan is made from the number of pieces of each length, whatever the corpus holds:

* a bin is filled greedily, always with the longest piece left that fits;
* then its smallest piece is taken out, and of all pairs of pieces left the one that fills the expanded gap
  most tightly replaces it, if it fills more than the single piece did;
* a bin is repeated as often as the numbers left allow.

Pieces are numbered inside their length and read their place off the plan.  Each task that encodes texts counts
its own pieces of each length and writes these numbers with them; what earlier tasks have of a length is added from a
table with one row for each task and length.  That table, cut where the plan goes on to another bin, says where its pieces stand.
Pieces are joined with it by hash, so ids are shuffled once and pass through no sort, window or Python worker again.

Defined cases: null text is empty and holds its end id only; rows of the same doc_id are packed each; an empty
table gives no row; other columns are ignored.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closepass.llm import tokens as T
from closepass.llm import words as W
from closepass.llm.store import mapped, stored

SIZE = 2048

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long, ids binary"
PLACE_SCHEMA = "task int, length long, first long, end long, base long, offset long"


def plan(counts: np.ndarray, size: int = SIZE) -> list[tuple[list[int], int]]:
    """counts[l]: pieces of length l.  Bins as (lengths in order, how often)."""
    left = counts.astype(np.int64).copy()
    bins = []
    while left.any():
        free = left.copy()
        own: list[int] = []
        gap = size
        at = int(np.flatnonzero(free).max())
        while at:
            take = min(int(free[at]), gap // at)
            own += [at] * take
            free[at] -= take
            gap -= take * at
            fits = np.flatnonzero(free[: gap + 1])
            at = int(fits.max()) if len(fits) else 0
        if gap and len(own) > 1:
            smallest = own[-1]
            free[smallest] += 1
            room = gap + smallest
            lengths = np.flatnonzero(free[: room + 1])
            longest = np.maximum.accumulate(np.where(free[: room + 1] > 0, np.arange(room + 1), 0))
            other = longest[room - lengths]
            lone = (other == lengths) & (free[lengths] < 2)
            other[lone] = longest[np.maximum(other[lone] - 1, 0)]
            both = np.where(other > 0, lengths + other, 0)
            if len(both) and both.max() > smallest:
                k = int(both.argmax())
                own[-1:] = sorted((int(lengths[k]), int(other[k])), reverse=True)
        kinds, each = np.unique(own, return_counts=True)
        times = int((left[kinds] // each).min())
        left[kinds] -= times * each
        bins.append((own, times))
    return bins


class Places:
    """(length, number inside the length) -> (sequence, offset), read off a plan."""

    def __init__(self, counts: np.ndarray, size: int = SIZE):
        taken = np.zeros(size + 1, dtype=np.int64)
        rows, base = [], 0
        for own, times in plan(counts, size):
            offset = 0
            for length in own:
                rows.append(((length << 44) + taken[length], base, offset))
                taken[length] += times
                offset += length
            base += times
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(-1, 3)
        self.keys, self.base, self.offset = table[:, 0], table[:, 1], table[:, 2]
        self.sequences = base

    def ranges(self, length: np.ndarray, before: np.ndarray, n: np.ndarray):
        """Pieces before..before+n-1 of a length, cut into runs whose sequences follow each other.

        (row, first, end, base, offset): its pieces first..end-1, counted from `before`, stand at `offset` of the sequences
        from `base` on.
        """
        key = (length << 44) + before
        a = np.searchsorted(self.keys, key, "right") - 1
        b = np.searchsorted(self.keys, key + n, "left")
        at = W.ragged(a, b - a)
        row = np.repeat(np.arange(len(length)), b - a)
        opens, closes = self.keys[at], np.append(self.keys, 1 << 62)[at + 1]
        first = np.maximum(opens, key[row])
        return row, first - key[row], np.minimum(closes, key[row] + n[row]) - key[row], self.base[at] + first - opens, self.offset[at]


def _pieces(path: str, end_id: int, size: int):
    def run(batches):
        encoder = T.encoder(path)
        task = TaskContext.get().partitionId()
        counts = np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            for row, ids, bounds in encoder.column(batch.column("text"), end_id):
                lengths = np.diff(bounds)
                first = (lengths - 1) % size + 1
                number = (lengths - first) // size + 1
                doc = np.repeat(np.arange(len(lengths)), number)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * size)
                length = np.where(piece == 0, first[doc], size)
                # the place among the pieces of its length, here and in earlier blocks of the task
                order = np.argsort(length, kind="stable")
                kinds, opens, own = np.unique(length[order], return_index=True, return_counts=True)
                among = np.empty(len(length), dtype=np.int64)
                among[order] = np.arange(len(length)) - np.repeat(opens, own)
                among += counts[length]
                counts[kinds] += own
                data = ids.astype("<u4")
                a = bounds[doc] + start
                # the pieces stand end to end, so the ids of the block are their bytes
                at = np.append(a, len(ids)) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(doc + row)),
                        pa.array(piece, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        pa.array([zlib.crc32(data[i : i + n]) for i, n in zip(a, length)], pa.int64()),
                        pa.array(np.full(len(a), task), pa.int32()),
                        pa.array(among),
                        pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)]),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number", "ids"],
                )

    return run


def _ranges(places: Places):
    def run(batches):
        for batch in batches:
            length, before, n = (batch.column(c).to_numpy() for c in ("length", "before", "n"))
            row, first, end, base, offset = places.ranges(length, before, n)
            task = batch.column("task").take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [task, *map(pa.array, (length[row], first, end, base, offset))], ["task", "length", "first", "end", "base", "offset"]
            )

    return run


def packed(documents: DataFrame, path: str, end_id: int = 0, size: int = SIZE, ids: bool = True) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset and, unless told otherwise,
    ids (unsigned 32-bit, little-endian)."""
    pieces = stored(documents.select("doc_id", "text").transform(mapped, _pieces(path, end_id, size), PIECE_SCHEMA))
    groups = stored(pieces.groupBy("task", "length").agg(F.count("*").alias("n")))
    counts = np.zeros(size + 1, dtype=np.int64)
    for length, n in groups.groupBy("length").agg(F.sum("n")).collect():  # at most `size` rows
        counts[length] = n
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row a task
    groups = groups.select("*", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    places = groups.transform(mapped, _ranges(Places(counts, size)), PLACE_SCHEMA)
    # the table grows with the tasks, so it is not broadcast; its part of a partition is small, so pieces need no sort
    rows = pieces.join(places.hint("shuffle_hash"), ["task", "length"]).where("number >= first AND number < end")
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    return rows.select(*kept, (F.col("base") + F.col("number") - F.col("first")).alias("sequence_id"), "offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences; each has at most `size` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda x, p: F.concat(x, p["ids"]))
    return pieces.groupBy("sequence_id").agg(whole.alias("ids"))


def op4_best_two_fit(spark, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), T.default_path(), ids=False)
