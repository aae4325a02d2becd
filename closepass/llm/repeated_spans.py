"""Exact removal of repeated byte spans by suffix sorting at sampled places.

A byte goes if a string of `LENGTH` bytes that covers it starts anywhere else too.  Sorting the suffixes at
all places would move every text several hundred times over.  Instead each such string is named by one
place in it, its anchor: the leftmost least hash of the `GRAM`-byte strings inside.  Equal strings have
their anchor at the same place, so only suffixes that start at anchors need to be compared.

1. Every text is cut into runs of string starts with the same anchor (about one in 100 bytes).  A run is
   described by a hash of the GRAM bytes at its anchor (its group) and one of all bytes it covers (its class).
2. Groups with one run hold no repeat.  Runs of one class are counted, not moved: a class is one
   suffix with a multiplicity.  The bytes of one run of each class are fetched where a group has several.
3. In each bucket of groups, deep-shallow sorting orders the suffixes from the anchors and the reversed
   prefixes before them.  For each number l of bytes before the anchor, a string repeats if its suffix to
   depth LENGTH - l and its prefix to depth l both lie in one range of the two orders with another's.
   A group of more than BUCKET_ROWS classes is not sorted: its strings are counted by 128-bit digests, for each
   number of bytes before the anchor, so no task holds more of it than its share of digests.
4. Repeated strings go back to all runs of their class and are cut out of the documents.

Defined cases: null text is empty; texts shorter than LENGTH keep all bytes; equal rows are two
occurrences, and each gets its own result row; other columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closepass.llm import words as W
from closepass.llm.store import mapped, stored
from closepass.llm.suffix_sort import ranked

LENGTH = 400
GRAM = 200
BUCKET_ROWS = 20_000  # suffixes of one group that a sort takes; strings of a larger group are counted


def _gram_hashes(data: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Hashes of the GRAM bytes at each place, and of the 64 and 128 bytes; the end of the block is padded."""
    padded = np.zeros(len(data) + LENGTH + 3 * GRAM, dtype=np.uint8)
    padded[: len(data)] = data
    n = len(padded) - 8
    word = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        word |= padded[k : k + n].astype(np.uint64) << np.uint64(8 * k)

    def joined(x: np.ndarray, step: int) -> np.ndarray:
        return W.mixed(x[:-step] * np.uint64(W.BASE) + x[step:])

    size, value, kept = 8, W.mixed(word), {}
    while size < 128:
        value = joined(value, size)
        size *= 2
        kept[size] = value
    return joined(kept[128], GRAM - 128), kept


def _runs(data: np.ndarray, bounds: np.ndarray):
    """(row, first start, last start, anchor, group, class) of the runs of each row of a block."""
    starts = bounds[1:] - bounds[:-1] - LENGTH + 1
    rows = np.flatnonzero(starts > 0)
    if not len(rows):
        return None
    gram, kept = _gram_hashes(data)
    span = LENGTH - GRAM + 1
    n = len(data)
    total = -(-(n + span) // span) * span
    keys = np.full(total, np.uint64(0xFFFFFFFFFFFFFFFF))
    keys[:n] = (gram[:n] >> np.uint64(32) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    table = keys.reshape(-1, span)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[:n], before[span - 1 : span - 1 + n])
    place = W.ragged(bounds[:-1][rows], starts[rows])
    row = np.repeat(rows, starts[rows])
    anchor = (least[place] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(place), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    first, last, anchor, row = place[at], place[np.append(at[1:], len(place)) - 1], anchor[at], row[at]
    # a run covers LENGTH to LENGTH + span - 1 bytes: five pieces of 128 bytes overlap to cover them all
    size = last - first + LENGTH
    code = W.mixed((anchor - first).astype(np.uint64) * np.uint64(1 << 20) + size.astype(np.uint64))
    for k in range(5):
        code = W.mixed(code * np.uint64(W.BASE) + kept[128][first + (size - 128) * k // 4])
    return row, first, last, anchor, gram[anchor], code


RUN_SCHEMA = "doc_id long, key long, first int, last int, anchor int, grp long, cls long"


def _find_runs(batches):
    for batch in batches:
        for row0, bounds, data in W.blocks(batch.column("text")):
            found = _runs(data, bounds)
            if found is None:
                continue
            row, first, last, anchor, group, code = found
            own = bounds[row]
            take = pa.array(row + row0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take),
                    batch.column("key").take(take),
                    *((x - own).astype(np.int32) for x in (first, last, anchor)),
                    W.signed(group),
                    W.signed(code),
                ],
                ["doc_id", "key", "first", "last", "anchor", "grp", "cls"],
            )


CLASS_SCHEMA = "grp long, cls long, n long, before int, first int, last int, bytes binary"


def _fetch(batches):
    """The bytes of the wanted runs of each document."""
    for batch in batches:
        out = {k: [] for k in ("grp", "cls", "n", "before", "first", "last", "bytes")}
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            data = (text or "").encode()
            for r in wanted:
                out["grp"].append(r["grp"])
                out["cls"].append(r["cls"])
                out["n"].append(r["n"])
                out["before"].append(r["anchor"] - r["first"])
                out["first"].append(r["first"] - r["anchor"])
                out["last"].append(r["last"] - r["anchor"])
                out["bytes"].append(data[r["first"] : r["last"] + LENGTH])
        kinds = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))


STRING_SCHEMA = "grp long, cls long, n long, start int, code binary"
STRING_ROWS = 50_000  # digests of a batch


def _strings(batches):
    """A digest of each string of LENGTH bytes of the classes."""
    kinds = [pa.int64()] * 3 + [pa.int32(), pa.binary()]
    names = ["grp", "cls", "n", "start", "code"]
    for batch in batches:
        out = [[] for _ in names]
        for r in zip(*(batch.column(k).to_pylist() for k in ("grp", "cls", "n", "first", "last", "bytes"))):
            first, last, data = r[3:]
            count = last - first + 1
            for own, value in zip(out, r[:3]):
                own += [value] * count
            out[3] += range(first, last + 1)
            out[4] += [hashlib.blake2b(data[i : i + LENGTH], digest_size=16).digest() for i in range(count)]
            if len(out[4]) >= STRING_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names)
                out = [[] for _ in names]
        if out[4]:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names)


def counted_ranges(suffixes: DataFrame) -> DataFrame:
    """(grp, cls, r) as sorting finds them: a row for each range of starts of repeated strings of a class."""
    strings = stored(suffixes.transform(mapped, _strings, STRING_SCHEMA))
    # copies are added up in each task before the shuffle; written first for the same reason as the groups
    key = ["grp", "start", "code"]
    repeated = stored(strings.groupBy(*key).agg(F.sum("n").alias("copies")).where("copies > 1").select(*key))
    starts = strings.join(repeated, key).select("grp", "cls", "start")
    rank = F.dense_rank().over(Window.partitionBy("grp", "cls").orderBy("start"))
    return (
        starts.withColumn("island", F.col("start") - rank)
        .groupBy("grp", "cls", "island")
        .agg(F.min("start").alias("from"), F.max("start").alias("to"))
        .select("grp", "cls", F.struct("from", "to").alias("r"))
    )


def repeated_starts(
    prefixes: list[bytes], suffixes: list[bytes], first: np.ndarray, last: np.ndarray, n: np.ndarray, length: int = LENGTH
) -> list[list[tuple[int, int]]]:
    """For each suffix at an anchor: ranges of starts, relative to it, of strings that occur twice or more.

    prefixes: the bytes before the anchor, reversed; first..last: the starts of a run; n: its copies.
    """
    m = len(suffixes)
    right, right_lcp = ranked(suffixes)
    left, left_lcp = ranked(prefixes)
    repeated: list[list[int]] = [[] for _ in range(m)]
    low, high = -last, -first  # bytes before the anchor
    right_class, left_class = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)
    for before in range(int(low.min()), int(high.max()) + 1):
        members = np.flatnonzero((low <= before) & (before <= high))
        if not len(members):
            continue
        right_class[right] = np.cumsum(right_lcp < length - before)
        left_class[left] = np.cumsum(left_lcp < before)
        both = right_class[members] * (m + 1) + left_class[members]
        order = np.argsort(both, kind="stable")
        sorted_both = both[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = sorted_both[1:] != sorted_both[:-1]
        which = np.cumsum(new) - 1
        copies = np.bincount(which, weights=n[members][order])
        for i in members[order[copies[which] > 1]].tolist():
            repeated[i].append(-before)
    out = []
    for starts in repeated:
        ranges: list[tuple[int, int]] = []
        for s in reversed(starts):
            if ranges and ranges[-1][1] == s - 1:
                ranges[-1] = (ranges[-1][0], s)
            else:
                ranges.append((s, s))
        out.append(ranges)
    return out


RANGES = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def _sort_bucket(table: pa.Table) -> pa.Table:
    before = table["before"].to_numpy()
    data = table["bytes"].to_pylist()
    prefixes = [d[:b][::-1] for d, b in zip(data, before)]
    suffixes = [d[b:] for d, b in zip(data, before)]
    found = repeated_starts(
        prefixes, suffixes, table["first"].to_numpy(), table["last"].to_numpy(), table["n"].to_numpy()
    )
    ranges = pa.array([[{"from": a, "to": b} for a, b in x] for x in found], type=RANGES)
    return pa.table({"grp": table["grp"], "cls": table["cls"], "ranges": ranges})


def _cut(batches):
    """Documents without their repeated spans (starts of repeated strings, as ranges)."""
    for batch in batches:
        n, removed, spans, kept = [], [], [], []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            data = (text or "").encode()
            merged: list[list[int]] = []
            for a, b in sorted((r["from"], r["to"] + LENGTH) for r in ranges or ()):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            at, parts = 0, []
            for a, b in merged:
                parts.append(data[at:a])
                at = b
            parts.append(data[at:])
            kept.append(b"".join(parts))
            n.append(len(data))
            removed.append(len(data) - len(kept[-1]))
            spans.append([{"from": a, "to": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n), pa.array(removed), pa.array(spans, RANGES), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def without_repeats(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, spans (maximal removed byte runs), kept (remaining bytes)."""
    documents = documents.select("doc_id", F.xxhash64("text").alias("key"), "text")
    runs = stored(documents.transform(mapped, _find_runs, RUN_SCHEMA))
    # written first, so that the join below deals runs by itself and Spark can split a large group
    groups = stored(
        runs.groupBy("grp")
        .agg(F.count("*").alias("n"), (F.min("cls") != F.max("cls")).alias("mixed"))
        .where("n > 1")
        .select("grp", "mixed")
    )
    shared = stored(runs.join(groups, "grp"))
    classes = (
        shared.where("mixed")
        .groupBy("grp", "cls")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "key", "first", "last", "anchor")).alias("run"))
    )
    wanted = classes.groupBy(F.col("run.doc_id").alias("_doc"), F.col("run.key").alias("_key")).agg(
        F.collect_list(F.struct("grp", "cls", "n", "run.first", "run.last", "run.anchor")).alias("wanted")
    )
    # equal rows fetch their runs once each, which only adds to copies that n counts already
    here = [documents.doc_id.eqNullSafe(F.col("_doc")), documents.key == F.col("_key")]
    suffixes = stored(documents.join(wanted, here).select("text", "wanted").transform(mapped, _fetch, CLASS_SCHEMA))
    large = stored(suffixes.groupBy("grp").agg(F.count("*").alias("m")).where(F.col("m") > BUCKET_ROWS).select("grp"))
    split = not large.isEmpty()
    small = suffixes.join(large, "grp", "left_anti") if split else suffixes
    # a bucket holds whole groups
    buckets = max(1, -(-suffixes.count() // (BUCKET_ROWS // 2)))
    results = (
        small.withColumn("bucket", F.pmod(F.xxhash64("grp"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInArrow(_sort_bucket, "grp long, cls long, ranges array<struct<from: int, to: int>>")
        .where(F.size("ranges") > 0)
        .select("grp", "cls", F.explode("ranges").alias("r"))
    )
    if split:
        results = results.unionByName(counted_ranges(suffixes.join(large, "grp", "left_semi")))
    absolute = lambda c: (F.col("anchor") + F.col(c)).alias(c.split(".")[1])
    mixed = shared.where("mixed").join(results, ["grp", "cls"]).select("doc_id", "key", absolute("r.from"), absolute("r.to"))
    plain = shared.where("NOT mixed").select("doc_id", "key", F.col("first").alias("from"), F.col("last").alias("to"))
    ranges = (
        mixed.unionByName(plain)
        .groupBy(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"))
        .agg(F.collect_set(F.struct("from", "to")).alias("ranges"))
    )
    kind = "array<struct<from: int, to: int>>"
    return (
        documents.join(ranges, here, "left")
        .select("doc_id", "text", "ranges")
        .transform(mapped, _cut, f"doc_id long, n_bytes long, n_removed long, spans {kind}, kept binary")
    )


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    cut = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def brute_force(texts: list[str], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """The definition, over all places of a small list of texts."""
    seen: dict[bytes, int] = {}
    data = [(t or "").encode() for t in texts]
    for d in data:
        for i in range(len(d) - length + 1):
            s = d[i : i + length]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int(np.sum(gone[:-1] & ~np.append(False, gone[:-1])[:-1])) if len(d) else 0
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), len(d) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out
