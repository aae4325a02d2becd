"""Token ids of documents in files of patched frame-of-reference blocks.

A file image (one value of the `image` column) holds whole documents in ascending order:

    header   magic "PFR1", documents, ids, blocks (unsigned 64-bit each, little-endian)
    rows     document ids (signed 64-bit), then for each the end of its ids (unsigned 64-bit)
    index    for each block, the byte where it starts (unsigned 64-bit)
    blocks   of 128 ids, the last one filled up with its first id:
             least id (unsigned 32-bit), width, number of exceptions (bytes), 16 x width bytes of the
             low bits of each id less the least, exception places (bytes), their high bits (unsigned 32-bit)

The width of a block is the number of bits that `PERCENT` of its values fit in; the rest are exceptions.
Images travel in Parquet rows, so that Spark commits them: a lost task leaves no half-written file.

Documents are dealt by ranges of doc_id, which a sample of the ids balances; each range is one or more
images of about `IMAGE_IDS` ids.  The place of an image in the whole is the sum of what stands before it,
by range and inside the range.

Defined cases: null text is empty and has its end id only; rows of the same doc_id are ordered by
a hash of their texts, then by text, however many ranges there are; a
null doc_id comes first and is written as the least long; an empty table gives no image; other columns are
ignored.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closepass.llm import tokens as T
from closepass.llm import words as W
from closepass.llm.store import mapped, stored

BLOCK = 128
PERCENT = 90
IMAGE_IDS = 1 << 20
MAGIC = b"PFR1"
NO_ID = -(1 << 63)


def _lanes(width: int):
    """(place in the block, word, shift) of each value of a block of 64-bit words."""
    for i in range(BLOCK):
        yield i, i * width // 64, i * width % 64


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 128) values of at most `width` bits -> (blocks, 16 * width) bytes."""
    out = np.zeros((2 * width, len(values)), dtype=np.uint64)
    lanes = np.ascontiguousarray(values.T)
    for i, word, shift in _lanes(width):
        lane = lanes[i].astype(np.uint64)
        out[word] |= lane << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lane >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).view(np.uint8)


def unpack(data: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(data).view(np.uint64).T)
    out = np.zeros((BLOCK, len(data)), dtype=np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i, word, shift in _lanes(width):
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[word + 1] << np.uint64(64 - shift)
        out[i] = value & mask
    return out.T


def _bits(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _anywhere(body: np.ndarray, dtype) -> np.ndarray:
    """The value of `dtype` that begins at each byte; writing into it writes the bytes."""
    size = np.dtype(dtype).itemsize
    return np.ndarray(max(len(body) - size + 1, 0), dtype, body, strides=(1,))


def write_image(doc_ids: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> bytes:
    blocks = -(-len(ids) // BLOCK)
    padded = np.zeros(blocks * BLOCK, dtype=np.uint32)
    padded[: len(ids)] = ids
    if len(padded) > len(ids):
        padded[len(ids) :] = padded[(blocks - 1) * BLOCK]
    table = padded.reshape(blocks, BLOCK)
    least = table.min(axis=1)
    values = table - least[:, None]
    rank = BLOCK * PERCENT // 100 - 1
    width = _bits(np.partition(values, rank, axis=1)[:, rank])
    above = values >> width.astype(np.uint32)[:, None]
    block, place = np.nonzero(above)
    exceptions = np.bincount(block, minlength=blocks)
    size = 6 + 16 * width + 5 * exceptions
    start = np.cumsum(size) - size
    body = np.zeros(int(size.sum()), dtype=np.uint8)
    numbers = _anywhere(body, "<u4")
    numbers[start] = least
    body[start + 4] = width
    body[start + 5] = exceptions
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        low = pack(values[own] & np.uint32((1 << w) - 1), w)
        _anywhere(body, f"V{16 * w}")[start[own] + 6] = low.view(f"V{16 * w}").ravel()
    rank = np.arange(len(block)) - (np.cumsum(exceptions) - exceptions)[block]
    after = start[block] + 6 + 16 * width[block]
    body[after + rank] = place
    numbers[after + exceptions[block] + 4 * rank] = above[block, place]
    counts = np.array([len(doc_ids), len(ids), blocks], dtype="<u8")
    head = MAGIC + counts.tobytes() + doc_ids.astype("<i8").tobytes() + ends.astype("<u8").tobytes()
    offset = len(head) + 8 * blocks
    return head + (start + offset).astype("<u8").tobytes() + body.tobytes()


def read_image(image: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, ends, ids)"""
    if image[:4] != MAGIC:
        raise ValueError("not a token file")
    docs, n, blocks = np.frombuffer(image, "<u8", 3, 4).astype(np.int64).tolist()
    doc_ids = np.frombuffer(image, "<i8", docs, 28)
    ends = np.frombuffer(image, "<u8", docs, 28 + 8 * docs).astype(np.int64)
    start = np.frombuffer(image, "<u8", blocks, 28 + 16 * docs).astype(np.int64)
    body = np.frombuffer(image, np.uint8)
    numbers = _anywhere(body, "<u4")
    width, exceptions = body[start + 4].astype(np.int64), body[start + 5].astype(np.int64)
    values = np.zeros((blocks, BLOCK), dtype=np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        low = _anywhere(body, f"V{16 * w}")[start[own] + 6]
        values[own] = unpack(low.view(np.uint8).reshape(-1, 16 * w), w)
    block = np.repeat(np.arange(blocks), exceptions)
    rank = np.arange(len(block)) - (np.cumsum(exceptions) - exceptions)[block]
    after = start[block] + 6 + 16 * width[block]
    high = numbers[after + exceptions[block] + 4 * rank]
    values[block, body[after + rank]] |= high << width[block].astype(np.uint32)
    values += numbers[start][:, None]
    return doc_ids, ends, values.ravel()[:n]


FILE_SCHEMA = "part int, number int, n_ids long, image binary"


def _write(path: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        encoder = T.encoder(path)
        docs, parts, ends, total = [], [], [], 0

        def image():
            nonlocal docs, parts, ends, total, number
            data = write_image(np.concatenate(docs), np.concatenate(ends), np.concatenate(parts))
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([total]), pa.array([data])],
                ["part", "number", "n_ids", "image"],
            )
            docs, parts, ends, total, number = [], [], [], 0, number + 1
            return row

        for batch in batches:
            doc_ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            for row, ids, bounds in encoder.column(batch.column("text"), end_id):
                docs.append(doc_ids[row : row + len(bounds) - 1])
                parts.append(ids)
                ends.append(bounds[1:] + total)
                total += len(ids)
                if total >= IMAGE_IDS:
                    yield image()
        if docs:
            yield image()

    return run


def write_token_files(documents: DataFrame, path: str, end_id: int) -> DataFrame:
    """The token files of `documents`: part, number (order inside the part), n_ids, image.

    Texts are dealt and sorted before they are encoded, so that finding the ranges reads no token.
    """
    order = ["doc_id", F.xxhash64("text")]
    ordered = documents.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return stored(ordered.transform(mapped, _write(path, end_id), FILE_SCHEMA))


def _images(batches):
    """For each image: the digest columns of its documents, their bounds, its ids."""
    for batch in batches:
        for start, image in zip(batch.column("start").to_pylist(), batch.column("image")):
            doc_ids, ends, ids = read_image(image.as_buffer())
            bounds = np.append(0, ends)
            data = ids.astype("<u4", copy=False)
            crc = [zlib.crc32(data[a:b]) for a, b in zip(bounds.tolist(), ends.tolist())]
            columns = [
                pa.array(doc_ids, mask=doc_ids == NO_ID),
                pa.array(start + bounds[:-1]),
                pa.array(np.diff(bounds)),
                pa.array(crc, pa.int64()),
            ]
            yield columns, bounds, data


DIGESTS = ["doc_id", "start", "n_tokens", "ids_crc32"]


def _read(batches):
    for columns, bounds, ids in _images(batches):
        ids_of = pa.LargeListArray.from_arrays(bounds, ids.astype(np.int32)).cast(pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*columns, ids_of], [*DIGESTS, "ids"])


def _read_digests(batches):
    for columns, _, _ in _images(batches):
        yield pa.RecordBatch.from_arrays(columns, DIGESTS)


def placed(files: DataFrame) -> DataFrame:
    """`files` with `start`, the number of ids before each image."""
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))  # as many rows as the write had tasks
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "number", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("in_part"))
    starts = starts.join(parts, "part").select("part", "number", (F.col("before") + F.col("in_part")).alias("start"))
    # stored, so that its size is known: small, it is broadcast, and images are not shuffled
    return files.join(stored(starts), ["part", "number"])


def read_token_files(files: DataFrame, ids: bool = True) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 and, unless told otherwise, its ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    rows = placed(files).select("start", "image")
    if ids:
        return rows.transform(mapped, _read, f"{schema}, ids array<int>")
    return rows.transform(mapped, _read_digests, schema)


def op7_patched_frame_token_files(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_token_files(write_token_files(documents, T.default_path(), 2), ids=False)
