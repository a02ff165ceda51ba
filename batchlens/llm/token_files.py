"""Token ids in files: frequent ids in few bytes, decoded by table lookup."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm.tables import by_bytes, new_folder, written
from batchlens.llm.vocabulary import SIZE_KEPT, ChunkEncoder, flattened, gathered, library_tokenizer, of_one_task, vocabulary

TEXTS_AT_ONCE = 512
# Bytes of text encoded at once: the chunks they have in common are looked up once.
TEXT_AT_ONCE = 8 << 20

#: For each control byte the lengths of its four numbers.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)


def _filled(counts: np.ndarray, quads: np.ndarray) -> np.ndarray:
    """Of the places in the control bytes of all rows, which ones have a number."""
    filled = np.ones(4 * int(quads.sum()), dtype=bool)
    missing = 4 * quads - counts
    for k in range(1, 4):
        filled[4 * np.cumsum(quads)[missing >= k] - k] = False
    return filled


def pack_rows(values: np.ndarray, counts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """For each row of so many numbers its control bytes (two bits a number, four
    numbers a byte) and data bytes (the 1 to 4 low bytes of each number, little-endian)."""
    values = values.astype("<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    quads = -(-counts // 4)
    filled = _filled(counts, quads)
    codes = np.zeros(len(filled), dtype=np.uint8)
    codes[filled] = extra
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= extra[:, None]]
    reached = np.concatenate([[0], np.cumsum(extra, dtype=np.int64)])[np.cumsum(counts)] + np.cumsum(counts)
    return _rows(control, np.cumsum(quads)), _rows(data, reached)


def unpack_rows(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The inverse of ``pack_rows``: the numbers of all rows, end to end."""
    filled = _filled(counts, -(-counts // 4))
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[filled]
    values = np.zeros((len(lengths), 4), dtype=np.uint8)
    values[np.arange(4, dtype=np.uint8) < lengths[:, None]] = np.frombuffer(data, dtype=np.uint8)
    return values.view("<u4").ravel()


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of one row."""
    control, data = pack_rows(values, np.array([len(values)]))
    return control[0].as_py(), data[0].as_py()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The inverse of ``pack``."""
    return unpack_rows(control, data, np.array([count]))


def _rows(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that end at these places of ``flat``."""
    offsets = np.concatenate([[0], ends])
    if offsets[-1] < 2**31:
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat)])
    return pa.array([flat[a:b].tobytes() for a, b in zip(offsets, offsets[1:])], pa.binary())


def encoder(path: str) -> ChunkEncoder:
    """By the tokenizers library, which is asked once per distinct chunk."""
    library = library_tokenizer(path)

    sizes = np.array([len(t) for t in vocabulary(path).bytes_of], dtype=np.int64)

    def encode_new(chunks: list[str], joinable: bool) -> tuple[np.ndarray, np.ndarray]:
        if joinable:
            # Put end to end the chunks cost the library a few calls; which ids
            # are whose shows in the bytes they stand for.
            runs = ["".join(chunks[at : at + 500]) for at in range(0, len(chunks), 500)]
            ids, _ = flattened([e.ids for e in library.encode_batch_fast(runs, add_special_tokens=False)])
            ends = np.cumsum(pc.binary_length(pa.array(chunks, pa.string())).to_numpy(), dtype=np.int64)
            reached = np.cumsum(sizes[ids])
            last = np.searchsorted(reached, ends)
            if (reached[np.minimum(last, len(reached) - 1)] == ends).all():
                return ids, np.diff(np.concatenate([[0], last + 1]))
        return flattened([e.ids for e in library.encode_batch_fast(chunks, add_special_tokens=False)])

    return ChunkEncoder(vocabulary(path), encode_new, 2 * SIZE_KEPT)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield batch.slice(at, TEXTS_AT_ONCE)


def _plain_type(path: str) -> np.dtype:
    return np.dtype("<u2" if len(vocabulary(path).bytes_of) <= 1 << 16 else "<u4")


def plain_ids(df: DataFrame, path: str, end_id: int, key: str, text: str) -> DataFrame:
    """``(key, __order, n_tokens, plain)``: a hash of the text, the number of its ids
    and the ids, closed by ``end_id``, as compressed bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, kind = pa.Codec("zstd", compression_level=1), _plain_type(path)
        with of_one_task(encoder(path)) as own:
            for part in by_bytes(batches, text, TEXT_AT_ONCE):
                ids, counts = own.encode_flat(part.column(text))
                ends = np.cumsum(counts + 1)
                closed = np.full(len(ids) + len(counts), end_id, dtype=kind)
                closed[gathered(ends - counts - 1, counts)] = ids
                plain = [codec.compress(c, asbytes=True) for c in np.split(closed, ends[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), part.column("__order"), pa.array(counts + 1), pa.array(plain, pa.binary())],
                    [key, "__order", "n_tokens", "plain"],
                )

    kind = df.schema[key].dataType.simpleString()
    hashed = df.select(key, F.xxhash64(text).alias("__order"), text)
    return hashed.mapInArrow(run, f"`{key}` {kind}, __order bigint, n_tokens bigint, plain binary")


def _plain(part: pa.RecordBatch, path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows, end to end, and how many each has."""
    codec, kind = pa.Codec("zstd"), _plain_type(path)
    counts = part.column("n_tokens").to_numpy()
    rows = zip(part.column("plain"), counts.tolist(), strict=True)
    raw = [codec.decompress(p.as_buffer(), n * kind.itemsize, asbytes=True) for p, n in rows]
    return np.frombuffer(b"".join(raw), dtype=kind), counts


def id_ranks(encoded: DataFrame, path: str) -> np.ndarray:
    """Rank of each id by its frequency in the rows of ``plain_ids``, ties by id.

    Ids are counted where the rows lie; a task sends a row per id, and the
    ranking is over the vocabulary, whatever the size of the corpus.
    """
    size = len(vocabulary(path).bytes_of)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(size, dtype=np.int64)
        for part in _parts(batches):
            totals += np.bincount(_plain(part, path)[0], minlength=size)
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[seen])], ["id", "n"])

    rows = encoded.select("n_tokens", "plain")
    counted = rows.mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    totals = np.zeros(size, dtype=np.int64)
    for row in counted.collect():
        totals[row["id"]] = row["n"]
    ranks = np.empty(size, dtype=np.int32)
    ranks[np.lexsort((np.arange(size), -totals))] = np.arange(size)
    return ranks


def write_ids(
    df: DataFrame, folder: str, path: str, end_id: int = 2, key: str = "doc_id", text: str = "text"
) -> None:
    """Write the ids of every text, closed by ``end_id``, in ascending order of
    ``key``.

    ``folder/ids`` holds one record per document: its key, the number of ids, the
    part it lies in, the ids before it in that part, control bytes and data bytes
    of the ranks of its ids; files and records follow the order of the key.
    ``folder/ranks`` holds the id of each rank. NULL keys come first; documents
    with equal keys are ordered by a hash of their text. NULL texts have the end id alone.

    Texts are encoded once; their plain ids are written, compressed, to a folder of
    their own, from which they are counted and then sorted in place of the texts.
    """
    spark = df.sparkSession
    encoded = written(plain_ids(df, path, end_id, key, text), "plain-ids")
    ranks = id_ranks(encoded, path)
    by_rank = np.argsort(ranks)
    table = pa.table({"rank": np.arange(len(by_rank)), "id": by_rank})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{folder}/ranks")
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, before = TaskContext.get().partitionId(), 0
        for part in _parts(batches):
            ids, counts = _plain(part, path)
            starts = before + np.cumsum(counts) - counts
            before += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(key),
                    part.column("n_tokens"),
                    pa.array(np.full(len(counts), own, dtype=np.int32)),
                    pa.array(starts),
                    *pack_rows(shared.value[ids], counts),
                ],
                [key, "n_tokens", "part", "before", "control", "data"],
            )

    kind = df.schema[key].dataType.simpleString()
    # By a hash of the text: sampled keys, texts among them, go to the driver.
    ordered = encoded.sort(key, "__order")
    records = ordered.mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, part int, before bigint, control binary, data binary"
    )
    records.write.option("compression", "none").parquet(f"{folder}/ids")


def read_ids(spark, folder: str, key: str = "doc_id", digest: bool = False) -> DataFrame:
    """The documents of ``write_ids``: ``(key, start, n_tokens, ids)``, where
    ``start`` counts the ids of all documents before; with ``digest`` the crc32 of
    the ids as little-endian 32-bit numbers, ``ids_crc32``, in place of them."""
    ranked = spark.read.parquet(f"{folder}/ranks").orderBy("rank").toPandas()
    shared = spark.sparkContext.broadcast(ranked["id"].to_numpy(dtype=np.uint32))
    records = spark.read.parquet(f"{folder}/ids")
    # A row per part: their number is that of the sort's ranges.
    so_far = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        records.groupBy(F.col("part").alias("__part"))
        .agg(F.sum("n_tokens").alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(so_far), F.lit(0)).alias("__first"))
    )
    placed = records.join(F.broadcast(parts), F.col("part") == F.col("__part")).select(
        key, (F.col("__first") + F.col("before")).alias("start"), "n_tokens", "control", "data"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            counts = batch.column("n_tokens").to_numpy()
            coded = [b"".join(batch.column(c).to_pylist()) for c in ("control", "data")]
            flat = shared.value[unpack_rows(*coded, counts)]
            ids = np.split(flat, np.cumsum(counts)[:-1])
            if digest:
                last = pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64())
            else:
                last = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), batch.column("start"), batch.column("n_tokens"), last],
                [key, "start", "n_tokens", "ids_crc32" if digest else "ids"],
            )

    kind = records.schema[key].dataType.simpleString()
    out = "ids_crc32 bigint" if digest else "ids array<int>"
    return placed.mapInArrow(run, f"`{key}` {kind}, start bigint, n_tokens bigint, {out}")


def through_files(df: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write the ids to a new folder of the shared ones and read their digests."""
    folder = new_folder(df.sparkSession, "token-files")
    write_ids(df, folder, path, end_id)
    return read_ids(df.sparkSession, folder, digest=True)
