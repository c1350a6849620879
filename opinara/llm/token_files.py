"""Token ids in binary shards with a shared zstandard dictionary (operator 2).

A shard holds the documents of one range of ids in ascending order. Each document is
compressed by itself, with a dictionary trained on serialized id arrays, so one short
document is read by one small range request and still compresses well.

    shard        magic, SHA-256 of the dictionary, frame of each document
    dictionary   the trained bytes; a shard read with another dictionary is refused
    index        Parquet: shard, place, doc_id, offset, length, n_tokens, width

The index is committed by Spark. A task that is repeated writes a shard of a new name, and a
shard that no index row names does not count, so lost executors leave no half results.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from opinara.llm.tokenization import Encoder, encoder
from opinara.session import cut_lineage, scratch_path

MAGIC = b"TOKIDS01"
HEADER = len(MAGIC) + 32
DEFAULT = "byte_bpe_50k.json"
END_ID = 2
#: The dictionary is trained on about so many documents (chosen by a hash of their id) of at
#: most so many characters: it serves short documents, long ones bring their own statistics.
SAMPLE_DOCUMENTS, SAMPLE_CHARS, DICTIONARY_BYTES = 1_000, 8_192, 65_536
#: A shard is closed when it is longer than this.
SHARD_BYTES = 64 << 20
LEVEL = 3
_SPACE = 1 << 30


def _filesystem(uri: str):
    """File system and path of a folder all executors reach; any scheme Arrow knows."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _tools(dictionary: bytes):
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return (zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=True),
            zstandard.ZstdDecompressor(dict_data=data))


def train_dictionary(rows: DataFrame, path: str) -> bytes:
    """Bytes of a dictionary for ``rows`` (``doc_id, text``); none if there is too little text.

    The sample is bounded by the module's constants. One task encodes it and trains, so that neither the
    tokenizer nor the trainer takes memory of the driver, which gets the dictionary alone.
    """
    n = rows.count()
    share = min(_SPACE, _SPACE * SAMPLE_DOCUMENTS // max(n, 1))
    sample = (rows.filter((F.pmod(F.xxhash64("doc_id"), F.lit(_SPACE)) < share)
                          & F.char_length("text").between(1, SAMPLE_CHARS))
              .select("text").limit(2 * SAMPLE_DOCUMENTS).coalesce(1))
    size = DICTIONARY_BYTES

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Encoder(path)  # not kept by the worker
        arrays = [ids[a:b].tobytes() for batch in batches for _, ids, at in model.encode(batch.column("text")) for a, b in zip(at, at[1:])]
        try:
            dictionary = zstandard.train_dictionary(size, arrays).as_bytes()
        except zstandard.ZstdError:
            dictionary = b""
        yield pa.RecordBatch.from_arrays([pa.array([dictionary], pa.binary())], names=["dictionary"])

    trained = sample.mapInArrow(train, "dictionary binary").first()
    return bytes(trained["dictionary"]) if trained else b""


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, and write ``folder`` in ascending id order.

    Null text counts as empty: the document has the end id alone. Rows of one id stand next
    to each other; a null id comes first. Other columns are ignored whatever their names. No
    rows give an empty index and no shard.
    """
    path = tokenizer or public_tokenizers.path(DEFAULT)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    dictionary = train_dictionary(rows, path)
    fs, top = _filesystem(folder)
    fs.create_dir(f"{top}/shards", recursive=True)
    with fs.open_output_stream(f"{top}/dictionary") as file:
        file.write(dictionary)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (packer, _) = encoder(path), _tools(dictionary)
        for batch in batches:
            for first, ids, at in model.encode(batch.column("text")):
                n = np.diff(at) + 1
                # room for the end id behind each document
                whole = np.full(len(ids) + len(n), end_id, model.dtype)
                whole[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n - 1)] = ids
                ends = np.cumsum(n)
                frames = [packer.compress(whole[e - k:e].tobytes()) for e, k in zip(ends, n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(n)), pa.array(n, pa.int64()),
                     pa.array(frames, pa.binary()), pa.array(np.full(len(n), model.dtype.itemsize, np.int32))],
                    names=["doc_id", "n_tokens", "frame", "width"])

    # frames are a third of the texts: they are what is sorted, and they are encoded once
    frames = cut_lineage(rows.mapInArrow(compress, "doc_id long, n_tokens long, frame binary, width int"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _filesystem(folder)
        digest, part, number, file, size, place = hashlib.sha256(dictionary).digest(), TaskContext.get().partitionId(), 0, None, 0, 0
        try:
            for batch in batches:
                lengths = batch.column("frame").to_pylist()
                names, places, offsets = [], [], []
                for frame in lengths:
                    if file is None or size > SHARD_BYTES:
                        if file is not None:
                            file.close()
                        name = f"{part:08d}-{number:04d}-{uuid.uuid4().hex}"
                        file = fs.open_output_stream(f"{top}/shards/{name}")
                        file.write(MAGIC + digest)
                        size, place, number = HEADER, 0, number + 1
                    names.append(name)
                    places.append(place)
                    offsets.append(size)
                    file.write(frame)
                    size, place = size + len(frame), place + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(places, pa.int64()), batch.column("doc_id"),
                     pa.array(offsets, pa.int64()), pa.array([len(f) for f in lengths], pa.int64()),
                     batch.column("n_tokens"), batch.column("width")],
                    names=["shard", "place", "doc_id", "offset", "length", "n_tokens", "width"])
        finally:
            if file is not None:
                file.close()

    (frames.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "n_tokens", "frame")
     .mapInArrow(shards, "shard string, place long, doc_id long, offset long, length long, n_tokens long, width int")
     .write.parquet(f"{folder}/index"))


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def _read_frames(rows: DataFrame, folder: str, finish, schema: str) -> DataFrame:
    """``finish(batch, id arrays)`` over index rows; rows of a shard should come together."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _filesystem(folder)
        with fs.open_input_stream(f"{top}/dictionary") as file:
            dictionary = file.read()
        digest, (_, unpacker), name, file = hashlib.sha256(dictionary).digest(), _tools(dictionary), None, None
        for batch in batches:
            arrays = []
            for shard, offset, length, width in zip(*[batch.column(c).to_pylist()
                                                      for c in ("shard", "offset", "length", "width")]):
                if shard != name:
                    if file is not None:
                        file.close()
                    name, file = shard, fs.open_input_file(f"{top}/shards/{shard}")
                    if file.read(HEADER) != MAGIC + digest:
                        raise ValueError(f"shard {shard} was written with another dictionary")
                file.seek(offset)
                arrays.append(np.frombuffer(unpacker.decompress(file.read(length)), f"<u{width}"))
            yield finish(batch, arrays)
        if file is not None:
            file.close()

    return rows.mapInArrow(read, schema)


def read_documents(index: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, ids)`` of index rows: all of them, or those a filter or join has left."""
    def finish(batch, arrays):
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([a.astype(np.int32) for a in arrays], pa.list_(pa.int32()))],
            names=["doc_id", "ids"])
    return _read_frames(index.sortWithinPartitions("shard", "offset"), folder, finish, "doc_id long, ids array<int>")


def token_table(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it. Each task reads runs of
    documents that stand behind each other in a file.
    """
    index = read_index(spark, folder)
    along = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard: what a single task sums is a list of files
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))

    def finish(batch, arrays):
        crc = [zlib.crc32(a.astype("<u4").tobytes()) for a in arrays]
        return pa.RecordBatch.from_arrays(
            [batch.column("shard"), batch.column("place"), batch.column("doc_id"),
             pa.array([len(a) for a in arrays], pa.int64()), pa.array(crc, pa.int64())],
            names=["shard", "place", "doc_id", "n_tokens", "ids_crc32"])

    # the index is small next to the files: without this few tasks would read all of them
    tasks = max(index.select("shard").distinct().count(),
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    runs = index.repartitionByRange(tasks, "shard", "place").sortWithinPartitions("shard", "place")
    read = _read_frames(runs, folder, finish,
                        "shard string, place long, doc_id long, n_tokens long, ids_crc32 long")
    inside = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return (read.withColumn("until", F.sum("n_tokens").over(inside)).join(shards, "shard")
            .select("doc_id", (F.col("before") + F.col("until") - F.col("n_tokens")).alias("start"),
                    "n_tokens", "ids_crc32"))


def tokenized(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back as a table."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, folder, **options)
    return token_table(docs.sparkSession, folder)
