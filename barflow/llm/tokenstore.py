"""Token files: ids compressed per document with one shared zstandard dictionary.

A store is a folder with two Parquet tables. ``dictionary`` has one row, the
dictionary trained on serialized ids of sample documents, and its SHA-256.
``shards`` has a row per run of documents in ascending id order: the compressed
documents one after the other in ``payload``, and the index to them (ids,
stops in the payload, token counts, the dictionary's hash), in columns of its
own, so that an index read leaves the payload on disk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barflow.llm.common import ARROW, NULL_ID, row_id
from barflow.llm.tokens import default_path, encoder

END_ID = 2
#: The dictionary is trained on so many documents at most (the first by a hash of the id), so many bytes of ids each.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 2_000, 4_096, 64 << 10
#: A shard ends when its payload has so many bytes.
SHARD_BYTES = 2 << 20
LEVEL = 1
_SHARD = ("part int, shard int, dictionary string, before long, doc_ids array<long>, stops array<long>, "
          "n_tokens array<long>, payload binary")


def _width(path: str) -> str:
    return "<u2" if encoder(path).size <= 1 << 16 else "<u4"


def _serialized(path: str, texts: list[str | None], end_id: int) -> Iterator[np.ndarray]:
    width, end = _width(path), np.array([end_id], "<u4").tobytes()
    for ids in encoder(path).encode_all(texts):
        yield np.frombuffer(ids + end, "<u4").astype(width)


def _samples(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([pa.array([x.tobytes()[:SAMPLE_BYTES]
                                             for x in _serialized(path, b.column(0).to_pylist(), end_id)], pa.binary())], names=["ids"])
    return run


def train_dictionary(docs: DataFrame, path: str, end_id: int) -> bytes:
    """From a bounded sample; with too little to train on, no dictionary."""
    order = F.xxhash64("id")
    first = docs.select(order.alias("h")).orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]  # ids alone
    if first is None:
        return b""
    chosen = docs.filter(order <= F.lit(first)).orderBy(order, "id", F.xxhash64("text")).limit(SAMPLE_DOCS).select("text")
    samples = [bytes(r["ids"]) for r in chosen.mapInArrow(_samples(path, end_id), "ids binary").collect()]
    total = sum(map(len, samples))
    if len(samples) < 16 or total < 8 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


def _shards(path: str, end_id: int, dictionary: bytes):
    name = hashlib.sha256(dictionary).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_content_size=True)
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        ids, counts, stops, payload, size = [], [], [], [], 0

        def row():
            values = ([part], [shard], [name], [before], [ids], [stops], [counts], [b"".join(payload)])
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary())
            return pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds)],
                                   names=[x.split()[0] for x in _SHARD.split(", ")])
        for b in batches:
            for doc, tokens in zip(b.column(0).to_pylist(), _serialized(path, b.column(1).to_pylist(), end_id)):
                frame = packer.compress(tokens.tobytes())
                size += len(frame)
                ids.append(doc), counts.append(len(tokens)), stops.append(size), payload.append(frame)
                if size >= SHARD_BYTES:
                    yield row()
                    shard, before = shard + 1, before + sum(counts)
                    ids, counts, stops, payload, size = [], [], [], [], 0
        if ids:
            yield row()
        encoder(path).forget()
    return run


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
          end_id: int = END_ID) -> None:
    """Encode every text, end it with ``end_id`` and write the store.

    Null or empty text is the end id alone. Null ids stand first. Rows that
    repeat an id are kept each, ordered by a hash of their text. An empty table
    makes a store without shards; other columns are ignored."""
    spark = docs.sparkSession
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    path = tokenizer or default_path()
    rows = docs.select(row_id(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dictionary = train_dictionary(rows, path, end_id)
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))],
                          "dictionary string, data binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    (dealt.select("id", "text").mapInArrow(_shards(path, end_id, dictionary), _SHARD)
     .write.option("compression", "uncompressed").parquet(f"{folder}/shards"))


def _load(spark: SparkSession, folder: str) -> tuple[DataFrame, bytes]:
    dictionary = spark.read.parquet(f"{folder}/dictionary").first()
    if hashlib.sha256(dictionary["data"]).hexdigest() != dictionary["dictionary"]:
        raise ValueError(f"{folder}: the dictionary doesn't have the hash it was stored under")
    return spark.read.schema(_SHARD).parquet(f"{folder}/shards"), bytes(dictionary["data"])


def _documents(dictionary: bytes, width: str):
    name = hashlib.sha256(dictionary).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress
        for b in batches:
            for r in b.to_pylist():
                if r["dictionary"] != name:
                    raise ValueError("a shard was written with another dictionary")
                start, ids, starts, counts, data, size = r["before"], [], [], [], [], 0
                for doc, a, z, n in zip(r["doc_ids"], [0, *r["stops"]], r["stops"], r["n_tokens"]):
                    if "wanted" not in r or doc in r["wanted"]:
                        tokens = np.frombuffer(unpack(r["payload"][a:z]), width).astype("<u4")
                        ids.append(doc), starts.append(start), counts.append(len(tokens)), data.append(tokens.tobytes())
                        size += tokens.nbytes
                    start += n
                    if size > 4 << 20 or (z == r["stops"][-1] and ids):
                        yield pa.record_batch([pa.array(x, k) for x, k in zip(
                            (ids, starts, counts, data), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                            names=["doc_id", "start", "n_tokens", "ids"])
                        ids, starts, counts, data, size = [], [], [], [], 0
    return run


def read(spark: SparkSession, folder: str, only: list[int] | None = None, tokenizer: str | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of all documents or of those in
    ``only``: ``start`` counts the ids of all documents before, ``ids`` are
    little-endian unsigned 32-bit integers. With ``only``, the index picks the
    shards, and of their payloads only these documents are decompressed."""
    for key, value in ARROW.items():  # a few shards make a batch's bytes
        spark.conf.set(key, value)
    shards, dictionary = _load(spark, folder)
    # tokens before each part: one row per part of the store
    parts = shards.groupBy("part").agg(F.sum(F.expr("aggregate(n_tokens, 0L, (a, x) -> a + x)")).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    if only is not None:
        wanted = F.array(*[F.lit(x).cast("long") for x in only])
        shards = shards.filter(F.arrays_overlap("doc_ids", wanted)).withColumn("wanted", wanted)
    rows = shards.join(parts, "part").withColumn("before", F.col("before") + F.col("offset")).drop("offset", "part", "shard")
    out = rows.mapInArrow(_documents(dictionary, _width(tokenizer or default_path())),
                          "doc_id long, start long, n_tokens long, ids binary")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))
