"""Token ids of a corpus as compressed segments, in ascending document order.

``write`` range-partitions the documents by id, encodes each partition's texts and packs
whole documents into segments (see ``context_coder``).  A segment is a row of a Parquet
table: Spark's commit protocol makes a lost executor or a repeated task harmless.
``read`` decodes the segments independently; only the numbers of ids per partition are
summed over the corpus to tell where a document starts.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import context_coder, words
from .scratch import batches_of, bound_batches
from .tokens import PieceEncoder

SEGMENT_IDS = 512 * context_coder.BLOCK  # a segment ends with the document that passes this

SEGMENTS = T.StructType(
    [
        T.StructField("part", T.LongType()),
        T.StructField("segment", T.LongType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("part", "segment", "n_docs", "n_tokens")] + [("payload", pa.binary())]
)


def default_tokenizer() -> str:
    """The installed byte-level vocabulary; every worker has the same package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=1)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _segments(path: str, end_id: int, segment_ids: int):
    def run(batches):
        encoder = _encoder(path)
        part, number = TaskContext.get().partitionId(), 0
        names, ids, sizes, held = [], [], [], 0

        def row():
            packed = context_coder.pack(np.concatenate(ids), names, np.concatenate(sizes))
            columns = [[part], [number], [len(names)], [held], [packed]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
            )

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for low, high, data, offsets in words.chunks(batch.column(1), 1 << 20):
                got, counts = encoder.encode(data, offsets)
                ends = np.cumsum(counts)
                ids.append(np.insert(got, ends, np.uint32(end_id)))
                names += doc_ids[low:high]
                sizes.append(counts + 1)
                held += int(counts.sum()) + high - low
                if held >= segment_ids:
                    yield row()
                    names, ids, sizes, held, number = [], [], [], 0, number + 1
        if names:
            yield row()

    return run


def segments(
    docs: DataFrame, tokenizer: str, end_id: int = 2, segment_ids: int = SEGMENT_IDS
) -> DataFrame:
    """The segments of ``docs`` (``doc_id``, ``text``); other columns are not looked at.

    Null and empty texts hold the end id alone.  Documents without id come first; rows
    that repeat an id follow each other in the order of their texts.
    """
    bound_batches(docs.sparkSession)
    chosen = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    sorted_docs = chosen.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return sorted_docs.mapInArrow(_segments(tokenizer, end_id, segment_ids), SEGMENTS)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    segments(docs, tokenizer, end_id).write.parquet(path)


_READ = "doc_id long, part long, segment long, place long, n_tokens long, ids_crc32 long"
_READ_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "part", "segment", "place", "n_tokens", "ids_crc32")]
)


def _documents(batches):
    add, flush = batches_of(_READ_ARROW, 4000)
    for batch in batches:
        for part, segment, payload in zip(*(c.to_pylist() for c in batch.columns)):
            ids, names, sizes = context_coder.unpack(payload)
            place = 0
            for name, size in zip(names, sizes.tolist()):
                check = zlib.crc32(ids[place : place + size])
                if (out := add((name, part, segment, place, size, check))) is not None:
                    yield out
                place += size
    yield flush()


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the segments.

    ``start`` is the number of ids of all documents before; ``ids_crc32`` is over the
    ids as little-endian unsigned 32-bit integers.  Raises if a checksum is wrong.
    """
    table = spark.read.schema(SEGMENTS).parquet(path)
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the writing job: their number does not follow the rows.
    across = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = table.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    parts = parts.select("part", F.coalesce(F.sum("held").over(across), zero).alias("before"))
    offsets = (
        table.select("part", "segment", F.coalesce(F.sum("n_tokens").over(within), zero).alias("inside"))
        .join(parts, "part")
        .select("part", "segment", (F.col("before") + F.col("inside")).alias("offset"))
    )
    found = table.select("part", "segment", "payload").mapInArrow(_documents, _READ)
    return found.join(offsets, ["part", "segment"]).select(
        "doc_id", (F.col("offset") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )
