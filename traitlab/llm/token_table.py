"""Token-id tables: Simple-8b blocks in document order, written and read by Spark.

``write_tokens`` orders documents by id with a range shuffle of their texts,
encodes each range in its task, and writes one Parquet row per block: the
range and block numbers, the ids and lengths of its documents, and the block
itself. Any reader can decode a block alone; no task holds more than a batch
of texts and one block's ids.

``read_tokens`` decodes blocks in parallel. The position of a document is the
sum of three counts: ids of earlier ranges (one number per range), of earlier
blocks in the range, and of earlier documents in the block.

Defined results: null or empty text has only the end id; a null id comes
first; equal ids are ordered by a hash of the text, and rows equal in both are
alike; an empty table gives an empty table; only the id column is carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..operators.ordering import shuffle_width
from . import simple8b
from .common import broadcast_if_small
from .subwords import VOCABULARY, encoder

END_ID = 0
# A block is closed once it holds this many ids.
BLOCK_IDS = 1 << 16
# Bytes of text encoded at a time: each time, all units met before are indexed anew.
CHUNK_BYTES = 8 << 20


def write_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 vocabulary: str = VOCABULARY) -> None:
    """Write the token table of ``docs`` to ``path``."""
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(docs.schema[doc_id].dataType)),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("data", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, block = encoder(vocabulary), TaskContext.get().partitionId(), 0
        docs_held: list = []
        ids_held: list[np.ndarray] = []
        held = 0
        out = None

        def close():
            nonlocal block, held
            row = [[part], [block], [held], [list(docs_held)], [[len(x) for x in ids_held]],
                   [simple8b.encode(np.concatenate(ids_held))]]
            block, held = block + 1, 0
            docs_held.clear()
            ids_held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(row, out, strict=True)], schema=out)

        for batch in batches:
            if out is None:
                out = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()),
                                 ("doc_ids", pa.list_(batch.schema.field(0).type)),
                                 ("lengths", pa.list_(pa.int64())), ("data", pa.binary())])
            docs_here = batch.column(0).to_pylist()
            for row, ids, offsets in coder.chunks(batch.column(1), chunk_bytes=CHUNK_BYTES):
                for n in range(len(offsets) - 1):
                    own = np.append(ids[offsets[n]:offsets[n + 1]], np.uint16(END_ID))
                    docs_held.append(docs_here[row + n])
                    ids_held.append(own)
                    held += len(own)
                    if held >= BLOCK_IDS:
                        yield close()
        if docs_held:
            yield close()

    spark = docs.sparkSession
    ranges = shuffle_width(spark)
    order = [F.col("doc"), F.xxhash64("text")]
    (docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
     .repartitionByRange(ranges, *order).sortWithinPartitions(*order)
     .mapInArrow(run, schema).write.parquet(path))


def read_tokens(spark: SparkSession, path: str, doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc id, ``start``, ``ids`` as little-endian 32-bit binary) of a table."""
    blocks = spark.read.parquet(path)
    counts = blocks.select("part", "block", "n_ids")
    # one row per range: bounded by the number of partitions written
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counts.withColumn("in_part", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
              .join(F.broadcast(parts), "part")
              .select("part", "block", (F.col("part_start") + F.col("in_part")).alias("block_start"))
              .checkpoint())
    id_type = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField(doc_id, id_type), T.StructField("start", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                block_start, doc_ids, lengths = (batch.column(c)[n] for c in range(3))
                lengths = lengths.values.to_numpy()
                ids = simple8b.decode(batch.column(3)[n].as_py()).astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(block_start.as_py() + ends - lengths),
                     pa.Array.from_buffers(pa.binary(), len(lengths), [
                         None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids)])],
                    names=[doc_id, "start", "ids"])

    # a block meets its one row of starts before it is decoded
    return (blocks.join(broadcast_if_small(starts), ["part", "block"])
            .select("block_start", "doc_ids", "lengths", "data").mapInArrow(run, schema))
