"""Packing by power-of-two decomposition.

A document's ids (its tokens and an end id) are cut into full pieces of ``max_length`` and the binary pieces
of what remains: 1,000 = 512 + 256 + 128 + 64 + 32 + 8. Each piece is a sequence of its own, so none crosses
documents and none needs padding; sequences of equal length form a bucket, from which batches are drawn.
The top bits of ``sequence_id`` are the bucket, so a bucket is one range of ids.

Cutting needs only the document itself: one pass over the table, no shuffle, whatever the skew.

Defined cases: a null or empty text has the end id alone (one piece of length 1); a null ``doc_id`` is kept;
repeated rows are packed each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .encoding import encode
from .scratch import released, table

_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"
_FLUSH = 8 << 20


def piece_lengths(n: int, max_length: int) -> list[int]:
    """Full pieces first, then the binary digits of the rest, largest first."""
    full, rest = divmod(n, max_length)
    return [max_length] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, max_length: int = 1024, end_id: int = 0, ranks_path: str | None = None) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian uint32), doc_tokens, bucket
    (log2 of the length), sequence_id, offset (0: a piece is a sequence). ``max_length`` is a power of two."""
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")

    def cut(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())])
        cols, held = [[] for _ in schema], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = np.append(encode(text.as_py(), ranks_path), end_id).astype("<u4")
                start = 0
                for n in piece_lengths(len(ids), max_length):
                    for c, v in zip(cols, (doc_id.as_py(), start, n, ids[start : start + n].tobytes(), len(ids))):
                        c.append(v)
                    start += n
                held += ids.nbytes
                if held > _FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
                    cols, held = [[] for _ in schema], 0
        if cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(cut), _PIECES)
    return pieces.withColumn("bucket", F.round(F.log2("length")).cast("int")).withColumn(
        # 5 bits of bucket above Spark's partition and row numbers
        "sequence_id", F.shiftleft(F.col("bucket").cast("long"), 58) + F.monotonically_increasing_id()
    ).withColumn("offset", F.lit(0).cast("long"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pack(table(spark, sf_dir, "documents"))
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
