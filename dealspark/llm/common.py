"""What the operators share: input tables, scratch tables, documents in blocks.

Conventions of every operator here:

* It selects the columns it names and ignores others, so extra columns cannot
  clash with its own names. Outputs hold exactly the documented columns.
* A null text is an empty text. A null id stays null in the result.
* Rows are documents of their own: a repeated row is one more copy.
* An empty table gives an empty result with the same columns.
* Intermediate tables go to ``spark.checkpoint.dir`` as Parquet, which cuts
  lineage and survives lost executors.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.sources.scratch import scratch_path as scratch
from dealspark.sources.scratch import stored

#: A null id inside packed int64 arrays (so this one id is reserved).
NULL_ID = -(2 ** 63)

#: Text bytes in a block: bounds what one Python step holds (longer texts get a block of their own).
BLOCK_BYTES = 2 << 20

BLOCK_SCHEMA = "block long, n_bytes long, ids binary, lens binary, blob binary, extra array<string>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send the library to the executors, once per application, in case they cannot import it."""
    context = spark.sparkContext
    if getattr(context, "_llm_shipped", False):
        return
    library = Path(__file__).parent.parent
    archive = Path(tempfile.mkdtemp(prefix="dealspark-package-")) / "dealspark_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(library.rglob("*.py")):
            z.write(source, source.relative_to(library.parent))
    context.addPyFile(str(archive))
    context._llm_shipped = True


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_array(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.int64())
    ids = column.fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    if (ids == NULL_ID).sum() > column.null_count:
        raise ValueError(f"the id {NULL_ID} stands for null ids; rows must not use it")
    return ids


def ids_out(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string (or binary) column, nulls empty: one uint8 array
    and the int64 offsets of its rows."""
    column = pa.array(column.to_pylist(), pa.large_binary()) if isinstance(column, pa.ChunkedArray) else column
    wide = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces_of(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (one row at least)."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        end = min(n, max(end, start + 1))
        yield start, end
        start = end


def blocks(docs: DataFrame, name: str, block_bytes: int = BLOCK_BYTES, extra: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (doc_id, text, and string columns ``extra``) packed into a
    stored table with one row per block of about ``block_bytes`` of text.

    Packing happens where a document is read, without a shuffle. The table is
    written once, so blocks keep their numbers and contents in all later
    passes, also after lost executors. It is bucketed by block, so ``answered``
    brings answers to blocks without moving texts.
    """
    def pack(batches):
        from pyspark import TaskContext
        base, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ids = id_array(batch.column(0))
            raw, offsets = text_bytes(batch.column(1))
            more = [batch.column(2 + k).to_pylist() for k in range(len(extra))]
            for a, b in pieces_of(offsets, block_bytes):
                blob = raw[offsets[a]:offsets[b]]
                flat = [v for i in range(a, b) for v in (m[i] for m in more)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([base + made]), pa.array([len(blob)]), pa.array([ids[a:b].tobytes()], pa.binary()),
                    pa.array([np.diff(offsets[a:b + 1]).astype(np.int64).tobytes()], pa.binary()),
                    pa.array([blob.tobytes()], pa.binary()), pa.array([flat], pa.list_(pa.string()))],
                    ["block", "n_bytes", "ids", "lens", "blob", "extra"])
                made += 1

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                         *[F.col(c).cast("string") for c in extra])
    return bucketed(picked.mapInArrow(pack, BLOCK_SCHEMA), name)


def bucketed(df: DataFrame, name: str, key: str = "block") -> DataFrame:
    """``stored``, and bucketed by ``key``: joins on it do not move these rows again."""
    spark = df.sparkSession
    path, table_name = scratch(spark, name), f"{name}_{uuid.uuid4().hex}"
    (df.write.option("compression", "zstd").option("path", path)
     .bucketBy(partitions(spark), key).saveAsTable(table_name))
    made = spark.table(table_name)
    made.schema  # resolved here; only the name goes, the files stay
    spark.sql(f"DROP TABLE {table_name}")
    return made


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, byte offsets and bytes of one block."""
    lens = np.frombuffer(row["lens"], np.int64)
    return (np.frombuffer(row["ids"], np.int64), np.concatenate([[0], np.cumsum(lens)]),
            np.frombuffer(row["blob"], np.uint8))


def answered(packed: DataFrame, answers: DataFrame, *, key: str = "block") -> DataFrame:
    """Each block with its row of ``answers`` (one per block at most); texts stay where they are."""
    return packed.join(answers.hint("shuffle_hash"), key, "left")
