"""What the document operators have in common: tables in the shared folder, Arrow batches cut to a size."""

from __future__ import annotations

import ctypes
from collections import Counter
from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tabprep.materialize import new_folder

# Text bytes that a task holds at a time; a longer single text is a batch of its own.
SHARD_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def temporary_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; what is written there goes when the session ends."""
    folder = new_folder(spark, name)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back.

    This cuts the lineage: a lost executor costs no more than rereading. ``forget`` deletes the
    table, else the end of the session does.
    """
    spark = df.sparkSession
    folder = temporary_folder(spark, name)
    df.write.mode("overwrite").option("compression", compression).parquet(folder)
    back = spark.read.schema(df.schema).parquet(folder)
    back._stored_at = folder
    return back


def forget(df: DataFrame) -> None:
    """Delete what ``stored`` wrote; the table must not be read any more."""
    delete_folder(df.sparkSession, df._stored_at)


def give_back() -> None:
    """Return free memory of this worker process to the system: it stays for later tasks, and others need the room."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SHARD_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` text bytes (one row at least)."""
    yield from _pieces(batches, column, limit)
    give_back()


def _pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = [0 if n is None else n for n in pa.compute.binary_length(batch.column(column)).to_pylist()]
        begin, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        yield batch.slice(begin)


def runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Consecutive rows of equal ``keys`` in a sorted stream, with those keys; a run that crosses batches comes in parts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = [batch.column(k).dictionary_encode().indices.to_numpy() for k in keys]
        change = np.any([c[1:] != c[:-1] for c in codes], axis=0)
        bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for begin, stop in zip(bounds, bounds[1:]):
            yield tuple(batch.column(k)[begin].as_py() for k in keys), batch.slice(begin, stop - begin)


def raw_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; a null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    """A string column; a null is empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def named(column: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def id_and_text(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that other columns can't clash with its own."""
    return df.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def within_bytes(sizes: Iterable[tuple[Hashable, int]], size: int) -> list[int]:
    """Of texts, given as ``(label, bytes)``, the places of as many as ``size`` bytes of each label have room for, in their order.

    A text over a hundredth of that waits until all others have had room, so that it can't crowd them out; a text
    without room is passed over. A label whose texts are all longer than ``size`` keeps its shortest one.
    """
    taken: list[int] = []
    waiting: list[tuple[int, int, Hashable]] = []
    shortest: dict[Hashable, tuple[int, int]] = {}
    held, found = Counter(), set()
    for at, (label, n) in enumerate(sizes):
        if n > size:
            shortest[label] = min(shortest.get(label, (n, at)), (n, at))
        elif n * 100 > size:
            waiting.append((at, n, label))
        elif held[label] + n <= size:
            held[label] += n
            taken.append(at)
            found.add(label)
    for at, n, label in waiting:
        if held[label] + n <= size:
            held[label] += n
            taken.append(at)
            found.add(label)
    return sorted([*taken, *(at for label, (_, at) in shortest.items() if label not in found)])


def sampled_texts(docs: DataFrame, labels: DataFrame, rows: int, size: int) -> tuple[list[Row], dict[Hashable, int]]:
    """Rows of ``docs`` (``doc_id, text`` and more) with their ``label``, and how many rows of ``labels`` (``doc_id, label``) each label has.

    At most ``rows`` ids of each label are drawn by a hash of the id; of their texts as many are taken as ``size`` bytes of
    each label have room for. Ids and lengths alone decide, so that no text beyond that size is gathered anywhere; a label whose drawn texts are
    all longer has its shortest one. An id with several texts gives its shortest. If ``docs`` has a ``label``, it must be the same.
    """
    labels = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").distinct()
    totals = {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    if not totals:
        return [], {}
    by_hash, whole = F.xxhash64("doc_id"), 1 << 40
    # Twice as many as are taken, so that only a few rows of each label have to be put in order.
    chance = F.create_map(*[F.lit(x) for v, n in totals.items() for x in (v, min(whole, int(2.0 * rows / n * whole) + 1))])
    drawn = labels.where(F.pmod(by_hash, F.lit(whole)) < F.element_at(chance, F.col("label")))
    first = Window.partitionBy("label").orderBy(by_hash, "doc_id")
    drawn = drawn.withColumn("place", F.row_number().over(first)).where(F.col("place") <= rows)
    keys = ["doc_id", "label"] if "label" in docs.columns else ["doc_id"]
    texts = docs.where("text IS NOT NULL").withColumn("bytes", F.octet_length("text"))
    # At most ``rows`` ids of each label.
    sizes = texts.join(F.broadcast(drawn), keys).groupBy("doc_id", "label", "place").agg(F.min("bytes").alias("bytes")).collect()
    sizes.sort(key=lambda r: (r["place"], r["label"]))
    chosen = [sizes[i] for i in within_bytes(((r["label"], r["bytes"]) for r in sizes), size)]
    if not chosen:
        return [], totals
    few = F.broadcast(docs.sparkSession.createDataFrame(chosen, drawn.withColumn("bytes", F.lit(0)).schema))
    found = texts.join(few, [*keys, "bytes"]).dropDuplicates(["doc_id", "label"]).collect()
    return sorted(found, key=lambda r: (r["place"], r["label"])), totals


def filtered(docs: DataFrame, text_column: str, keep: Callable[[pa.Array], list[bool]]) -> DataFrame:
    """The rows of ``docs`` for whose texts ``keep`` says so, batch by batch, with all columns whatever their names."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index(text_column)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            yield batch.filter(pa.array(keep(batch.column(text)), pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
