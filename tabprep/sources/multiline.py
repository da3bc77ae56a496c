"""CSV files with line breaks inside quoted cells, read by many tasks.

A line break ends a row if an even number of quotes stands before it in its file. Tasks read physical lines by blocks; one
count of quotes for each block says whether it begins inside a cell. So each task knows where rows really end, and only the parts of
rows that cross blocks are brought together.
"""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.materialize import materialize
from tabprep.sources.csv import _parsed, _without_tokens

_PLACE = ["path", "block"]


def scan_multiline_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """As ``scan_csv(..., multi_line=True)`` with a schema, but a file is no single task's.

    The header is the first row of each file; a row with too few or too many cells, or a cell that doesn't fit its type, raises. Line breaks
    inside cells become line feeds, blank rows are passed over, and a file that ends inside a cell raises.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = [f.name for f in schema.fields]
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    records = _records(spark, path)
    cells = T.StructType([*texts.fields, T.StructField("more", T.StringType()), T.StructField("bad", T.StringType())])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", "lineSep": "\n"}
    # A mark after the end of each row must be the cell after the last.
    parsed = records.select("header", F.from_csv(F.concat("text", F.lit(",\u0001")), cells.simpleString(), options).alias("r"))
    last = F.col("r.more")
    wrong = F.raise_error(F.concat(F.lit("a row has too few or too many cells: "), F.coalesce(F.col("r.bad"), F.col("r.c0"), F.lit("")))).cast("string")
    checked = F.when(last == "\u0001", F.col("r.c0")).otherwise(wrong)
    rows = parsed.where("NOT header").select(checked.alias(names[0]), *[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names) if i])
    heads = parsed.where("header").select(*[F.col(f"r.c{i}").alias(f"c{i}") for i in range(len(names))], last.alias("last")).distinct().limit(2).collect()
    if any(list(h)[:-1] != names or h["last"] != "\u0001" for h in heads):
        raise ValueError(f"the header of {path} isn't {names}")
    present = _without_tokens(rows)
    return present.select(*[_parsed(f.name, f.dataType).alias(f.name) for f in schema.fields])


def _records(spark: SparkSession, path: str) -> DataFrame:
    """``header, text``: the rows of the files as text, without their ends."""
    lines = spark.read.option("lineSep", "\n").text(path)
    placed = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = placed.groupBy(*_PLACE).agg(F.sum(quotes).alias("quotes"))
    ahead = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    starts = blocks.select(
        *_PLACE,
        (F.coalesce(F.sum("quotes").over(ahead), F.lit(0)) % 2 == 1).alias("inside"),
        (F.min("block").over(whole) == F.col("block")).alias("first"),
        (F.sum("quotes").over(whole) % 2 == 1).alias("open"),
    )
    starts = materialize(starts)
    if not starts.where("open").isEmpty():
        raise ValueError(f"a file of {path} ends inside a cell")
    # One row for each block of a file; as ordinary a join as its size asks for, in which lines keep their order.
    known = placed.join(F.broadcast(starts.drop("open")), _PLACE)

    def gather(batches):
        """Whole rows; of those that cross blocks the parts: that which ends one (part 1), goes all through (1) or begins one (0)."""
        place, inside, held, header, part = None, False, [], False, None
        out = {k: [] for k in ("path", "block", "part", "header", "text")}

        def put(text, kind):
            for k, v in zip(out, (*place, kind, header, text)):
                out[k].append(v)

        def flush():
            made = pa.RecordBatch.from_arrays(
                [pa.array(out["path"], pa.string()), pa.array(out["block"], pa.int64()), pa.array(out["part"], pa.int32()), pa.array(out["header"], pa.bool_()), pa.array(out["text"], pa.string())],
                names=list(out),
            )
            for v in out.values():
                v.clear()
            return made

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("path", "block", "inside", "first", "value")]
            for own_path, block, begins_inside, first, line in zip(*columns):
                if (own_path, block) != place:
                    if held:
                        # Open at the end of a block: 0 begins a row, 2 goes on with one that began before.
                        put("\n".join(held), 0 if part is None else 2)
                    place, inside, held, header, part = (own_path, block), begins_inside, [], first, 1 if begins_inside else None
                held.append(line)
                inside ^= line.count('"') % 2 == 1
                if not inside:
                    text = "\n".join(held).removesuffix("\r").replace("\r\n", "\n")
                    if part == 1 or text:
                        put(text, -1 if part is None else 1)
                        header = header and part is not None
                    held, part = [], None
            if len(out["text"]) >= 5000:
                yield flush()
        if held:
            put("\n".join(held), 0 if part is None else 2)
        if out["text"]:
            yield flush()

    found = materialize(known.mapInArrow(gather, "path string, block bigint, part int, header boolean, text string"))
    ready = found.where("part = -1").select("header", "text")
    # A row's parts follow each other: the last row that begins before a part is its own.
    parts = found.where("part >= 0")
    order = Window.partitionBy("path").orderBy("block", F.when(F.col("part") == 0, 1).otherwise(0))
    row = F.sum(F.when(F.col("part") == 0, 1).otherwise(0)).over(order)
    pieces = F.sort_array(F.collect_list(F.struct("block", "text")))
    joined = parts.withColumn("row", row).groupBy("path", "row").agg(F.max(F.col("header") & (F.col("part") == 0)).alias("header"), pieces.alias("pieces"))
    text = F.replace(F.array_join(F.transform("pieces", lambda p: p["text"]), "\n"), F.lit("\r\n"), F.lit("\n"))
    return ready.unionAll(joined.select("header", text.alias("text")))
