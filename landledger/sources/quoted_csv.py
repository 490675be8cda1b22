"""Split reading of CSV files whose quoted fields hold line breaks.

Whether a block of a file begins within quotes follows from the parity of the quote signs before it. The parities of
all blocks are counted first and summed up in order; then every block puts its own records together, and only the
pieces of records that reach over a block's edge meet. No task reads more than its block, however large the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landledger.storage import materialise

LONGEST = 64 << 20  # characters of a record within one block; more are taken for a stray quote sign
_PIECES = "file string, start long, place int, kind string, header boolean, record string"


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Lines in the order of their block, with file and start of the block."""
    text = F.col("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return spark.read.option("lineSep", "\n").text(path).select(
        text.alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def block_states(lines: DataFrame) -> DataFrame:
    """(file, start, inside, open): whether each block begins and ends within quotes; a row for each block.

    A file whose quote signs are odd in number raises.
    """
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"')))
    upto = Window.partitionBy("file").orderBy("start")
    states = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    states = states.select(
        "file", "start", (F.sum("odd").over(upto) % 2 != 0).alias("open"), ((F.sum("odd").over(upto) - F.col("odd")) % 2 != 0).alias("inside")
    )
    states = materialise(states, "csv-blocks")
    last = states.groupBy("file").agg(F.max_by("open", "start").alias("open")).filter("open").select("file").take(1)
    if last:
        raise ValueError(f"a quoted field is not closed in {last[0].file}")
    return states


def quoted_records(spark: SparkSession, path: str, encoding: str = "UTF-8", longest: int = LONGEST) -> DataFrame:
    """(file, header, record): the records of CSV files as text, line breaks in quotes kept, the first of a file marked.

    Quotes are doubled inside quotes, records end with a line feed, a carriage return before it belongs to the end.
    Empty lines are no records; an empty file has none. A record of which one block holds more than ``longest``
    characters raises, as does a file that ends within quotes. Blocks that begin or end within quotes are broadcast: one short
    row for each such block, so a few bytes for every ``spark.sql.files.maxPartitionBytes`` of input.
    """
    lines = _lines(spark, path, encoding)
    cut = block_states(lines).filter("inside OR open").select("file", "start", "inside")
    # a broadcast join leaves the lines of a block in their order
    known = lines.join(F.broadcast(cut), ["file", "start"], "left").select(
        "file", "start", "line", F.coalesce("inside", F.lit(False)).alias("inside"), F.col("inside").isNotNull().alias("cut")
    )

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("file", pa.string()), ("start", pa.int64()), ("place", pa.int32()), ("kind", pa.string()), ("header", pa.bool_()), ("record", pa.string())]
        )
        # `began`: the record in hand began in this block; `at`: number of the next line in it, `first` of the piece's
        block, parts, size, within, at, first, began = None, [], 0, False, 0, 0, True
        out: list[tuple] = []

        def close(kind: str):
            nonlocal parts, size, began
            out.append((*block, first, kind, block[1] == 0 and first == 0, "\n".join(parts)))
            parts, size, began = [], 0, True

        def finish():
            if parts:  # the block ends within quotes
                close("begin" if began else "middle")

        def pieces():
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            if not batch.num_rows:
                continue
            files, starts, lines, states = (batch.column(c) for c in ("file", "start", "line", "inside"))
            where = starts.to_numpy()
            new = where[1:] != where[:-1]
            if len(new):
                new |= pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)
            odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
            if pc.max(pc.utf8_length(lines)).as_py() >= longest:
                at_fault = int(np.argmax(pc.utf8_length(lines).to_numpy(zero_copy_only=False)))
                raise ValueError(f"a record of more than {longest} characters in {files[at_fault]}, block at {starts[at_fault]}")
            alone, number = np.zeros(len(where), bool), np.zeros(len(where), np.int32)
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(where)]
            for low, high in zip(edges, edges[1:]):
                key = (files[low].as_py(), int(where[low]))
                if block != key:
                    finish()
                    inside = states[low].as_py()
                    block, within, at, began = key, inside, 0, not inside
                after = (np.cumsum(odd[low:high]) + within) % 2 == 1
                before = np.concatenate([[within], after[:-1]])
                number[low:high] = np.arange(at, at + high - low)
                # a line that begins and ends outside of quotes is a record
                alone[low:high] = ~before & ~after
                for i in np.flatnonzero(before | after).tolist():
                    if not parts:
                        first = at + i
                    line = lines[low + i].as_py()
                    parts.append(line)
                    size += len(line) + 1
                    if size > longest:
                        raise ValueError(f"a record of more than {longest} characters in {block[0]}, block at {block[1]}")
                    if not after[i]:
                        close("whole" if began else "end")
                within, at = bool(after[-1]), at + high - low
            if alone.any():
                single = pa.array(alone)
                place = pa.array(number[alone])
                yield pa.RecordBatch.from_arrays(
                    [files.filter(single), starts.filter(single), place, pa.array(["whole"] * len(place)),
                     pa.array((where[alone] == 0) & (number[alone] == 0)), lines.filter(single)],
                    schema=schema,
                )
            if out:
                yield pieces()
        finish()
        if out:
            yield pieces()

    columns = ["file", "start", "line", "inside"]
    whole = known.select(*columns).mapInArrow(assembled, _PIECES).filter("kind = 'whole'")
    edges = known.filter("cut").select(*columns).mapInArrow(assembled, _PIECES).filter("kind <> 'whole'")
    # at most two pieces of a block; a record is its beginning and all pieces up to the next beginning
    upto = Window.partitionBy("file").orderBy("start", "place")
    joined = (
        edges.withColumn("nth", F.sum(F.when(F.col("kind") == "begin", 1).otherwise(0)).over(upto))
        .groupBy("file", "nth")
        .agg(
            F.max("header").alias("header"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "place", "record"))), lambda p: p["record"]), "\n").alias("record"),
        )
    )
    own = ["file", "header", "record"]
    records = whole.select(*own).unionAll(joined.select(*own))
    return records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).filter("record <> ''")


def scan_quoted_csv(spark: SparkSession, path: str, encoding: str = "UTF-8", longest: int = LONGEST) -> DataFrame:
    """Rows of CSV files with quoted line breaks, all text, named by the header that all files share.

    Equal to Spark's reading with ``multiLine``, but files are split; a carriage return and line feed within quotes
    becomes a line feed in both. Another header, or a row with more or fewer
    fields than it, raises. Without a file that has a header there is nothing to name columns by, which raises, too.
    """
    records = quoted_records(spark, path, encoding, longest)
    options = {"mode": "FAILFAST", "quote": '"', "escape": '"', "multiLine": "true",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    head = spark.read.options(**options, encoding=encoding)
    cells = head.csv(path).first()  # of one of the files
    if not cells:
        raise ValueError(f"no header in {path}")
    names = head.option("header", True).csv(path).columns
    fields = ", ".join(f"c{i} string" for i in range(len(names)))
    text = F.replace("record", F.lit("\r\n"), F.lit("\n"))
    parsed = records.select("file", "header", F.from_csv(text, fields, options).alias("r"))
    # decided in one expression, so that no header is dropped unchecked
    same = F.lit(True)
    for i, cell in enumerate(cells):
        same = same & F.col(f"r.c{i}").eqNullSafe(F.lit(cell))
    other = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean")
    return parsed.filter(F.when(~F.col("header"), True).when(same, False).otherwise(other)).select("r.*").toDF(*names)
