"""Delimited-text source: header, line filter and typed parse, all as DataFrame operations.

A file is read as lines (``spark.read.text``, split across tasks like any text input). The
first line names the columns. Every line equal to that header is dropped wherever it
occurs (a folder of files with one header each, or a header repeated inside a file), and so
is every blank line. The rest is parsed by ``from_csv`` against an explicit schema built
from the header: feature and target columns are doubles, excluded columns stay strings and
are never cast. Short, long and malformed rows are kept and marked in a corrupt-record
column, so the checks can count them or set them aside; no type-inference pass runs.

CSV with inferred types may have line breaks inside quoted fields. Files are still read line
by line and split over tasks; whether a line begins inside quotes follows from the number of
quotes before it in its file, which is a prefix sum over the splits (one number a split). Each
task puts the lines of a record together, and records that go on from one split into the next
are completed from the splits' loose ends, which are all that is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linclass.functions.expressions import col

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Header:
    line: str  # the raw first line, used for the header-line filter
    names: list[str]  # column names, surrounding double quotes stripped
    sep: str


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """DataFrame[value: string], one row per line of every file under ``path``."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths)


def header_of(line: str, sep: str = ",") -> Header:
    if sep == "":
        raise ValueError("separator must not be empty")
    names = [item.strip('"') for item in line.split(sep)]
    return Header(line=line, names=names, sep=sep)


def read_header(lines: DataFrame, sep: str = ",") -> Header:
    """First line of the input (one row to the driver)."""
    first = lines.first()
    if first is None:
        raise ValueError("input has no lines")
    return header_of(first["value"], sep)


def _ddl_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def parse_schema(names: Sequence[str], string_columns: Iterable[str] = ()) -> T.StructType:
    text = set(string_columns)
    fields = [T.StructField(n, T.StringType() if n in text else T.DoubleType(), True) for n in names]
    return T.StructType(fields + [T.StructField(CORRUPT, T.StringType(), True)])


def parse_lines(
    lines: DataFrame,
    header: Header,
    string_columns: Iterable[str] = (),
    value_col: str = "value",
) -> DataFrame:
    """Header and blank lines out, then each line parsed into typed columns + ``_corrupt_record``.

    ``_corrupt_record`` holds the raw line when it has too few or too many fields or a value
    that is not a number; it is null for a good line.
    """
    return _parse(lines, header, parse_schema(header.names, string_columns), value_col)


def _parse(lines: DataFrame, header: Header, schema: T.StructType, value_col: str = "value", options: dict | None = None, keep_line: bool = False) -> DataFrame:
    ddl = ", ".join(f"{_ddl_name(f.name)} {f.dataType.simpleString().upper()}" for f in schema.fields)
    options = (options or {}) | {
        "sep": header.sep,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
    }
    v = F.col(value_col)
    body = lines.where((v != F.lit(header.line)) & (F.trim(v) != F.lit("")))
    parsed = body.select(F.from_csv(v, ddl, options).alias("_row"), *([v.alias("_line")] if keep_line else []))
    return parsed.select(*[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields], *(["_line"] if keep_line else []))


def load_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    string_columns: Iterable[str] = (),
) -> tuple[DataFrame, Header]:
    """Read a delimited file or folder: (typed rows with ``_corrupt_record``, header)."""
    lines = read_lines(spark, path)
    header = read_header(lines, sep)
    return parse_lines(lines, header, string_columns), header


SPLITS = "file string, block long, quotes long"
PIECES = "value string, file string, block long, at_start boolean, at_end boolean"


def _split_quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of quotes of each split (rows of a split follow one another)."""
    for batch in batches:
        n = pc.count_substring(batch.column("value"), '"').cast(pa.int64())
        t = pa.table({"file": batch.column("file"), "block": batch.column("block"), "quotes": n})
        sums = t.group_by(["file", "block"]).aggregate([("quotes", "sum")])
        yield from sums.select(["file", "block", "quotes_sum"]).rename_columns(["file", "block", "quotes"]).to_batches()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines put together to records. The lines of a split up to the end of a record that began
    before it, and those of a record that it does not end, are loose ends."""
    here, parts, inside, begun = None, [], False, False

    def piece(at_end: bool) -> tuple:
        return ("\n".join(parts), *here, not begun, at_end)

    for batch in batches:
        out = []
        odd = np.asarray(pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False), np.int64) % 2 > 0
        for value, file, block, start, turns in zip(*(batch.column(c).to_pylist() for c in ("value", "file", "block", "inside")), odd.tolist(), strict=True):
            if (file, block) != here:
                if parts:
                    out.append(piece(True))
                here, parts, inside = (file, block), [], start
                begun = not start  # whether the record at hand began in this split
            parts.append(value)
            inside ^= turns
            if not inside:
                out.append(piece(False))
                parts, begun = [], True
        if out:
            yield _pieces(out)
    if parts:
        yield _pieces([piece(True)])


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["value", "file", "block", "at_start", "at_end"])


def read_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """DataFrame[value: string], one row per record: a line, or several that belong together because
    a quoted field has line breaks in it (which come back as a newline each). An open quote at the
    end of a file makes the rest of the file one record."""
    meta = F.col("_metadata")
    lines = read_lines(spark, path).select("value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"))
    quotes = lines.mapInArrow(_split_quotes, SPLITS).groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    states = quotes.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 > 0).alias("inside"))
    # the lines must stay in their order, so the states are broadcast: a row for each split that begins inside quotes
    known = lines.join(F.broadcast(states.where("inside")), ["file", "block"], "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    pieces = known.mapInArrow(_records, PIECES)
    whole = pieces.where("not at_start and not at_end").select("value")
    # loose ends in file order: one that does not go on from a split before begins a record
    ends = pieces.where("at_start or at_end")
    order = Window.partitionBy("file").orderBy("block", F.desc("at_start"))
    begins = F.sum((~F.col("at_start")).cast("long")).over(order)
    joined = ends.withColumn("record", begins).groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", (~F.col("at_start")).alias("later"), "value"))).alias("parts"))
    return whole.union(joined.select(F.concat_ws("\n", F.col("parts")["value"]).alias("value")))


def load_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header line and column types inferred from all of its rows (one pass), then
    parsed record by record with those types, so that short and long rows are marked as well.

    Only a file with a line that has an odd number of quotes can have line breaks inside its
    fields; others are parsed line by line."""
    lines = read_lines(spark, path)
    broken = not lines.where(F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1).isEmpty()
    types = spark.read.csv(path, sep=sep, header=True, inferSchema=True, multiLine=broken, **({"escape": '"'} if broken else {})).schema
    header = read_header(lines, sep)
    fields = [T.StructField(name, f.dataType, True) for name, f in zip(header.names, types.fields, strict=True)]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])
    if not broken:
        return _parse(lines, header, schema)
    rows = _parse(read_records(spark, path), header, schema, options={"escape": '"'}, keep_line=True)
    # an open quote takes the rest of its file with it
    is_open = F.length(F.regexp_replace("_line", '[^"]', "")) % 2 == 1
    return rows.withColumn(CORRUPT, F.when(is_open, F.col("_line")).otherwise(F.col(CORRUPT))).drop("_line")


def lines_from_table(df: DataFrame, columns: Sequence[str], sep: str = ",") -> tuple[DataFrame, Header]:
    """Table rows written as delimited lines, plus the header line naming the columns.

    Builds delimited input from a table inside Spark (no files); the header line is
    returned apart so it can be placed among the lines.
    """
    line = F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns])
    return df.select(line.alias("value")), header_of(sep.join(columns), sep)
