"""Large CSV exports with line breaks in quoted cells, read by many tasks.

Whether a line break ends a row depends on the quotes before it, back to the start of the file. So the quotes of every
byte range are counted first, one row per range; prefix sums of these counts tell each range how many lines with an odd
number of quotes come before it. With that a range knows for each of its lines whether it starts within a cell. Rows
of one line, nearly all, are parsed where they are; only the lines of longer rows are brought together, also across
ranges.

The grammar is strict, because a stray quote would shift all that follows: cells with a quote, a comma or a line break
are quoted, quotes in them doubled, and no other cell has a quote. Anything else raises. So do short and long rows, a
file with another header, a file that ends within a cell, and a row of more than ``LONGEST_ROW`` lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Lines that one row may have.
LONGEST_ROW = 1_000_000

# The grammar of lines. Possessive throughout, so that a line of any length is matched without recursion.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CELL = rf'(?:"{_INSIDE}"|[^",]*+)'
_WHOLE = rf"{_CELL}(?:,{_CELL})*+"
#: (starts within a cell, has an odd number of quotes) -> what such a line looks like
_LINES = {
    (False, False): rf"^{_WHOLE}\r?$",
    (False, True): rf'^(?:{_CELL},)*+"{_INSIDE}$',
    (True, False): rf'^{_INSIDE}(?:",(?:{_CELL},)*+"{_INSIDE})?$',
    (True, True): rf'^{_INSIDE}"(?:,{_CELL})*+\r?$',
}


def _too_long(kind: str) -> Column:
    return F.raise_error(F.lit(f"MALFORMED CSV: a row of more than {LONGEST_ROW} lines")).cast(kind)


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the start of its byte range and its place in it."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"), (_quotes(F.col("value")) % 2 == 1).alias("_odd"))


def _ranges(lines: DataFrame) -> DataFrame:
    """One row per byte range: the odd lines of its file before it.

    Raises for a file that ends within a cell, and for a cell that covers whole ranges of too many lines, so that no such
    cell is ever brought together.
    """
    own = lines.groupBy("_file", "_start").agg(F.count_if("_odd").alias("_count"), F.count(F.lit(1)).alias("_n"))
    file = Window.partitionBy("_file").orderBy("_start")
    before = F.coalesce(F.sum("_count").over(file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_count").over(Window.partitionBy("_file"))
    open_end = F.raise_error(F.concat(F.lit("MALFORMED CSV: a quoted cell never ends in "), "_file")).cast("bigint")
    placed = own.withColumn("_before", F.when(total % 2 == 1, open_end).otherwise(before))
    # ranges within one cell have the same number before them and no odd line of their own
    within = F.sum(F.when((F.col("_count") == 0) & (F.col("_before") % 2 == 1), F.col("_n"))).over(
        Window.partitionBy("_file", "_before"))
    return placed.select("_file", "_start", F.when(within > LONGEST_ROW, _too_long("bigint")).otherwise(F.col("_before")).alias("_before"),
                         F.xxhash64("_file").alias("_file_id"))


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the odd lines of their file before them, and whether they are its first.

    The window holds one byte range, whose size is a setting of the session, not of the file.
    """
    lines = _lines(spark, path)
    # a row per byte range: 80 of 128 MB each for 10 GB
    known = lines.join(F.broadcast(_ranges(lines)), ["_file", "_start"]).drop("_file")
    here = Window.partitionBy("_file_id", "_start").orderBy("_at")
    odd = F.col("_odd").cast("bigint")
    return known.select(
        "value", "_odd", "_file_id", "_start", "_at",
        (F.col("_before") + F.sum(odd).over(here.rowsBetween(Window.unboundedPreceding, 0)) - odd).alias("_before"),
        ((F.col("_start") == 0) & (F.row_number().over(here) == 1)).alias("_first"))


def _checked(line: Column, inside: Column, odd: Column) -> Column:
    """The line, if it has the grammar of its kind."""
    fits = F.lit(False)
    for (within, single), pattern in _LINES.items():
        kind = (inside if within else ~inside) & (odd if single else ~odd)
        fits = F.when(kind, line.rlike(pattern)).otherwise(fits)
    wrong = F.raise_error(F.concat(F.lit("MALFORMED CSV: quotes out of place in the line "), F.substring(line, 1, 200)))
    return F.when(line.contains('"') & ~fits, wrong.cast("string")).otherwise(line)


def _rows(lines: DataFrame) -> DataFrame:
    """One text per row of the file, without its line end; and whether it is the first line of its file."""
    inside = F.col("_before") % 2 == 1
    lines = lines.withColumn("value", _checked(F.col("value"), inside, F.col("_odd")))
    single = lines.where(~inside & ~F.col("_odd")).select("value", "_first")
    # The line that opens a cell has an even number before it, the others of its row one more, and so has the last.
    parts = lines.where(inside | F.col("_odd")).withColumn("_record", F.shiftright("_before", 1))
    ordered = F.array_sort(F.collect_list(F.struct("_start", "_at", "value")))
    joined = (parts.groupBy("_file_id", "_record")
              .agg(ordered.alias("_lines"), F.bool_or("_first").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .select(F.array_join("_lines.value", "\n").alias("value"), "_first", "_n"))
    joined = joined.select(F.when(F.col("_n") > LONGEST_ROW, _too_long("string")).otherwise(F.col("value")).alias("value"), "_first")
    return single.unionByName(joined).withColumn("value", F.regexp_replace("value", "\r$", ""))


def read_split(spark: SparkSession, path: str, columns: list[str], options: dict) -> DataFrame:
    """The rows of a CSV file, or of a folder of them, as text columns; each file is read by as many tasks as it has ranges.

    ``columns`` is the header that every file must begin with, ``options`` are those of Spark's CSV parser.
    """
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    strict = {**options, "mode": "FAILFAST"}
    parsed = _rows(_placed(spark, path)).where("value != ''").select("_first", F.from_csv("value", schema, strict).alias("_row"))
    header = F.array(*[F.col(f"_row.`{c.replace('`', '``')}`") for c in columns])
    other = F.raise_error(F.concat(F.lit("CSV header does not conform to the schema: "), F.array_join(header, ","))).cast("boolean")
    same = F.coalesce(header == F.array(*map(F.lit, columns)), F.lit(False))
    data = F.when(~F.col("_first"), F.lit(True)).when(same, F.lit(False)).otherwise(other)
    return parsed.where(data).select("_row.*")
