"""CSV files with line breaks in their fields, read by many tasks.

Spark reads such a file in one task, as a record is only known to begin where no
quoted field is open.  Here the files are read as lines, in splits.  A line takes
one of two states, a quoted field open or not, to one of the two, so it is a
function of two values, and functions compose in any grouping: the state after
every line of a block follows from the lines before it in the block and the
state in which the block begins, and that from the functions of the blocks before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.headers import quoted

# A quoted field that is closed on its line, with what follows up to the next comma.
_CLOSED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"[^,]*+(?=,|\z)'
_OPENED = r'(^|,)"'
# A quoted field that is closed on its line and nothing else, as in the simplest files.
_WHOLE = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|\z)'


FILE = "_metadata.file_path"


def plain_path(uri: str | Column) -> Column:
    """The path of a file as listings give it, from the escaped one that scans give."""
    return F.url_decode(F.replace(F.col(uri) if isinstance(uri, str) else uri, F.lit("+"), F.lit("%2B")))


def csv_lines(spark: SparkSession, paths: str | Sequence[str], files: Column | None = None) -> DataFrame:
    """``file, size, block, place, line``: the lines of files or folders; ``block`` and ``place`` order a file's lines.

    ``files``: a condition on ``_metadata.file_path`` alone; others are not opened.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(paths)
    raw = raw if files is None else raw.where(files)
    return raw.select(
        F.col(FILE).alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        # A split is read by one task from its begin to its end, whichever task that is.
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )


def split_size(spark: SparkSession) -> int:
    """Bytes of a file that one task reads."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )


def _bare(line: Column) -> Column:
    """A line without the carriage return at its end."""
    return F.when(F.endswith(line, F.lit("\r")), F.left(line, F.length(line) - 1)).otherwise(line)


def spans_lines(line: Column) -> Column:
    """Whether a line can't be read apart from its neighbours with the same result.

    Such a line holds a quote that is not part of a field closed on that line, a
    bare carriage return, or nothing but blanks.  Only lines with quotes meet the expression.
    """
    bare = _bare(line)
    open_quote = F.when(line.contains('"'), F.regexp_replace(bare, _WHOLE, "$1").contains('"')).otherwise(False)
    returns = F.when(line.contains("\r"), bare.contains("\r")).otherwise(False)
    blank = F.when(F.ltrim(line, F.lit(" \t\n\x0b\f\r")) == "", ~line.isin("", "\r")).otherwise(False)
    return open_quote | returns | blank


def _opens(line: Column) -> Column:
    """1 if a line that begins outside quoted fields ends in one, else 0."""
    return F.regexp_replace(line, _CLOSED, "$1").rlike(_OPENED).cast("int")


def file_headers(lines: DataFrame) -> DataFrame:
    """Per file its first line that isn't empty, and how its records can be read.

    ``file, header, open_header, spanning, whole``: the line; whether it ends in a quoted
    field; whether records may span lines; whether one task should read them then, as the
    file is no larger than a split, or a bare carriage return in the first line says that
    other lines may end there too.  One pass over the lines; a row per file leaves each task.
    A set of at most one value stands for a maximum: sets are aggregated by hash, and so are
    the aggregates beside one, where the least struct alone would have all lines sorted by file.
    """
    split = split_size(lines.sparkSession)
    first = F.when(~F.ltrim("line").isin("", "\r"), F.struct("block", "place", "line"))
    spanning = F.size(F.collect_set(F.when(spans_lines(F.col("line")), True))) > 0
    heads = lines.groupBy("file").agg(F.min(first).alias("first"), spanning.alias("spanning"), F.max("size").alias("size"))
    header = _bare(F.col("first.line"))
    return heads.select(
        "file",
        header.alias("header"),
        (_opens(header) == 1).alias("open_header"),
        "spanning",
        (header.contains("\r") | (F.col("size") <= split)).alias("whole"),
    )


def csv_records(lines: DataFrame) -> DataFrame:
    """``file, number, record``: lines joined to records, numbered from 0 in their file; empty ones are left out.

    A field is quoted if it begins with a quote; a doubled quote is part of it.  If a
    file's first line ends in a carriage return, that belongs to its line ends.  Only the
    lines of records that span several are gathered by record.
    """
    of_block = Window.partitionBy("file", "block").orderBy("place")
    so_far = of_block.rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    # A line swaps the states, keeps them, or leads both to one.
    step = lines.withColumn("out", _opens(F.col("line"))).withColumn("in", _opens(F.concat(F.lit('"'), F.col("line"))))
    step = step.withColumn("swaps", F.sum((F.col("out") > F.col("in")).cast("int")).over(so_far) % 2)
    settled = F.when(F.col("out") == F.col("in"), (F.col("out") + F.col("swaps")) % 2)
    step = step.withColumn("settled", F.last(settled, ignorenulls=True).over(so_far))

    def after(begin: Column) -> Column:
        return (F.coalesce("settled", begin) + F.col("swaps")) % 2

    # The same over the blocks of a file, of which there are few.
    blocks = step.groupBy("file", "block").agg(
        F.max_by(F.struct(after(F.lit(0)).alias("out"), after(F.lit(1)).alias("in")), "place").alias("end"),
        F.min_by(F.endswith("line", F.lit("\r")), "place").alias("returns"),
    )
    state = F.aggregate(
        F.collect_list("end").over(earlier),
        F.lit(0).cast("bigint"),
        lambda now, end: F.when(now == 0, end["out"]).otherwise(end["in"]),
    )
    returns = F.first("returns").over(Window.partitionBy("file").orderBy("block"))
    step = step.join(blocks.select("file", "block", state.alias("begin"), returns.alias("returns")), ["file", "block"])
    step = step.withColumn("after", after(F.col("begin")))
    step = step.withColumn("before", F.coalesce(F.lag("after").over(of_block), "begin"))
    step = step.withColumn("line", F.when(F.col("returns"), F.regexp_replace("line", r"\r\z", "")).otherwise(F.col("line")))
    step = step.where("before = 1 OR after = 1 OR length(line) > 0")

    # Numbers: records that begin in the block so far, and those of the blocks before.
    step = step.withColumn("nth", F.sum((F.col("before") == 0).cast("int")).over(so_far))
    sizes = step.groupBy("file", "block").agg(F.max("nth").alias("records"))
    base = F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("base")
    step = step.join(sizes.select("file", "block", base), ["file", "block"])
    step = step.withColumn("number", F.col("base") + F.col("nth") - 1)
    alone = step.where("before = 0 AND after = 0").select("file", "number", F.col("line").alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("block", "place", "line")))
    text = F.array_join(F.transform(parts, lambda part: part["line"]), "\n")
    several = step.where("before = 1 OR after = 1").groupBy("file", "number").agg(text.alias("record"))
    return alone.unionAll(several)


def parsed(records: DataFrame, columns: Sequence[str], corrupt: str | None = None, **more: str) -> DataFrame:
    """``file, number`` and the columns as text, by their place; the raw text of malformed records in ``corrupt``.

    ``more``: further options of Spark's CSV parser.
    """
    names = [*columns, *([corrupt] if corrupt else [])]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", **more}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    # The schema as text of its own: names may be of any kind.
    row = F.from_csv("record", ", ".join(f"{quoted(n)} STRING" for n in names), options)
    return records.select("file", "number", row.alias("row")).select(
        "file", "number", *[F.col(f"row.{quoted(f.name)}") for f in schema]
    )
