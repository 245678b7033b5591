"""CSV records whose quoted fields hold line feeds, without giving a file to one task.

A line feed ends a record unless it lies in a quoted field.  Whether a line begins inside one depends on all
lines before it; but a line only maps "begins inside a quoted field: yes or no" to the same for its end, and
such maps compose.  So every split of a file is reduced to one map, the maps of a file's splits are run
through in order (one row a split), and each split then knows how it begins: a segmented scan.  Inside a split
it is a window over its lines.  Lines are then put together by record.

A quote opens a field only at its start (white space aside); quotes elsewhere are text.  A carriage return
before a line feed is dropped.  A record that is still open at the end of its file is returned as its first line
with ``open`` set: the rest of the file belongs to it and is not gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A line that, begun outside of quotes, ends inside a quoted field.  Possessive throughout: linear and no recursion.
_CLOSED = r'\s*+"[^"]*+(?:""[^"]*+)*+"[^,]*+'
_PLAIN = r'(?!\s*+")[^,]*+'
OPEN_LINE = rf'\A(?:(?:{_CLOSED}|{_PLAIN}),)*+\s*+"[^"]*+(?:""[^"]*+)*+\z'

SPLIT = ["source_file", "block"]


def ends_open(line: Column) -> Column:
    return line.rlike(OPEN_LINE)


def is_blank(line: Column) -> Column:
    return F.trim(line) == ""


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines with their place; ``outside`` and ``inside``: whether a line ends inside quotes, by how it begins."""
    raw = spark.read.option("lineSep", "\n").text(files).select(
        F.regexp_replace("value", r"\r\z", "").alias("line"), F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"))
    # a task reads a split in order
    raw = raw.withColumn("n", F.monotonically_increasing_id())
    ends = F.struct(ends_open(F.col("line")).alias("outside"), ends_open(F.concat(F.lit('"'), "line")).alias("inside"))
    return raw.select("*", F.inline(F.array(ends)))


def records(spark: SparkSession, files: list[str]) -> DataFrame:
    """source_file, record, header (the file's first record that is not blank), open."""
    bit = lambda c: c.cast("int")
    own = Window.partitionBy(*SPLIT).orderBy("n")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = _lines(spark, files)
    # a line either swaps the two states, leaves them, or ends in one state whatever it began in
    lines = lines.withColumn("swaps", F.sum(bit(F.col("outside") & ~F.col("inside"))).over(upto))
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct("n", bit(F.col("outside")).alias("state"), "swaps"))
    lines = lines.withColumn("fixed", F.max(fixed).over(upto))
    ended = F.coalesce(F.col("fixed.state") + F.col("swaps") - F.col("fixed.swaps"), F.lit(0)) % 2

    in_file = Window.partitionBy("source_file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    ends = (lines.groupBy(*SPLIT).agg(F.max(F.struct("n", "swaps", "fixed")).alias("last"))
            .select(*SPLIT, F.col("last.swaps").alias("swaps"), F.col("last.fixed").alias("fixed")))
    ends = ends.select(*SPLIT, "swaps", F.when(F.col("fixed").isNotNull(), ended).alias("state"),
                       F.sum("swaps").over(in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("total"))
    ends = ends.withColumn("known", F.max(F.when(F.col("state").isNotNull(), F.struct("block", "state", "total"))).over(before))
    entry = (F.col("total") - F.col("swaps") + F.coalesce(F.col("known.state") - F.col("known.total"), F.lit(0))) % 2
    starts = ends.select(*SPLIT, F.pmod(entry, F.lit(2)).alias("entry"))

    after = F.when(F.col("fixed").isNotNull(), ended).otherwise((F.col("entry") + F.col("swaps")) % 2)
    lines = lines.join(starts, SPLIT).withColumn("after", after)
    lines = lines.withColumn("begins", F.coalesce(F.lag("after").over(own), F.col("entry")) == 0)
    lines = lines.withColumn("number", F.sum(bit(F.col("begins"))).over(upto))
    lines = lines.withColumn("filled", F.sum(bit(F.col("begins") & ~is_blank(F.col("line")))).over(upto))

    # what earlier splits leave: the record that runs into this one, and whether the header is behind
    sums = (lines.groupBy(*SPLIT).agg(F.max("number").alias("records"), F.max("filled").alias("all_filled"),
                                      F.max(F.struct("n", "after"))["after"].alias("exit")))
    begun = F.when(F.col("records") > 0, F.struct("block", F.col("records").alias("number")))
    whole = Window.partitionBy("source_file")
    sums = sums.select(
        *SPLIT, F.max(begun).over(before).alias("running"), F.max(begun).over(whole).alias("final"),
        F.coalesce(F.sum("all_filled").over(before), F.lit(0)).alias("filled_before"),
        (F.max(F.struct("block", "exit")).over(whole)["exit"] == 1).alias("file_open"))
    lines = lines.join(sums, SPLIT)
    here = F.struct(F.col("block"), F.col("number"))
    lines = lines.withColumn("id", F.when(F.col("number") > 0, here).otherwise(F.col("running")))
    lines = lines.withColumn("open", F.col("file_open") & (F.col("id") == F.col("final")))
    lines = lines.withColumn("header", F.col("begins") & ~is_blank(F.col("line")) & (F.col("filled_before") + F.col("filled") == 1))

    parts = F.sort_array(F.collect_list(F.struct("block", "n", "line")))
    return (lines.where(F.col("begins") | ~F.col("open")).groupBy("source_file", "id")
            .agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("record"),
                 F.max("header").alias("header"), F.max("open").alias("open"))
            .where(~is_blank(F.col("record"))).drop("id"))
