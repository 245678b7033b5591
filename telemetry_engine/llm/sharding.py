"""Shards that all hold the same mixture of sources: proportional stratified interleaving.

1. Rows are shuffled within their source by a seeded hash of the id, source, size, checksum and the number of
   the copy, and ranked.
2. The fractional rank of the r-th of n rows of a source is (r - u) / n, where u in [0, 1) is a seeded hash of
   the source, so that sources of one row spread over the whole line too.
3. All rows are sorted by fractional rank.  The line is cut into runs of counts at most one apart (law ``rows``):
   any run holds every source in proportion, to within a row and its share of the rows (at most one per source,
   some square root of their number) by which a cut misses the exact quantile.  The place in the run is the slot.

Neither ranking gathers a group in one task.  A rank is the number of rows in earlier buckets of the ordering
key, from one count per bucket, plus the row's number within its own bucket; buckets hold some ``BUCKET_ROWS``
rows of one source, however large the source is.  Rows that agree in all that is kept are one row with a count
until they are numbered, so that no repeated row fills a bucket either.

Nulls: a null source is a source of its own, a null text has no bytes and checksum 0, a null id is an ordinary
id.  Repeated rows are placed one by one.  An empty table gives no rows.  Columns of the input named like those
of the result are not kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C

SHARDS = 40
ROW_BYTES = 16
BUCKET_ROWS = 4096
COPIES = 1 << 16
ADDED = ["size", "text_crc32", "law", "shard", "slot"]
HASH_BITS = 60


def _hash(*parts: Column) -> Column:
    """The first 60 bits of md5 of the parts, joined by colons."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _bits(rows: int) -> int:
    """Bits of the bucket number, for buckets of some ``BUCKET_ROWS`` rows (at most 2**20 buckets a source)."""
    return min(20, max(0, (max(1, rows // BUCKET_ROWS) - 1).bit_length()))


def _ranked(rows: DataFrame, group: list[str], bucket: str, order: list[str], before: str) -> DataFrame:
    """``rows`` with ``before``: how many rows of its ``group`` come before a row, by bucket and then ``order``;
    and with ``<before>_all``, the number of rows of its group.  ``rows`` is read twice: stored by the caller."""
    counts = rows.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(*group)
    starts = counts.select(*group, bucket, (F.sum("_n").over(upto) - F.col("_n")).alias("_start"),
                           F.sum("_n").over(every).alias(f"{before}_all"))
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    return (rows.withColumn("_in", F.row_number().over(inside)).join(starts, [*group, bucket])
            .withColumn(before, F.col("_start") + F.col("_in") - 1).drop("_in", "_start", bucket))


def interleaved(docs: DataFrame, shards: int = SHARDS, seed: int = 13, keep: list[str] | None = None,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` (the columns ``keep``; all, if None) with size, text_crc32, law, shard and slot.

    ``keep`` leaves out what need not be shuffled: size and checksum are taken where the text is read.
    """
    spark = docs.sparkSession
    path = C.work_dir(spark, "sharding")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ADDED]
    text = F.coalesce(C.col(text_col).cast("string"), F.lit(""))
    basis = docs.select(
        *[C.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
        F.coalesce(C.col(id_col).cast("string"), F.lit("null")).alias("_id"),
        F.coalesce(F.concat(F.lit("="), C.col(source_col).cast("string")), F.lit("null")).alias("_source"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    once = basis.groupBy(*basis.columns).agg(F.count(F.lit(1)).alias("_copies"))
    # copies are numbered in runs, so that those of one row can be dealt to many tasks
    runs = once.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPIES))))
    many = runs.where(F.col("_copies") > COPIES).repartition("_id", "_source", "text_crc32", "_run")
    numbered = [d.withColumn("_copy", F.explode(F.sequence(F.col("_run") * COPIES, F.least(F.col("_run") * COPIES + COPIES, "_copies") - 1)))
                for d in (runs.where(F.col("_copies") <= COPIES), many)]
    rows = numbered[0].unionByName(numbered[1]).drop("_copies", "_run")
    rows = rows.withColumn("_o", _hash(F.lit(seed), F.col("_id"), F.col("_source"), F.col("size"), F.col("text_crc32"), F.col("_copy")))
    rows = C.store(rows, f"{path}/rows")
    total = rows.count()
    bits = _bits(total)

    rows = rows.withColumn("_bucket", F.shiftright("_o", HASH_BITS - bits))
    tie = [f"k{i}" for i, c in enumerate(keep) if _orderable(docs, c)]
    ranked = _ranked(rows, ["_source"], "_bucket", ["_o", "_id", "size", "text_crc32", "_copy", *tie], "_before")
    offset = _hash(F.lit(seed), F.col("_source")) / F.lit(float(1 << HASH_BITS))
    line = ranked.select(
        *[f"k{i}" for i in range(len(keep))], "_source", "_before", "size", "text_crc32",
        ((F.col("_before") + 1 - offset) / F.col("_before_all")).alias("_fraction"))
    # rank 1 of an offset near 0 may round up to 1: the last bucket
    bucket = F.least(F.floor(F.col("_fraction") * F.lit(float(1 << bits))), F.lit((1 << bits) - 1))
    line = C.store(line.withColumn("_bucket", bucket), f"{path}/line")
    placed = _ranked(line.withColumn("_all", F.lit(1)), ["_all"], "_bucket", ["_fraction", "_source", "_before"], "_place")

    out = placed.withColumn("shard", F.expr(f"_place * {shards}L div {max(1, total)}L"))
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}L")  # the least place of the shard
    return out.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), (F.col("_place") - first).alias("slot"))


def _orderable(docs: DataFrame, name: str) -> bool:
    kind = next(f.dataType.typeName() for f in docs.schema.fields if f.name == name)
    return kind not in ("map", "variant", "struct", "array")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 13) -> None:
    """All rows below ``path``, one folder a shard, in the order of their slots."""
    rows = interleaved(docs, shards, seed)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
