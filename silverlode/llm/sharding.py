"""Two-pass external shuffle: rows scattered into memory-sized buckets, each shuffled in memory, dealt to shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BYTES = 4 << 20
# A bucket's exchanges take time that grows with the square of its rows.
BUCKET_ROWS = 2048
LEAST_BUCKETS = 256
BUCKETS_PER_TASK = 4
SEED = 23


def shuffled(
    df: DataFrame,
    shards: int = 8,
    bucket_bytes: int = BUCKET_BYTES,
    least_buckets: int = LEAST_BUCKETS,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``df`` with a struct column ``place`` (shard, slot): all rows in random order, dealt out in turn.

    First pass: a seeded hash of doc_id and text scatters rows into buckets of about ``bucket_bytes`` and
    ``bucket_rows``, at least ``least_buckets`` of them. Second pass: the rows of a bucket, in the order of their hashes, are
    Fisher-Yates shuffled by hashes of seed, bucket and step, and take the next numbers after all rows of the
    buckets before it. Row number n goes to slot ``n // shards`` of shard ``n % shards``, so counts of shards
    differ by one at most.

    Places depend on the rows and parameters alone, not on the layout of tasks or files, so a task that runs again
    after a lost executor deals out the same ones. The one exchange of whole rows is the scatter. Counts per bucket are
    summed up over 4096 buckets at a time. Null texts count no bytes; null ids are hashed like others; repeated rows
    are kept, and which of equal rows gets which of their places has no meaning; such as repeat more than ``bucket_rows``
    times are numbered, and scattered by their number too; rows of equal id and text that differ elsewhere go by a
    hash of the rest. An empty table gives no rows. Columns are only carried, but for one named place, which is
    replaced. A very long text is a row of a bucket like others.
    """
    others = [c for c in df.columns if c not in ("place", "doc_id", "text")]
    rest = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in others]))) if others else F.lit(0).cast("long")
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "place"]).alias("row"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("at"),
        rest.alias("rest"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("bytes"),
    )
    total = rows.agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    buckets = max(least_buckets, -(-(total["bytes"] or 0) // bucket_bytes), -(-total["rows"] // bucket_rows))
    rows = _numbered(rows.drop("bytes"), seed, bucket_rows)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "at"), F.lit(buckets)))

    group = F.floor(F.col("bucket") / 4096)
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("group", group)
    groups = counts.groupBy("group").agg(F.sum("n").alias("n"))
    below = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("group", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("start"))
    within = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counts.withColumn("inner", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(groups, "group")
        .select("bucket", (F.col("start") + F.col("inner")).alias("start"))
    )

    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // BUCKETS_PER_TASK)
    lists = (
        rows.repartition(tasks, "bucket")
        .sortWithinPartitions("bucket", "at", "rest")
        .groupBy("bucket")
        .agg(F.collect_list(F.struct("at", "rest", "row")).alias("rows"))
        .join(starts, "bucket")
    )
    # The list is in order already, as rows come sorted; the keys are sorted again so that nothing rests on that.
    keys = F.array_sort(F.transform("rows", lambda r, i: F.struct(r["at"], r["rest"], i.alias("i"))))
    lists = lists.withColumn("order", _fisher_yates(F.transform(keys, lambda k: k["i"]), F.col("bucket"), seed + 2))
    drawn = F.transform("order", lambda i: F.get("rows", i)["row"])
    number = F.col("start") + F.col("pos")
    return lists.select("start", F.posexplode(drawn)).select(
        "col.*",
        F.struct(
            F.pmod(number, F.lit(shards)).cast("int").alias("shard"), F.floor(number / shards).alias("slot")
        ).alias("place"),
    )


def _numbered(rows: DataFrame, seed: int, often: int) -> DataFrame:
    """The rows, where each of those that repeat more than so often has a hash of its own; no task makes more at a time."""
    hot = rows.groupBy("at", "rest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > often)
    if hot.isEmpty():
        return rows
    copies = rows.join(hot, ["at", "rest"], "left_semi").groupBy("at", "rest").agg(
        F.first("row").alias("row"), F.count(F.lit(1)).alias("n")
    )
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(often).cast("long"))).alias("begin")
    blocks = copies.select("row", "at", "rest", "n", begin).repartition("at", "rest", "begin")
    last = F.least(F.col("begin") + often, "n") - 1
    each = blocks.select("row", "at", "rest", F.explode(F.sequence("begin", last)).alias("copy"))
    each = each.select("row", F.xxhash64(F.lit(seed), "at", "rest", "copy").alias("at"), "rest")
    return rows.join(hot, ["at", "rest"], "left_anti").select("row", "at", "rest").unionByName(each)


def _fisher_yates(items: Column, bucket: Column, seed: int) -> Column:
    """The array shuffled: from the last place down, each exchanges its item with that of a drawn place up to it."""
    size = F.size(items)

    def exchanged(a: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(F.lit(seed), bucket, i), i + 1).cast("int")
        # An array of one element gives a name to what is used more than once.
        return F.get(F.transform(F.array(j), lambda j: F.when(j == i, a).otherwise(swapped(a, i, j))), F.lit(0))

    def swapped(a: Column, i: Column, j: Column) -> Column:
        return F.concat(
            F.slice(a, F.lit(1), j),
            F.array(F.get(a, i)),
            F.slice(a, j + 2, i - j - 1),
            F.array(F.get(a, j)),
            F.slice(a, i + 2, F.size(a) - i - 1),
        )

    return F.when(size < 2, items).otherwise(F.aggregate(F.sequence(size - 1, F.lit(1), F.lit(-1)), items, exchanged))


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard; readers order a shard by ``slot``."""
    columns = [F.col(f"`{c}`") for c in placed.columns if c != "place"]
    placed.select(*columns, "place.slot", "place.shard").write.partitionBy("shard").parquet(path)
