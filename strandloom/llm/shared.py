"""Session settings, the shared folder and global prefix sums that the operators of this subpackage have in common."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words of most contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, one of our own, on a local master only."""
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="strandloom-"))
        held = sc._jsc.sc().getCheckpointDir()
    return spark.conf.get("spark.checkpoint.dir", None) or held.get()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, stored in the shared folder, so that lineage ends here and later readings agree."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files that lie behind cuts and that nobody refers to any more.

    Spark does so when the driver's collector finds out, which on a large heap may take longer than the job. What one
    collection finds may be what held the next thing, and it goes in the background: hence three, with a pause.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)


def table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The same rows as a Parquet table of the shared folder."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(df: DataFrame, rows: int, each: int = 50_000) -> DataFrame:
    """df, of which at most about `rows` rows are expected, in as few partitions as hold `each` of them."""
    return df.coalesce(max(1, min(parts(df.sparkSession), -(-rows // each))))


def parts(spark: SparkSession) -> int:
    """Partitions of an exchange, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_crc(c: Column, mod: int) -> Column:
    """crc32 of an id's decimal text, modulo mod; null for a null id."""
    return F.crc32(c.cast("string")) % mod


#: Into how many parts the rows of one key are dealt where a join would bring them all together.
SALTS = 8


def salted_join(rows: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows joined by `key` with `small`, which has a row for each key: the rows of any key go to SALTS tasks."""
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def ranged(df: DataFrame, *order: str) -> DataFrame:
    """Rows dealt into contiguous ranges of the order, with the range's number in _pid; stored, so the numbers stay.

    Rows that are equal in the whole order are told apart by where they were read, so no value makes a range that
    cannot be cut.
    """
    df = df.withColumn("_at", F.monotonically_increasing_id())
    keys = [*order, "_at"]
    return cut(df.repartitionByRange(parts(df.sparkSession), *keys).withColumn("_pid", F.spark_partition_id()))


def running(df: DataFrame, by: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """Exclusive prefix sums over ranged() rows, for each value of `by` (none: over all).

    sums maps a new column to the column that is summed. Each range is summed by itself; a small table with a row for
    each range (and value of `by` in it) carries the totals over, so no task sees more than its range.
    """
    totals = df.groupBy("_pid", *by).agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    across = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_pid", *by, *[F.coalesce(F.sum(k).over(across), F.lit(0)).alias(f"_b_{k}") for k in sums])
    own = Window.partitionBy("_pid", *by).orderBy(*order, "_at").rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumns({k: F.coalesce(F.sum(v).over(own), F.lit(0)) for k, v in sums.items()})
    on = [rows["_pid"] == base["_pid"], *[rows[c].eqNullSafe(base[c]) for c in by]]
    return rows.join(base, on).select(*[rows[c] for c in rows.columns if c not in sums], *[(rows[k] + base[f"_b_{k}"]).alias(k) for k in sums])
