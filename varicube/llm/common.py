"""What the operators share: the shared folder, block pairs of large groups, connected components."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varicube.functions.storage import stored as save

MASK64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sliced(batches, rows: int = 512):
    """Frames or record batches in slices of at most `rows` rows. Spark bounds a batch by bytes; what a task builds for its rows is bounded by this."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows) if hasattr(batch, "slice") else batch.iloc[at : at + rows]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 128):
    """What runs within sends its rows to Python so many at a time. sliced() bounds what a task builds for its rows, this the texts that are on their way as well."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows if int(before) <= 0 else min(rows, int(before)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def unused(name: str, *frames: DataFrame) -> str:
    """`name`, with as many underscores as it takes to be no column of the frames (names are compared without case, as Spark does)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_blocks(df: DataFrame, keys: list[str], node: str, rows: int) -> tuple[DataFrame, int]:
    """Deal out the rows of each group so that every pair of a group's rows meets in one unit of at most about 2 * rows.

    A group of up to `rows` rows is one unit. A larger one is cut into blocks by the hash of `node`, and each
    pair of blocks is a unit: a row then goes to as many units as its group has blocks. Adds `blk` (the row's
    block), `bi` <= `bj` (the unit) and returns the frame with the number of rows that it will have.
    """
    sizes = save(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("grp_n")).withColumn("nb", F.ceil(F.col("grp_n") / rows)).where("grp_n > 1"), "sizes")
    total = sizes.agg(F.sum(F.col("grp_n") * F.col("nb"))).first()[0] or 0
    cut = df.join(sizes.drop("grp_n"), keys).withColumn("blk", F.pmod(F.xxhash64(F.lit(7), F.col(node)), F.col("nb")))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)))
    return met.withColumns({"bi": F.least("blk", "other"), "bj": F.greatest("blk", "other")}).drop("nb", "other"), total


def groups_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    return max(2 * shuffle_partitions(spark), -(-rows // rows_each))


def dealt_to(n: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


class Forest:
    """Connected components of a task's own rows, fed pairs bit by bit (numpy label propagation)."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            open_ = x != y
            if not open_.any():
                break
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            low = np.minimum(x, y)
            np.minimum.at(label, x, low)
            np.minimum.at(label, y, low)
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label[:] = up


def pairs_within(starts: np.ndarray, sizes: np.ndarray, most: int):
    """All i < j within consecutive ranges of rows, in arrays of about `most` pairs."""
    ends = np.repeat(starts + sizes, sizes)
    rows = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, sizes)]) if len(starts) else np.empty(0, np.int64)
    partners = ends - 1 - rows
    upto = np.cumsum(partners)
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right")))
        n = partners[at:to]
        i = np.repeat(rows[at:to], n)
        first = np.repeat(np.cumsum(n) - n, n)
        yield i, i + 1 + (np.arange(len(i)) - first)
        at = to


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node reachable.

    Alternates large-star and small-star steps until the edge set stands still. Each round is a few
    aggregations and joins whose result is written to the shared folder; nothing comes to the driver but a
    count and a checksum. A null end or a loop makes no edge; an empty frame gives an empty frame.
    """
    both = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v").distinct()
    now, before = save(both, "edges"), None
    while True:
        seen = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == before or seen[0] == 0:
            break
        before = seen
        # large star: every larger neighbour of u is tied to the smallest of u and its neighbours
        sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = sides.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours are tied to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = save(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    own = now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return own.unionByName(roots)
