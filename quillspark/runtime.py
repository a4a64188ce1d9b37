"""Session helpers shared by the operators: cutting lineage and ranking inside groups of any size."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def local_session(app: str = "quillspark", cpus: str = "8", partitions: int = 8) -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, so that its functions can be loaded there without an installation.

    The archive is made on the driver, which serves it to every executor, also to those that join later.
    """
    sc = spark.sparkContext
    if getattr(sc, "_quillspark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quillspark-"), "quillspark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("quillspark", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._quillspark_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by spark.checkpoint.dir; only a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="quillspark-checkpoint-")
    sc.setCheckpointDir(named)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so that lost executors and repeated use cost no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ranked_in_groups(df: DataFrame, group: Sequence[str], order: Sequence[Column], value: str | None = None) -> DataFrame:
    """Add ``rank_in_group`` (1-based) and, with ``value``, ``running_total`` (inclusive), over groups of any size.

    ``order`` must be total within a group. A window over the group would put a hot group into one task. Here the rows
    are range-partitioned on (group, order), so that a hot group spreads over many tasks; ranks are counted inside each
    piece and shifted by the sizes of the pieces before it. That table of pieces has at most one row per partition and
    group. The range partitioning is written out once, because its bounds are sampled and must be the same in both uses.
    """
    g = list(group)
    ranged = cut_lineage(df.repartitionByRange(*[F.col(c) for c in g], *order).withColumn("_piece", F.spark_partition_id()))
    piece = Window.partitionBy("_piece", *g).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged.withColumn("_rank", F.row_number().over(piece))
    sizes = [F.count(F.lit(1)).alias("_n")]
    if value:
        out = out.withColumn("_run", F.sum(value).over(piece))
        sizes.append(F.sum(value).alias("_v"))
    before = Window.partitionBy(*g).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = ranged.groupBy("_piece", *g).agg(*sizes)
    pieces = pieces.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if value:
        pieces = pieces.withColumn("_vshift", F.coalesce(F.sum("_v").over(before), F.lit(0)))
    pieces = pieces.drop("_n", "_v")
    out = out.join(pieces, ["_piece", *g]).withColumn("rank_in_group", F.col("_rank") + F.col("_shift"))
    if value:
        out = out.withColumn("running_total", F.col("_run") + F.col("_vshift"))
    return out.drop("_piece", "_rank", "_shift", "_run", "_vshift")


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with the columns, each evaluated once however often it is used later.

    The optimiser puts a projected expression wherever its column is used, which multiplies long chains; a generator of
    one row is a border that it does not cross, and stays within the stage.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
