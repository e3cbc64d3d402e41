"""Spark session helpers.

The library never creates its own session inside an operator; operators take
DataFrames. These helpers exist for tests, the bench and the driver entry
point, and for the one piece of cluster state the library depends on: a
reliable checkpoint directory (used by the iterative closure).
"""

from __future__ import annotations

import os
import sys
import tempfile
import time
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings that every session of this project wants. AQE re-plans joins at
# runtime (broadcast conversion from measured sizes, skew-join splitting of
# hub nodes, partition coalescing); the UI stays off because it is a server.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Codec of stored tables: ids of one kind have common beginnings and take a fraction of the default's bytes.
STORED_CODEC = "zstd"

# Bits of a filter for each key, and of a filter at most (16 MB when broadcast).
KEY_BITS, MAX_FILTER_BITS = 16, 1 << 27


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "graphspark", extra_conf: dict | None = None) -> SparkSession:
    """Return a session with the project's defaults (tests, bench, entry)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("GRAPHSPARK_DRIVER_MEMORY", "16g"))
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a directory; return it.

    On a cluster the directory must be a shared file system named by
    ``spark.checkpoint.dir``; it is read from the session. Only a local-mode
    session (tests, single machine) without that setting gets a scratch
    directory of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared file system "
            "(the iterative closure cuts lineage with reliable checkpoints)")
    scratch = tempfile.mkdtemp(prefix="graphspark-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def materialize(df):
    """Compute ``df`` once and cut its lineage: write it as a Parquet table in
    the shared checkpoint directory and read it back.

    Used for small per-question tables that several branches of a plan read
    (picked predicates, chosen anchors, capped facts): without it each
    branch would recompute the retrieval under it. One job computes the
    table (``Dataset.checkpoint`` would compute it twice), the files live in
    the shared ``spark.checkpoint.dir`` so a lost executor does not lose
    them, and the re-read table carries its true size, so the optimizer can
    broadcast it where it is small."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tables/{uuid.uuid4().hex}"
    t0 = time.perf_counter()
    df.write.mode("overwrite").option("compression", STORED_CODEC).parquet(path)
    if os.environ.get("GRAPHSPARK_PROFILE"):
        import traceback
        caller = traceback.extract_stack(limit=3)[0]
        print(f"[materialize] {caller.name}:{caller.lineno} {time.perf_counter() - t0:.2f}s",
              file=sys.stderr, flush=True)
    return spark.read.parquet(path)


def bounded_rows(df, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows + 1).

    The size proof in front of every broadcast whose side is data-derived."""
    return df.limit(max_rows + 1).count() <= max_rows


def key_filter(keys, col: str):
    """A one-row table of bits, set at the hash of each value of ``col``: what :func:`prefiltered` reads.

    ``KEY_BITS`` bits for each row of ``keys`` (counted), a power of two, up to ``MAX_FILTER_BITS``."""
    n = keys.count()
    bits = 1 << min(MAX_FILTER_BITS.bit_length() - 1, max(10, (KEY_BITS * n).bit_length()))
    place = keys.select(F.xxhash64(col).bitwiseAND(F.lit(bits - 1)).alias("_p"))
    words = place.groupBy(F.shiftright("_p", 6).alias("_i")).agg(F.bit_or(F.expr("shiftleft(1L, int(_p & 63))")).alias("_w"))
    rows = keys.sparkSession.range(bits >> 6).withColumnRenamed("id", "_i").join(words, "_i", "left")
    listed = rows.agg(F.sort_array(F.collect_list(F.struct("_i", F.coalesce("_w", F.lit(0).cast("long")).alias("_w")))).alias("_l"))
    return materialize(listed.select(F.col("_l._w").alias("_words"), F.lit(bits).alias("_bits")))


def prefiltered(df, col: str, key_bits):
    """``df`` without nearly all rows whose ``col`` is no key of :func:`key_filter`; none that has a key is lost.

    For a join of a large table with keys that are too many to be broadcast: rows without a key aren't shuffled to it.
    The join itself stays exact and is still needed."""
    there = df.withColumn("_hash", F.xxhash64(col)).join(
        F.broadcast(key_bits), F.expr("(shiftright(_words[int(shiftright(_hash & (_bits - 1), 6))], int(_hash & 63)) & 1) = 1"), "left_semi")
    return there.drop("_hash")
