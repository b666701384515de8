"""Retention rules and run-table upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.sources import parts


def cutoff(now: Column, days: int) -> Column:
    return now - F.expr(f"INTERVAL {int(days)} DAYS")


def _report(df: DataFrame, stale: Column, dry_run: bool) -> DataFrame:
    """What pruning removes and keeps, without doing it, or the rows that stay."""
    stale = F.coalesce(stale, F.lit(False))
    if dry_run:
        return df.agg(
            F.count_if(stale).alias("removed"), F.count_if(~stale).alias("kept")
        )
    return df.filter(~stale)


def stale_tiles(now: Column, days: int = 30) -> Column:
    """Vector tiles older than the retention period."""
    return (F.col("format") == "mvt") & (F.col("generated_at") < cutoff(now, days))


def stale_metrics(now: Column, days: int = 30) -> Column:
    return F.col("timestamp") < cutoff(now, days)


def stale_runs(now: Column, days: int = 30) -> Column:
    """Finished runs older than the period; running ones stay whatever their age."""
    return F.col("status").isin("completed", "failed") & (F.col("start_time") < cutoff(now, days))


def prune_tiles(tiles: DataFrame, now: Column, days: int = 30, dry_run: bool = False) -> DataFrame:
    return _report(tiles, stale_tiles(now, days), dry_run)


def prune_metrics(metrics: DataFrame, now: Column, days: int = 30, dry_run: bool = False) -> DataFrame:
    return _report(metrics, stale_metrics(now, days), dry_run)


def prune_runs(runs: DataFrame, now: Column, days: int = 30, dry_run: bool = False) -> DataFrame:
    return _report(runs, stale_runs(now, days), dry_run)


def prune_stored(spark: SparkSession, root: str, table: str, stale: Column, dry_run: bool = False) -> DataFrame:
    """Take stale rows out of a stored table; part, removed and kept of the partitions that have any.

    Only these partitions are rewritten, in new folders that a manifest swaps in at the end; those left
    without rows go. A run lost before the swap leaves the table as it was and can be repeated. ``stale``
    reads the table's own columns, so a time of reference is a value and no query.
    """
    stale = F.coalesce(stale, F.lit(False))
    rows = parts.read(spark, root, table)
    if not parts.manifest(spark, root)[1][table]["folders"]:
        rows = rows.withColumn("_metadata", F.expr("named_struct('file_path', '')"))
    counts = rows.groupBy(parts.part_of_file().alias(parts.PART)).agg(
        F.count_if(stale).alias("removed"), F.count_if(~stale).alias("kept")
    )
    hit = counts.filter("removed > 0").collect()
    if hit and not dry_run:
        names = [r[parts.PART] for r in hit]
        kept = parts.read(spark, root, table, names).withColumn(parts.PART, parts.part_of_file()).filter(~stale)
        parts.commit(spark, root, parts.stage(kept, root, table, names))
    return spark.createDataFrame([tuple(r) for r in hit], "part string, removed bigint, kept bigint")


def insert_ignore(existing: DataFrame, batch: DataFrame, key: str = "run_id") -> DataFrame:
    """Rows of the batch to append: new keys only, the smallest row where a batch repeats a key."""
    rest = [c for c in batch.columns if c != key]
    once = batch.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r"))
    fresh = once.join(existing.select(key).distinct(), key, "left_anti")
    return fresh.select(*[(F.col(key) if c == key else F.col(f"_r.{c}").alias(c)) for c in batch.columns])


def upsert(existing: DataFrame, changes: DataFrame, now: Column, key: str = "run_id") -> DataFrame:
    """Table after the update: changed columns win and ``updated_at`` is set on touched rows.

    Where the changes repeat a key the smallest row counts.
    """
    changed = [c for c in changes.columns if c != key]
    changes = changes.groupBy(key).agg(F.min(F.struct(*changed)).alias("_r")).select(key, "_r.*")
    joined = existing.alias("e").join(changes.alias("c").withColumn("_hit", F.lit(True)), key, "left")
    columns = []
    for c in existing.columns:
        if c == key:
            columns.append(F.col(key))
        elif c == "updated_at":
            columns.append(F.when(F.col("_hit"), now).otherwise(F.col("e.updated_at")).alias(c))
        elif c in changed:
            columns.append(F.when(F.col("_hit"), F.col(f"c.{c}")).otherwise(F.col(f"e.{c}")).alias(c))
        else:
            columns.append(F.col(f"e.{c}"))
    return joined.select(*columns)
