"""Delivery of changed rows by comparing source and target ids per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.buckets import dt_partition
from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import merge, not_in_changes

TARGETS = {"kafka": "kafkaTargetid", "hdfs": "hdfsTargetid"}


def pending(status: DataFrame, target: str) -> DataFrame:
    """Keys whose source id is ahead of the target's; undelivered keys have no target id."""
    delivered = F.col(TARGETS[target])
    return status.filter(delivered.isNull() | (F.col("sourceid") > delivered))


def status_upsert(status: DataFrame, changes: DataFrame) -> DataFrame:
    """Insert new keys, move the source id of known ones; target ids stay."""
    return merge(status, changes, ["qualifiedName"], update=["sourceid"])


def mark_delivered(status: DataFrame, target: str) -> DataFrame:
    return status.withColumn(TARGETS[target], F.col("sourceid"))


def delivery_rows(facts: DataFrame, due: DataFrame, key: str, status_key: Column, bookmark: str, length: int = 10) -> DataFrame:
    """Full rows of the pending keys with their ``dt=`` partition label."""
    keys = due.select(status_key.alias(key)).distinct()
    return facts.join(keys, key, "left_semi").withColumn("label", dt_partition(bookmark, length))


def merge_delivered(master: DataFrame, delivered: DataFrame, key: str, bookmark: str) -> DataFrame:
    """Master rows not delivered again, plus the newest delivered row per key."""
    newest = latest_per_key(delivered, [key], bookmark).select(*master.columns)
    return not_in_changes(master, delivered, [key]).unionByName(newest)
