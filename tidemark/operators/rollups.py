"""Per-user and per-device roll-ups fed by one cached aggregate."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def events_by_user_device(events: DataFrame) -> DataFrame:
    """(user, device): event count and the sorted distinct hosts."""
    e = events.where(F.col("user_id").isNotNull())
    return e.groupBy("user_id", "device_id").agg(
        F.count(F.lit(1)).alias("event_counts"),
        F.array_sort(F.collect_set("host")).alias("host_array"))


def with_user_totals(agg: DataFrame) -> DataFrame:
    """A user's devices, one row each, with the user's busiest device's count
    (``total_hits``) and number of devices. The totals are summed per task first; a
    user with very many devices is many rows, never one list."""
    totals = agg.groupBy("user_id").agg(F.max("event_counts").alias("total_hits"), F.count(F.lit(1)).alias("num_devices"))
    return agg.join(totals, "user_id")


def with_device_totals(agg: DataFrame, devices: DataFrame) -> DataFrame:
    """A device's users, one row each, with the device's type and number of users."""
    totals = agg.groupBy("device_id").agg(F.count(F.lit(1)).alias("num_users"))
    return devices.select("device_id", "device_type").join(agg.select("device_id", "user_id", "event_counts"), "device_id").join(totals, "device_id")


def user_device_rollups(events: DataFrame, devices: DataFrame, persist: bool = True):
    """Users with their devices and devices with their users, both in long form and
    from ONE aggregate of the events. With ``persist`` the aggregate is kept (memory,
    spilling to disk) so the two outputs do not recompute it; call the returned
    ``release()`` when both are written."""
    agg = events_by_user_device(events)
    if persist:
        agg = agg.persist(StorageLevel.MEMORY_AND_DISK)
    return with_user_totals(agg), with_device_totals(agg, devices), (agg.unpersist if persist else (lambda: None))
