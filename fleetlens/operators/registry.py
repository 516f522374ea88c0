"""Worker registry, retention, and roles with their permissions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.clock import instant, since
from fleetlens.params import RETENTION_DAYS, ROLE_DESCRIPTIONS, ROLE_PERMISSIONS
from fleetlens.session import cut_lineage

TIME_COLUMNS = {
    "metrics": "timestamp",
    "anomalies": "detected_at",
    "alerts": "raised_at",
    "predictions": "predicted_at",
    "scaling_events": "triggered_at",
}


def worker_name(container: Column, prefix: str = "") -> Column:
    """Worker id of a container name: the prefix is dropped, ``_`` becomes ``-``."""
    bare = F.replace(container, F.lit(prefix), F.lit("")) if prefix else container
    return F.replace(bare, F.lit("_"), F.lit("-"))


def sync_registry(
    workers: DataFrame, snapshot: DataFrame, seen_at: datetime, prefix: str = ""
) -> DataFrame:
    """Registry after a sync with the live containers ``(name, container_id)``.

    Active rows that are not alive become terminated; live ones become active
    with a fresh heartbeat and keep their registration time; new ones are added.
    """
    live = snapshot.select(
        worker_name(F.col("name"), prefix).alias("worker_id"), F.col("container_id").alias("_cid")
    )
    live = live.groupBy("worker_id").agg(F.max("_cid").alias("_cid"), F.lit(True).alias("_live"))
    now = instant(workers, "last_heartbeat", seen_at)
    alive = F.col("_live").isNotNull()
    return workers.join(live, "worker_id", "full_outer").select(
        "worker_id",
        F.when(alive, F.col("_cid")).otherwise(F.col("container_id")).alias("container_id"),
        F.coalesce("registered_at", now).alias("registered_at"),
        F.when(alive, now).otherwise(F.col("last_heartbeat")).alias("last_heartbeat"),
        F.when(alive, "active")
        .when(F.col("status") == "active", "terminated")
        .otherwise(F.col("status"))
        .alias("status"),
    )


def retained(table: DataFrame, name: str, as_of: datetime, days: dict[str, int] | None = None) -> DataFrame:
    """Rows of a table that its retention keeps; open alerts are always kept."""
    limits = days or RETENTION_DAYS
    fresh = since(table, TIME_COLUMNS[name], as_of, days=limits[name])
    return table.filter(fresh | ~F.col("resolved")) if name == "alerts" else table.filter(fresh)


def _date_folders(spark: SparkSession, path: str) -> dict[str, object]:
    """Folder of each date of a date-partitioned table, by listing the table's folder alone."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f.getPath() for f in files.listStatus(root) if f.isDirectory() and f.getPath().getName().startswith("date=")]
    return {p.getName()[5:]: p for p in found}


def apply_retention(
    spark: SparkSession, path: str, name: str, as_of: datetime, days: dict[str, int] | None = None
) -> DataFrame:
    """Drop what a table's retention no longer keeps; returns (date, action, removed, kept) of the dates it touched.

    The table is partitioned by ``date``. Dates before the limit are dropped as whole folders, found by listing, and
    only the limit's own date is rewritten; later dates keep their files. Where open alerts must be kept, a date
    that still holds some is rewritten instead of dropped. Rows of dropped folders are counted by their footers. A
    run that is cut off can be run again: it does the rest.
    """
    limit = as_of - timedelta(days=(days or RETENTION_DAYS)[name])
    folders = _date_folders(spark, path)
    old = sorted(d for d in folders if d < limit.date().isoformat())
    edge = [d for d in folders if d == limit.date().isoformat()]
    table = spark.read.parquet(path)
    of = lambda dates: table.where(F.col("date").cast("string").isin(dates))
    counts = {str(r["date"]): r["n"] for r in of(old).groupBy("date").agg(F.count("*").alias("n")).collect()} if old else {}
    opened = set()
    if name == "alerts" and old:
        opened = {str(r["date"]) for r in of(old).where(~F.col("resolved")).select("date").distinct().collect()}
    report = [(d, "dropped", counts.get(d, 0), 0) for d in old if d not in opened]
    redo = sorted([*opened, *edge])
    if redo:
        some = of(redo)
        fresh = since(some, TIME_COLUMNS[name], as_of, days=(days or RETENTION_DAYS)[name])
        keep = fresh | ~F.col("resolved") if name == "alerts" else fresh
        sizes = some.groupBy("date").agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("removed")).collect()
        changed = [str(r["date"]) for r in sizes if r["removed"]]
        report += [(str(r["date"]), "rewritten", r["removed"], r["kept"]) for r in sizes if r["removed"]]
        if changed:
            left = cut_lineage(some.where(F.col("date").cast("string").isin(changed)).where(keep))
            left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
        old += [str(r["date"]) for r in sizes if r["removed"] and not r["kept"]]
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for d in old:
        if d not in opened:
            files.delete(folders[d], True)
    spark.catalog.refreshByPath(path)
    return spark.createDataFrame(report, "date string, action string, removed long, kept long")


def retention_report(tables: dict[str, DataFrame], as_of: datetime, days: dict[str, int] | None = None) -> DataFrame:
    """Rows kept and removed per table."""
    limits = days or RETENTION_DAYS
    parts = []
    for name, df in tables.items():
        keep = since(df, TIME_COLUMNS[name], as_of, days=limits[name])
        if name == "alerts":
            keep = keep | ~F.col("resolved")
        parts.append(
            df.agg(
                F.lit(name).alias("table_name"),
                F.count_if(keep).alias("kept"),
                F.count_if(~keep).alias("removed"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- roles ------------------------------------------------------------------------


def role_table(spark: SparkSession, extra: dict[str, list[str]] | None = None) -> DataFrame:
    """(role, permission) rows of the default roles and any custom ones."""
    roles = ROLE_PERMISSIONS | (extra or {})
    rows = [(role, p) for role, granted in roles.items() for p in granted]
    return spark.createDataFrame(rows, "role string, permission string")


def role_summary(roles: DataFrame) -> DataFrame:
    """Permissions of each role as a sorted list, with their number."""
    pairs = [F.lit(x) for item in ROLE_DESCRIPTIONS.items() for x in item]
    text = F.try_element_at(F.create_map(*pairs), F.col("role"))
    return roles.groupBy("role").agg(
        F.array_sort(F.collect_set("permission")).alias("permissions"),
        F.count_distinct("permission").alias("permission_count"),
    ).withColumn("description", text)


def user_permissions(users: DataFrame, roles: DataFrame, user: str = "user_id", held: str = "roles") -> DataFrame:
    """Distinct (user, permission) over all roles held; unknown roles add nothing."""
    return (
        users.select(user, F.explode(held).alias("role")).distinct().join(roles, "role").select(user, "permission").distinct()
    )


def access_audit(
    log: DataFrame, roles: dict[str, list[str]] | None = None, held: str = "roles", required: str = "required"
) -> DataFrame:
    """Add ``has_any`` and ``has_all`` of the required permissions to each request.

    A request is judged by its own role list against a map literal of the configured roles, so the log is
    not shuffled. No roles (or NULL) grant nothing; without a required list both flags are false.
    """
    none = F.array().cast("array<string>")
    pairs = [
        x
        for role, permissions in (roles or ROLE_PERMISSIONS).items()
        for x in (F.lit(role), F.array(*map(F.lit, permissions)).cast("array<string>"))
    ]
    granted = F.flatten(
        F.transform(
            F.coalesce(F.col(held), none), lambda role: F.coalesce(F.try_element_at(F.create_map(*pairs), role), none)
        )
    )
    return log.withColumns(
        {
            "has_any": F.coalesce(F.arrays_overlap(granted, required), F.lit(False)),
            "has_all": F.coalesce(F.size(F.array_except(required, granted)) == 0, F.lit(False))
            & F.col(required).isNotNull(),
        }
    )


def granted_requests(log: DataFrame, permissions: DataFrame, user: str = "user_id", needs: str = "permission") -> DataFrame:
    return log.join(permissions, [user, needs], "left_semi")


def denied_requests(log: DataFrame, permissions: DataFrame, user: str = "user_id", needs: str = "permission") -> DataFrame:
    return log.join(permissions, [user, needs], "left_anti")
