"""Task runner and audit trail.

A ``Task`` declares its inputs (raw feeds or upstream tables), its output
table and a build function. ``Workflow.run`` executes tasks in
dependency order; tasks whose inputs are ready run concurrently (Spark
schedules jobs from several driver threads). A task ends with one write, with
the row count observed on it; builds with end dates or surrogate keys also
write their ordered tables before. All audit rows are appended in one write at
the end, also when a task failed.

A run reads one state of the warehouse: the files of the feeds and the versions
of the tables are listed when it begins, and a task's output is read at the
version that this run committed, whatever others write meanwhile. Values that
a feed's declared type does not take are counted in the same pass (audit row)
and kept in the quarantine table.

What a task has finished is put into the run's ledger, one small file per task
and attempt. ``run(spark, run_id)`` of a run that ended early does only the tasks
that are not finished there; the others' tables are read at the versions they
committed, and every record reaches the audit log once.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierforge.plans import tables as T
from tierforge.sources import commits
from tierforge.sources.io import (
    Layout,
    append_rows,
    configure_storage,
    read_feed,
    read_table,
    table_format,
    write_feed,
    write_version,
)
from tierforge.sources.rejects import CheckedFeed, read_checked
from tierforge.sources.schemas import AUDIT, FEEDS, QUARANTINE

log = logging.getLogger("tierforge")

# Task statuses and the "unknown" defaults of an audit row.
SUCCESS, FAILED, SKIPPED, UNKNOWN_STATUS = "SUCCESS", "FAILED", "SKIPPED", "UNKNOWN"
UNKNOWN_NAME = "unknown"

FEED_PREFIX = "feed:"


@dataclass(frozen=True)
class Task:
    name: str
    layer: str
    output: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    bucket_by: tuple[str, int] | None = None      # layout of the output: (column, buckets)

    def upstream(self) -> list[str]:
        return [i for i in self.inputs if not i.startswith(FEED_PREFIX)]


@dataclass
class AuditRecord:
    task_name: str = UNKNOWN_NAME
    layer: str = UNKNOWN_NAME
    status: str = UNKNOWN_STATUS
    rows_processed: int = 0
    start_time: dt.datetime | None = None
    end_time: dt.datetime | None = None
    error_message: str | None = None
    job_group: str | None = None           # Spark job group of the task's jobs (not written to the log)
    rejects: dict[str, int] = field(default_factory=dict)     # rejected values: "feed.column" -> count
    rows_rejected: int = 0                 # feed records with such values
    version: int | None = None             # version of the table that the task committed (not written to the log)
    duration_seconds: float = field(init=False, default=0.0)

    def __post_init__(self) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        self.start_time = self.start_time or now
        self.end_time = self.end_time or now
        self.duration_seconds = (self.end_time - self.start_time).total_seconds()

    def row(self, executed_at: dt.datetime) -> tuple:
        return (self.task_name, self.layer, self.status, int(self.rows_processed or 0), self.start_time,
                self.end_time, float(self.duration_seconds), self.error_message, executed_at,
                int(self.rows_rejected), json.dumps(self.rejects, sort_keys=True) if self.rejects else None)

    def note(self) -> str:
        """The record as the ledger keeps it."""
        kept = {k: v for k, v in self.__dict__.items() if k != "duration_seconds"}
        return json.dumps(kept | {"start_time": self.start_time.isoformat(), "end_time": self.end_time.isoformat()})

    @staticmethod
    def from_note(text: str) -> AuditRecord:
        kept = json.loads(text)
        return AuditRecord(**kept | {k: dt.datetime.fromisoformat(kept[k]) for k in ("start_time", "end_time")})


def warehouse_tasks(as_of: str | None = None, key_method: str = "ranged", buckets: int | None = None) -> list[Task]:
    """The nine table builds of the sales warehouse, with their dependencies.

    With ``buckets`` the sales and the customer dimension are stored in that many
    buckets of the customer id, so that the fact's customer lookup (J5) joins
    bucket by bucket, without an exchange.
    """
    by = {"silver_sales": "sls_cust_id", "dim_customers": "customer_id"} if buckets else {}
    tasks = [
        Task("silver.crm_cust_info", "silver", "silver_customers", ("feed:customers",), T.silver_customers),
        Task("silver.crm_prd_info", "silver", "silver_product_versions", ("feed:products",),
             T.silver_product_versions),
        Task("silver.crm_sales_details", "silver", "silver_sales", ("feed:sales",), T.silver_sales),
        Task("silver.erp_cust_az12", "silver", "silver_erp_customers", ("feed:erp_customers",),
             lambda raw: T.silver_erp_customers(raw, as_of)),
        Task("silver.erp_loc_a101", "silver", "silver_erp_locations", ("feed:erp_locations",),
             T.silver_erp_locations),
        Task("silver.erp_px_cat_g1v2", "silver", "silver_categories", ("feed:categories",), T.silver_categories),
        Task("gold.dim_customers", "gold", "dim_customers",
             ("silver_customers", "silver_erp_customers", "silver_erp_locations"),
             lambda c, e, l: T.dim_customers(c, e, l, key_method)),
        Task("gold.dim_products", "gold", "dim_products", ("silver_product_versions", "silver_categories"),
             lambda v, c: T.dim_products(v, c, key_method)),
        Task("gold.fact_sales", "gold", "fact_sales", ("silver_sales", "dim_products", "dim_customers"),
             T.fact_sales),
    ]
    return [replace(t, bucket_by=(by[t.output], buckets)) if t.output in by else t for t in tasks]


class Workflow:
    """Run ``tasks`` against ``layout``.

    ``on_failure="skip"`` (default): a task whose upstream failed is SKIPPED,
    not run on stale tables. ``"continue"`` runs it anyway (source parity).
    ``feed_schemas`` replaces declared schemas of feeds.
    """

    def __init__(self, tasks: Sequence[Task], layout: Layout, fmt: str | None = None,
                 on_failure: str = "skip", max_parallel: int = 4, explicit_schemas: bool = True,
                 feed_schemas: Mapping[str, StructType] | None = None) -> None:
        if on_failure not in ("skip", "continue"):
            raise ValueError("on_failure must be 'skip' or 'continue'")
        self.tasks = list(tasks)
        self.layout = layout
        self.fmt = fmt
        self.on_failure = on_failure
        self.max_parallel = max_parallel
        self.explicit_schemas = explicit_schemas
        self.feed_schemas = {**FEEDS, **(feed_schemas or {})}
        self._snapshots: dict[str, commits.Snapshot] = {}
        outputs = {t.output for t in self.tasks}
        for t in self.tasks:
            missing = [u for u in t.upstream() if u not in outputs]
            if missing:
                raise ValueError(f"task {t.name} reads tables no task writes: {missing}")

    def _snapshot(self, spark: SparkSession, fmt: str) -> commits.Snapshot:
        """Feed files and table versions as they are now (tables of other formats are not pinned)."""
        tables = {self.layout.table(u) for t in self.tasks for u in t.upstream()} if fmt == "parquet" else set()
        feeds = {self.layout.feed(i[len(FEED_PREFIX):]) for t in self.tasks for i in t.inputs if i.startswith(FEED_PREFIX)}
        return commits.Snapshot(spark, sorted(tables), sorted(feeds))

    def _input(self, spark: SparkSession, name: str, fmt: str, snapshot: commits.Snapshot,
               checked: dict[str, CheckedFeed]) -> DataFrame:
        if name.startswith(FEED_PREFIX):
            feed = name[len(FEED_PREFIX):]
            files = snapshot.feed(self.layout.feed(feed))
            if not self.explicit_schemas:
                return read_feed(spark, files)
            checked[feed] = read_checked(spark, files, self.feed_schemas[feed])
            return checked[feed].rows
        path = self.layout.table(name)
        return snapshot.table(spark, path) if fmt == "parquet" else read_table(spark, path, fmt)

    def _quarantine(self, spark: SparkSession, feed: str, found: CheckedFeed, run_id: str) -> None:
        rows = found.flagged.select(F.lit(feed).alias("feed"), "record", "rejected", F.lit(run_id).alias("run_id"))
        commits.append(rows.select(*[F.col(f.name).cast(f.dataType) for f in QUARANTINE]), self.layout.quarantine(), run_id)

    def _run_task(self, spark: SparkSession, task: Task, fmt: str, run_id: str) -> AuditRecord:
        start = dt.datetime.now(dt.timezone.utc)
        snapshot, checked = self._snapshots[run_id], {}
        # One job group per task run (thread-local): its jobs can be listed or
        # cancelled together (SparkContext.cancelJobGroup).
        group = f"tierforge-{run_id}-{task.name}"
        spark.sparkContext.setJobGroup(group, f"tierforge task {task.name}")
        rows, status, error, version = 0, SUCCESS, None, None
        rejects, rows_rejected = {}, 0
        try:
            log.info("task %s: start", task.name)
            df = task.build(*[self._input(spark, i, fmt, snapshot, checked) for i in task.inputs])
            if not isinstance(df, DataFrame):
                raise TypeError(f"task {task.name} must build a DataFrame, got {type(df).__name__}")
            path = self.layout.table(task.output)
            rows, made = write_version(df, path, fmt, label=run_id, bucket_by=task.bucket_by)
            for feed, found in checked.items():
                if found.rows_rejected():
                    rejects.update({f"{feed}.{c}": n for c, n in found.counts().items()})
                    rows_rejected += found.rows_rejected()
                    self._quarantine(spark, feed, found, run_id)
            if made is not None:
                snapshot.committed(path, made)
                version = made.number
        except Exception as exc:  # noqa: BLE001 - one failed task must not lose the others' audit rows
            log.exception("task %s failed", task.name)
            rows, status, error, version = 0, FAILED, str(exc), None
        return AuditRecord(task.name, task.layer, status, rows, start, dt.datetime.now(dt.timezone.utc), error,
                           job_group=group, rejects=rejects, rows_rejected=rows_rejected, version=version)

    def _ledger(self, spark: SparkSession, run_id: str) -> tuple[int, dict[str, AuditRecord], list[AuditRecord]]:
        """Attempts so far, finished tasks, and records that the audit log may lack."""
        folder, finished, last = self.layout.ledger(run_id), {}, {}
        notes = sorted((int(n.split("-", 1)[0]), n) for n in commits.names(spark, folder) if n[0].isdigit())
        attempts = max((a for a, _ in notes), default=-1) + 1
        # an audit append labelled run/attempt holds the records of all attempts up to that one
        labels = [x.rpartition("/") for x in commits.labels(spark, self.layout.audit())] if notes else []
        logged = max((int(a) for r, _, a in labels if r == run_id), default=-1)
        unlogged = []
        for attempt, name in notes:
            record = AuditRecord.from_note(commits.read_text(spark, os.path.join(folder, name)))
            last[record.task_name] = record
            if attempt > logged:
                unlogged.append(record)
        tables = {t.name: self.layout.table(t.output) for t in self.tasks}
        for name, record in last.items():
            if record.status == SUCCESS and name in tables and record.version in commits.versions(spark, tables[name]):
                finished[name] = record
        return attempts, finished, unlogged

    def run(self, spark: SparkSession, run_id: str | None = None) -> list[AuditRecord]:
        """Run all tasks, or with the ``run_id`` of an earlier run those that it has not finished."""
        fmt = self.fmt or table_format(spark)
        run_id = run_id or uuid.uuid4().hex[:12]
        by_output = {t.output: t for t in self.tasks}
        done: dict[str, AuditRecord] = {}
        attempt, finished, unlogged = self._ledger(spark, run_id)
        snapshot = self._snapshots[run_id] = self._snapshot(spark, fmt)
        for task in self.tasks:
            if task.name in finished:
                path = self.layout.table(task.output)
                done[task.name] = finished[task.name]
                snapshot.committed(path, commits.version(spark, path, finished[task.name].version))
        again = set(done)
        pending = [t for t in self.tasks if t.name not in done]
        running: dict = {}

        def close(task: Task, record: AuditRecord) -> None:
            done[task.name] = record
            commits.put_new(spark, os.path.join(self.layout.ledger(run_id), f"{attempt}-{task.name}.json"), record.note())

        try:
            with ThreadPoolExecutor(max_workers=self.max_parallel) as pool:
                while pending or running:
                    progressed = False
                    for task in list(pending):
                        ups = [by_output[u].name for u in task.upstream()]
                        if any(u not in done for u in ups):
                            continue
                        pending.remove(task)
                        progressed = True
                        bad = [u for u in ups if done[u].status != SUCCESS]
                        if bad and self.on_failure == "skip":
                            close(task, AuditRecord(task.name, task.layer, SKIPPED, 0,
                                                    error_message=f"upstream not successful: {bad}"))
                            continue
                        running[pool.submit(self._run_task, spark, task, fmt, run_id)] = task
                    if not running:
                        if pending and not progressed:
                            raise ValueError(f"cyclic task dependencies among {[t.name for t in pending]}")
                        continue
                    ended, _ = wait(list(running), return_when=FIRST_COMPLETED)
                    for fut in ended:
                        task = running.pop(fut)
                        close(task, fut.result())
        finally:
            records = [done[t.name] for t in self.tasks if t.name in done]
            fresh = unlogged + [r for r in records if r.task_name not in again]
            write_audit(spark, fresh, self.layout.audit(), f"{run_id}/{attempt}")
            del self._snapshots[run_id]
        return records


def run_warehouse(spark: SparkSession, root: str, storage_settings: dict[str, str] | None = None,
                  as_of: str | None = None, on_failure: str = "skip", key_method: str = "ranged",
                  fmt: str | None = None, explicit_schemas: bool = True,
                  feed_paths: dict[str, str] | None = None, run_id: str | None = None,
                  buckets: int | None = None) -> list[AuditRecord]:
    """The whole load in one call: storage settings, nine tasks, audit append.

    Feeds are read from ``<root>/bronze`` (or ``feed_paths``, see ``Layout``); tables go to ``<root>/silver`` and
    ``<root>/gold``; audit rows to ``<root>/audit``. ``run_id`` names the run; given
    again after a failure, it resumes that run.
    """
    if storage_settings:
        configure_storage(spark, storage_settings)
    tasks = warehouse_tasks(as_of=as_of, key_method=key_method, buckets=buckets)
    return Workflow(tasks, Layout(root, feed_paths or {}), fmt=fmt, on_failure=on_failure,
                    explicit_schemas=explicit_schemas).run(spark, run_id)


def write_audit(spark: SparkSession, records: Sequence[AuditRecord], path: str, label: str = "") -> None:
    """Every record of a run in one append (one small file per run)."""
    if not records:
        return
    executed_at = dt.datetime.now(dt.timezone.utc)
    append_rows(spark, [r.row(executed_at) for r in records], AUDIT, path, label)


def write_feeds(feeds: dict[str, DataFrame], layout: Layout) -> None:
    """Write raw feeds as headed CSV under ``layout`` (test and bench setup); side by side, so that none waits for another's last tasks."""
    with ThreadPoolExecutor(max_workers=max(1, len(feeds))) as pool:
        writes = [pool.submit(write_feed, df, layout.feed(name)) for name, df in feeds.items()]
    for w in writes:
        w.result()
