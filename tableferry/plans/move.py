"""Moving one table or a batch of tables: read, load, verify, clean up."""

from __future__ import annotations

import hashlib
import json
import logging
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.mapping import map_schema, map_schema_flagged, split_rejects, target_schema
from tableferry.functions.nested import quoted
from tableferry.operators.incremental import incremental, incremental_by_key, rows_not_in
from tableferry.operators.load import LoadResult, load_direct, load_permissive, load_staged, prepare, remove_stage, stage_path
from tableferry.operators.verify import verify_checksum, verify_counts
from tableferry.leases import cross_out, note
from tableferry.session import has_source, scratch_root, text_frame
from tableferry.sources.batch_config import read_config
from tableferry.sources.catalog import Definition, Pointer, create_schema, quote_name, read_pointer, table_definition, table_exists
from tableferry.sources.files import path_exists, write_text
from tableferry.sources.log_table import (
    TableLog,
    latest_version,
    log_detail,
    open_log,
    read_after,
    read_since,
    read_table,
    scan_snapshot,
    split_version,
    table_detail,
)

log = logging.getLogger("tableferry")

POOL = "spark.scheduler.pool"
# What a data source says of a table that is not there yet.
ABSENT = ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND")
# Both words for each route are accepted.
METHODS = {"staged": "staged", "parquet": "staged", "direct": "direct", "connector": "direct"}
RESULT_SCHEMA = """
  `table` string, status string, method string, mode string, source_version bigint, source_rows bigint,
  target_rows bigint, verified boolean, seconds double, staged_path string, error string"""


@dataclass(frozen=True)
class Job:
    """What to move where. ``format`` names a connector; without it the session catalog is the target.

    Three ways to move only what is new, all for appends: ``since`` takes the
    rows of commits after a time, ``incremental_column`` the rows above the
    target's largest value, ``key`` the rows whose key the target lacks. With
    ``switch`` the target is a pointer, which stores the source version it holds
    in the step that shows the rows; an append that states none of the three
    then takes what the source committed since.
    """

    source_path: str | None
    table: str | None
    schema: str | None = "default"
    catalog: str | None = None
    project: str | None = None
    stage_root: str | None = None
    method: str = "staged"
    mode: str = "overwrite"
    nested: str = "json"
    version: int | None = None
    format: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    date_columns: tuple[str, ...] = ()
    time_columns: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    incremental_column: str | None = None
    since: str | None = None
    keep_nulls: bool = False
    map_types: bool = False
    rejects: str | None = None
    switch: bool = False

    @property
    def mapped(self) -> bool:
        """True when source types become those of the target system."""
        return bool(self.map_types or self.rejects or self.date_columns or self.time_columns)

    @property
    def target(self) -> str:
        """Full table name; a project only means something to a connector."""
        parts = (self.project if self.format else self.catalog, self.schema, self.table)
        return ".".join(p for p in parts if p)

    def check(self) -> None:
        missing = [name for name in ("source_path", "schema", "table") if not getattr(self, name)]
        if missing:
            raise ValueError(f"missing {', '.join(missing)}")
        if self.method not in METHODS:
            raise ValueError(f"unknown method {self.method!r}, expected staged or direct")
        if (self.key or self.incremental_column or self.since) and self.mode != "append":
            raise ValueError("key, incremental_column and since only make sense with mode append")
        if self.switch and self.format:
            raise ValueError("only a catalog table can be behind a pointer")
        if self.mode == "partitions" and (self.format or self.switch or self.rejects):
            raise ValueError("partitions can only be replaced in a plain catalog table, without setting rows aside")
        if self.rejects and (self.format or METHODS[self.method] != "staged"):
            raise ValueError("rows can only be set aside on the staged way into a catalog table")


@dataclass(frozen=True)
class Source:
    """What a job reads: rows pinned at one version, so that load and check see the same."""

    rows: DataFrame
    version: int | None = None
    partition_by: tuple[str, ...] = ()
    unfiltered: DataFrame | None = None

    @property
    def whole(self) -> DataFrame:
        """All rows, also where ``rows`` are only what an append still has to add."""
        return self.rows if self.unfiltered is None else self.unfiltered


def _mark(job: Job) -> str:
    """Name of the mark that holds a source's version."""
    return "version of " + split_version(job.source_path)[0].rstrip("/")


def _held_version(pointer: Pointer | None, job: Job) -> int | None:
    """The source version from which an append with nothing stated goes on; ``None`` to read the whole source."""
    if pointer is None or job.mode != "append" or job.since or job.key or job.incremental_column:
        return None
    held = pointer.marks.get(_mark(job))
    return None if held is None else int(held)


def _new_marks(job: Job, source: Source) -> dict[str, str]:
    """What a load into a pointer proves: afterwards the target holds this version. Appends by time or high-water mark prove less."""
    if source.version is None or job.since or job.incremental_column:
        return {}
    return {_mark(job): str(source.version)}


def _read_source(spark: SparkSession, job: Job, held: int | None = None) -> Source:
    path, version = split_version(job.source_path, job.version)
    if has_source(spark, "delta"):
        version = latest_version(spark, path) if version is None else version
        rows = _read_rows(spark, job, path, version, held)
        detail = table_detail(spark, path).first()
        source = Source(rows, version, tuple(c for c in detail.partition_columns.split(",") if c))
    else:
        source = _replay_source(spark, job, path, version, held)
    if job.mapped and not job.rejects:
        schema = target_schema(source.rows.schema, job.date_columns, job.time_columns)
        source = replace(source, rows=map_schema(source.rows, schema))
    return source


def _read_rows(spark: SparkSession, job: Job, path: str, version: int, held: int | None) -> DataFrame:
    if job.since:
        return read_since(spark, path, job.since, version)
    return read_table(spark, path, version) if held is None else read_after(spark, path, held, version)


def _replay_source(spark: SparkSession, job: Job, path: str, version: int | None, held: int | None) -> Source:
    try:
        opened = open_log(spark, path, version)
    except FileNotFoundError:
        if version is not None or job.since or held is not None or not path_exists(spark, path):
            raise
        return Source(read_table(spark, path, fmt="parquet"))
    _report_detail(opened)
    rows = scan_snapshot(spark, opened) if not job.since and held is None else _read_rows(spark, job, path, opened.version, held)
    return Source(rows, opened.version, tuple(opened.partition_columns))


def _report_detail(opened: TableLog) -> None:
    """Metadata is nice to have in the log; its absence never fails a job."""
    try:
        log.info("source %s", log_detail(opened).first().asDict())
    except Exception as error:
        log.warning("no metadata for %s: %s", opened.root, error)


def connector_options(job: Job) -> dict[str, str]:
    """Options for the target's data source; a warehouse connector it knows gets its usual ones as defaults."""
    if job.format != "bigquery":
        return dict(job.options)
    defaults = {"table": job.target, "writeMethod": "direct"}
    if job.stage_root:
        defaults["temporaryGcsBucket"] = job.stage_root.removeprefix("gs://").split("/", 1)[0]
    if len(job.partition_by) == 1:
        defaults.update(partitionField=job.partition_by[0], partitionType="DAY")
    if job.cluster_by:
        defaults["clusteredFields"] = ",".join(job.cluster_by)
    return {**defaults, **job.options}


def _read_target(spark: SparkSession, job: Job) -> DataFrame:
    if job.format:
        return spark.read.format(job.format).options(**connector_options(job)).load()
    return spark.table(quote_name(job.target))


def _rows_before(spark: SparkSession, job: Job, count: bool) -> int | None:
    """Rows an append finds in its target, 0 if they need not be counted; ``None`` when there is no target yet."""
    if not job.format and not table_exists(spark, job.target):
        return None
    try:
        target = _read_target(spark, job)
    except AnalysisException as error:
        # A connector tells a table that does not exist like this; any other failure must stop the job,
        # as an append that takes its target for empty adds everything again.
        if job.format and error.getCondition() in ABSENT:
            return None
        raise
    return target.count() if count else 0


def _layout(spark: SparkSession, job: Job, source: Source) -> Definition | None:
    """The job's layout, else that of the existing target, else the source's partitioning."""
    if job.partition_by or job.cluster_by:
        return Definition(job.partition_by, job.cluster_by)
    if job.format or table_exists(spark, job.target):
        return None
    return Definition(source.partition_by)


def _load(spark: SparkSession, job: Job, source: Source, staged: list[str], notes: list[str]) -> LoadResult:
    """Load what was read. Staged copies are written down first, so that a sweep finds those of dead runs."""
    settings = {"nested": job.nested, "keep_nulls": job.keep_nulls, "definition": _layout(spark, job, source)}
    # A source is a scan, unless keys were looked up in the target.
    settings["shrink"] = "rebalance" if job.key else "coalesce"
    if not job.format and (job.switch or read_pointer(spark, job.target)):
        settings.update(switch=True, marks=_new_marks(job, source))
    if job.rejects:
        root = job.stage_root or f"{scratch_root(spark)}/stage"
        schema = target_schema(source.rows.schema, job.date_columns, job.time_columns)
        staged.append(stage_path(root, job.target))
        notes.append(note(spark, "path", staged[-1]))
        return load_permissive(source.rows, schema, job.target, job.rejects, root, job.mode, skip_known=bool(job.key), path=staged[-1], **settings)[0]
    settings.update(fmt=job.format, options=connector_options(job))
    if METHODS[job.method] == "direct":
        return load_direct(source.rows, job.target, job.mode, **settings)
    root = job.stage_root or f"{scratch_root(spark)}/stage"
    staged.append(stage_path(root, job.target))
    notes.append(note(spark, "path", staged[-1]))
    return load_staged(source.rows, job.target, root, job.mode, path=staged[-1], **settings)


def _new_rows(job: Job, source: DataFrame, target: DataFrame) -> DataFrame:
    """What an append still has to add."""
    if job.incremental_column and job.key:
        return incremental_by_key(source, target, job.incremental_column, list(job.key))
    if job.incremental_column:
        return incremental(source, target, job.incremental_column)
    return rows_not_in(source, target, list(job.key)) if job.key else source


def _verify(spark: SparkSession, job: Job, source: Source, before: int, result: LoadResult) -> tuple[bool, int | None]:
    """Count both sides; a check that cannot be carried out counts as failed.

    With a key, the rows still to add are none by now, so the target must hold
    what it held plus what was written, and no key of the whole source may be
    missing from it, but for those of rows that are set aside.
    """
    try:
        target = _read_target(spark, job)
        if job.mode == "partitions":  # only those that the source has rows of
            columns = table_definition(spark, job.target).partition_by
            target = rows_in(target, prepare(source.rows, job.nested, job.keep_nulls), columns) if columns else target
        if not job.key:
            row = verify_counts(source.rows, target, before - result.rejected).first()
            return row.passed, row.target_rows
        row = verify_counts(source.rows.limit(0), target, before + result.rows).first()
        whole = source.whole
        if job.rejects:
            schema = target_schema(whole.schema, job.date_columns, job.time_columns)
            whole, _ = split_rejects(map_schema_flagged(whole, schema))
        keyed = whole.dropna(subset=[k for k in job.key])
        return row.passed and rows_not_in(keyed, target, list(job.key)).isEmpty(), row.target_rows
    except Exception as error:
        log.error("verification could not run: %s", error)
        return False, None


def rows_in(target: DataFrame, source: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows of ``target`` in partitions that ``source`` has rows of; nulls are a partition too."""
    wanted = source.select(*[quoted(c).alias(f"__p{i}") for i, c in enumerate(columns)]).distinct()
    same = reduce(lambda a, b: a & b, [quoted(c).eqNullSafe(F.col(f"__p{i}")) for i, c in enumerate(columns)])
    return target.join(wanted, same, "left_semi")


def _same_content(spark: SparkSession, job: Job, source: DataFrame) -> bool:
    """Compare digests of all rows as they were loaded; a check that cannot be carried out counts as failed."""
    try:
        return verify_checksum(prepare(source, job.nested, job.keep_nulls), _read_target(spark, job)).first().passed
    except Exception as error:
        log.error("checksum could not run: %s", error)
        return False


def run_job(
    spark: SparkSession,
    job: Job,
    verify: bool = True,
    cleanup: bool = True,
    strict_verify: bool = False,
    checksum: bool = False,
) -> dict:
    """Move one table and describe the outcome; failures are returned, not raised.

    ``verify`` counts both sides. ``checksum`` also compares the content, which
    reads both sides in full and needs an overwrite: an appended-to table holds more.
    """
    started = time.monotonic()
    outcome = dict.fromkeys([f.strip().split()[0].strip("`") for f in RESULT_SCHEMA.split(",")])
    outcome.update(table=job.table, status="FAILED", method=job.method, mode=job.mode)
    staged: list[str] = []
    notes: list[str] = []
    try:
        job.check()
        pointer = None if job.format else read_pointer(spark, job.target)
        source = _read_source(spark, job, _held_version(pointer, job))
        outcome["source_version"] = source.version
        if not job.format:
            create_schema(spark, job.target.rsplit(".", 1)[0])
        before = _rows_before(spark, job, verify) if job.mode == "append" else None
        if before is not None:
            source = replace(source, rows=_new_rows(job, source.rows, _read_target(spark, job)), unfiltered=source.rows)
        result = _load(spark, job, source, staged, notes)
        outcome["source_rows"] = result.rows
        outcome["staged_path"] = result.staged_path
        if verify:
            outcome["verified"], outcome["target_rows"] = _verify(spark, job, source, before or 0, result)
            if checksum and job.mode == "overwrite" and outcome["verified"]:
                outcome["verified"] = _same_content(spark, job, source.rows)
            if strict_verify and not outcome["verified"]:
                raise ValueError(f"{job.target} does not hold the rows that were loaded")
        outcome["status"] = "SUCCESS"
    except Exception as error:
        log.error("moving %s failed", job.table, exc_info=log.isEnabledFor(logging.INFO))
        outcome["error"] = str(error).split("\n", 1)[0]
    finally:
        if cleanup:
            for path in staged:
                remove_stage(spark, path)
            outcome["staged_path"] = None
        for place in notes:  # removed, or kept on purpose
            cross_out(spark, place)
    outcome["seconds"] = round(time.monotonic() - started, 3)
    return outcome


def _results(spark: SparkSession, outcomes: list[dict]) -> DataFrame:
    lines = text_frame(spark, [json.dumps(o) for o in outcomes])
    return lines.select(F.from_json("value", RESULT_SCHEMA).alias("row")).select("row.*")


def move_table(spark: SparkSession, job: Job, **flags: bool) -> DataFrame:
    """One result row for one table."""
    return _results(spark, [run_job(spark, job, **flags)])


def jobs_from_config(spark: SparkSession, path: str, method: str | None = None, mode: str | None = None) -> list[Job]:
    """Jobs of a configuration; ``method`` and ``mode`` fill in where an entry states none."""
    jobs = []
    for row in read_config(spark, path).collect():
        given = {k: tuple(v) if isinstance(v, list) else v for k, v in row.asDict().items() if v is not None}
        given.setdefault("source_path", None)
        given.setdefault("table", None)
        given.setdefault("schema", None)
        given.setdefault("method", method or "staged")
        given.setdefault("mode", mode or "overwrite")
        jobs.append(Job(**given))
    return jobs


LEDGER_SCHEMA = f"job string, finished timestamp, outcome struct<{RESULT_SCHEMA.replace(' string', ': string').replace(' bigint', ': bigint').replace(' boolean', ': boolean').replace(' double', ': double')}>"


def job_id(job: Job) -> str:
    """Tells jobs apart in a ledger: all that a job states."""
    return hashlib.sha256(json.dumps(asdict(job), sort_keys=True).encode()).hexdigest()


def finished_jobs(spark: SparkSession, ledger: str) -> dict[str, dict]:
    """Outcomes of the jobs that a ledger counts as done: moved, and not found wrong. One row per job of the batch."""
    if not path_exists(spark, ledger):
        return {}
    rows = spark.read.schema(LEDGER_SCHEMA).option("recursiveFileLookup", "true").json(ledger)
    done = rows.filter("outcome.status = 'SUCCESS' and coalesce(outcome.verified, true)")
    return {r.job: r.outcome.asDict() for r in done.groupBy("job").agg(F.max_by("outcome", "finished").alias("outcome")).collect()}


def _enter(spark: SparkSession, ledger: str, job: Job, outcome: dict) -> None:
    """One file per finished job, so that parallel jobs never share one."""
    line = json.dumps({"job": job_id(job), "finished": datetime.now(timezone.utc).isoformat(), "outcome": outcome})
    write_text(spark, f"{ledger}/{uuid.uuid4().hex}.json", line)


def move_all(
    spark: SparkSession,
    config_path: str,
    method: str | None = None,
    mode: str | None = None,
    parallel: int = 1,
    ledger: str | None = None,
    **flags: bool,
) -> DataFrame:
    """One result row per configured table, in order; one table's failure does not stop the rest.

    ``parallel`` tables are submitted at a time, each to a scheduler pool of its
    own: the pools get equal shares of the cluster, so a small table does not
    wait for the tasks of a large one.

    ``ledger`` names a folder in which finished tables are written down. A run
    with the same ledger passes over tables whose job is in it, stated alike,
    and moves the rest: those that failed, that a dead run never reached, or
    whose entry in the configuration changed. Their earlier results are returned.
    """
    jobs = jobs_from_config(spark, config_path, method, mode)
    done = finished_jobs(spark, ledger) if ledger else {}

    def one(job: Job) -> dict:
        if job_id(job) in done:
            log.info("%s was moved before", job.table)
            return done[job_id(job)]
        context = spark.sparkContext
        before = context.getLocalProperty(POOL)
        context.setLocalProperty(POOL, job.table or "unnamed")
        try:
            outcome = run_job(spark, job, **flags)
        finally:
            context.setLocalProperty(POOL, before)
        if ledger:
            _enter(spark, ledger, job, outcome)
        return outcome

    if parallel <= 1:
        return _results(spark, [one(job) for job in jobs])
    # a target for each job: threads of one target would share the properties that hold the pool
    targets = [inheritable_thread_target(spark)(one) for _ in jobs]
    with ThreadPoolExecutor(parallel) as pool:
        return _results(spark, list(pool.map(lambda target, job: target(job), targets, jobs)))


def batch_totals(results: DataFrame) -> DataFrame:
    """One row: tables that succeeded, and all tables."""
    return results.agg(F.count_if(F.col("status") == "SUCCESS").alias("succeeded"), F.count("*").alias("tables"))
