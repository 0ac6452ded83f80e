"""Tables kept as Parquet files plus a transaction log of JSON commits.

Where a ``delta`` data source is installed it does the reading and writing.
Without it the log is replayed with DataFrame operations: commits and the
newest checkpoint are read as tables, reduced to the live files, and only those
files are scanned. Tables that need a reader feature beyond that are refused.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.nested import quoted
from tableferry.session import empty_frame, has_source, text_frame
from tableferry.sources.files import (
    decode_uri,
    encode_uri,
    list_files,
    plain_location,
    publish_single_file,
    qualified,
    read_plain,
    row_location,
)

LOG_FOLDER = "_delta_log"
LOG_SCHEMA = """
  add struct<path: string, partitionValues: map<string, string>, size: bigint, modificationTime: bigint,
             dataChange: boolean, stats: string, deletionVector: struct<storageType: string>>,
  remove struct<path: string, partitionValues: map<string, string>, size: bigint, deletionTimestamp: bigint,
                dataChange: boolean>,
  cdc struct<path: string, partitionValues: map<string, string>, size: bigint, dataChange: boolean>,
  metaData struct<id: string, name: string, description: string, format: struct<provider: string>,
                  schemaString: string, partitionColumns: array<string>, configuration: map<string, string>,
                  createdTime: bigint>,
  protocol struct<minReaderVersion: int, minWriterVersion: int, readerFeatures: array<string>,
                  writerFeatures: array<string>>,
  commitInfo struct<timestamp: bigint, operation: string>
"""
# Fixed values of the public log format.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
COMMIT_NAME = r"^(\d{20})\.json$"
CHECKPOINT_NAME = r"^(\d{20})\.checkpoint(?:\.(\d{10})\.(\d{10}))?\.parquet$"
HARMLESS_READER_FEATURES = {"timestampNtz", "vacuumProtocolCheck"}

# Files handed to one scan by name, or broadcast as a list (about 300 bytes each,
# so under 60 MB). More files make more scans; see scan_snapshot.
MAX_NAMED_FILES = 200_000

HISTORY_SCHEMA = """
  version bigint, committed_at timestamp, operation string, added bigint, removed bigint, added_records bigint"""


class UnsupportedTable(ValueError):
    """The table needs a feature the log replay does not implement."""


@dataclass(frozen=True)
class TableLog:
    """One version of a table as its log describes it. ``actions`` is lazy."""

    root: str
    version: int
    schema: T.StructType
    partition_columns: list[str]
    provider: str
    configuration: dict[str, str]
    actions: DataFrame = field(repr=False)


def split_version(path: str, version: int | None = None) -> tuple[str, int | None]:
    """Accept a version as a ``path@v12`` suffix."""
    match = re.fullmatch(r"(.+)@v(\d+)/?", path)
    if match is None:
        return path.rstrip("/"), version
    return match[1].rstrip("/"), int(match[2]) if version is None else version


def _log_names(spark: SparkSession, path: str) -> list[str]:
    """Names in the log folder; their number is bounded by the log's retention."""
    listed = list_files(spark, f"{path}/{LOG_FOLDER}", "*.{json,parquet}").select("path").collect()
    if not listed:
        raise FileNotFoundError(f"no table log below {path}")
    return [row.path.rsplit("/", 1)[1] for row in listed]


def _pick_log_files(names: list[str], version: int | None) -> tuple[int, int, list[str]]:
    """Version to read, first commit needed, and the checkpoint parts to start from."""
    commits = {int(m[1]) for m in (re.match(COMMIT_NAME, n) for n in names) if m}
    parts: dict[tuple[int, int], list[str]] = {}
    for name in names:
        m = re.match(CHECKPOINT_NAME, name)
        if m:
            parts.setdefault((int(m[1]), int(m[3] or 1)), []).append(name)
    complete = {v: found for (v, total), found in sorted(parts.items()) if len(found) == total}
    known = commits | set(complete)
    if not known:
        raise UnsupportedTable("the log has no commit and no complete single or multi-part checkpoint")
    wanted = max(known) if version is None else version
    start = max((v for v in complete if v <= wanted), default=-1)
    missing = [v for v in range(start + 1, wanted + 1) if v not in commits]
    if missing:
        raise ValueError(f"version {wanted} cannot be built: commit {missing[0]} is not in the log")
    return wanted, start + 1, complete.get(start, [])


def _commits(spark: SparkSession, root: str, first: int, last: int) -> DataFrame:
    """Actions of the commits ``first..last``; the file-name filter prunes the listing before any read."""
    name = F.col("_metadata.file_name")
    return (
        spark.read.schema(LOG_SCHEMA)
        .option("pathGlobFilter", "*.json")
        # A damaged commit must stop the read; skipping its actions would change the table.
        .option("mode", "FAILFAST")
        .json(f"{root}/{LOG_FOLDER}")
        .filter(name.between(f"{first:020d}.json", f"{last:020d}.json") & name.rlike(COMMIT_NAME))
        .withColumn("version", F.substring(name, 1, 20).cast("bigint"))
    )


def open_log(spark: SparkSession, path: str, version: int | None = None) -> TableLog:
    """Read the log up to a version (latest by default) and check that replay can honour it."""
    path, version = split_version(path, version)
    names = _log_names(spark, path)
    root = qualified(spark, path)
    version, first, checkpoint = _pick_log_files(names, version)
    actions = None
    if first <= version:
        actions = _commits(spark, root, first, version)
    if checkpoint:
        base = (
            spark.read.schema(LOG_SCHEMA)
            .parquet(*[f"{root}/{LOG_FOLDER}/{name}" for name in checkpoint])
            .withColumn("version", F.lit(first - 1).cast("bigint"))
        )
        actions = base if actions is None else base.unionByName(actions)

    def latest(action: str) -> Column:
        return F.max_by(action, F.when(F.col(action).isNotNull(), F.col("version"))).alias(action)

    head = actions.agg(
        latest("metaData"),
        latest("protocol"),
        F.count_if(F.col("add.deletionVector").isNotNull()).alias("vectors"),
    ).first()
    if head.metaData is None:
        raise UnsupportedTable(f"the log of {path} holds no schema")
    configuration = head.metaData.configuration or {}
    _check_readable(path, head.protocol, configuration, head.vectors)
    return TableLog(
        root=root,
        version=version,
        schema=T.StructType.fromJson(json.loads(head.metaData.schemaString)),
        partition_columns=list(head.metaData.partitionColumns or []),
        provider="delta",
        configuration=dict(configuration),
        actions=actions,
    )


def latest_version(spark: SparkSession, path: str) -> int:
    """Newest version in the log, from file names alone."""
    path, _ = split_version(path)
    return _pick_log_files(_log_names(spark, path), None)[0]


def _check_readable(path: str, protocol, configuration: dict[str, str], vectors: int) -> None:
    needed = set((protocol.readerFeatures if protocol else None) or []) - HARMLESS_READER_FEATURES
    # Version 2 tables list no features; they only differ when a mapping mode is set.
    if configuration.get("delta.columnMapping.mode", "none") == "none":
        needed.discard("columnMapping")
    else:
        needed.add("columnMapping")
    if vectors:
        needed.add("deletionVectors")
    if protocol and protocol.minReaderVersion > 3:
        needed.add(f"reader version {protocol.minReaderVersion}")
    if needed:
        raise UnsupportedTable(f"{path} needs {', '.join(sorted(needed))}; install the delta data source to read it")


def _file_location(root: str, path: Column) -> Column:
    """Decoded, qualified location of a logged path, which may be relative, absolute or a full URI."""
    decoded = decode_uri(path)
    authority = re.match(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?", root)
    return plain_location(
        F.when(decoded.rlike("^[A-Za-z][A-Za-z0-9+.-]*:/"), decoded)
        .when(decoded.startswith("/"), F.concat(F.lit(authority[0] if authority else ""), decoded))
        .otherwise(F.concat(F.lit(root + "/"), decoded))
    )


def live_files(log: TableLog, where: str | Column | None = None) -> DataFrame:
    """Live data files: ``path, version, size, num_records, partition_values`` and each partition column, typed.

    The last action on a path decides. ``max_by`` is combined before the
    shuffle, so no path's history is gathered or sorted. ``where`` filters on
    partition columns and prunes files before anything is listed or scanned.
    """
    action = F.coalesce(
        F.when(F.col("add").isNotNull(), F.struct("add.path", "add.partitionValues", "add.size", "add.stats")),
        F.struct("remove.path", "remove.partitionValues", "remove.size", F.lit(None).cast("string").alias("stats")),
    )
    is_add = F.col("add").isNotNull()
    # Within one commit an add outranks a remove of the same path.
    rank = F.col("version") * 2 + F.col("is_add").cast("int")
    last = (
        log.actions.filter(is_add | F.col("remove").isNotNull())
        .select("version", is_add.alias("is_add"), action.alias("file"))
        .select("version", "is_add", "file", _file_location(log.root, F.col("file.path")).alias("path"))
        .groupBy("path")
        .agg(F.max_by(F.struct("version", "is_add", "file"), rank).alias("a"))
        .filter("a.is_add")
    )
    values = F.col("a.file.partitionValues")
    files = last.select(
        "path",
        F.col("a.version").alias("version"),
        F.col("a.file.size").alias("size"),
        _num_records(F.col("a.file.stats")).alias("num_records"),
        values.alias("partition_values"),
        *_partition_columns(log, values),
    )
    return files if where is None else files.filter(where)


def _num_records(stats: Column) -> Column:
    return F.get_json_object(stats, "$.numRecords").cast("bigint")


def _partition_columns(log: TableLog, values: Column) -> list[Column]:
    """Partition values live in the log as text; the empty string stands for null."""
    return [
        F.nullif(values[name], F.lit("")).cast(log.schema[name].dataType).alias(name)
        for name in log.partition_columns
    ]


def snapshot_files(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``path, version, size, num_records, partition_values`` of the files of a snapshot."""
    return live_files(open_log(spark, path, version)).select(
        "path", "version", "size", "num_records", "partition_values"
    )


def _folders_follow_values(log: TableLog) -> Column:
    """True for a file below the root whose folders spell its logged partition values, so Spark can read them from the path."""
    relative = F.substring(F.col("path"), len(log.root) + 2, 1 << 30)
    pattern = "^" + "".join(f"{re.escape(name)}=([^/]*)/" for name in log.partition_columns) + "[^/]*$"
    agrees = F.col("path").startswith(log.root + "/") & relative.rlike(pattern)
    for position, name in enumerate(log.partition_columns, start=1):
        spelled = decode_uri(F.regexp_extract(relative, pattern, position))
        logged = F.coalesce(F.nullif(F.col("partition_values")[name], F.lit("")), F.lit(NULL_PARTITION))
        agrees = agrees & (spelled == logged)
    return agrees


def scan_snapshot(
    spark: SparkSession,
    log: TableLog,
    where: str | Column | None = None,
    max_named_files: int = MAX_NAMED_FILES,
) -> DataFrame:
    """Rows of the live files, in schema order.

    Every live file is handed to a scan by name, ``max_named_files`` to a scan,
    and the scans are united: a file that is missing stops the read, and what
    else lies in the folder is never touched, however many files there are. No
    row is shuffled. Where folders spell the partition values, Spark reads them
    from the path, so that later filters on them prune files; other files get
    theirs from a broadcast list, one row per file of the scan.
    """
    files = live_files(log, where)
    spelled = files.filter(_folders_follow_values(log)).select("path")
    others = files.filter(~_folders_follow_values(log)).select(
        F.col("path").alias("__path"), *[quoted(name) for name in log.partition_columns]
    )
    columns = [quoted(name) for name in log.schema.names]
    reader = spark.read.schema(log.schema)
    if log.partition_columns:
        reader = reader.option("basePath", log.root)
    scans = [reader.parquet(*[row.path for row in some]) for some in _portions(spelled, max_named_files)]
    own = T.StructType([f for f in log.schema.fields if f.name not in log.partition_columns])
    scans += [_scan_keyed(spark, some, others.schema, own) for some in _portions(others, max_named_files)]
    if not scans:
        return empty_frame(spark, log.schema)
    return reduce(DataFrame.unionByName, [scan.select(*columns) for scan in scans])


def _portions(files: DataFrame, most: int) -> Iterator[list]:
    """Rows about files, in lists of at most ``most``. Names only: a scan's own file index holds as much."""
    rows = files.toLocalIterator()
    while some := list(islice(rows, max(1, most))):
        yield some


def _scan_keyed(spark: SparkSession, files: list, keyed: T.StructType, schema: T.StructType) -> DataFrame:
    """Rows of the files named in ``files.__path`` with the other values of ``files``, which are broadcast."""
    scan = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*sorted({row["__path"] for row in files}))
    return scan.withColumn("__path", row_location()).join(F.broadcast(spark.createDataFrame(files, keyed)), "__path")


def read_table(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    fmt: str = "auto",
    where: str | Column | None = None,
) -> DataFrame:
    """Snapshot of a table, latest or at a version (also as ``path@v12``).

    ``fmt="auto"`` takes the installed delta source, else replays the log if
    there is one, else reads plain Parquet. ``"log"`` and ``"parquet"`` force one way.
    """
    path, version = split_version(path, version)
    if fmt not in ("auto", "delta", "log", "parquet"):
        raise ValueError(f"unknown table format {fmt!r}")
    if fmt == "delta" or (fmt == "auto" and has_source(spark, "delta")):
        reader = spark.read.format("delta")
        if version is not None:
            reader = reader.option("versionAsOf", version)
        rows = reader.load(path)
        return rows if where is None else rows.filter(where)
    if fmt != "parquet":
        try:
            return scan_snapshot(spark, open_log(spark, path, version), where)
        except FileNotFoundError:
            if fmt == "log" or version is not None:
                raise
    rows = read_plain(spark, path)
    return rows if where is None else rows.filter(where)


def table_detail(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row: format, version, number of files, bytes, records (null when a file has no count), partition columns."""
    if has_source(spark, "delta") and version is None:
        path, version = split_version(path)
        if version is None:
            return spark.sql(f"DESCRIBE DETAIL delta.`{path}`").select(
                "format",
                F.lit(latest_version(spark, path)).cast("bigint").alias("version"),
                F.col("numFiles").alias("num_files"),
                F.col("sizeInBytes").alias("size_bytes"),
                F.lit(None).cast("bigint").alias("num_records"),
                F.array_join("partitionColumns", ",").alias("partition_columns"),
            )
    return log_detail(open_log(spark, path, version))


def log_detail(log: TableLog) -> DataFrame:
    complete = F.count("num_records") == F.count("*")
    return live_files(log).agg(
        F.lit(log.provider).alias("format"),
        F.lit(log.version).cast("bigint").alias("version"),
        F.count("*").alias("num_files"),
        F.coalesce(F.sum("size"), F.lit(0).cast("bigint")).alias("size_bytes"),
        F.when(complete, F.coalesce(F.sum("num_records"), F.lit(0).cast("bigint"))).alias("num_records"),
        F.lit(",".join(log.partition_columns)).alias("partition_columns"),
    )


def log_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per commit file still in the log: time, operation, files added and removed, records in added files."""
    path, _ = split_version(path)
    names = _log_names(spark, path)
    versions = [int(m[1]) for m in (re.match(COMMIT_NAME, n) for n in names) if m]
    if not versions:
        return empty_frame(spark, HISTORY_SCHEMA)
    return (
        _commits(spark, path, min(versions), max(versions))
        .groupBy("version")
        .agg(
            F.timestamp_millis(F.max("commitInfo.timestamp")).alias("committed_at"),
            F.max("commitInfo.operation").alias("operation"),
            F.count("add").alias("added"),
            F.count("remove").alias("removed"),
            F.sum(_num_records(F.col("add.stats"))).alias("added_records"),
        )
    )


def structure_report(spark: SparkSession, path: str) -> DataFrame:
    """One row: does a log exist, how many commits, checkpoints and data files lie in the folder."""
    path, _ = split_version(path)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    log = list_files(spark, f"{path}/{LOG_FOLDER}", "*.{json,parquet}")
    data = list_files(spark, path)
    zero = F.lit(0).cast("bigint")
    return (
        log.select(
            F.lit(True).alias("in_log"),
            name.rlike(COMMIT_NAME).alias("commit"),
            name.rlike(CHECKPOINT_NAME).alias("checkpoint"),
            zero.alias("data_bytes"),
        )
        .unionByName(
            data.select(
                F.lit(False).alias("in_log"),
                F.lit(False).alias("commit"),
                F.lit(False).alias("checkpoint"),
                F.col("size").alias("data_bytes"),
            )
        )
        .agg(
            F.coalesce(F.bool_or("in_log"), F.lit(False)).alias("log_exists"),
            F.count_if("commit").alias("commit_files"),
            F.count_if("checkpoint").alias("checkpoint_files"),
            F.count_if(~F.col("in_log")).alias("data_files"),
            F.coalesce(F.sum("data_bytes"), zero).alias("data_bytes"),
        )
    )


def _commit_times(spark: SparkSession, path: str) -> DataFrame:
    """``version, committed_at, has_change_files`` per commit still in the log; a commit that states no time has its file's."""
    versions = [int(m[1]) for m in (re.match(COMMIT_NAME, n) for n in _log_names(spark, path)) if m]
    if not versions:
        return empty_frame(spark, "version bigint, committed_at timestamp, has_change_files boolean")
    return (
        _commits(spark, path, min(versions), max(versions))
        .withColumn("written", F.col("_metadata.file_modification_time"))
        .groupBy("version")
        .agg(
            F.coalesce(F.timestamp_millis(F.max("commitInfo.timestamp")), F.max("written")).alias("committed_at"),
            (F.count("cdc") > 0).alias("has_change_files"),
        )
    )


def _changed(spark: SparkSession, log: TableLog, after: int, kinds: tuple[str, ...]) -> DataFrame:
    """Rows of the change files (``cdc``), added files (``add``) or removed files (``remove``) of the commits after one.

    A commit with change files is told by those alone. Rows of added files are
    inserts, rows of removed files deletes; every file asked for must be stored.
    """
    times = _commit_times(spark, log.root).filter(F.col("version").between(after + 1, log.version))
    present = {row.version for row in times.select("version").collect()}
    missing = [v for v in range(after + 1, log.version + 1) if v not in present]
    if missing:
        raise ValueError(f"changes need commit {missing[0]}, which is not in the log")
    commits = _commits(spark, log.root, after + 1, log.version).join(F.broadcast(times), "version")
    columns = [quoted(name) for name in log.schema.names]
    own = [f for f in log.schema.fields if f.name not in log.partition_columns]
    scans = []
    for action in kinds:
        told = action == "cdc"
        wanted = F.col(action).isNotNull() & (F.col("has_change_files") == told)
        files = commits.filter(wanted if told else wanted & F.col(f"{action}.dataChange")).select(
            _file_location(log.root, F.col(f"{action}.path")).alias("__path"),
            F.col("version").alias("_commit_version"),
            F.col("committed_at").alias("_commit_timestamp"),
            *_partition_columns(log, F.col(f"{action}.partitionValues")),
        )
        # A file added and later removed yields both changes, so a path may occur in two frames.
        schema = T.StructType([*own, T.StructField("_change_type", T.StringType())] if told else own)
        for some in _portions(files, MAX_NAMED_FILES):
            scan = _scan_keyed(spark, some, files.schema, schema)
            if not told:
                scan = scan.withColumn("_change_type", F.lit("insert" if action == "add" else "delete"))
            scans.append(scan.select(*columns, "_change_type", "_commit_version", "_commit_timestamp"))
    if not scans:
        return empty_frame(
            spark, T.StructType([*log.schema.fields, *T.StructType.fromDDL("_change_type string, _commit_version bigint, _commit_timestamp timestamp").fields])
        )
    return reduce(DataFrame.unionByName, scans)


def read_changes(spark: SparkSession, path: str, after: int, until: int | None = None) -> DataFrame:
    """Row changes of the commits ``after+1..until`` with ``_change_type, _commit_version, _commit_timestamp``.

    The installed delta source answers from its change feed. Without it a
    commit's own change files are used where it has them, else rows of added
    files count as inserts and rows of removed files as deletes.
    """
    path, _ = split_version(path)
    if has_source(spark, "delta"):
        feed = spark.read.format("delta").option("readChangeFeed", "true").option("startingVersion", after + 1)
        if until is not None:
            feed = feed.option("endingVersion", until)
        return feed.load(path)
    return _changed(spark, open_log(spark, path, until), after, ("cdc", "add", "remove"))


def read_since(spark: SparkSession, path: str, timestamp: str, until: int | None = None) -> DataFrame:
    """Rows inserted by commits later than a timestamp, up to a version: the source side of an append-only sync.

    The log must reach back to the timestamp: to version 0 or to a commit not
    later than it. Removed files are not read, so they may be gone.
    """
    path, _ = split_version(path)
    log = open_log(spark, path, until)
    times = _commit_times(spark, log.root).withColumn("later", F.col("committed_at") > F.lit(timestamp).cast("timestamp"))
    reach = times.agg(F.min("version").alias("oldest"), F.count_if(~F.col("later")).alias("earlier"), F.min(F.when(F.col("later"), F.col("version"))).alias("first")).first()
    if reach.oldest != 0 and not reach.earlier:
        raise ValueError(f"the log of {path} reaches back to version {reach.oldest} only, which is later than {timestamp}")
    if reach.first is None or reach.first > log.version:
        return empty_frame(spark, log.schema)
    if has_source(spark, "delta"):
        changes = read_changes(spark, path, reach.first - 1, until)
    else:
        changes = _changed(spark, log, reach.first - 1, ("cdc", "add"))
    return changes.filter(F.col("_change_type").isin("insert", "update_postimage")).drop(
        "_change_type", "_commit_version", "_commit_timestamp"
    )


def read_after(spark: SparkSession, path: str, version: int, until: int | None = None) -> DataFrame:
    """Rows that the commits ``version+1..until`` inserted: what an append still lacks that holds ``version``.

    Only a source that grew can be followed so. Commits that removed or changed
    rows are refused, as are commits that the log no longer has.
    """
    path, _ = split_version(path)
    log = open_log(spark, path, until)
    if log.version <= version:
        return empty_frame(spark, log.schema)
    told = ("_change_type", "_commit_version", "_commit_timestamp")
    if has_source(spark, "delta"):
        changes = read_changes(spark, path, version, until)
        other = changes.filter(F.col("_change_type") != "insert").select("_commit_version").first()
        shrunk = None if other is None else other[0]
    else:
        lost = (F.col("remove").isNotNull() & F.col("remove.dataChange")) | F.col("cdc").isNotNull()
        shrunk = _commits(spark, log.root, version + 1, log.version).filter(lost).agg(F.min("version")).first()[0]
        changes = _changed(spark, log, version, ("add",)) if shrunk is None else None
    if shrunk is not None:
        raise ValueError(f"commit {shrunk} of {path} removed or changed rows; overwrite the target or name a key")
    return changes.drop(*told)


def write_log_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> int:
    """Write a log table and return its version.

    Without the delta source this supports a single writer: data files first,
    then one commit that names them, so a failed write leaves the table as it was.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    path, _ = split_version(path)
    if has_source(spark, "delta"):
        df.write.format("delta").mode(mode).partitionBy(*partition_by).save(path)
        return spark.sql(f"DESCRIBE HISTORY delta.`{path}` LIMIT 1").first().version
    try:
        previous = open_log(spark, path)
    except FileNotFoundError:
        previous = None
    if previous is not None and mode == "append":
        if previous.schema.simpleString() != df.schema.simpleString():
            raise ValueError("an appended frame must have the table's schema")
        partition_by = tuple(previous.partition_columns)
    # A name of their own tells the files of this write from all others, whatever clocks say.
    name = f"part-{uuid.uuid4().hex}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").option("mapreduce.output.basename", name).partitionBy(*partition_by).parquet(path)
    return _commit_files(df, path, mode, partition_by, previous, _written_files(df, path, name), seen.get["rows"])


def rebuild_log(spark: SparkSession, files_path: str, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """A new table from bare Parquet files, for a table whose log is broken."""
    return write_log_table(read_plain(spark, files_path), path, "overwrite", partition_by)


def write_manifest(spark: SparkSession, path: str) -> str:
    """List the live files as text below the table, one folder per partition, for engines that read manifests."""
    log = open_log(spark, path)
    target = f"{log.root}/_symlink_format_manifest"
    listed = live_files(log).select("path", *[quoted(name) for name in log.partition_columns])
    listed.write.mode("overwrite").partitionBy(*log.partition_columns).text(target)
    return target


def _commit_files(df, path, mode, partition_by, previous, written, rows: int) -> int:
    spark = df.sparkSession
    listed = written.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first().rows
    if listed != rows:
        raise RuntimeError(f"{rows} rows were written to {path}, but its new files hold {listed}; nothing is committed")
    version = 0 if previous is None else previous.version + 1
    now = int(time.time() * 1000)
    root = qualified(spark, path)
    in_table = F.regexp_replace("path", "^" + re.escape(root) + "/", "")
    adds = written.select(
        _action(
            "add",
            encode_uri(in_table).alias("path"),
            _values_from_folders(in_table, partition_by).alias("partitionValues"),
            "size",
            F.unix_millis("modified").alias("modificationTime"),
            F.lit(True).alias("dataChange"),
            F.to_json(F.struct(F.col("rows").alias("numRecords"))).alias("stats"),
        )
    )
    lines = [{"commitInfo": {"timestamp": now, "operation": "WRITE", "operationParameters": {"mode": mode}}}]
    if previous is None:
        lines.append({"protocol": {"minReaderVersion": 1, "minWriterVersion": 2}})
    if previous is None or mode == "overwrite":
        metadata = {
            "id": str(uuid.uuid4()),
            "format": {"provider": "parquet", "options": {}},
            "schemaString": df.schema.json(),
            "partitionColumns": list(partition_by),
            "configuration": {},
            "createdTime": now,
        }
        lines.append({"metaData": metadata})
    commit = text_frame(spark, [json.dumps(line) for line in lines]).unionByName(adds)
    if previous is not None and mode == "overwrite":
        removes = live_files(previous).select(
            _action(
                "remove",
                encode_uri(in_table).alias("path"),
                F.lit(now).alias("deletionTimestamp"),
                F.lit(True).alias("dataChange"),
                F.col("partition_values").alias("partitionValues"),
                "size",
            )
        )
        commit = commit.unionByName(removes)
    folder = f"{path}/{LOG_FOLDER}"
    draft = f"{folder}/_draft-{uuid.uuid4().hex}"
    # A commit is one file by format; it holds one line per data file, never rows.
    commit.repartition(1).write.text(draft)
    publish_single_file(spark, draft, f"{folder}/{version:020d}.json")
    return version


def _action(kind: str, *fields: Column | str) -> Column:
    return F.to_json(F.struct(F.struct(*fields).alias(kind))).alias("value")


def _written_files(df: DataFrame, path: str, name: str) -> DataFrame:
    """The files of a write, which begin with ``name``, with their row counts."""
    return (
        df.sparkSession.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"{name}*.parquet")
        .schema(df.schema)
        .parquet(path)
        .groupBy(
            F.col("_metadata.file_path").alias("uri"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        .agg(F.count("*").alias("rows"))
        .select(plain_location(decode_uri(F.col("uri"))).alias("path"), "size", "modified", "rows")
    )


def _values_from_folders(relative: Column, partition_by: tuple[str, ...]) -> Column:
    """Map of partition values as the folders of a just-written file spell them."""
    if not partition_by:
        return F.create_map().cast("map<string,string>")
    entries = []
    for name in partition_by:
        spelled = F.regexp_extract(relative, f"(?:^|/){re.escape(name)}=([^/]*)/", 1)
        entries += [F.lit(name), F.nullif(decode_uri(spelled), F.lit(NULL_PARTITION))]
    return F.create_map(*entries)
