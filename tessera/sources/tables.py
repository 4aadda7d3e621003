"""Typed file scans, landing writes and table materialisations."""

from __future__ import annotations

import datetime as _dt
import json as _json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path
from tessera.sources import fs

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
LANDING_ROWS_PER_FILE = 50_000  # fixed value: rows per landed file


# ------------------------------------------------------------------ scans (A1, A2)
def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A1: header row, quoted values, declared types; malformed input fails the job."""
    return (spark.read.schema(schema)
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("timestampFormat", TS_FORMAT)
            .option("timestampNTZFormat", TS_FORMAT)
            .csv(path))


def load_seeds(spark: SparkSession, folder: str,
               schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    """Every declared seed ``<folder>/<name>.csv`` loaded with its schema."""
    return {name: read_csv_typed(spark, f"{folder.rstrip('/')}/{name}.csv", schema)
            for name, schema in schemas.items()}


def write_csv_seed(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("timestampFormat", TS_FORMAT).option("timestampNTZFormat", TS_FORMAT)
     .csv(path))


BROKEN_COL, FILE_COL = "_broken", "_file"


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType, payload: str = "data",
                with_broken: bool = False) -> DataFrame:
    """A2: newline-delimited JSON with an explicit schema.  A STRING field keeps a
    nested object's JSON text as it stands in the file; a payload that was landed
    as text (see :func:`landing_lines`) comes back in the same column.

    ``with_broken`` adds the line itself in ``_broken`` where it is no JSON object, does
    not fit the schema or holds none of its fields, and the file it is in as ``_file``.
    """
    kept_as_text = payload + TEXT_SUFFIX
    read = T.StructType([*schema.fields, *([T.StructField(kept_as_text, T.StringType())] if payload in schema.names else []),
                         *([T.StructField(BROKEN_COL, T.StringType())] if with_broken else [])])
    df = (spark.read.schema(read)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", BROKEN_COL)
          .option("timestampNTZFormat", ISO_FORMAT)
          .option("timestampFormat", ISO_FORMAT)
          .json(path))
    if with_broken:
        empty = F.coalesce(*[F.col(c).cast("string") for c in read.names if c != BROKEN_COL]).isNull()
        df = (df.withColumn(FILE_COL, F.col("_metadata.file_path"))
              .withColumn(BROKEN_COL, F.coalesce(BROKEN_COL, F.when(empty, F.lit("{}")))))
    if payload in schema.names:
        df = df.withColumn(payload, F.coalesce(payload, kept_as_text)).drop(kept_as_text)
    return df


class TooManyRejected(RuntimeError):
    """A load set aside more lines than it was allowed to."""


def load_landed(spark: SparkSession, landing: str, schema: T.StructType, columns: list[str], raw: str, rejects: str,
                run_id: str, max_rejected: int = 0) -> dict[str, int]:
    """A2 / A4: load a run's landed files into its folder of the raw table.

    Broken lines do not become rows of nulls: they go, with their file, to the run's folder
    below ``rejects``.  One pass loads and counts; a second one is made only if there are
    broken lines.  Returns ``lines``, ``loaded`` and ``rejected`` (the sum of the two is the
    first); more than ``max_rejected`` raise :class:`TooManyRejected`, after they were set aside.
    """
    lines = read_ndjson(spark, landing, schema, with_broken=True)
    seen = Observation(f"load_{uuid.uuid4().hex[:8]}")
    broken = F.col(BROKEN_COL).isNotNull()
    counted = lines.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(broken).alias("rejected"))
    append_raw(counted.where(~broken).select(*columns), raw, run_id=run_id)
    found = {k: int(v or 0) for k, v in seen.get.items()}
    found["loaded"] = found["lines"] - found["rejected"]
    aside = run_folder(rejects, run_id)
    if found["rejected"]:
        lines.where(broken).select(F.col(BROKEN_COL).alias("line"), F.col(FILE_COL).alias("file")) \
            .write.mode("overwrite").parquet(aside)
    else:
        fs.delete(spark, aside)  # of an earlier try of this run
    if found["rejected"] > max_rejected:
        raise TooManyRejected(f"{found['rejected']} of {found['lines']} landed lines are broken ({max_rejected} allowed): see {aside}")
    return found


# --------------------------------------------------------------- landing (A3, A4)
#: Suffix of the field that holds a payload which is no JSON object or array.
TEXT_SUFFIX = "_text"


def landing_lines(df: DataFrame, partition_cols=(), payload: str = "data") -> DataFrame:
    """One JSON line per row in ``value``, beside the partition columns.

    A payload that is a JSON object or array on one line stands in the line as
    it is, byte for byte.  Any other payload (malformed text, repeated keys,
    scalars, line breaks) is kept as an escaped string in ``<payload>_text``.
    """
    options = {"timestampNTZFormat": ISO_FORMAT, "timestampFormat": ISO_FORMAT}
    rest = [c for c in df.columns if c not in partition_cols and c != payload]
    plain = F.to_json(F.struct(*rest), options)
    whole = (F.try_parse_json(payload).isNotNull() & F.col(payload).rlike(r"^[\{\[]")
             & ~F.col(payload).rlike(r"[\r\n]"))
    spliced = F.concat(F.expr("left(_plain, length(_plain) - 1)"),
                       F.when(F.col("_plain") == "{}", F.lit("")).otherwise(F.lit(",")),
                       F.lit(f'"{payload}":'), F.col(payload), F.lit("}"))
    as_text = F.to_json(F.struct(*rest, F.col(payload).alias(payload + TEXT_SUFFIX)), options)
    return df.withColumn("_plain", plain).select(
        F.when(F.coalesce(whole, F.lit(False)), spliced).otherwise(as_text).alias("value"), *partition_cols)


def write_landing(df: DataFrame, path: str, partition_cols=("source_stream", "dt"),
                  rows_per_file: int = LANDING_ROWS_PER_FILE, mode: str = "overwrite") -> None:
    """A3: NDJSON under ``<stream>/<day>`` folders, at most ``rows_per_file`` per file."""
    (landing_lines(df, partition_cols).write.mode(mode)
     .partitionBy(*partition_cols)
     .option("maxRecordsPerFile", rows_per_file)
     .text(path))


RUN_COL = "_run_id"


def append_raw(df: DataFrame, path: str, ingest_col: str = "ingested_at",
               run_id: str | None = None) -> None:
    """A4: append landed rows to the raw table, partitioned by ingestion day.

    With a ``run_id`` the rows go to the run's own folder ``_run_id=`` (day
    folders inside), which a retry replaces as a whole: whatever day or stamp
    the retry runs with, the run's rows are there once.
    """
    out = df.withColumn("_ingest_date", F.to_date(ingest_col))
    if run_id is None:
        out.write.mode("append").partitionBy("_ingest_date").parquet(path)
        return
    out.write.mode("overwrite").partitionBy("_ingest_date").parquet(run_folder(path, run_id))


def run_folder(path: str, run_id: str) -> str:
    """Folder of a run's rows in a raw table."""
    return f"{path.rstrip('/')}/{RUN_COL}={run_id}"


# ------------------------------------------------------- full-refresh table (A5)
def write_partitioned_table(df: DataFrame, path: str, day_source: str, day_col: str,
                            cluster_by=(), tiebreak=(), num_partitions: int | None = None) -> None:
    """A5: rebuild a table partitioned by the day of ``day_source`` and clustered.

    Range-partitioning on (day, *cluster) gives each task a contiguous key
    range, so every day folder gets few files whose row groups carry tight
    min/max statistics on the cluster keys (parquet row-group pruning).  The day
    leads the in-partition sort, as the partitioned writer requires; otherwise
    it would sort again.  ``tiebreak`` columns (high cardinality, e.g. the
    event id) end the range key so that one hot (day, cluster) combination is
    still cut into several ranges instead of landing in a single task.
    By default the session's shuffle partition count is used and AQE coalesces small
    ranges; :func:`tessera.sources.layout.write_clustered_table` sizes them by the data
    and clusters on all columns alike.
    """
    keys = [day_col, *cluster_by, *tiebreak]
    out = df.withColumn(day_col, F.to_date(day_source))
    out = (out.repartitionByRange(num_partitions, *keys) if num_partitions
           else out.repartitionByRange(*keys))
    (out
     .sortWithinPartitions(*keys)
     .write.mode("overwrite").partitionBy(day_col).parquet(path))


def read_day_range(spark: SparkSession, path: str, ts_col: str, day_col: str,
                   start: str | None = None, end: str | None = None) -> DataFrame:
    """Read a day-partitioned table for ``start <= ts < end``; the predicate is
    stated on the partition column too, so whole folders are pruned."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where((F.col(day_col) >= F.to_date(F.lit(start))) & (F.col(ts_col) >= F.lit(start).cast("timestamp_ntz")))
    if end is not None:
        df = df.where((F.col(day_col) <= F.to_date(F.lit(end))) & (F.col(ts_col) < F.lit(end).cast("timestamp_ntz")))
    return df


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet below ``spark.checkpoint.dir`` and read it back:
    cuts the lineage (a lost executor re-reads files instead of recomputing) and
    gives later size checks real file statistics."""
    return materialize_counted(df, label)[0]


def write_counted(df: DataFrame, path: str) -> int:
    """Write ``df`` as parquet at ``path`` (overwrite) and return the exact
    number of rows written, observed during the write itself (no second job)."""
    return int(write_observed(df, path)["rows"] or 0)


def write_observed(df: DataFrame, path: str, metrics: list | None = None, partition_by: list[str] | None = None) -> dict:
    """Write ``df`` as parquet at ``path`` (overwrite); return the row count
    (``rows``) and any extra aggregate ``metrics`` computed in the same pass."""
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows"), *(metrics or [])) \
        .write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return dict(obs.get)


def materialize_counted(df: DataFrame, label: str,
                        path: str | None = None) -> tuple[DataFrame, int]:
    """:func:`materialize` that also returns the row count it observed."""
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    rows = write_counted(df, path)
    return spark.read.schema(df.schema).parquet(path), rows


# ---------------------------------------------------------------- retention
def expire_partitions(spark: SparkSession, path: str, column: str, as_of: str | _dt.date,
                      keep_days: int = 7) -> list[str]:
    """Delete ``column=<day>`` folders older than ``keep_days`` before ``as_of``.

    Works from a directory listing only (no data scan); the day folders may sit
    below other partition folders (``source_stream=x/dt=...``) at any depth.  Returns the
    dropped folders.
    """
    day = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    cutoff = day - _dt.timedelta(days=keep_days)
    dropped: list[str] = []

    def walk(folder: str) -> None:
        for value in fs.list_partition_values(spark, folder, column):
            try:
                d = _dt.date.fromisoformat(value)
            except ValueError:
                continue
            if d <= cutoff:
                target = f"{folder}/{column}={value}"
                fs.delete(spark, target)
                dropped.append(target)
        for sub in fs.list_partition_dirs(spark, folder):
            if not sub.startswith(column + "="):
                walk(f"{folder}/{sub}")

    walk(path.rstrip("/"))
    return dropped


# ------------------------------------------------------ versioned table (for A8)
class StaleVersion(RuntimeError):
    """The table moved on since the version that a commit builds on."""


class Rewritten(RuntimeError):
    """Rows were replaced in a range of versions of which only the added rows were asked for."""


class LostPointer(RuntimeError):
    """A committed table without any pointer file."""


class VersionedTable:
    """A parquet table published through small numbered pointer files.

    ``_pointer/v<N>.json`` names the segment folders of version N, its schema, the time
    of its commit and optional high-water marks; the highest number is the live version.
    Writers first *stage* a segment (written, not yet visible), then commit it
    as an extra segment (append) or as a whole new version (rewrite).  A commit
    creates the next pointer file, which fails if that file exists: of two
    writers that start from one version, one gets :class:`StaleVersion`.  No
    pointer is ever replaced, so there is no moment without one; a table that
    was committed once and has none left is an error, not an empty table.
    Older versions can be read until ``vacuum`` takes them.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.pointers = f"{self.path}/_pointer"

    def _versions(self) -> list[str]:
        return [n for n in fs.list_files(self.spark, self.pointers) if n.startswith("v")]

    def _pointer(self, version: int) -> str:
        return f"{self.pointers}/v{version:012d}.json"

    def _state(self, version: int | None = None) -> dict:
        """The pointer of a version, by default of the live one."""
        if version is not None:
            text = fs.read_text(self.spark, self._pointer(version))
            if text is None:
                raise KeyError(f"{self.path} has no version {version} (any more)")
            return _json.loads(text)
        found = self._versions()
        if found:
            return _json.loads(fs.read_text(self.spark, f"{self.pointers}/{found[-1]}"))
        if fs.exists(self.spark, f"{self.path}/_created"):
            raise LostPointer(f"{self.path} was committed before, but has no pointer file")
        return {"version": 0, "segments": []}

    def _dirs(self, state: dict) -> list[str]:
        """Folders of a version's rows, below the table's."""
        return state["segments"]

    def exists(self) -> bool:
        return bool(self._dirs(self._state()))

    @property
    def version(self) -> int:
        return int(self._state()["version"])

    def history(self) -> list[dict]:
        """Version, commit time (UTC), run and kind of each version that can still be read."""
        states = [self._state(int(n[1:-5])) for n in self._versions()]
        return [{"version": s["version"], "committed_at": s.get("committed_at"), "run": s.get("run"),
                 "appends": s.get("appends")} for s in states]

    def version_at(self, moment: str | _dt.datetime) -> int:
        """The version that was live at ``moment`` (UTC)."""
        at = str(moment if isinstance(moment, _dt.datetime) else _dt.datetime.fromisoformat(moment))
        found = [h["version"] for h in self.history() if h["committed_at"] is not None and h["committed_at"] <= at]
        if not found:
            raise KeyError(f"{self.path} has no version as old as {at}")
        return found[-1]

    def schema(self) -> T.StructType | None:
        st = self._state()
        return T.StructType.fromJson(_json.loads(st["schema"])) if st.get("schema") else None

    def marks(self) -> dict | None:
        """High-water marks recorded at commit time (``None`` if never recorded)."""
        return self._state().get("marks")

    def read(self, schema: T.StructType | None = None, version: int | None = None) -> DataFrame | None:
        """Rows of the live version, or of an older one."""
        state = self._state(version)
        if schema is None and state.get("schema"):
            schema = T.StructType.fromJson(_json.loads(state["schema"]))
        return self._frame(self._dirs(state), schema)

    def _frame(self, dirs: list[str], schema: T.StructType | None) -> DataFrame | None:
        if not dirs:
            return None if schema is None else self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*[f"{self.path}/{d}" for d in dirs])

    def added(self, since: int, upto: int | None = None) -> DataFrame | None:
        """Rows appended after version ``since``; :class:`Rewritten` if a version between
        replaced rows, as its new folders hold old rows too."""
        upto = self.version if upto is None else upto
        for v in range(since + 1, upto + 1):
            if not self._state(v).get("appends"):
                raise Rewritten(f"{self.path}: version {v} replaced rows")
        before = set(self._dirs(self._state(since))) if since else set()
        state = self._state(upto) if upto else self._state()
        schema = T.StructType.fromJson(_json.loads(state["schema"])) if state.get("schema") else None
        return self._frame([d for d in self._dirs(state) if d not in before], schema)

    # -- staging and commits
    def stage(self, df: DataFrame) -> str:
        return self.stage_counted(df)[0]

    def stage_counted(self, df: DataFrame) -> tuple[str, int]:
        """Stage ``df`` as an unpublished segment; also return its row count."""
        seg, observed = self.stage_observed(df)
        return seg, int(observed["rows"] or 0)

    def stage_observed(self, df: DataFrame, metrics: list | None = None,
                       partition_by: list[str] | None = None) -> tuple[str, dict]:
        """Stage ``df``; return the segment and the metrics observed while writing."""
        seg = f"seg-{uuid.uuid4().hex[:16]}"
        return seg, write_observed(df, f"{self.path}/{seg}", metrics, partition_by)

    def read_segment(self, seg: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{seg}")

    def _publish(self, segments: list[str], schema: T.StructType, marks: dict | None,
                 base: int | None = None, run: str | None = None, extra: dict | None = None,
                 appends: bool = False) -> None:
        st = self._state()
        if base is not None and st["version"] != base:
            raise StaleVersion(f"{self.path}: built on version {base}, live is {st['version']}")
        if appends and st.get("schema"):
            old = T.StructType.fromJson(_json.loads(st["schema"]))
            if [(f.name, f.dataType) for f in old] != [(f.name, f.dataType) for f in schema]:
                raise ValueError(f"appended schema {schema.simpleString()} differs from "
                                 f"table schema {old.simpleString()}")
        body = {"version": st["version"] + 1, "segments": segments, "schema": schema.json(), "appends": appends,
                "committed_at": str(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)), **(extra or {})}
        if marks is not None:
            body["marks"] = marks
        if run is not None:
            body["run"] = run
        if not st["version"]:
            fs.publish_new(self.spark, f"{self.path}/_created", "")
        if not fs.publish_new(self.spark, self._pointer(body["version"]), _json.dumps(body)):
            raise StaleVersion(f"{self.path}: another writer committed version {body['version']}")

    def run_of(self, version: int) -> str | None:
        """Run id that committed a version (``None`` if none was given or it is gone)."""
        text = fs.read_text(self.spark, self._pointer(version))
        return _json.loads(text).get("run") if text else None

    def commit_append(self, seg: str, schema: T.StructType, marks: dict | None = None,
                      base: int | None = None) -> None:
        self._publish(self._state()["segments"] + [seg], schema, marks, base, appends=True)

    def commit_rewrite(self, df: DataFrame, marks: dict | None = None, base: int | None = None,
                       run: str | None = None) -> None:
        seg = self.stage(df)
        self._publish([seg], df.schema, marks, base, run)

    def append(self, df: DataFrame) -> None:
        self.commit_append(self.stage(df), df.schema, self.marks())

    def vacuum(self, older_than: str | _dt.datetime | None = None, keep: frozenset[int] = frozenset()) -> list[str]:
        """Forget versions and delete the segment folders that only they name.

        The live version stays, and so do versions in ``keep`` (the pointer alone: it tells
        which run committed them) and versions that were live after ``older_than`` (UTC).
        Without ``older_than`` all but the live version go, staged segments that were never
        committed too; with it, staged segments are left to their writers.
        """
        names = self._versions()
        at = None if older_than is None else str(older_than if isinstance(older_than, _dt.datetime)
                                                 else _dt.datetime.fromisoformat(older_than))
        states = [self._state(int(n[1:-5])) for n in names]
        gone = []
        for state, following in zip(states, states[1:]):
            # a version was live until the next one was committed
            if at is None or (following.get("committed_at") or "") <= at:
                gone.append(state)
        stay = [s for s in states if s not in gone]
        live = {d.split("/")[0] for s in stay for d in self._dirs(s)}
        named = {d.split("/")[0] for s in gone for d in self._dirs(s)}
        dropped = []
        for name in fs.list_dirs(self.spark, self.path):
            if name.startswith("seg-") and name not in live and (at is None or name in named):
                fs.delete(self.spark, f"{self.path}/{name}")
                dropped.append(name)
        for state in gone:
            if state["version"] not in keep:
                fs.delete(self.spark, self._pointer(state["version"]))
        return dropped

    def rewrite(self, df: DataFrame) -> None:
        self.commit_rewrite(df, self.marks())


class Releases:
    """Sets of tables that become visible together.

    A build writes its tables to a folder of its own and publishes their paths
    under the next number; readers take the highest.  Until then, and if a check
    fails, they keep reading the release before.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.pointers = f"{self.root}/_releases"

    def _numbers(self) -> list[str]:
        return [n for n in fs.list_files(self.spark, self.pointers) if n.startswith("r")]

    @property
    def version(self) -> int:
        found = self._numbers()
        return int(found[-1][1:-5]) if found else 0

    def paths(self) -> dict[str, str]:
        """Table name to path of the live release; empty before the first."""
        found = self._numbers()
        return _json.loads(fs.read_text(self.spark, f"{self.pointers}/{found[-1]}")) if found else {}

    def new_folder(self) -> str:
        return f"{self.root}/build-{uuid.uuid4().hex[:12]}"

    def publish(self, paths: dict[str, str], base: int) -> int:
        """Make ``paths`` the release after ``base``; :class:`StaleVersion` if there is one already."""
        if not fs.publish_new(self.spark, f"{self.pointers}/r{base + 1:012d}.json", _json.dumps(paths)):
            raise StaleVersion(f"{self.root}: release {base + 1} exists already")
        return base + 1
