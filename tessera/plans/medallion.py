"""Batch medallion build: raw -> silver -> gold."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tessera.operators import gold, silver
from tessera.operators.sizing import DEFAULT_BROADCAST_MAX_ROWS, broadcast_if_bounded
from tessera.schemas import RAW_LOCATIONS, RAW_RESEARCHERS, RAW_TELEMETRY, RAW_VESSELS
from tessera.sources import bindings
from tessera.sources.layout import write_clustered_table
from tessera.sources.tables import Releases, load_seeds, materialize_counted


@dataclass
class Dims:
    vessels: DataFrame
    locations: DataFrame
    researchers: DataFrame


@dataclass
class Gold:
    """Materialised dimensions, the researcher leads and the (lazy) fact."""
    dims: Dims
    leads: DataFrame
    fact: DataFrame


@dataclass
class Sources:
    """The declared raw tables of the build; ``stream_silver`` is optional."""
    telemetry: DataFrame
    vessels: DataFrame
    locations: DataFrame
    researchers: DataFrame
    stream_silver: DataFrame | None = None

    @classmethod
    def of_tables(cls, spark: SparkSession, sf_dir: str) -> Sources:
        """The domain tables bound to the driver's parquet."""
        return cls(bindings.raw_telemetry(spark, sf_dir), bindings.raw_vessels(spark, sf_dir),
                   bindings.raw_locations(spark, sf_dir), bindings.raw_researchers(spark, sf_dir),
                   bindings.stream_silver_table(spark, sf_dir))

    @classmethod
    def of_seeds(cls, spark: SparkSession, folder: str, stream_silver: DataFrame | None = None) -> Sources:
        """A folder of declared CSV seeds, ``raw_<table>.csv``."""
        seeds = load_seeds(spark, folder, {
            "raw_telemetry": RAW_TELEMETRY, "raw_vessels": RAW_VESSELS,
            "raw_locations": RAW_LOCATIONS, "raw_researchers": RAW_RESEARCHERS})
        return cls(*seeds.values(), stream_silver)

    def silver(self) -> dict[str, DataFrame]:
        """The silver models."""
        return {"stg_telemetry": silver.stg_telemetry(self.telemetry),
                "stg_vessels": silver.stg_vessels(self.vessels),
                "stg_locations": silver.stg_locations(self.locations),
                "stg_researchers": silver.stg_researchers(self.researchers)}

    def dims(self, as_of: str) -> Dims:
        s = self.silver()
        return Dims(gold.dim_vessels(s["stg_vessels"], as_of), gold.dim_locations(s["stg_locations"]),
                    gold.dim_researchers(s["stg_researchers"], as_of))


def stg_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.stg_telemetry(bindings.raw_telemetry(spark, sf_dir))


def stg_telemetry_stream(spark: SparkSession, sf_dir: str, processed_at=None) -> DataFrame:
    """Stream silver computed from the topic's records with the streaming
    transform (the function the continuous query applies), run as a batch plan."""
    return silver.stg_telemetry_stream(bindings.stream_records(spark, sf_dir), processed_at)


def dims(spark: SparkSession, sf_dir: str, as_of: str = bindings.AS_OF) -> Dims:
    return Sources.of_tables(spark, sf_dir).dims(as_of)


def _materialize_counted(df: DataFrame, label: str, root: str | None) -> tuple[DataFrame, int]:
    """Write once and read back; the exact row count is observed during the
    write.  With ``root`` the dimension is (re)written as the gold table
    ``<root>/<label>``; otherwise it goes to a fresh folder below
    ``spark.checkpoint.dir``."""
    path = None if root is None else f"{root.rstrip('/')}/{label}"
    return materialize_counted(df, label, path)


def _join_side(stored: DataFrame, rows: int, max_rows: int | None) -> DataFrame:
    """Broadcast a stored dimension only when its observed row count proves it
    small; the hint is attached where the frame is joined, nowhere else."""
    proven = max_rows is not None and rows <= max_rows
    return broadcast_if_bounded(stored, max_rows, checked=True) if proven else stored


def build_gold(spark: SparkSession, sf_dir: str, include_stream: bool = True,
               as_of: str = bindings.AS_OF, lead_first: bool = True,
               broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
               stream_silver: DataFrame | None = None, dims_root: str | None = None,
               sources: Sources | None = None) -> Gold:
    """Dimensions are full-refresh gold tables: they are written first (the
    three independent jobs run concurrently), which keeps the fact's lineage
    short; each broadcast size proof is the row count observed while writing.
    The
    researcher leads (one per vessel) are then taken from the stored
    researcher dimension, so its sources are read once."""
    sources = sources or Sources.of_tables(spark, sf_dir)
    d = sources.dims(as_of)
    todo = {"dim_vessels": d.vessels, "dim_locations": d.locations,
            "dim_researchers": d.researchers}
    job = inheritable_thread_target(spark)(_materialize_counted)  # keep job group, tags
    with ThreadPoolExecutor(max_workers=len(todo)) as pool:
        futs = {k: pool.submit(job, v, k, dims_root) for k, v in todo.items()}
        done = {k: f.result() for k, f in futs.items()}
    if lead_first:
        # from the *stored* dimension: the orders aggregate is not computed twice
        done["lead_researchers"] = _materialize_counted(
            gold.lead_researchers(done["dim_researchers"][0]), "lead_researchers", dims_root)
    mdims = Dims(done["dim_vessels"][0], done["dim_locations"][0], done["dim_researchers"][0])
    batch = silver.stg_telemetry(sources.telemetry)
    stream = None
    if include_stream:
        stream = stream_silver if stream_silver is not None else sources.stream_silver
    telemetry = gold.unified_telemetry(batch, stream)
    # each joined side carries its own proven broadcast decision
    side = {k: _join_side(df, rows, broadcast_max_rows) for k, (df, rows) in done.items()}
    researchers = side["lead_researchers"] if lead_first else side["dim_researchers"]
    fact = gold.fact_events(telemetry, side["dim_vessels"], side["dim_locations"], researchers,
                            lead_first=False, dedupe=True, broadcast_max_rows=None)
    leads = (done["lead_researchers"] if lead_first else done["dim_researchers"])[0]
    return Gold(mdims, leads, fact)


def fact(spark: SparkSession, sf_dir: str, include_stream: bool, **kw) -> DataFrame:
    return build_gold(spark, sf_dir, include_stream=include_stream, **kw).fact


def fact_batch_only(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return fact(spark, sf_dir, include_stream=False, **kw)


def fact_unified(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return fact(spark, sf_dir, include_stream=True, **kw)


def daily_build(spark: SparkSession, sf_dir: str | None, gold_root: str, suite=None,
                include_stream: bool = True, as_of: str = bindings.AS_OF,
                sources: Sources | None = None, api_silver: DataFrame | None = None) -> dict:
    """The daily medallion build: write, check, then publish.

    Silver models are gated first; the gold tables (dimensions, then the
    day-partitioned, clustered fact) are written to a folder of the build, gated
    as stored, and only then published as the next release.  A failing
    error-severity check or a lost driver leaves the release before untouched.
    ``sources`` are the raw tables; by default those bound to ``sf_dir``.  ``api_silver`` is
    the stored API model (see ``api_ingest``), which is gated with the other silver models.
    """
    from tessera.operators.quality import audit, gate
    from tessera.plans.audit import SUITE

    suite = SUITE if suite is None else suite
    sources = sources or Sources.of_tables(spark, sf_dir)
    releases = Releases(spark, gold_root)
    base, folder = releases.version, releases.new_folder()
    checks = []

    def gated(models: dict[str, DataFrame]) -> None:
        specs = [s for s in suite if s.model in models]
        if not specs:
            return
        results = audit(models, specs)
        gate(results, specs)
        checks.extend(r.asDict() for r in results.collect())

    gated(sources.silver() | ({} if api_silver is None else {"stg_api_telemetry": api_silver}))
    g = build_gold(spark, sf_dir, include_stream=include_stream, as_of=as_of, dims_root=folder,
                   sources=sources)
    dims_models = {"dim_vessels": g.dims.vessels, "dim_locations": g.dims.locations,
                   "dim_researchers": g.dims.researchers}
    gated(dims_models)
    fact_path = f"{folder}/fct_events"
    write_clustered_table(g.fact, fact_path, "observed_at", "observed_date",
                          ["location_id", "vessel_id", "vessel_type"], tiebreak=["event_id"])
    gated({"fct_events": spark.read.parquet(fact_path)})
    paths = {k: f"{folder}/{k}" for k in dims_models} | {"fct_events": fact_path}
    return {"release": releases.publish(paths, base), "fact": fact_path,
            "dims": {k: paths[k] for k in dims_models}, "checks": checks}
