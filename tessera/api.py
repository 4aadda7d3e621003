"""The user-facing surface: one import for the models, the incremental
machinery, the stream and the checks.

    from tessera import api
    fact = api.fact(telemetry, vessels, locations, researchers)
"""

from __future__ import annotations

from tessera.functions import (cursor_position, days_between, format_cursor, full_name,
                               json_scalar, parse_iso_timestamp, seconds_to_timestamp, title_case)
from tessera.operators.gold import (dim_locations, dim_researchers, dim_vessels, enrich,
                                    lead_researchers, low_g_flag, top1, unified_telemetry)
from tessera.operators.gold import fact_events as fact
from tessera.operators.incremental import (advance_cursors, extract_new, high_water_mark,
                                           incremental_filter, lookup_rows,
                                           merge_into_catalog_table, sanitize, upsert,
                                           watermark_lookup)
from tessera.operators.quality import Check, ModelChecks, audit, duplicate_keys, gate, null_counts
from tessera.operators.quality import run_checks as run_quality
from tessera.operators.silver import (api_silver_projection, stg_locations, stg_researchers,
                                      stg_telemetry, stg_telemetry_stream, stg_vessels,
                                      union_tagged)
from tessera.plans.api_ingest import ApiTables, merge_into, run_cycle
from tessera.plans.medallion import build_gold
from tessera.session import build_session, scratch_path
from tessera.sources.tables import (VersionedTable, append_raw, expire_partitions,
                                    read_csv_typed, read_day_range, read_ndjson,
                                    write_landing, write_partitioned_table)
from tessera.streaming.bronze import parse_contract, topic_source
from tessera.streaming.silver import StreamPaths, run_available, start_silver


def read_fact(spark, path: str, start: str | None = None, end: str | None = None,
              day_col: str = "observed_date"):
    """The gold fact for ``start <= observed_at < end`` with day-folder pruning."""
    return read_day_range(spark, path, "observed_at", day_col, start, end)


__all__ = [n for n in dir() if not n.startswith("_")]
