"""DuckDB SQL that states, independently of the Spark plans, what each
registered query must return on the driver's parquet views.

The fact oracle uses the literal form (fan-out join + row_number top-1), not
the lead-first rewrite the Spark plan uses, so the two check each other.
"""

from __future__ import annotations

from tessera.functions.text import INITCAP_DELIMITERS
from tessera.sources.bindings import AS_OF

_CLS = r"\s" + "".join("\\" + c for c in INITCAP_DELIMITERS)


def _titlecase(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '[{_CLS}]+|[^{_CLS}]+'), "
            f"lambda t: upper(left(t, 1)) || lower(substr(t, 2))), '')")


def _days(x: str) -> str:
    return f"CAST(date_diff('day', CAST({x} AS DATE), DATE '{AS_OF}') AS INTEGER)"


CTES: dict[str, str] = {
    "raw_telemetry": """
        SELECT event_id AS id, user_id AS vessel_id, value % CAST(19 AS DOUBLE) AS raw_force_reading,
               event_id % 30 AS location_id, ts AS event_time
        FROM events""",
    "stg_telemetry": """
        SELECT id AS event_id, vessel_id, location_id,
               raw_force_reading / CAST(9.80665 AS DOUBLE) AS gravity_g,
               event_time AS observed_at
        FROM raw_telemetry""",
    "stream_records": """
        SELECT event_id AS id, user_id AS vessel_id, value % CAST(19 AS DOUBLE) AS raw_force_reading,
               event_id % 30 AS location_id,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time
        FROM events""",
    "stg_telemetry_stream": """
        SELECT id AS event_id, vessel_id, location_id,
               raw_force_reading / CAST(9.80665 AS DOUBLE) AS gravity_g,
               CAST(strptime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS TIMESTAMP) AS observed_at
        FROM stream_records""",
    "raw_vessels": """
        SELECT s.s_suppkey AS vessel_id, s.s_name AS vessel_name,
               'T' || CAST(s.s_nationkey % 5 AS VARCHAR) AS vessel_type,
               f.commissioned_at
        FROM supplier s
        LEFT JOIN (SELECT l_suppkey, min(l_shipdate) AS commissioned_at
                   FROM lineitem GROUP BY l_suppkey) f ON s.s_suppkey = f.l_suppkey""",
    "stg_vessels": """
        SELECT vessel_id, vessel_name, vessel_type, commissioned_at FROM raw_vessels""",
    "dim_vessels": f"""
        SELECT vessel_id, vessel_name, vessel_type, commissioned_at,
               {_days('commissioned_at')} AS age_days
        FROM stg_vessels""",
    "raw_locations": """
        SELECT n.n_nationkey AS location_id, n.n_name AS location_name, r.r_name AS region,
               'F' || CAST(n.n_nationkey % 4 AS VARCHAR) AS facility_type
        FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "dim_locations": """
        SELECT location_id, location_name, region, facility_type FROM raw_locations""",
    "raw_researchers": """
        SELECT c.c_custkey AS researcher_id,
               split_part(c.c_name, '#', 1) AS first_name,
               split_part(c.c_name, '#', 2) AS last_name,
               upper(c.c_name) || '@X.ORG' AS email,
               c.c_mktsegment AS specialization,
               4 * c.c_custkey // 50 AS assigned_vessel_id,
               o.joined_at
        FROM customer c
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS joined_at
                   FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey""",
    "stg_researchers": f"""
        SELECT researcher_id,
               {_titlecase('first_name')} AS first_name,
               {_titlecase('last_name')} AS last_name,
               lower(email) AS email, specialization, assigned_vessel_id, joined_at
        FROM raw_researchers""",
    "dim_researchers": f"""
        SELECT researcher_id, first_name, last_name, email, specialization,
               assigned_vessel_id, joined_at,
               first_name || ' ' || last_name AS full_name,
               {_days('joined_at')} AS tenure_days
        FROM stg_researchers""",
    "telemetry_batch": """
        SELECT event_id, vessel_id, location_id, gravity_g, observed_at,
               'batch' AS ingestion_mode
        FROM stg_telemetry""",
    "telemetry_unified": """
        SELECT * FROM telemetry_batch
        UNION ALL
        SELECT event_id, vessel_id, location_id, gravity_g, observed_at,
               'stream' AS ingestion_mode
        FROM stg_telemetry_stream""",
}


def _fact(telemetry: str) -> str:
    return f"""
        SELECT t.event_id, t.vessel_id, t.location_id, t.gravity_g, t.observed_at,
               t.ingestion_mode, v.vessel_name, v.vessel_type, v.age_days AS vessel_age_days,
               l.location_name, l.region, r.researcher_id, r.full_name AS lead_researcher,
               r.specialization, COALESCE(t.gravity_g <= 0.1, FALSE) AS is_low_g
        FROM {telemetry} t
        LEFT JOIN dim_vessels v ON t.vessel_id = v.vessel_id
        LEFT JOIN dim_locations l ON t.location_id = l.location_id
        LEFT JOIN dim_researchers r ON t.vessel_id = r.assigned_vessel_id
        QUALIFY row_number() OVER (
            PARTITION BY t.event_id, t.ingestion_mode
            ORDER BY r.tenure_days DESC NULLS LAST, r.researcher_id ASC NULLS LAST,
                     t.vessel_id, t.location_id, t.observed_at, t.gravity_g) = 1"""


CTES["fact_batch"] = _fact("telemetry_batch")
CTES["fact_unified"] = _fact("telemetry_unified")


def with_ctes(select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in CTES.items())
    return f"WITH {body}\n{select}"


def table(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}")


# ------------------------------------------------------------------ API path
CUT = "2024-01-16 00:00:00"
STAMP_1 = "2024-01-16 00:00:00"
STAMP_2 = "2024-01-31 00:00:00"


def _scalar(path: str) -> str:
    return (f"CASE WHEN json_type(data, '{path}') IN ('OBJECT', 'ARRAY') THEN NULL "
            f"ELSE json_extract_string(data, '{path}') END")


CTES["api_log"] = """
        SELECT CASE event_type WHEN 'error' THEN 'fraud' WHEN 'view' THEN 'audit'
                               WHEN 'click' THEN 'access' WHEN 'signup' THEN 'members'
                               WHEN 'purchase' THEN 'sales' END AS stream_name,
               event_id AS pos, CAST(event_id AS VARCHAR) AS event_id,
               event_type AS stream_type, props AS data,
               CAST(epoch_us(ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS timestamp,
               ts AS event_ts
        FROM events"""
CTES["api_raw"] = """
        SELECT CAST(date_trunc('day', event_ts) AS TIMESTAMP) AS ingested_at,
               stream_name AS source_stream, event_id, stream_type, data, timestamp
        FROM api_log"""
CTES["api_silver"] = f"""
        SELECT event_id, stream_type, source_stream,
               {_scalar('$.k')} AS measure_value,
               {_scalar('$.message')} AS event_message,
               make_timestamp(CAST(round(timestamp) AS BIGINT) * 1000000) AS observed_at,
               ingested_at
        FROM api_raw"""
CTES["run1_cursors"] = f"""
        SELECT stream_name, max(pos) AS last_pos FROM api_log
        WHERE event_ts < TIMESTAMP '{CUT}' GROUP BY stream_name"""


# ------------------------------------------------------------------ quality
AUDIT_PROCESSED_AT = "2024-02-01 00:00:00"
CTES["stg_locations"] = "SELECT location_id, location_name, region, facility_type FROM raw_locations"
CTES["stream_silver_stamped"] = (
    f"SELECT *, TIMESTAMP '{AUDIT_PROCESSED_AT}' AS processed_at FROM stg_telemetry_stream")
AUDIT_MODEL_CTE = {
    "stg_telemetry": "stg_telemetry", "stg_researchers": "stg_researchers",
    "stg_vessels": "stg_vessels", "stg_locations": "stg_locations",
    "stg_telemetry_stream": "stream_silver_stamped", "stg_api_telemetry": "api_silver",
    "dim_researchers": "dim_researchers", "fct_events": "fact_unified",
    "dim_vessels": "dim_vessels", "dim_locations": "dim_locations",
}


def check_sql(model: str, chk) -> str:
    """One result row ``(model, column_name, check_name, observed, passed)``."""
    src = AUDIT_MODEL_CTE[model]
    if chk.kind == "unique":
        keys = list(chk.column) if isinstance(chk.column, tuple) else [chk.column]
        nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        obs = (f"(SELECT count(*) FROM (SELECT {', '.join(keys)} FROM {src} WHERE {nn} "
               f"GROUP BY {', '.join(keys)} HAVING count(*) > 1))")
    elif chk.kind == "not_null":
        obs = f"(SELECT count(*) FILTER (WHERE {chk.column} IS NULL) FROM {src})"
    elif chk.kind == "between":
        obs = (f"(SELECT count(*) FILTER (WHERE NOT ({chk.column} BETWEEN {chk.low} AND {chk.high})) "
               f"FROM {src})")
    elif chk.kind == "non_negative":
        obs = f"(SELECT count(*) FILTER (WHERE {chk.column} < 0) FROM {src})"
    elif chk.kind == "min_rows":
        obs = f"(SELECT count(*) FROM {src})"
        return (f"SELECT '{model}' AS model, '*' AS column_name, 'min_rows' AS check_name, "
                f"CAST({obs} AS BIGINT) AS observed, {obs} >= {chk.min_rows} AS passed")
    else:
        raise ValueError(chk.kind)
    return (f"SELECT '{model}' AS model, '{chk.label}' AS column_name, '{chk.kind}' AS check_name, "
            f"CAST({obs} AS BIGINT) AS observed, {obs} = 0 AS passed")


def suite_sql(suite) -> str:
    return with_ctes("\nUNION ALL\n".join(check_sql(s.model, c) for s in suite for c in s.checks))
