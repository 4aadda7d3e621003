"""Column builders (all built-in Spark expressions, no Python UDFs)."""

from tessera.functions.cursor import cursor_position, format_cursor
from tessera.functions.json import json_scalar, parse_payload, variant_kind
from tessera.functions.temporal import (days_between, epoch_seconds, iso_utc_text,
                                        parse_iso_timestamp, seconds_to_timestamp, to_ntz)
from tessera.functions.text import full_name, title_case

__all__ = [
    "cursor_position", "format_cursor", "json_scalar", "parse_payload", "variant_kind",
    "days_between", "epoch_seconds",
    "iso_utc_text", "parse_iso_timestamp", "seconds_to_timestamp", "to_ntz", "full_name",
    "title_case",
]
