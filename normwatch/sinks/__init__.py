"""Writers."""

from normwatch.sinks.files import (
    register_view,
    round_trip_parquet,
    write_json,
    write_nested_json,
    write_ntriples,
    write_parquet,
)
from normwatch.sinks.late import add_late, new_rows, replace_dates

__all__ = [
    "add_late",
    "new_rows",
    "register_view",
    "replace_dates",
    "round_trip_parquet",
    "write_json",
    "write_nested_json",
    "write_ntriples",
    "write_parquet",
]
