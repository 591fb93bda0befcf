"""Column expressions built from Spark built-ins only (no Python UDFs)."""

from lakemart.functions.timeparts import (  # noqa: F401
    WEEKDAY_BASES, epoch_ms_to_ntz, epoch_ms_to_timestamp, epoch_ms_whole_seconds, epoch_ms_to_text,
    ntz_to_epoch_ms, weekday, time_parts,
)
from lakemart.functions.defaults import typed_default, with_defaults, number_as_text  # noqa: F401
