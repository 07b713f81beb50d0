"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from millrace.functions.casts import (  # noqa: F401
    clean_text, to_bigint, to_date, to_decimal, to_int, to_timestamp_ntz, to_typed,
)
from millrace.functions.metrics import (  # noqa: F401
    day_diff, hours_between, ratio_percent, round2, surrogate_key,
)
