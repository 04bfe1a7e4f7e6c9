"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from panelforge.functions.core import (  # noqa: F401
    clamp,
    nan_to_null,
    r6,
    safe_div,
    safe_float,
    safe_timestamp,
    signed_expm1,
    signed_log1p,
)
