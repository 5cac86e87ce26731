"""Column-expression builders (pure ``Column -> Column`` helpers, all JVM-side)."""

from cellhealth.functions.expressions import (  # noqa: F401
    battery_id_from_path,
    battery_type_from_path,
    clip,
    cycle_bucket,
    health_status,
    safe_ratio,
    to_double,
)
