"""Column functions used by the marts (all JVM-side built-ins, no Python UDFs)."""

from martsmith.functions.scalar import (
    PAYMENT_TYPE_LABELS,
    collated,
    decode_codes,
    full_name,
    json_fields,
    nan_to_null,
)

__all__ = [
    "PAYMENT_TYPE_LABELS",
    "collated",
    "decode_codes",
    "full_name",
    "json_fields",
    "nan_to_null",
]
