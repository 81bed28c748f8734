"""Column-level helpers shared by the operators."""

from tidemark.functions.columns import (
    broadcast_if_small,
    estimated_bytes,
    from_micros,
    micros,
    to_ntz,
    width_micros,
)

__all__ = ["broadcast_if_small", "estimated_bytes", "from_micros", "micros", "to_ntz", "width_micros"]
