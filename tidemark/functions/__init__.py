"""Column expressions shared by the operators."""

from tidemark.functions.columns import (
    all_reasons,
    event_time,
    first_reason,
    is_blank,
    known_metadata,
    moment,
    no_amount,
    safe_ratio,
    typed_numbers,
)

__all__ = [
    "all_reasons",
    "event_time",
    "first_reason",
    "is_blank",
    "known_metadata",
    "moment",
    "no_amount",
    "safe_ratio",
    "typed_numbers",
]
