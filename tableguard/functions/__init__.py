"""Column-expression building blocks (verdicts, bands, value text)."""

from .text import concat_key, num_text, value_num, value_text
from .verdict import (band_bounds, band_pass, mode_predicate, ratio, relative_change_pass,
                      round_int, source_count_pass)

__all__ = [
    "band_bounds", "band_pass", "concat_key", "mode_predicate", "num_text", "ratio",
    "relative_change_pass", "round_int", "source_count_pass", "value_num", "value_text",
]
