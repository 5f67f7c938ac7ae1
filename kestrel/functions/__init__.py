"""Column-expression helpers (tokenisers, Python-style arithmetic)."""

from .arith import (floor_div, ieee_divide, int_floor_div, nan_to_null, nansum, py_mod,
                    round_half_away)
from .tokens import (delete_patterns, normalise_line, space_split, whitespace_tokens,
                     word_tokens)

__all__ = ["floor_div", "int_floor_div", "round_half_away", "ieee_divide", "nan_to_null", "nansum", "py_mod",
           "delete_patterns", "normalise_line", "space_split", "whitespace_tokens",
           "word_tokens"]
