"""Column -> Column expressions."""

from featurepipe.functions.nulls import null_if_sentinel
from featurepipe.functions.numeric import NUMBER_BODY, NUMBER_PATTERN, null_outside, to_number
from featurepipe.functions.text import (
    PY_WHITESPACE_CLASS, has_match, once, py_strip, strip_accents, word_count,
)

__all__ = [
    "NUMBER_BODY", "NUMBER_PATTERN", "PY_WHITESPACE_CLASS", "has_match", "null_if_sentinel", "null_outside", "once",
    "py_strip", "strip_accents", "to_number", "word_count",
]
