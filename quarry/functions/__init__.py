"""Column expressions. All are built-in Spark expressions (codegen, no Python
in the task)."""

from quarry.functions.numeric import sq_distance, trunc_div
from quarry.functions.recode import age_group, sex_label, working_status
from quarry.functions.text import mentions, tokens, vocabulary_hits

__all__ = [
    "age_group", "mentions", "sex_label", "sq_distance", "tokens", "trunc_div",
    "vocabulary_hits", "working_status",
]
