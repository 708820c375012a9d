from .fmt import escape, fixed, py_float, unescape
from .text import FIELD_SEP, TOKEN_SEP, char_length, distinct_lower_tokens, lower_tokens, tokens, word_count
from .time import epoch_millis, local_hour

__all__ = [
    "FIELD_SEP", "TOKEN_SEP", "char_length", "distinct_lower_tokens", "epoch_millis", "escape", "fixed", "local_hour",
    "lower_tokens", "py_float", "tokens", "unescape", "word_count",
]
