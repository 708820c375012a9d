"""Text expressions. All are built-in Catalyst expressions (code-generated, no Python per row).

Tokenising follows the single-space rule of the message format: ``split(text, ' ')`` keeps empty tokens (runs of
spaces, leading/trailing spaces) and leaves newlines and punctuation inside tokens. Lengths are code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token separator and the field separator of the message format.
TOKEN_SEP = " "
FIELD_SEP = "\t"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: str | Column) -> Column:
    """All single-space tokens of ``text`` in order, empty tokens kept (``split`` with limit -1)."""
    return F.split(_col(text), TOKEN_SEP, -1)


def word_count(text: str | Column) -> Column:
    """Number of single-space tokens: one more than the number of spaces (NULL for a NULL text, whatever
    ``spark.sql.legacy.sizeOfNull`` says)."""
    return F.when(_col(text).isNotNull(), F.size(tokens(text)))


def char_length(text: str | Column) -> Column:
    """Length in code points (an emoji counts as one)."""
    return F.length(_col(text))


def lower_tokens(text: str | Column) -> Column:
    """Tokens of the lower-cased text (the classifier's tokenising: no length filter, empties kept)."""
    return tokens(F.lower(_col(text)))


def distinct_lower_tokens(text: str | Column) -> Column:
    """Each lower-cased token once per text: one vote per message per word."""
    return F.array_distinct(lower_tokens(text))
