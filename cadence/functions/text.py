"""Text cleaning: missing-value tokens and Unicode-aware strip."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The strings a CSV reader with pandas 1.3 defaults reads
# as missing (exact, case-sensitive match on the whole cell).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

# Every code point Python's str.strip() removes, derived from Python's own
# definition of whitespace rather than listed by hand.  Spark's trim()
# only removes U+0020, so stripping uses btrim with this set.
WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def na_to_null(col: Column | str, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Null out cells that equal one of ``tokens`` exactly (before any trim)."""
    c = F.col(col) if isinstance(col, str) else col
    tokens = list(tokens)
    if not tokens:
        return c
    return F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)


def strip_unicode(col: Column | str) -> Column:
    """Remove leading/trailing Unicode whitespace (Python ``str.strip``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit(WHITESPACE))


def normalise_name(col: Column | str) -> Column:
    """Lower-case, then strip -- the order the cleaning rules apply."""
    c = F.col(col) if isinstance(col, str) else col
    return strip_unicode(F.lower(c))
