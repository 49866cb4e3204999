"""String expressions with Unicode white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where a text breaks into lines: all the marks that Unicode counts as line ends.
LINE_BREAK = "\\r\\n|[\\n\\r\\u000B\\u000C\\u001C-\\u001E\\u0085\\u2028\\u2029]"
_SPACE = "(?U)[\\s\\u001C-\\u001F]"


def strip(x: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(x, f"^{_SPACE}+|{_SPACE}+$", "")


def squash(x: Column) -> Column:
    """Every run of white space as one blank."""
    return F.regexp_replace(x, f"{_SPACE}+", " ")


def blank_to_null(x: Column, *blanks: str) -> Column:
    """Stripped; null if nothing or one of ``blanks`` is left."""
    bare = strip(x)
    return F.when(~bare.isin("", *blanks), bare)


def before_first(x: Column, mark: str) -> Column:
    """Trimmed text before the first ``mark`` (all of it if there is none); null if empty."""
    return F.nullif(F.trim(F.split_part(x, F.lit(mark), F.lit(1))), F.lit(""))
