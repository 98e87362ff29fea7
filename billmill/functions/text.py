from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billmill.schema import NA_TOKENS


def quoted(name: str) -> str:
    """A column name for SQL text; bill columns hold spaces, ``#`` and parentheses."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column by its literal name."""
    return F.col(quoted(name))


_TOKENS = ", ".join(f"'{token}'" for token in NA_TOKENS)


def null_if_na(name: str) -> Column:
    """NULL when the text column holds one of the no-value spellings, else the text unchanged."""
    return F.expr(f"CASE WHEN {quoted(name)} NOT IN ({_TOKENS}) THEN {quoted(name)} END")


def member_or(name: str, unknown: str) -> Column:
    """The text unchanged, or ``unknown`` where it is NULL or a no-value spelling."""
    text = f"CAST({quoted(name)} AS STRING)"
    return F.expr(f"CASE WHEN {text} NOT IN ({_TOKENS}) THEN {text} ELSE '{unknown}' END")
