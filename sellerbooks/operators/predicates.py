"""Record filters built from clauses, folded left to right."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clause(field: str, test: str, value: str | bool) -> Column:
    """``CT`` contains the text, ``EX`` equals it. The texts True and False mean booleans."""
    if value in ("True", "False") or isinstance(value, bool):
        return F.col(field) == F.lit(value in ("True", True))
    if test == "CT":
        return F.lower(F.col(field)).contains(str(value).lower())
    if test == "EX":
        return F.lower(F.col(field).cast("string")) == str(value).lower()
    raise ValueError(f"unknown test {test}")


def build_predicate(clauses: Sequence[tuple[str, str, str | bool]], operators: Sequence[str] = ()) -> Column:
    """Join clauses with ``AND``/``OR`` in the order given, no precedence: ``(a AND b) OR c``."""
    if len(operators) != len(clauses) - 1:
        raise ValueError("one operator fewer than clauses is needed")
    predicate = clause(*clauses[0])
    for operator, parts in zip(operators, clauses[1:]):
        predicate = predicate & clause(*parts) if operator.upper() == "AND" else predicate | clause(*parts)
    return predicate
