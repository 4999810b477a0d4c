"""Results that several queries start from, computed once per owner.

A result is known by its operator, the parameters, and what the operator read of the tables:
the meaning of each plan and the files it lists. Tables opened anew over the same files find
it; new or other files don't. It is a written table of the owner it was computed under (see
``tables.owned``) and goes with that owner.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from souk.plans.tables import materialize, owner_of
from souk.schema import Tables


def shared(operator: Callable[..., DataFrame], t: Tables, **parameters) -> DataFrame:
    """``operator(t, **parameters)``, from its owner's results if it is among them."""
    kept = owner_of(t.orders.sparkSession).results.setdefault(
        (operator, tuple(sorted(parameters.items()))), [])
    for read, result in kept:
        if all(_identity(getattr(t, name)) == known for name, known in read.items()):
            return result
    noted = _Noted(t)
    result = materialize(operator(noted, **parameters))
    kept.append(({name: _identity(getattr(t, name)) for name in noted.names}, result))
    return result


def _identity(table: DataFrame) -> tuple[int, tuple[str, ...]]:
    return table.semanticHash(), tuple(sorted(table.inputFiles()))


class _Noted:
    """Tables that note which of them are read."""

    def __init__(self, t: Tables):
        self.tables, self.names = t, set()

    def __getattr__(self, name: str) -> DataFrame:
        self.names.add(name)
        return getattr(self.tables, name)

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name, _ in self.tables.items()]
