"""Declarative document filters turned into predicates, never into query text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _is_in(column: str, values: Sequence[Any]) -> Column:
    return F.col(column).isin(*values)


def _any(parts: Sequence[Column]) -> Column:
    return reduce(or_, parts, F.lit(False)) if parts else F.lit(False)


def _all(parts: Sequence[Column]) -> Column:
    return reduce(and_, parts) if parts else F.lit(True)


@dataclass(frozen=True)
class TypeRule:
    """A document type, narrowed to some subtypes when any are given."""

    type: str
    subtypes: tuple[str, ...] = ()

    def predicate(self) -> Column:
        base = F.col("document_type") == F.lit(self.type)
        return base & _is_in("document_subtype", self.subtypes) if self.subtypes else base


@dataclass(frozen=True)
class FlatFilter:
    """Optional clauses, all of which must hold; an absent clause does not restrict."""

    numbers: tuple[str, ...] | None = None
    units: tuple[str, ...] | None = None
    types: tuple[TypeRule, ...] | None = None
    statuses: tuple[str, ...] | None = None

    def predicate(self) -> Column:
        parts = []
        for column, values in (
            ("document_number", self.numbers),
            ("doc_control_name", self.units),
            ("status", self.statuses),
        ):
            if values is not None:
                parts.append(_is_in(column, values))
        if self.types is not None:
            parts.append(_any([rule.predicate() for rule in self.types]))
        return _all(parts)


@dataclass(frozen=True)
class UnitFilter:
    """Per unit, the type rules that apply to it; a status list on top."""

    units: Mapping[str, Sequence[TypeRule]] = field(default_factory=dict)
    statuses: tuple[str, ...] = ()

    def predicate(self) -> Column:
        rules = [
            (F.col("doc_control_name") == F.lit(unit)) & rule.predicate()
            for unit, unit_rules in self.units.items()
            for rule in unit_rules
        ]
        return _any(rules) & _is_in("status", self.statuses)


def search_filter(spec: Mapping[str, Any]) -> Column:
    """Column to scalar or list of allowed values; all columns must agree."""
    parts = []
    for column, wanted in spec.items():
        values = list(wanted) if isinstance(wanted, (list, tuple, set)) else [wanted]
        parts.append(_is_in(column, values))
    return _all(parts)
