"""Document filters as a table: one row per rule, NULL where a rule does not care.

The filter classes become predicates, which suits a handful of rules. Rules kept in a table, thousands of them, are
joined instead: every combination of values that occurs among the rows is spread over the 2^4 patterns of NULL and
value it may be ruled by, and those meet the rules by equality. Combinations are few; the rows are never multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.filters import FlatFilter, UnitFilter
from docloom.staging import stage

RULE_COLUMNS = ["doc_control_name", "document_type", "document_subtype", "status"]
_SCHEMA = ", ".join(f"{c} string" for c in RULE_COLUMNS)


def rules_of(spark: SparkSession, spec: FlatFilter | UnitFilter) -> DataFrame:
    """The rows of a filter. A list of document numbers is not a rule: join it with ``operators.stages.in_batch``."""
    if isinstance(spec, FlatFilter):
        if spec.numbers is not None:
            raise ValueError("document numbers are no rule columns")
        units, statuses = spec.units, spec.statuses
        types = None if spec.types is None else [(r.type, s) for r in spec.types for s in (r.subtypes or (None,))]
        rows = [(u, t, s, status) for u in (units if units is not None else (None,))
                for t, s in (types if types is not None else [(None, None)])
                for status in (statuses if statuses is not None else (None,))]
    else:
        rows = [(unit, rule.type, s, status) for unit, unit_rules in spec.units.items() for rule in unit_rules
                for s in (rule.subtypes or (None,)) for status in spec.statuses]
    return spark.createDataFrame(rows, _SCHEMA)


def _patterns(columns: list[str]) -> Column:
    """All ways to replace some of the columns by NULL, as an array of structs."""
    shapes = [[]]
    for c in columns:
        shapes = [s + [v] for s in shapes for v in (F.col(c), F.lit(None).cast("string"))]
    return F.array(*(F.struct(*(v.alias(c) for v, c in zip(shape, columns, strict=True))) for shape in shapes))


def matching(rows: DataFrame, rules: DataFrame, columns: list[str] = RULE_COLUMNS) -> DataFrame:
    """The rows that at least one rule lets in, each once. A NULL value meets only rules that do not care for it.

    A rule without any value lets everything in; an empty rule table lets nothing in.
    """
    present = rows.select(*columns).distinct()
    # A NULL in the row would look like a wildcard: its own pattern is dropped by asking for equal values.
    spread = present.select(*[F.col(c).alias(f"_{c}") for c in columns], F.explode(_patterns(columns)).alias("_p")).distinct()
    wanted = rules.select(*[F.col(c).alias(f"_r{c}") for c in columns]).distinct()
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"_p.{c}").eqNullSafe(F.col(f"_r{c}"))
    allowed = stage(spread.join(wanted, same, "left_semi").select(*[f"_{c}" for c in columns]).distinct(), "allowed")
    met = F.lit(True)
    for c in columns:
        met = met & rows[c].eqNullSafe(allowed[f"_{c}"])
    return rows.join(allowed, met, "left_semi")
