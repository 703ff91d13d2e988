"""Code rules as JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rulebook as R


def _lookup(key: Column, table: Mapping) -> Column:
    """Value of a key in a literal map, NULL for an unknown key.

    A map is looked up once per row however many entries it has; a CASE chain would
    repeat the key expression in every branch and bloat the generated code.
    """
    entries = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), key)


def conform_label(code: Column | str, labels: Mapping[str, str]) -> Column:
    """Source code -> shared label; a code outside the dictionary is NULL."""
    return _lookup(F.trim(F.col(code) if isinstance(code, str) else code), labels)


def year_lookup(year: Column, table: Mapping[int, float]) -> Column:
    return _lookup(year, table)


def simple_case(code: Column, labels: Mapping, otherwise: str) -> Column:
    return F.coalesce(_lookup(code, labels), F.lit(otherwise))


def major_group(occupation: Column, labels: Mapping[str, str] = R.MAJOR_GROUP_LABELS) -> Column:
    return simple_case(F.substring(occupation, 1, 1), labels, R.UNKNOWN_M)


def default_label(label: Column, *fallbacks: Column) -> Column:
    return F.coalesce(label, *fallbacks)


def code_flag(code: Column, value) -> Column:
    return code == F.lit(value)


def in_set(code: Column, members: Iterable) -> Column:
    return code.isin(sorted(members))


def group_members(
    label: Column,
    groups: Mapping[str, Iterable[str]],
    otherwise: str,
) -> Column:
    """Fold labels into named groups; anything else, NULL included, is ``otherwise``."""
    expr = None
    for name, members in groups.items():
        condition = label.isin(list(members))
        expr = F.when(condition, F.lit(name)) if expr is None else expr.when(condition, F.lit(name))
    return expr.otherwise(F.lit(otherwise))


def signed_effect(balance: Column, kind: Column, cancelled: str = "EXC") -> Column:
    """A cancellation counts with the opposite sign of the event it cancels."""
    return balance * F.when(kind == cancelled, -1).otherwise(1)


def plausible_value(
    value: Column,
    unit: Column,
    reference: Column,
    expected_unit: str = R.MONTHLY_UNIT,
    low: float = R.WAGE_FLOOR,
    high: float = R.WAGE_CEILING,
) -> Column:
    """Keep a value given in the expected unit and within low..high references, edges included."""
    return F.when((unit == expected_unit) & value.between(reference * low, reference * high), value)


def turnover_flags(
    admission_month: Column,
    separation_month: Column,
    contract_type: Column,
    reason: Column,
    statutory: Iterable[int] = R.STATUTORY_TYPES,
    excluded: Iterable[int] = R.NON_TURNOVER_REASONS,
) -> tuple[Column, Column]:
    """(counts as entry, counts as exit). NULL inputs give NULL, which is not counted."""
    market = ~in_set(contract_type, statutory)
    entry = admission_month.between(1, 12) & market
    exit_ = separation_month.between(1, 12) & market & ~in_set(reason, excluded)
    return entry, exit_


def eligible_size(eligible: Column, size: Column, otherwise: str = R.NOT_APPLICABLE) -> Column:
    return F.when(eligible & size.isNotNull(), size).otherwise(F.lit(otherwise))


def informality(position: Column, registry: Column) -> Column:
    """NULL when there is no position; otherwise always true or false.

    An unknown registry answer is not a "no", so the comparison is null-safe.
    """
    unregistered = in_set(position, R.POSITIONS_NEEDING_REGISTRY) & registry.eqNullSafe(F.lit(R.NO_REGISTRY))
    always = in_set(position, [*R.UNREGISTERED_POSITIONS, *R.FAMILY_HELPER_POSITIONS])
    return F.when(position.isNotNull(), always | unregistered)
