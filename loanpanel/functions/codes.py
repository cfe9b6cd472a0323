"""Code lists and bounds as column expressions."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(value: Column, mapping: Mapping) -> Column:
    """``mapping[value]``, null when absent. Identity maps become one IN test."""
    if all(key == label for key, label in mapping.items()):
        return F.when(value.isin(*mapping), value)
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), value)


def map_codes(value: Column, mapping: Mapping[str, str], default=None) -> Column:
    """Code -> label; a label stays itself; anything else -> ``default``."""
    known = {label: label for label in mapping.values()} | dict(mapping)
    found = lookup(value.cast("string"), known)
    return found if default is None else F.coalesce(found, F.lit(default))


def clip(value: Column, low: float, high: float) -> Column:
    bounded = F.least(F.greatest(value, _bound(low)), _bound(high))
    return F.when(value.isNotNull(), bounded)


def _bound(limit: float) -> Column:
    return F.lit(float(limit)).cast("float")


def indicator(condition: Column) -> Column:
    """0/1 byte; an unknown condition counts as 0."""
    return F.when(condition, 1).otherwise(0).cast("byte")


def named(columns: Mapping[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]
