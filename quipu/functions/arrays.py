"""Array and map expressions with Python's list and dict rules (0-based places)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(a: Column, kind: str = "double") -> Column:
    """Sum of the elements, 0 for an empty array."""
    return F.aggregate(a, F.lit(0).cast(kind), lambda acc, x: acc + x.cast(kind))


def item(a: Column, place: int) -> Column:
    """Element at a 0-based place; negative places count from the end."""
    return F.try_element_at(a, F.lit(place + 1 if place >= 0 else place))


def cut(a: Column, start: int = 0, stop: int | None = None, step: int = 1) -> Column:
    """Elements ``start`` to ``stop - 1``, every ``step``-th of them."""
    size = F.size(a)

    def place(i: int) -> Column:
        return F.least(F.lit(i), size) if i >= 0 else F.greatest(size + i, F.lit(0))

    first = place(start)
    last = size if stop is None else place(stop)
    part = F.slice(a, first + 1, F.greatest(last - first, F.lit(0)))
    return part if step == 1 else F.filter(part, lambda _, i: i % step == 0)


def insert_at(a: Column, place: int, value: Column) -> Column:
    """The value put before a place; past the end it is appended."""
    at = F.least(F.lit(place), F.size(a))
    return F.concat(
        F.slice(a, F.lit(1), at), F.array(value), F.slice(a, at + 1, F.size(a) - at)
    )


def remove_first(a: Column, value: Column) -> Column:
    """Without the first occurrence of a value; unchanged if there is none."""
    place = F.array_position(a, value)
    return F.when(place == 0, a).otherwise(F.filter(a, lambda _, i: i != place - 1))


def pop_at(a: Column, place: int) -> Column:
    """Without the element at a place; negative places count from the end."""
    at = F.lit(place) if place >= 0 else F.size(a) + place
    return F.filter(a, lambda _, i: i != at)


def set_at(a: Column, place: int, value: Column) -> Column:
    at = F.lit(place) if place >= 0 else F.size(a) + place
    return F.transform(a, lambda x, i: F.when(i == at, value).otherwise(x))


def index_of(a: Column, value: Column) -> Column:
    """0-based place of the first occurrence; null if there is none."""
    return F.nullif(F.array_position(a, value), F.lit(0)) - 1


def count_of(a: Column, value: Column) -> Column:
    return F.size(F.filter(a, lambda x: x == value))


def times(a: Column, n: int) -> Column:
    """The array repeated ``n`` times in a row."""
    return F.flatten(F.array_repeat(a, n))


def grade_summary(a: Column, passing: float = 4.0) -> Column:
    """Average, best, worst and pass mark of a list of grades; zeros when empty."""
    average = F.coalesce(F.try_divide(total(a), F.size(a)), F.lit(0.0))
    zero = F.lit(0.0)
    return F.struct(
        average.alias("average"),
        F.coalesce(F.array_max(a).cast("double"), zero).alias("best"),
        F.coalesce(F.array_min(a).cast("double"), zero).alias("worst"),
        ((F.size(a) > 0) & (average >= passing)).alias("passed"),
    )


def get(m: Column, key: Column, default: Column | None = None) -> Column:
    """Value of a key, or the default when the key is absent."""
    found = F.try_element_at(m, key)
    if default is None:
        return found
    return F.when(F.map_contains_key(m, key), found).otherwise(default)


def without_key(m: Column, key: Column) -> Column:
    return F.map_filter(m, lambda k, _: k != key)


def put(m: Column, key: Column, value: Column) -> Column:
    """The map with a key set, whether or not it was there."""
    return F.map_concat(without_key(m, key), F.create_map(key, value))


def set_default(m: Column, key: Column, value: Column) -> Column:
    """The map with a key set only if it was absent."""
    return F.when(F.map_contains_key(m, key), m).otherwise(put(m, key, value))
