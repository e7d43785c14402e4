"""Values whose shape is not known beforehand, as VARIANT: lists in lists to any depth, one object or a list of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LISTS = "array<variant>"


def variant(text: Column) -> Column:
    """The value of a JSON text; null where it is none."""
    return F.try_parse_json(text)


def depth(v: Column) -> Column:
    """How many brackets are open at most in a value: as deep as lists can be nested in it."""
    brackets = F.regexp_replace(F.to_json(v), r'"(?:[^"\\]++|\\.)*+"|[^\[\]"]+', "")
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("most"))

    def step(state: Column, bracket: Column) -> Column:
        now = state["open"] + F.when(bracket == "[", 1).when(bracket == "]", -1).otherwise(0)
        return F.struct(now.alias("open"), F.greatest(state["most"], now).alias("most"))

    return F.aggregate(F.split(brackets, ""), start, step, lambda state: state["most"])


def leaves(v: Column) -> Column:
    """All values that are no lists, in order, from lists nested to any depth; without nulls. A value by itself is one leaf.

    Each row opens its lists as many times as it is deep, within the row: nothing is exploded, shuffled or counted first.
    """
    opened = lambda x: F.coalesce(F.try_variant_get(x, "$", _LISTS), F.array(x))
    flat = F.aggregate(F.sequence(F.lit(0), depth(v)), F.array(v), lambda found, _: F.flatten(F.transform(found, opened)))
    return F.filter(flat, lambda x: ~F.is_variant_null(x))


def leaf_texts(v: Column) -> Column:
    """leaves() as text: a text is itself, anything else its JSON."""
    return F.transform(leaves(v), lambda x: F.try_variant_get(x, "$", "string"))


def named(v: Column, field: str = "text") -> Column:
    """The names in one object, one text, or lists of either: an object's name is in `field`. Without what has no name."""
    name = lambda x: F.when(F.startswith(F.schema_of_variant(x), F.lit("OBJECT")), F.try_variant_get(x, f"$.{field}", "string")).otherwise(F.try_variant_get(x, "$", "string"))
    return F.filter(F.transform(leaves(v), name), lambda n: n.isNotNull() & (n != ""))
