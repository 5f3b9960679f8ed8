"""Raw record to typed event, with the reason a record is not acceptable."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from retailflow.schemas import EVENTS, NUMBERS, Field, columns, json_schema


def parse_events(raw: DataFrame, kind: str) -> DataFrame:
    """Typed event columns, the record's text as ``value`` and ``reject_reason``.

    Works the same on a batch and on a stream. A good record has a NULL
    ``reject_reason`` and no ``value``, so the text is only kept where somebody has
    to look at it.

    The struct is flattened by ``inline``: a filter on its fields stops there. Below
    a plain projection, the filter would repeat from_json for each field it names.
    """
    record = F.from_json("value", json_schema(kind))
    parsed = raw.select(F.col("value").cast("string").alias("value")).select(
        "value", F.inline(F.array(record))
    )
    cast = [f for f in EVENTS[kind] if f.type in _RAW]
    typed = parsed.withColumns({f"_{f.name}": F.col(f.name) for f in cast}).withColumns(
        {f.name: _typed(F.col(f.name), f.type) for f in cast}
    )
    reason = reject_reason(kind)
    return typed.withColumn("reject_reason", reason).select(
        *columns(kind),
        F.when(F.col("reject_reason").isNotNull(), F.col("value")).alias("value"),
        "reject_reason",
    )


# Fields that are cast after they are read; ``_<name>`` is what the record gives.
_RAW = ("timestamp", *NUMBERS)


def _typed(given: Column, kind: str) -> Column:
    """NULL unless the value is of its type.

    A time must have a full date, as a cast fills in what is missing. A number is a JSON
    value of the right kind, as a cast takes "3", 2.5 and true for whole numbers too.
    """
    if kind == "timestamp":
        full = given.rlike(r"^\s*\d{4,6}-\d{1,2}-\d{1,2}([ T]|$)")
        return F.when(full, given.try_cast("timestamp"))
    right = F.schema_of_variant(given).rlike(NUMBERS[kind])
    return F.when(right, F.try_variant_get(given, "$", kind))


def _present(field: Field) -> Column:
    """Whether the record gives the field; null in JSON is not given."""
    if field.type in NUMBERS:
        given = F.col(f"_{field.name}")
        return given.isNotNull() & ~F.is_variant_null(given)
    return F.col(f"_{field.name}" if field.type in _RAW else field.name).isNotNull()


def reject_reason(kind: str) -> Column:
    """NULL for a good record, else every broken rule, in field order."""
    fields = EVENTS[kind]
    unreadable = reduce(Column.__and__, [~_present(field) for field in fields])
    broken = F.concat_ws(",", *[rule for field in fields for rule in _rules(field)])
    return F.when(unreadable, F.lit("unreadable")).when(broken != "", broken)


def _rules(field: Field) -> list[Column]:
    value, present = F.col(field.name), _present(field)
    rules = []
    if field.type in _RAW:
        rules.append(F.when(present & value.isNull(), F.lit(f"invalid:{field.name}")))
    if field.required:
        rules.append(F.when(~present, F.lit(f"missing:{field.name}")))
    if field.max_length:
        rules.append(
            F.when(F.length(value) > field.max_length, F.lit(f"too_long:{field.name}"))
        )
    return rules


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("value", "reject_reason")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select("value", "reject_reason")
