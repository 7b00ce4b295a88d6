"""Model answers: parsing, the reasons to reject one, flattening."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.columns import once
from freshet.functions.models import Field, Model

REASONS = (
    "call_error",
    "empty_content",
    "invalid_json",
    "empty_object",
    "empty_key",
    "type_mismatch",
    "domain",
    "missing_field",
)

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
# What of a JSON value may fill a field, by the field's type; null always may.
_KINDS = {
    T.LongType: "BIGINT",
    T.DoubleType: "BIGINT|DECIMAL.*|DOUBLE|FLOAT|INT|SMALLINT|TINYINT",
    T.BooleanType: "BOOLEAN",
}


def _last_value(answer: Column, name: str) -> Column:
    """Of the entries of a name the last one's value, as Python's decoder has it."""
    return F.try_element_at(F.filter(F.map_entries(answer), lambda e: e["key"] == name), F.lit(-1))["value"]


def _inside(value: Column, name: str) -> Column:
    return F.try_variant_get(value, "$[" + json.dumps(name) + "]", "variant")


def _nodes(fields: tuple[Field, ...], values: list[Column], path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], Field, Column]]:
    """Path, field and JSON value of every field at every depth."""
    found = []
    for field, value in zip(fields, values, strict=True):
        found.append(((*path, field.name), field, value))
        if field.fields:
            found += _nodes(field.fields, [_inside(value, f.name) for f in field.fields], (*path, field.name))
    return found


def _wrong_kind(field: Field, value: Column) -> Column:
    kinds = "OBJECT<.*" if field.fields else _KINDS.get(type(field.spark_type()), "STRING")
    wrong = ~F.schema_of_variant(value).rlike(f"^(?:VOID|{kinds})")
    typed = _typed(field, value)
    if not field.fields and isinstance(field.spark_type(), (T.TimestampNTZType, T.DateType, T.BinaryType)):
        # Written as text, which may not be one.
        wrong |= typed.isNull() & (F.schema_of_variant(value) != "VOID")
    return wrong


def _typed(field: Field, value: Column) -> Column:
    """The value in the field's own type."""
    if field.fields:
        return F.struct(*[_typed(f, _inside(value, f.name)).alias(f.name) for f in field.fields])
    dtype = field.spark_type()
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return F.try_variant_get(value, "$", "string").try_cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return F.try_to_binary(F.try_variant_get(value, "$", "string"), F.lit("base64"))
    return F.try_variant_get(value, "$", dtype.simpleString())


def _any(tests: list[Column]) -> Column:
    return reduce(Column.__or__, [F.coalesce(test, F.lit(False)) for test in tests], F.lit(False))


def parsed_answer(content: Column) -> Column:
    """The answer's entries, from a single parse; null where it is anything but one JSON object.

    It is parsed as the first of two array items. The second is an object whose only key, made of the text's own
    hash, cannot be in the text: found last and second, it shows that nothing stands behind the answer, where a
    parser would stop, and nothing between."""
    seal = F.concat(F.lit("sealed "), F.xxhash64(content).cast("string"))
    text = F.concat(F.lit("["), content, F.lit(',{"'), seal, F.lit('":0}]'))
    items = F.from_json(text, "array<map<string,variant>>", _STRICT)

    def answer(both: Column) -> Column:
        sealed = F.map_contains_key(F.get(both, F.lit(1)), seal)
        return F.when((F.size(both) == 2) & F.coalesce(sealed, F.lit(False)), F.get(both, F.lit(0)))

    return once(items, answer)


def reject_reason(model: Model, content: Column, answer: Column, nodes: list, error: Column | None = None) -> Column:
    """The first rule an answer fails, null for a valid one. `answer` is `parsed_answer(content)`, `nodes` its fields."""
    leaves = [(field, value) for _, field, value in nodes if not field.fields]
    text = lambda value: F.try_variant_get(value, "$", "string")
    outside = [~text(value).isin(*field.allowed) for field, value in leaves if field.allowed]
    missing = [value.isNull() | (F.schema_of_variant(value) == "VOID") for _, value in leaves]
    reason = F.when(error.isNotNull(), "call_error") if error is not None else F.when(F.lit(False), "")
    return (
        reason.when(F.coalesce(content, F.lit("")) == "", "empty_content")
        .when(answer.isNull(), "invalid_json")
        .when(F.size(F.map_keys(answer)) == 0, "empty_object")
        .when(F.array_contains(F.map_keys(answer), ""), "empty_key")
        .when(_any([_wrong_kind(field, value) for _, field, value in nodes]), "type_mismatch")
        .when(_any(outside), "domain")
        .when(_any(missing), "missing_field")
    )


def parse_responses(df: DataFrame, model: Model, content: str = "content", error: str | None = None) -> DataFrame:
    """Replace the answer text by the model's flat columns and `reject_reason`.

    Rejected rows stay, with null results; one bad answer does not touch the others. Each answer is parsed once.
    Of a key that comes twice the last value counts; inside a group such an answer is no JSON.
    """
    others = [name for name in df.columns if name not in (content, error)]
    text = F.col(content)
    parsed = df.withColumn("_answer", parsed_answer(text))
    # Each value is looked up once; a group's fields are read from it.
    tops = {f"_top_{i}": _last_value(F.col("_answer"), f.name) for i, f in enumerate(model.fields)}
    parsed = parsed.withColumns(tops)
    nodes = _nodes(model.fields, [F.col(name) for name in tops])
    reason = reject_reason(model, text, F.col("_answer"), nodes, F.col(error) if error else None)
    # A filter of the reason must not move below this step, to be worked out there with a parse for each of its rules.
    parsed = parsed.withColumn("reject_reason", F.explode(F.array(reason)))
    ok = F.col("reject_reason").isNull()
    at = {path: (field, value) for path, field, value in nodes}
    results = [F.when(ok, _typed(*at[path])).alias(name) for name, path, _ in model.flat()]
    return parsed.select(*[f"`{name}`" for name in others], *results, "reject_reason")


def valid_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def flatten(df: DataFrame, answer: str, model: Model) -> DataFrame:
    """Replace a typed answer struct by the model's columns; groups become `group.field`."""
    others = [f"`{name}`" for name in df.columns if name != answer]
    return df.select(
        *[reduce(Column.getField, path, F.col(answer)).alias(name) for name, path, _ in model.flat()], *others
    )
