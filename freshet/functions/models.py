"""The structured answers a model may give: fields, allowed values, prompt."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import types as T

PYTHON_TYPES = {
    int: T.LongType(),
    str: T.StringType(),
    float: T.DoubleType(),
    bool: T.BooleanType(),
    datetime: T.TimestampNTZType(),
    date: T.DateType(),
    bytes: T.BinaryType(),
}

# Types a target table can hold; anything else is stored as text.
TABLE_TYPES = (
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
    T.StringType,
    T.BinaryType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


@dataclass(frozen=True)
class Field:
    """A named value of a Python type, optionally one of a fixed set, or a group of fields."""

    name: str
    type: type = str
    allowed: tuple[str, ...] = ()
    fields: tuple[Field, ...] = ()

    def spark_type(self) -> T.DataType:
        if self.fields:
            return T.StructType([T.StructField(f.name, f.spark_type()) for f in self.fields])
        return T.StringType() if self.allowed else PYTHON_TYPES.get(self.type, T.StringType())


@dataclass(frozen=True)
class Model:
    name: str
    prompt: str
    fields: tuple[Field, ...]

    def flat(self) -> list[tuple[str, tuple[str, ...], Field]]:
        """Result columns as (column name, path in the answer, field): one level of groups is
        flattened to `group.field`, deeper ones stay structs."""
        columns = []
        for field in self.fields:
            if field.fields:
                columns += [(f"{field.name}.{f.name}", (field.name, f.name), f) for f in field.fields]
            else:
                columns.append((field.name, (field.name,), field))
        return columns

    def result_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, field.spark_type()) for name, _, field in self.flat()])


def table_type(dtype: T.DataType) -> T.DataType:
    return dtype if isinstance(dtype, TABLE_TYPES) else T.StringType()


def _need(name: str, *allowed: str) -> Field:
    return Field(
        name,
        fields=(Field("type", allowed=allowed), Field("score", float), Field("confidence", float)),
    )


# Answer formats, allowed values and prompts. The prompts go to the model word for
# word, slips included, since its answers depend on them.

SENTIMENT = Model(
    name="sentiment",
    prompt=(
        "You are a social media expert tasked with analyzing social media posts by viewing details and metrics. "
        "Analyze the sentiment of the following social media post and provide a sentiment analysis result. "
        "The sentiment analysis result should include the sentiment score, post impact, sentiment summary, and confidence. "
        "The sentiment score ranges from -1 to 1, where -1 indicates a very negative sentiment, 0 indicates neutral sentiment, and 1 indicates a very positive sentiment. "
        "The sentiment summary should be a short summary of the sentiment analysis result. "
        "The confidence ranges from 0 to 1, where 0 indicates no confidence, and 1 indicates very high confidence."
    ),
    fields=(
        Field("score", float),
        Field("sentiment", allowed=("positive", "negative", "neutral")),
        Field("confidence", float),
    ),
)

USER_NEEDS = Model(
    name="user_needs",
    prompt=(
        "You are a social media expert tasked with analyzing social media posts by viewing details and metrics. "
        "Analyze which needs the following social media post addresses and provide a needs analysis result. "
        "For each need category (wissen, verstehen, fuehlen, machen), provide: "
        "- The specific type from the allowed options"
        "- A score (0-1) indicating how strongly this need is addressed "
        "- A confidence score (0-1) for the total assessment "
        "Finally, provide an overall confidence score (0-1) and a summaryfor the entire analysis."
    ),
    fields=(
        _need("wissen", "keep me engaged", "update me"),
        _need("verstehen", "educate me", "give me perspective"),
        _need("fuehlen", "connect me", "help me"),
        _need("machen", "inspire me", "divert me"),
        Field("summary", str),
    ),
)

MODELS = {model.name: model for model in (SENTIMENT, USER_NEEDS)}


def model_named(name: str) -> Model:
    """A registered answer format; add your own to `MODELS`."""
    try:
        return MODELS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown answer format: {name!r}") from None
