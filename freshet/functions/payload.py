"""A row as the JSON text and the chat messages a model is sent, as column expressions.

The text is that of Python's `json.dumps(row, ensure_ascii=True)`: `", "` and `": "` as separators,
nulls kept, everything outside printable ASCII as lower-case `\\uXXXX`.
"""

from __future__ import annotations

import json
from collections.abc import Collection
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.columns import once
from freshet.functions.times import iso_timestamp
from freshet.operators.projection import included


def bytes_text(col: Column) -> Column:
    """ASCII bytes as text, any others as lower-case hex."""
    digits = F.hex(col)
    ascii_only = digits.rlike("^([0-7][0-9A-F])*$")
    return F.when(ascii_only, F.decode(col, "US-ASCII")).otherwise(F.lower(digits))


def json_string(col: Column) -> Column:
    """A quoted JSON string. `to_json` escapes with upper-case digits and leaves DEL as it is; text that needs
    no escape is quoted alone."""
    document = F.to_json(F.struct(col.alias("v")), {"writeNonAsciiCharacterAsCodePoint": "true"})
    quoted = F.substr(document, F.lit(len('{"v":') + 1), F.length(document) - len('{"v":}'))
    quoted = F.replace(quoted, F.lit("\x7f"), F.lit("\\u007f"))

    def lower_escapes(text: Column) -> Column:
        # Tokens: a code point escape, another escape, or a run without backslash. Going by tokens
        # keeps an escaped backslash before a "u" from being read as an escape.
        tokens = F.regexp_extract_all(text, F.lit(r"(\\u[0-9A-Fa-f]{4}|\\.|[^\\]++)"), F.lit(0))
        lowered = F.transform(tokens, lambda t: F.when(t.startswith("\\u"), F.lower(t)).otherwise(t))
        return F.when(F.contains(text, F.lit("\\u")), F.array_join(lowered, "")).otherwise(text)

    plain = col.rlike(r"^[ !#-\[\]-~]*+\z")
    return F.when(plain, F.concat(F.lit('"'), col, F.lit('"'))).otherwise(once(quoted, lower_escapes))


# 2^e for e from _LOW on, as 38 digits each, all zeros behind them left out: _POWERS[e - _LOW] times 10 to the
# power of _TENS[e - _LOW], rounded down.
_LOW, _HIGH, _WIDTH = 9, 971, 38


@cache
def _powers() -> tuple[str, str]:
    digits, tens = [], []
    for e in range(_LOW, _HIGH + 1):
        left_out = len(str(2**e)) - _WIDTH
        digits.append(str(2**e // 10**left_out if left_out > 0 else 2**e * 10**-left_out))
        tens.append(f"{left_out:4d}")
    return "".join(digits), "".join(tens)


def _first_fit(texts: Column, value: Column) -> Column:
    """The first of an array of texts that gives the value; null if none does."""
    return F.try_element_at(F.filter(texts, lambda t: t.try_cast("double") == value), F.lit(1))


def _whole_digits(size: Column) -> Column:
    """The shortest text of a whole value beyond 2^61, and of those the nearest one, as `123E45`; null if none.

    The value is m * 2^e, m of 53 bits. m times the power's first 22 digits and, for what is carried, its
    other 16 fits a decimal, which makes some 37 digits of the value, right but for the last ones. Rounded to
    15, 16 and 17 of them it gives the texts of each length, the nearer one first."""
    digits, tens = _powers()
    low = F.greatest(F.floor(F.log2(size)) - 53, F.lit(_LOW - 1))
    # The logarithm may be off by one next to a power of two.
    m = size * F.pow(F.lit(2.0), -low)
    e = F.greatest(low + F.when(m >= 2.0**54, 2).when(m >= 2.0**53, 1).otherwise(0), F.lit(_LOW))

    def product(at: Column) -> Column:
        m = (size * F.pow(F.lit(2.0), -at)).cast("decimal(16,0)")
        start = (at - _LOW) * _WIDTH
        head = F.substr(F.lit(digits), (start + 1).cast("int"), F.lit(22)).cast("decimal(22,0)")
        rest = F.substr(F.lit(digits), (start + 23).cast("int"), F.lit(16)).cast("decimal(16,0)")
        carried = F.floor(m * rest / F.lit(10**16).cast("decimal(17,0)")).cast("decimal(17,0)")
        ten = F.trim(F.substr(F.lit(tens), ((at - _LOW) * 4 + 1).cast("int"), F.lit(4))).cast("int") + 16
        return F.struct((m * head + carried).cast("string").alias("digits"), ten.alias("ten"))

    def text(found: Column) -> Column:
        every, ten = found.getField("digits"), found.getField("ten")

        def around(n: Column) -> Column:
            whole = F.substr(every, F.lit(1), n).cast("bigint")
            up = (F.substr(every, n + 1, F.lit(1)) >= "5").cast("bigint")
            behind = F.concat(F.lit("E"), (F.length(every) - n + ten).cast("string"))
            # Next to a power of two the farther one alone may give the value.
            return F.transform(F.array(up, 1 - up), lambda step: F.concat((whole + step).cast("string"), behind))

        return _first_fit(F.flatten(F.transform(F.array(F.lit(15), F.lit(16), F.lit(17)), around)), size)

    return once(once(e.cast("int"), product), text)


def _shortest(value: Column) -> Column:
    """The value in scientific form, `1.5E20`, with no more digits than tell it from its neighbours.

    Java before release 19 now and then writes a digit too many, or the farther of two texts. That shows by
    16 digits or more, or next to the smallest values; there, fewer digits are tried until they no longer
    give the value."""
    text = value.cast("string")
    size = F.abs(value)

    def signed(plain: Column) -> Column:
        return F.when(value < 0, F.concat(F.lit("-"), plain)).otherwise(plain)

    def shown(fewest: int, most: int) -> Column:
        formats = F.transform(F.sequence(F.lit(fewest - 1), F.lit(most - 1)), lambda n: F.concat(F.lit("%."), n.cast("string"), F.lit("E")))
        return _first_fit(F.transform(formats, lambda f: F.call_function("format_string", f, value)), value)

    # Whole numbers in reach, of 16 to 19 digits, are rounded from their exact digits.
    whole = size.try_cast("bigint")
    exact = F.array(*[F.round(whole, -dropped).cast("string") for dropped in (4, 3, 2, 1, 0)])
    long = F.length(F.regexp_replace(F.substring_index(text, "E", 1), "[-.]|^0[.]0*", "")) >= 16
    found = (
        F.when(size.between(2.0**53, 2.0**61), signed(_first_fit(exact, size)))
        .when(value == 0, text)
        .when(size < 1e-300, shown(1, 17))
        .when(long & (size > 2.0**61) & (size < float("inf")), signed(_whole_digits(size)))
        .when(long, shown(15, 17))
    )
    return F.coalesce(found, text)


def float_text(col: Column) -> Column:
    """A double as Python shows it: plain digits for exponents -4 to 15, else like `1e+20`.

    Java's own text is that already where it has no exponent and at most 15 digits: no shorter one and no other
    of 15 gives the value. Only other values take the long way, which computes each part once."""
    value = col.cast("double")
    text = value.cast("string")
    plain = ~F.contains(text, F.lit("E")) & (F.length(text) <= 16) & text.rlike("^-?[0-9]")
    return F.when(plain, text).otherwise(once(value, lambda v: once(_shortest(v), _python_style)))


def _python_style(text: Column) -> Column:
    """From digits with a point, without one, or with an exponent behind `E`, whatever its form."""
    return F.when(text.rlike("^-?[0-9]"), once(_parts(text), lambda parts: once(_digits(parts), _laid_out))).otherwise(text)


def _parts(text: Column) -> Column:
    number = r"^-?([0-9]+)(?:[.]([0-9]+))?"
    return F.struct(
        F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")).alias("sign"),
        F.regexp_extract(text, number, 1).alias("mantissa"),
        F.regexp_extract(text, number, 2).alias("fraction"),
        F.coalesce(F.regexp_extract(text, r"E[+]?(-?[0-9]+)$", 1).try_cast("int"), F.lit(0)).alias("power"),
    )


def _digits(parts: Column) -> Column:
    """Sign, digits without zeros at either end, and the exponent of the first one."""
    mantissa = parts.getField("mantissa")
    every = F.concat(mantissa, parts.getField("fraction"))
    significant = F.ltrim(every, F.lit("0"))
    leading = F.length(every) - F.length(significant)
    exponent = F.length(mantissa) - 1 - leading + parts.getField("power")
    return F.struct(
        parts.getField("sign").alias("sign"),
        F.when(significant == "", F.lit("0")).otherwise(F.regexp_replace(significant, "(?<=.)0+$", "")).alias("digits"),
        F.when(significant == "", F.lit(0)).otherwise(exponent).alias("exponent"),
    )


def _laid_out(number: Column) -> Column:
    sign, digits, exponent = (number.getField(name) for name in ("sign", "digits", "exponent"))
    head, tail = F.substr(digits, F.lit(1), F.lit(1)), F.substr(digits, F.lit(2))
    scientific = F.concat(
        F.when(tail == "", head).otherwise(F.concat(head, F.lit("."), tail)),
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(exponent).cast("string"),
    )
    whole = exponent + 1
    large = F.when(
        F.length(digits) <= whole,
        F.concat(digits, F.repeat(F.lit("0"), whole - F.length(digits)), F.lit(".0")),
    ).otherwise(F.concat(F.substr(digits, F.lit(1), whole), F.lit("."), F.substr(digits, whole + 1)))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    rebuilt = (
        F.when((exponent >= 16) | (exponent < -4), scientific).when(exponent < 0, small).otherwise(large)
    )
    return F.concat(sign, rebuilt)


class _Pair(T.StructType):
    """A map entry, shown as a list of two."""

    def __init__(self, key: T.DataType, value: T.DataType):
        super().__init__([T.StructField("key", key), T.StructField("value", value)])


def json_value(col: Column, dtype: T.DataType) -> Column:
    """Any column as JSON text; null becomes `null`.

    Dates and decimals, for which the plain encoder has no form, are written as strings.
    """
    if isinstance(dtype, T.StringType):
        text = json_string(col)
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = F.concat(F.lit('"'), iso_timestamp(col, dtype), F.lit('"'))
    elif isinstance(dtype, T.BinaryType):
        text = json_string(bytes_text(col))
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        text = float_text(col)
    elif isinstance(dtype, (T.IntegralType, T.BooleanType)):
        text = col.cast("string")
    elif isinstance(dtype, _Pair):
        key, value = (json_value(col.getField(f.name), f.dataType) for f in dtype)
        text = F.concat(F.lit("["), key, F.lit(", "), value, F.lit("]"))
    elif isinstance(dtype, T.StructType):
        text = json_object({f.name: (col.getField(f.name), f.dataType) for f in dtype})
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(col, lambda item: json_value(item, dtype.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(dtype, T.MapType):
        text = json_value(F.map_entries(col), T.ArrayType(_Pair(dtype.keyType, dtype.valueType)))
    else:
        text = json_string(col.cast("string"))
    return F.when(col.isNotNull(), text).otherwise("null")


def json_object(fields: dict[str, tuple[Column, T.DataType]]) -> Column:
    if not fields:
        return F.lit("{}")
    parts = []
    for i, (name, (col, dtype)) in enumerate(fields.items()):
        parts += [F.lit((", " if i else "{") + json.dumps(name) + ": "), json_value(col, dtype)]
    return F.concat(*parts, F.lit("}"))


def payload_json(df: DataFrame, include: Collection[str] | None = None) -> Column:
    """The chosen columns of `df` as one JSON object, in column order; none chosen gives `{}`."""
    names = df.columns if include is None else included(df.columns, include)
    return json_object({name: (F.col(f"`{name}`"), df.schema[name].dataType) for name in names})


def prompt_messages(prompt: str, payload: Column) -> Column:
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", F.lit(prompt)), message("user", payload))
