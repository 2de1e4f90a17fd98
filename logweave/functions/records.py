"""Typed JSON records: strict decoding with rejects, and encoding.

``from_json`` alone is lenient: it turns a number or object into text and reads
numbers as timestamps.  Here instants are parsed from their text, text fields
are checked to hold text, and missing fields get empty values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)

from logweave.functions.text import col
from logweave.functions.times import parse_instant

POLICIES = ("fail", "skip", "quarantine", "raw")
BAD = "__not_json"
_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def _with_leaves(kind: DataType, text: DataType, instant: DataType) -> DataType:
    """The type with other types for its text and instant leaves."""
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, TimestampType):
        return instant
    if isinstance(kind, ArrayType):
        return ArrayType(_with_leaves(kind.elementType, text, instant))
    if isinstance(kind, MapType):
        return MapType(StringType(), _with_leaves(kind.valueType, text, instant))
    if isinstance(kind, StructType):
        return StructType(
            [StructField(f.name, _with_leaves(f.dataType, text, instant)) for f in kind.fields]
        )
    return kind


def _has(kind: DataType, *leaves: type) -> bool:
    if isinstance(kind, ArrayType):
        return _has(kind.elementType, *leaves)
    if isinstance(kind, MapType):
        return _has(kind.valueType, *leaves)
    if isinstance(kind, StructType):
        return any(_has(f.dataType, *leaves) for f in kind.fields)
    return isinstance(kind, leaves)


def _any(value: Column, kind: DataType, leaf: type, test) -> Column:
    """True when ``test`` holds for some leaf of the given type."""
    no = F.lit(False)
    if not _has(kind, leaf):
        return no
    if isinstance(kind, ArrayType):
        return F.coalesce(F.exists(value, lambda v: _any(v, kind.elementType, leaf, test)), no)
    if isinstance(kind, MapType):
        values = F.map_values(value)
        return F.coalesce(F.exists(values, lambda v: _any(v, kind.valueType, leaf, test)), no)
    if isinstance(kind, StructType):
        result = no
        for field in kind.fields:
            if _has(field.dataType, leaf):
                result = result | _any(value[field.name], field.dataType, leaf, test)
        return result
    return F.coalesce(test(value), no)


_TEXT = r'(?:"(?:[^"\\]++|\\.)*+"|null)'


def _tail(kind: DataType) -> str | None:
    """What may follow the name of a text field or of a list or map of texts."""
    if isinstance(kind, StringType):
        return '["n]'
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StringType):
        return rf"(?:null|\[\s*+(?:{_TEXT}\s*+(?:,\s*+{_TEXT}\s*+)*+)?+\])"
    if isinstance(kind, MapType) and isinstance(kind.valueType, StringType):
        pair = rf"{_TEXT}\s*+:\s*+{_TEXT}\s*+"
        return rf"(?:null|\{{\s*+(?:{pair}(?:,\s*+{pair})*+)?+\}})"
    return None


def _suspicion(schema: StructType) -> str:
    """A pattern found in every record that has another JSON type in a text field.

    It looks at field names followed by something else than text, wherever they
    stand; names spelled with escapes are for the caller to suspect.
    """
    tails: dict[str, set[str]] = {}

    def visit(kind: DataType) -> None:
        if isinstance(kind, StructType):
            for field in kind.fields:
                tail = _tail(field.dataType)
                if tail:
                    tails.setdefault(tail, set()).add(field.name)
                else:
                    visit(field.dataType)
        elif isinstance(kind, ArrayType):
            visit(kind.elementType)
        elif isinstance(kind, MapType):
            visit(kind.valueType)

    visit(schema)
    fields = "|".join(
        rf'(?:{"|".join(sorted(names))})"\s*+:\s*+(?!{tail})' for tail, names in sorted(tails.items())
    )
    return rf'"(?:{fields})'


def _text_of_another_type(text: Column, schema: StructType) -> Column:
    """Is some text field of the record a number, a flag, a list or an object?

    Parses text leaves as variants, which keep their JSON type.
    """
    shape = _with_leaves(schema, VariantType(), VariantType())

    def other(leaf: Column) -> Column:
        return ~F.schema_of_variant(leaf).isin("STRING", "VOID")

    parsed = F.array(F.from_json(text, shape, _OPTIONS))
    found = F.transform(
        parsed,
        lambda p: _any(p, schema, StringType, other) | _any(p, schema, TimestampType, other),
    )
    return F.coalesce(F.get(found, F.lit(0)), F.lit(False))


def _built(value: Column, kind: DataType, fill: bool) -> Column:
    """The declared value out of the parsed one; ``fill`` replaces missing scalars."""
    if isinstance(kind, TimestampType):
        return parse_instant(value)
    if isinstance(kind, (ArrayType, MapType)):
        inner = kind.elementType if isinstance(kind, ArrayType) else kind.valueType
        if not (_has(inner, TimestampType) or (fill and isinstance(inner, StructType))):
            return value
        if isinstance(kind, ArrayType):
            return F.transform(value, lambda v: _built(v, inner, fill))
        return F.transform_values(value, lambda _, v: _built(v, inner, fill))
    if isinstance(kind, StructType):
        return F.struct(
            *[_built(value[f.name], f.dataType, fill).alias(f.name) for f in kind.fields]
        )
    zero = F.lit("") if isinstance(kind, StringType) else F.lit(0).cast(kind)
    return F.coalesce(value, zero) if fill else value


def decode(
    df: DataFrame,
    schema: StructType,
    value: str = "value",
    out: str = "record",
    fill: bool = True,
    strict: bool = True,
) -> DataFrame:
    """Add ``out`` (struct, null when bad) and ``reject_reason`` (null when good).

    One lenient parse serves sound records.  ``strict`` adds a search for text
    fields that hold something else, and only what it finds is parsed again.
    """
    text = col(value).cast("string")
    shape = _with_leaves(schema, StringType(), StringType())
    shape = StructType([*shape.fields, StructField(BAD, StringType())])
    parsed = df.withColumn("__parsed", F.from_json(text, shape, _OPTIONS))
    p = F.col("__parsed")

    def unreadable(instant: Column) -> Column:
        return instant.isNotNull() & parse_instant(instant).isNull()

    wrong = _any(p, schema, TimestampType, unreadable)
    if strict:
        escaped = F.contains(text, F.lit("\\u00"))
        suspicious = escaped | F.rlike(text, F.lit(_suspicion(schema)))
        wrong = F.when(suspicious & _text_of_another_type(text, schema), F.lit(True)).otherwise(wrong)
    reason = (
        F.when(col(value).isNull(), F.lit("no value"))
        .when(
            p.isNull() | p[BAD].isNotNull(), F.lit("not a JSON record of the declared types")
        )
        .when(wrong, F.lit("field of another JSON type than declared"))
    )
    return (
        parsed.withColumn("reject_reason", reason)
        .withColumn(out, F.when(F.col("reject_reason").isNull(), _built(p, schema, fill)))
        .drop("__parsed")
    )


def apply_policy(df: DataFrame, on_error: str, value: str = "value", out: str = "record"):
    """What happens to rejected rows of :func:`decode`.

    fail: the job stops with the reason; skip: they are left out; raw: they stay,
    with their text and reason; quarantine: a pair (good rows, rejected rows).
    """
    if on_error not in POLICIES:
        raise ValueError(f"on_error must be one of {POLICIES}")
    good = df.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    if on_error == "skip":
        return good
    if on_error == "raw":
        return df
    if on_error == "quarantine":
        return good, df.filter(F.col("reject_reason").isNotNull()).drop(out)
    text = F.substring(col(value).cast("string"), 1, 200)
    stop = F.raise_error(F.concat(F.col("reject_reason"), F.lit(": "), F.coalesce(text, F.lit(""))))
    sound = F.when(F.col("reject_reason").isNull(), F.lit(True)).otherwise(stop.cast("boolean"))
    return df.filter(sound).drop("reject_reason")


def encode(*columns: Column | str, omit_empty: tuple[str, ...] = ()) -> Column:
    """Columns as one JSON record; ``omit_empty`` fields vanish when empty."""
    parts = []
    for c in columns:
        if isinstance(c, str) and c in omit_empty:
            parts.append(F.nullif(F.col(c), F.lit("")).alias(c))
        else:
            parts.append(col(c))
    return F.to_json(F.struct(*parts))


_TOKEN = r'("(?:[^"\\]|\\.)*"|[\[\]{}:,]|[^\s\[\]{}:,"]+)'
_MOST_TOKENS_BITS = 30


def _once(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _places(tokens: Column, *wanted: str) -> Column:
    """Where in ``tokens`` the wanted ones are, ascending."""
    found = F.transform(tokens, lambda t, i: F.when(t.isin(*wanted), i))
    return F.array_compact(found)


def _before(places: Column, at: Column) -> Column:
    """How many of ascending ``places`` are less than ``at``, by binary search."""
    steps = F.array(*(F.lit(1 << k) for k in range(_MOST_TOKENS_BITS, -1, -1)))
    return F.aggregate(
        steps, F.lit(0), lambda n, step: F.when(F.get(places, n + step - 1) < at, n + step).otherwise(n)
    )


def pretty(value: Column | str) -> Column:
    """Any JSON text indented by two, null when it is not JSON.

    Keys keep their order and numbers their digits: the text's own tokens are set
    apart, each after as many spaces as there are brackets open before it.
    """
    text = col(value)

    def indented(tokens: Column) -> Column:
        def joined(opened: Column, closed: Column) -> Column:
            def piece(t: Column, i: Column) -> Column:
                depth = _before(opened, i) - _before(closed, i)
                last = F.get(tokens, i - 1)
                first_inside = F.coalesce((i > 0) & last.isin("{", "["), F.lit(False))

                def line(n: Column) -> Column:
                    return F.concat(F.lit("\n"), F.repeat(F.lit("  "), n))

                return (
                    F.when(t.isin("}", "]"), F.when(first_inside, t).otherwise(F.concat(line(depth - 1), t)))
                    .when(t == ",", F.concat(t, line(depth)))
                    .when(t == ":", F.lit(": "))
                    .when(first_inside, F.concat(line(depth), t))
                    .otherwise(t)
                )

            return F.array_join(F.transform(tokens, piece), "")

        return _once(_places(tokens, "{", "["), lambda o: _once(_places(tokens, "}", "]"), lambda c: joined(o, c)))

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(1))
    return F.when(F.try_parse_json(text).isNotNull(), _once(tokens, indented))


def pretty_record(record: Column | str) -> Column:
    """A typed record as indented JSON, without leaving the JVM."""
    return F.to_json(col(record), {"pretty": "true"})
