"""Types of a table that grow with the batches merged into it.

Columns and the fields of structs, also of structs in arrays and maps, go together by
name, whatever their order. A type is widened to hold what either side has and is never
narrowed; values that do not fit become null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from sluicework.operators.schema import column

# Digits of the whole numbers, from the narrowest up, and of a decimal.
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}
_MOST_DIGITS = 38


def widened_type(ours: DataType, theirs: DataType) -> DataType:
    """The narrowest type that holds both; ``ours`` where there is none."""
    if ours == theirs or isinstance(theirs, NullType):
        return ours
    if isinstance(ours, NullType):
        return theirs
    if isinstance(ours, StructType) and isinstance(theirs, StructType):
        return _merged_struct(ours, theirs)
    if isinstance(ours, ArrayType) and isinstance(theirs, ArrayType):
        element = widened_type(ours.elementType, theirs.elementType)
        return ArrayType(element, ours.containsNull or theirs.containsNull)
    if isinstance(ours, MapType) and isinstance(theirs, MapType):
        value = widened_type(ours.valueType, theirs.valueType)
        nullable = ours.valueContainsNull or theirs.valueContainsNull
        return MapType(widened_type(ours.keyType, theirs.keyType), value, nullable)
    return _wider_value(ours, theirs)


def _wider_value(ours: DataType, theirs: DataType) -> DataType:
    if ours in _DIGITS and theirs in _DIGITS:
        return max(ours, theirs, key=_DIGITS.__getitem__)
    kinds = {type(ours), type(theirs)}
    if kinds <= {DecimalType, *map(type, _DIGITS)}:
        sizes = [(k.precision - k.scale, k.scale) if isinstance(k, DecimalType) else (_DIGITS[k], 0) for k in (ours, theirs)]
        whole, scale = (max(part) for part in zip(*sizes, strict=True))
        return DecimalType(whole + scale, scale) if whole + scale <= _MOST_DIGITS else DoubleType()
    if kinds <= {DecimalType, FloatType, DoubleType, *map(type, _DIGITS)}:
        return DoubleType()
    if kinds <= {DateType, TimestampNTZType} or kinds <= {DateType, TimestampType}:
        return next(k for k in (ours, theirs) if not isinstance(k, DateType))
    return ours


def _merged_struct(ours: StructType, theirs: StructType) -> StructType:
    named = {f.name.lower(): f for f in theirs.fields}
    fields = []
    for field in ours.fields:
        other = named.pop(field.name.lower(), None)
        kind = widened_type(field.dataType, other.dataType) if other else field.dataType
        fields.append(StructField(field.name, kind, True, field.metadata))
    return StructType(fields + [StructField(f.name, f.dataType, True, f.metadata) for f in named.values()])


def same_shape(a: DataType, b: DataType) -> bool:
    """Whether types differ in nothing but what may be null."""
    return a.simpleString() == b.simpleString()


def adds_fields(ours: DataType, theirs: DataType) -> bool:
    """Whether a struct anywhere in ``theirs`` has a field that ``ours`` lacks."""
    if isinstance(ours, StructType) and isinstance(theirs, StructType):
        named = {f.name.lower(): f.dataType for f in ours.fields}
        return any(
            f.name.lower() not in named or adds_fields(named[f.name.lower()], f.dataType) for f in theirs.fields
        )
    if isinstance(ours, ArrayType) and isinstance(theirs, ArrayType):
        return adds_fields(ours.elementType, theirs.elementType)
    if isinstance(ours, MapType) and isinstance(theirs, MapType):
        return adds_fields(ours.valueType, theirs.valueType)
    return False


def conformed(value: Column, kind: DataType, wanted: DataType, stored: Column | None = None) -> Column:
    """``value`` of type ``kind`` as one of type ``wanted``, fields by name.

    Fields that ``kind`` lacks are those of ``stored``, which has the type ``wanted``; null
    where there is none, and in elements of arrays and maps.
    """
    if same_shape(kind, wanted):
        return value
    if isinstance(kind, StructType) and isinstance(wanted, StructType):
        named = {f.name.lower(): f for f in kind.fields}
        fields = []
        for field in wanted.fields:
            old = stored.getField(field.name) if stored is not None else None
            own = named.get(field.name.lower())
            if own is not None:
                new = conformed(value.getField(own.name), own.dataType, field.dataType, old)
            else:
                new = old if old is not None else F.lit(None).cast(field.dataType)
            fields.append(new.alias(field.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, ArrayType) and isinstance(wanted, ArrayType):
        return F.transform(value, lambda x: conformed(x, kind.elementType, wanted.elementType))
    if isinstance(kind, MapType) and isinstance(wanted, MapType):
        if not same_shape(kind.keyType, wanted.keyType):
            value = F.transform_keys(value, lambda k, _: conformed(k, kind.keyType, wanted.keyType))
        return F.transform_values(value, lambda _, v: conformed(v, kind.valueType, wanted.valueType))
    if isinstance(kind, NullType):
        return F.lit(None).cast(wanted)
    nested = (StructType, ArrayType, MapType)
    if isinstance(wanted, nested) or isinstance(kind, nested):
        # Text is the one plain type that holds a nested value; any other is null.
        return F.to_json(value) if wanted.typeName() == "string" else F.lit(None).cast(wanted)
    return value.try_cast(wanted)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The rows in the columns and types of ``schema``, null where they have none."""
    own = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        found = own.get(field.name.lower())
        value = conformed(column(found.name), found.dataType, field.dataType) if found else F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)
