"""Type rules for reading from and writing to keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)
_TIME = (T.DateType, T.TimestampType, T.TimestampNTZType)
_TEXT = (T.StringType, T.CharType, T.VarcharType)
_COLLECTION = (T.ArrayType, T.MapType)

# Result type of each select-list function.
FUNCTION_TYPES: dict[str, T.DataType] = {
    "token": T.LongType(),
    "count": T.LongType(),
    "writetime": T.LongType(),
    "ttl": T.IntegerType(),
    "dateof": T.TimestampType(),
    "unixtimestampof": T.LongType(),
}


def quoted(name: str) -> str:
    """Column reference text that survives dots and backticks in ``name``."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of the frames has it in any case."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name in taken:
        name += "_"
    return name


def is_collection(dtype: T.DataType) -> bool:
    return isinstance(dtype, _COLLECTION)


def read_value(c: Column, dtype: T.DataType) -> Column:
    """The value a reader hands on: widened numbers, instants in milliseconds, text for structs."""
    if isinstance(dtype, _WHOLE):
        return c.cast("bigint")
    if isinstance(dtype, _REAL):
        return c.cast("double")
    if isinstance(dtype, _TIME):
        return F.date_trunc("millisecond", c.cast("timestamp"))
    if isinstance(dtype, T.StructType):
        return F.to_json(c)
    return c


def normalize_types(df: DataFrame) -> DataFrame:
    """Widen every column to its reader type; collections stay whole for unwinding."""
    return df.select(*[read_value(col(f.name), f.dataType).alias(f.name) for f in df.schema])


def storage_type(dtype: T.DataType) -> T.DataType:
    """Column type a table gets when it is created or widened from an input of ``dtype``."""
    if isinstance(dtype, (*_COLLECTION, T.StructType)):
        raise TypeError(f"collections cannot be written: {dtype.simpleString()}")
    if isinstance(dtype, _TEXT):
        return T.StringType()
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(38, 18)
    if isinstance(dtype, T.BooleanType):
        return T.BooleanType()
    if isinstance(dtype, _WHOLE):
        return T.LongType()
    if isinstance(dtype, _REAL):
        return T.DoubleType()
    if isinstance(dtype, _TIME):
        return T.TimestampType()
    return T.BinaryType()


_BLANK = r"[\s\p{Cntrl}]*"
_WHOLE_TEXT = f"^{_BLANK}[+-]?[0-9]+{_BLANK}$"
_REAL_TEXT = f"^{_BLANK}[+-]?([0-9.]|(?i:inf)|(?i:nan))"
_FLAG_TEXT = f"(?i)^{_BLANK}(t|true|y|yes|1|f|false|n|no|0){_BLANK}$"


def parse_text(c: Column, target: T.DataType) -> Column:
    """Text as a number or boolean, null where it is none.

    ``try_cast`` alone raises and catches an exception for each bad value,
    which is about a hundred times slower than a good one; a pattern that all
    good values match turns the bad ones away first.
    """
    if isinstance(target, _WHOLE):
        pattern = _WHOLE_TEXT
    elif isinstance(target, (*_REAL, T.DecimalType)):
        pattern = _REAL_TEXT
    elif isinstance(target, T.BooleanType):
        pattern = _FLAG_TEXT
    else:
        return c.try_cast(target)
    return F.when(F.rlike(c, F.lit(pattern)), c.try_cast(target))


def _same_back(c: Column, dtype: T.DataType, target: T.DataType) -> Column:
    """``c`` as ``target`` where casting back gives ``c`` again."""
    made = c.try_cast(target)
    return F.when(made.try_cast(dtype) == c, made)


def storage_value(c: Column, dtype: T.DataType, target: T.DataType) -> Column:
    """``c`` as ``target``; null where it does not fit.

    Whole numbers fit by range; numbers given as another kind fit if nothing is
    lost, but a double may lose digits in a float while it stays finite, and
    fractions may lose digits in a decimal. Text fits if it reads as the
    target, everything fits text and bytes, instants become UTC days for
    ``date``. No other pair of types fits.
    """
    number = (*_WHOLE, *_REAL, T.DecimalType)
    if type(dtype) is type(target) and not isinstance(target, T.DecimalType):
        return c
    if isinstance(target, T.BinaryType):
        return c.cast("string").cast("binary") if not isinstance(dtype, T.BinaryType) else c
    if isinstance(dtype, _TEXT):
        return parse_text(c, target)
    if isinstance(target, _TEXT):
        return c.try_cast(target)
    if isinstance(dtype, number) and isinstance(target, number):
        if isinstance(target, T.FloatType) and isinstance(dtype, T.DoubleType):
            made = c.try_cast(target)
            endless = F.abs(made) == F.lit(float("inf"))
            return F.when(~endless | (F.abs(c) == F.lit(float("inf"))), made)
        if isinstance(target, _WHOLE) and isinstance(dtype, _WHOLE):
            return c.try_cast(target)
        if isinstance(target, _WHOLE) or isinstance(dtype, _WHOLE):
            return _same_back(c, dtype, target)
        return c.try_cast(target)
    if isinstance(dtype, _TIME) and isinstance(target, _TIME):
        return c.try_cast(target)
    if isinstance(dtype, (*_COLLECTION, T.StructType)) and type(dtype) is type(target):
        return c.try_cast(target)
    return F.lit(None).cast(target)


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A hash of the row (bigint); values that hold maps go by their text."""
    names = df.columns if columns is None else columns
    parts = [F.to_json(col(c)) if _holds_map(df.schema[c].dataType) else col(c) for c in names]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype)
    return isinstance(dtype, T.MapType)
