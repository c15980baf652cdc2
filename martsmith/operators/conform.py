"""Conform a query result to a target schema (the implicit coercion of a keyed insert).

Per target column, in table order and bound by name:

1. NaN -> NULL on floating point inputs;
2. type conversion with the ``try_`` family (ANSI mode is on, dirty text must
   not fail the job): strings cut to VARCHAR(n), numbers clamped to the range
   of the target type *before* the cast (so the cast cannot overflow) and
   rounded to its scale, text parsed as number/date/timestamp;
3. NOT NULL columns get the implicit default of their type (0, '') - after
   the conversion, because an unparsable value in a NOT NULL column also
   becomes the default.

Numeric text is rounded once, to the target's scale, and clamped however many
digits it has. Other text gives NULL (``on_bad_cast="null"``) or the number it
begins with, 0 if there is none (``on_bad_cast="zero"``, the server's behaviour
under IGNORE: ``'12abc'`` is 12). Dates and timestamps need a full date. Columns the
query does not deliver are NULL. Each changed cell is counted in an optional
``coerced`` metric column.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martsmith.schemas import VARCHAR_META, TargetSpec

COERCED_COL, REJECTED_COL = "__coerced_cells", "__rejected"

_INT_RANGES = {
    "tinyint": (-(2**7), 2**7 - 1),
    "int": (-(2**31), 2**31 - 1),
    "bigint": (-(2**63), 2**63 - 1),
}

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _int_range(dt: T.DataType) -> tuple[int, int]:
    return _INT_RANGES[{T.ByteType: "tinyint", T.IntegerType: "int", T.LongType: "bigint"}[type(dt)]]


def _decimal_bound(dt: T.DecimalType) -> Decimal:
    return Decimal(10) ** (dt.precision - dt.scale) - Decimal(1).scaleb(-dt.scale)


def _default_value(dt: T.DataType):
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, _NUMERIC):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    return None  # dates/timestamps: no value Spark can hold for a zero date


NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
FULL_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:[ T].*)?$"


def _text_number(text: Column, scale: int, high: Column) -> Column:
    """Numeric text as a decimal of ``scale``, rounded once; what has too many digits
    before the point becomes ``high`` or its negative (as doubles tell the sign); else NULL."""
    rough = F.when(text.rlike(f"^{NUMBER}$"), text.try_cast("double"))
    exact = F.when(rough.isNotNull(), text.try_cast(T.DecimalType(38, scale)))
    return F.coalesce(exact, F.when(rough > 0, high).when(rough < 0, -high).when(rough == 0, F.lit(0)).cast(T.DecimalType(38, scale)))


def convert(src: Column, src_type: T.DataType, field: T.StructField,
            on_bad_cast: str = "null", want_flag: bool = True) -> tuple[Column, Column | None]:
    """Return (converted value, changed flag) for one column; the flag is None when
    ``want_flag`` is false (building expressions is a driver-side cost)."""
    value, changed = _convert(src, src_type, field, on_bad_cast, want_flag)
    return value, (F.coalesce(changed, F.lit(False)) if want_flag else None)


def _convert(src: Column, src_type: T.DataType, field: T.StructField,
             on_bad_cast: str, want_flag: bool) -> tuple[Column, Column]:
    dt = field.dataType
    changed = F.lit(False)

    if isinstance(src_type, (T.DoubleType, T.FloatType)):
        src = F.when(~F.isnan(src), src)

    if isinstance(dt, T.StringType):
        value = src if isinstance(src_type, T.StringType) else src.cast("string")
        n = field.metadata.get(VARCHAR_META)
        if n:
            if want_flag:
                changed = F.length(value) > F.lit(n)
            value = F.substring(value, 1, n)
        return value, changed

    if isinstance(dt, (T.ByteType, T.IntegerType, T.LongType, T.DecimalType)):
        if isinstance(dt, T.DecimalType):
            scale, hi = dt.scale, _decimal_bound(dt)
            lo = -hi
        else:
            scale, (lo, hi) = 0, _int_range(dt)
        lo_lit, hi_lit = F.lit(lo), F.lit(hi)
        failed = None
        if isinstance(src_type, T.StringType):
            text = F.trim(src)
            if on_bad_cast == "zero":
                failed = src.isNotNull() & ~text.rlike(f"^{NUMBER}$")
                text = F.when(failed, F.regexp_extract(text, f"^{NUMBER}", 0)).otherwise(text)
                text = F.when(text == "", F.lit("0")).otherwise(text)
            num = _text_number(text, scale, F.lit(Decimal(hi) + 1))
        elif isinstance(src_type, T.BooleanType):
            num = src.cast("int")
        elif isinstance(src_type, _NUMERIC):
            num = src
        else:
            num = src.try_cast(T.DecimalType(38, 10))
        if failed is None and want_flag:
            failed = src.isNotNull() & num.isNull()
        if not isinstance(dt, T.DecimalType) and not isinstance(src_type, (T.StringType, *_INTEGRAL)):
            num = F.round(num, 0)
        if isinstance(src_type, (T.DoubleType, T.FloatType)):
            lo_lit, hi_lit = lo_lit.cast("double"), hi_lit.cast("double")
        value = F.when(num > hi_lit, hi_lit).when(num < lo_lit, lo_lit).otherwise(num).cast(dt)
        if want_flag:
            changed = failed | (num > hi_lit) | (num < lo_lit)
        return value, changed

    if isinstance(dt, T.DateType):
        if isinstance(src_type, T.StringType):
            value = F.when(F.trim(src).rlike(FULL_DATE), F.trim(src)).try_cast(T.DateType())
            if want_flag:
                changed = src.isNotNull() & value.isNull()
        else:
            value = src.cast(T.DateType())
        return value, changed

    if isinstance(dt, (T.TimestampNTZType, T.TimestampType)):
        if isinstance(src_type, T.StringType):
            value = F.when(F.trim(src).rlike(FULL_DATE), F.trim(src)).try_cast(dt)
            if want_flag:
                changed = src.isNotNull() & value.isNull()
        else:
            value = src.cast(dt)
        return value, changed

    return src.cast(dt), changed


def conform(
    df: DataFrame,
    target: TargetSpec,
    on_bad_cast: str = "null",
    keep: tuple[str, ...] = (),
    count_coerced: bool = False,
    tell: bool = False,
) -> DataFrame:
    """Project ``df`` onto the load columns of ``target`` with target types.

    ``keep`` names extra columns (e.g. captured arrival order) passed through
    unchanged after the target columns. With ``count_coerced`` a column
    ``__coerced_cells`` holds the number of changed or defaulted cells per row. With ``tell`` a column
    ``__rejected`` lists those cells (``rejected_cells`` makes a table of it): the column, the rule that changed it
    (``converted``: not a value of the type, or out of its range or length; ``defaulted``: NULL where the table takes none) and the
    source's value as text.
    """
    if on_bad_cast not in ("null", "zero"):
        raise ValueError("on_bad_cast must be 'null' or 'zero'")
    types = {f.name: f.dataType for f in df.schema.fields}
    out, flags, told = [], [], []
    for field in target.load_schema.fields:
        if field.name in types:
            value, changed = convert(F.col(f"`{field.name}`"), types[field.name], field, on_bad_cast,
                                     want_flag=count_coerced or tell)
        else:
            value, changed = F.lit(None).cast(field.dataType), None
        rule = F.when(changed, F.lit("converted")) if changed is not None else F.lit(None).cast("string")
        if field.name in target.not_null:
            default = _default_value(field.dataType)
            if default is not None:
                rule = F.when(value.isNull(), F.lit("defaulted")).otherwise(rule)
                if count_coerced:
                    changed = value.isNull() if changed is None else (changed | value.isNull())
                value = F.coalesce(value, default)
        out.append(value.alias(field.name))
        source = F.col(f"`{field.name}`").cast("string") if field.name in types else F.lit(None).cast("string")
        told.append(F.when(rule.isNotNull(), F.struct(F.lit(field.name).alias("column"), rule.alias("rule"), source.alias("value"))))
        if count_coerced and changed is not None:
            flags.append(F.when(changed, 1).otherwise(0))
    extra = [F.col(f"`{k}`") for k in keep]
    if count_coerced:
        total = F.lit(0)
        for f in flags:
            total = total + f
        extra.append(total.alias(COERCED_COL))
    if tell:
        extra.append(F.filter(F.array(*told), lambda x: x.isNotNull()).alias(REJECTED_COL))
    return df.select(*out, *extra)


def rejected_cells(stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key columns, column, rule, value): a row per cell that ``conform(..., tell=True)`` changed; ``stored`` is its result, written
    once, from which the load reads the rows and this table the cells."""
    return stored.where(F.size(REJECTED_COL) > 0).select(*[f"`{k}`" for k in key], F.explode(REJECTED_COL).alias("__cell")).select(
        *[f"`{k}`" for k in key], "__cell.column", "__cell.rule", "__cell.value")
