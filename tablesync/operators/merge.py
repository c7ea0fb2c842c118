"""Conditional overwrite and keyed upsert as frame formulas.

Both return the new content of the target rows they are given. Nothing here
writes; ``tablesync.sinks.table`` feeds them the touched partitions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.names import col, resolve
from tablesync.operators.keyfilter import KeyFilter, bits_for, key_words
from tablesync.operators.predicates import (
    COPIES,
    PartitionScope,
    checked,
    conjunction,
    distinct_keys,
    grouped_by_key,
    is_true,
    key_equality,
    merge_condition,
)

_IN_SCOPE = "__in_scope"

# Casts that keep every value, so an incoming column may take the target's type.
_WIDENING = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.NullType: (T.DataType,),
}


def _by_name(struct: T.StructType) -> dict[str, T.StructField]:
    """Fields by their names in lower case, which must differ."""
    found = {f.name.lower(): f for f in struct}
    if len(found) < len(struct):
        raise ValueError(f"field names clash: {struct.names}")
    return found


def _same(have: T.DataType, want: T.DataType) -> bool:
    # simpleString leaves nullability out at every level.
    return have.simpleString() == want.simpleString()


def _fits(have: T.DataType, want: T.DataType) -> bool:
    """Whether values can take a type without loss, but for struct fields it lacks."""
    if _same(have, want):
        return True
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = _by_name(have)
        return all(_fits(own[f.name.lower()].dataType, f.dataType) for f in want if f.name.lower() in own)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return _fits(have.elementType, want.elementType)
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return _same(have.keyType, want.keyType) and _fits(have.valueType, want.valueType)
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        whole_digits = want.precision - want.scale >= have.precision - have.scale
        return whole_digits and want.scale >= have.scale
    return isinstance(want, _WIDENING.get(type(have), ()))


def _merged(old: T.DataType, new: T.DataType) -> T.DataType:
    """``old`` with the struct fields that only ``new`` has behind its own, at every level.

    Reaches into structs, elements of arrays and values of maps; keys of maps stay.
    """
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return evolved_schema(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_merged(old.elementType, new.elementType))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(old.keyType, _merged(old.valueType, new.valueType))
    return old


def evolved_schema(target: T.StructType, incoming: T.StructType) -> T.StructType:
    """Target columns in order, then the incoming columns it lacks, all nullable; struct fields likewise."""
    known, arriving = _by_name(target), _by_name(incoming)
    fields = [
        T.StructField(f.name, _merged(f.dataType, arriving[f.name.lower()].dataType), True)
        if f.name.lower() in arriving
        else T.StructField(f.name, f.dataType, True)
        for f in target
    ]
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in incoming if f.name.lower() not in known])


def _absent(have: T.DataType, want: T.DataType, path: str = "") -> list[str]:
    """Dotted names of the fields of ``want`` that ``have`` lacks."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own, found = _by_name(have), []
        for f in want:
            name = f"{path}.{f.name}" if path else f.name
            source = own.get(f.name.lower())
            found += [name] if source is None else _absent(source.dataType, f.dataType, name)
        return found
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return _absent(have.elementType, want.elementType, f"{path}.element")
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return _absent(have.valueType, want.valueType, f"{path}.value")
    return []


def _shaped(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as ``want``: struct fields matched by name, missing ones null. A null stays null."""
    if _same(have, want):
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = _by_name(have)

        def field(f: T.StructField) -> Column:
            source = own.get(f.name.lower())
            if source is None:
                return F.lit(None).cast(f.dataType).alias(f.name)
            return _shaped(value.getField(source.name), source.dataType, f.dataType).alias(f.name)

        return F.when(value.isNotNull(), F.struct(*map(field, want)))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _shaped(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.transform_values(value, lambda _, x: _shaped(x, have.valueType, want.valueType))
    return value.cast(want)


def conform(df: DataFrame, schema: T.StructType, missing: str = "null") -> DataFrame:
    """Select ``schema`` from ``df`` by name; columns and struct fields it does not list are dropped.

    ``missing="null"`` fills absent columns and fields, ``missing="error"`` raises.
    """
    have = _by_name(df.schema)
    absent = _absent(df.schema, schema)
    if absent and missing == "error":
        raise ValueError(f"incoming data lacks target columns {absent}")
    clashing = [
        f.name
        for f in schema
        if f.name.lower() in have and not _fits(have[f.name.lower()].dataType, f.dataType)
    ]
    if clashing:
        raise ValueError(f"incoming columns do not fit the target types: {clashing}")

    def pick(field: T.StructField) -> Column:
        source = have.get(field.name.lower())
        if source is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        return _shaped(col(source.name), source.dataType, field.dataType).alias(field.name)

    return df.select([pick(f) for f in schema])


def append_rows(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Union all by name; a column either side lacks is null there."""
    schema = evolved_schema(target.schema, incoming.schema)
    return conform(target, schema).unionByName(conform(incoming, schema))


def check_incoming(incoming: DataFrame, where: Column | None, partition_col: str) -> DataFrame:
    """Incoming rows, failing the job on one outside the overwrite predicate.

    A row's own partition value is in scope unless it is null.
    """
    inside = conjunction(where, col(partition_col).isNotNull())
    return checked(incoming, inside, partition_col, "incoming row lies outside the overwrite predicate")


def replace_where(
    target: DataFrame, incoming: DataFrame, where: Column | None, scope: PartitionScope
) -> DataFrame:
    """Target rows for which ``where AND partition in scope`` is not true, plus all incoming rows."""
    tagged = scope.tag(target, _IN_SCOPE)
    replaced = is_true(conjunction(where, col(_IN_SCOPE)))
    kept = tagged.where(~replaced).drop(_IN_SCOPE)
    return append_rows(kept, check_incoming(incoming, where, scope.column))


def replace_touched(
    touched: DataFrame, incoming: DataFrame, where: Column | None, partition_col: str
) -> DataFrame:
    """``replace_where`` for target rows known to lie in scope: a filter and a union."""
    kept = touched.where(~is_true(conjunction(where)))
    return append_rows(kept, check_incoming(incoming, where, partition_col))


def source_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], n_rows: int) -> KeyFilter:
    """Filter by the keys of a source of ``n_rows`` rows, in the target's types."""
    wanted = T.StructType([target.schema[resolve(target, k)] for k in keys])
    bits = bits_for(n_rows)
    return KeyFilter(key_words(conform(source, wanted, missing="error"), wanted.names, bits), wanted.names, bits)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    scope: PartitionScope | None = None,
    key_filter: KeyFilter | None = None,
) -> DataFrame:
    """Update target rows that match a source row, keep the others, insert the rest.

    A match needs equal non-null keys and, given a scope, a target row inside
    it. A target row matched by several source rows fails the job.

    * Updates: the source is first aggregated per key (partial aggregation
      collapses repeated keys before the shuffle), so the join's right side has
      one row per key and only the target side can be skewed, which AQE splits
      for a left join.
    * Inserts: source rows anti-joined with the distinct target keys. Skew can
      only sit on the source side, which AQE splits for an anti join.

    Whether a side is broadcast is Spark's choice. If none is, the target's rows
    are shuffled once, and its keys twice; with a ``key_filter`` of the source's
    keys only those that may match, while the others pass from the scan.
    """
    schema = target.schema
    if key_filter is not None:
        merged_rows = upsert(key_filter.possible(target), source, keys, scope)
        return key_filter.impossible(target).unionByName(merged_rows)
    source = conform(source, schema, missing="error")
    keys = [resolve(target, k) for k in keys]
    others = [c for c in target.columns if c not in keys]
    in_scope = target
    flag = None
    if scope is not None:
        target = scope.tag(target, _IN_SCOPE)
        in_scope = target.where(col(_IN_SCOPE))
        flag = F.col(f"target.{_IN_SCOPE}")

    has_keys = conjunction(*[col(k).isNotNull() for k in keys])
    representative = [F.first(col(c)).alias(c) for c in others]
    per_key = grouped_by_key(source.where(has_keys), keys, *representative)
    copies = F.col(f"source.{COPIES}")

    def merged(field: T.StructField) -> Column:
        name = f"`{field.name}`"
        return (
            F.when(copies.isNull(), F.col(f"target.{name}"))
            .when(copies == 1, F.col(f"source.{name}"))
            .otherwise(F.raise_error("a target row matches more than one source row"))
            .alias(field.name)
        )

    updated = (
        target.alias("target")
        .join(per_key.alias("source"), merge_condition(keys, flag), "left")
        .select([merged(f) for f in schema])
    )

    target_keys = in_scope.select(*[col(k) for k in keys])
    inserted = source.alias("source").join(
        distinct_keys(target_keys, keys).alias("target"), key_equality(keys), "left_anti"
    )
    return updated.unionByName(inserted)
