"""Schema evolution of catalog tables.

A write may bring new columns, leave out old ones, or change a type to one that
both can be read as.  The table's schema becomes the union of both: old columns
stay (null in the new rows), new ones come at the end (null in the old rows),
a type widens to the smallest one that holds both without loss.  Structs are
merged field by field, also inside arrays and maps.  Types without a common one
raise ``TypeError`` before anything is written.

New top-level columns only change the catalog entry; old files are not touched.
A type that widens or a struct that grows makes a new version of the table, staged
in the shared folder first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurewright.session import remove_path, scratch_path
from featurewright.sources.sinks import overwrite_table, table_exists, table_partitions

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
#: Decimal digits that hold every value of a whole-number type.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def merged_type(old: T.DataType, new: T.DataType, path: str) -> T.DataType:
    """The smallest type that holds both; ``path`` names the column in errors."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged_schema(old, new, path + ".")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged_type(old.elementType, new.elementType, path + ".element"), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(merged_type(old.keyType, new.keyType, path + ".key"), merged_type(old.valueType, new.valueType, path + ".value"), True)
    for a, b in ((old, new), (new, old)):
        if a in _WHOLE and b in _WHOLE:
            return max(a, b, key=_WHOLE.index)
        if isinstance(a, (T.FloatType, T.DoubleType)) and (isinstance(b, (T.FloatType, T.DoubleType)) or b in _WHOLE[:3]):
            # a float holds whole numbers up to 24 bits
            return T.FloatType() if isinstance(a, T.FloatType) and b in _WHOLE[:2] else T.DoubleType()
        if isinstance(a, T.DecimalType) and (isinstance(b, T.DecimalType) or b in _WHOLE):
            whole, scale = (b.precision - b.scale, b.scale) if isinstance(b, T.DecimalType) else (_DIGITS[b.simpleString()], 0)
            whole, scale = max(whole, a.precision - a.scale), max(scale, a.scale)
            if whole + scale <= 38:
                return T.DecimalType(whole + scale, scale)
        if isinstance(a, T.DateType) and isinstance(b, T.TimestampNTZType):
            return b
    raise TypeError(f"column {path}: {old.simpleString()} and {new.simpleString()} have no common type")


def merged_schema(old: T.StructType, new: T.StructType, path: str = "") -> T.StructType:
    """Union of the fields (names compared without case), old ones first."""
    by_name = {f.name.lower(): f for f in new.fields}
    if len(by_name) < len(new.fields):
        raise TypeError(f"{path or 'schema'}: column names that differ in case only")
    out = []
    for f in old.fields:
        other = by_name.pop(f.name.lower(), None)
        out.append(T.StructField(f.name, merged_type(f.dataType, other.dataType, path + f.name) if other else f.dataType, True, f.metadata))
    return T.StructType([*out, *(T.StructField(f.name, f.dataType, True, f.metadata) for f in by_name.values())])


def _fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as the wider type; a null stays null."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        mine = {f.name.lower(): f for f in have.fields}
        fields = [(_fitted(value.getField(mine[f.name.lower()].name), mine[f.name.lower()].dataType, f.dataType) if f.name.lower() in mine
                   else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: _fitted(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        keyed = F.transform_keys(value, lambda k, _: _fitted(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda _, v: _fitted(v, have.valueType, want.valueType))
    return value.cast(want)


def evolved(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the merged schema: columns cast, reordered, and null where it has none."""
    mine = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        own = mine.get(f.name.lower())
        value = _fitted(F.col("`" + own.name.replace("`", "``") + "`"), own.dataType, f.dataType) if own else F.lit(None)
        cols.append(value.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _plain(t: T.DataType) -> T.DataType:
    """The type with everything nullable, as tables store it."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_plain(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(_plain(t.keyType), _plain(t.valueType), True)
    return t


def write_evolving(spark: SparkSession, name: str, df: DataFrame, mode: str = "append", partition_by: tuple[str, ...] = ()) -> T.StructType:
    """Append to, or overwrite the rows of, a table whose schema grows with the frame's; returns the table's schema.

    A missing table is created (``partition_by`` counts then; later writes keep the
    table's own partitioning).
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode {mode}: append or overwrite")
    if not table_exists(spark, name):
        overwrite_table(evolved(df, _plain(df.schema)), name, partition_by)
        return spark.table(name).schema
    old = _plain(spark.table(name).schema)
    schema = merged_schema(old, _plain(df.schema))
    parts = table_partitions(spark, name)
    kept = len(old.fields)
    if mode == "append" and schema.fields[:kept] == old.fields:
        if new := schema.fields[kept:]:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
        evolved(df, schema).select(*spark.table(name).columns).write.insertInto(name)
        return spark.table(name).schema
    rows = evolved(df, schema)
    if mode == "append":
        rows = evolved(spark.table(name), schema).unionByName(rows)
    path = scratch_path(spark, "evolved")
    try:
        rows.write.parquet(path)
        overwrite_table(spark.read.schema(rows.schema).parquet(path), name, parts)
    finally:
        remove_path(spark, path)
    return spark.table(name).schema
