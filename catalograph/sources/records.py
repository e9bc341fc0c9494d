"""JSON record files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.schema import STRINGS


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(target)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


CORRUPT = "_corrupt_record"
# What a JSON value must be to count as a value of a field's type.
_JSON_KINDS = {T.IntegerType: "^BIGINT$", T.LongType: "^BIGINT$", T.DoubleType: "^(BIGINT|DOUBLE|DECIMAL.*)$",
               T.BooleanType: "^BOOLEAN$", T.ArrayType: "^ARRAY<", T.StructType: "^OBJECT<"}


def _typed(field: T.StructField) -> Column:
    """A field read as any JSON value: null where it is of another type, one text where a list of texts
    is due as a list of one."""
    name, kind = f"`{field.name}`", field.dataType
    if isinstance(kind, T.StringType):
        return F.col(name)
    given = F.schema_of_variant(name)
    value = F.when(given.rlike(_JSON_KINDS[type(kind)]), F.try_variant_get(name, "$", kind.simpleString()))
    if kind == STRINGS:
        value = value.when(given == "STRING", F.array(F.try_variant_get(name, "$", "string")))
    return value.alias(field.name)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of files that each hold one JSON array; a missing or unreadable file gives none.

    A field of another type than the schema's is null, and every record stays, even one without any readable
    field: fields are read as whatever value they hold, so only a file that is no JSON counts as corrupt.
    """
    if not path_exists(spark, path):
        return empty(spark, schema)
    fields = [f if isinstance(f.dataType, T.StringType) else T.StructField(f.name, T.VariantType()) for f in schema.fields]
    rows = (spark.read.schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())]))
            .option("multiLine", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    # an unreadable file is one row of nulls; the first field is named as Spark refuses to read CORRUPT alone
    readable = F.col(CORRUPT).isNull() | F.col(f"`{schema.fields[0].name}`").isNotNull()
    return rows.where(readable).select(*[_typed(f) for f in schema.fields])


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records written one per line, the splittable form that ``write_items`` produces."""
    return spark.read.schema(schema).json(path) if path_exists(spark, path) else empty(spark, schema)


def write_items(df: DataFrame, path: str, form: str = "json") -> bool:
    """Write the collection, creating folders; nothing is written for an empty one."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").format(form).save(path)
    return True
