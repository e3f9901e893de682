"""Small frames from dictionaries, with every column nullable whatever the schema declares."""

from pyspark.sql.types import StructField, StructType


def frame(spark, schema, rows, extra=""):
    fields = [StructField(f.name, f.dataType) for f in schema]
    if extra:
        fields += list(StructType.fromDDL(extra))
    names = [f.name for f in fields]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], StructType(fields))
