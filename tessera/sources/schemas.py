"""Record schemas (explicit, checked on read)."""

from pyspark.sql import types as T

STORY = T.StructType([
    T.StructField("author", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("average_views", T.DoubleType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("warnings", T.ArrayType(T.StringType())),
    T.StructField("chapter_title", T.StringType()),
])

CORPUS = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("format", T.StringType()),
    T.StructField("token_length", T.IntegerType()),
])

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])

CONVERSATION = T.StructType([
    T.StructField("messages", T.ArrayType(MESSAGE)),
])

CLEAN_SAMPLE = T.StructType([
    T.StructField("input_ids", T.ArrayType(T.IntegerType())),
    T.StructField("length", T.IntegerType()),
    T.StructField("author", T.StringType()),
    T.StructField("split", T.StringType()),
])

AUTHOR_STATS = T.StructType([
    T.StructField("author", T.StringType()),
    T.StructField("total", T.LongType()),
    T.StructField("bad", T.LongType()),
    T.StructField("skipped", T.LongType()),
])


def check_columns(df, schema: T.StructType):
    """Fail early when a required column is missing or has another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in have:
            raise ValueError(f"missing column {f.name!r}")
        if have[f.name] != f.dataType:
            raise TypeError(f"column {f.name!r} is {have[f.name].simpleString()}, "
                            f"expected {f.dataType.simpleString()}")
    return df
