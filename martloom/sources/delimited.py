"""Delimited files with a declared schema: reject handling, charsets, file names and record numbers."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.sources.charsets import decode_strings, normal_name, spark_charset
from martloom.sources.files import existing_paths

_BAD = "_bad_record"
_FILE = "_source_file"
_BLOCK = "_source_block"
_SEEN = "_seen"

_LINE = "_line"
_ROW = "_row"

# Stands for a cell without anything in it, so that quoted empty text stays apart from it.
_NOTHING = "\u0002 nothing \u0002"
# What layouts with `line_breaks="escape"` write in place of characters that a line cannot carry. The first of the two is
# itself escaped. Other layouts know nothing of it.
_ESCAPES = (
    ("\u001a", "\u001as"),
    ("\n", "\u001an"),
    ("\r", "\u001ar"),
    ("\u0000", "\u001a0"),
    ("\u0001", "\u001a1"),
    ("\u0002", "\u001a2"),
)


@dataclass(frozen=True)
class DelimitedFormat:
    """How a delimited file is laid out. The defaults are the reference's file format.

    ``line_breaks`` says what becomes of line breaks inside text cells. ``refuse``: a sink stops at one, a source takes
    every line as a record, so files are read in splits. ``quote``: they stand inside the quotes, as other tools write
    them; such a file is read by one task. ``escape``: signs that only this library undoes stand for them and for the
    control characters U+0000 to U+0002 and U+001A, and files stay splittable.
    """

    separator: str = ","
    header: bool = False
    charset: str = "UTF-8"
    date_format: str = "yyyy-MM-dd"
    line_separator: str | None = None
    line_breaks: str = "refuse"

    def __post_init__(self) -> None:
        if self.line_breaks not in ("refuse", "quote", "escape"):
            raise ValueError("line_breaks is 'refuse', 'quote' or 'escape'")

    def options(self) -> dict[str, str]:
        chosen = {
            "sep": self.separator,
            "quote": '"',
            "escape": '"',
            "header": str(self.header).lower(),
            "encoding": spark_charset(self.charset),
            "dateFormat": self.date_format,
            "columnNameOfCorruptRecord": _BAD,
            "nullValue": _NOTHING,
        }
        name = normal_name(self.charset)
        if name in ("utf-16", "utf-32"):
            # The byte order stands at the start of such a file only, so it is decoded as a whole, in one task. Files
            # that come in a named byte order are split like any other.
            chosen["multiLine"] = "true"
        elif name in ("utf-16-le", "utf-16-be"):
            chosen["lineSep"] = "\n"
        if self.line_breaks == "quote":
            chosen["multiLine"] = "true"
        if self.line_separator:
            chosen["lineSep"] = self.line_separator
        return chosen

    def with_header(self, header: bool = True) -> "DelimitedFormat":
        return replace(self, header=header)


def schema_from_file(spark: SparkSession, path: str) -> T.StructType:
    """A schema kept in a text file, as JSON or as a DDL column list. It is metadata, a few lines long.

    Raises ValueError unless exactly one file under the path has text in it.
    """
    texts = [row.value.strip() for row in spark.read.text(path, wholetext=True).filter("trim(value) <> ''").take(2)]
    if len(texts) != 1:
        raise ValueError(f"{path} must have one schema file, not {'none' if not texts else 'several'}")
    text = texts[0]
    if text.startswith("{"):
        return T.StructType.fromJson(json.loads(text))
    return T.StructType.fromDDL(text)


def resolve_paths(spark: SparkSession, paths: str | Sequence[str], missing: str = "error") -> list[str]:
    """Paths to read. ``missing='skip'`` leaves out the absent ones; otherwise Spark reports them."""
    wanted = [paths] if isinstance(paths, str) else list(paths)
    if missing == "error":
        return wanted
    if missing != "skip":
        raise ValueError("missing is 'error' or 'skip'")
    return existing_paths(spark, wanted)


def _raw(
    spark: SparkSession, paths: list[str], schema: T.StructType, layout: DelimitedFormat, mode: str
) -> DataFrame:
    fields = [T.StructField(f.name, f.dataType) for f in schema]
    if mode == "PERMISSIVE":
        fields.append(T.StructField(_BAD, T.StringType()))
    if not paths:
        return spark.createDataFrame([], T.StructType(fields)).withColumns(
            {_FILE: F.lit(None).cast("string"), _BLOCK: F.lit(None).cast("bigint"), _SEEN: F.lit(None).cast("bigint")}
        )
    frame = spark.read.schema(T.StructType(fields)).options(**layout.options()).option("mode", mode).csv(paths)
    return frame.withColumns(
        {
            _FILE: F.col("_metadata.file_path"),
            _BLOCK: F.col("_metadata.file_block_start"),
            _SEEN: F.monotonically_increasing_id(),
        }
    )


def _absent_required(schema: T.StructType) -> Column:
    """A required non-text column without a value. Required text is never absent: it is the empty text."""
    checks = [F.col(f.name).isNull() for f in schema if not f.nullable and f.dataType != T.StringType()]
    return reduce(lambda a, b: a | b, checks) if checks else F.lit(False)


def _parsed_whole(schema: T.StructType) -> Column:
    """Always true, and refers to every column: a row is judged on all its columns, whatever is selected later.

    Without it the parser would skip unselected columns and so overlook the bad values in them.
    """
    return F.hash(*[F.col(f.name) for f in schema]) >= F.lit(-(2**31))


def escaped(text: Column) -> Column:
    """Text without line breaks and characters that delimited files cannot carry; ``unescaped`` undoes it."""
    out = text
    for plain, sign in _ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(sign))
    return F.when(text.rlike("[\\u0000-\\u0002\\u001a\r\n]"), out).otherwise(text)


def unescaped(text: Column) -> Column:
    out = text
    for plain, sign in reversed(_ESCAPES):
        out = F.replace(out, F.lit(sign), F.lit(plain))
    return F.when(F.contains(text, F.lit(_ESCAPES[0][0])), out).otherwise(text)


def _finish(frame: DataFrame, schema: T.StructType, layout: DelimitedFormat, extra: dict[str, Column]) -> DataFrame:
    def value(f: T.StructField) -> Column:
        if f.dataType != T.StringType():
            return F.col(f.name)
        text = unescaped(F.col(f.name)) if layout.line_breaks == "escape" else F.col(f.name)
        return text if f.nullable else F.coalesce(text, F.lit(""))

    values = [value(f).alias(f.name) for f in schema]
    return decode_strings(frame.select(*values, *[c.alias(n) for n, c in extra.items()]), layout.charset)


def scan_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    layout: DelimitedFormat = DelimitedFormat(),
    rejects: str = "continue",
    missing: str = "error",
    source_name: str | None = None,
    record_number: str | None = None,
    first_rows: int | None = None,
) -> DataFrame:
    """Rows of the files that fit the schema.

    ``rejects='continue'`` drops rows that do not fit, ``'fail'`` stops at the first of them; see
    ``scan_with_rejects`` to keep them. Several paths and patterns may be given. ``source_name`` and
    ``record_number`` add columns with the file a row came from and its number in that file, counting every
    record read; ``first_rows`` keeps that many leading records of each file.
    """
    if rejects not in ("continue", "fail"):
        raise ValueError("rejects is 'continue' or 'fail'")
    found = resolve_paths(spark, paths, missing)
    frame = _raw(spark, found, schema, layout, "FAILFAST" if rejects == "fail" else "PERMISSIVE")
    extra: dict[str, Column] = {}
    if record_number or first_rows is not None:
        frame = number_records(frame, "_record")
        if first_rows is not None:
            frame = frame.filter(F.col("_record") <= first_rows)
        if record_number:
            extra[record_number] = F.col("_record")
    if source_name:
        extra[source_name] = F.col(_FILE)
    if rejects == "fail":
        kept = frame.filter(_parsed_whole(schema))
        complete = F.when(_absent_required(schema), F.raise_error(F.lit("a required column is empty"))).otherwise(True)
        return _finish(kept.filter(complete.cast("boolean")), schema, layout, extra)
    fits = F.col(_BAD).isNull() & ~_absent_required(schema) & _parsed_whole(schema)
    return _finish(frame.filter(fits), schema, layout, extra)


def scan_with_rejects(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    layout: DelimitedFormat = DelimitedFormat(),
    reason: str | None = None,
    missing: str = "error",
) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, rejected raw records). ``reason`` names a column telling what was wrong with each.

    Lines are read as they are and parsed beside themselves, so a rejected record is the file's line to the letter, and both
    results come from one rule. Files whose records may be several lines are parsed as a whole; there, a record rejected
    for an empty required column is put together again from its values.
    """
    found = resolve_paths(spark, paths, missing)
    if found and "multiLine" not in layout.options():
        frame = _parsed_lines(spark, found, schema, layout)
        record = F.coalesce(F.col(_BAD), F.col(_LINE))
    else:
        frame = _raw(spark, found, schema, layout, "PERMISSIVE")
        record = F.coalesce(F.col(_BAD), F.to_csv(F.struct(*[F.col(f.name) for f in schema]), {"sep": layout.separator}))
    absent = _absent_required(schema)
    broken = F.col(_BAD).isNotNull()
    good = _finish(frame.filter(~broken & ~absent & _parsed_whole(schema)), schema, layout, {})
    bad = frame.filter((broken | absent) & _parsed_whole(schema)).select(
        record.alias("raw_record"), *([_reason(schema, layout).alias(reason)] if reason else [])
    )
    return good, decode_strings(bad, layout.charset)


def _parsed_lines(spark: SparkSession, paths: list[str], schema: T.StructType, layout: DelimitedFormat) -> DataFrame:
    """The declared columns, the bad record if a line does not fit them, and the line."""
    # A separator that a text hardly has, and no quotes: a line is one value. One that has it comes as a bad record.
    whole = {**layout.options(), "sep": "\u0001", "quote": "", "columnNameOfCorruptRecord": _BAD}
    lines = spark.read.schema(f"{_LINE} STRING, {_BAD} STRING").options(**whole).csv(paths)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema, T.StructField(_BAD, T.StringType())])
    options = {k: v for k, v in layout.options().items() if k in ("sep", "quote", "escape", "dateFormat", "nullValue")}
    line = F.coalesce(F.col(_BAD), F.col(_LINE)).alias(_LINE)
    row = F.from_csv(F.coalesce(F.col(_BAD), F.col(_LINE)), fields, {**options, "columnNameOfCorruptRecord": _BAD})
    # The row number keeps filters above the parser, so that a line is parsed once.
    return lines.select(line, row.alias(_ROW), F.monotonically_increasing_id().alias(_SEEN)).select(_LINE, _SEEN, f"{_ROW}.*")


def _reason(schema: T.StructType, layout: DelimitedFormat) -> Column:
    """First fault of a bad record: its column count, then the first column that does not hold its type."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(_BAD, T.StringType())])
    ddl = ", ".join(f"`{f.name}` STRING" for f in texts)
    tokens = F.from_csv(
        F.col(_BAD),
        ddl,
        {"sep": layout.separator, "escape": '"', "nullValue": _NOTHING, "columnNameOfCorruptRecord": _BAD},
    )
    outcome = F.when(
        F.col(_BAD).isNotNull() & tokens[_BAD].isNotNull(), F.lit(f"record does not have {len(schema)} columns")
    )
    for f in schema:
        token = tokens[f.name]
        if f.dataType != T.StringType():
            if f.dataType == T.DateType():
                value = F.try_to_date(token, layout.date_format)
            else:
                value = token.try_cast(f.dataType)
            wrong = F.col(_BAD).isNotNull() & token.isNotNull() & value.isNull()
            outcome = outcome.when(wrong, F.lit(f"column {f.name} is not {f.dataType.simpleString()}"))
            if not f.nullable:
                outcome = outcome.when(
                    F.col(f.name).isNull() & (F.col(_BAD).isNull() | token.isNull()), F.lit(f"column {f.name} is empty")
                )
    return outcome.otherwise(F.lit("record does not fit the schema"))


def number_records(frame: DataFrame, name: str) -> DataFrame:
    """Number the records of each file in file order, without gathering a file in one task.

    A record's number is the count of records in the file's earlier splits plus its place in its own split.
    Only one row per split is summed up and windowed. How its offset reaches the records is left to Spark.
    """
    splits = frame.groupBy(_FILE, _BLOCK).agg(F.min(_SEEN).alias("_first"), F.count(F.lit(1)).alias("_records"))
    earlier = Window.partitionBy(_FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        _FILE, _BLOCK, "_first", F.coalesce(F.sum("_records").over(earlier), F.lit(0)).alias("_before")
    )
    return (
        frame.join(offsets, [_FILE, _BLOCK])
        .withColumn(name, F.col("_before") + F.col(_SEEN) - F.col("_first") + 1)
        .drop("_first", "_before")
    )
