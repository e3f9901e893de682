"""Delimited sinks: quoted text, plain numbers, optional header line in every file."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import sort_key
from martloom.sources.charsets import encode_text, spark_charset
from martloom.sources.delimited import DelimitedFormat, escaped

CANNOT_CARRY = "a text cell has a line break or control character; choose another line_breaks of the layout"
_MODES = {"overwrite": "overwrite", "append": "append", "create": "errorifexists"}


def as_line(df: DataFrame, layout: DelimitedFormat = DelimitedFormat()) -> Column:
    """A row as one text line: text columns in double quotes, all others bare, null as nothing.

    Line breaks in texts go by the layout's ``line_breaks``: an error, or escaped.
    """
    cells, texts = [], False
    for name, kind in df.dtypes:
        value = F.col(f"`{name}`")
        if kind == "string":
            texts = True
            own = escaped(value) if layout.line_breaks == "escape" else value
            cells.append(F.coalesce(F.concat(F.lit('"'), F.replace(own, F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")))
        elif kind == "date":
            cells.append(F.coalesce(F.date_format(value, layout.date_format), F.lit("")))
        else:
            cells.append(F.coalesce(value.cast("string"), F.lit("")))
    line = F.concat_ws(layout.separator, *cells)
    if texts and layout.line_breaks == "refuse":
        line = _carried(line, "\n\r\u0000\u0001")
    return encode_text(line, layout.charset)


def _carried(line: Column, refused: str) -> Column:
    """The line, or an error if it has a character that the layout cannot carry. Searching the whole line costs less than a
    search of each cell."""
    found = reduce(lambda a, b: a | b, [F.contains(line, F.lit(c)) for c in refused])
    return F.when(found, F.raise_error(F.lit(CANNOT_CARRY))).otherwise(line)


def _writer(df: DataFrame, layout: DelimitedFormat, mode: str, keep: Sequence[str] = ()):
    """The lines go out as a one-column file whose column name is the header line itself; those with line breaks inside
    quotes go out as the columns they are, quoted where they need it."""
    carried = df.drop(*keep)
    if layout.line_breaks == "quote":
        texts = [n for n, kind in carried.dtypes if kind == "string"]
        return df.withColumns({n: encode_text(F.col(f"`{n}`"), layout.charset) for n in texts}).write.mode(_MODES[mode]).options(
            header=str(layout.header).lower(),
            sep=layout.separator,
            quote='"',
            escape='"',
            dateFormat=layout.date_format,
            emptyValue='""',
            nullValue="",
            encoding=spark_charset(layout.charset),
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
        )
    header = layout.separator.join(carried.columns)
    lines = df.select(*[F.col(k) for k in keep], as_line(carried, layout).alias(header))
    return lines.write.mode(_MODES[mode]).options(
        header=str(layout.header).lower(),
        sep="\u0001",
        quote="",
        encoding=spark_charset(layout.charset),
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    )


def write_delimited(
    df: DataFrame,
    path: str,
    layout: DelimitedFormat = DelimitedFormat(header=True),
    mode: str = "overwrite",
    max_file_mb: float | None = None,
) -> None:
    """Write ``df`` in parallel. ``mode`` is overwrite, append or create (an error if the path exists).

    ``max_file_mb`` starts a new file before the size would be passed: the row limit is taken from the widest
    line, so no file exceeds it.
    """
    writer = _writer(df, layout, mode)
    if max_file_mb is not None:
        widest = df.agg(F.max(F.octet_length(as_line(df, layout))).alias("w")).first()["w"] or 1
        writer = writer.option("maxRecordsPerFile", max(1, int(max_file_mb * 1024 * 1024) // (widest + 1)))
    writer.csv(path)


def write_delimited_by_key(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    layout: DelimitedFormat = DelimitedFormat(header=True),
    mode: str = "overwrite",
    key_in_data: bool = True,
    order_by: Sequence[Column] | None = None,
) -> None:
    """A set of files per key value, the value being part of the path.

    The rebalance hint brings the rows of a key together so that small keys get one file, and lets adaptive
    execution cut a key that is too large for one task into several. Rows are sorted inside each file.
    """
    folders = [f"by_{k}" for k in keys]
    keyed = df.withColumns({folder: F.col(k) for folder, k in zip(folders, keys)})
    if not key_in_data:
        keyed = keyed.drop(*keys)
    spread = keyed.hint("rebalance", *[F.col(f) for f in folders])
    order = list(order_by) if order_by is not None else [sort_key(f) for f in folders]
    ordered = spread.sortWithinPartitions(*[sort_key(f) for f in folders], *order)
    _writer(ordered, layout, mode, keep=folders).partitionBy(*folders).csv(path)


def write_single_file(
    df: DataFrame,
    path: str,
    layout: DelimitedFormat = DelimitedFormat(header=True),
    mode: str = "overwrite",
) -> None:
    """One file, which one task writes, by request of the caller. ``write_delimited`` writes in parallel.

    Only the last step is one task: the repartition keeps what comes before it parallel. The rows pass through that
    task as a stream, so its memory does not depend on their number.
    """
    _writer(df.repartition(1), layout, mode).csv(path)
