"""A quoted CSV file, however large, read by many tasks.

Spark's own reader gives a file whose quoted fields may hold line ends to one task.  Here the file is read as lines,
which Spark splits into byte ranges, in any store.  Whether a line starts inside a quoted field depends on all lines before it, so
each range is first scanned for both answers: a range maps the state it starts in (outside or inside quotes) to the state it ends
in.  Such maps are constant, the identity or a swap, and a window over one narrow row for each range composes them: the
state before a range is that of the last constant range before it, swapped as often as swaps follow.  Then each range is
parsed from its first record to its last.  Of a record that crosses borders, only its lines meet.  Lines without quotes cannot
change a state and are not looked at; the file is read once for the states, once for the records and, if a record crosses
a border, once for the lines of such records.

Records end at a line end (LF, CRLF or CR) outside quotes.  A quote opens a field only at its beginning and is doubled
inside; what follows the closing quote belongs to the field, quotes included.  Line ends inside quotes stay as they are.  Lines of
blanks alone are no records; missing fields at the end of a record are null, and so are empty ones, quoted or not.  More
fields than columns are an error, and so is a file of a folder whose first record is not the header of the first.
A quote that is never closed takes the rest of the file into its field.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OUT, IN = False, True
NEVER = (1 << 63) - 1
#: Records that a task turns into columns at a time.
ROWS = 10_000
_CARRIAGE = re.compile(r"[^\r]*\r\n?|[^\r]+\Z")


class Quotes:
    """Whether a line that starts in a state ends inside a quoted field."""

    def __init__(self, separator: str):
        s = re.escape(separator)
        body, rest = r'(?:[^"]++|"")*+', rf"[^{s}\r]*+"
        opens = rf'(?:(?:"{body}"{rest}|[^"{s}\r]{rest}|)[{s}\r])*+"{body}\Z'
        self.outside = re.compile(opens)
        self.inside = re.compile(rf'{body}(?:\Z|"{rest}[{s}\r]{opens})')

    def after(self, line: str, state: bool) -> bool:
        if '"' not in line:
            return state
        return bool((self.inside if state else self.outside).match(line))


def records(lines: Iterable[str], separator: str) -> Iterator[list[str]]:
    """The fields of complete records, blank ones left out."""
    csv.field_size_limit(sys.maxsize)
    split = (part for line in lines for part in ([line] if "\r" not in line else _CARRIAGE.findall(line)))
    for fields in csv.reader(split, delimiter=separator, quotechar='"', doublequote=True):
        if len(fields) > 1 or (fields and fields[0].strip()):
            yield fields


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, id, value``: each line with the byte range it was read in and its number, which grows within a task."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"), "value")


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array, pa.Array]]:
    """``(range, ids, lines)``: batches cut where the range changes."""
    for batch in batches:
        n = batch.num_rows
        file, start, ids, lines = batch.columns
        cuts = [0, n] if n else []
        if n > 1:
            differ = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(start[1:], start[:-1]))
            cuts = [0, *(i + 1 for i in pc.indices_nonzero(differ).to_pylist()), n]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield (file[lo].as_py(), start[lo].as_py()), ids.slice(lo, hi - lo), lines.slice(lo, hi - lo)


def ranges(lines: DataFrame, separator: str) -> DataFrame:
    """``file, start, first, head, tail`` of each range: the numbers of its first line, of the line that ends the record it starts in (none: it starts
    with a record; ``NEVER``: the record goes on beyond it), and of the line where the record that it ends in begins."""
    made = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("first", pa.int64()), ("a", pa.bool_()), ("b", pa.bool_()), ("head", pa.int64()), ("tail_a", pa.int64()), ("tail_b", pa.int64())])

    def scan(batches):
        quotes, now, state, tail, head, first = Quotes(separator), None, [OUT, IN], [None, None], None, None

        def row():
            return pa.RecordBatch.from_pylist([{"file": now[0], "start": now[1], "first": first, "a": state[0], "b": state[1], "head": head, "tail_a": tail[0], "tail_b": tail[1]}], made)

        for key, ids, values in _runs(batches):
            if key != now:
                if now is not None:
                    yield row()
                now, state, tail, head, first = key, [OUT, IN], [None, None], None, ids[0].as_py()
            known = pc.is_valid(values)  # lines with a quote
            for i, line in zip(ids.filter(known).to_pylist(), values.filter(known).to_pylist(), strict=True):
                same = state[0] == state[1]
                for h in (0,) if same else (0, 1):
                    after = quotes.after(line, state[h])
                    if not after:
                        tail[h] = None
                    elif not state[h]:
                        tail[h] = i
                    state[h] = after
                if same:
                    state[1], tail[1] = state[0], tail[0]
                if head is None and not state[1]:
                    head = i
        if now is not None:
            yield row()

    # Only lines with a quote are sent to Python; of the others, that they are there.
    quoted = lines.withColumn("value", F.when(F.contains("value", F.lit('"')), F.col("value")))
    found = quoted.mapInArrow(scan, "file long, start long, first long, a boolean, b boolean, head long, tail_a long, tail_b long")
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    swaps = found.withColumn("swaps", F.sum((F.col("a") & ~F.col("b")).cast("int")).over(upto))
    fixed = F.last(F.when(F.col("a") == F.col("b"), F.struct(F.col("a").cast("int").alias("state"), "swaps")), True).over(before)
    known = swaps.withColumns({"fixed": fixed, "earlier": F.coalesce(F.max("swaps").over(before), F.lit(0))})
    inside = (F.coalesce(F.col("fixed.state"), F.lit(0)) + F.col("earlier") - F.coalesce(F.col("fixed.swaps"), F.lit(0))) % 2 == 1
    return known.select("file", "start", "first", F.when(inside, F.coalesce("head", F.lit(NEVER))).alias("head"), F.when(inside, F.col("tail_b")).otherwise(F.col("tail_a")).alias("tail"))


def _table(rows: list[list[str]], columns: list[str], first: list[bool]) -> pa.RecordBatch | None:
    """Rows as columns, without the header at the beginning of a file."""
    kept = []
    for fields, header in zip(rows, first, strict=True):
        if header:
            if [f.removeprefix("\ufeff") if i == 0 else f for i, f in enumerate(fields)] != columns:
                raise ValueError(f"a file's first record is {fields}, not {columns}")
            continue
        if len(fields) > len(columns):
            raise ValueError(f"{len(fields)} fields for {len(columns)} columns in a record that begins with {fields[0]!r}")
        kept.append([*(f or None for f in fields), *[None] * (len(columns) - len(fields))])
    if not kept:
        return None
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*kept, strict=True)], names=columns)


def _schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _whole(lines: DataFrame, columns: list[str], separator: str, borders: dict[tuple, tuple]) -> DataFrame:
    """The records that lie within one range; without borders, every file is one range."""
    shared = lines.sparkSession.sparkContext.broadcast(borders)

    def parse(batches):
        now, head, tail, header = None, None, None, False

        def complete():
            nonlocal now, head, tail, header
            for key, ids, values in _runs(batches):
                if key != now:
                    if key not in shared.value and not (key[1] == 0 and not shared.value):
                        raise RuntimeError("the byte ranges are not those of the scan for quotes; read the file again under the present settings")
                    now, (head, tail), header = key, shared.value.get(key, (None, None)), key[1] == 0
                if head is not None or tail is not None:
                    kept = pc.and_(pc.greater(ids, -1 if head is None else head), pc.less(ids, NEVER if tail is None else tail))
                    values = values.filter(kept)
                for line in values.to_pylist():
                    yield line + "\n"

        rows, first = [], []
        for fields in records(complete(), separator):
            rows.append(fields)
            first.append(header)
            header = False
            if len(rows) == ROWS:
                yield from filter(None, [_table(rows, columns, first)])
                rows, first = [], []
        if rows:
            yield from filter(None, [_table(rows, columns, first)])

    return lines.mapInArrow(parse, _schema(columns))


def _crossing(lines: DataFrame, columns: list[str], separator: str, odd: DataFrame) -> DataFrame:
    """The records that cross a border: their lines, and no others, meet by record."""
    # Borders are numbered by the records that begin before them; a range's head belongs to the last record before it.
    order = Window.partitionBy("file").orderBy("start")
    numbered = odd.withColumn("after", F.sum(F.col("tail").isNotNull().cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    numbered = numbered.withColumn("before", F.col("after") - F.col("tail").isNotNull().cast("long"))
    met = lines.join(F.broadcast(numbered), ["file", "start"])
    is_tail = F.coalesce(F.col("id") >= F.col("tail"), F.lit(False))
    met = met.where(F.coalesce(F.col("id") <= F.col("head"), F.lit(False)) | is_tail)
    top = is_tail & (F.col("start") == 0) & (F.col("id") == F.col("first"))
    piece = met.select("file", F.when(is_tail, F.col("after")).otherwise(F.col("before")).alias("record"), F.struct("start", "id", "value").alias("line"), top.alias("top"))
    joined = piece.groupBy("file", "record").agg(F.bool_or("top").alias("top"), F.array_sort(F.collect_list("line")).alias("lines"))
    whole = joined.select("top", F.array_join(F.col("lines.value"), "\n").alias("text"))

    def parse(batches):
        for batch in batches:
            for top, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = list(records([text], separator))
                if rows:
                    yield from filter(None, [_table(rows, columns, [top, *[False] * (len(rows) - 1)])])

    return whole.mapInArrow(parse, _schema(columns))


def header(lines: DataFrame, separator: str, most: int = 1000) -> list[str]:
    """The first record of the first file, which must end within so many lines."""

    def first(rows) -> list[str] | None:
        quotes, state, held = Quotes(separator), OUT, []
        for r in rows:
            held.append(r["value"])
            state = quotes.after(r["value"], state)
            found = list(records(["\n".join(held)], separator)) if not state or "\r" in r["value"] else []
            if found and (not state or len(found) > 1):
                return [f.removeprefix("\ufeff") if i == 0 else f for i, f in enumerate(found[0])]
        return None

    begin = lines.where("start = 0").limit(most).collect()
    if not begin:
        return []
    # The first range may be shorter than the record.
    return first(begin) or first(lines.where(F.col("file") == begin[0]["file"]).orderBy("start", F.monotonically_increasing_id()).limit(most).collect()) or []


def read(spark: SparkSession, path: str, separator: str = ";") -> DataFrame:
    """All records of a file, or of the files of a folder, as strings.  The scan for quotes runs at once; the settings that
    decide Spark's byte ranges must be the same when the table is used (if not, that is an error)."""
    lines = _lines(spark, path)
    columns = header(lines, separator)
    if not columns:
        raise ValueError(f"{path} has no header")
    if lines.where("start > 0").isEmpty():
        return _whole(lines, columns, separator, {})
    # One narrow row for each range.
    rows = ranges(lines, separator).collect()
    whole = _whole(lines, columns, separator, {(r["file"], r["start"]): (r["head"], r["tail"]) for r in rows})
    odd = [tuple(r) for r in rows if r["head"] is not None or r["tail"] is not None]
    if not odd:
        return whole
    return whole.unionAll(_crossing(lines, columns, separator, spark.createDataFrame(odd, "file long, start long, first long, head long, tail long")))
