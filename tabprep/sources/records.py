"""CSV records of any size of file, split at record boundaries by many tasks.

A line break inside quotes does not end a record, so whether a line starts a record
depends on all quotes before it.  Spark's splittable text scan gives the lines of
each file block in order; three steps turn them into records:

1. **Transitions.**  A block is a function from the state at its start (between
   records, or inside quotes) to the state at its end.  Tasks find both values
   of the function, from the lines that hold a quote; other lines change nothing.
2. **States.**  The functions of a file's blocks, one after the other, give every
   block's true state at its start: a row a block on the driver (some hundred
   thousand for 100 TB).
3. **Records.**  Tasks parse their blocks from the known state.  A record that
   crosses a block's end is left in pieces; the pieces of a file are numbered by
   a running count of the records they begin, joined and parsed.

The records are stored once as Parquet, a column per field, so typing and every later
reader scan columns instead of parsing text again.  Compressed files are one block each.

Rules (those of the common CSV reader the job specs were written for): a quote
opens a quoted field only at the field's start; inside, two quotes are one; what
follows the closing quote up to the separator is kept as it is; a backslash is an
ordinary character; blank lines (also of blanks only) are skipped; rows with too few fields
end in nulls; a byte order mark is dropped; a nameless header field is
``Unnamed: i``.  Rows with too many fields, and rows with a lone carriage return outside quotes, are
malformed.  A quote that is never closed is an error.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabprep.functions.names import qcol
from tabprep.session import drop_stored, store

ROW, MALFORMED, PIECE = 0, 1, 2
#: Lines, and bytes of them, that a task takes apart at a time: its memory does not grow with its block.
ROWS_AT_ONCE, BYTES_AT_ONCE = 2_000, 4 << 20
HEAD_LINES = 1000


def open_after(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether the line ends inside quotes, given whether it starts there."""
    start = sep + '"'
    if inside:
        at = 0
    elif line[:1] == '"':
        at = 1
    else:
        at = line.find(start) + 2
        if at == 1:
            return False
    while True:  # inside quotes from ``at`` on
        quote = line.find('"', at)
        while quote >= 0 and line[quote + 1:quote + 2] == '"':
            quote = line.find('"', quote + 2)
        if quote < 0:
            return True
        at = line.find(start, quote + 1) + 2
        if at == 1:
            return False


def parse(lines: list[str], sep: str = ",") -> Iterator[tuple[list[str] | None, str]]:
    """(fields or None if malformed, text) of whole records given as lines; blank ones are skipped."""
    csv.field_size_limit(2 ** 31 - 1)
    whole = [x for x in lines if x.strip(" \t\r\n") or not x.isascii()] if not any('"' in x for x in lines) else lines
    try:  # one call for all, in the usual case that every line is fine
        rows = list(csv.reader((x + "\n" for x in whole), delimiter=sep))
        yield from ((r, "") for r in rows if r and not (len(r) == 1 and not r[0].strip(" \t")))
        return
    except csv.Error:
        pass
    for record in join_lines(lines, sep):
        if not record.strip(" \t\r\n"):
            continue
        try:
            yield next(csv.reader((x + "\n" for x in record.split("\n")), delimiter=sep)), record
        except csv.Error:
            yield None, record


def join_lines(lines: list[str], sep: str = ",") -> Iterator[str]:
    """The text of each record."""
    held, inside = [], False
    for line in lines:
        held.append(line)
        inside = open_after(line, inside, sep) if '"' in line else inside
        if not inside:
            yield "\n".join(held)
            held = []
    if held:
        yield "\n".join(held)


def _lines(spark: SparkSession, path) -> DataFrame:
    """(file, block, line): the lines of every file, in order within a block."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[str]]]:
    """((file, block), lines) runs of at most ROWS_AT_ONCE lines and, but for single lines, BYTES_AT_ONCE bytes, in order."""
    for batch in batches:
        files, blocks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edge = ((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])).nonzero()[0] + 1 if len(files) else []
        for lo, hi in zip([0, *edge], [*edge, len(files)]):
            while lo < hi:
                n = min(ROWS_AT_ONCE, int(hi - lo))
                while n > 1 and batch.column(2).slice(lo, n).get_total_buffer_size() > BYTES_AT_ONCE:
                    n //= 2
                yield (int(files[lo]), int(blocks[lo])), batch.column(2).slice(lo, n).to_pylist()
                lo += n


def open_blocks(lines: DataFrame, sep: str = ",") -> tuple[set, int]:
    """((file, block) of the blocks that start inside quotes, files that end inside quotes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ends = None, (False, True)
        for key, some in _runs(batches):
            if key != now:
                if now is not None:
                    yield _transition(now, ends)
                now, ends = key, (False, True)
            outside, inside = ends
            for line in some:
                outside, inside = open_after(line, outside, sep), open_after(line, inside, sep)
            ends = outside, inside
        if now is not None:
            yield _transition(now, ends)

    quoted = lines.where(F.col("line").contains('"'))
    found = quoted.mapInArrow(run, "file long, block long, outside boolean, inside boolean").collect()  # a row a block
    opened, state = set(), {}
    for r in sorted(found):
        inside = state.get(r["file"], False)
        if inside:
            opened.add((r["file"], r["block"]))
        state[r["file"]] = r["inside"] if inside else r["outside"]
    return opened, sum(state.values())


def _transition(key: tuple[int, int], ends: tuple[bool, bool]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, *ends)], ["file", "block", "outside", "inside"])


def read_header(spark: SparkSession, path, sep: str = ",") -> tuple[list[str], str]:
    """(names, text of the first record) of the first file."""
    files = sorted(spark.read.option("lineSep", "\n").text(path).inputFiles())
    first = _lines(spark, files[0]).where("block = 0").select("line") if files else None
    lines = [r["line"] for r in first.limit(HEAD_LINES).collect()] if files else []
    while lines and not lines[0].strip(" \t\r\ufeff"):
        lines = lines[1:]
    if not lines:
        raise ValueError(f"no header in {path}")
    text = next(join_lines([lines[0].lstrip("\ufeff"), *lines[1:]], sep))
    fields = next(parse(text.split("\n"), sep))[0]
    if fields is None:
        raise ValueError(f"the header of {files[0]} is malformed")
    return [name if name else f"Unnamed: {i}" for i, name in enumerate(fields)], text


class _Rows:
    """Parsed rows as Arrow batches: kind, text, file, block, part, then a column per field."""

    def __init__(self, width: int):
        self.width = width
        self.names = ["_kind", "_text", "_file", "_block", "_part", *[f"c{i}" for i in range(width)]]

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        """From (kind, text, file, block, part, fields)."""
        kind, text, file, block, part = (list(x) for x in zip(*[r[:5] for r in rows]))
        blank = [None] * self.width
        fields = zip(*[r[5] + blank[len(r[5]):] for r in rows])
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(text, pa.string()), pa.array(file, pa.int64()), pa.array(block, pa.int64()),
             pa.array(part, pa.int32()), *[pa.array(c, pa.string()) for c in fields]], self.names)

    def parsed(self, lines: list[str], key: tuple[int, int], sep: str) -> Iterator[tuple]:
        for fields, text in parse(lines, sep):
            if fields is None or len(fields) > self.width:
                yield (MALFORMED, text or sep.join(map(_quoted, fields)), *key, 0, [])
            else:
                yield (ROW, None, *key, 0, fields)

    @property
    def schema(self) -> str:
        return "_kind int, _text string, _file long, _block long, _part int, " + ", ".join(f"c{i} string" for i in range(self.width))


def _quoted(field: str) -> str:
    return '"' + field.replace('"', '""') + '"' if any(c in field for c in '",\n') else field


def read_records(spark: SparkSession, path, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(rows as text columns, malformed rows as ``text``); both read stored tables."""
    names, header = read_header(spark, path, sep)
    rows_of, lines = _Rows(len(names)), _lines(spark, path)
    # both scans must cut the files alike, also when executors come or go in between
    setting = "spark.sql.files.minPartitionNum"
    pinned = spark.conf.get(setting, None)
    if pinned is None:
        spark.conf.set(setting, str(spark.sparkContext.defaultParallelism))
    try:
        opened, endless = open_blocks(lines, sep)
        if endless:
            raise ValueError(f"{endless} of the files at {path} end inside quotes")
        started = spark.sparkContext.broadcast(opened)  # blocks whose first line continues a record

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, held, inside, tail, expect = None, [], False, [], False
            for key, some in _runs(batches):
                if key != now:
                    if tail:
                        held.append((PIECE, "\n".join(tail), *now, 1, []))
                    now, inside, tail = key, key in started.value, []
                    head, expect = [] if inside else None, key[1] == 0
                done = []  # lines of whole records
                for line in some:
                    inside = open_after(line, inside, sep) if '"' in line else inside
                    if head is not None:  # the rest of a record that an earlier block began
                        head.append(line)
                        if not inside:
                            held.append((PIECE, "\n".join(head), *key, 0, []))
                            head = None
                        continue
                    tail.append(line)
                    if not inside:
                        done += tail
                        tail = []
                if head:  # the block may end before the record does; its next run goes on with it
                    held.append((PIECE, "\n".join(head) + "\n", *key, -1, []))
                    head = []
                if expect and done:
                    done, expect = without_header(done), False
                held += rows_of.parsed(done, key, sep)
                if held:
                    yield rows_of.batch(held)
                    held = []
            if tail:
                held.append((PIECE, "\n".join(tail), *now, 1, []))
            if held:
                yield rows_of.batch(held)

        def without_header(done: list[str]) -> list[str]:
            done = [done[0].lstrip("\ufeff"), *done[1:]]
            while done and not done[0].strip(" \t\r"):
                done = done[1:]
            n = header.count("\n") + 1
            if done and "\n".join(done[:n]).rstrip("\r") != header.rstrip("\r"):
                raise ValueError(f"a file's header is not that of the first file: {done[0][:200]!r}")
            return done[n:]

        found = store(lines.mapInArrow(run, rows_of.schema), "csv-rows")
    finally:
        if pinned is None:
            spark.conf.unset(setting)
    if opened:
        found = _joined(found, rows_of, sep)
    rows = found.where(F.col("_kind") == ROW).select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
    return rows, found.where(F.col("_kind") == MALFORMED).select(F.col("_text").alias("text"))


def _joined(found: DataFrame, rows_of: _Rows, sep: str) -> DataFrame:
    """``found`` with the records that cross block ends, from their pieces."""
    pieces = found.where(F.col("_kind") == PIECE).select("_file", "_block", "_part", "_text", F.monotonically_increasing_id().alias("_n"))
    # at most a few pieces a block: a running count of the records begun tells which belong together
    order = ["_block", "_part", "_n"]
    begun = F.sum((F.col("_part") == 1).cast("long")).over(Window.partitionBy("_file").orderBy(*order))
    whole = pieces.withColumn("_record", begun).groupBy("_file", "_record").agg(
        F.array_sort(F.collect_list(F.struct(*order, "_text"))).alias("p"))
    # a piece that ends its block's lines lacks the line break that the scan took away
    text = F.array_join(F.transform("p", lambda x: F.when((x["_part"] == 1), F.concat(x["_text"], F.lit("\n"))).otherwise(x["_text"])), "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for file, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for r in rows_of.parsed(body.split("\n"), (file, 0), sep)]
            if rows:
                yield rows_of.batch(rows)

    crossed = whole.select("_file", text.alias("_text")).mapInArrow(run, rows_of.schema)
    both = store(found.where(F.col("_kind") != PIECE).unionByName(crossed), "csv-records")
    drop_stored(found)
    return both


__all__ = ["read_records", "read_header", "open_after", "join_lines", "parse"]
