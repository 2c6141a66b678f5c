"""FASTA files as a Spark data source: records carried over splits, sequences in chunks that overlap."""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .binary import files_at, opened
from .staging import staged

BLANKS = b"\r\n\t "
#: A header is told from a line of letters if its line begins within so many bytes before the place.
LONGEST_HEADER = 1 << 20


@dataclass
class Split(InputPartition):
    """The bytes [begin, end) of a file; end is None for the whole of a compressed one."""

    path: str
    number: int
    begin: int
    end: int | None


class Parser:
    """Chunks of the records of a split from its bytes, in order."""

    def __init__(self, chunk: int, overlap: int):
        self.chunk, self.overlap = chunk, overlap
        self.record, self.name, self.at, self.new = 0, None, 0, False
        self.held, self.own = bytearray(), 0  # letters not given yet; those of them that belong to the split

    def letters(self, data: bytes, own: bool) -> Iterator[tuple]:
        more = data.translate(None, BLANKS)
        self.held += more
        self.own += len(more) if own else 0
        while self.own >= self.chunk and len(self.held) >= self.chunk + self.overlap:
            yield self.row(self.chunk)

    def row(self, own: int, whole: bool = False) -> tuple:
        seq = bytes(self.held[: own + self.overlap])
        out = (self.record, self.name, self.at, own, seq.decode("ascii", "replace"), whole)
        del self.held[:own]
        self.at, self.own, self.new = self.at + own, self.own - own, False
        return out

    def finish(self, ended: bool = True) -> Iterator[tuple]:
        """What is left of the record; a record that began in this split and ended, in one chunk, is whole."""
        whole = ended and self.record > 0 and self.at == 0 and len(self.held) == self.own <= self.chunk
        while self.own:
            yield self.row(min(self.own, self.chunk), whole)
        if self.new:
            yield self.row(0, whole)  # a record without letters
        self.held.clear()

    def begin(self, header: bytes) -> Iterator[tuple]:
        yield from self.finish()
        words = header.split()
        self.record, self.name, self.at, self.new = self.record + 1, words[0].decode("utf-8", "replace") if words else "", 0, True


def rows_of(read, begin: int, end: int | None, parser: Parser, piece: int = 1 << 22) -> Iterator[tuple]:
    """The rows of the bytes [begin, end) of what read(n, at) gives; a header that begins there is read to its end, and letters beyond as far as the last window reaches."""
    back = read(min(begin, LONGEST_HEADER), begin - min(begin, LONGEST_HEADER))
    start = back.rfind(b"\n") + 1
    in_header = begin > 0 and (start > 0 or begin <= LONGEST_HEADER) and back[start : start + 1] == b">"
    line_start = begin == 0 or back.endswith(b"\n")
    header, at = bytearray(), begin
    skip, ended = in_header, True  # the header belongs to the split before
    while True:
        own = end is None or at < end
        if not own and not in_header and len(parser.held) - parser.own >= parser.overlap:
            ended = False
            break
        data = read(piece if own else max(256, parser.overlap), at)
        if own and end is not None:
            data = data[: end - at]
        if not data:
            break
        at, place = at + len(data), 0
        while place < len(data):
            if in_header:
                stop = data.find(b"\n", place)
                header += data[place : stop if stop >= 0 else len(data)]
                if stop < 0:
                    break
                if not skip:
                    yield from parser.begin(bytes(header[1:]))
                header.clear()
                in_header, skip, line_start, place = False, False, True, stop + 1
                continue
            if line_start and data[place : place + 1] == b">":
                if not own:  # the next record: no window goes beyond it
                    yield from parser.finish()
                    return
                in_header = True
                continue
            stop = data.find(b"\n>", place)
            stop = len(data) if stop < 0 else stop + 1
            yield from parser.letters(data[place:stop], own)
            line_start, place = data[stop - 1 : stop] == b"\n", stop
    if in_header and not skip:
        yield from parser.begin(bytes(header[1:]))
    yield from parser.finish(ended)


class FastaReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.split, self.chunk, self.overlap = (int(options[k]) for k in ("split", "chunk", "overlap"))

    def partitions(self) -> list[Split]:
        out, store = [], opened(self.path)[0]
        for path, size in files_at(self.path):
            with store.open_input_file(path) as f:
                packed = f.read_at(2, 0) == b"\x1f\x8b"
            if packed:
                out.append(Split(path, 0, 0, None))
            else:
                out += [Split(path, i, at, min(size, at + self.split)) for i, at in enumerate(range(0, size, self.split))]
        return out or [Split("", 0, 0, 0)]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        parser, rows, held = Parser(self.chunk, self.overlap), [], 0
        with opened(self.path)[0].open_input_file(partition.path) as f:
            if partition.end is None:
                text = gzip.GzipFile(fileobj=f)
                source = rows_of(lambda n, at: text.read(n) if n else b"", 0, None, parser)
            else:
                source = rows_of(f.read_at, partition.begin, partition.end, parser)
            for row in source:
                rows.append(row)
                held += len(row[4])
                if held >= 1 << 22 or len(rows) >= 10_000:
                    yield self.batch(partition, rows)
                    rows, held = [], 0
        if rows:
            yield self.batch(partition, rows)

    def batch(self, partition: Split, rows: list[tuple]) -> pa.RecordBatch:
        rec, name, at, own, seq, whole = zip(*rows, strict=True)
        columns = [pa.array([partition.path] * len(rows)), pa.array([partition.number] * len(rows), pa.int32()), pa.array(rec, pa.int32()), pa.array(name, pa.string()), pa.array(at, pa.int64()), pa.array(own, pa.int32()), pa.array(seq), pa.array(whole)]
        return pa.record_batch(columns, names=["path", "split", "rec", "name", "at", "own", "seq", "whole"])


class Fasta(DataSource):
    """path, split, rec, name, at, own, seq and whole: chunks of records as the splits see them; what goes on from the split before has rec 0 and no name."""

    @classmethod
    def name(cls) -> str:
        return "fasta_splits"

    def schema(self) -> str:
        return "path string, split int, rec int, name string, at long, own int, seq string, whole boolean"

    def reader(self, schema) -> FastaReader:
        return FastaReader(self.options)


def read_fasta(spark: SparkSession, path: str, overlap: int = 30, chunk: int = 65_536, split: int = 1 << 25) -> DataFrame:
    """path, name, at, own, seq and whole of all records of a FASTA file or folder (gzipped or not).

    Sequences come in chunks: `at` is the place of the chunk in its record, `own` the number of its
    letters, and seq has these and up to `overlap` letters that follow in the record, across line
    breaks, so with overlap k - 1 every window of k letters begins in exactly one chunk. A file is read in splits of bytes
    (a gzipped one as a whole, in a stream); a record may go over any number of them: its name and place are carried from
    the splits before by sums over splits, not by reading them again. No task holds a sequence.

    `whole` is true for a row that has all of its record (it may be false for one that ends at the end of a split).
    The name is the header's first word; letters before the first header have the name null; blanks in sequences are
    left out; a record without letters has one row of no letters. A header may have up to 1 MB.
    """
    spark.dataSource.register(Fasta)
    raw = staged(spark.read.format("fasta_splits").options(split=str(split), chunk=str(chunk), overlap=str(overlap)).load(path), "fasta")
    header = F.when(F.col("rec") > 0, F.struct("rec", "name", (F.col("at") + F.col("own")).alias("end")))
    ends = raw.groupBy("path", "split").agg(F.max(header).alias("last"), F.coalesce(F.sum(F.when(F.col("rec") == 0, F.col("own"))), F.lit(0)).alias("on"))
    order = Window.partitionBy("path").orderBy("split")
    ends = ends.withColumn("piece", F.count("last").over(order)).withColumn("letters", F.coalesce("last.end", "on"))
    ends = ends.withColumn("upto", F.sum("letters").over(Window.partitionBy("path", "piece").orderBy("split")))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    carried = staged(ends.select("path", "split", F.last("last.name", ignorenulls=True).over(before).alias("of"), F.lag("upto", 1, 0).over(order).alias("base")), "carried")
    goes_on = F.col("rec") == 0
    joined = raw.join(carried, ["path", "split"])
    return joined.select("path", F.when(goes_on, F.col("of")).otherwise(F.col("name")).alias("name"), (F.col("at") + F.when(goes_on, F.col("base")).otherwise(0)).alias("at"), "own", "seq", "whole")
