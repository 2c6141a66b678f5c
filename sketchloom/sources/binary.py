"""Binary files of hashes and vectors as Spark data sources, read in blocks, and exact files written by the tasks.

Readers open files through Arrow's file systems, so paths may be local or those of any store that Arrow knows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..operators.ordered import ranged, running_sum


@dataclass
class Block(InputPartition):
    """`count` items of a file from item `first` on; `path` is its full name."""

    path: str
    first: int
    count: int


def opened(path: str) -> tuple[stores.FileSystem, str]:
    """The file system of a path or URI and the path on it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (stores.LocalFileSystem(), path) if path.startswith("/") else stores.FileSystem.from_uri(path)


def files_at(path: str, ending: str = "") -> list[tuple[str, int]]:
    """URI-free names and sizes of the file, or of all files of the folder, in order of names."""
    store, at = opened(path)
    info = store.get_file_info(at)
    if info.type == stores.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else store.get_file_info(stores.FileSelector(at))
    return sorted((f.path, f.size) for f in found if f.is_file and not f.base_name.startswith((".", "_")) and f.base_name.endswith(ending))


def within(filters: list[Filter], column: str) -> tuple[int, int | None]:
    """The range [low, high) of a whole-number column that conjunct filters leave."""
    low, high = 0, None
    for f in filters:
        if not isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual) or f.attribute != (column,):
            continue
        value = f.value
        if isinstance(f, EqualTo | GreaterThanOrEqual):
            low = max(low, value)
        if isinstance(f, GreaterThan):
            low = max(low, value + 1)
        if isinstance(f, EqualTo | LessThanOrEqual):
            high = value + 1 if high is None else min(high, value + 1)
        if isinstance(f, LessThan):
            high = value if high is None else min(high, value)
    return low, high


class BlockReader(DataSourceReader):
    """Items of fixed length in files, one partition for each block; filters on the item's number leave blocks out."""

    number = "pos"

    def __init__(self, options: dict[str, str]):
        self.path, self.block = options["path"], int(options["block"])
        self.low, self.high, self.only = 0, None, None

    def item_bytes(self) -> int:
        raise NotImplementedError

    def batch(self, block: Block, first: int, data: np.ndarray) -> pa.RecordBatch:
        raise NotImplementedError

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        self.low, self.high = within(filters, self.number)
        self.only = next((f.value for f in filters if isinstance(f, EqualTo) and f.attribute == ("acc",)), None)
        yield from filters  # Spark applies them to the rows too

    def partitions(self) -> list[Block]:
        size, out = self.item_bytes(), []
        for path, length in files_at(self.path):
            if length % size:
                raise ValueError(f"{path}: {length} bytes are no whole number of items of {size} bytes")
            if self.only is not None and path.rsplit("/", 1)[-1].split(".", 1)[0] != self.only:
                continue
            end = length // size if self.high is None else min(self.high, length // size)
            first = self.low // self.block * self.block
            out += [Block(path, at, min(self.block, end - at)) for at in range(first, end, self.block)]
        return out or [Block("", 0, 0)]

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        if not partition.count:
            return
        size, step = self.item_bytes(), max(1, (1 << 22) // self.item_bytes())
        store = opened(self.path)[0]
        with store.open_input_file(partition.path) as f:
            for at in range(partition.first, partition.first + partition.count, step):
                count = min(step, partition.first + partition.count - at)
                data = np.frombuffer(f.read_at(count * size, at * size), np.uint8)
                if len(data) != count * size:
                    raise OSError(f"{partition.path} ends early")
                yield self.batch(partition, at, data)


class NumberReader(BlockReader):
    def item_bytes(self) -> int:
        return 8

    def batch(self, block: Block, first: int, data: np.ndarray) -> pa.RecordBatch:
        h = data.view("<u8")
        if int(h.max()) >= 1 << 63:
            raise ValueError(f"hash {int(h.max())} is 2^63 or more")
        acc = block.path.rsplit("/", 1)[-1].split(".", 1)[0]
        return pa.record_batch([pa.array([acc] * len(h)), pa.array(np.arange(first, first + len(h))), pa.array(h.astype(np.int64))], names=["acc", "pos", "h"])


class Numbers(DataSource):
    """acc (the file's name up to its first dot), pos and h of files of little-endian unsigned 64-bit numbers.

    Options: block, the numbers of a partition. A length that is no multiple of 8 and a number of 2^63 or more are errors.
    """

    @classmethod
    def name(cls) -> str:
        return "u64"

    def schema(self) -> str:
        return "acc string, pos long, h long"

    def reader(self, schema) -> NumberReader:
        return NumberReader({"block": str(1 << 23), **self.options})


class VectorReader(BlockReader):
    number = "idx"

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.dim = int(options["dim"])

    def item_bytes(self) -> int:
        return 2 * self.dim

    def batch(self, block: Block, first: int, data: np.ndarray) -> pa.RecordBatch:
        flat, n = data.view("<i2"), len(data) // (2 * self.dim)
        ends = pa.array(np.arange(0, n * self.dim + 1, self.dim, dtype=np.int32))
        return pa.record_batch([pa.array(np.arange(first, first + n)), pa.ListArray.from_arrays(ends, pa.array(flat))], names=["idx", "v"])


class Vectors(DataSource):
    """idx and v of a file of little-endian 16-bit vectors. Options: dim, and block, the vectors of a partition."""

    @classmethod
    def name(cls) -> str:
        return "vectors16"

    def schema(self) -> str:
        return "idx long, v array<smallint>"

    def reader(self, schema) -> VectorReader:
        return VectorReader({"block": "4096", **self.options})


def read_blocks(spark: SparkSession, kind: type[DataSource], path: str, **options) -> DataFrame:
    """A table of one of the sources above; comparisons of acc, pos or idx with constants leave out whole files and blocks."""
    spark.dataSource.register(kind)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(kind.name()).options(**{k: str(v) for k, v in options.items()}).load(path)


# --- exact files ----------------------------------------------------------------------------------
def local(path: str) -> str:
    return opened(path)[1]


def place_bytes(pieces: DataFrame, path: str) -> int:
    """Writes each of pieces (at, data) at its place of one file, and returns their number.

    Every task writes its own pieces, so nothing passes through the driver; a task that runs again
    writes the same bytes at the same places. The file lies on a file system that all machines mount. It
    appears, or replaces an older one, when all are written; if any fails nothing is left.
    """
    path = local(path)
    part = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}-{uuid.uuid4().hex}")
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            with open(part, "r+b") as f:
                for at, data in zip(batch["at"], batch["data"], strict=True):
                    f.seek(int(at))
                    f.write(data)
            yield pd.DataFrame({"n": [len(batch)]})

    try:
        with open(part, "wb"):
            pass
        done = pieces.select("at", "data").mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0
        os.replace(part, path)
        return done
    finally:
        if os.path.exists(part):
            os.remove(part)


def write_lines(lines: DataFrame, order: list, path: str, head: str = "") -> int:
    """One text file of the column `line` (each with its own line end) in an order of no ties, after `head`; and the number of lines.

    The place of each line is the running sum of the lengths before it, counted in ranges of the order.
    """
    data = lines.withColumn("data", F.encode("line", "utf-8"))
    placed = running_sum(ranged(data, *order), order, F.octet_length("data"), "before")
    pieces = placed.select((F.coalesce("before", F.lit(0)) + len(head.encode())).cast("long").alias("at"), "data")
    first = lines.sparkSession.createDataFrame([(0, head.encode())], "at long, data binary")
    return place_bytes(pieces.union(first), path) - 1


def write_groups(lines: DataFrame, order: list[str], root: str) -> int:
    """A file below the root for each distinct `file`, of its lines in order, written whole by the task that holds them; and their number."""
    root = local(root)
    os.makedirs(root, exist_ok=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, f, done = None, None, 0

        def close():
            f.close()
            os.replace(f.name, os.path.join(root, name))

        try:
            for batch in batches:
                for file, line in zip(batch["file"], batch["line"], strict=True):
                    if file != name:
                        if f:
                            close()
                        name, done = file, done + 1
                        f = open(os.path.join(root, f".{file}-{uuid.uuid4().hex}"), "w", encoding="utf-8")
                    f.write(line)
            if f:
                close()
                f = None
        finally:
            if f and not f.closed:
                f.close()
                os.remove(f.name)
        yield pd.DataFrame({"n": [done]})

    sorted_ = lines.repartition("file").sortWithinPartitions("file", *order)
    return sorted_.select("file", "line").mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0


def write_matrix_npy(rows: DataFrame, path: str, n_rows: int, n_cols: int) -> int:
    """A .npy file of 32-bit floats from rows (at, values), `at` the number of cells before the values; each is written at its place by its task."""
    if not path.endswith(".npy"):
        raise ValueError(f"{path}: only .npy files are written")
    header = np.lib.format.magic(1, 0)
    text = repr({"descr": "<f4", "fortran_order": False, "shape": (n_rows, n_cols)}).encode()
    text += b" " * (63 - (len(header) + 2 + len(text)) % 64) + b"\n"
    header += len(text).to_bytes(2, "little") + text

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"at": batch["at"] * 4 + len(header), "data": [np.asarray(x, "<f4").tobytes() for x in batch["values"]]})

    first = rows.sparkSession.createDataFrame([(0, header)], "at long, data binary")
    return place_bytes(rows.select("at", "values").mapInPandas(run, "at long, data binary").union(first), path) - 1
