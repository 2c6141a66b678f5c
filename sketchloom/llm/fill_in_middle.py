"""Fill-in-middle: documents as piece tables, cut and arranged by descriptors, restored by the inverse arrangement."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTINELS = b"<P><S><M>"
#: The descriptors of a document that has been cut are prefix, middle, suffix and the three sentinels; these are their arrangements.
ARRANGED = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


class PieceTable:
    """A text as descriptors (buffer, start, length) over buffers that are never changed."""

    def __init__(self, buffers: tuple[bytes, ...], pieces: list[tuple[int, int, int]]):
        self.buffers, self.pieces = buffers, pieces

    def cut(self, *places: int) -> PieceTable:
        """The same text with descriptors that end at the places (ascending); a place between descriptors makes an empty one."""
        out, at, places = [], 0, list(places)
        for buffer, start, length in self.pieces:
            begin = 0
            while places and places[0] <= at + length:
                end = places.pop(0) - at
                out.append((buffer, start + begin, end - begin))
                begin = end
            out.append((buffer, start + begin, length - begin))
            at += length
        return PieceTable(self.buffers, out)

    def arranged(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[i] for i in order])

    def put_back(self, order: tuple[int, ...]) -> PieceTable:
        """The table before it was arranged in this order."""
        pieces = list(self.pieces)
        for piece, i in zip(self.pieces, order, strict=True):
            pieces[i] = piece
        return PieceTable(self.buffers, pieces)

    def first(self, n: int) -> PieceTable:
        return PieceTable(self.buffers, self.pieces[:n])

    def views(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield memoryview(self.buffers[buffer])[start : start + length]

    def sha256(self) -> str:
        """The digest of the text, read piece by piece."""
        digest = hashlib.sha256()
        for view in self.views():
            digest.update(view)
        return digest.hexdigest()

    def text(self) -> bytes:
        return b"".join(self.views())


def units(data: bytes, step: int = 1 << 24) -> Iterator[np.ndarray]:
    """The ends of a text's units in pieces of the text: blanks with the run of other characters that follows, and blanks at the end."""
    for at in range(0, len(data), step):
        blank = BLANK[np.frombuffer(data, np.uint8, min(step + 1, len(data) - at), at)]
        ends = np.flatnonzero(~blank[:-1] & blank[1:]) + at + 1
        yield np.append(ends, len(data)) if at + step >= len(data) else ends


def ends_at(data: bytes, asked: list[int]) -> list[int]:
    """The byte at which as many units as asked (ascending) have ended."""
    out, before, left = [0 for k in asked if k == 0], 0, [k for k in asked if k]
    for ends in units(data):
        while left and left[0] <= before + len(ends):
            out.append(int(ends[left.pop(0) - before - 1]))
        before += len(ends)
    return out


def characters(data: memoryview) -> int:
    """Code points of UTF-8: the bytes that begin one."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def transformed(data: bytes, key: str, rate: int = 50, spm: int = 80) -> tuple[int, str, PieceTable]:
    """The number of units, the form and the output of a text, as the digest of the key decides."""
    n = sum(map(len, units(data)))
    mark = hashlib.sha256(key.encode()).hexdigest()
    h = [int(mark[i : i + 8], 16) for i in range(0, 32, 8)]
    whole = PieceTable((data, SENTINELS), [(0, 0, len(data))])
    if not data or h[2] % 100 >= rate or any(SENTINELS[i : i + 3] in data for i in (0, 3, 6)):
        return n, "plain", whole
    form = "spm" if h[3] % 100 < spm else "psm"
    pieces = whole.cut(*ends_at(data, sorted((h[0] % (n + 1), h[1] % (n + 1))))).pieces
    return n, form, PieceTable(whole.buffers, pieces + [(1, 0, 3), (1, 3, 3), (1, 6, 3)]).arranged(ARRANGED[form])


def restored(output: bytes, form: str) -> PieceTable:
    """The text that an output of this form was made of, as descriptors over the output."""
    table = PieceTable((output,), [(0, 0, len(output))])
    if form == "plain":
        return table
    places = []
    for i in ARRANGED[form][0:6:2]:
        at = output.index(SENTINELS[3 * (i - 3) : 3 * (i - 2)], places[-1] if places else 0)
        places += [at, at + 3]
    return PieceTable(table.buffers, table.cut(*places).pieces[1:]).put_back(ARRANGED[form]).first(3)


def fill_in_middle(docs: DataFrame, rate: int = 50, spm: int = 80, seed: str = "42", with_output: bool = True) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output, output_sha256 and restored_sha256 of every row.

    A text is cut into n units (a run of blanks with the run of other characters that follows it, or
    the blanks at its end). The digest of `seed:doc_id` draws the two cuts, whether the document is
    transformed (`rate` of 100) and in which form (`spm` of 100, else psm): the descriptors of
    prefix, middle and suffix are arranged with those of the sentinels, and no text is copied until the
    output is written. Texts that are empty or hold a sentinel stay plain. restored_sha256 is that of
    the text rebuilt from output and form alone. Without `with_output` the column output is left out.

    Null text counts as empty; a null doc_id draws as the seed with nothing behind it. Rows that repeat a
    doc_id draw alike and are cut each in its own text. An empty table gives no rows; other columns are left out.
    """
    kind = "doc_id long, n long, form string, prefix_chars long, middle_chars long, " + "output string, " * with_output + "output_sha256 string, restored_sha256 string"
    names = [x.split(" ")[0] for x in kind.split(", ")]

    def row(doc_id: int | None, data: bytes) -> list:
        n, form, table = transformed(data, f"{seed}:{'' if doc_id is None else doc_id}", rate, spm)
        output = table.text()
        chars = [None, None]
        if form != "plain":
            views = list(table.views())
            chars = [characters(views[ARRANGED[form].index(i)]) for i in (0, 1)]
        digests = [table.sha256(), restored(output, form).sha256()]
        return [doc_id, n, form, *chars, *([output.decode()] if with_output else []), *digests]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                rows.append(row(doc_id.as_py(), data))
                held += len(data)
                if held >= 1 << 24:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    def made(rows: list[list]) -> pa.RecordBatch:
        kinds = {"doc_id": pa.int64(), "n": pa.int64(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}
        return pa.record_batch([pa.array(c, kinds.get(k, pa.string())) for k, c in zip(names, zip(*rows, strict=True), strict=True)], names=names)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, kind)
