"""Packing: deficit round-robin over source queues into token windows, cut into sequences."""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, written

#: Kept by a Python worker for its later tasks, by path.
_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    """Token ids of whole texts by the tokenizers library, with a memory of words and their parts.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its words
    one after the other. Words of printable characters below U+0100 are cut further into the parts
    that the tokenizer takes apart (contractions, runs of letters, numbers, other signs), so that
    the library sees each part once. All other words go to it as they are.
    """

    #: The tokenizer's parts, for characters below U+0100.
    PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\s\w]|_)+")
    PLAIN = re.compile(r"[!-~¡-ÿ]+")
    #: Letters that the tokenizer's normaliser (NFC, then lower case) turns into a letter and a mark.
    MARKED = "".join(c for c in map(chr, range(0xA0, 0x110000)) if c.isalnum() and not unicodedata.normalize("NFC", c).lower()[-1].isalnum())
    #: A full stop or comma that may belong to a longer run of signs.
    RUN = re.compile(rf"[.,] (?<![^\W_{MARKED}][.,] )(?<![ ][.,] )")

    def __init__(self, path: str, end_id: int, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib, self.end = Tokenizer.from_file(path), np.array([end_id], "<u2").tobytes()
        vocabulary = self.lib.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # the ids that end a part
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.most = most
        self.words: dict[str, bytes] = {"": b""}

    def _learn_parts(self, new: list[str], step: int = 500) -> None:
        for b in range(0, len(new), 40 * step):
            joined = [" ".join(new[i : i + step]) for i in range(b, min(len(new), b + 40 * step), step)]
            for k, x in enumerate(self.lib.encode_batch_fast(joined, add_special_tokens=False)):
                ids = np.array(x.ids, "<u2")
                raw, ends = ids.tobytes(), (2 * np.flatnonzero(self.closes[ids]) + 2).tolist()
                own = new[b + k * step : b + (k + 1) * step]
                if len(ends) != len(own):
                    raise ValueError("a part was not tokenized by itself")
                self.words.update(zip(own, [raw[i:j] for i, j in zip([0, *ends], ends, strict=False)], strict=True))

    def _learn(self, new: set[str]) -> None:
        parts, cut, strange = [], {}, []
        for w in new:
            if w.isalpha() and self.PLAIN.fullmatch(w) and w == w.lower():
                parts.append(w)
            elif not self.PLAIN.fullmatch(w) or "<|" in w:
                strange.append(w)
            else:
                cut[w] = self.PART.findall(w.lower())
        more = set().union(*cut.values()) - self.words.keys()
        self._learn_parts(parts + list(more.difference(parts)))
        for w, own in cut.items():
            self.words[w] = b"".join([self.words[x] for x in own])
        for w, x in zip(strange, self.lib.encode_batch_fast(strange, add_special_tokens=False), strict=True):
            self.words[w] = np.array(x.ids, "<u2").tobytes()

    def _split(self, text: str) -> list[str]:
        """The text's words; full stops and commas that stand alone after a word are words too."""
        try:
            text.encode("latin-1")
            text = text.lower()  # simple for these characters; the tokenizer does the same
        except UnicodeEncodeError:
            pass
        text = text.replace("\n", " ")
        if not self.RUN.search(text):
            text = text.replace(". ", " . ").replace(", ", " , ")
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text and the end id, as little-endian unsigned 16-bit numbers."""
        if len(self.words) > self.most:
            self.words = {"": b""}
        split = [self._split(t) for t in texts]
        self._learn(set().union(*split) - self.words.keys())
        known = self.words.__getitem__
        return [b"".join(map(known, words)) + self.end for words in split]


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, source, n and ids (16-bit, with the end id) of every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(tokenizer_path)
        if encoder is None:
            encoder = _encoders[tokenizer_path] = WordEncoder(tokenizer_path, end_id)
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            ids = [x for b, e in chunks([len(x) for x in texts], 4_000_000) for x in encoder.encode(texts[b:e])]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("source"), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "source", "n", "ids"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    return docs.select("doc_id", F.coalesce(source, F.lit("")).alias("source"), "text").mapInArrow(
        run, f"doc_id {kind}, source string, n long, ids binary"
    )


def running_start(df: DataFrame, group: list[str], block: Column, order: list[str], value: str, name: str) -> DataFrame:
    """df with `name`: the sum of `value` over earlier rows of the group, by block and then order.

    Sums within blocks and sums of blocks are taken apart, so that no task gets a whole group.
    """
    blocked = df.withColumn("_block", block)
    inner = Window.partitionBy(*group, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        blocked.groupBy(*group, "_block")
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(outer), F.lit(0)))
        .drop("_sum")
    )
    return (
        blocked.withColumn("_inner", F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .join(bases, [*group, "_block"])
        .withColumn(name, F.col("_base") + F.col("_inner"))
        .drop("_block", "_base", "_inner")
    )


def plan(lengths: DataFrame, window_tokens: int, shares: dict[str, float] | None, blocks: int) -> DataFrame:
    """row, window and `start`, the place of each document in the one stream of all windows.

    Every source is a queue. In each window its deficit grows by its share of `window_tokens`, and
    its next documents are sent as long as the deficit covers them; what is left is carried to the
    next window. So a document is sent in window ceil(tokens of the queue up to its end / quantum)
    - 1, wherever its rows lie: the deficits cross windows and partitions. Shares default to those
    of the corpus, which empties all queues together; a source without a share of its own gets its
    share of the corpus.
    """
    totals = lengths.groupBy("source").agg(F.sum("n").alias("tokens"))
    share = F.col("tokens") / F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    if shares:
        given = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
        share = F.coalesce(F.element_at(given, F.col("source")), share)
    quanta = totals.withColumn("quantum", F.greatest(F.lit(1.0), share * window_tokens)).select("source", "quantum")
    queued = running_start(lengths, ["source"], F.pmod(F.xxhash64("row"), F.lit(blocks)), ["row"], "n", "queue_start")
    sent = queued.join(quanta, "source").withColumn(
        "window", (F.ceil((F.col("queue_start") + F.col("n")) / F.col("quantum")) - 1).cast("long")
    )
    windows = sent.groupBy("window").agg(F.sum("n").alias("tokens"))
    placed = running_start(windows, [], F.floor(F.col("window") / 1024), ["window"], "tokens", "window_start").select("window", "window_start")
    inside = Window.partitionBy("window").orderBy("source", "queue_start").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sent.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(placed, "window")
        .select("row", "window", (F.col("window_start") + F.col("before")).alias("start"))
    )


def cut(total: int, size: int) -> tuple[int, list[int]]:
    """Full sequences of a stream of `total` tokens, and the power-of-two lengths of its tail."""
    tail = total % size
    return total // size, [1 << b for b in range(tail.bit_length() - 1, -1, -1) if tail >> b & 1]


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 1,
    size: int = 2048,
    window_tokens: int = 64 * 2048,
    shares: dict[str, float] | None = None,
    block_rows: int = 500_000,
) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The stream of all windows is cut every `size` tokens; the tail is cut into lengths that are
    powers of two, so no sequence needs padding. Null text counts as empty, which is the end id
    alone; a null source is a queue of its own; repeated rows are packed one by one; an empty table
    has no pieces; extra columns are left out. The queue of a source may be of any size: it is summed
    in blocks of about `block_rows` rows of the whole table.
    """
    spark = docs.sparkSession
    tokens = written(tokenized(docs, tokenizer_path, end_id).withColumn("row", F.monotonically_increasing_id()), "tokens")
    total, rows = tokens.agg(F.sum("n"), F.count("*")).first()
    full, tail = cut(total or 0, size)
    ends, at = [], full * size  # of the tail's sequences
    for n in tail:
        at += n
        ends.append(at)
    starts = plan(tokens.select("row", "source", "n"), window_tokens, shares, max(64, -(-rows // block_rows))).drop("window")
    shared = spark.sparkContext.broadcast((full, np.array([full * size, *ends], np.int64)))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, edges = shared.value
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            own = []
            for i, (begin, ids) in enumerate(zip(batch.column("start").to_pylist(), batch.column("ids").to_pylist(), strict=True)):
                n, done = len(ids) // 2, 0
                wide = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                while done < n:
                    at = begin + done
                    if at < full * size:
                        sequence, head = at // size, at // size * size
                        end = head + size
                    else:
                        k = int(np.searchsorted(edges, at, side="right"))
                        sequence, head, end = full + k - 1, int(edges[k - 1]), int(edges[k])
                    take = min(n - done, end - at)
                    own.append(i)
                    for column, x in zip(rows[1:], (done, take, zlib.crc32(wide[4 * done : 4 * (done + take)]), n, sequence, at - head), strict=True):
                        column.append(x)
                    done += take
            yield pa.record_batch([batch.column("doc_id").take(pa.array(own, pa.int64())), *[pa.array(c, pa.int64()) for c in rows[1:]]], names=names)

    kind = dict(docs.dtypes)["doc_id"]
    return (
        tokens.select("row", "doc_id", "ids")
        .join(starts, "row")
        .select("doc_id", "ids", "start")
        .mapInArrow(pieces, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    )
