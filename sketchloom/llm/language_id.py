"""Language ID: prediction by partial matching over bytes with frozen per-language statistics."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Lookup, chunks

LETTER = re.compile(r"[^\W\d_]")


class ContextModel:
    """Variable-order byte contexts of several languages and their code lengths in bits.

    A symbol seen after a context costs log2((n + d) / count), with n symbols and d distinct ones
    seen there; an unseen one pays the escape log2((n + d) / d) and is coded in the context that is
    a byte shorter, down to uniform bytes. Every text is preceded by `order` line feeds.
    """

    def __init__(self, order: int, samples: dict[str, list[bytes]]):
        self.order, self.langs = order, sorted(samples)
        counts = [self._count(order, samples[x]) for x in self.langs]
        n_langs = len(self.langs)
        self.find: list[Lookup] = []
        self.cost: list[np.ndarray] = []
        self.find_context: list[Lookup] = []
        self.escape: list[np.ndarray] = []
        for k in range(order + 1):
            grams = np.unique(np.concatenate([c[k][0] for c in counts]))
            seen = np.zeros((len(grams), n_langs))
            for j, c in enumerate(counts):
                seen[np.searchsorted(grams, c[k][0]), j] = c[k][1]
            contexts, back = np.unique(grams >> np.uint64(8), return_inverse=True)
            total, kinds = (np.zeros((len(contexts), n_langs)) for _ in range(2))
            np.add.at(total, back, seen)
            np.add.at(kinds, back, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
                own = np.log2((total + kinds)[back] / seen)
            if k:
                shorter = self.cost[k - 1][self.find[k - 1].find(grams & np.uint64((1 << 8 * k) - 1))]
            else:
                shorter = np.full((1, n_langs), 8.0)
            self.find_context.append(Lookup(contexts))
            self.escape.append(escape.astype(np.float32))
            self.cost.append(np.where(seen > 0, own, escape[back] + shorter).astype(np.float32))
            self.find.append(Lookup(grams))

    def code_lengths(self, texts: list[np.ndarray], piece: int = 2_000_000) -> np.ndarray:
        """Exact code length of each text in each language; no more than about `piece` bytes are coded at once.

        A long text is coded in pieces, each after the `order` bytes before it.
        """
        out = np.zeros((len(texts), len(self.langs)))
        cut = [(i, b, min(b + piece, len(x))) for i, x in enumerate(texts) for b in range(0, len(x), piece)]
        for b, e in chunks([to - at for _, at, to in cut], piece):
            own = cut[b:e]
            heads = [texts[i][max(0, at - self.order) : at] for i, at, _ in own]
            bits = self.bits(*padded([texts[i][at:to] for i, at, to in own], self.order, heads))
            np.add.at(out, [i for i, _, _ in own], bits)
        return out

    @staticmethod
    def _count(order: int, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        data, starts = padded([np.frombuffer(x, np.uint8) for x in texts], order)
        real = np.ones(len(data), bool)
        for i in range(order):
            real[starts + i] = False
        return [np.unique(keys_of(data, k)[real[k:]], return_counts=True) for k in range(order + 1)]

    def bits(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Exact code length of each padded text in each language."""
        at = np.ones(len(data), bool)
        for i in range(self.order):
            at[starts + i] = False
        at = np.flatnonzero(at)
        out = np.zeros((len(data), len(self.langs)), np.float32)
        key = keys_of(data, self.order)[at - self.order]
        for k in range(self.order, -1, -1):
            hit = self.find[k].find(key)
            found = hit >= 0
            out[at[found]] += self.cost[k][hit[found]]
            at, key = at[~found], key[~found]
            above = self.find_context[k].find(key >> np.uint64(8))
            known = above >= 0
            out[at[known]] += self.escape[k][above[known]]
            key = key & np.uint64((1 << 8 * k) - 1)
        out[at] += np.float32(8)  # bytes that no language has seen
        return np.add.reduceat(out, starts, axis=0, dtype=np.float64)


def padded(texts: list[np.ndarray], order: int, heads: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each after `order` bytes (line feeds, and its head at their end), and where each begins."""
    sizes = np.array([len(x) + order for x in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.full(int(sizes.sum()), 10, np.uint8)
    for x, s in zip(texts, starts, strict=True):
        data[s + order : s + order + len(x)] = x
    for x, s in zip(heads or [], starts, strict=False):
        data[s + order - len(x) : s + order] = x
    return data, starts


def keys_of(data: np.ndarray, k: int) -> np.ndarray:
    """The k + 1 bytes that end at each position from k on, as one number."""
    n = max(0, len(data) - k)
    key = np.zeros(n, np.uint64)
    for i in range(k + 1):
        key = (key << np.uint64(8)) | data[i : i + n]
    return key


def held_out(doc_id) -> object:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def fit(docs: DataFrame, order: int = 3, max_bytes: int = 1_000_000, max_doc_bytes: int = 100_000) -> ContextModel | None:
    """The model of the languages in `lang`, or None where no labelled text may be learned from.

    Learns from rows whose crc32(doc_id) mod 4 is not 2 and that have text and lang. It reads a
    bounded sample: documents of up to `max_doc_bytes`, taken by the hash of doc_id so that each
    language gives about `max_bytes`.
    """
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        "lang", "text", "doc_id", F.octet_length("text").alias("n")
    ).where(f"n between 1 and {max_doc_bytes}")
    sizes = {r.lang: r.n for r in usable.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not sizes:
        return None
    steps = 1_000_000
    quota = [x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(int(steps * min(1.0, max_bytes / n)) + 1))]
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language id")), F.lit(steps))
    sample = usable.where(drawn < F.element_at(F.create_map(*quota), F.col("lang"))).select("lang", "text").toPandas()
    return ContextModel(order, {lang: [x.encode() for x in own] for lang, own in sample.groupby("lang")["text"]})


def predict_language(docs: DataFrame, model: ContextModel | None, chunk_bytes: int = 2_000_000) -> DataFrame:
    """doc_id, held_out, lang_pred, score and bits_per_byte for every row of docs.

    lang_pred is the language with the shortest code for the whole text (ties: the first in order
    of name); score is its posterior under equal priors. Null, empty and letterless texts, and all
    texts where nothing could be learned, are `und` with score 0 and null bits_per_byte. A null
    doc_id is not held out. lang, source and doc_id take no part in a prediction; repeated rows are
    judged one by one, extra columns are left out and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            where = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
            raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            lang, sure, rate = [], [], []
            for b, e in chunks(np.diff(where).tolist(), chunk_bytes):
                own = [raw[where[i] : where[i + 1]] for i in range(b, e)]
                if model is None:
                    lang += ["und"] * (e - b)
                    sure += [0.0] * (e - b)
                    rate += [None] * (e - b)
                    continue
                bits = model.code_lengths(own)
                best = bits.argmin(axis=1)
                least = bits.min(axis=1)
                with np.errstate(under="ignore"):
                    post = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                for j, x in enumerate(own):
                    known = len(x) > 0 and LETTER.search(x.tobytes().decode()) is not None
                    lang.append(model.langs[best[j]] if known else "und")
                    sure.append(float(post[j]) if known else 0.0)
                    rate.append(float(least[j] / len(x)) if known else None)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(sure, pa.float64()), pa.array(rate, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text").mapInArrow(
        score, f"doc_id {kind}, held_out boolean, lang_pred string, score double, bits_per_byte double"
    )


def language_report(docs: DataFrame) -> DataFrame:
    return predict_language(docs, fit(docs))


def known(bits: float, size: int, raw_bits: float = 8.0, allowance: float = 128.0) -> bool:
    """Whether the best code of a text of `size` bytes is no longer than the bytes as they are."""
    return bits <= raw_bits * size + allowance


def language_stage(docs: DataFrame, raw_bits: float = 8.0, allowance: float = 128.0) -> DataFrame:
    """The documents in a known language.

    A language's statistics make its own texts shorter, and texts of other languages longer, as every
    unseen context costs an escape. So a text is rejected when its code in the best language is longer
    than `raw_bits` a byte, which is what uniform bytes cost without a model. `allowance` bits more are
    free, so that a few odd words don't reject a short text. Texts that are null or have no letter are
    rejected too; where nothing could be learned, all are. All columns are kept; repeated rows are
    judged one by one; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            at = batch.schema.names.index("text")
            texts = [(x or "").encode() for x in batch.column(at).to_pylist()]
            stays = []
            for b, e in chunks([len(x) for x in texts], 2_000_000):
                bits = model.code_lengths([np.frombuffer(x, np.uint8) for x in texts[b:e]]).min(axis=1) if model else None
                stays += [bool(model and x and LETTER.search(x.decode()) and known(bits[j], len(x), raw_bits, allowance)) for j, x in enumerate(texts[b:e])]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
