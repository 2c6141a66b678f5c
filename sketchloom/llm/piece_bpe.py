"""SentencePiece BPE: vectorised merge rounds over flat symbol arrays, and decoding of ids."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Lookup, chunks

SPACE = "\u2581"
#: Runs of spaces go with the word that follows; no piece has a space after another character.
WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
NONE = np.int32(2**31 - 1)


class PieceModel:
    """A byte-fallback BPE model with a dummy prefix and no other normalisation.

    Each merge round takes, in every word, the pair whose joined piece ranks first, and joins all
    its places at once, leftmost first. Where a piece could at once be part of a better-ranked pair,
    only its leftmost place is joined in that round, so that the order of merges is that of the
    one-at-a-time algorithm. Words with no pair left are put aside and the arrays compacted.
    """

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(n)]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(n)]
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.unknown = lib.unk_id()
        ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        scores = np.array([lib.get_score(i) for i in range(n)])
        symbols = dict(ids)  # characters that are only parts of pieces get numbers above the ids
        for p in ids:
            for c in p:
                symbols.setdefault(c, n + len(symbols))
        self.symbol = {c: i for c, i in symbols.items() if len(c) == 1}
        order = np.empty(n, np.int32)
        order[np.argsort(-scores, kind="stable")] = np.arange(n)
        rank = order
        left, right, joined = [], [], []
        unsafe = np.zeros(n, bool)
        for p, i in ids.items():
            for k in range(1, len(p)):
                a, b = p[:k], p[k:]
                for part in (a, b):
                    if part in ids and rank[ids[part]] > rank[i]:
                        unsafe[ids[part]] = True
                if a in symbols and b in symbols:
                    left.append(symbols[a])
                    right.append(symbols[b])
                    joined.append(i)
        self.joined = np.array(joined, np.int64)
        self.rank_of = rank[self.joined].astype(np.int32)
        self.by_rank = np.argsort(rank)
        self.unsafe = unsafe
        self.pairs = Lookup((np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64))
        self.text_of = [b"" if special[i] and i not in self.byte_id.values() else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        for value, i in self.byte_id.items():
            self.text_of[i] = bytes([value])
        self.is_byte = [lib.is_byte(i) for i in range(n)]
        self.number = [str(i) for i in range(n)]
        self.n = n

    def encode_words(self, words: list[str], long: int = 64) -> list[list[int]]:
        """The ids of each word (with its leading spaces); words of over `long` characters go by rank."""
        flat = "".join(words)
        codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds, back = np.unique(codes, return_inverse=True)
        # characters outside every piece keep a number below 0, which no pair has
        own = np.array([self.symbol.get(chr(c), -1 - int(c)) for c in kinds], np.int64)
        symbol = own[back]
        sizes = np.array([len(w) for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        large = np.repeat(sizes > long, sizes)
        done = [self._by_rank(word[large], symbol[large])] if large.any() else []
        symbol, word = symbol[~large], word[~large]
        while len(symbol):
            here = word[1:] == word[:-1]
            at = np.flatnonzero(here & (symbol[1:] >= 0) & (symbol[:-1] >= 0))
            hit = self.pairs.find((symbol[at].astype(np.uint64) << np.uint64(32)) | symbol[at + 1].astype(np.uint64))
            at, hit = at[hit >= 0], hit[hit >= 0]
            rank = np.full(len(symbol), NONE, np.int32)  # of the pair that begins here
            rank[at] = self.rank_of[hit]
            begins = np.flatnonzero(np.concatenate([[True], ~here]))
            least = np.minimum.reduceat(rank, begins)
            counts = np.diff(np.append(begins, len(symbol)))
            live = np.repeat(least < NONE, counts)
            if not live.all():
                done.append((word[~live], symbol[~live]))
                symbol, word, rank = symbol[live], word[live], rank[live]
                least, counts = least[least < NONE], counts[least < NONE]
                if not len(symbol):
                    break
            best = np.repeat(least, counts)
            chosen = rank == best
            begins = np.cumsum(counts) - counts
            one = np.repeat(self.unsafe[self.by_rank[least]], counts)
            if one.any():
                places = np.flatnonzero(chosen)
                _, first = np.unique(word[places], return_index=True)
                only = np.zeros(len(chosen), bool)
                only[places[first]] = True
                chosen &= only | ~one
            run = chosen & ~np.concatenate([[False], chosen[:-1]])
            index = np.arange(len(chosen))
            since = index - np.maximum.accumulate(np.where(run, index, 0))
            chosen &= since % 2 == 0
            places = np.flatnonzero(chosen)
            symbol[places] = self.by_rank[rank[places]]
            stay = np.ones(len(symbol), bool)
            stay[places + 1] = False
            symbol, word = symbol[stay], word[stay]
        if not done:
            return [[] for _ in words]
        word, symbol = (np.concatenate([d[i] for d in done]) for i in (0, 1))
        order = np.argsort(word, kind="stable")
        word, symbol = word[order], symbol[order]
        ends = np.searchsorted(word, np.arange(len(words)), side="right")
        flat_ids, out, begin = symbol.tolist(), [], 0
        strange = np.zeros(len(words), bool)
        strange[word[(symbol < 0) | (symbol >= self.n)]] = True
        chars = {v: k for k, v in self.symbol.items() if v >= self.n}
        for end, odd in zip(ends.tolist(), strange.tolist(), strict=True):
            ids = flat_ids[begin:end]
            out.append([y for x in ids for y in self._fallback(x, chars)] if odd else ids)
            begin = end
        return out

    def _by_rank(self, word: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words and symbols after all merges, in rounds over ranks with the best rank first.

        A round joins, in every word, all places of the rank, leftmost first, and looks only at the
        pairs beside them, so all rounds together cost the number of merges and not length times rounds.
        Symbols are linked instead of compacted. Where joining a place makes a better-ranked pair, or
        could with the place after it, the places to its right wait until that pair is joined.
        """
        n = len(symbol)
        symbol, after, before = symbol.copy(), np.arange(1, n + 1), np.arange(-1, n - 1)
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        after[edge - 1], before[edge] = n, -1
        rank, there = np.full(n, NONE, np.int32), np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        best: list[int] = []

        def ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            out = np.full(len(left), NONE, np.int32)
            at = np.flatnonzero((left >= 0) & (right >= 0))
            hit = self.pairs.find((left[at].astype(np.uint64) << np.uint64(32)) | right[at].astype(np.uint64))
            out[at[hit >= 0]] = self.rank_of[hit[hit >= 0]]
            return out

        def wait(at: np.ndarray) -> None:
            """Notes the pairs that now begin at these places."""
            rank[at] = NONE
            at = at[after[at] < n]
            rank[at] = ranks(symbol[at], symbol[after[at]])
            at = at[rank[at] < NONE]
            at = at[np.argsort(rank[at], kind="stable")]
            for part in np.split(at, np.flatnonzero(np.diff(rank[at])) + 1) if len(at) else []:
                k = int(rank[part[0]])
                if k not in waiting:
                    waiting[k] = []
                    heapq.heappush(best, k)
                waiting[k].append(part)

        wait(np.arange(n))
        while best:
            k = heapq.heappop(best)
            parts = waiting.pop(k)
            at = np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            at = at[rank[at] == k]
            if not len(at):
                continue
            piece = self.by_rank[k]
            next_to = np.zeros(len(at), bool)  # begins where the place before it ends
            next_to[1:] = after[at[:-1]] == at[1:]
            index = np.arange(len(at))
            run = next_to & ~np.concatenate([[False], next_to[:-1]])
            since = index - np.maximum.accumulate(np.where(next_to, np.where(run, index - 1, 0), index))
            at = at[since % 2 == 0]
            if self.unsafe[piece]:
                prev, end = before[at], after[after[at]]
                less = np.zeros(len(at), bool)
                less[prev >= 0] = ranks(symbol[prev[prev >= 0]], np.full((prev >= 0).sum(), piece)) < k
                less[end < n] |= ranks(np.full((end < n).sum(), piece), symbol[end[end < n]]) < k
                less[1:] |= end[:-1] == at[1:]
                _, first, of = np.unique(word[at], return_index=True, return_inverse=True)
                upto = np.minimum.reduceat(np.where(less, index[: len(at)], len(at)), first)[of]
                rest, at = at[index[: len(at)] > upto], at[index[: len(at)] <= upto]
                if len(rest):
                    waiting[k] = [rest]
                    heapq.heappush(best, k)
            right = after[at]
            symbol[at] = piece
            rank[right], there[right] = NONE, False
            after[at] = after[right]
            inner = after[at] < n
            before[after[at[inner]]] = at[inner]
            beside = before[at]
            wait(np.unique(np.concatenate([at, beside[beside >= 0]])))
        return word[there], symbol[there]

    def _fallback(self, x: int, chars: dict[int, str]) -> list[int]:
        if 0 <= x < self.n:
            return [x]
        data = (chr(-1 - x) if x < 0 else chars[x]).encode("utf-8", "surrogatepass")
        return [self.byte_id[b] for b in data] if self.byte_id else [self.unknown]

    @staticmethod
    def words(text: str) -> list[str]:
        """The words of a text, each without its first space."""
        if not text:
            return []
        text = text.replace(" ", SPACE)
        if SPACE * 2 in text or text[0] == SPACE or text[-1] == SPACE:
            return [w[1:] for w in WORD.findall(SPACE + text)]
        return text.split(SPACE)

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: one leading space goes, bad bytes become U+FFFD one by one."""
        raw = b"".join([self.text_of[i] for i in ids])
        for i in ids:
            if self.text_of[i]:
                if not self.is_byte[i] and raw[:1] == b" ":
                    raw = raw[1:]
                break
        return clean(raw)


def clean(raw: bytes) -> str:
    """UTF-8 to text; each byte that begins no valid character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out = []
        while raw:
            try:
                out.append(raw.decode())
                break
            except UnicodeDecodeError as e:
                out.append(raw[: e.start].decode() + "\ufffd")
                raw = raw[e.start + 1 :]
        return "".join(out)


#: Kept by a Python worker for its later tasks, by path.
_models: dict[str, PieceModel] = {}
_words: dict[str, dict[str, tuple[int, str, bytes]]] = {}


def encode_texts(model: PieceModel, seen: dict, texts: list[str], most: int) -> list[tuple[int, str, str]]:
    """For each text the number of ids, the ids as text and the decoded text; `seen` keeps words."""
    split = [model.words(t) for t in texts]
    new = list({w for words in split for w in words if w not in seen})
    for b, e in chunks([len(w) + 1 for w in new], 1_000_000):
        number, text_of = model.number, model.text_of
        for w, ids in zip(new[b:e], model.encode_words([SPACE + w for w in new[b:e]]), strict=True):
            seen[w] = (len(ids), ",".join([number[i] for i in ids]), b"".join([text_of[i] for i in ids]))
    out = []
    for words in split:
        if not words:
            out.append((0, "", ""))
            continue
        counts, ids, raw = zip(*[seen[w] for w in words], strict=True)
        # The dummy prefix makes the first piece begin with a space, which decoding takes off.
        out.append((sum(counts), ",".join(ids), clean(b"".join(raw)[1:])))
    if len(seen) > most:
        seen.clear()
    return out


def encode_documents(docs: DataFrame, model_path: str, cached_words: int = 300_000) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 for every row of docs.

    Ids are those of the sentencepiece library without begin or end ids; they are joined by commas
    for the digest. Null text counts as empty (no ids). Repeated rows are encoded one by one, extra
    columns are left out and an empty table gives no rows. A word's ids are kept for later texts, of
    `cached_words` words at most. The cost of a word is near its length, however long it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_path not in _models:
            _models[model_path] = PieceModel(model_path)
        model = _models[model_path]
        seen = _words.setdefault(model_path, {})
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            n, ids, decoded = [], [], []
            for b, e in chunks([len(x) for x in texts], 4_000_000):
                for count, own, text in encode_texts(model, seen, texts[b:e], cached_words):
                    n.append(count)
                    ids.append(hashlib.sha256(own.encode()).hexdigest())
                    decoded.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
