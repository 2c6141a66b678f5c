"""From texts and sequences to postings (acc, h): hash sets with or without abundance."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import HASH_BITS, kmers, word_shingles, words
from ..sources.staging import dealt


def shingle_postings(docs: DataFrame, id_col: str = "doc_id", width: int = 3, scaled: int = 4) -> DataFrame:
    """acc, h: the distinct hashes of a text's word shingles, one in `scaled` of the hash space.

    Distinct within the row that holds the text, so nothing is shuffled.
    """
    return hashed(shingled(docs, id_col, width, True), scaled)


def shingled(docs: DataFrame, id_col: str, width: int, distinct: bool) -> DataFrame:
    """acc, shingle: the word shingles of every text."""
    split = dealt(docs.where("text is not null").select(F.col(id_col).alias("acc"), "text")).select("acc", words(F.col("text")).alias("words"))
    runs = word_shingles(F.col("words"), width)
    return split.select("acc", F.explode(F.array_distinct(runs) if distinct else runs).alias("shingle"))


def hashed(shingles: DataFrame, scaled: int) -> DataFrame:
    """acc, h: hashes of the first of `scaled` parts of the hash space.

    The shingles are rows here, so hashing is compiled; only what stays is turned into a number.
    """
    digest = shingles.select("acc", F.md5("shingle").alias("digest"))
    most = f"{(1 << HASH_BITS) // scaled:013x}"  # digits of equal length are in the order of their numbers
    kept = digest.where(F.substring("digest", 1, 13) < most)
    return kept.select("acc", F.conv(F.substring("digest", 1, 13), 16, 10).cast("long").alias("h"))


def abundant_postings(docs: DataFrame, id_col: str = "doc_id", width: int = 3, scaled: int = 4, least: int = 2) -> DataFrame:
    """acc, h, abund: hashes that a text has at least `least` times."""
    return (
        hashed(shingled(docs, id_col, width, False), scaled)
        .groupBy("acc", "h")
        .agg(F.count("*").alias("abund"))
        .where(F.col("abund") >= least)
    )


def chunked(seqs: DataFrame, k: int, chunk: int = 65_536) -> DataFrame:
    """id, seq: sequences of more than `chunk` letters cut into chunks that overlap by k - 1, so that every window of k letters begins in one chunk; in one pass."""
    pieces = F.regexp_extract_all("seq", F.lit(f"(?s)(?=(.{{1,{chunk + k - 1}}})).{{1,{chunk}}}"), F.lit(1))
    return seqs.select("id", F.explode(pieces).alias("seq"))


def own_kmers(k: int, alphabet: str) -> Column:
    """The distinct windows of k letters of `seq`, of the alphabet only; a-z count as A-Z."""
    upper = F.translate("seq", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return F.array_distinct(F.filter(kmers(upper, k), lambda x: x.rlike(f"^[{alphabet}]+\\z")))


def kmer_sets(seqs: DataFrame, k: int, alphabet: str = "ACGT", chunk: int = 65_536, parts: bool = False) -> DataFrame:
    """id, kmer: the distinct windows of k letters of sequences, of the alphabet only; a-z count as A-Z.

    Windows of a short sequence are made distinct within its row; a longer one is cut into chunks, so that no row holds
    all its windows, and what chunks repeat is taken out by a shuffle. With `parts` the rows are chunks
    already (of `read_fasta`), several with one id; those that are `whole` records are not shuffled.
    """
    seqs = dealt(seqs.where("seq is not null").select("id", "seq", *(["whole"] if parts else [])))
    windows = lambda df: df.select("id", F.explode(own_kmers(k, alphabet)).alias("kmer"))
    if parts:
        return windows(seqs.where("whole")).union(windows(seqs.where("not whole")).distinct())
    long = F.char_length("seq") > chunk
    return windows(seqs.where(~long)).union(windows(chunked(seqs.where(long), k, chunk)).distinct())


def kmer_stats(chunks: DataFrame, k: int, alphabet: str = "ACGT") -> DataFrame:
    """id, n, first_kmer, last_kmer of the distinct windows of records in chunks (id, seq, whole, of `read_fasta`); ids without windows have no row.

    Whole records are summed up within their rows; only windows of records in several chunks are shuffled.
    """
    summed = lambda own: F.struct(F.size(own).cast("long").alias("n"), F.array_min(own).alias("first_kmer"), F.array_max(own).alias("last_kmer"))
    # generated, so that no filter or column makes the windows again
    whole = chunks.where("whole").select("id", F.inline(F.transform(F.array(own_kmers(k, alphabet)), summed))).where("n > 0")
    rest = chunks.where("not whole").select("id", F.explode(own_kmers(k, alphabet)).alias("kmer")).distinct()
    return whole.union(rest.groupBy("id").agg(F.count("*").alias("n"), F.min("kmer").alias("first_kmer"), F.max("kmer").alias("last_kmer")))


# Fixed values of the 64-bit half of the 128-bit hash, and its rotations.
C1, C2 = np.uint64(0x87C37B91114253D5), np.uint64(0x4CF5AD432745937F)
F1, F2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
A1, A2 = np.uint64(0x52DCE729), np.uint64(0x38495AB5)


def murmur64(data: np.ndarray, seed: int = 42) -> np.ndarray:
    """The first 64 bits of the 128-bit x64 murmur3 hash of every row of an array of bytes (n x length)."""
    n, length = data.shape
    turn = lambda x, k: (x << np.uint64(k)) | (x >> np.uint64(64 - k))
    padded = np.zeros((n, -(-length // 16) * 16), np.uint8)
    padded[:, :length] = data
    words = padded.view("<u8").astype(np.uint64)
    a = np.full(n, seed, np.uint64)
    b = a.copy()
    whole = length // 16
    for i in range(words.shape[1] // 2):
        x, y = turn(words[:, 2 * i] * C1, 31) * C2, turn(words[:, 2 * i + 1] * C2, 33) * C1
        if i < whole:
            a = (turn(a ^ x, 27) + b) * np.uint64(5) + A1
            b = (turn(b ^ y, 31) + a) * np.uint64(5) + A2
        else:  # what is left of the last block; bytes beyond the end are zero and mix to zero
            a, b = a ^ x, b ^ y
    a, b = a ^ np.uint64(length), b ^ np.uint64(length)
    a += b
    b += a
    for k in (F1, F2):
        a, b = (a ^ (a >> np.uint64(33))) * k, (b ^ (b >> np.uint64(33))) * k
    return (a ^ (a >> np.uint64(33))) + (b ^ (b >> np.uint64(33)))


def dna_postings(seqs: DataFrame, k: int = 31, scaled: int = 1000, seed: int = 42, parts: bool = False) -> DataFrame:
    """id, h, abund: FracMinHash sketches of DNA sequences, of the hashes up to 2^64 / scaled.

    With `parts` the rows are chunks of sequences that overlap by k - 1 (of `read_fasta`), several with one id.

    Windows of k letters of A, C, G and T (a-z count as A-Z) are hashed on the strand that comes first
    in order of letters; windows with other letters are left out. Hashes of 2^63 or more only occur
    with scaled 1, which is an error.
    """
    if scaled < 2:
        raise ValueError("scaled must be 2 or more")
    most = np.uint64((1 << 64) // scaled)
    code = np.full(256, 4, np.uint8)
    for i, pair in enumerate(("Aa", "Cc", "Gg", "Tt")):
        code[[ord(c) for c in pair]] = i
    letters = np.frombuffer(b"ACGT", np.uint8)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, seq in zip(batch["id"], batch["seq"], strict=True):
                digits = code[np.frombuffer(seq.encode("ascii", "replace"), np.uint8)]
                counts: Counter[int] = Counter()
                for at in range(0, len(digits) - k + 1, 1 << 16):
                    own = np.lib.stride_tricks.sliding_window_view(digits[at : at + (1 << 16) + k - 1], k)
                    own = own[(own < 4).all(axis=1)]
                    other = 3 - own[:, ::-1]
                    first = (own != other).argmax(axis=1)
                    row = np.arange(len(own))
                    own = np.where((other[row, first] < own[row, first])[:, None], other, own)
                    hashes = murmur64(letters[own], seed) if len(own) else np.zeros(0, np.uint64)
                    counts.update(hashes[hashes <= most].astype(np.int64).tolist())
                yield pd.DataFrame({"id": [i] * len(counts), "h": list(counts), "abund": list(counts.values())})

    kind = dict(seqs.dtypes)["id"]
    found = seqs.where("seq is not null").select("id", "seq").mapInPandas(run, f"id {kind}, h long, abund long")
    return found.groupBy("id", "h").agg(F.sum("abund").alias("abund")) if parts else found


def set_sizes(postings: DataFrame) -> DataFrame:
    return postings.groupBy("acc").agg(F.count("*").alias("n"))


def set_classes(postings: DataFrame) -> DataFrame:
    """acc, rep, n: accessions with equal hash sets share the smallest as representative.

    Sets are compared by their size and two independent 64-bit xors over hashed members, which
    aggregate before the shuffle whatever a set's size.
    """
    mixed = [F.bit_xor(F.xxhash64("h", F.lit(salt))) for salt in (1, 2)]
    marks = postings.groupBy("acc").agg(F.count("*").alias("n"), mixed[0].alias("m1"), mixed[1].alias("m2"))
    reps = marks.groupBy("n", "m1", "m2").agg(F.min("acc").alias("rep"))
    return marks.join(reps, ["n", "m1", "m2"]).select("acc", "rep", "n")
