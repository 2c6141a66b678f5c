"""Column expressions: hashes of shingles, quantisation, code lengths, units, paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 52  # of a portable hash: 13 hexadecimal digits


def portable_hash(text: Column) -> Column:
    """The first 52 bits of a text's MD5, as a long that any SQL engine can reproduce."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def words(text: Column) -> Column:
    return F.split(text, r"\s+")


def word_shingles(words: Column, width: int = 3) -> Column:
    """All runs of `width` words of an array column, in order; none for shorter arrays."""
    joined = words
    for k in range(1, width):  # beyond the end of the shorter array the zipped word is null, and so is the run
        later = F.slice(words, k + 1, F.greatest(F.size(words) - k, F.lit(0)))
        joined = F.zip_with(joined, later, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(joined, lambda x: x.isNotNull())


def kmers(text: Column, k: int) -> Column:
    """All windows of k characters, in order, in one pass over the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def quantise(similarity: Column) -> Column:
    """0..1 to 0..255, half up, cut at 1."""
    return F.floor(F.least(similarity, F.lit(1.0)) * 255 + 0.5).cast("int")


def dequantise(q: Column) -> Column:
    """0..255 to 0..1 with three decimals."""
    return F.floor(q / F.lit(255.0) * 1000 + 0.5) / F.lit(1000.0)


def jaccard(common: Column, a: Column, b: Column) -> Column:
    """common / (a + b - common), 0 where the union is empty."""
    union = a + b - common
    return F.when(union > 0, common / union).otherwise(F.lit(0.0))


def clamp16(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(32767)), F.lit(-32768))


def bit_length(x: Column) -> Column:
    """Bits of a positive integer: exact at powers of two, unlike a logarithm; 0 for 0."""
    return F.when(x > 0, F.length(F.bin(x.cast("long")))).otherwise(0)


def ceil_log2(x: Column) -> Column:
    return F.when(x > 1, bit_length(x - 1)).otherwise(0)


def gamma_bits(x: Column) -> Column:
    """Length of the Elias gamma code of x >= 0."""
    return 2 * (bit_length(x + 1) - 1) + 1


def delta_bits(x: Column) -> Column:
    """Length of the Elias delta code of x >= 0: the gamma code of the length, then the rest."""
    low = bit_length(x + 1) - 1
    return gamma_bits(low) + low


def rice_bits(x: Column, k: int) -> Column:
    """Length of the Rice code of x >= 0 with k low bits."""
    return F.shiftright(x.cast("long"), k) + 1 + k


def dense_code(v: Column) -> tuple[Column, Column]:
    """Simple dense coding of v >= 0: the length of its codeword and the codeword."""
    length = bit_length(v + 1) - 1
    return length, (v + 1 - F.expr("1L").cast("long") * F.pow(F.lit(2.0), length).cast("long")).cast("long")


def signature_md5(ksize: Column, mins: Column) -> Column:
    """The MD5 that a signature of these members has to carry: of ksize and the sorted members, written one after the other."""
    return F.md5(F.concat(ksize.cast("string"), F.array_join(F.sort_array(mins).cast("array<string>"), "")))


def accession_of(path: Column) -> Column:
    """A path's last part up to its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def human_time(seconds: Column) -> Column:
    """Seconds as s, min or h with one decimal, half up."""
    shown = lambda x, unit: F.concat(F.format_string("%.1f", F.floor(x * 10 + 0.5) / 10), F.lit(unit))
    return (
        F.when(seconds < 60, shown(seconds, " s")).when(seconds < 3600, shown(seconds / 60, " min")).otherwise(shown(seconds / 3600, " h"))
    )


def human_bytes(n: Column) -> Column:
    """Bytes in IEC units with one decimal."""
    units = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]
    cases = [(n < 1024 ** (i + 1), F.concat(F.format_string("%.1f", n / float(1024**i)), F.lit(f" {u}"))) for i, u in enumerate(units)]
    return reduce(lambda c, x: c.when(*x), cases[1:], F.when(*cases[0])).otherwise(cases[-1][1])


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371.0 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def confidence(countries: list[Column], points: list[tuple[Column, Column]], near_km: float = 8.0) -> Column:
    """0 to 6: pairs of three country sources that agree, and pairs of three points within `near_km`."""
    pairs = [(0, 1), (0, 2), (1, 2)]
    same = [F.coalesce((countries[i] == countries[j]).cast("int"), F.lit(0)) for i, j in pairs]
    near = [F.coalesce((haversine_km(*points[i], *points[j]) <= near_km).cast("int"), F.lit(0)) for i, j in pairs]
    return reduce(lambda a, b: a + b, same + near)
