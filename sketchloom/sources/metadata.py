"""The metadata table with types: dates and numbers cast, points and attributes taken apart by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the metadata table.
METADATA = (
    "acc assay_type center_name consent experiment sample_name instrument librarylayout libraryselection librarysource platform "
    "sample_acc biosample organism sra_study releasedate bioproject mbytes loaddate avgspotlen mbases insertsize library_name "
    "biosamplemodel_sam collection_date_sam geo_loc_name_country_calc geo_loc_name_country_continent_calc geo_loc_name_sam "
    "ena_first_public_run ena_last_update_run sample_name_sam datastore_filetype datastore_provider datastore_region "
    "attributes jattr run_file_version lat_lon elevation country biome confidence".split()
)
DATES = ("releasedate", "loaddate", "ena_first_public_run", "ena_last_update_run")
NUMBERS = {"mbytes": "bigint", "avgspotlen": "bigint", "mbases": "bigint", "insertsize": "bigint", "run_file_version": "bigint", "elevation": "double", "confidence": "int"}
PAIRS = "array<struct<k:string,v:string>>"


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The metadata table from Parquet, or from CSV (gzipped or not) with a header, in the order of METADATA.

    Columns that the file lacks are null; other columns follow. Types are those of the file: see `typed`.
    """
    csv = path.endswith((".csv", ".csv.gz"))
    df = spark.read.option("header", True).option("escape", '"').csv(path) if csv else spark.read.parquet(path)
    there = {c.lower(): c for c in df.columns}
    known = [F.col(f"`{there[c]}`").alias(c) if c in there else F.lit(None).cast("string").alias(c) for c in METADATA]
    return df.select(*known, *[c for c in df.columns if c.lower() not in METADATA])


def double_of(digits: Column) -> Column:
    """The 64-bit floating-point number of 16 hexadecimal digits, high ones first: sign, exponent and mantissa put together, exactly."""
    high, low = (F.conv(F.substring(digits, at, 8), 16, 10).cast("long") for at in (1, 9))
    exponent = F.shiftright(high, 20).bitwiseAND(0x7FF)
    mantissa = high.bitwiseAND(0xFFFFF).cast("double") * float(1 << 32) + low
    size = F.when(exponent == 0, mantissa * 2.0**-1074).otherwise((1 + mantissa / float(1 << 52)) * F.pow(F.lit(2.0), exponent - 1023))
    return F.when(exponent < 0x7FF, F.when(high >= 1 << 31, -size).otherwise(size))


def swapped(digits: Column) -> Column:
    """Hexadecimal digits with their bytes in the other order."""
    return F.array_join(F.reverse(F.regexp_extract_all(digits, F.lit("(..)"), F.lit(1))), "")


def wkb_point(wkb: Column, hexadecimal: bool = False) -> Column:
    """lon and lat of a point in well-known binary form, of either byte order, with or without a reference system; null for anything else.

    The value is binary, or a text of hexadecimal digits.
    """
    digits = F.upper(wkb) if hexadecimal else F.hex(wkb)
    little = F.substring(digits, 1, 2) == "01"
    field = lambda at, n: F.when(little, swapped(F.substr(digits, at, F.lit(n)))).otherwise(F.substr(digits, at, F.lit(n)))
    kind = field(F.lit(3), 8)
    begin = F.when(kind == "20000001", F.lit(19)).otherwise(F.lit(11))
    known = digits.rlike("^0[01]([0-9A-F]{2})+$") & kind.isin("00000001", "20000001") & (F.char_length(digits) == begin + 31)
    point = F.struct(double_of(field(begin, 16)).alias("lon"), double_of(field(begin + 16, 16)).alias("lat"))
    return F.when(known, point)


def attribute(jattr: Column, name: str) -> Column:
    """The value of one attribute in the JSON text of attributes, read as a variant; null where there is none or the text is no JSON."""
    return F.try_variant_get(F.try_parse_json(jattr), "$['" + name.replace("'", "\\'") + "']", "string")


def typed(metadata: DataFrame) -> DataFrame:
    """The table with dates, numbers and nested attributes as such, lat_lon as a struct of lon and lat, and all else unchanged.

    Values that can't be read become null. Columns of text stay as they are in the file, so
    filters on them reach its scan.
    """
    kinds = dict(metadata.dtypes)
    out = []
    for c in metadata.columns:
        col, kind = F.col(f"`{c}`"), kinds[c]
        if c in DATES:
            col = col.try_cast("date")
        elif c in NUMBERS:
            col = col.try_cast(NUMBERS[c])
        elif c == "attributes" and kind == "string":
            col = F.from_json(col, PAIRS)
        elif c == "lat_lon" and kind in ("string", "binary"):
            col = wkb_point(col, kind == "string")
        out.append(col.alias(c))
    return metadata.select(*out)


def attributes_of(metadata: DataFrame) -> DataFrame:
    """acc, k, v: one row for each attribute of a typed table."""
    return metadata.select("acc", F.inline("attributes"))
