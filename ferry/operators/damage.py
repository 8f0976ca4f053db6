"""What became of a text that differs: re-decoded, truncated, nulled, or other.

Only keys whose digests differ fetch their texts. Everything is a column expression: the
longest common prefix by bisection over prefixes, the repair of double encoding by
decoding what reads as UTF-8 bytes once more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import named, text_digest
from ..manifest import Manifest, TableSet, TableSpec
from .parity import conformed, paired_columns, parity_tables

DOUBLE, TRUNCATED, NULLED, FILLED, OTHER = "double_encoded", "truncated", "nulled", "filled", "other"
SCHEMA = "table_name string, key string, column_name string, damage string, position bigint, source_char string, target_char string"

# The characters that code page 1252 shows for the bytes 80 to 9F, and those
# bytes as code points (five bytes are unassigned).
CP1252_SHOWN = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_BYTES = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
# A character of two to four UTF-8 bytes, each read as a character of its own.
READ_AS_BYTES = "[Â-ß][\u0080-¿]|[à-ï][\u0080-¿]{2}|[ð-ô][\u0080-¿]{3}"


def byte_view(text: Column) -> Column:
    """``text`` with code page 1252's own characters as the bytes they stand for."""
    return F.translate(text, CP1252_SHOWN, CP1252_BYTES)


def redecoded(text: Column) -> Column:
    """``text`` (in its ``byte_view``) with each run of characters that reads as the UTF-8
    bytes of one character turned into that character."""
    parts = F.split(text, READ_AS_BYTES, -1)
    found = F.regexp_extract_all(text, F.lit(READ_AS_BYTES), F.lit(0))
    fixed = F.transform(found, lambda x: F.decode(F.encode(x, "ISO-8859-1"), "UTF-8"))
    return F.array_join(F.zip_with(parts, fixed, lambda p, f: F.concat(p, F.coalesce(f, F.lit("")))), "")


def common_prefix(a: Column, b: Column) -> Column:
    """Characters that both texts begin with, found by bisection."""
    start = F.struct(F.lit(0).alias("low"), F.least(F.length(a), F.length(b)).alias("high"))

    def step(s, _):
        mid = F.ceil((s["low"] + s["high"]) / 2).cast("int")
        same = F.substr(a, F.lit(1), mid) == F.substr(b, F.lit(1), mid)
        return F.struct(F.when(same, mid).otherwise(s["low"]).alias("low"), F.when(same, s["high"]).otherwise(mid - 1).alias("high"))

    # 31 halvings end every length; a finished search stays as it is
    return F.aggregate(F.sequence(F.lit(1), F.lit(31)), start, lambda s, i: F.when(s["low"] >= s["high"], s).otherwise(step(s, i)), lambda s: s["low"])


def damage(source: Column, target: Column) -> Column:
    """The class of a differing pair: NULLED and FILLED where one side has no text,
    DOUBLE where decoding the target once more gives the source (all of it, or some of its
    characters where no others happen to read as bytes), TRUNCATED where the source
    only goes on, else OTHER."""
    return (F.when(target.isNull(), NULLED).when(source.isNull(), FILLED)
            .when(byte_view(redecoded(byte_view(target))) == byte_view(source), DOUBLE)
            .when(F.startswith(source, target), TRUNCATED).otherwise(OTHER))


def _char(text: Column, position: Column) -> Column:
    """The character at ``position`` as ``U+`` and its code point; null past the end."""
    one = F.substr(text, position, F.lit(1))
    return F.when(one != "", F.concat(F.lit("U+"), F.lpad(F.hex(F.ascii(one)), F.greatest(F.length(F.hex(F.ascii(one))), F.lit(4)), F.lit("0"))))


def table_damage(table: str, src: DataFrame, tgt: DataFrame, spec: TableSpec) -> DataFrame:
    """(table_name, key, column_name, damage, position, source_char, target_char): every
    differing text of keys that each side holds once, and where it begins to differ.

    The digests of both sides are grouped by key in one shuffle; the keys that differ, with
    their columns, then fetch their texts."""
    key, columns = list(spec.primary_key), paired_columns(spec, spec.primary_key)
    s, t = (conformed(df, [*key, *columns], spec.schema, spec.logical) for df in (src, tgt))
    keys = [f"_k{i}" for i in range(len(key))]

    def digests(df: DataFrame, tag: int) -> DataFrame:
        return df.select(*[named(k).alias(x) for k, x in zip(key, keys, strict=True)], F.lit(tag).alias("_side"),
                         *[text_digest(c).alias(f"_d{i}") for i, c in enumerate(columns)])

    own = [F.max(F.when(F.col("_side") == tag, F.col(f"_d{i}"))).alias(f"_d{i}_{tag}") for i in range(len(columns)) for tag in (0, 1)]
    pairs = digests(s, 0).unionByName(digests(t, 1)).dropna(subset=keys).groupBy(*keys).agg(
        F.count_if(F.col("_side") == 0).alias("_ns"), F.count_if(F.col("_side") == 1).alias("_nt"), *own)
    differs = [~F.col(f"_d{i}_0").eqNullSafe(F.col(f"_d{i}_1")) for i in range(len(columns))]
    hit = pairs.where((F.col("_ns") == 1) & (F.col("_nt") == 1) & reduce(lambda a, b: a | b, differs)).select(*keys)

    def texts(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[named(k).alias(x) for k, x in zip(key, keys, strict=True)], F.struct(*[named(c).alias(f"_c{i}") for i, c in enumerate(columns)]).alias(name))

    both = hit.join(texts(s, "_s"), keys).join(texts(t, "_t"), keys)
    shown = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"_s._c{i}").alias("s"), F.col(f"_t._c{i}").alias("t")) for i, c in enumerate(columns)]
    rows = both.select(shown.alias("key"), F.explode(F.array(*cells)).alias("x")).select("key", "x.*").where(~F.col("s").eqNullSafe(F.col("t")))
    place = F.when(F.col("s").isNotNull() & F.col("t").isNotNull(), common_prefix(F.col("s"), F.col("t")) + 1)
    rows = rows.withColumn("damage", damage(F.col("s"), F.col("t"))).withColumn("position", place)
    return rows.select(F.lit(table).alias("table_name"), "key", "column_name", "damage", F.col("position").cast("long").alias("position"),
                       _char(F.col("s"), F.col("position")).alias("source_char"), _char(F.col("t"), F.col("position")).alias("target_char"))


def text_damage(spark: SparkSession, source: TableSet, target: TableSet, manifest: Manifest, tables=None) -> DataFrame:
    """``table_damage`` of every common table (of ``tables``) that has a key and text."""
    parts = [table_damage(n, source[n], target[n], manifest[n]) for n in parity_tables(source, target)
             if (tables is None or n in tables) and n in manifest and manifest[n].primary_key and paired_columns(manifest[n], manifest[n].primary_key)]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], SCHEMA))


def damage_summary(rows: DataFrame) -> DataFrame:
    """(table_name, column_name, damage, n_rows, first_position): counts by class."""
    return rows.groupBy("table_name", "column_name", "damage").agg(F.count("*").alias("n_rows"), F.min("position").alias("first_position"))
