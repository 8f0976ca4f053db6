"""Line dedup: globally repeated multi-line chunks, found by rolling hashes over line hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import in_place, saved

#: Lines that the rolling hash spans, which is the smallest chunk that can go.
WINDOW = 2
#: Parts in which the rows of a common window meet what is known of it.
DEAL = 4


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _dealt(df: DataFrame, *by: str) -> DataFrame:
    return df.withColumn("deal", F.pmod(F.xxhash64(*by), F.lit(DEAL)).cast("int"))


def _to_all(df: DataFrame) -> DataFrame:
    return df.withColumn("deal", F.explode(F.expr(f"sequence(0, {DEAL - 1})")))


def windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, of, h, at): the rolling hash of every ``WINDOW`` lines in a row and the first
    of them; ``of`` is the text's hash. A hash depends on its own lines alone, so what is
    inserted elsewhere, or in another text, moves nothing."""
    df = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("of"), in_place(F.transform(_split(F.col(text_col)), lambda x: F.xxhash64(x))).alias("lines"))
    rolled = F.transform("lines", lambda x, i: F.xxhash64(x, *[F.get("lines", i + k) for k in range(1, WINDOW)]))
    return df.where(F.size("lines") >= WINDOW).select("doc_id", "of", F.posexplode(F.slice(rolled, F.lit(1), F.size("lines") - (WINDOW - 1))).alias("at", "h"))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, of, at, first): windows whose very bytes stand elsewhere too, and whether this
    is the first place by id and line, which keeps them.

    Hashes that occur once are dropped first; the bytes of the rest are compared by their
    SHA-256. A window that holds much of all lines is counted where it stands, and what is
    known of it meets its rows in ``DEAL`` parts. White space alone is never repeated."""
    rows = windows(docs, id_col, text_col)
    often = saved(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    hit = _dealt(rows, "doc_id", "at").join(_to_all(often), ["h", "deal"], "left_semi").groupBy("doc_id", "of").agg(F.collect_set("at").alias("places"))
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("of"), F.col(text_col).alias("text"))
    df = df.join(hit, ["doc_id", "of"]).select("doc_id", "of", "places", in_place(_split(F.col("text"))).alias("lines"))
    texts = df.select("doc_id", "of", F.explode(F.transform("places", lambda i: F.struct(
        i.alias("at"), F.array_join(F.slice("lines", i + 1, F.lit(WINDOW)), "\n").alias("chunk")))).alias("w")).select("doc_id", "of", "w.*")
    texts = saved(texts.where(F.col("chunk").rlike(r"[^\x20\x09-\x0D]")).select(
        "doc_id", "of", "at", F.unhex(F.sha2(F.col("chunk").cast("binary"), 256)).alias("digest")))
    own = F.struct("doc_id", "at", "of")
    keepers = texts.groupBy("digest").agg(F.min(own).alias("keeper"), F.max(own).alias("last")).where("keeper <> last").drop("last")
    return _dealt(texts, "doc_id", "at").join(_to_all(keepers), ["digest", "deal"]).select(
        "doc_id", "of", "at", (own == F.col("keeper")).alias("first")).distinct()


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, of, cut): the lines of each text that go. Windows that follow or overlap one
    another make up a chunk; its bounds are where a window stops repeating. A line goes
    that is in a window whose first place is elsewhere, and in none whose first place this is."""
    def lines(of: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(of, lambda i: F.sequence(i, i + (WINDOW - 1)))))

    per_text = repeated_windows(docs, id_col, text_col).groupBy("doc_id", "of").agg(
        F.collect_list(F.when(~F.col("first"), F.col("at"))).alias("again"), F.collect_list(F.when(F.col("first"), F.col("at"))).alias("here"))
    return per_text.select("doc_id", "of", F.array_except(lines(F.col("again")), lines(F.col("here"))).alias("cut")).where(F.size("cut") > 0)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated multi-line chunks cut out of ``text``; adds ``n_lines`` (of
    the text before) and ``n_removed_lines``.

    Of equal chunks the one in the smallest id stays, there the first. A text without
    repeated chunks stays as it is, null included. Rows with a null id stay as they are
    and are no one's copy; equal rows are one document, rows of one id with different
    texts are ordered by the line. An empty table gives none. Columns named like the added
    ones raise.
    """
    if clash := {"n_lines", "n_removed_lines"} & set(docs.columns):
        raise ValueError(f"columns already exist: {sorted(clash)}")
    cut = repeated_lines(docs, id_col, text_col)
    every = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("of"))
    rows = every.join(cut, ["doc_id", "of"], "left").withColumn("lines", in_place(_split(F.col(f"row.{text_col}"))))
    rows = rows.withColumn("gone", in_place(F.coalesce("cut", F.array().cast("array<int>"))))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.transform(left, lambda i: F.get("lines", i))
    text = F.when(F.col("cut").isNull(), F.col("row")[text_col]).otherwise(F.array_join(kept, "\n"))
    return rows.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns],
                       F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed_lines"))
