"""Quality rules: a threshold table compiled into one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import in_place

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on are this at from or an not have but which "
    "der die das und den von zu mit sich des auf ist im dem nicht ein eine als auch es an er sie "
    "le la les et en un une du des que qui dans pour par sur au il ne pas est ou ce plus se avec "
    "el los las y por con para una su al lo como del más o pero sus"
).split()

#: (rule, measure, least, greatest); a bound of None does not hold.
RULES = (
    ("mean_word_length", "word_chars / n_words", 2.0, 15.0),
    ("symbol_ratio", "n_symbols / n_words", None, 0.25),
    ("stop_word_ratio", "n_stop_words / n_words", 0.02, None),
    ("repeated_line_ratio", "n_dup_lines / n_lines", None, 0.50),
    ("bullet_line_ratio", "n_bullet_lines / n_lines", None, 0.90),
    ("ellipsis_line_ratio", "n_ellipsis_lines / n_lines", None, 0.50),
)


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in windows of three that stand twice or more. Windows
    are compared by a 64-bit hash of their three words; sorted with their positions, the
    repeated ones cover three words each, less what the next one covers too."""
    hashes = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    df = df.withColumn("w3", F.when(F.col("n_words") >= 3, F.slice(hashes, F.lit(1), F.greatest(F.col("n_words") - 2, F.lit(0)))))
    found = F.sort_array(F.transform("w3", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("w3", F.when(F.size(F.array_distinct("w3")) < F.size("w3"), found))
    same = F.filter("w3", lambda x, i: (x["h"] == F.get("w3", i + 1)["h"]) | (x["h"] == F.get("w3", i - 1)["h"]))
    df = df.withColumn("w3", F.sort_array(F.transform(same, lambda x: x["i"])))
    covered = F.transform("w3", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("w3", i + 1) - p, F.lit(3))))
    return df.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0))).drop("w3")


def measures(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the measures that the rules use added; null text counts as empty."""
    df = df.withColumn("t", F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumn("words", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)))
    df = df.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)))
    df = df.withColumns({
        "n_words": F.size("words"),
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.regexp_count("t", F.lit(SYMBOL)),
        "n_stop_words": F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_bullet_lines": F.size(F.filter("lines", lambda x: x.rlike(r"^[\x20\t]*[-*•]"))),
        "n_ellipsis_lines": F.size(F.filter("lines", lambda x: x.rlike(r"(?:\.\.\.|…)[\x20\t\r]*$"))),
    })
    df = _repeat_words(df).drop("t", "words", "lines")
    names = ["n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines", "n_repeat_words"]
    return df.withColumns({c: in_place(F.col(c)) for c in names})


def broken_rules(rules=RULES) -> Column:
    """The names of the rules that a row of measures breaks, as one array column."""
    out = []
    for name, measure, least, greatest in rules:
        top, _, base = measure.partition(" / ")
        value = F.col(top) / F.greatest(F.col(base), F.lit(1))
        bad = F.lit(False)
        if least is not None:
            bad = bad | (value < least)
        if greatest is not None:
            bad = bad | (value > greatest)
        out.append(F.when(bad, F.lit(name)))
    return F.array_compact(F.array(*out))


def quality(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, broken) for every row.

    Words are runs of characters other than ASCII white space. ``base_failed`` holds with
    fewer than 50 words, or if more than half the words stand in repeated windows of
    three. ``kept`` needs that not to hold and no rule of the threshold table broken;
    ``broken`` names the broken ones. A null or empty text has no words and fails. Repeated
    rows are judged alike; columns beside id and text are ignored; an empty table gives none.
    """
    rows = measures(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (rows.withColumn("broken", broken_rules(rules)).withColumn("base_failed", base)
            .select("doc_id", *[F.col(c).cast("long").alias(c) for c in longs], "base_failed",
                    (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"), "broken"))


def passing(docs: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with their own columns only."""
    names = docs.columns
    held = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[text_col].alias("text"))
    rows = measures(held).where((F.col("n_words") >= 50) & (100 * F.col("n_repeat_words") <= 50 * F.col("n_words")))
    return rows.where(F.size(broken_rules(rules)) == 0).select("row.*")
