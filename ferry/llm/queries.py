"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.common import table


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, formatted and read back."""
    from ferry.llm.chat import digests, windows

    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(windows(turns.union(extra)))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document by the byte-level rank file."""
    import public_tokenizers

    from ferry.llm.bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    from ferry.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the quality rules for every document."""
    from ferry.llm.quality import quality

    return quality(table(spark, sf_dir, "documents")).withColumn("broken", F.array_join("broken", ","))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated multi-line chunks."""
    from ferry.llm.linededup import line_dedup

    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed_lines", "text")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and texts of every document."""
    from ferry.llm.licenses import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers, plain and disguised, of every document."""
    from ferry.llm.pii import personal_data

    return personal_data(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of all documents that repeat text standing elsewhere."""
    from ferry.llm.substrings import repeated_spans

    return repeated_spans(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of all documents with all benchmark items."""
    from ferry.llm.decontam import contaminations

    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    from ferry.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components of near ones."""
    from ferry.llm.simhash import simhash_duplicates

    return simhash_duplicates(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of all documents, by language."""
    from ferry.llm.phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, checked after some texts were lower-cased."""
    from ferry.llm.merkle import hexed, leaf_of, proof_text, proofs, verified

    docs = table(spark, sf_dir, "documents")
    names = ("doc_id", "source", "lang", "n_chars", "text")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = F.when(picked, leaf_of([lower if c == "text" else F.col(c) for c in names]))
    rows = verified(proofs(docs, names, keep={"changed": changed}), F.coalesce("changed", "leaf"))
    return rows.select("doc_id", hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"),
                       F.sha2(proof_text(F.col("segs")).cast("binary"), 256).alias("proof_sha256"), hexed(F.col("folded_root")).alias("folded_root"), "verified")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's result over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_chat_windows, op2_bpe, op3_near_duplicates, op4_quality_rules, op5_line_dedup, op6_license_scan,
    op7_personal_data, op8_substring_dedup, op9_decontamination, op10_language_id, op11_simhash,
    op12_phrases, op13_merkle_manifest, pipeline)}


def _quality_sql() -> str:
    """The quality measures and the verdict of the threshold table, in SQL."""
    from ferry.llm.quality import RULES, STOP_WORDS

    def broken(measure: str, least: float | None, greatest: float | None) -> str:
        top, _, base = measure.partition(" / ")
        value = f"({top} / CAST(greatest({base}, 1) AS DOUBLE))"
        return " OR ".join([f"{value} < {least}"] * (least is not None) + [f"{value} > {greatest}"] * (greatest is not None))

    word = r"[^\x20\x09-\x0D]+"
    rules = ", ".join(f"CASE WHEN {broken(m, a, b)} THEN '{name}' END" for name, m, a, b in RULES)
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS ls
  FROM documents),
place AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM split),
seen AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM place),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM seen WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT split.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(list_filter(ws, lambda w: lower(w) IN ({stop}))) AS n_stop_words,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\t]*[-*•]'))) AS n_bullet_lines,
         len(list_filter(ls, lambda x: regexp_matches(x, '(?:\.\.\.|…)[\x20\t\r]*$'))) AS n_ellipsis_lines,
         coalesce(covered.n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered ON covered.doc_id = split.doc_id),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             list_filter([{rules}], lambda x: x IS NOT NULL) AS bad FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND len(bad) = 0 AS kept, array_to_string(bad, ',') AS broken FROM v"""


PHRASES_SQL = r"""WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
split AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM piece),
total AS (SELECT lang, CAST(sum(len(ws)) AS HUGEINT) AS n FROM split GROUP BY lang),
place AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM split),
gram AS (SELECT lang, ws, i, unnest(range(1, least(5, len(ws) - i + 1) + 1)) AS m FROM place),
f AS (SELECT lang, ws[i:i + m - 1] AS g, m, count(*) AS f FROM gram GROUP BY ALL HAVING count(*) >= 100),
cand AS (SELECT lang, g, m, f AS a FROM f WHERE m > 1),
longer AS (SELECT lang, m, a, g, unnest(range(1, m)) AS k FROM cand),
inside AS (SELECT DISTINCT c.lang, c.g FROM cand c JOIN (SELECT lang, a, m, g, k, unnest(range(0, m - k + 1)) AS o FROM longer) x
  ON c.lang = x.lang AND c.m = x.k AND c.g = x.g[o + 1:o + x.k] AND 100 * x.a >= 100 * c.a),
cut AS (SELECT lang, g, m, a, unnest(range(1, m)) AS k FROM cand ANTI JOIN inside USING (lang, g)),
scored AS (
  SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r, CAST(n AS BIGINT) AS n, CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cut c JOIN total USING (lang) JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:c.m]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""

MERKLE_SQL = r"""WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS row, doc_id, lang,
         {leaf} AS leaf, CASE WHEN {picked} THEN {changed} END AS changed FROM documents),
leaf AS (SELECT *, coalesce('=' || lang, '') AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM doc),
node AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, n FROM leaf
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8 FROM node WHERE n > 1 GROUP BY tree, level, pos // 8, n),
sub AS (SELECT tree, level AS height, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (
  SELECT 0 AS level, pos, digest, n FROM sub
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY level, pos // 8, n),
every AS (SELECT tree, level, pos, digest, n FROM node UNION ALL SELECT '/top', level, pos, digest, n FROM top),
side AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM every a JOIN every b ON a.tree = b.tree AND a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY a.tree, a.level, a.pos),
up AS (
  SELECT row, leaf.tree, 0 AS level, leaf.pos, coalesce(changed, leaf) AS now, '' AS proof FROM leaf
  UNION ALL
  SELECT row, u.tree, u.level + 1, u.pos // 8, sha256(s.l || now || s.r), proof || s.l || s.r FROM up u JOIN side s ON s.tree = u.tree AND s.level = u.level AND s.pos = u.pos),
beyond AS (
  SELECT row, 0 AS level, sub.pos, now, proof FROM up JOIN sub ON sub.tree = up.tree AND sub.height = up.level
  UNION ALL
  SELECT row, o.level + 1, o.pos // 8, sha256(s.l || now || s.r), proof || s.l || s.r FROM beyond o JOIN side s ON s.tree = '/top' AND s.level = o.level AND s.pos = o.pos),
root AS (SELECT level, digest FROM top WHERE n = 1)
SELECT leaf.doc_id, leaf.leaf, sub.digest AS subroot, root.digest AS root, sha256(beyond.proof) AS proof_sha256, beyond.now AS folded_root, beyond.now = root.digest AS verified
FROM leaf JOIN sub ON sub.tree = leaf.tree CROSS JOIN root JOIN beyond ON beyond.row = leaf.row AND beyond.level = root.level"""


def _merkle_sql() -> str:
    """The proofs in SQL: trees level by level, then each leaf's way to the root. The CRC-32
    of the id is computed bit by bit."""
    def leaf(text: str) -> str:
        parts = ("doc_id", "source", "lang", "n_chars", text)
        return "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in parts) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    byte = "list_reduce(list_prepend(xor(c, CAST(ascii(x) AS BIGINT)), range(8)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
    crc = f"list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda y: CAST(ascii(y) AS BIGINT))), lambda c, x: {byte.replace('ascii(x)', 'x')})"
    return MERKLE_SQL.format(leaf=leaf("text"), changed=leaf(lower), picked=f"xor({crc}, 4294967295) % 3 = 0")


ORACLE_SQL: dict[str, str] = {"op4_quality_rules": _quality_sql(), "op12_phrases": PHRASES_SQL, "op13_merkle_manifest": _merkle_sql()}
