"""Merkle manifest of a data set: leaves, roots per group, and proofs by pointer jumping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import saved
from ferry.operators.ranking import places

#: Children of a node.
FAN = 8
#: Leaves in a row that share a join key with each of their ancestors.
BLOCK = FAN ** 5


def digest(*parts: Column) -> Column:
    """SHA-256 (binary) of texts end to end."""
    return F.unhex(F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_of(values: list[Column]) -> Column:
    """A row's leaf: of each value ``-`` if null, else its count of UTF-8 bytes, a colon
    and the value; integers in decimal."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _join(kids: Column) -> Column:
    return F.lower(F.array_join(F.transform(kids, lambda k: F.hex(k["digest"])), ""))


def _tree(nodes: DataFrame, most: int) -> tuple[DataFrame | None, DataFrame]:
    """(pointers, roots) of the trees over ``nodes`` (node, tree, pos, digest, n, lo, hi,
    row), n the nodes of the tree at that height, the greatest of them ``most``."""
    pointers, roots, level = None, None, 0
    while True:
        done = nodes.where("n = 1").drop("n")
        roots = done if roots is None else roots.union(done)
        if most <= 1:
            return pointers, roots
        level += 1
        runs = saved(nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {FAN}").alias("pos")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "digest", "node", "lo", "hi", "row"))).alias("kids"), F.first("n").alias("n")))
        runs = runs.withColumn("node", F.concat_ws("/", "tree", F.lit(level), "pos"))
        whole = _join(F.col("kids"))
        size = 64
        kids = runs.select(F.col("node").alias("anc"), whole.alias("whole"), F.posexplode("kids").alias("i", "kid")).select(
            "kid.node", "anc", "kid.lo", "kid.hi", "kid.digest", "kid.row",
            F.struct(F.unhex(F.expr(f"substring(whole, 1, {size} * i)")).alias("l"),
                     F.unhex(F.expr(f"substring(whole, {size} * (i + 1) + 1)")).alias("r")).alias("seg"))
        pointers = kids if pointers is None else pointers.union(kids)
        nodes = runs.select("node", "tree", "pos", digest(whole).alias("digest"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
                            F.array_min("kids.lo").alias("lo"), F.array_max("kids.hi").alias("hi"), F.lit(None).cast(nodes.schema["row"].dataType).alias("row"))
        most = -(-most // FAN)


def _blocks(ancestors: DataFrame) -> DataFrame:
    """``ancestors`` once per block of leaves below them, so that no join key holds more
    than ``BLOCK`` leaves and their inner nodes, whatever the height."""
    return ancestors.select(F.col("node").alias("anc"), F.col("anc").alias("next"), F.col("segs").alias("more"),
                            F.explode(F.expr(f"sequence(lo div {BLOCK}, hi div {BLOCK})")).alias("block"))


def _doubled(nodes: DataFrame, ancestors: DataFrame) -> DataFrame:
    """``nodes`` with their ancestors' segments behind their own, and those ancestors'
    ancestors. An ancestor without a row is the root, where nodes stay."""
    rest = [c for c in nodes.columns if c not in ("anc", "segs")]
    return nodes.join(_blocks(ancestors), ["anc", "block"], "left").select(
        *rest, F.coalesce("next", "anc").alias("anc"), F.when(F.col("more").isNull(), F.col("segs")).otherwise(F.concat("segs", "more")).alias("segs"))


def folded(leaf: Column, segs: Column) -> Column:
    """The digest that a leaf and the siblings on its way up give."""
    return F.aggregate(segs, leaf, lambda at, s: digest(hexed(s["l"]), hexed(at), hexed(s["r"])))


def proofs(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
           id_col: str = "doc_id", group_col: str = "lang", keep: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, group, leaf, subroot, root, segs, *keep) for every row of ``docs``; digests
    are binary, ``keep`` are expressions on the row.

    Leaves (``leaf_of`` over ``columns``) of one group ascend by id, nulls first, ties by
    their digest. While a level has several nodes, every ``FAN`` consecutive ones become
    the digest of their hex texts, a last run of fewer too; what remains is the group's
    subroot. The subroots by group, null first and then by UTF-8 bytes, give the root in
    the same way. ``segs`` are the siblings left and right of the way from the leaf to the
    root, a pair per level: none where the leaf is the root.

    Each node starts with its parent and the siblings beside it. Self-joins then double
    the distance to the ancestor and append its segments, so their number is the logarithm
    of the height. Leaves take their places from a range partitioning, so a group of any
    size spreads over all tasks, and join ancestors block by block.

    Rows that repeat (an id or all of a row) are leaves of their own. A null or empty text
    is a value like any other. An empty table gives no row. Columns not named are ignored.
    """
    keep = keep or {}
    rows = saved(docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[group_col].cast("string").alias("group"),
        F.coalesce(F.concat(F.lit("="), docs[group_col].cast("string")), F.lit("")).alias("tree"),
        leaf_of([docs[c] for c in columns]).alias("leaf"), F.struct(*[v.alias(k) for k, v in keep.items()], F.lit(0).alias("_")).alias("kept")))
    placed = saved(places(rows, [F.col("doc_id").asc_nulls_first(), F.col("leaf")], ["tree"]))
    most = placed.agg(F.max("group_size")).first()[0] or 0
    if not most:
        empty = "array<struct<l: binary, r: binary>>"
        return placed.select("doc_id", "group", "leaf", F.col("leaf").alias("subroot"), F.col("leaf").alias("root"),
                             F.array().cast(empty).alias("segs"), *[F.col("kept")[k].alias(k) for k in keep])
    row = F.struct("doc_id", "group", "kept", F.col("group_size").alias("held"))
    leaves = placed.select(F.concat_ws("/", "tree", F.lit(0), "place").alias("node"), "tree", F.col("place").alias("pos"), F.col("leaf").alias("digest"),
                           F.col("group_size").alias("n"), F.col("overall").alias("lo"), F.col("overall").alias("hi"), row.alias("row"))
    inner, subroots = _tree(leaves, most)
    tops = places(subroots.drop("pos"), [F.col("tree")])
    tops = saved(tops.select("node", F.lit("T").alias("tree"), F.col("place").alias("pos"), "digest", F.col("group_size").alias("n"), "lo", "hi", "row"))
    groups = tops.count()
    upper, roots = _tree(tops, groups)
    root = roots.first()["digest"]
    pointers = [p for p in (inner, upper) if p is not None]
    nothing = F.array().cast("array<struct<l: binary, r: binary>>")
    if pointers:
        every = pointers[0] if len(pointers) == 1 else pointers[0].union(pointers[1])
        every = every.withColumn("segs", F.array("seg")).drop("seg").withColumn("block", F.expr(f"lo div {BLOCK}"))
        up = saved(every.where("row is null").drop("row", "digest"))
        ways = every.where("row is not null").drop("node", "hi")
        height = sum(_height(x) for x in (most, groups))
        reach = 1
        while reach < height:
            ways = _doubled(ways, up)
            reach *= 2
            if reach < height:
                up = saved(_doubled(up, up))
    else:  # one row in all
        ways = leaves.select("lo", "digest", "row", nothing.alias("segs"))
    own = F.slice("segs", F.lit(1), sum(((F.col("row.held") > FAN ** k).cast("int") for k in range(21)), F.lit(0)))
    return ways.select(F.col("row.doc_id").alias("doc_id"), F.col("row.group").alias("group"), F.col("digest").alias("leaf"),
                       folded(F.col("digest"), own).alias("subroot"), F.lit(bytes(root)).alias("root"), "segs",
                       *[F.col("row.kept")[k].alias(k) for k in keep])


def _height(nodes: int) -> int:
    """Levels above ``nodes`` leaves."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


def proof_text(segs: Column) -> Column:
    """All siblings of a proof in hex, level by level, left to right."""
    return F.array_join(F.transform(segs, lambda s: F.concat(hexed(s["l"]), hexed(s["r"]))), "")


def verified(rows: DataFrame, leaf: Column) -> DataFrame:
    """``rows`` of ``proofs`` with ``folded_root``, recomputed from ``leaf`` and the row's
    siblings, and ``verified``, whether it is the root."""
    return rows.withColumn("folded_root", folded(leaf, F.col("segs"))).withColumn("verified", F.col("folded_root") == F.col("root"))
