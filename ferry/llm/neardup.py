"""MinHash near-duplicate detection with an LSH forest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm import words as W
from ferry.llm.common import saved, shipped, text_slices
from ferry.llm.components import components
from ferry.llm.filters import id_bitmap, id_hash, passes

#: Trees of the forest, hashes of a tree's label, and the depths at which regions may end.
TREES, LABEL = 16, 8
DEPTHS = (2, 3, 4, 5, 6, 8)
HASHES = TREES * LABEL
#: A region of more documents is divided at the next depth.
REGION = 64
#: Documents of either side that a task's unit of a family compares.
UNIT = 512
#: Hash slots in which shingles are counted to order them by rarity (a byte each).
SLOTS = 1 << 22
#: Documents' rows that a partition of what is kept between steps holds.
PART = 10_000
#: Agreement of signatures below which a candidate is not compared: at similarity 0.75
#: agreement has a standard error of 0.038, so this lies four of them below.
LEAST_AGREEMENT = 0.60


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``size`` words; with fewer
    words the whole sequence is the only one; without words the set is empty."""
    words = W.split(data, bounds, "spaced")
    hashes, at = W.grams(words, tuple(range(size)))
    cut = np.searchsorted(at, words.of)
    out = []
    factors = W.constants(size, 1)
    for i, n in enumerate(words.counts()):
        if n >= size:
            out.append(np.unique(hashes[cut[i] : cut[i + 1]]))
        elif n:
            own = words.hash[words.of[i] : words.of[i + 1]]
            out.append(W.mix(np.array([(own * factors[:n]).sum()], W.U64) + W.U64(n)))
        else:
            out.append(np.zeros(0, W.U64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set."""
    a, b = W.constants(HASHES, 11), W.constants(HASHES, 12)
    least = np.full(HASHES, np.iinfo(np.uint64).max, W.U64)
    for i in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[i : i + 2048, None] * a + b).min(0), out=least)
    return (least >> W.U64(32)).astype(np.uint32)


def signatures(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, digest, sig): digest of the whole set, big-endian signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in text_slices(batch.column(1)):
                sets = shingle_sets(data, bounds, size)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, end - first),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s).astype(">u4").tobytes() if len(s) else None for s in sets], pa.binary()),
                ], names=["id", "n_shingles", "digest", "sig"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id bigint, n_shingles bigint, digest binary, sig binary")


def regions(classes: DataFrame) -> DataFrame:
    """(region, rep, label, n, tree): every tree's documents by region."""
    return _regions(classes)[0]


def _regions(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``regions``, and (rep) of the documents that the least depth leaves in a region of more
    than ``REGION``.

    A region holds the documents whose labels share a prefix, at the least depth at which
    there are at most ``REGION`` of them; regions of one document are left out. Where
    even whole labels are shared by more (nearly equal texts), the region is dealt into
    parts by a hash of the id, each with the region's smallest id in it, so that no part
    grows with the region; every tree deals in another way.
    """
    parts = classes.rdd.getNumPartitions()
    rows = saved(classes.select("rep", "n", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)),
                 lambda t: F.substring(F.col("sig"), t * (4 * LABEL) + 1, F.lit(4 * LABEL)))).alias("tree", "label")))
    out = []
    for depth in DEPTHS:
        key = F.xxhash64(F.lit(depth), F.col("tree"), F.substring("label", 1, 4 * depth))
        keyed = rows.drop("held").withColumn("region", key)
        counts = keyed.groupBy("region").agg(F.count("*").alias("held"), F.min("rep").alias("lead")).where("held > 1")
        found = keyed.join(counts, "region")
        if depth != DEPTHS[-1]:
            found = saved(found.coalesce(parts))
            out.append(found.where(F.col("held") <= REGION).drop("held", "lead"))
            rows = found.where(F.col("held") > REGION).drop("region", "lead")
            if depth == DEPTHS[0]:
                crowded = saved(rows.select("rep").distinct().coalesce(parts))
    part = F.when(F.col("held") <= REGION, F.lit(0)).otherwise(
        F.pmod(F.xxhash64("rep", "tree"), F.ceil(F.col("held") / (REGION // 2)).cast("long")))
    dealt = saved(found.withColumn("region", F.xxhash64("region", part)).coalesce(parts))
    leads = (dealt.where(F.col("held") > REGION).select("region", "lead").distinct().alias("x")
             .join(dealt.alias("y"), F.col("x.lead") == F.col("y.rep"))
             .select("x.region", "y.rep", "y.n", "y.tree", "y.label").dropDuplicates(["region", "rep"]))
    columns = ["region", "rep", "n", "tree", "label"]
    every = dealt.select(columns).union(leads).dropDuplicates(["region", "rep"])
    for part in out:
        every = every.union(part.select(columns))
    return every, crowded


def rarity(texts: DataFrame, shared: Broadcast, size: int) -> np.ndarray:
    """For each of ``SLOTS`` hash slots a level that ascends with the number of shingles that
    the documents in ``shared``'s bitmap have in it: 0 for one at most. Its size is fixed
    whatever the table's; a fuller one orders less finely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(shared.value, id_hash(batch.column(0).to_numpy()))))
            for _, _, data, bounds in text_slices(batch.column(1)):
                taken, n = np.unique(slots(np.concatenate(shingle_sets(data, bounds, size))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(taken.astype(np.int32)), pa.array(n)], names=["slot", "n"])

    sums = texts.mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1")
    # whole numbers up to 100, from there on some ten a power of two
    level = F.when(F.col("n") <= 100, F.col("n")).otherwise(F.least(100 + F.floor(10 * F.log2(F.col("n") / 100)), F.lit(255)))
    found = sums.select("slot", level.cast("short").alias("level")).toArrow()
    out = np.zeros(SLOTS, np.uint8)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out


def slots(shingles: np.ndarray) -> np.ndarray:
    return (W.mix(shingles) >> W.U64(65 - SLOTS.bit_length())).astype(np.int64)


def rarest(shingles: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """Of a set's ``n`` shingles the first ``n`` - ceil(n * percent / 100) + 1 by level, then
    hash, without those of level 0, which no other set holds."""
    level = levels[slots(shingles)]
    first = np.lexsort((shingles, level))[: len(shingles) * (100 - percent) // 100 + 1]
    return shingles[first[level[first] > 0]]


def rare_regions(crowded: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(region, rep, holders): for the documents in ``crowded``, a region for each shingle
    among their rarest that another of them has among its own.

    Two linked sets share a shingle among the rarest ``n`` - ceil(n * percent / 100) + 1 of
    each, in any one order of all shingles; here they ascend by ``rarity``. Those that no
    other holds come first and take places, but need no region. So every link between
    crowded documents stands in some region, however many documents it has, and only the
    rarest shingles, about a quarter, are written and joined."""
    context = crowded.sparkSession.sparkContext
    shared = context.broadcast(id_bitmap(crowded, crowded.rdd.getNumPartitions()))
    levels = context.broadcast(rarity(texts, shared, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(shared.value, id_hash(batch.column(0).to_numpy()))))
            for first, end, data, bounds in text_slices(batch.column(1)):
                own = [rarest(x, levels.value, percent) for x in shingle_sets(data, bounds, size)]
                rows = np.repeat(np.arange(first, end), [len(x) for x in own])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(np.concatenate(own).view(np.int64))], names=["rep", "h"])

    rows = saved(texts.mapInArrow(run, "rep bigint, h bigint").distinct())
    some = rows.groupBy("h").agg(F.count("*").alias("holders")).where("holders > 1")
    return rows.join(some, "h").select(F.xxhash64(F.lit("rare"), "h").alias("region"), "rep", "holders")


def families(large: DataFrame, named: DataFrame) -> DataFrame:
    """(region, rep): units that every two documents of ``large`` (region, rep) which share a
    region there, and are in different components of ``named`` (rep, component), meet in.

    Components that share a region are a family. In it the documents outside its most
    frequent component are dealt against all of it, so no unit grows with the family and
    the documents that are connected already don't meet."""
    parts = named.rdd.getNumPartitions()
    tagged = saved(large.join(named, "rep").coalesce(parts))
    live = tagged.groupBy("region").agg(F.min("component").alias("b"), F.max("component").alias("x")).where("b <> x").select("region", "b")
    edges = saved(tagged.select("region", F.col("component").alias("a")).distinct().join(live, "region").where("a <> b").select("a", "b").distinct().coalesce(parts))
    family = components(edges).select(F.col("id").alias("component"), F.col("component_id").alias("family"))
    members = saved(tagged.select("rep", "component").distinct().join(family, "component").coalesce(parts))
    sizes = members.groupBy("family", "component").agg(F.count("*").alias("n")).groupBy("family").agg(
        F.sum("n").alias("m"), F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("of_main"))
    cuts = [F.ceil(F.col(c) / UNIT).cast("long").alias(name) for c, name in (("m", "rights"), ("others", "lefts"))]
    dealt = members.join(sizes.withColumn("others", F.expr("m - of_main")).select("family", "main", *cuts), "family")
    right = dealt.select("family", "rep", F.explode(F.expr("sequence(0, lefts - 1)")).alias("i"), F.expr("pmod(xxhash64(rep), rights)").alias("j"))
    left = dealt.where("component <> main").select("family", "rep", F.expr("pmod(xxhash64(rep, 1), lefts)").alias("i"), F.explode(F.expr("sequence(0, rights - 1)")).alias("j"))
    return right.union(left).select(F.xxhash64("family", "i", "j").alias("region"), "rep").distinct()


def linked(units: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) that connect, in each unit (region, rep), all components which
    links between its documents connect; ``classes`` are (rep, sketch, component), ``sets``
    (id, shingles). A pair whose components a link of the unit connects is not compared."""
    rows = units.join(classes, "rep").join(sets.withColumnRenamed("id", "rep"), "rep").select("region", "rep", "component", "sketch", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            part = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held else pa.Table.from_batches([batch])
            region = part.column(0).to_numpy()
            cuts = np.flatnonzero(np.r_[True, region[1:] != region[:-1]]) if len(region) else [0]
            for first, end in zip(cuts[:-1], cuts[1:], strict=True):
                yield links(part.slice(first, end - first))
            held = part.slice(cuts[-1]).combine_chunks()
        if held:
            yield links(held)

    def links(unit: pa.Table) -> pa.RecordBatch:
        rep, component = unit.column(1).to_numpy(), unit.column(2).to_numpy()
        sketch = np.frombuffer(b"".join(unit.column(3).to_pylist()), np.uint8).reshape(-1, HASHES)
        shingles = [np.frombuffer(x, W.U64) for x in unit.column(4).to_pylist()]
        n = np.array([len(x) for x in shingles])
        at = np.arange(len(rep))
        names = np.unique(component, return_inverse=True)[1]
        found = []
        for i in range(len(rep)):
            small, large = np.minimum(n[i], n[i + 1 :]), np.maximum(n[i], n[i + 1 :])
            j = at[i + 1 :][(100 * small >= percent * large) & (names[i + 1 :] != names[i])]
            same = (sketch[j] == sketch[i]).mean(1)
            j, same = j[same >= LEAST_AGREEMENT], same[same >= LEAST_AGREEMENT]
            for k in j[np.argsort(-same, kind="stable")]:
                if names[i] == names[k]:
                    continue
                both = len(np.intersect1d(shingles[i], shingles[k], assume_unique=True))
                if 100 * both >= percent * (n[i] + n[k] - both):
                    found.append((min(rep[i], rep[k]), max(rep[i], rep[k])))
                    names[names == names[k]] = names[i]
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], pa.int64()) for c in (0, 1)], names=["a", "b"])

    return rows.repartition("region").sortWithinPartitions("region", "rep").mapInArrow(run, "a bigint, b bigint")


def neighbours(regions: DataFrame, classes: DataFrame, threshold: float, spanning: bool) -> DataFrame:
    """(a, b, agreement) with a < b: documents of different ``component`` that meet in a
    region, whose set sizes allow the threshold and whose
    signatures agree enough. ``spanning``: of each region only the pairs of a greatest
    spanning forest by agreement, fewer than its documents; else all of them.

    ``classes`` are (rep, n, sketch, component)."""
    rows = regions.join(classes, "rep").select("region", "rep", "n", "component", "sketch")
    rows = rows.repartition("region").sortWithinPartitions("region", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = tuple(batch.column(i).to_numpy() for i in (0, 1, 2, 3)) + (
                np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, HASHES),)
            part = tuple(np.concatenate(x) for x in zip(held, now, strict=True)) if held else now
            keep = np.flatnonzero(part[0] == part[0][-1])[0] if len(part[0]) else 0
            yield from pairs(*(x[:keep] for x in part))
            held = tuple(x[keep:] for x in part)
        if held:
            yield from pairs(*held)

    def pairs(region, rep, n, component, sketch):
        found = []
        for lag in range(1, len(region)):
            at = np.flatnonzero(region[lag:] == region[:-lag])
            if not len(at):
                break
            small, large = np.minimum(n[at], n[at + lag]), np.maximum(n[at], n[at + lag])
            at = at[(small >= threshold * large) & (component[at] != component[at + lag])]
            for cut in range(0, len(at), 50_000):
                i = at[cut : cut + 50_000]
                same = (sketch[i] == sketch[i + lag]).mean(1)
                ok = same >= LEAST_AGREEMENT
                found.append((i[ok], i[ok] + lag, same[ok]))
        if not found:
            return
        x, y, same = (np.concatenate(f) for f in zip(*found))
        if spanning:
            keep = forest(x, y, same, len(region))
            x, y, same = x[keep], y[keep], same[keep]
        a, b = rep[x], rep[y]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(same)], names=["a", "b", "agreement"])

    return rows.mapInArrow(run, "a bigint, b bigint, agreement double").groupBy("a", "b").agg(F.max("agreement").alias("agreement"))


def forest(x: np.ndarray, y: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The edges (places in ``x``, ``y``) of a spanning forest of ``n`` nodes of greatest
    weight: in each round every tree takes its heaviest edge out, until none is left."""
    order = np.argsort(-weight, kind="stable")
    ends, tree, taken = (x[order], y[order]), np.arange(n), []
    rank = np.arange(len(order))
    while len(rank):
        u, v = tree[ends[0][rank]], tree[ends[1][rank]]
        out = u != v
        rank, u, v = rank[out], u[out], v[out]
        best = np.full(n, len(order))
        np.minimum.at(best, u, rank)
        np.minimum.at(best, v, rank)
        chosen = np.unique(best[best < len(order)])
        taken.append(chosen)
        u, v = tree[ends[0][chosen]], tree[ends[1][chosen]]
        while len(u):  # the smallest name of those joined
            least = np.minimum(tree[u], tree[v])
            np.minimum.at(tree, u, least)
            np.minimum.at(tree, v, least)
            while (tree[tree] != tree).any():
                tree = tree[tree]
            apart = tree[u] != tree[v]
            u, v = tree[u[apart]], tree[v[apart]]
    return order[np.concatenate(taken)] if taken else order[:0]


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on their full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), W.U64), np.frombuffer(y.as_buffer(), W.U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    A document's set holds its distinct shingles of ``size`` words, A-Z lower-cased; a
    text of fewer words is one shingle, a null, empty or wordless text has none and is
    linked with nothing. Documents are linked if 100 * intersection >= ``percent`` *
    union; ``component_id`` is the smallest id that can be reached over links.

    Documents of equal sets become one class. Each class gets a MinHash signature, which
    the trees of an LSH forest sort in different orders; classes that share the longest
    label prefixes are candidates, at a depth that adapts to how crowded the region is.
    Classes of crowded regions are candidates of all those they share one of their rarest
    shingles with too, so that dividing a region loses none of its links.

    Candidates are confirmed on full sets, in two rounds. Each region first offers a
    spanning forest of its candidates by agreement, fewer than a row a document, and every
    class's most agreeing smaller partner among these is compared. Then every region
    offers its candidates whose ends are in different components; of a shingle that more
    than ``REGION`` hold they are dealt over units and compared there. So each candidate pair is
    either compared or connected by compared links, and a family's pairs are never all
    written.

    Rows with a null id are left out. Rows that repeat an id are one document: its set is
    that of the row whose set's digest is smallest, each row is returned with its own
    number of shingles and the document's component. Other columns of ``docs`` are
    ignored. An empty table gives an empty result.
    """
    docs = shipped(docs).where(F.col(id_col).isNotNull())
    all_docs = saved(signatures(docs, size, id_col, text_col))
    # ids of several sets stand for one of them
    several = saved(all_docs.groupBy("id").agg(F.min("digest").alias("own"), F.max("digest").alias("most"), F.count("*").alias("n"), F.count("digest").alias("m"))
                    .where("n > 1 and (own <> most or (m > 0 and m < n))").select("id", "own"))
    parts = max(1, -(-all_docs.count() // PART))
    kept = all_docs.where("digest is not null")
    repeated = bool(several.head(1))
    if repeated:
        kept = kept.join(several, "id", "left").where("own is null or own = digest").drop("own")
    classes = saved(kept.groupBy("digest").agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")).coalesce(parts))
    # the low byte of each hash
    low = F.expr("aggregate(sequence(4, %d, 4), cast('' as binary), (x, i) -> concat(x, substring(sig, i, 1)))" % (4 * HASHES))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    every, crowded = _regions(classes)
    every = every.select("region", "rep")
    rare = saved(rare_regions(crowded, texts, size, percent).coalesce(parts)) if crowded.head(1) else None
    every = every.union(rare.where(F.col("holders") <= REGION).select(every.columns)) if rare is not None else every
    every = saved(every.coalesce(parts))
    sketches = classes.select("rep", "n", low.alias("sketch"))
    found = neighbours(every, sketches.withColumn("component", F.col("rep")), percent / 100, True)

    def sets_of(ids: DataFrame) -> DataFrame:
        """(id, shingles) of the classes in ``ids`` (id), read from the rows they stand for."""
        chosen = ids.sparkSession.sparkContext.broadcast(id_bitmap(ids, parts))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                batch = batch.filter(pa.array(passes(chosen.value, id_hash(batch.column(0).to_numpy()))))
                for first, end, data, bounds in text_slices(batch.column(1)):
                    sets = shingle_sets(data, bounds, size)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(first, end - first),
                        pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in sets], pa.binary()),
                        pa.array([x.tobytes() for x in sets], pa.binary()),
                    ], names=["id", "digest", "shingles"])

        wanted = ids.distinct().join(classes.select(F.col("rep").alias("id"), F.col("digest").alias("own")), "id")
        # no equality, which Spark would deal the rows by as well
        return (texts.mapInArrow(run, "id bigint, digest binary, shingles binary").join(wanted, "id")
                .where("digest >= own and digest <= own").select("id", "shingles").dropDuplicates(["id"]))

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("id")).union(pairs.select("b"))

    best = saved(found.groupBy("b").agg(F.max_by("a", F.struct("agreement", F.negate("a"))).alias("a")).select("a", "b").coalesce(parts))
    links = saved(confirmed(best, sets_of(ends(best)), percent))
    known = components(links)
    # a region whose documents are all connected has nothing more to offer
    named = saved(classes.select("rep").join(known.withColumnRenamed("id", "rep"), "rep", "left").select("rep", F.coalesce("component_id", "rep").alias("component")).coalesce(parts))
    live = every.join(named, "rep").groupBy("region").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("region")
    last = saved(neighbours(every.join(live, "region"), sketches.join(named, "rep"), percent / 100, False).select("a", "b").join(best, ["a", "b"], "left_anti").coalesce(parts))
    large = rare.where(F.col("holders") > REGION).select("region", "rep") if rare is not None else None
    units = saved(families(large, named).coalesce(parts)) if large is not None and large.head(1) else None
    ids = ends(last).union(units.select("rep")) if units is not None else ends(last)
    more = None
    if ids.head(1):
        sets = sets_of(ids)
        more = confirmed(last, sets, percent)
        more = more.union(linked(units, sketches.join(named, "rep"), sets, percent)) if units is not None else more
    if more is not None:
        more = saved(more)
        known = components(links.union(more)) if more.head(1) else known
    member = classes.select("digest", "rep").join(known.withColumnRenamed("id", "rep"), "rep", "left").select(
        "digest", F.coalesce("component_id", "rep").alias("component_id"))
    if repeated:
        all_docs = all_docs.join(several, "id", "left").withColumn("digest", F.coalesce("own", "digest")).drop("own")
    return (all_docs.join(member, "digest", "left")
            .select(F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))
