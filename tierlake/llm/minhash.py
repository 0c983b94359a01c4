"""Near duplicates by MinHash with tensored banding, confirmed on whole shingle sets.

Two collections of `SMALL` subkeys, each of `ROWS` minhashes, give SMALL x SMALL table keys, one for each pair of a subkey of
the first and one of the second: 60 minhashes serve 100 tables of 6. A pair of sets with similarity s meets in some
table with probability (1 - (1 - s^3)^10)^2, which is 0.9998 at s = 0.85 and rises from there; meeting is not counted as
a link before the whole sets have been compared.

Equal sets are joined first, so copies cost one row. Subkeys that only one set has are dropped before they are paired. In a
table, sets are compared with the smallest one, not with each other. Where a table still holds sets of several components
after that, those of different components are compared too if they share a rare shingle, as similar ones must.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.functions.storage import scratch_folder, unique_name
from tierlake.llm.common import as_list, columns, fresh, mixed, pieces, prefix_sums, runs, span_hashes, stored, utf8
from tierlake.llm.components import components

SHINGLE = 5
#: Sets are linked when PERCENT * |union| <= 100 * |intersection|.
PERCENT = 85
SMALL, ROWS = 10, 3
#: Bits of a set's marks, by which pairs that share too little are told without the sets.
MARKS = 512
#: Bits of the bitmap that tells which texts are needed once more (8 MB), and those of a row of it, which Spark gives.
FILTER_BITS, FILTER_BLOCK = 1 << 26, 8 * 4096

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_MIX = np.random.default_rng(10).integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FAMILY = np.random.default_rng(11).integers(1, 1 << 63, 2 * SMALL * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles; one for the whole sequence if it has fewer words."""
    data = _LOWER[data]
    starts, ends = runs(_IS_WORD[data], offsets)
    words = span_hashes(prefix_sums(data), starts, ends)
    n = max(0, len(words) - SHINGLE + 1)
    fives = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        fives += words[k : k + n] * _MIX[k]
    fives = mixed(fives)
    border = np.searchsorted(starts, offsets)
    found = []
    for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            found.append(np.unique(fives[a : b - SHINGLE + 1]))
        else:
            few = (words[a:b] * _MIX[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            found.append(mixed(np.array([few] if b > a else [], np.uint64)))
    return found


def subkeys(sets: list[np.ndarray]) -> np.ndarray:
    """2 * SMALL subkeys for each set, none of which is empty: the first SMALL are the first collection."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets)])[:-1]
    keys = np.zeros((len(sets), 2 * SMALL), np.uint64)
    for i, factor in enumerate(_FAMILY):
        hashes = flat * factor
        hashes ^= hashes >> np.uint64(32)
        hashes *= _FAMILY[i - 1]
        least = np.minimum.reduceat(hashes, at)
        keys[:, i // ROWS] = mixed(keys[:, i // ROWS] ^ least) + np.uint64(i // ROWS)
    return keys


def _signed(batches):
    for batch in pieces(batches):
        sets = shingles(*utf8(batch.column("text")))
        names = [_name(s) if len(s) else None for s in sets]
        full = [i for i, s in enumerate(sets) if len(s)]
        keys = np.zeros((0, 2 * SMALL), np.uint64) if not full else subkeys([sets[i] for i in full])
        sizes = np.zeros(len(sets), np.int64)
        sizes[full] = 2 * SMALL
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(names, pa.binary()),
                as_list(np.concatenate([[0], np.cumsum(sizes)]), keys.ravel().view(np.int64), pa.int64()),
            ],
            ["doc_id", "text_hash", "n_shingles", "node", "keys"],
        )


def _sets(batches):
    for batch in pieces(batches):
        sets = [s for s in shingles(*utf8(batch.column("text"))) if len(s)]
        if sets:
            flat = np.concatenate(sets).view(np.int64)
            names = pa.array([_name(s) for s in sets], pa.binary())
            own = as_list(np.cumsum([0, *map(len, sets)]), flat, pa.int64())
            bits = as_list(np.arange(len(sets) + 1) * (MARKS // 64), np.concatenate([marks(s) for s in sets]), pa.int64())
            yield pa.RecordBatch.from_arrays([names, own, bits], ["node", "shingles", "marks"])


def marks(shingle_set: np.ndarray) -> np.ndarray:
    """For each of MARKS classes of hashes whether the set has an odd number of them, as bits of MARKS / 64 integers.

    Where two sets' bits differ one of them has a shingle that the other lacks, which bounds what they share.
    """
    odd = np.bincount((shingle_set >> np.uint64(20)) % np.uint64(MARKS), minlength=MARKS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _name(shingle_set: np.ndarray) -> bytes:
    return hashlib.blake2b(shingle_set.tobytes(), digest_size=16).digest()


def _similar(batches, percent: int):
    """The pairs of sets that are similar enough."""
    for batch in batches:
        left, right = ([batch.column(c).values.to_numpy(zero_copy_only=False), batch.column(c).offsets.to_numpy()] for c in ("x", "y"))
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            one, two = (flat[at[i] : at[i + 1]] for flat, at in (left, right))
            both = len(np.intersect1d(one, two, assume_unique=True))
            keep[i] = 100 * both >= percent * (len(one) + len(two) - both)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))


def clusters(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    NULL, empty and white-space texts have no shingles and are their own component. Documents with equal sets (also repeated
    rows) are linked whatever their ids. component_id is the smallest doc_id of the component; a NULL id counts for
    nothing, and a row with one is only kept if all ids of its component are NULL. Rows that repeat the smallest id are all
    marked kept. An empty table gives no rows. Other columns are not looked at.
    """
    return _clustered(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _clustered(docs: DataFrame, percent: int) -> DataFrame:
    """As `clusters`, with a hash of the text and with the component's root, which is NULL for a text without shingles."""
    text = F.coalesce("text", F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    signed = plain.withColumn("text_hash", _text_hash()).mapInArrow(
        _signed, "doc_id long, text_hash long, n_shingles long, node binary, keys array<long>"
    )
    signed = stored(signed)
    nodes = signed.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")
    )
    tables = stored(_tables(nodes))
    if tables.isEmpty():
        roots = docs.sparkSession.createDataFrame([], "node binary, root binary")
    else:
        roots = _roots(plain, tables, nodes, percent)
    named = nodes.select("node", "doc_id").join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    # Written out because adaptive execution can only split the rows of a hot set between two plain shuffles.
    of_node = stored(named.join(least, "root").select("node", "root", "component_id"))
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.col("doc_id").eqNullSafe(component).alias("kept")
    return signed.join(of_node, "node", "left").select(
        "doc_id", "text_hash", "n_shingles", "root", component.alias("component_id"), kept
    )


def _tables(nodes: DataFrame) -> DataFrame:
    """Rows (key, node, n) of tables that hold several sets."""
    sub = nodes.select("node", "n", F.posexplode("keys").alias("i", "sub"))
    shared = sub.groupBy("sub").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("sub")
    shared = stored(shared)  # as below: a hot subkey can be split between two plain shuffles
    half = F.col("i") < SMALL
    pairs = (
        sub.join(shared, "sub")
        .groupBy("node", "n")
        .agg(
            F.collect_list(F.when(half, F.col("sub"))).alias("first"),  # at most SMALL each
            F.collect_list(F.when(~half, F.col("sub"))).alias("second"),
        )
        .select("node", "n", F.explode("first").alias("one"), "second")
        .select("node", "n", "one", F.explode("second").alias("two"))
    )
    keyed = stored(pairs.select(F.xxhash64("one", "two").alias("key"), "node", "n"))
    several = keyed.groupBy("key").agg(F.min(F.struct("node", "n")).alias("low"), F.max("node").alias("high"))
    several = several.filter("low.node < high").select("key", F.col("low.node").alias("low"), F.col("low.n").alias("low_n"))
    return keyed.join(stored(several), "key")


def _fits(percent: int, one: str, two: str) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(one, two) >= percent * F.greatest(one, two)


def _may_share(percent: int) -> Column:
    """Whether two sets' sizes and marks allow them to be similar enough: each differing bit is a shingle of one set alone."""
    n = F.col("n1") + F.col("n2")
    differ = reduce(add, (F.bit_count(F.col("marks1")[i].bitwiseXOR(F.col("marks2")[i])) for i in range(MARKS // 64)))
    return (100 + percent) * (n - differ) >= 2 * percent * n


def _roots(plain: DataFrame, tables: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    spark, name = plain.sparkSession, unique_name("tierlake_sets_")
    held = stored(nodes.join(tables.select("node").distinct(), "node").select("node", "doc_id"))
    # A set's text is found by the set's smallest id, whose other rows may hold other texts.
    ids = held.select(F.col("doc_id").alias("id")).distinct()
    mine = _likely(plain, ids).join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    sets = mine.mapInArrow(_sets, "node binary, shingles array<long>, marks array<long>").join(held.select("node"), "node")
    sets = sets.groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("marks").alias("marks"))
    # Bucketed, so that sets stay where they are in the joins that look at pairs of them.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets.write.bucketBy(buckets, "node").option("path", scratch_folder(spark)).option("compression", "zstd").saveAsTable(name)
    try:
        return _linked(spark.table(name), tables, percent)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _likely(plain: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id may be among `ids`, by a bitmap of their hashes, so that few texts are shuffled to find out.

    The bitmap has FILTER_BITS bits whatever the number of ids; the more there are, the more other rows pass.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    block, bit = F.floor(place / FILTER_BLOCK), (place % FILTER_BLOCK)
    hashed = ids.select(F.col("id").alias("doc_id")).select(block.alias("block"), bit.alias("bit"))
    bitmap = hashed.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    own = F.conv(F.hex(F.substring(F.col("bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = plain.join(F.broadcast(bitmap), block == F.col("block"))
    return found.filter(own.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0).select(*plain.columns)


def _linked(sets: DataFrame, tables: DataFrame, percent: int) -> DataFrame:
    """Rows (node, root) of the sets that are linked with others, from the sets and the tables that they meet in."""

    def confirmed(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        both = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
        return stored(both.mapInArrow(lambda batches: _similar(batches, percent), "a binary, b binary"))

    stars = tables.filter((F.col("node") != F.col("low")) & _fits(percent, "n", "low_n"))
    stars = stars.select(F.col("low").alias("a"), F.col("low_n").alias("n1"), F.col("node").alias("b"), F.col("n").alias("n2"))
    one, two = (sets.select(F.col("node").alias(side), F.col("marks").alias(f"marks{i}")) for i, side in ((1, "a"), (2, "b")))
    stars = stars.distinct().join(one, "a").join(two, "b").filter(_may_share(percent)).select("a", "b")
    compared = stored(stars)
    links = confirmed(compared)
    roots = stored(components(links)) if not links.isEmpty() else None
    placed = tables.select("key", "node")
    placed = placed.join(roots, "node", "left") if roots is not None else placed.withColumn("root", F.lit(None).cast("binary"))
    placed = placed.select("key", "node", F.coalesce("root", "node").alias("root"))
    several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    undecided = stored(placed.join(several.select("key"), "key").select("node", "root").distinct())
    apart = _across(sets.join(undecided, "node"), percent).join(compared, ["a", "b"], "left_anti")
    more = confirmed(apart)
    if not more.isEmpty():
        roots = components(links.union(more))
    if roots is None:
        return sets.sparkSession.createDataFrame([], "node binary, root binary")
    return roots


def _across(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets in different components that may be similar enough, from rows (node, root, shingles, marks)."""
    enough = (100 + percent) * F.least("left1", "left2") >= percent * (F.col("n1") + F.col("n2"))
    pairs = _met(sets, percent)
    pairs = pairs.filter((F.col("n1") <= F.col("n2")) & (F.col("root1") != F.col("root2")) & enough & _may_share(percent))
    return pairs.select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b")).distinct()


def _met(sets: DataFrame, percent: int) -> DataFrame:
    """Rows of two sets each that share a shingle among those that similar sets would share; most are of different components.

    All shingles are put in one order: first those that sets of one component alone have, then the others from rare to
    frequent. Two similar sets share one of the first few in that order: of the larger set the first n - ceil(t n) + 1, and of the
    smaller one the first n - ceil(2 t / (1 + t) n) + 1, as it shares more of itself. Only sets that share one of these
    are paired. So the shingles of a passage that many texts quote are not among them, nor those of a template that is
    most of a text, unless what is left beside it is too little to tell similar texts from others. The first shingle that two
    sets share also bounds what they share: all that comes before it in either is the set's own, so sets with too many
    shingles of their own are not paired. A shingle's sets of its main component are not paired with each other.
    """
    token = F.explode("shingles").alias("token")
    root = sets.select(token, F.xxhash64("root").alias("root"))
    often = root.groupBy("token").agg(F.count("*").alias("often"), F.min("root").alias("low"), F.max("root").alias("high"))
    often = stored(often.filter("low <> high").select("token", "often"))
    across = sets.select("node", token).join(often, "token").groupBy("node")
    across = across.agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("tokens"))  # as many as a set has
    n = F.size("shingles").cast("long")
    few = across.join(sets.select("node", "root", "marks", n.alias("n")), "node")
    own = F.col("n") - F.size("tokens")  # these come first
    long, short = (F.col("n") - F.ceil(F.col("n") * x / y) + 1 for x, y in ((percent, 100), (2 * percent, 100 + percent)))
    few = few.withColumns({"own": own, "long": long, "short": short}).filter("own < long")
    few = few.select("node", "root", "marks", "n", "own", "short", F.posexplode(F.slice("tokens", F.lit(1), (long - own).cast("int"))).alias("nth", "t"))
    before = F.col("own") + F.col("nth")
    # No more than `left` can be shared; a set whose partner would have to be too small for that has none.
    left = F.col("n") - before
    few = few.filter((100 + percent) * left >= percent * (F.col("n") + F.ceil(F.col("n") * percent / 100)))
    rare = stored(few.select(F.col("t.token").alias("token"), "node", "root", "marks", "n", left.alias("left"), (before < F.col("short")).alias("short")))
    by_root = rare.groupBy("token", "root").agg(F.count("*").alias("size"), F.count_if("short").alias("some"))
    main = by_root.groupBy("token").agg(F.max_by("root", "size").alias("main"), F.count("*").alias("roots"), F.sum("some").alias("some"))
    main = stored(main.filter("roots > 1 AND some > 0").select("token", "main"))
    rows = rare.join(main, "token")

    def side(some: DataFrame, i: int) -> DataFrame:
        return some.select("token", *(F.col(c).alias(f"{c}{i}") for c in ("node", "root", "marks", "n", "left")))

    in_main = F.col("root") == F.col("main")
    one = side(rows.filter(F.col("short") & ~in_main), 1).join(side(rows, 2), "token")
    two = side(rows.filter(F.col("short") & in_main), 1).join(side(rows.filter(~in_main), 2), "token")
    return one.union(two)


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, all columns, that stay: one of each component, which has its smallest id; the rest goes.

    Texts without shingles stay, but of rows with one id and equal texts one stays.
    """
    found = _clustered(docs, percent).filter("kept").select("doc_id", "text_hash", "root")
    of_component = found.filter("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("k"))
    kept = of_component.select("k.*").union(found.filter("root is null").select("doc_id", "text_hash")).distinct()
    kept_id, kept_hash, own_hash, order, n = fresh(docs, "kept_id", "kept_hash", "own_hash", "order", "n")
    keyed = docs.withColumns({own_hash: _text_hash(), order: F.xxhash64(*columns(docs))})
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(own_hash) == F.col(kept_hash))
    first = F.row_number().over(Window.partitionBy("doc_id", own_hash).orderBy(order))
    left = keyed.join(stored(kept).toDF(kept_id, kept_hash), same)
    return left.withColumn(n, first).filter(F.col(n) == 1).select(*columns(docs))
