"""Near-duplicate classes by SimHash and a self-join of the binary trie of fingerprints.

Distinct fingerprints form a binary trie. Two of its nodes at one depth are traversed together: the
pair of roots splits into pairs of children, a pair whose branches differ gains a differing bit,
and pairs beyond the error budget are dropped with everything below. Of at most three differing
bits, at most one lies in the first half of the 64 bits or at most one in the second; so the
traversal is done twice, over the bits as they are and with the halves exchanged, and allows one
difference within the half that comes first and three in all. This keeps the frontier near
the number of fingerprints.

The nodes at a fixed depth are the units of distribution: a fingerprint goes to the pair of its
node with itself and to the pairs with the nodes one bit away, and each pair's subtrees are
traversed in one task. The depth grows with the largest node, so subtrees stay small.
A task returns a star per connected set, not all pairs. Exact copies share a fingerprint and take part
once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.common import Batches, Scratch, bit_field, has_bit, map_batches, table, utf8
from civiclens.llm.components import components
from civiclens.llm.prefixes import frequencies, rarest

col = F.col

BITS = 64
HALF = 32
MOST_BITS = 3
SHINGLE_WORDS = 3
STAGE_WORDS, ALIKE = 5, 80
"""Shingles of the pipeline's stage, and the Jaccard similarity (in percent) from which it takes documents for copies."""
SEED = 42
NODE_ROWS = 4096
"""Fingerprints below one node of the distributed cut, by way of its depth."""
LEAST_DEPTH, MOST_DEPTH = 8, 30
FRONTIER = 1 << 18
"""Node pairs expanded at a time in a task."""
FILTER_BITS = 27
"""Bits of the fields (16 MB, whatever the input) that tell which prefix elements several sets can have."""
SKETCH_BITS = 9
"""A set's sketch has two to the power of this many bits."""
DIRECT_PAIRS = 16
"""Below this many leaf pairs a node pair is compared leaf by leaf."""


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of all word shingles, repeats included; of a shorter text, of all its words."""
    parts = text.lower().split()  # of bytes: A-Z only, and cut at ASCII white space
    if not parts:
        return []
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate([[0], ends[:-1]]).tolist()
    ends = (ends - 1).tolist()
    size = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :])]


def majority(hashes: list[int]) -> int:
    """The bits that most hashes have; 0 without hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included; 0 without words."""
    return majority(shingle_hashes(text, words))


def fingerprints(frame: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``print`` (the 64 bits as a signed long) of every row; a NULL text has no words."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            prints = np.array([fingerprint(v.as_py()) for v in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["doc_id", "print"])

    picked = frame.select(col(id_column).cast("long").alias("doc_id"), utf8(text).alias("body"))
    return map_batches(picked, run, "doc_id long, print long")


def _stars(nodes: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node of their connected set, roots left out."""
    label = np.arange(nodes)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            member = np.flatnonzero(label != np.arange(nodes))
            return member, label[member]
        label = new


def _budget(depth: int) -> int:
    """Differing bits allowed among the first ``depth``."""
    return 1 if depth <= HALF else MOST_BITS


def trie_links(left: np.ndarray, right: np.ndarray | None, depth: int, errors: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the leaves below two nodes, or within one node (``right`` None), as stars.

    ``left`` and ``right`` are distinct sorted unsigned fingerprints that agree in their first ``depth`` bits.
    Positions returned count through both.
    """
    own = right is None
    leaves = left if own else np.concatenate([left, right])
    offset = 0 if own else len(left)
    ones = {}

    def split(lo: np.ndarray, hi: np.ndarray, at: int) -> np.ndarray:
        if at not in ones:
            bit = (leaves >> np.uint64(BITS - 1 - at)) & np.uint64(1)
            ones[at] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        return hi - (ones[at][hi] - ones[at][lo])

    second = (0, len(left)) if own else (offset, len(leaves))
    start = np.array([[0, len(left), *second, errors]], dtype=np.int64).T
    stack, found_i, found_j, held = [(depth, start)], [], [], 0
    while stack:
        at, pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            stack.append((at, pairs[:, FRONTIER:]))
            pairs = pairs[:, :FRONTIER]
        alo, ahi, blo, bhi, err = pairs
        leaf_pairs = (ahi - alo) * (bhi - blo)
        small = leaf_pairs <= DIRECT_PAIRS
        if small.any() or at == BITS:
            picked = small | (at == BITS)
            n = leaf_pairs[picked]
            each = np.repeat(np.flatnonzero(picked), n)
            nth = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            wide = (bhi - blo)[each]
            i, j = alo[each] + nth // wide, blo[each] + nth % wide
            differing = np.bitwise_count(leaves[i] ^ leaves[j])
            near = (differing <= MOST_BITS) & (i != j)
            found_i.append(i[near])
            found_j.append(j[near])
            held += int(near.sum())
            if held > 4 * FRONTIER:  # dense: keep who is connected, not every pair
                i, j = _stars(len(leaves), np.concatenate(found_i), np.concatenate(found_j))
                found_i, found_j, held = [i], [j], 0
            pairs = pairs[:, ~picked]
            if not pairs.shape[1]:
                continue
            alo, ahi, blo, bhi, err = pairs
        amid, bmid = split(alo, ahi, at), split(blo, bhi, at)
        same = (alo == blo) & (ahi == bhi)
        children = [
            np.array([alo, amid, blo, bmid, err]),
            np.array([amid, ahi, bmid, bhi, err]),
            np.array([alo, amid, bmid, bhi, err + 1]),
            np.array([amid, ahi, blo, bmid, err + 1])[:, ~same],
        ]
        grown = np.concatenate(children, axis=1)
        grown = grown[:, (grown[1] > grown[0]) & (grown[3] > grown[2]) & (grown[4] <= _budget(at + 1))]
        if grown.shape[1]:
            stack.append((at + 1, grown))
    if not found_i:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return _stars(len(leaves), np.concatenate(found_i), np.concatenate(found_j))


def _join_nodes(depth: int):
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        prints = rows["bits"].to_numpy().view(np.uint64)
        side = rows["side"].to_numpy()
        left, right = np.sort(prints[side == 0]), np.sort(prints[side == 1])
        own, turned = rows["flip"].iloc[0] < 0, rows["turned"].iloc[0]
        empty = pd.DataFrame({"u": [], "v": []}, dtype="int64")
        if not len(left) or (not own and not len(right)):
            return empty
        i, j = trie_links(left, None if own else right, depth, 0 if own else 1)
        leaves = left if own else np.concatenate([left, right])
        if turned:
            leaves = (leaves << np.uint64(HALF)) | (leaves >> np.uint64(HALF))
        leaves = leaves.view(np.int64)
        return pd.DataFrame({"u": leaves[i], "v": leaves[j]})

    return join


def _depth(prints: DataFrame, total: int) -> int:
    """Depth of the cut: by the number of fingerprints, then deeper while a node holds too many."""
    depth = max(LEAST_DEPTH, min(MOST_DEPTH, (max(1, total // NODE_ROWS) - 1).bit_length()))
    while depth < MOST_DEPTH:
        nodes = [F.shiftrightunsigned(bits, BITS - depth) for bits in (col("print"), _turn(col("print")))]
        counts = prints.select(F.posexplode(F.array(*nodes)).alias("half", "node")).groupBy("half", "node").count()
        if (counts.agg(F.max("count")).first()[0] or 0) <= 8 * NODE_ROWS:
            break
        depth += 2
    return depth


def _turn(bits: Column) -> Column:
    return F.shiftleft(bits, HALF).bitwiseOR(F.shiftrightunsigned(bits, HALF))


def near_links(prints: DataFrame) -> DataFrame:
    """Links u, v that connect all distinct fingerprints at most three bits apart."""
    depth = _depth(prints, prints.count())
    bits = prints.select(
        "print", F.explode(F.array(F.lit(False), F.lit(True))).alias("turned")
    ).select("turned", F.when(col("turned"), _turn(col("print"))).otherwise(col("print")).alias("bits"))
    node = F.shiftrightunsigned("bits", BITS - depth)
    placed = bits.withColumn("node", node).withColumn("flip", F.explode(F.sequence(F.lit(-1), F.lit(depth - 1))))
    mask = F.when(col("flip") < 0, F.lit(0).cast("long")).otherwise(F.expr("shiftleft(1L, flip)"))
    first = col("node").bitwiseAND(F.bitwise_not(mask))
    paired = placed.select(
        "turned", "flip", first.alias("first"), (col("node") != first).cast("int").alias("side"), "bits"
    )
    return paired.groupBy("turned", "flip", "first").applyInPandas(_join_nodes(depth), "u long, v long")


def near_duplicates(frame: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every row.

    Rows whose fingerprints differ in at most three bits are linked; component_id is the smallest doc_id
    in reach. A NULL or empty text has no words and fingerprint zero. A NULL id names no class: a
    row without one gets the smallest id among the rest, NULL if there is none. Repeated rows give
    repeated results.
    """
    scratch = Scratch(frame.sparkSession, "simhash")
    rows = scratch.stage(fingerprints(frame, id_column, text), "rows")
    prints = scratch.stage(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    links = scratch.stage(near_links(prints), "links")
    roots = components(links, scratch)
    rooted = prints.join(roots, prints["print"] == roots["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    rooted = scratch.stage(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("print", "component_id")
    return rows.join(classes, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_simhash_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_duplicates(table(spark, folder, "documents"))


def _sketch(hashes: np.ndarray) -> np.ndarray:
    """Parities of the bits chosen by a set's hashes: no more of them differ between two sets than elements do."""
    chosen = (hashes.view(np.uint64) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
    parities = np.bincount(chosen, minlength=1 << SKETCH_BITS) & 1
    return np.packbits(parities.astype(np.uint8)).view(np.int64)


def shingle_sets(documents: DataFrame, words: int) -> DataFrame:
    """doc_id, print, and the distinct shingle hashes with their own hash ``node``, number and sketch of every row."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            nodes, prints, sets = [], [], []
            for value in batch.column(1):
                hashes = shingle_hashes(value.as_py(), words)
                prints.append(majority(hashes))
                sets.append(np.unique(np.array(hashes, dtype=np.uint64).view(np.int64)))
                nodes.append(xxhash.xxh3_64_intdigest(sets[-1].tobytes()))
            longs = [pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in (nodes, prints)]
            sketches = pa.array([_sketch(found) for found in sets], pa.list_(pa.int64()))
            columns = [batch.column(0), *longs, pa.array([len(found) for found in sets], pa.int32()), sketches]
            columns.append(pa.array(sets, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "print", "n", "sketch", "hashes"])

    picked = documents.select(col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("body"))
    return map_batches(picked, run, "doc_id long, node long, print long, n int, sketch array<long>, hashes array<long>")


def _row_bucket(rows: np.ndarray) -> np.ndarray:
    """Places of rows in the field of the first ones of their sets."""
    return (rows ^ (rows >> 13)) & ((1 << FILTER_BITS) - 1)


def _set_prefixes(rows: DataFrame, nodes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """key, place and size of the elements of which sets alike enough share at least one, without most of those of one set only.

    Of equal sets the first row emits. Which keys occur twice, a bit field of fixed size says; only these are
    given their set, place and size and shuffled with them. A false positive of a field is a row more, none less.
    """
    frequent = frequencies(rows)
    mask = F.lit((1 << FILTER_BITS) - 1)
    first_rows = bit_field(nodes, col("row").bitwiseXOR(F.shiftright("row", 13)).bitwiseAND(mask), FILTER_BITS)

    def elements(batches: Batches) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            batch = batch.filter(pa.array(has_bit(first_rows.value, _row_bucket(batch.column(0).to_numpy()))))
            nodes, sizes, keys = batch.column(1).to_numpy(), [], []
            for value in batch.column(2):
                hashes = value.values.to_numpy()
                least = -(-percent * len(hashes) // 100)
                sizes.append(len(hashes))
                keys.append(rarest(hashes, frequent.value, len(hashes) - least + 1 if len(hashes) else 0))
            each = [len(k) for k in keys]
            place = np.concatenate([np.arange(n, dtype=np.int32) for n in each] or [np.empty(0, np.int32)])
            key = np.concatenate(keys or [np.empty(0, np.int64)])
            yield key, np.repeat(nodes, each), place, np.repeat(np.array(sizes, dtype=np.int32), each)

    def keys_only(batches: Batches) -> Batches:
        for found in elements(batches):
            yield pa.RecordBatch.from_arrays([pa.array(found[0])], ["key"])

    picked = rows.select("row", "node", "hashes")
    several = map_batches(picked, keys_only, "key long").groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = bit_field(several, col("key").bitwiseAND(mask), FILTER_BITS)
    scratch.release()

    def run(batches: Batches) -> Batches:
        for found in elements(batches):
            kept = has_bit(met.value, found[0] & ((1 << FILTER_BITS) - 1))
            yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in found], ["key", "node", "place", "size"])

    emitted = map_batches(picked, run, "key long, node long, place int, size int")
    # A row that the field of first ones let through emits what the first one of its set does.
    return emitted.groupBy("key", "node").agg(F.first("place").alias("place"), F.first("size").alias("size"))


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs u, v whose sets can be alike by their sketches."""
    one = nodes.select(col("node").alias("u"), col("n").alias("of_u"), col("sketch").alias("sketch_u"))
    other = nodes.select(col("node").alias("v"), col("n").alias("of_v"), col("sketch").alias("sketch_v"))
    bits = F.zip_with("sketch_u", "sketch_v", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    apart = F.aggregate(bits, F.lit(0), lambda total, some: total + some)
    near = (100 + percent) * apart <= (100 - percent) * (col("of_u") + col("of_v"))
    return pairs.join(one, "u").join(other, "v").where(near).select("u", "v")


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs u, v whose sets have a Jaccard similarity of at least ``percent``."""
    one, other = sets.toDF("u", "of_u"), sets.toDF("v", "of_v")
    joined = pairs.join(one, "u").join(other, "v")
    shared = F.size(F.array_intersect("of_u", "of_v"))
    enough = (100 + percent) * shared >= percent * (F.size("of_u") + F.size("of_v"))
    return joined.where(enough).select("u", "v")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def similar_classes(documents: DataFrame, words: int = STAGE_WORDS, percent: int = ALIKE) -> DataFrame:
    """doc_id and component_id: classes of documents linked by a Jaccard similarity of word shingles.

    All pairs with at least ``percent`` are found: they share an element of their prefixes. The
    trie's links and a star below each prefix element are compared first; after that only sets not yet in one class are, so
    a large class costs stars, not all its pairs. Sets are fetched only for pairs that can be alike by their sketches.
    """
    scratch = Scratch(documents.sparkSession, "alike")
    scratch.release()  # of what the stage before has left
    rows = shingle_sets(documents.where("doc_id IS NOT NULL"), words).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.stage(rows, "rows")
    alike = [F.first(c).alias(c) for c in ("print", "n", "sketch")]
    nodes = rows.groupBy("node").agg(F.min(F.struct("doc_id", "row")).alias("first"), *alike)
    nodes = scratch.stage(nodes.select("node", col("first.doc_id").alias("least"), "first.row", "print", "n", "sketch"), "nodes")
    prefixes = scratch.stage(_set_prefixes(rows, nodes, percent, scratch), "prefixes")
    scratch.release()
    met = prefixes.groupBy("key").agg(
        F.count("*").alias("n"),
        *[F.min(F.struct(F.xxhash64(F.lit(k), "node"), "node", "size")).alias(f"star{k}") for k in (0, 1)],
    )
    prefixes = scratch.stage(prefixes.join(met.where("n > 1").drop("n"), "key"), "met")
    scratch.drop("prefixes")
    scratch.release()
    sized = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)
    stars = prefixes.select("node", "size", F.explode(F.array("star0", "star1")).alias("star"))
    stars = stars.where(sized(col("size"), col("star.size"))).select(col("node").alias("u"), col("star.node").alias("v"))

    prints = scratch.stage(nodes.groupBy("print").agg(F.min("node").alias("v")), "prints")
    equal = nodes.join(prints, "print").select(col("node").alias("u"), "v")
    close = near_links(prints.select("print")).toDF("a", "b")
    close = close.join(prints.toDF("a", "u"), "a").join(prints.toDF("b", "v"), "b").select("u", "v")
    tried = scratch.stage(_possible(_ordered(stars.union(equal).union(close)), nodes, percent), "tried")

    def compared(pairs: DataFrame, name: str) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(nodes.select("node", "row"), "node")
        # Written, so that its size is known and few sets are fetched without shuffling all.
        wanted = scratch.stage(wanted, f"wanted-{name}")
        scratch.release()
        sets = scratch.stage(rows.select("row", "hashes").join(wanted, "row").select("node", "hashes"), f"sets-{name}")
        scratch.release()
        return scratch.stage(_alike(pairs, sets, percent), f"links-{name}")

    links = compared(tried, "first")
    scratch.drop("sets-first")
    scratch.release()
    roots = components(links, scratch)
    placed = prefixes.select("key", "node", "place", "size").join(roots, "node", "left")
    placed = scratch.stage(placed.withColumn("root", F.coalesce("root", "node")), "placed")
    largest = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    largest = largest.groupBy("key").agg(F.max(F.struct("n", "root"))["root"].alias("largest"), F.count("*").alias("roots"))
    placed = scratch.stage(placed.join(largest.where("roots > 1").drop("roots"), "key"), "apart")
    for done in ("placed", "met"):
        scratch.drop(done)
    scratch.release()
    left = placed.where("root <> largest").select("key", *[col(c).alias(f"{c}_a") for c in ("node", "place", "size", "root")])
    behind = F.least(col("size_a") - col("place_a"), col("size") - col("place"))
    pairs = left.join(placed, "key").where(
        (col("root_a") != col("root"))
        & ((col("root") == col("largest")) | (col("node_a") < col("node")))
        & sized(col("size_a"), col("size"))
        & ((100 + percent) * behind >= percent * (col("size_a") + col("size")))
    )
    pairs = _ordered(pairs.select(col("node_a").alias("u"), col("node").alias("v"))).join(tried, ["u", "v"], "left_anti")
    links = links.union(compared(scratch.stage(_possible(pairs, nodes, percent), "pairs"), "rest"))
    for done in ("apart", "sets-rest"):
        scratch.drop(done)
    scratch.release()
    roots = components(links, Scratch(documents.sparkSession, "alike-roots"))
    rooted = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("node", "component_id")
    return rows.select("doc_id", "node").join(classes, "node").select("doc_id", "component_id")


def representatives(documents: DataFrame) -> DataFrame:
    """The documents with the smallest id of their class, with their columns.

    Classes are those of ``similar_classes``: texts without words are one, and texts under five words are alike
    if equal. Rows that repeat an id and a text are one document and stay once. Rows without an id stay.
    """
    going = similar_classes(documents).groupBy("doc_id").agg(F.min("component_id").alias("least")).where("least < doc_id")
    left = documents.join(going.select("doc_id"), "doc_id", "left_anti").select(*documents.columns)
    return left.dropDuplicates(["doc_id", "text"])
