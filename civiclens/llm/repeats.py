"""Substrings of at least a given length that occur more than once, over all rows of a table.

Every window of ``length`` bytes belongs to the smallest hash of the ``gram``-byte pieces in it, so
equal windows meet under the same hash wherever they stand. Consecutive windows with the same
hash form a fragment; one alone under its hash is done, which a bit field of fixed size tells before
anything is shuffled. Fragments are dealt to shards by that hash; of equal fragments one goes
on for all. Each shard builds one suffix array of its fragments by induced sorting, and runs of
common prefixes of ``length`` bytes tell which windows repeat. Rows with different salts never meet, also not in one array.

A hash under which very many different fragments meet (the edge of a passage that thousands
of texts quote) is cut finer: into blocks of windows keyed by the bytes they have in common, and what
is still frequent into single windows. Equal pieces are merged by a map-side minimum at every level,
so no group grows with the number of copies.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclens.llm.common import Batches, Scratch, bit_field, has_bit, join_counted, map_batches
from civiclens.llm.suffix import permuted_prefixes, suffix_array

col = F.col

HOT = 512
"""Different fragments under one hash from which they are cut finer."""
FEW = 64
"""Up to so many fragments under a hash are compared by their middles before they are sorted."""
BLOCK = 8
"""Windows in a block of the finer cut."""
SHARD_BYTES = 1 << 20
"""Text of one suffix array, about; fragments under one hash stay together."""
CHUNK = 1 << 18
"""Windows hashed at a time."""
FILTER_BITS = 27
"""Bits of the field (16 MB, whatever the input) that tells which hashes can occur twice."""
BASE = 0x9E3779B97F4A7C15
ODD = np.uint64(0xFF51AFD7ED558CCD)
CUT = "start int, n int, anchor long, digest long"


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of hashes (a bijection)."""
    values = (values ^ (values >> np.uint64(33))) * ODD
    return values ^ (values >> np.uint64(29))


@functools.lru_cache(maxsize=4)
def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash per byte value, and the powers of the base and of its inverse modulo 2**64."""
    signs = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    powers = np.ones(size, dtype=np.uint64)
    inverse = np.ones(size, dtype=np.uint64)
    powers[1:] = np.cumprod(np.full(size - 1, BASE, dtype=np.uint64))
    inverse[1:] = np.cumprod(np.full(size - 1, pow(BASE, -1, 1 << 64), dtype=np.uint64))
    return signs, powers, inverse


class Rolling:
    """Hashes of all substrings of some bytes, from prefix sums modulo 2**64."""

    def __init__(self, body: np.ndarray):
        signs, powers, self.inverse = _tables(1 << max(12, int(len(body)).bit_length()))
        self.sums = np.zeros(len(body) + 1, dtype=np.uint64)
        np.cumsum(signs[body] * powers[: len(body)], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        starts = self.inverse[: len(self.sums)][start]
        return _mixed((self.sums[end] - self.sums[start]) * starts)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values."""
    out, span, windows = values, 1, len(values) - width + 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:windows], out[width - span : width - span + windows])


def _pieces(bodies: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Number of the text, start and bytes of pieces with all windows, lists of about ``CHUNK`` bytes."""
    held, size = [], 0
    for k, body in enumerate(bodies):
        for first in range(0, len(body) - length + 1, CHUNK):
            piece = body[first : first + CHUNK + length - 1]
            if held and size + len(piece) > CHUNK:
                yield held
                held, size = [], 0
            held.append((k, first, piece))
            size += len(piece)
    if held:
        yield held


def fragments(bodies: list[bytes], length: int, gram: int, digested: bool = True) -> Iterator[tuple[np.ndarray, ...]]:
    """Number of the text, start, number of windows, anchor hash and (if ``digested``) digest of all fragments of some texts.

    Short texts are hashed together; no window crosses texts.
    """
    for pieces in _pieces(bodies, length):
        numbers, firsts, parts = zip(*pieces)
        sizes = np.array([len(p) for p in parts])
        begins = np.cumsum(sizes) - sizes
        body = np.frombuffer(b"".join(parts), dtype=np.uint8)
        rolling = Rolling(body)
        grams = rolling.of(slice(0, len(body) - gram + 1), slice(gram, len(body) + 1))
        least = _smallest(grams, length - gram + 1)
        # The anchor changes when a smaller hash comes in or the present one drops out, or the text ends.
        change = np.append(True, (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1]))
        behind = begins + sizes - (length - 1)  # the first windows that cross into the next text
        change[begins] = True
        change[behind[:-1]] = True
        starts = np.flatnonzero(change)
        counts = np.diff(np.append(starts, len(least)))
        at = np.searchsorted(begins, starts, side="right") - 1
        inside = starts < behind[at]
        starts, counts, at = starts[inside], counts[inside], at[inside]
        found = [np.array(numbers)[at], starts - begins[at] + np.array(firsts)[at], counts, least[starts].view(np.int64)]
        if digested:
            found.append(rolling.of(starts, starts + counts + length - 1).view(np.int64))
        yield tuple(found)


ROW = ("doc", "tag")
"""The id and the hash of its text name a row."""


def _packed(batches: Batches) -> Batches:
    """Small batches of many short texts, put together."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 1 << 16:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _bucket(salt: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    return (anchors ^ salt) & ((1 << FILTER_BITS) - 1)


def _anchors(bodies: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            salts = batch.column(0).to_numpy()
            for owner, _, _, anchors in fragments([b.as_py() for b in batch.column(1)], length, gram, False):
                yield pa.RecordBatch.from_arrays([pa.array(salts[owner]), pa.array(anchors)], ["salt", "anchor"])

    return map_batches(bodies.select("salt", "body"), lambda batches: _packed(run(batches)), "salt long, anchor long")


def _fragments(bodies: DataFrame, length: int, gram: int, met: Broadcast) -> DataFrame:
    """The fragments whose hashes ``met`` has."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = [batch.column(k).to_numpy() for k in range(3)]
            for found in fragments([b.as_py() for b in batch.column(3)], length, gram):
                several = has_bit(met.value, _bucket(rows[2][found[0]], found[3]))
                owner, starts, counts, anchors, digests = (part[several] for part in found)
                columns = [pa.array(row[owner]) for row in rows]
                columns += [pa.array(c.astype(np.int32)) for c in (starts, counts)]
                columns += [pa.array(c) for c in (anchors, digests)]
                yield pa.RecordBatch.from_arrays(columns, [*ROW, "salt", "start", "n", "anchor", "digest"])

    picked = bodies.select(*ROW, "salt", "body")
    return map_batches(picked, lambda batches: _packed(run(batches)), f"doc long, tag long, salt long, {CUT}")


def _settle(rows: DataFrame, length: int, everywhere: bool, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """Spans of fragments equal to a deciding one, and the fragments that go on for all equal ones.

    The latter have ``shared`` (whether equal fragments stand in several rows) and ``size`` (how many meet
    under their hash); those alone under theirs are done.
    """
    key, equal = ["salt", "anchor"], ["salt", "anchor", "digest"]
    at, row = F.struct(*ROW, "start"), F.struct(*ROW)
    taken = ["n", *[c for c in rows.columns if c == "bytes"]]
    first = rows.groupBy(*equal).agg(
        F.min(at).alias("first"),
        (F.min(row) < F.max(row)).alias("shared"),
        F.count("*").alias("places"),
        *[F.first(c).alias(c) for c in taken],
    )
    first = scratch.stage(first, f"{name}-first")
    several = first.where("places > 1").select(*equal, "first", "shared", "places")
    met = join_counted(rows, several, equal, "places")
    repeated = col("shared") if everywhere else at > col("first")
    spans = met.where(repeated).select(*ROW, "start", (col("start") + col("n") + (length - 1)).alias("end"))
    left = first.select(*equal, "first.*", "shared", *taken)
    if everywhere:
        # Of fragments that one row has several times each place counts, should a window in them stand elsewhere.
        again = met.where(~col("shared") & (at > col("first"))).dropDuplicates([*key, *ROW, "start"])
        left = left.unionByName(again.select(*left.columns))
    sizes = left.groupBy(*key).agg(F.count("*").alias("size")).where("size > 1")
    return spans, left.join(sizes, key)


def _with_bytes(rows: DataFrame, bodies: DataFrame, length: int) -> DataFrame:
    """The rows with the bytes of their fragments."""
    wanted = ["start", "n", "salt", "anchor", "digest", "shared", "size"]
    by_row = rows.groupBy(*ROW).agg(F.collect_list(F.struct(*wanted)).alias("cut"))
    joined = bodies.select(*ROW, "body").dropDuplicates(list(ROW)).join(by_row, list(ROW))
    end = col("cut.n") + (length - 1)
    return joined.select(*ROW, "body", F.explode("cut").alias("cut")).select(
        *ROW, "cut.*", F.substring("body", col("cut.start") + 1, end).alias("bytes")
    )


def repeated_windows(
    texts: list[bytes],
    docs: np.ndarray,
    starts: np.ndarray,
    shared: np.ndarray,
    salts: np.ndarray,
    length: int,
    everywhere: bool,
) -> list[tuple[int, int, int]]:
    """Spans (doc, start, end) of windows repeated under their salt, from one suffix array of all the texts."""
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1)
    # 0 ends the whole, 1 ends each text, bytes count from 2.
    body = np.frombuffer(b"\x00".join(texts) + b"\x00", dtype=np.uint8)
    joined = np.append(body.astype(np.int64) + 2, 0)
    joined[ends - 1] = 1
    suffixes = suffix_array(joined)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    room = (ends - 1)[owner] - np.arange(len(body))
    prefixes = permuted_prefixes(body, suffixes, room, length)
    # Only suffixes that have a whole window left in their text can repeat one.
    place = suffixes[suffixes < len(owner)]
    inside = room[place] >= length
    same = (prefixes[place] >= length) & inside
    same[1:] &= inside[:-1]
    same[:1] = False
    group = np.cumsum(~same)
    place, group = place[inside], group[inside]
    if not len(place):
        return []
    own = owner[place]
    doc, at, salt = docs[own], starts[own] + place - (ends - 1 - sizes)[own], salts[own]
    order = np.lexsort((at, doc, salt, group))
    place, group, salt, doc, own = (c[order] for c in (place, group, salt, doc, own))
    head = np.append(True, (group[1:] != group[:-1]) | (salt[1:] != salt[:-1]))
    if everywhere:
        bounds = np.flatnonzero(head)
        last = np.append(bounds[1:], len(group)) - 1
        several = (doc[bounds] != doc[last]) | (np.add.reduceat(shared[own].astype(np.int64), bounds) > 0)
        repeated = np.repeat(several, last - bounds + 1) & (several.sum() > 0)
    else:
        repeated = ~head
    place = np.sort(place[repeated])
    if not len(place):
        return []
    own = owner[place]
    run = np.append(True, (np.diff(place) > 1) | (np.diff(own) > 0))
    low = np.flatnonzero(run)
    high = np.append(low[1:], len(place)) - 1
    base = (ends - 1 - sizes)[own]
    begin, finish = starts[own] + place - base, starts[own] + place - base + length
    return list(zip(docs[own[low]].tolist(), begin[low].tolist(), finish[high].tolist()))


def related(group: list[tuple], length: int) -> list[tuple]:
    """The fragments (text last) under one hash that can share a window with another of them.

    All windows of a fragment have its middle in common, so two fragments share a window only if
    each contains the middle of the other. That spares sorting those that agree in little more than the
    hashed piece. Large groups are sorted whole.
    """
    if len(group) > FEW:
        return group
    texts = [row[-1] for row in group]
    cores = [t[len(t) - length : length] for t in texts]
    near = lambda i, j: cores[i] in texts[j] and cores[j] in texts[i]
    return [row for i, row in enumerate(group) if any(i != j and near(i, j) for j in range(len(group)))]


def _by_suffix_arrays(rows: DataFrame, length: int, everywhere: bool) -> DataFrame:
    """Repeated spans among the fragments under each hash."""

    def run(batches: Batches) -> Batches:
        held: list[tuple] = []
        group: list[tuple] = []
        size, last = 0, None

        def solve() -> pa.RecordBatch:
            salts, docs, tags, starts, shared, texts = zip(*held)
            names = sorted(set(zip(docs, tags)))
            places = {name: k for k, name in enumerate(names)}
            found = repeated_windows(
                list(texts),
                np.array([places[name] for name in zip(docs, tags)]),
                np.array(starts),
                np.array(shared, dtype=bool),
                np.array(salts, dtype=np.int64),
                length,
                everywhere,
            )
            columns = list(zip(*[(*names[k], start, end) for k, start, end in found])) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*ROW, "start", "end"])

        for batch in batches:
            for salt, anchor, *row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if (salt, anchor) != last:
                    kept = related(group, length)
                    held += kept
                    size, group, last = size + sum(len(r[-1]) for r in kept), [], (salt, anchor)
                    if size >= SHARD_BYTES and held:
                        yield solve()
                        held, size = [], 0
                group.append((salt, *row))
        held += related(group, length)
        if held:
            yield solve()

    dealt = rows.select("salt", "anchor", *ROW, "start", "shared", "bytes").repartition("salt", "anchor")
    return map_batches(dealt.sortWithinPartitions("salt", "anchor"), run, "doc long, tag long, start int, end int")


def _finer(rows: DataFrame, length: int, gram: int, block: int) -> DataFrame:
    """Fragments cut into blocks of windows at the same distance from the anchor, keyed by their common bytes."""

    def cut(body: bytes, n: int, anchor: int) -> list[tuple[int, int, int, int, bytes]]:
        piece = np.frombuffer(body, dtype=np.uint8)
        rolling = Rolling(piece)
        if block == 1:
            starts = np.arange(n)
            keys = rolling.of(starts, starts + length).view(np.int64)
            return [(s, 1, k, k, body[s : s + length]) for s, k in enumerate(keys.tolist())]
        grams = rolling.of(slice(0, len(piece) - gram + 1), slice(gram, len(piece) + 1))
        places = np.flatnonzero(grams == np.array([anchor]).view(np.uint64)[0])
        place = int(places[0])
        ahead = place - np.arange(n)
        out = []
        for low in sorted({d // block * block for d in ahead.tolist()}):
            starts = np.flatnonzero(ahead // block * block == low)
            first, last = int(starts[0]), int(starts[-1])
            core = place - low, place - low - (block - 1) + length
            ends = [(core[0], core[1]), (first, last + length)]
            hashes = rolling.of(np.array([e[0] for e in ends]), np.array([e[1] for e in ends]))
            key = int(_mixed(hashes[:1] + np.uint64(low))[0].astype(np.int64))
            out.append((first, last - first + 1, key, int(hashes[1].astype(np.int64)), body[first : last + length]))
        return out

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = [
                (doc, tag, salt, start + s, m, key, digest, part)
                for doc, tag, salt, start, n, anchor, body in zip(*(batch.column(i).to_pylist() for i in range(7)))
                for s, m, key, digest, part in cut(body, n, anchor)
            ]
            names = [*ROW, "salt", "start", "n", "anchor", "digest", "bytes"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            columns = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    picked = rows.select(*ROW, "salt", "start", "n", "anchor", "bytes")
    return map_batches(picked, run, f"doc long, tag long, salt long, {CUT}, bytes binary")


def repeats(bodies: DataFrame, length: int, gram: int, everywhere: bool, scratch: Scratch) -> DataFrame:
    """doc, tag, start, end (bytes) of spans made of windows of ``length`` bytes that repeat under the same salt.

    ``bodies`` has doc and tag (long), which together name a row, salt (long) and body (binary). A window repeats if it
    starts earlier too (a smaller doc, tag or, in the same row, start); with ``everywhere``, if it stands in at
    least two rows, and then all its places count. Spans may overlap and touch.
    """
    common = _anchors(bodies, length, gram).groupBy("salt", "anchor").agg(F.count("*").alias("places")).where("places > 1")
    bucket = col("anchor").bitwiseXOR(col("salt")).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    met = bit_field(common, bucket, FILTER_BITS)
    scratch.release()
    rows = scratch.stage(_fragments(bodies, length, gram, met), "fragments")
    spans, left = _settle(rows, length, everywhere, scratch, "whole")
    found = [scratch.stage(spans, "spans-whole")]
    left = scratch.stage(left, "left")
    for done in ("fragments", "whole-first"):
        scratch.drop(done)
    scratch.release()
    left = scratch.stage(_with_bytes(left, bodies, length), "bytes")
    scratch.drop("left")
    scratch.release()
    found.append(scratch.stage(_by_suffix_arrays(left.where(col("size") <= HOT), length, everywhere), "spans-sorted"))
    hot = left.where(col("size") > HOT)
    for block in (BLOCK, 1):
        if hot.isEmpty():
            break
        finer = scratch.stage(_finer(hot, length, gram, block), f"finer-{block}")
        spans, left = _settle(finer, length, everywhere, scratch, f"finer-{block}")
        found.append(scratch.stage(spans, f"spans-{block}"))
        if block > 1:
            left = scratch.stage(left, f"left-{block}")
            light = left.where(col("size") <= HOT)
            found.append(scratch.stage(_by_suffix_arrays(light, length, everywhere), f"spans-sorted-{block}"))
            hot = left.where(col("size") > HOT)
    scratch.drop("bytes")
    scratch.release()
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out
