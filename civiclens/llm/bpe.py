"""Byte-level BPE in numpy, exactly as the rank file defines it.

A text is cut by the splitting pattern; each piece starts as its bytes. Pieces not yet known to
the task are sorted into buckets by length, each a padded matrix with one row per piece. In every
round each row merges its leftmost pair of least rank; the ranks of pairs come from an
open-addressing hash table probed for whole columns at once, and rows are compacted after the merge.
Finished rows leave the matrix. Texts are independent rows, so nothing is shuffled.

Token ids are kept packed: little-endian unsigned 32-bit integers in one binary value per text.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.common import Batches, free_name, map_batches, table, utf8

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

NO_RANK = np.int32(2**31 - 1)
GROUP_BYTES = 1 << 20
"""Text encoded at a time in a task."""
MATRIX_CELLS = 1 << 19
"""Cells of one padded matrix; a longer piece is a matrix of one row."""
KNOWN_PIECES = 150_000
"""Pieces a task remembers before it starts afresh."""


class PairTable:
    """Rank of the token that two adjacent tokens merge into, for arrays of pairs."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(2 * len(rank)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, NO_RANK, dtype=np.int32)
        keys = left.astype(np.int64) << 32 | right
        slots, pending = self._slots(keys), np.arange(len(keys))
        while len(pending):
            at = slots[pending]
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[pending[free]]  # of several, one wins the slot
            won = self.keys[at] == keys[pending]
            self.ranks[at[won]] = rank[pending[won]]
            pending = pending[~won]
            slots[pending] = (slots[pending] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys ^ (keys >> 29)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """NO_RANK for a pair that does not merge, padding (-1) included."""
        keys = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        keys[(left < 0) | (right < 0)] = -2
        out = np.full(len(keys), NO_RANK, dtype=np.int32)
        slots, pending = self._slots(keys), np.flatnonzero(keys >= 0)
        while len(pending):
            at = slots[pending]
            found = self.keys[at]
            hit = found == keys[pending]
            out[pending[hit]] = self.ranks[at[hit]]
            pending = pending[~hit & (found >= 0)]
            slots[pending] = (slots[pending] + 1) & (len(self.keys) - 1)
        return out


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ids = {base64.b64decode(t): int(r) for t, r in map(bytes.split, rank_file.splitlines()) if t}
        self.pieces = regex.compile(pattern)
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int32)
        splits = [
            (self.ids[t[:i]], self.ids[t[i:]], r)
            for t, r in self.ids.items()
            for i in range(1, len(t))
            if t[:i] in self.ids and t[i:] in self.ids
        ]
        self.pairs = PairTable(*np.array(splits or [(0, 0, NO_RANK)], dtype=np.int64).T)
        tokens = [b""] * (1 + max(self.ids.values()))
        for token, rank in self.ids.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.token_sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.known: dict[str, bytes] = {}

    def merge_rows(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers and ids (padded at the end with -1) of rows of byte ids as they are finished."""
        at = np.arange(len(rows))
        ranks = self.pairs.look_up(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(len(rows), -1)
        while len(rows):
            if not ranks.shape[1]:
                yield at, rows
                break
            place = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), place]
            live = best < NO_RANK
            if not live.all():
                yield at[~live], rows[~live]
                rows, ranks, at, place, best = rows[live], ranks[live], at[live], place[live], best[live]
                if not len(rows):
                    break
            # Close the gap behind each merged pair.
            each, shape = np.arange(len(rows)), rows.shape
            rows[each, place] = best
            kept = np.ones(shape, dtype=bool)
            kept[each, place + 1] = False
            rows = rows[kept].reshape(shape[0], shape[1] - 1)
            kept = np.ones(ranks.shape, dtype=bool)
            kept[each, place] = False
            ranks = ranks[kept].reshape(shape[0], shape[1] - 2)
            for beside in (place - 1, place):
                near = np.flatnonzero((beside >= 0) & (beside < ranks.shape[1]))
                column = beside[near]
                ranks[near, column] = self.pairs.look_up(rows[near, column], rows[near, column + 1])

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces not met before, bucket by bucket."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8")
            whole = self.ids.get(raw)
            if whole is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            else:
                buckets.setdefault((len(raw) - 1).bit_length(), []).append((piece, raw))
        for members in buckets.values():
            members.sort(key=lambda m: len(m[1]))
            start = 0
            while start < len(members):
                width = len(members[start][1])
                stop = start
                while stop < len(members) and (stop == start or (stop - start + 1) * len(members[stop][1]) <= MATRIX_CELLS):
                    stop += 1
                part = members[start:stop]
                width = len(part[-1][1])
                sizes = np.array([len(raw) for _, raw in part])
                filled = np.arange(width) < sizes[:, None]
                rows = np.full(filled.shape, -1, dtype=np.int32)
                rows[filled] = self.byte_ids[np.frombuffer(b"".join(raw for _, raw in part), dtype=np.uint8)]
                for at, ids in self.merge_rows(rows):
                    counts = (ids >= 0).sum(axis=1)
                    packed, ends = ids[ids >= 0].astype("<u4").tobytes(), 4 * np.cumsum(counts)
                    for k, end, size in zip(at.tolist(), ends.tolist(), (4 * counts).tolist()):
                        self.known[part[k][0]] = packed[end - size : end]
                start = stop

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        cut = [self.pieces.findall(text) for text in texts]
        fresh: set[str] = set()
        for pieces in cut:
            fresh.update(pieces)
        self.learn(fresh.difference(self.known))
        known = self.known.__getitem__
        return [b"".join(map(known, pieces)) for pieces in cut]

    def decode(self, packed: bytes) -> bytes:
        ids, out = np.frombuffer(packed, dtype="<u4"), []
        for start in range(0, len(ids), 1 << 20):
            part = ids[start : start + (1 << 20)]
            sizes = self.token_sizes[part]
            ends = np.cumsum(sizes)
            shift = np.repeat(self.token_starts[part] - (ends - sizes), sizes)
            out.append(self.token_bytes[shift + np.arange(len(shift))].tobytes())
        return b"".join(out)


@functools.lru_cache(maxsize=2)
def _codec(rank_file: bytes, pattern: str) -> Codec:
    return Codec(rank_file, pattern)


def _rank_file(spark: SparkSession, path: str) -> Broadcast:
    """The file's bytes, read once on the driver; a vocabulary is under a few MB whatever the corpus."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _groups(bodies: Iterable[bytes]) -> Iterator[list[str]]:
    group, held = [], 0
    for body in bodies:
        group.append(body.decode("utf-8", "replace"))
        held += len(body)
        if held >= GROUP_BYTES:
            yield group
            group, held = [], 0
    if group:
        yield group


def encode(
    frame: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    round_trip: bool = False,
) -> DataFrame:
    """The ``keep`` columns, ``n_tokens`` and ``token_ids`` (packed) of every row.

    With ``round_trip`` also ``decoded``, the bytes that the ids decode to, in the same pass. A NULL text
    is empty and has no tokens. Bytes that are not UTF-8 are read as U+FFFD.
    """
    ranks = _rank_file(frame.sparkSession, vocabulary)
    picked = frame.select(*keep, utf8(text).alias(free_name(keep, "_body")))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in picked.schema.fields[:-1]]
    added = ["n_tokens long", "token_ids binary", *["decoded binary"] * round_trip]

    def run(batches: Batches) -> Batches:
        codec = _codec(ranks.value, pattern)
        for batch in batches:
            start = 0
            for group in _groups(value.as_py() for value in batch.column(batch.num_columns - 1)):
                packed = codec.encode(group)
                columns = [c.slice(start, len(group)) for c in batch.columns[:-1]]
                columns += [pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary())]
                if round_trip:
                    columns.append(pa.array(map(codec.decode, packed), pa.binary()))
                names = [*batch.schema.names[:-1], *(a.split()[0] for a in added)]
                yield pa.RecordBatch.from_arrays(columns, names)
                start += len(group)

    return map_batches(picked, run, ", ".join([*fields, *added]))


def decode(
    frame: DataFrame,
    keep: tuple[str, ...] = ("doc_id", "n_tokens", "token_ids"),
    ids: str = "token_ids",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
) -> DataFrame:
    """The ``keep`` columns and ``decoded``, the bytes of the packed ids of every row; NULL ids are none."""
    ranks = _rank_file(frame.sparkSession, vocabulary)
    picked = frame.select(*keep, F.coalesce(F.col(ids), F.lit(b"")).alias(free_name(keep, "_ids")))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in picked.schema.fields[:-1]]

    def run(batches: Batches) -> Batches:
        codec = _codec(ranks.value, pattern)
        for batch in batches:
            decoded = pa.array((codec.decode(v.as_py()) for v in batch.column(batch.num_columns - 1)), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], decoded], [*batch.schema.names[:-1], "decoded"])

    return map_batches(picked, run, ", ".join([*fields, "decoded binary"]))


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encode every document, decode the ids again, report both by digest."""
    return encode(table(spark, folder, "documents"), round_trip=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
