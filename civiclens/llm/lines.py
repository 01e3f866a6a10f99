"""Removal of repeated lines, up to one edited word in ten, by a deletion-neighbourhood and a prefix join.

Lines of n and more words may be ``edits(n)`` words apart, n being the length of the shorter. Where that is one edit, they
meet by deletion variants, as follows; where it is more, see the end.

A line is its words; its variants are the line itself and the line without any one of its words. Two
lines are at most one word apart (inserted, deleted or replaced) exactly if a variant of both is
equal and, when both lack a word, they lack it at the same place. Variants are emitted as hashed
keys with the place and joined on equality; the candidate found is verified on the words themselves.

Of every set of equal variants only the earliest line matters, so a minimum per key takes the
place of pairs: lines that thousands of documents share, or that differ in one word among
thousands, cost one row each. Before that, equal lines are one line, and of the rest only those can have a
partner that share their first or last half with another line; only these emit variants.

The variants of k edits would be n^k. Of a long line's runs of three words, k edits change 3k at most; so of two lines k edits apart
the 3k+1 rarest runs of one and of the other have one in common, rare being those that hold a rare pair of words. (Pairs would be fewer, but the
more lines there are, the more of them share a pair by chance.) A run that a line has several times is one key, as lines that share it a second time share
it a first time. The earliest line of each such key is met first; lines that are not near it and have keys of three lines or more meet all earlier ones of these.
Each line has a sketch of 64 bits, the parities of the bits that its words' hashes choose; one edit changes two of them at most, so most lines that
cannot be near are told apart by their sketches and only the rest by their words.

Lines are cut, hashed and given their keys for a whole chunk of texts at a time. Which lines are the first of their kind, and which keys
meet, tasks know from bit fields of fixed size, so what cannot meet is left out before it is shuffled; a false positive is left
out by the exact join behind.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.llm.common import Batches, Scratch, bit_field, has_bit, join_counted, map_batches, table, utf8
from civiclens.llm.hashing import Rolling, hashed_words, mixed

col = F.col

LEAST_WORDS = 8
"""Lines that are both shorter are repeated only if equal: one word of few is no small edit."""
EDIT_WORDS = 10
"""One edit is allowed for so many words."""
LONG_WORDS = 2 * EDIT_WORDS
"""From here on more than one edit is allowed; a line with one edit has up to this many words."""
GRAM_WORDS = 3
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
WHOLE = -1
"""Place of the variant that lacks no word."""
FLUSH = 1 << 16
CHUNK = 1 << 20
"""Bytes of text hashed at a time; a longer text is cut at line ends."""
BUCKETS = 1 << 18
"""Counters of how often pairs of words occur; the rarest ones are taken as keys."""
SLICE = 1 << 12
BEFORE = 8
"""Keys of a line that go with its next one, so that lines with many keys in common are one pair seldom more than once."""
FILTER_BITS = 27
LINE_END = re.compile(rb"\n")
AT = ("doc", "tag", "line")


def edits(n: int) -> int:
    """Inserted, deleted or replaced words that may tell a line of n words from one at least as long."""
    return max(1, n // EDIT_WORDS)


def _names(ddl: str) -> list[str]:
    return [column.split()[0] for column in ddl.split(", ")]


def _parts(batches: Batches) -> Iterator[tuple[list[tuple], list[bytes], list[int]]]:
    """(doc, tag), text and number of the first line of texts of about ``CHUNK`` bytes; a long text is cut at line ends."""
    keys, texts, firsts, size = [], [], [], 0
    for batch in batches:
        for doc, tag, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            body, start, number = body.as_py(), 0, 0
            while start < len(body):
                end = LINE_END.search(body, start + CHUNK)
                end = end.end() if end else len(body)
                part = body[start:end]
                keys.append((doc, tag))
                texts.append(part)
                firsts.append(number)
                number, start, size = number + part.count(b"\n"), end, size + len(part)
                if size >= CHUNK:
                    yield keys, texts, firsts
                    keys, texts, firsts, size = [], [], [], 0
    if texts:
        yield keys, texts, firsts


class Lines:
    """The lines with words of some texts: first word and word behind the last one, and where each stands."""

    def __init__(self, keys: list[tuple], texts: list[bytes], firsts: list[int]):
        self.hashes, owner, places = hashed_words(texts)
        body = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        ends = np.flatnonzero(body == 10)
        line = np.searchsorted(ends, places)
        head = np.flatnonzero(np.diff(line, prepend=-1))
        self.start, self.end = head, np.append(head[1:], len(line))[: len(head)]
        self.n = self.end - self.start
        # Line ends before a text: those inside the earlier texts and one behind each.
        starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])[:-1]
        own = owner[head]
        self.line = line[head] - np.searchsorted(ends, starts)[own] + np.array(firsts, dtype=np.int64)[own]
        self.doc, self.tag = (np.array(k, dtype=np.int64)[own] for k in zip(*keys))

    @functools.cached_property
    def rolling(self) -> Rolling:
        return Rolling(self.hashes)

    @functools.cached_property
    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each line's words."""
        second = Rolling(mixed(self.hashes + np.uint64(1)))
        return tuple(r.of(self.start, self.end).view(np.int64) for r in (self.rolling, second))

    def halves(self) -> pa.ListArray:
        """Keys of which lines one word apart share at least one: outer halves of this length and of one more word."""
        short = np.flatnonzero((self.n >= LEAST_WORDS - 1) & (self.n <= LONG_WORDS))
        start, end, n = self.start[short], self.end[short], self.n[short]
        rows, keys = [], []
        for half, which in (((n - 1) // 2, n > 0), (n // 2, n % 2 == 0)):
            for side, (low, high) in enumerate(((start, start + half), (end - half, end))):
                found = mixed(self.rolling.of(low, high) + (2 * half + side).astype(np.uint64))
                rows.append(short[which])
                keys.append(found[which].view(np.int64))
        row, key = np.concatenate(rows), np.concatenate(keys)
        order = np.argsort(row, kind="stable")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(self.n)))])
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(key[order]))

    def sketches(self) -> np.ndarray:
        """Parities of the bits chosen by each line's words."""
        bits = np.uint64(1) << (self.hashes >> np.uint64(58))
        return np.bitwise_xor.reduceat(bits, self.start).view(np.int64) if len(self.start) else self.start

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and line of all runs of so many words in long lines."""
        line = np.repeat(np.arange(len(self.n)), np.where(self.n >= LONG_WORDS, self.n, 0))
        ahead = np.cumsum(np.where(self.n >= LONG_WORDS, self.n, 0)) - np.where(self.n >= LONG_WORDS, self.n, 0)
        place = np.arange(len(line)) - ahead[line]
        kept = place <= self.n[line] - size
        return self.start[line[kept]] + place[kept], line[kept]

    @functools.cached_property
    def pairs(self) -> np.ndarray:
        """Hash of every word with the next one."""
        return mixed(self.hashes[:-1] * BASES[0] + self.hashes[1:])


def _counter(pairs: np.ndarray) -> np.ndarray:
    return (pairs & np.uint64(BUCKETS - 1)).astype(np.int64)


LINE_TABLE = "doc long, tag long, line int, n int, digest1 long, digest2 long, halves array<long>, counts binary"


def line_table(documents: DataFrame) -> DataFrame:
    """Place, words, digest and half keys of every line that is not blank.

    Besides, each task adds the counts of the word pairs it has seen, in rows that have ``counts`` and as ``line`` the number of a
    slice of the counters.
    """

    def run(batches: Batches) -> Batches:
        seen = np.zeros(BUCKETS, dtype=np.int64)
        for part in _parts(batches):
            found = Lines(*part)
            if not len(found.n):
                continue
            seen += np.bincount(_counter(found.pairs[found.runs(2)[0]]), minlength=BUCKETS)
            n = len(found.n)
            columns = [found.doc, found.tag, found.line.astype(np.int32), found.n.astype(np.int32), *found.digests]
            yield _batch([*(pa.array(c) for c in columns), found.halves(), pa.nulls(n, pa.binary())])
        slices = [(k, seen[k * SLICE : (k + 1) * SLICE]) for k in range(BUCKETS // SLICE)]
        slices = [(k, counts.tobytes()) for k, counts in slices if counts.any()]
        if slices:
            n = len(slices)
            none = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))]
            none[2] = pa.array([k for k, _ in slices], pa.int32())
            yield _batch([*none, pa.array([c for _, c in slices], pa.binary())])

    def _batch(columns: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(columns, _names(LINE_TABLE))

    return map_batches(documents, run, LINE_TABLE)


def pair_counts(lines: DataFrame) -> Broadcast:
    """How often each bucket of word pairs occurs; 2 MB whatever the input."""

    def run(batches: Batches) -> Batches:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts.as_buffer(), dtype=np.int64)
        columns = [pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["line", "counts"])

    counted = lines.where("counts IS NOT NULL").select("line", "counts").repartition(BUCKETS // SLICE, "line")
    total = np.zeros(BUCKETS, dtype=np.int64)
    for row in map_batches(counted, run, "line int, counts binary").collect():  # 64 rows
        total[row["line"] * SLICE : (row["line"] + 1) * SLICE] = np.frombuffer(bytes(row["counts"]), dtype=np.int64)
    return lines.sparkSession.sparkContext.broadcast(total)


def _line_bucket(doc: np.ndarray, tag: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Places of lines in the field of first ones."""
    return ((tag >> 13) ^ (doc << 20) ^ (line << 7)) & ((1 << FILTER_BITS) - 1)


def _line_bucket_column() -> Column:
    parts = [F.shiftright("tag", 13), F.shiftleft("doc", 20), F.shiftleft(col("line").cast("long"), 7)]
    return functools.reduce(lambda a, b: a.bitwiseXOR(b), parts).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


KEY_TABLE = "key long, place int, doc long, tag long, line int, n int, sketch long"


def run_keys(documents: DataFrame, counts: Broadcast, first_lines: Broadcast) -> DataFrame:
    """The rarest runs of the first long lines, with their place among the line's runs, its words and its sketch.

    A run that a line has several times has as many places and is a key for the first one only.
    """

    def run(batches: Batches) -> Batches:
        for part in _parts(batches):
            found = Lines(*part)
            if not len(found.n):
                continue
            first = has_bit(first_lines.value, _line_bucket(found.doc, found.tag, found.line))
            start, line = found.runs(GRAM_WORDS)
            start, line = start[first[line]], line[first[line]]
            if not len(start):
                continue
            grams = mixed(found.pairs[start] * BASES[0] + found.hashes[start + 2])
            rarity = np.minimum(*(counts.value[_counter(found.pairs[start + k])] for k in range(2)))
            order = np.lexsort((grams, line << 40 | np.minimum(rarity, (1 << 40) - 1)))
            grams, line = grams[order], line[order]
            at = np.arange(len(grams))
            head = np.append(True, line[1:] != line[:-1])
            fresh = head | np.append(True, grams[1:] != grams[:-1])
            rank = at - np.maximum.accumulate(np.where(head, at, 0))
            taken = np.flatnonzero(fresh & (rank <= GRAM_WORDS * np.maximum(1, found.n // EDIT_WORDS)[line]))
            keys, line = grams[taken], line[taken]
            columns = [keys.view(np.int64), rank[taken].astype(np.int32), found.doc[line], found.tag[line]]
            columns += [found.line[line].astype(np.int32), found.n[line].astype(np.int32), found.sketches()[line]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _names(KEY_TABLE))

    return map_batches(documents, run, KEY_TABLE)


def _texts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of the wanted lines, joined by single spaces."""
    numbers = wanted.groupBy("doc", "tag").agg(F.collect_set("line").alias("lines"))
    joined = documents.join(numbers, ["doc", "tag"]).select("doc", "tag", "body", "lines")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = [
                (doc, tag, number, b" ".join(lines[number].split()))
                for doc, tag, body, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3))
                for lines in [body.as_py().split(b"\n")]
                for number in numbers.as_py()
            ]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*AT, "words"])

    return map_batches(joined, run, "doc long, tag long, line int, words binary")


def variant_hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the line and of the line without each word: two polynomials over word hashes, in linear time."""
    hashed = np.array([xxhash.xxh3_64_intdigest(w, 1) for w in words], dtype=np.uint64)
    n, out = len(words), []
    for base in BASES:
        powers = np.ones(n + 1, dtype=np.uint64)
        powers[1:] = np.cumprod(np.full(n, base, dtype=np.uint64))
        # Sums of word k times base**(words behind it), modulo 2**64, with and without a word before k.
        behind = hashed * powers[n - 1 :: -1][:n]
        tail = np.concatenate([np.cumsum(behind[::-1])[::-1], np.zeros(1, dtype=np.uint64)])
        ahead = hashed[: n - 1] * powers[n - 2 :: -1][: n - 1] if n > 1 else hashed[:0]
        head = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(ahead)])
        out.append(np.concatenate([tail[:1], head + tail[1:]]).view(np.int64))
    return out[0], out[1]


def _variants(texts: DataFrame) -> DataFrame:
    """Hashed keys of all variants with the place of the missing word.

    A line under ``LEAST_WORDS`` is only met as a whole, by one that has a word more.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            held, size = [], 0
            for doc, tag, line, words in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3)):
                parts = words.as_py().split(b" ")
                if len(parts) > LONG_WORDS:
                    continue
                first, second = variant_hashes(parts)
                n = len(first) if len(parts) >= LEAST_WORDS else 1
                held.append((first[:n], second[:n], np.arange(WHOLE, len(parts))[:n], doc, tag, line))
                size += len(first)
                if size >= FLUSH:
                    yield _variant_batch(held)
                    held, size = [], 0
            if held:
                yield _variant_batch(held)

    def _variant_batch(held: list[tuple]) -> pa.RecordBatch:
        sizes = [len(h[0]) for h in held]
        spread = lambda k, kind: np.repeat(np.array([h[k] for h in held], dtype=kind), sizes)
        columns = [np.concatenate([h[k] for h in held]) for k in range(3)]
        columns[2] = columns[2].astype(np.int32)
        columns += [spread(3, np.int64), spread(4, np.int64), spread(5, np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key1", "key2", "place", *AT])

    return map_batches(texts, run, "key1 long, key2 long, place int, doc long, tag long, line int")


def within_one_word(left: list[bytes], right: list[bytes]) -> bool:
    """Whether one inserted, deleted or replaced word at most tells the lines apart."""
    longer, shorter = (left, right) if len(left) >= len(right) else (right, left)
    if len(longer) - len(shorter) > 1:
        return False
    same = 0
    while same < len(shorter) and longer[same] == shorter[same]:
        same += 1
    return longer[same + 1 :] == shorter[same + (len(longer) == len(shorter)) :]


def within_edits(left: list[bytes], right: list[bytes], most: int) -> bool:
    """Whether at most so many inserted, deleted or replaced words tell the lines apart.

    The columns of the distance matrix are kept as the bits of its steps (Myers, Hyyrö), so a word costs a few
    operations on whole numbers of as many bits as the shorter line has words.
    """
    start = 0
    while start < min(len(left), len(right)) and left[start] == right[start]:
        start += 1
    left, right = left[start:], right[start:]
    while left and right and left[-1] == right[-1]:
        left, right = left[:-1], right[:-1]
    shorter, longer = sorted((left, right), key=len)
    distance = len(shorter)
    if not shorter or len(longer) - len(shorter) > most:
        return len(longer) <= most
    places: dict[bytes, int] = {}
    for i, word in enumerate(shorter):
        places[word] = places.get(word, 0) | 1 << i
    full, last = (1 << len(shorter)) - 1, 1 << (len(shorter) - 1)
    up, down = full, 0
    for i, word in enumerate(longer, 1):
        equal = places.get(word, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        more, less = down | (full & ~(across | up)), up & across
        distance += bool(more & last) - bool(less & last)
        if distance - (len(longer) - i) > most:
            return False
        more, less = more << 1 | 1, less << 1
        up, down = full & (less | ~(vertical | more)), full & more & vertical
    return distance <= most


def _verified(pairs: DataFrame) -> DataFrame:
    """Places of the first of two lines whose words are no more edits apart than allowed."""

    def near(left: list[bytes], right: list[bytes]) -> bool:
        most = edits(min(len(left), len(right)))
        return within_one_word(left, right) if most == 1 else within_edits(left, right, most)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            kept = [
                near(a.as_py().split(b" "), b.as_py().split(b" "))
                for a, b in zip(batch.column(3), batch.column(4))
            ]
            yield batch.filter(pa.array(kept, pa.bool_())).select([0, 1, 2])

    return map_batches(pairs.select(*AT, "words", "at_words"), run, "doc long, tag long, line int")


def _at(prefix: str = "") -> Column:
    return F.struct(*[col(prefix + c).alias(c) for c in AT])


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The lines whose pairs (place and ``at_`` place of an earlier line) hold on the words."""
    other = texts.select(*[col(c).alias(f"at_{c}") for c in (*AT, "words")])
    joined = pairs.join(texts, list(AT)).join(other, [f"at_{c}" for c in AT])
    return _verified(joined).distinct()


def near_copies(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Place of every line up to ``LONG_WORDS`` words with an earlier one at most one word apart."""
    variants = scratch.stage(_variants(texts), "variants")
    at, key = _at(), ["key1", "key2"]
    # Most variants belong to one line; only the rest is looked at by place.
    several = variants.groupBy(*key).agg(F.min(at).alias("low"), F.max(at).alias("high")).where("low < high").select(*key)
    variants = scratch.stage(variants.join(several, key, "left_semi"), "met-variants")
    scratch.drop("variants")
    by_place = variants.groupBy(*key, "place").agg(F.min(at).alias("first"))
    whole = F.min(F.when(col("place") == WHOLE, at))
    by_key = variants.groupBy(*key).agg(F.min(at).alias("any"), whole.alias("whole"))
    # A line meets the lines lacking a word at its place, the variant itself as a line, and as a line all of them.
    met = variants.join(by_key, key)
    alike = variants.join(by_place, [*key, "place"])
    earliest = lambda first: col(first).isNotNull() & (col(first) < at)
    partner = F.when(col("place") == WHOLE, col("any")).otherwise(col("whole"))
    found = (
        met.select(*AT, partner.alias("first"))
        .union(alike.select(*AT, "first"))
        .where(earliest("first"))
        .distinct()
        .select(*AT, *[col(f"first.{c}").alias(f"at_{c}") for c in AT])
    )
    return _compared(scratch.stage(found, "found"), texts)


def met_keys(documents: DataFrame, lines: DataFrame, firsts: DataFrame, scratch: Scratch) -> DataFrame:
    """The rarest runs that several long lines have, with the earliest of these; of equal lines the earliest stands for all.

    Of a key of two lines there is a row only if they may be near: for a later look at all lines of a key it has nothing left.
    """
    long = firsts.where(col("n") >= LONG_WORDS).select("first.*")
    first_lines = bit_field(long, _line_bucket_column(), FILTER_BITS)
    keys = scratch.stage(run_keys(documents, pair_counts(lines), first_lines), "run-keys")
    scratch.drop("lines")
    several = keys.groupBy("key").agg(F.count("*").alias("places")).where("places > 1").select("key")
    field = bit_field(several, col("key").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)), FILTER_BITS)
    scratch.release()

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield batch.filter(pa.array(has_bit(field.value, batch.column(0).to_numpy() & ((1 << FILTER_BITS) - 1))))

    met = scratch.stage(map_batches(keys, run, KEY_TABLE), "met-keys")
    scratch.drop("run-keys")
    members = [*AT, "n", "place", "sketch"]
    first = met.groupBy("key").agg(F.min(F.struct(*members)).alias("first"), F.count("*").alias("places"))
    first = scratch.stage(first.where("places > 1"), "first-keys")
    scratch.release()
    starred = join_counted(met, first, ["key"], "places")
    starred = scratch.stage(starred.where((col("places") > 2) | _near_first()), "starred-keys")
    for done in ("met-keys", "first-keys"):
        scratch.drop(done)
    scratch.release()
    return starred


def _possible(earlier: Callable[[str], Column]) -> Column:
    """Whether lines with a pair in common can be near: by their words, the places of the pair in their order, and their sketches."""
    n, place = col("n"), col("place")
    shorter, longer = F.least(n, earlier("n")), F.greatest(n, earlier("n"))
    most = F.greatest(F.lit(1), F.floor(shorter / EDIT_WORDS))
    behind = F.least(n - place, earlier("n") - earlier("place")) - (GRAM_WORDS - 1)
    shared = behind >= longer - (GRAM_WORDS - 1) - GRAM_WORDS * most
    return (longer - shorter <= most) & shared & (F.bit_count(col("sketch").bitwiseXOR(earlier("sketch"))) <= 2 * most)


def _near_first() -> Column:
    """Whether a line comes after the earliest one of its key and may be near it."""
    return _behind_first() & _possible(lambda c: col(f"first.{c}"))


def _behind_first() -> Column:
    return F.struct(*[col(f"first.{c}").alias(c) for c in AT]) < _at()


def _star_pairs(met: DataFrame) -> DataFrame:
    """Lines and the earliest line of one of their keys that may be near."""
    return met.where(_near_first()).select(*AT, *[col(f"first.{c}").alias(f"at_{c}") for c in AT]).distinct()


def _with_before(met: DataFrame) -> DataFrame:
    """The rows with the keys just before theirs in the line's order."""
    ahead = Window.partitionBy(*AT).orderBy("place").rowsBetween(-BEFORE, -1)
    return met.withColumn("before", F.collect_list("key").over(ahead))


def _all_pairs(left: DataFrame, met: DataFrame) -> DataFrame:
    """Lines of ``left`` and all earlier lines of their keys, behind the earliest one, that may be near.

    Lines are no pair at a key if they have one of the keys before it in common: at the first key they have in common they are one, or the earlier
    line is that key's earliest, which the other one is known not to be near.
    """
    earlier = met.where(_behind_first()).select("key", *[col(c).alias(f"at_{c}") for c in (*AT, "n", "place", "sketch", "before")])
    rest = left.where(_behind_first()).drop("first").join(earlier, "key")
    once = ~F.arrays_overlap("before", "at_before")
    rest = rest.where((_at("at_") < _at()) & _possible(lambda c: col(f"at_{c}")) & once)
    return rest.select(*AT, *[f"at_{c}" for c in AT]).distinct()


def _of_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(*AT).union(pairs.select(*[f"at_{c}" for c in AT])).distinct()


def repeated_lines(frame: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, tag (the hash of its text) and ``removed``, the numbers (from 0) of its lines that repeat an earlier one.

    Lines end at a line feed; blank ones take no part. A line repeats another if the words are equal or,
    if the longer has ``LEAST_WORDS`` words, at most ``edits(words of the shorter)`` words are inserted, deleted or replaced. Earlier means a
    smaller doc_id, or a smaller number in the same document; lines are compared with the input, not with what is
    left of it. A NULL text has no lines, a document without an id takes no part, rows repeated whole
    are one document, and two texts under one id are two documents in the order of their hashes.
    """
    scratch = Scratch(frame.sparkSession, "lines")
    documents = frame.where(col(id_column).isNotNull()).select(col(id_column).cast("long").alias("doc"), utf8(text).alias("body"))
    documents = documents.select("doc", F.xxhash64("body").alias("tag"), "body")
    lines = scratch.stage(line_table(documents), "lines")
    placed, key = lines.where("counts IS NULL"), ["digest1", "digest2"]
    firsts = placed.groupBy(*key).agg(
        F.min(_at()).alias("first"), F.first("halves").alias("halves"), F.first("n").alias("n"), F.count("*").alias("places")
    )
    firsts = scratch.stage(firsts, "firsts")
    copied = join_counted(placed.select(*AT, *key), firsts.where("places > 1").select(*key, "first", "places"), key, "places")
    copies = scratch.stage(copied.where(_at() > col("first")).select(*AT), "copies")

    halves = firsts.where(F.size("halves") > 0).select("first.*", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1")  # a line has a half once
    wanted = scratch.stage(halves.join(shared, "half", "left_semi").select(*AT).distinct(), "wanted")
    scratch.release()
    met = met_keys(documents, lines, firsts, scratch)
    stars = scratch.stage(_star_pairs(met), "star-pairs")
    texts = scratch.stage(_texts(documents, wanted.union(_of_pairs(stars)).distinct()), "texts")
    scratch.release()
    near = [scratch.stage(near_copies(texts, scratch), "near"), scratch.stage(_compared(stars, texts), "near-long")]
    for done in ("met-variants", "texts"):
        scratch.drop(done)
    # Lines that are not near the earliest one of a key have not met the others yet. The field of first lines may have let a copy through.
    long = firsts.where(col("n") >= LONG_WORDS).select("first.*")
    crowded = scratch.stage(_with_before(met.where("places > 2").drop("places").join(long, list(AT), "left_semi")), "crowded-keys")
    for done in ("firsts", "starred-keys", "star-pairs"):
        scratch.drop(done)
    scratch.release()
    others = scratch.stage(_all_pairs(crowded.join(near[1], list(AT), "left_anti"), crowded), "other-pairs")
    scratch.release()
    if not others.isEmpty():
        near.append(scratch.stage(_compared(others, _texts(documents, _of_pairs(others))), "near-others"))
    for more in near:
        copies = copies.union(more)
    removed = copies.groupBy("doc", "tag").agg(F.sort_array(F.collect_set("line")).alias("removed"))
    removed = scratch.stage(removed, "removed")
    for done in ("crowded-keys", "other-pairs", "wanted", "copies", "near", "near-long", "near-others"):
        scratch.drop(done)
    scratch.release()
    return removed


def without_lines(text: Column, removed: Column) -> Column:
    """The text without its numbered lines; NULL stays NULL, and no numbers change nothing."""
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
    rebuilt = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return F.when(removed.isNull() | text.isNull(), text).otherwise(rebuilt)


def _with_removed(documents: DataFrame) -> DataFrame:
    """``row`` (all columns of a document) and ``removed``, the numbers of its repeated lines or NULL."""
    columns = [documents[f"`{c}`"] for c in documents.columns]
    tag = F.xxhash64(F.coalesce(documents["text"].cast("binary"), F.lit(b"")))
    keyed = documents.select(F.struct(*columns).alias("row"), documents["doc_id"].cast("long").alias("doc"), tag.alias("tag"))
    return keyed.join(repeated_lines(documents.select("doc_id", "text")), ["doc", "tag"], "left").select("row", "removed")


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents with their columns, their repeated lines removed; no document is dropped."""
    joined = _with_removed(documents)
    text = without_lines(col("row").getField("text"), col("removed"))
    columns = {"text": text, "n_chars": F.length(text).cast("long")}
    return joined.select(*[columns.get(c, col("row").getField(c)).alias(c) for c in documents.columns])


def op10_line_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Lines removed from every document, and the digest of what is left."""
    joined = _with_removed(table(spark, folder, "documents").select("doc_id", "text")).select("row.*", "removed")
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    return joined.select(
        "doc_id",
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.sha2(F.coalesce(without_lines(col("text"), col("removed")), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
