"""Removal of word runs that start earlier in the corpus, by suffix automata of reference shards.

Every window of ``length`` words belongs to the smallest hash of the ``gram``-word pieces in it, its anchor, so
equal windows have the same anchor at the same distance wherever they stand. Consecutive windows with one anchor
form a fragment, in which no two windows are equal; one alone with its anchor is done, which a bit field of fixed size tells before
anything is shuffled. Of equal fragments the earliest is the reference; the others are
repeated whole. The references that share an anchor are a shard: it has a suffix automaton, and its fragments are streamed
through it in the order of the corpus, each before it is added. Matching statistics, the length of the
longest match that ends at a word, give the maximal spans that stand in an earlier fragment.

The reference is the corpus itself, so automata of all of it cannot be broadcast: instead each fragment goes to the one shard that can
hold its windows. A shard of more than ``HOT`` references (the edge of a passage that thousands of texts quote) is cut into
single windows, whose earliest is found by a map-side minimum, so no automaton grows with the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.common import Batches, Scratch, bit_field, has_bit, join_counted, map_batches, table, utf8
from civiclens.llm.hashing import Rolling, hashed_words, mixed

col = F.col

LENGTH = 20
GRAM = 6
HOT = 256
"""References under one anchor from which they are cut into windows."""
CHUNK = 4 << 20
"""Bytes of text hashed at a time."""
ROWS = 1 << 16
FILTER_BITS = 27
"""Bits of the field (16 MB, whatever the input) that tells which anchors can occur twice."""
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    windows = len(values) - width + 1
    return np.minimum(out[:windows], out[width - span : width - span + windows])


def fragments(hashes: np.ndarray, owner: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """First word, number of windows, anchor and digest of every fragment; windows lie within one text."""
    windows = len(hashes) - length + 1
    if windows <= 0:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    rolling = Rolling(hashes)
    grams = rolling.of(slice(0, len(hashes) - gram + 1), slice(gram, len(hashes) + 1))
    least = _smallest(grams, length - gram + 1)
    valid = owner[:windows] == owner[length - 1 :]
    head = np.ones(windows, dtype=bool)
    # The anchor changes when a smaller hash comes in or the present one drops out.
    head[1:] = (least[1:] != least[:-1]) | (grams[: windows - 1] == least[:-1]) | ~valid[:-1]
    breaks = np.flatnonzero(head | ~valid)
    counts = np.diff(np.append(breaks, windows))
    starts, counts = breaks[valid[breaks]], counts[valid[breaks]]
    digests = rolling.of(starts, starts + counts + length - 1)
    return starts, counts, least[starts].view(np.int64), digests.view(np.int64)


def _parts(batches: Batches, length: int) -> Iterator[tuple[list, list[bytes], np.ndarray, np.ndarray, int]]:
    """Keys and texts of about ``CHUNK`` bytes, their words' hashes and owners, and how many words came before.

    A longer text comes alone and in parts that overlap by ``length - 1`` words, so that each window is in exactly one.
    """
    keys, texts, size = [], [], 0
    for batch in batches:
        for doc, tag, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            body = body.as_py()
            if len(body) > 2 * CHUNK:
                before, start = 0, 0
                while start < len(body):
                    end = SPACE.search(body, start + CHUNK)
                    end = end.start() if end else len(body)
                    hashes, owner, places = hashed_words([body[start:end]])
                    if end < len(body) and len(hashes) < 2 * length:
                        end = len(body)
                        hashes, owner, places = hashed_words([body[start:]])
                    yield [(doc, tag)], [body[start:end]], hashes, owner, before
                    if end == len(body):
                        break
                    before, start = before + len(hashes) - length + 1, start + int(places[1 - length])
                continue
            keys.append((doc, tag))
            texts.append(body)
            size += len(body)
            if size >= CHUNK:
                yield keys, texts, *hashed_words(texts)[:2], 0
                keys, texts, size = [], [], 0
    if texts:
        yield keys, texts, *hashed_words(texts)[:2], 0


def _anchors(bodies: DataFrame, length: int, gram: int) -> DataFrame:
    """The anchors of all fragments."""

    def run(batches: Batches) -> Batches:
        for _, _, hashes, owner, _ in _parts(batches, length):
            yield pa.RecordBatch.from_arrays([pa.array(fragments(hashes, owner, length, gram)[2])], ["anchor"])

    return map_batches(bodies, run, "anchor long")


def _cut(bodies: DataFrame, length: int, gram: int, met: Broadcast) -> DataFrame:
    """The fragments whose anchors ``met`` has, with the first word's number in the text."""

    def run(batches: Batches) -> Batches:
        for keys, _, hashes, owner, before in _parts(batches, length):
            found = fragments(hashes, owner, length, gram)
            several = has_bit(met.value, found[2] & ((1 << FILTER_BITS) - 1))
            starts, counts, anchors, digests = (part[several] for part in found)
            docs, tags = (np.array(k, dtype=np.int64) for k in zip(*keys))
            own = owner[starts] if len(starts) else starts
            at = starts - np.searchsorted(owner, own) + before
            columns = [docs[own], tags[own], at.astype(np.int32), counts.astype(np.int32), anchors, digests]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], ["doc", "tag", "start", "n", "anchor", "digest"]
            )

    return map_batches(bodies, run, "doc long, tag long, start int, n int, anchor long, digest long")


def _at(prefix: str = "") -> Column:
    return F.struct(*[col(prefix + c).alias(c) for c in ("doc", "tag", "start")])


def _with_words(references: DataFrame, bodies: DataFrame, length: int) -> DataFrame:
    """The references with the hashes of their words."""
    wanted = references.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "n", "anchor", "variants")).alias("cut"))
    joined = bodies.join(wanted, ["doc", "tag"]).select("doc", "tag", "body", "cut")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for doc, tag, body, cut in zip(*(batch.column(i) for i in range(4))):
                hashes = hashed_words([body.as_py()])[0]
                fields = cut.values.flatten()
                starts, counts, anchors, variants = (f.to_numpy(zero_copy_only=False) for f in fields)
                for at in range(0, len(starts), ROWS):
                    part = slice(at, at + ROWS)
                    words = [hashes[s : s + n + length - 1].tobytes() for s, n in zip(starts[part].tolist(), counts[part].tolist())]
                    n = len(words)
                    columns = [pa.array(np.full(n, k.as_py(), dtype=np.int64)) for k in (doc, tag)]
                    columns += [pa.array(c[part]) for c in (starts, anchors, variants)] + [pa.array(words, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc", "tag", "start", "anchor", "variants", "words"])

    def packed(batches: Batches) -> Batches:
        held, rows = [], 0
        for batch in run(batches):
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS // 4:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return map_batches(joined, packed, "doc long, tag long, start int, anchor long, variants long, words binary")


class SuffixAutomaton:
    """Of the sequences added, all runs of symbols that stand in one of them."""

    def __init__(self) -> None:
        self.steps: list[dict[int, int]] = [{}]
        self.links = [-1]
        self.sizes = [0]

    def add(self, symbols: list[int]) -> None:
        steps, links, sizes = self.steps, self.links, self.sizes
        last = 0
        for symbol in symbols:
            known = steps[last].get(symbol)
            if known is not None and sizes[known] == sizes[last] + 1:
                last = known
                continue
            if known is not None:
                last = self._copy(last, symbol, known)
                continue
            state = len(steps)
            steps.append({})
            links.append(0)
            sizes.append(sizes[last] + 1)
            while last >= 0 and symbol not in steps[last]:
                steps[last][symbol] = state
                last = links[last]
            if last >= 0:
                known = steps[last][symbol]
                links[state] = known if sizes[known] == sizes[last] + 1 else self._copy(last, symbol, known)
            last = state

    def _copy(self, state: int, symbol: int, known: int) -> int:
        """Split off the part of ``known`` that is reached from ``state`` and shorter ones."""
        copy = len(self.steps)
        self.steps.append(dict(self.steps[known]))
        self.links.append(self.links[known])
        self.sizes.append(self.sizes[state] + 1)
        self.links[known] = copy
        while state >= 0 and self.steps[state].get(symbol) == known:
            self.steps[state][symbol] = copy
            state = self.links[state]
        return copy

    def matches(self, symbols: list[int]) -> list[int]:
        """Length of the longest run that ends at each symbol and stands in a sequence added."""
        steps, links, sizes = self.steps, self.links, self.sizes
        state, size, out = 0, 0, []
        for symbol in symbols:
            after = steps[state].get(symbol)
            while after is None and state:
                state = links[state]
                size = sizes[state]
                after = steps[state].get(symbol)
            if after is not None:
                state, size = after, size + 1
            out.append(size)
        return out


def spans_of(sizes: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal spans covered by matches of at least the length."""
    spans: list[tuple[int, int]] = []
    for end, size in enumerate(sizes, 1):
        if size >= length:
            start = end - size
            if spans and start <= spans[-1][1]:
                spans[-1] = (min(spans[-1][0], start), end)
            else:
                spans.append((start, end))
    return spans


SPANS = "doc long, tag long, start int, end int"


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "tag", "start", "end"])


def _by_automata(references: DataFrame, length: int) -> DataFrame:
    """Spans of the references that stand in an earlier one of their shard."""

    def run(batches: Batches) -> Batches:
        anchor, earlier, automaton, found = None, None, SuffixAutomaton(), []
        for batch in batches:
            words = batch.column(4)
            for i, row in enumerate(zip(*(batch.column(k).to_pylist() for k in range(4)))):
                if row == earlier:  # a row repeated whole
                    continue
                symbols = np.frombuffer(words[i].as_buffer(), dtype=np.uint64).tolist()
                if row[0] != anchor:
                    anchor, automaton = row[0], SuffixAutomaton()
                else:
                    spans = spans_of(automaton.matches(symbols), length)
                    found += [(row[1], row[2], row[3] + a, row[3] + b) for a, b in spans]
                automaton.add(symbols)
                earlier = row
            if len(found) >= ROWS:
                yield _spans(found)
                found = []
        yield _spans(found)

    order = ["anchor", "doc", "tag", "start"]
    dealt = references.select(*order, "words").repartition("anchor").sortWithinPartitions(*order)
    return map_batches(dealt, run, SPANS)


def _by_windows(references: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """The same for shards that are too large: equal windows meet by 128 bits of hash."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            held = []
            for doc, tag, start, words in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(3)):
                hashes = np.frombuffer(words.as_buffer(), dtype=np.uint64)
                first = np.arange(len(hashes) - length + 1)
                keys = [Rolling(h).of(first, first + length).view(np.int64) for h in (hashes, mixed(hashes + np.uint64(1)))]
                held.append((np.full(len(first), doc), np.full(len(first), tag), (first + start).astype(np.int32), *keys))
            columns = [np.concatenate(c) for c in zip(*held)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "tag", "start", "key1", "key2"])

    cut = map_batches(references.select("doc", "tag", "start", "words"), run, "doc long, tag long, start int, key1 long, key2 long")
    windows = scratch.stage(cut, "windows")
    first = windows.groupBy("key1", "key2").agg(F.min(_at()).alias("first"), F.count("*").alias("places"))
    first = scratch.stage(first.where("places > 1"), "first-windows")
    met = join_counted(windows, first, ["key1", "key2"], "places").where(_at() > col("first"))
    return met.select("doc", "tag", "start", (col("start") + length).alias("end"))


def repeated_words(bodies: DataFrame, length: int, gram: int, scratch: Scratch) -> DataFrame:
    """doc, tag, start and end (words) of spans covered by windows that start earlier too; spans may overlap.

    ``bodies`` has doc and tag (long), which together name a text, and body (binary).
    """
    anchors = _anchors(bodies, length, gram).groupBy("anchor").agg(F.count("*").alias("places")).where("places > 1")
    met = bit_field(anchors, col("anchor").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)), FILTER_BITS)
    scratch.release()
    # A fragment alone with its anchor holds no window that stands elsewhere.
    cut = scratch.stage(_cut(bodies, length, gram, met), "fragments")
    first = cut.groupBy("anchor", "digest").agg(F.min(_at()).alias("first"), F.first("n").alias("n"), F.count("*").alias("places"))
    first = scratch.stage(first, "references")
    scratch.release()
    copied = join_counted(cut, first.where("places > 1").select("anchor", "digest", "first", "places"), ["anchor", "digest"], "places")
    copies = copied.where(_at() > col("first")).select("doc", "tag", "start", (col("start") + col("n") + (length - 1)).alias("end"))
    found = [scratch.stage(copies, "spans-copies")]
    scratch.drop("fragments")
    scratch.release()
    shards = first.groupBy("anchor").agg(F.count("*").alias("variants")).where("variants > 1")
    references = first.select("anchor", "first.*", "n").join(shards, "anchor")
    references = scratch.stage(_with_words(references, bodies, length), "words")
    scratch.drop("references")
    scratch.release()
    found.append(scratch.stage(_by_automata(references.where(col("variants") <= HOT), length), "spans-automata"))
    hot = references.where(col("variants") > HOT)
    if not hot.isEmpty():
        found.append(scratch.stage(_by_windows(hot, length, scratch), "spans-windows"))
        scratch.drop("windows")
    scratch.drop("words")
    scratch.release()
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def without_repeated_words(
    frame: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """doc_id, n_words, spans (maximal removed runs of words) and kept (the words left, joined by one space) of every row.

    Words end at blanks and ASCII white space and are compared unchanged; NULL text has none. Windows are judged on the input and do
    not cross texts. Earlier means a smaller id, or the same text and an earlier start; two texts under one id are two
    documents, in the order of their hashes. Rows repeated whole are one document and lose the same. A row without an id
    takes no part and is kept whole. Equality rests on 64 bits of hash per word and 128 per window or fragment.
    """
    scratch = Scratch(frame.sparkSession, "automata")
    named = frame.select(col(id_column).cast("long").alias("doc"), utf8(text).alias("body"))
    named = named.select("doc", F.xxhash64("body").alias("tag"), "body")
    found = repeated_words(named.where("doc IS NOT NULL"), length, gram, scratch)
    by_text = found.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    joined = named.join(by_text, ["doc", "tag"], "left").select("doc", "body", "found")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for body, found in zip(batch.column(1), batch.column(2)):
                words = body.as_py().split()
                runs: list[list[int]] = []
                for s in sorted(found.as_py() or (), key=lambda s: s["start"]):
                    if runs and s["start"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s["end"])
                    else:
                        runs.append([s["start"], s["end"]])
                edges = [0, *(edge for r in runs for edge in r), len(words)]
                sizes.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b" ".join([w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "spans", "kept"])

    return map_batches(joined, run, "doc_id long, n_words long, spans array<struct<start: int, end: int>>, kept binary")


def op11_automata_words(spark: SparkSession, folder: str) -> DataFrame:
    """What every document loses, and the digest of what it keeps."""
    found = without_repeated_words(table(spark, folder, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
