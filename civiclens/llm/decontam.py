"""Benchmark decontamination by latent semantic retrieval.

Texts are windows of words (passages), weighted by TF-IDF over hashed terms; document frequencies
count every document. A randomised SVD of all passages, the benchmark's and the corpus's, gives a latent
space. Terms outside the benchmark's vocabulary cannot bring a passage closer to an item, so the space has the
benchmark's terms, and of the passage matrix A only A'A is needed: one pass over the texts counts exactly how often two terms
share a passage, and each step of the SVD multiplies these counts on the executors. Every passage of the corpus is
weighed, and those with enough of their weight on these terms are projected.

Passages near an item by cosine are candidates. Each is verified on its words: the longest common
subsequence with the item, and for paraphrases also that with the item's answer (its last sentence).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.llm.common import Batches, Scratch, map_batches, table
from civiclens.llm.repeats import Rolling

col = F.col

TERMS = 1 << 18
"""Hashed terms: the bound of all statistics that tasks hold."""
WINDOW, STRIDE, ITEM_STRIDE = 24, 8, 12
RANK, OVERSAMPLE, POWER_STEPS = 256, 16, 2
DENSE_TERMS = 1 << 12
"""Largest vocabulary whose pairs a task counts in a table of all of them (67 MB)."""
PART_PLACES = 1 << 16
"""Places whose pairs are counted at a time."""
HELD_PAIRS = 1 << 21
"""Pairs that a task holds for a larger vocabulary, before it adds them up and gives them out."""
BLOCK_ITEMS = 5_000
"""Benchmark items searched at a time; larger benchmarks take several passes over the corpus."""
SHARE = 0.3
"""Least share of a passage's IDF weight on terms of the benchmark. A passage half of whose words are an
item's has about as much, even if the others are the rarest; most of ordinary prose has less."""
COSINE = 0.4
OVERLAP = 0.4
"""Least share of an item passage's terms in a candidate: a leak in the passage's place has half of them at least."""
VERBATIM = 0.75
PARAPHRASE = 0.5
ANSWER = 0.8
"""Shares of the item's (the answer's) words in the longest common subsequence that make a leak."""
SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")
BATCH_BYTES = 1 << 20


def _word_bytes() -> np.ndarray:
    """Bytes of words: ASCII letters and digits, and whatever is beyond ASCII."""
    return np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


WORD_BYTES = _word_bytes()


@dataclass
class Words:
    """Lower-case words of some texts, put one after the other."""

    body: bytes
    starts: np.ndarray
    ends: np.ndarray
    terms: np.ndarray
    bounds: np.ndarray
    """First word of each text, and the number of all words."""

    @staticmethod
    def of(texts: list[str]) -> Words:
        lowered = [text.lower().encode("utf-8", "replace") for text in texts]
        body = b"\n".join([*lowered, b""])
        signs = np.frombuffer(body, dtype=np.uint8)
        inside = WORD_BYTES[signs]
        # General punctuation (U+2000 to U+207F) is none of a word's signs.
        marks = np.flatnonzero(signs[:-2] == 0xE2) if len(signs) > 2 else np.empty(0, dtype=np.int64)
        marks = marks[(signs[marks + 1] == 0x80) | (signs[marks + 1] == 0x81)]
        for k in range(3):
            inside[marks + k] = False
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        hashes = np.empty(len(starts), dtype=np.uint64)
        for first in range(0, len(starts), BATCH_BYTES // 4):  # bounds the sums over one very long text
            part = slice(first, first + BATCH_BYTES // 4)
            low = starts[part][0]
            rolling = Rolling(signs[low : ends[part][-1]])
            hashes[part] = rolling.of(starts[part] - low, ends[part] - low)
        offsets = np.cumsum([0, *(len(t) + 1 for t in lowered)])
        terms = (hashes % np.uint64(TERMS)).astype(np.int64)
        return Words(body, starts, ends, terms, np.searchsorted(starts, offsets))

    def list(self, first: int, last: int) -> list[bytes]:
        return [self.body[a:b] for a, b in zip(self.starts[first:last].tolist(), self.ends[first:last].tolist())]


def word_list(text: str) -> list[bytes]:
    words = Words.of([text])
    return words.list(0, len(words.starts))


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, Words]]:
    """Words of the batch's texts, about a megabyte at a time, with the row they begin at."""
    first, held, size = 0, [], 0
    for row, value in enumerate(batch.column(column)):
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= BATCH_BYTES:
            yield first, Words.of(held)
            first, held, size = row + 1, [], 0
    if held:
        yield first, Words.of(held)


def window_starts(words: int, stride: int) -> np.ndarray:
    """Starts of the windows of a text: every ``stride`` words, and the last whole one."""
    return all_windows(np.array([0, words]), stride)[1]


def all_windows(bounds: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end of the windows of several texts, as ``window_starts`` has them."""
    lengths = np.diff(bounds)
    last = np.maximum(0, lengths - WINDOW)
    each = np.where(lengths > 0, last // stride + 1 + (last % stride != 0), 0)
    text = np.repeat(np.arange(len(lengths)), each)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    start = np.minimum(nth * stride, last[text])
    return text, bounds[text] + start, bounds[text] + np.minimum(start + WINDOW, lengths[text])


def window_terms(terms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of ``WINDOW`` terms per window, -1 beyond its end."""
    at = starts[:, None] + np.arange(WINDOW)
    return np.where(at < ends[:, None], terms[np.minimum(at, len(terms) - 1)], -1)


def shared_count(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many of the right's terms are in the left, row by row; the right's are distinct, padded with -2."""
    parts = [np.empty(0, dtype=np.int64)]
    for at in range(0, len(left), 4096):  # bounds the comparisons held at a time
        a, b = left[at : at + 4096], right[at : at + 4096]
        parts.append((a[:, :, None] == b[:, None, :]).any(axis=1).sum(axis=1))
    return np.concatenate(parts)


def common_subsequence(left: list, right: list) -> int:
    """Length of the longest common subsequence, a bit per word of the left."""
    places: dict = {}
    for i, word in enumerate(left):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(left)) - 1
    state = full
    for word in right:
        match = places.get(word, 0)
        if match:
            hit = state & match
            state = ((state + hit) | (state - hit)) & full
    return len(left) - state.bit_count()


@dataclass(frozen=True)
class Item:
    item_id: int
    text: str
    words: list[bytes]
    answer: list[bytes]

    @staticmethod
    def of(item_id: int, text: str) -> Item:
        words = word_list(text)
        last = [word_list(sentence) for sentence in SENTENCE_END.split(text)]
        # A sentence of a word or two is no answer; the last quarter of the item then is.
        answer = next((s for s in reversed(last) if len(s) >= 3), None)
        if answer is None or len(answer) == len(words):
            answer = words[-max(1, len(words) // 4) :]
        return Item(item_id, text, words, answer)

    def leak(self, region: list[bytes]) -> tuple[float, float, bool]:
        """Shares of the item's and the answer's words in common subsequences, and the verdict."""
        near = len(set(self.words) & set(region)) / len(set(self.words))
        if near < PARAPHRASE / 2:
            return 0.0, 0.0, False
        whole = common_subsequence(self.words, region) / len(self.words)
        answer = common_subsequence(self.answer, region) / len(self.answer)
        return whole, answer, whole >= VERBATIM or (whole >= PARAPHRASE and answer >= ANSWER)


@dataclass
class Space:
    """What a task needs to project passages: term weights, the basis, and the items' passages."""

    idf: np.ndarray
    row: np.ndarray
    """Row of a term in the basis; the last one (zeros) for terms outside."""
    basis: np.ndarray

    def __post_init__(self) -> None:
        self.known = self.row < len(self.basis) - 1

    def windows(self, terms: np.ndarray) -> np.ndarray:
        """Latent vectors of windows (a row of terms each, -1 beyond the text): sums of term weight times the term's row."""
        rows = np.where(terms < 0, len(self.basis) - 1, self.row[terms])
        total = np.zeros((len(rows), self.basis.shape[1]), dtype=self.basis.dtype)
        for place in rows.T:  # a place at a time, so that the sums stay in the cache
            total += self.basis[place]
        return total

    def related(self, terms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether windows have enough weight on the benchmark's terms."""
        weight = self.idf[terms].astype(np.float64)
        total = np.append(0.0, np.cumsum(weight))
        inside = np.append(0.0, np.cumsum(weight * self.known[terms]))
        return inside[ends] - inside[starts] >= SHARE * (total[ends] - total[starts])


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


class Pairs:
    """How often two terms of a vocabulary share a passage: the entries on and below the diagonal of T'T, T the passages' term counts.

    Every passage counts for any two of its places; a place with itself, too.
    """

    def __init__(self, vocabulary: np.ndarray):
        self.terms = vocabulary.astype(np.int64)
        self.row = np.full(TERMS, -1, dtype=np.int64)
        self.row[vocabulary] = np.arange(len(vocabulary))
        self.before = np.arange(len(vocabulary), dtype=np.int64)
        self.before = self.before * (self.before + 1) // 2
        """Pairs in the rows before a row of the triangle."""
        self.table = np.zeros(len(vocabulary) * (len(vocabulary) + 1) // 2, dtype=np.int64) if len(vocabulary) <= DENSE_TERMS else None
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, words: Words, stride: int) -> None:
        """Count the passages of some texts, which begin as ``window_starts`` says."""
        place = np.flatnonzero(self.row[words.terms] >= 0)
        text = np.searchsorted(words.bounds, place, side="right") - 1
        row, within = self.row[words.terms[place]], place - words.bounds[text]
        last = np.maximum(0, np.diff(words.bounds) - WINDOW)[text]
        # A passage that holds two places of a text, fewer than WINDOW apart, begins in reach of the later one and not behind the
        # earlier one: at a multiple of the stride, or as the last whole one. There are none too few, so no difference is negative.
        until = np.minimum(within, last) // stride + 1 + ((last % stride != 0) & (within >= last))
        since = -(-np.maximum(0, within - WINDOW + 1) // stride)
        apart = place + text * WINDOW  # places of two texts are never near
        until, since, row = until.astype(np.int32), since.astype(np.int32), row.astype(np.int32)
        for first in range(0, len(place), PART_PLACES):
            for lag in range(WINDOW):
                a = slice(first, max(first, min(first + PART_PLACES, len(place) - lag)))
                b = slice(a.start + lag, a.stop + lag)
                near = np.flatnonzero(apart[b] - apart[a] < WINDOW)
                if not len(near):
                    break
                left, right, times = row[a][near], row[b][near], (until[a] - since[b])[near]
                if lag:  # the diagonal has both orders of two places with one term
                    times = times << (left == right)
                self._count(self.before[np.maximum(left, right)] + np.minimum(left, right), times)

    def _count(self, codes: np.ndarray, times: np.ndarray) -> None:
        if self.table is not None:
            np.add.at(self.table, codes, times.astype(np.int64))  # much slower with another type than the table
        else:
            self.held.append((codes, times))
            self.size += len(codes)

    def full(self) -> bool:
        return self.size >= HELD_PAIRS

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Terms, other terms and counts so far, in parts; what is given out is forgotten."""
        if self.table is not None:
            for first in range(0, len(self.table), 1 << 18):
                part = self.table[first : first + (1 << 18)]
                codes = np.flatnonzero(part)
                yield *self._terms(codes + first), part[codes]
                part[:] = 0
        elif self.held:
            codes, times = (np.concatenate(part) for part in zip(*self.held))
            self.held, self.size = [], 0
            codes, at = np.unique(codes, return_inverse=True)
            counts = np.bincount(at, times, len(codes)).astype(np.int64)
            codes, counts = codes[counts > 0], counts[counts > 0]
            for first in range(0, len(codes), 1 << 16):
                yield *self._terms(codes[first : first + (1 << 16)]), counts[first : first + (1 << 16)]

    def _terms(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.before, codes, side="right") - 1
        return self.terms[row], self.terms[codes - self.before[row]]


def counts(frame: DataFrame, stride: int, vocabulary: np.ndarray) -> DataFrame:
    """term, other, n over all texts, to be added up by (term, other).

    With an ``other``: how often both share a passage. With -1: the texts that have the term; the term -1 stands for all texts.
    """

    def run(batches: Batches) -> Batches:
        pairs, documents, rows = Pairs(vocabulary), np.zeros(TERMS, dtype=np.int64), 0
        names = ["term", "other", "n"]

        def shared() -> Batches:
            for term, other, n in pairs.take():
                columns = [pa.array(term, pa.int32()), pa.array(other, pa.int32()), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for _, words in _groups(batch, 0):
                texts = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
                once = np.unique(texts * TERMS + words.terms)
                documents += np.bincount(once % TERMS, minlength=TERMS)
                pairs.add(words, stride)
                if pairs.full():
                    yield from shared()
            rows += batch.num_rows
        yield from shared()
        used = np.flatnonzero(documents)
        columns = [np.append(used, -1).astype(np.int32), np.full(len(used) + 1, -1, dtype=np.int32), np.append(documents[used], rows)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return map_batches(frame.select("text"), run, "term int, other int, n long")


def document_frequencies(counted: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and of the documents with each hashed term."""
    found = counted.where("other = -1").toArrow()  # at most one row per hashed term
    term, n = (found.column(c).to_numpy() for c in ("term", "n"))
    frequencies = np.zeros(TERMS, dtype=np.int64)
    frequencies[term[term >= 0]] = n[term >= 0]
    return int(n[term == -1].sum()), frequencies


def _vocabulary(benchmark: DataFrame) -> np.ndarray:
    """Hashed terms of the items, ascending."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for _, words in _groups(batch, 0):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(words.terms))], ["term"])

    found = map_batches(benchmark.select("text"), run, "term long").distinct().toArrow()
    return np.sort(found.column(0).to_numpy())


def _times(shared: DataFrame, row: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'A Q for the TF-IDF matrix A of the passages, from counts sorted by term.

    One row of the product per term comes back, or a few parts of it.
    """
    sent = shared.sparkSession.sparkContext.broadcast((row, idf, basis))

    def run(batches: Batches) -> Batches:
        row, idf, basis = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            term, other, n = (batch.column(i).to_numpy() for i in range(3))
            weights = n * idf[term] * idf[other]
            bounds = [0, *(np.flatnonzero(np.diff(term)) + 1).tolist(), len(term)]
            images = [(weights[a:b] @ basis[row[other[a:b]]]).tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(term[bounds[:-1]]), pa.array(images, pa.binary())], ["term", "image"])

    found = map_batches(shared.select("term", "other", "n"), run, "term int, image binary").toArrow()
    total = np.zeros(basis.shape)
    for at, image in zip(row[found.column(0).to_numpy()].tolist(), found.column(1)):
        total[at] += np.frombuffer(image.as_buffer())
    sent.unpersist()
    return total


def latent_space(shared: DataFrame, vocabulary: np.ndarray, idf: np.ndarray, seed: int = 5) -> Space:
    """Randomised SVD: range finding with power steps, then a rotation by the small Gram matrix."""
    row = np.full(TERMS, len(vocabulary), dtype=np.int64)
    row[vocabulary] = np.arange(len(vocabulary))
    width = min(len(vocabulary), RANK + OVERSAMPLE)
    basis = np.random.default_rng(seed).standard_normal((len(vocabulary), width))
    for _ in range(POWER_STEPS):
        basis = np.linalg.qr(_times(shared, row, idf, basis))[0]
    values, rotation = np.linalg.eigh(basis.T @ _times(shared, row, idf, basis))
    order = np.argsort(-values)[:RANK]
    order = order[values[order] > 1e-9 * values.max()]
    # Directions are damped by the fourth root of their singular values: undamped, those of the commonest
    # words rule every cosine; divided by the whole value, the weakest ones drown a paraphrase.
    basis = basis @ (rotation[:, order] / values[order] ** 0.125)
    weighted = np.vstack([basis * idf[vocabulary][:, None], np.zeros((1, basis.shape[1]))]).astype(np.float32)
    return Space(idf.astype(np.float32), row, weighted)


def verified(
    item: Item, places: list[tuple[float, int]], words: Words, low: int, high: int
) -> tuple[int, float, float, float] | None:
    """Word, cosine and shares of the best leak of an item among candidate windows (cosine, start) of a text."""
    best, tried = None, set()
    for cosine, start in sorted(places, key=lambda p: (-p[0], p[1])):
        if start in tried:
            continue
        tried.add(start)
        reach = len(item.words)
        region = words.list(max(low, low + start - reach), min(high, low + start + WINDOW + reach))
        whole, answer, leaked = item.leak(region)
        if leaked and (best is None or whole > best[2]):
            best = (start, cosine, whole, answer)
            if whole == 1.0:
                break
    return best


def _search(documents: DataFrame, items: list[Item], space: Space) -> DataFrame:
    """Verified leaks of a block of items: doc_id, item_id, position and measures."""
    owners, latents, sets = [], [], []
    for number, item in enumerate(items):
        found = Words.of([item.text]).terms
        windows = window_terms(found, *all_windows(np.array([0, len(found)]), ITEM_STRIDE)[1:])
        owners += [number] * len(windows)
        latents.append(space.windows(windows))
        sets += [np.unique(w[w >= 0]) for w in windows]
    sizes = np.array([len(s) for s in sets])
    distinct = np.array([np.pad(s, (0, WINDOW - len(s)), constant_values=-2) for s in sets], dtype=np.int32)
    sent = documents.sparkSession.sparkContext.broadcast(
        (items, np.array(owners), _unit(np.concatenate(latents)), distinct, sizes, space)
    )

    def run(batches: Batches) -> Batches:
        items, owners, passages, distinct, sizes, space = sent.value
        for batch in batches:
            rows, ids = [], batch.column(0).to_pylist()
            for first, words in _groups(batch, 1):
                text, starts, ends = all_windows(words.bounds, STRIDE)
                some = np.flatnonzero(space.related(words.terms, starts, ends))
                near: dict[tuple[int, int], list[tuple[float, int]]] = {}
                for at in range(0, len(some), 1024):
                    part = some[at : at + 1024]
                    windows = window_terms(words.terms, starts[part], ends[part]).astype(np.int32)
                    cosines = _unit(space.windows(windows)) @ passages.T
                    i, j = np.nonzero(cosines >= COSINE)
                    alike = shared_count(windows[i], distinct[j]) >= OVERLAP * sizes[j]
                    i, j = i[alike], j[alike]
                    found = (text[part[i]], owners[j], cosines[i, j], starts[part[i]] - words.bounds[text[part[i]]])
                    for row, number, cosine, start in zip(*(x.tolist() for x in found)):
                        near.setdefault((row, number), []).append((cosine, start))
                for (row, number), places in near.items():
                    low, high = words.bounds[row : row + 2].tolist()
                    best = verified(items[number], places, words, low, high)
                    if best:
                        rows.append((ids[first + row], items[number].item_id, *best))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
            names = ["doc_id", "item_id", "word", "cosine", "lcs_share", "answer_share"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "doc_id long, item_id long, word int, cosine double, lcs_share double, answer_share double"
    return map_batches(documents, run, schema)


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that leaks into it.

    doc_id, item_id, word (the passage's first word), cosine, lcs_share, answer_share. Items without an
    id or without words cannot leak; a NULL text has no words; rows repeated whole give repeated rows.
    An empty benchmark or corpus gives an empty result.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "decontam")
    documents = documents.select(col("doc_id").cast("long").alias("doc_id"), col("text").cast("string").alias("text"))
    benchmark = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        col("item_id").cast("long").alias("item_id"), "text"
    ).distinct()
    schema = "doc_id long, item_id long, word int, cosine double, lcs_share double, answer_share double"
    items = benchmark.count()
    vocabulary = _vocabulary(benchmark) if items else np.empty(0, dtype=np.int64)
    if not len(vocabulary):
        return spark.createDataFrame([], schema)
    # Every task gives out its pairs once, so a task takes several parts of the texts where there are more than cores.
    parts, cores = documents.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism
    corpus = counts(documents.coalesce(max(1, min(parts, max(2 * cores, parts // 4)))), STRIDE, vocabulary)
    own = counts(benchmark, ITEM_STRIDE, vocabulary).where("other >= 0")
    counted = scratch.stage(corpus.union(own).groupBy("term", "other").agg(F.sum("n").alias("n")), "counts")
    total, frequencies = document_frequencies(counted)
    if not total:
        return spark.createDataFrame([], schema)
    idf = np.log((1 + total) / (1 + frequencies)) + 1e-3
    pairs = counted.where("other >= 0")
    turned = pairs.where("term <> other").select(col("other").alias("term"), col("term").alias("other"), "n")
    shared = pairs.union(turned).repartition("term").sortWithinPartitions("term", "other")
    space = latent_space(scratch.stage(shared, "shared"), vocabulary, idf)

    blocks = -(-items // BLOCK_ITEMS)
    numbered = benchmark.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = None
    for block in range(blocks):
        rows = numbered.where(col("block") == block).select("item_id", "text").orderBy("item_id", "text").collect()
        worded = [item for item in (Item.of(r["item_id"], r["text"]) for r in rows) if item.words]
        if worded:
            found = _search(documents, worded, space)
            out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], schema)


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no item leaks into, with their columns; those without an id are kept."""
    scratch = Scratch(documents.sparkSession, "decontam")
    leaked = scratch.stage(leaks(documents, benchmark).select("doc_id").distinct(), "leaked")
    return documents.join(leaked, "doc_id", "left_anti").select(*documents.columns)


def op1_latent_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that contain benchmark items."""
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
