"""Phrases whose words keep together, by best-first growth of word sequences with admissible bounds.

A phrase of a occurrences, cut into parts of l and r occurrences, scores ``floor(SCALE * a * a / (l * r))`` at its lowest-scoring
cut. Since a phrase is no more frequent than its parts, what a prefix of a occurrences grows into scores at most
``floor(SCALE * a / l)``, l being the occurrences of its first word, and a prefix under the least count
grows into nothing. Words and pairs are counted whole, since no count but the least one bounds them. Of
triples only those are counted that can decide: in each round a language's threshold goes down a
frontier of pairs, and triples are counted that begin with a pair whose bound reaches it or that hold a
pair whose score reaches it (they may drop it). Once enough phrases at or above the threshold outlive that, everything
at or above it is known, ties included, and the language is settled; otherwise the frontier is opened further, at last whole.

Counts per task are merged before every exchange. What a task knows of the pairs to grow are bit fields of 2 MB, whatever the
input: a false positive counts a triple that does not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclens.llm.common import Batches, Scratch, bit_field, map_batches, table, utf8

col = F.col

SCALE = 1_000_000
LEAST_COUNT = 10
KEPT = 2000
SHARE_PERCENT = 50
"""A phrase goes if a longer one has so many hundredths of its occurrences."""
UNKNOWN = "und"
FILTER_BITS = 24
WORD_SHIFT = 17
"""How far the first word's hash is moved before it meets the second's in a filter."""
CHUNK = 1 << 20
"""Bytes of text counted at a time; a text that is longer is cut where pieces end."""
OPENED = 4
"""The first threshold is set for so many times the phrases wanted; each further round opens ``WIDER`` times as many."""
WIDER = 8
SALTS = 64

PIECE_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
# 0 is part of a word, 1 parts words, 2 parts pieces.
KIND = np.zeros(256, dtype=np.uint8)
KIND[list(b" \t")] = 1
KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def _chunks(batches: Batches) -> Iterator[tuple[list[str], list[bytes]]]:
    """Languages and texts (or parts of one) of about ``CHUNK`` bytes together."""
    langs, texts, size = [], [], 0
    for batch in batches:
        for lang, body in zip(batch.column(0).to_pylist(), batch.column(1)):
            body, start = body.as_py(), 0
            while start < len(body):
                end = len(body)
                if end - start > CHUNK:
                    found = PIECE_END.search(body, start + CHUNK)
                    end = found.end() if found else end
                langs.append(lang)
                texts.append(body[start:end])
                size, start = size + end - start, end
                if size >= CHUNK:
                    yield langs, texts
                    langs, texts, size = [], [], 0
    if texts:
        yield langs, texts


class Words:
    """The words of some texts: ``at`` numbers their (language, word) pairs, ``piece`` the piece each stands in."""

    def __init__(self, langs: list[str], texts: list[bytes]):
        body = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        kind = KIND[body]
        inside = kind == 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        spelled = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[body[inside]])]
        ).dictionary_encode()
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[starts] if len(starts) else np.empty(0, dtype=np.int32)
        names = sorted(set(langs))
        codes = np.array([names.index(lang) for lang in langs])
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        lang = codes[np.searchsorted(text_ends, starts, side="right")]
        word = spelled.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        both, self.at = np.unique(lang * max(1, len(spelled.dictionary)) + word, return_inverse=True)
        lang_of, word_of = np.divmod(both, max(1, len(spelled.dictionary)))
        self.langs = pa.array(names, pa.string()).take(pa.array(lang_of))
        self.spelled = spelled.dictionary.cast(pa.string()).take(pa.array(word_of))
        of = lambda values: np.array([xxhash.xxh64_intdigest(v, 42) for v in values], dtype=np.uint64)
        self.hashes = of(spelled.dictionary.to_pylist())[word_of] if len(both) else np.empty(0, dtype=np.uint64)
        self.lang_hashes = of([n.encode() for n in names])[lang_of] if len(both) else np.empty(0, dtype=np.uint64)

    def buckets(self, first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
        """Places in a filter of words or of pairs of words."""
        mixed = (self.lang_hashes[first] >> np.uint64(64 - FILTER_BITS)) ^ self.hashes[first if second is None else second]
        if second is not None:
            mixed = mixed ^ (self.hashes[first] >> np.uint64(WORD_SHIFT))
        return (mixed & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)

    def rows(self, columns: list[np.ndarray]) -> pa.RecordBatch:
        """Each distinct combination of the words numbered in the columns, with how often it occurs."""
        if len(columns) == 1:
            counts = np.bincount(columns[0], minlength=len(self.hashes))
            distinct = [np.flatnonzero(counts)]
            counts = counts[distinct[0]]
        else:
            size = len(self.hashes)
            key, heads = columns[0] * size + columns[1], None
            if len(columns) == 3:
                heads, inverse = np.unique(key, return_inverse=True)
                key = inverse * size + columns[2]
            found, counts = np.unique(key, return_counts=True)
            front, last = np.divmod(found, size)
            distinct = [front, last] if heads is None else [*np.divmod(heads[front], size), last]
        words = [self.spelled.take(pa.array(d)) for d in distinct]
        names = ["lang", *[f"w{k}" for k in range(1, len(words) + 1)], "n"]
        return pa.RecordBatch.from_arrays([self.langs.take(pa.array(distinct[0])), *words, pa.array(counts, pa.int64())], names)


def _field(filters: list[Broadcast]) -> np.ndarray:
    """The filters' bits of every bucket, one byte each."""
    marks = np.zeros(1 << FILTER_BITS, dtype=np.uint8)
    for k, bits in enumerate(filters):
        marks |= np.unpackbits(bits.value, bitorder="little") << np.uint8(k)
    return marks


def _bucket(first: str, second: str | None = None) -> Column:
    """As ``Words.buckets``."""
    mixed = F.shiftrightunsigned(F.xxhash64("lang"), 64 - FILTER_BITS).bitwiseXOR(F.xxhash64(second or first))
    if second:
        mixed = mixed.bitwiseXOR(F.shiftrightunsigned(F.xxhash64(first), WORD_SHIFT))
    return mixed.bitwiseAND(F.lit((1 << FILTER_BITS) - 1))


def _filter(frame: DataFrame, bucket: Column) -> Broadcast:
    return bit_field(frame, bucket, FILTER_BITS)


def _counted(documents: DataFrame, words: int, filters: list[Broadcast]) -> DataFrame:
    """lang, w1 to w``words`` and n: the occurrences of the sequences that the filters let through."""

    def run(batches: Batches) -> Batches:
        marks = _field(filters) if filters else None
        for langs, texts in _chunks(batches):
            found = Words(langs, texts)
            at, piece = found.at, found.piece
            if words == 1:
                yield found.rows([at])
                continue
            together = piece[:-1] == piece[1:]
            if words == 2:
                frequent = marks[found.buckets(np.arange(len(found.hashes)))] > 0
                usual = frequent[at]
                places = np.flatnonzero(together & usual[:-1] & usual[1:])
                yield found.rows([at[places], at[places + 1]])
                continue
            mark = marks[found.buckets(at[:-1], at[1:])] * together
            # 1 marks pairs frequent enough, 2 those to grow, 4 those that a triple may drop.
            left, right = mark[:-1], mark[1:]
            places = np.flatnonzero((left & right & 1) & ((left >> 1 | left >> 2 | right >> 2) & 1))
            yield found.rows([at[places], at[places + 1], at[places + 2]])

    names = [f"w{k}" for k in range(1, words + 1)]
    counted = map_batches(documents, run, ", ".join(f"{c} string" for c in ("lang", *names)) + ", n long")
    return counted.groupBy("lang", *names).agg(F.sum("n").alias("a"))


def _score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """Exact: the products are decimals of 38 digits (a up to 10**15)."""
    return F.expr(f"CAST({SCALE} * CAST({a} AS DECIMAL(16, 0)) * CAST({a} AS DECIMAL(16, 0)) AS DECIMAL(38, 0)) div (CAST({l} AS DECIMAL(16, 0)) * CAST({r} AS DECIMAL(16, 0)))")


def _thresholds(pairs: DataFrame, wanted: int) -> DataFrame:
    """Per language a score that about ``wanted`` pairs reach, 0 where there are not so many: from a histogram of few bins."""
    bins = pairs.groupBy("lang", F.floor(F.log2(col("score") + 1) * 16).alias("bin"))
    bins = bins.agg(F.count("*").alias("n"), F.min("score").alias("least"))
    down = Window.partitionBy("lang").orderBy(F.desc("bin"))
    reached = bins.withColumn("reached", F.sum("n").over(down))
    return reached.groupBy("lang").agg(F.coalesce(F.max(F.when(col("reached") >= wanted, col("least"))), F.lit(0)).alias("threshold"))


def _best(phrases: DataFrame, kept: int) -> DataFrame:
    """The first phrases of each language with their rank; a language is first ranked in ``SALTS`` parts."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = phrases.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    part = part.where(col("place") <= kept).drop("salt", "place")
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(col("rank") <= kept)


def collocations(
    frame: DataFrame, text: str = "text", lang: str = "lang", kept: int = KEPT, least: int = LEAST_COUNT, opened: int = OPENED
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the ``kept`` best phrases of two or three words of every language.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at blanks and tabs. NULL text is empty, NULL
    language ``und``. Phrases have ``least`` occurrences or more and are dropped if a longer one of as many, dropped or not,
    holds their words and has half their occurrences; ties go to the more frequent phrase, then to byte order. n is the
    number of a language's words. Every row counts, also one repeated whole; a language without such phrases has no rows.
    """
    scratch = Scratch(frame.sparkSession, "collocations")
    documents = frame.select(F.coalesce(col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), utf8(text).alias("body"))
    counted = scratch.stage(_counted(documents, 1, []), "words")
    sizes = counted.groupBy("lang").agg(F.sum("a").alias("n"))
    words = counted.where(col("a") >= least)
    frequent = _filter(words, _bucket("w1"))
    pairs = scratch.stage(_counted(documents, 2, [frequent]).where(col("a") >= least), "pairs")
    one = lambda name, count: words.select("lang", col("w1").alias(name), col("a").alias(count))
    pairs = pairs.join(one("w1", "l"), ["lang", "w1"]).join(one("w2", "r"), ["lang", "w2"])
    pairs = scratch.stage(pairs.withColumns({"score": _score("a", "l", "r"), "bound": F.expr(f"{SCALE} * a div l")}), "scored")
    scratch.drop("pairs")
    known = _filter(pairs, _bucket("w1", "w2"))

    settled: DataFrame | None = None
    left, wanted, step = pairs, kept * opened, 0
    while not left.isEmpty():
        threshold = scratch.stage(_thresholds(left, wanted), f"thresholds-{step}")
        frontier = left.join(threshold, "lang")
        grown = _filter(frontier.where("bound >= threshold"), _bucket("w1", "w2"))
        rivals = _filter(frontier.where("score >= threshold"), _bucket("w1", "w2"))
        triples = scratch.stage(_counted(documents, 3, [known, grown, rivals]).where(col("a") >= least), f"triples-{step}")
        front = left.select("lang", "w1", "w2", col("a").alias("l2"), col("l").alias("l1"))
        back = left.select("lang", col("w1").alias("w2"), col("w2").alias("w3"), col("a").alias("r1"), col("r").alias("r2"))
        scored = triples.join(front, ["lang", "w1", "w2"]).join(back, ["lang", "w2", "w3"])
        scored = scored.withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
        first = col("s1") <= col("s2")
        longer = scored.select(
            "lang",
            F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
            "a",
            F.when(first, col("l1")).otherwise(col("l2")).alias("l"),
            F.when(first, col("r1")).otherwise(col("r2")).alias("r"),
            F.least("s1", "s2").alias("score"),
        )
        inner = triples.select("lang", "w1", "w2", "a").union(triples.select("lang", "w2", "w3", "a"))
        most = inner.groupBy("lang", "w1", "w2").agg(F.max("a").alias("most"))
        lone = frontier.where("score >= threshold").join(most, ["lang", "w1", "w2"], "left")
        lone = lone.where(f"most IS NULL OR 100 * most < {SHARE_PERCENT} * a")
        phrases = longer.union(lone.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score"))
        reached = phrases.join(threshold, "lang").where("score >= threshold")
        reached = scratch.stage(reached, f"reached-{step}")
        enough = reached.groupBy("lang", "threshold").agg(F.count("*").alias("n"))
        done = threshold.join(enough, ["lang", "threshold"], "left").where(f"threshold = 0 OR n >= {kept}").select("lang")
        done = scratch.stage(done, f"done-{step}")
        final = reached.drop("threshold").join(done, "lang", "left_semi")
        settled = final if settled is None else settled.union(final)
        left = scratch.stage(left.join(done, "lang", "left_anti"), f"left-{step}")
        wanted, step = wanted * WIDER, step + 1
    if settled is None:
        settled = frame.sparkSession.createDataFrame([], "lang string, phrase string, a long, l long, r long, score long")
    return _best(settled, kept).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_branch_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best phrases of every language."""
    return collocations(table(spark, folder, "documents").select("lang", "text"))


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE = f"""
WITH pieces AS (
    SELECT row_number() OVER () AS p, lang, piece FROM (
        SELECT coalesce(lang, '{UNKNOWN}') AS lang,
            unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents
    )
), words AS (
    SELECT p, lang, unnest(ws) AS w, unnest(range(len(ws))) AS i
    FROM (SELECT p, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces)
), runs AS MATERIALIZED (
    SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3
    FROM words WINDOW o AS (PARTITION BY p ORDER BY i)
), c1 AS MATERIALIZED (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
c2 AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
c3 AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST_COUNT}),
cuts AS (
    SELECT c2.lang, c2.w1 || ' ' || c2.w2 AS phrase, c2.f AS a, x.f AS l, y.f AS r, 1 AS k
    FROM c2 JOIN c1 x ON x.lang = c2.lang AND x.w1 = c2.w1 JOIN c1 y ON y.lang = c2.lang AND y.w1 = c2.w2
    WHERE c2.f >= {LEAST_COUNT} AND NOT EXISTS (
        SELECT 1 FROM c3 WHERE c3.lang = c2.lang AND 100 * c3.f >= {SHARE_PERCENT} * c2.f
            AND ((c3.w1 = c2.w1 AND c3.w2 = c2.w2) OR (c3.w2 = c2.w1 AND c3.w3 = c2.w2)))
    UNION ALL
    SELECT c3.lang, c3.w1 || ' ' || c3.w2 || ' ' || c3.w3, c3.f, x.f, y.f, 1
    FROM c3 JOIN c1 x ON x.lang = c3.lang AND x.w1 = c3.w1 JOIN c2 y ON y.lang = c3.lang AND y.w1 = c3.w2 AND y.w2 = c3.w3
    UNION ALL
    SELECT c3.lang, c3.w1 || ' ' || c3.w2 || ' ' || c3.w3, c3.f, x.f, y.f, 2
    FROM c3 JOIN c2 x ON x.lang = c3.lang AND x.w1 = c3.w1 AND x.w2 = c3.w2 JOIN c1 y ON y.lang = c3.lang AND y.w1 = c3.w3
), scored AS (
    SELECT *, CAST(({SCALE}::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
    QUALIFY rank <= {KEPT}
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c1 GROUP BY lang) USING (lang)
"""
