import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from civiclens.llm import collocations as module
from civiclens.llm.collocations import collocations


def brute(docs, kept, least):
    counts = defaultdict(Counter)
    for text, lang in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    rows = []
    for lang, found in counts.items():
        n = sum(a for p, a in found.items() if len(p) == 1)
        ranked = []
        for p, a in found.items():
            if len(p) == 1 or a < least:
                continue
            longer = [b for q, b in found.items() if len(q) == 3 and len(p) == 2 and b >= least and p in (q[:2], q[1:])]
            if any(100 * b >= 50 * a for b in longer):
                continue
            cuts = [(1_000_000 * a * a // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:kept], 1):  # noqa: E741
            rows.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(rows)


def made(seed, rows=300, vocabulary=40):
    rnd = random.Random(seed)
    words = [rnd.choice(["a", "B", "é", "ß", "Zz", "#", "\x00q"]) + str(k // 2) * (k % 3) for k in range(vocabulary)]
    weights = [1 / (k + 1) for k in range(vocabulary)]
    sets = [rnd.choices(words, weights, k=rnd.randint(2, 4)) for _ in range(30)]
    docs = []
    for _ in range(rows):
        parts = []
        for _ in range(rnd.randint(0, 12)):
            parts += rnd.choice(sets) if rnd.random() < 0.4 else rnd.choices(words, weights, k=2)
            parts.append(rnd.choice([". ", " ", "\t", "\n", " , ", "!"]))
        docs.append((" ".join(parts), rnd.choice(["en", "en", "de", None, "und"])))
    return docs


def rows_of(spark, docs, **options):
    schema = "text string, lang string, n long, a long, w1 string, score string"
    frame = spark.createDataFrame([(*d, 1, 2, "x", "y") for d in docs], schema).repartition(4)
    return sorted(tuple(r) for r in collocations(frame, **options).collect())


@pytest.mark.parametrize("kept", [3, 40, 5000])
@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_are_those_of_brute_force(spark, seed, kept):
    docs = made(seed)
    assert rows_of(spark, docs, kept=kept, least=4, opened=1) == brute(docs, kept, 4)


def test_threshold_goes_down_until_settled(spark):
    """The best pairs all stand in triples that drop them, so the first threshold leaves too few phrases."""
    docs = [(f"x{i} y{i} z{i}. " * 12, "en") for i in range(60)] + [(f"p q{i} . " * (20 + i), "en") for i in range(20)]
    docs += [("p " * 3000, "en")]
    assert rows_of(spark, docs, kept=62, least=10, opened=1) == brute(docs, 62, 10)


def test_full_filters_change_nothing(spark, monkeypatch):
    full = np.full(1 << module.FILTER_BITS - 3, 255, dtype=np.uint8)
    monkeypatch.setattr(module, "_filter", lambda *_: spark.sparkContext.broadcast(full))
    docs = made(3, rows=80)
    assert rows_of(spark, docs, kept=20, least=3) == brute(docs, 20, 3)


def test_nulls_long_texts_and_no_rows(spark):
    docs = [(None, "en"), ("", None), (" \t\n", "en"), ("a b", None), ("A b " * 300_000, "fr"), ("one two. " * 200_000, "fr"), ("w" * 3_000_000, "fr")]
    docs += [("x y z", "")] * 12
    assert rows_of(spark, docs) == brute(docs, 2000, 10)
    assert rows_of(spark, []) == []


def test_products_beyond_64_bits(spark):
    big = 900_000_000_000_000
    frame = spark.createDataFrame([(big, big + 7, big + 11)], "a long, l long, r long")
    assert frame.select(module._score("a", "l", "r").alias("s")).first().s == 1_000_000 * big * big // ((big + 7) * (big + 11))
