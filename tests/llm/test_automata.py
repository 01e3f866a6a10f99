import random
import re

import pytest

from civiclens.llm import automata as module
from civiclens.llm.automata import SuffixAutomaton, spans_of, without_repeated_words


def brute(docs, length):
    """Removed word numbers per document (id, text), documents in the given order."""
    seen, out = set(), []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                gone.update(range(i, i + length))
            seen.add(window)
        out.append((len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def made(seed, n=120, alphabet="abc"):
    rnd = random.Random(seed)
    passages = [[rnd.choice(alphabet) for _ in range(rnd.randint(3, 40))] for _ in range(8)]
    docs = []
    for i in range(n):
        words = []
        for _ in range(rnd.randint(0, 5)):
            words += rnd.choice(passages) if rnd.random() < 0.5 else [rnd.choice(alphabet) + str(rnd.randrange(3)) for _ in range(rnd.randint(1, 15))]
        docs.append((i * 3 - 50, rnd.choice([" ", "\n", " \t "]).join(words)))
    return docs


def result(frame, **options):
    rows = without_repeated_words(frame, **options).collect()
    return sorted((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept.decode()) for r in rows)


@pytest.mark.parametrize(("length", "gram", "hot"), [(5, 2, 256), (8, 3, 2), (20, 6, 256), (6, 6, 256), (4, 1, 1)])
def test_removed_words_are_those_of_brute_force(texts, monkeypatch, length, gram, hot):
    monkeypatch.setattr(module, "HOT", hot)
    docs = made(length)
    expected = sorted((i, *r) for (i, _), r in zip(docs, brute(docs, length)))
    assert any(r[2] for r in expected)
    shuffled = random.Random(1).sample(docs, len(docs))
    assert result(texts(*shuffled).repartition(7), length=length, gram=gram) == expected


def test_periodic_texts_and_one_passage_in_all(texts):
    passage = " ".join(f"p{k}" for k in range(30))
    docs = [(i, f"own{i} {i} {passage} end{i}") for i in range(700)] + [(1000, "a " * 500), (1001, "a b " * 300), (1002, "b a " * 30)]
    expected = sorted((i, *r) for (i, _), r in zip(docs, brute(docs, 20)))
    assert result(texts(*docs)) == expected


def test_long_texts_are_cut_into_overlapping_parts(texts, monkeypatch, spark):
    rnd = random.Random(3)
    long = " ".join(str(rnd.randrange(10**6)) for _ in range(3000))
    parts = list(module._parts(iter(()), 20))
    assert parts == []
    monkeypatch.setattr(module, "CHUNK", 900)
    import pyarrow as pa

    for body in (long.encode(), ("y" * 2500 + " z ").encode() * 3, b"x" * 5000, b" " * 5000):
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([body], pa.binary())], ["a", "b", "c"])
        whole = module.hashed_words([body])[0].tolist()
        windows = {}
        for _, _, hashes, _, before in module._parts(iter([batch]), 20):
            for i in range(len(hashes) - 19):
                assert before + i not in windows
                windows[before + i] = hashes[i : i + 20].tolist()
        assert windows == {i: whole[i : i + 20] for i in range(len(whole) - 19)}
    huge = " ".join(str(k) for k in range(1_500_000))
    docs = [(1, "0 1 2"), (2, huge), (3, huge[-3_000_000:]), (4, "7 " + huge[50:5000])]
    expected = [(i, *r) for (i, _), r in zip(docs, brute(docs, 20))]
    assert result(texts(*docs)) == expected


def test_shared_ids_nulls_repeated_rows_and_no_rows(texts):
    p, q = (" ".join(f"{c}{k}" for k in range(30)) for c in "pq")
    docs = [(0, p), (1, p), (1, q), (2, None), (None, p), (None, None), (3, ""), (4, q), (4, q), (5, " \n\t ")]
    rows = without_repeated_words(texts(*docs)).collect()
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.kept.decode()) for r in rows)
    assert kept == sorted(
        [(False, 0, 30, p), (False, 1, 30, ""), (False, 1, 30, q), (False, 2, 0, ""), (True, 0, 30, p), (True, 0, 0, "")]
        + [(False, 3, 0, ""), (False, 4, 30, ""), (False, 4, 30, ""), (False, 5, 0, "")]
    )
    assert without_repeated_words(texts()).collect() == []


def test_matching_statistics():
    rnd = random.Random(9)
    for _ in range(200):
        added = [[rnd.randrange(3) for _ in range(rnd.randint(0, 12))] for _ in range(rnd.randint(0, 4))]
        automaton = SuffixAutomaton()
        for symbols in added:
            automaton.add(symbols)
        query = [rnd.randrange(4) for _ in range(15)]
        inside = lambda run: any(run == s[i : i + len(run)] for s in added for i in range(len(s)))
        expected = [max(k for k in range(e + 1) if k == 0 or inside(query[e - k : e])) for e in range(1, 16)]
        assert automaton.matches(query) == expected
    assert spans_of([1, 2, 3, 4, 0, 1, 2, 3, 1], 3) == [(0, 4), (5, 8)]
