import hashlib
import random

import pytest

from civiclens.llm import repeats
from civiclens.llm.passages import without_repeats


def brute(docs, length=100):
    seen, out = set(), {}
    for doc_id, body in sorted(docs.items()):
        covered = bytearray(len(body))
        for k in range(len(body) - length + 1):
            window = body[k : k + length]
            if window in seen:
                covered[k : k + length] = b"\x01" * length
            seen.add(window)
        out[doc_id] = bytes(b for b, gone in zip(body, covered) if not gone)
    return out


def made(seed):
    rnd = random.Random(seed)
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    quoted = [word(rnd.randint(90, 400)) for _ in range(4)]
    docs = {}
    for i in range(50):
        text = word(rnd.randint(0, 300))
        for q in rnd.sample(quoted, rnd.randint(0, 3)):
            text += q[rnd.randint(0, 30) : len(q) - rnd.randint(0, 30)] + word(rnd.randint(0, 4))
        docs[i] = text + "a" * rnd.choice([0, 0, 150, 400]) + "é" * rnd.choice([0, 120])
    docs[50], docs[51], docs[52] = docs[3], "", word(99)
    docs[53] = word(120_000) + docs[3]
    return docs


@pytest.mark.parametrize("hot", [512, 4])
def test_removes_what_brute_force_removes(texts, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    docs = made(hot)
    rows = without_repeats(texts(*docs.items())).collect()
    want = brute({i: t.encode() for i, t in docs.items()})
    assert {r.doc_id: bytes(r.kept) for r in rows} == want
    for r in rows:
        assert r.n_bytes == len(docs[r.doc_id].encode())
        assert all(a["end"] < b["start"] for a, b in zip(r.spans, r.spans[1:]))


def test_texts_longer_than_a_chunk(texts, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 300)
    docs = made(9)
    rows = without_repeats(texts(*docs.items())).collect()
    assert {r.doc_id: bytes(r.kept) for r in rows} == brute({i: t.encode() for i, t in docs.items()})


def test_nulls_repeated_rows_and_no_rows(texts):
    rnd = random.Random(1)
    text = "".join(rnd.choice("abcd ") for _ in range(300))
    rows = without_repeats(texts((1, text), (1, text), (2, None), (None, text), (3, text), (4, ""))).collect()
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, len(r.kept), len(r.spans)) for r in rows)
    assert kept == [
        (False, 1, 300, 300, 0),
        (False, 1, 300, 300, 0),
        (False, 2, 0, 0, 0),
        (False, 3, 300, 0, 1),
        (False, 4, 0, 0, 0),
        (True, 0, 300, 300, 0),
    ]
    assert without_repeats(texts()).collect() == []


def test_the_query_reports_digests(spark, folder):
    from civiclens.llm.passages import op6_suffix_passages

    rows = {r.doc_id: r for r in op6_suffix_passages(spark, folder).collect()}
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = brute(docs)
    assert len(rows) == len(docs)
    for i, kept in want.items():
        assert rows[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert rows[i].n_removed == len(docs[i]) - len(kept)


def test_texts_under_one_id_are_several(texts):
    rnd = random.Random(2)
    p, q = ("".join(rnd.choice("abcd ") for _ in range(300)) for _ in range(2))
    rows = without_repeats(texts((0, p), (1, p), (1, q), (1, q))).collect()
    assert sorted((r.doc_id, r.n_bytes, bytes(r.kept).decode()) for r in rows) == sorted([(0, 300, p), (1, 300, ""), (1, 300, q), (1, 300, q)])


def test_short_texts_are_hashed_together(monkeypatch):
    docs = [t.encode() for t in made(11).values()]
    alone = [[(k, *row[1:]) for found in repeats.fragments([d], 100, 20) for row in zip(*(c.tolist() for c in found))] for k, d in enumerate(docs)]
    built, rolling = [], repeats.Rolling
    monkeypatch.setattr(repeats, "Rolling", lambda body: built.append(len(body)) or rolling(body))
    together = [row for found in repeats.fragments(docs, 100, 20) for row in zip(*(c.tolist() for c in found))]
    assert together == [row for rows in alone for row in rows] and len(together) > 1000
    assert len(built) == 1 and sum(len(d) >= 100 for d in docs) > 30
