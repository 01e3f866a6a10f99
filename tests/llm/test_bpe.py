import base64
import random

import numpy as np
import pytest
import tiktoken

from civiclens.llm import bpe
from civiclens.llm.bpe import PATTERN, VOCABULARY, Codec, decode, encode


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return Codec(open(VOCABULARY, "rb").read(), PATTERN)


def random_texts(seed, n):
    rnd = random.Random(seed)
    parts = ["a", "b", " ", "\n", "é", "日本", "1", "23", "'s", "'", "!!", "the ", "\t", "ß", "😀", " ", "\x1c", "ǅ", "<|endoftext|>"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 80))) for _ in range(n)]


def ids(packed):
    return np.frombuffer(packed, dtype="<u4").tolist()


def test_ids_are_the_librarys(codec, library):
    texts = [*random_texts(7, 600), "", "a" * 3000, " " * 2000, "ab" * 1500, "日" * 700, "x1" * 900]
    for text, packed in zip(texts, codec.encode(texts)):
        assert ids(packed) == library.encode_ordinary(text)
        assert codec.decode(packed) == text.encode()


def test_small_groups_forgetting_and_small_matrices(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 20)
    monkeypatch.setattr(bpe, "MATRIX_CELLS", 16)
    for text in random_texts(8, 100):
        assert ids(codec.encode([text])[0]) == library.encode_ordinary(text)


def test_pairs_that_collide_in_the_table():
    n = 5000
    left, right = np.arange(n) % 71, np.arange(n) // 71
    pairs = bpe.PairTable(left, right, np.arange(n))
    assert (pairs.look_up(left, right) == np.arange(n)).all()
    assert (pairs.look_up(left + 5000, right) == bpe.NO_RANK).all()
    assert (pairs.look_up(np.array([-1, 3]), np.array([3, -1])) == bpe.NO_RANK).all()


def test_frames(texts, library):
    rows = [(1, "Hello wörld"), (1, "Hello wörld"), (2, None), (None, "a b"), (3, ""), (4, "word " * 50_000)]
    coded = encode(texts(*rows))
    assert coded.columns == ["doc_id", "n_tokens", "token_ids"]
    got = sorted(((r.doc_id or 0, r.n_tokens, ids(r.token_ids), bytes(r.decoded)) for r in decode(coded).collect()))
    want = sorted((i or 0, len(t), t, (x or "").encode()) for i, x in rows for t in [library.encode_ordinary(x or "")])
    assert got == want
    assert encode(texts(), round_trip=True).collect() == []


def test_the_query(spark, folder, library):
    import hashlib

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = bpe.op4_byte_bpe(spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
