import random

import numpy as np
import pytest

from civiclens.llm import suffix


def texts():
    rnd = random.Random(3)
    for k in range(200):
        symbols = rnd.choice([1, 2, 3, 200])
        body = [rnd.randint(1, symbols) for _ in range(rnd.randint(1, 60))]
        yield (body * rnd.randint(1, 3) if k % 2 else body) + [0]
    yield [1] * 500 + [0]
    yield [1, 2] * 200 + [0]


@pytest.mark.parametrize("buckets", [1, 1 << 10])
def test_suffixes_are_sorted_and_share_prefixes(buckets, monkeypatch):
    monkeypatch.setattr(suffix, "MOST_BUCKETS", buckets)
    for body in texts():
        text = np.array(body)
        order = suffix.suffix_array(text)
        assert order.tolist() == sorted(range(len(body)), key=lambda i: body[i:])
        bytes_ = np.array(body[:-1], dtype=np.uint8)
        room = len(bytes_) - np.arange(len(bytes_))
        shared = suffix.permuted_prefixes(bytes_, order, np.minimum(room, 15), 19)
        for before, at in zip(order[1:-1].tolist(), order[2:].tolist()):
            n = 0
            while n < 15 and max(at, before) + n < len(bytes_) and body[at + n] == body[before + n]:
                n += 1
            assert shared[at] == n


def test_large_alphabets_are_not_scanned_bucket_by_bucket(monkeypatch):
    rnd = random.Random(5)
    part = [rnd.randint(1, 3000) for _ in range(400)]
    text = np.array(part * 2 + [rnd.randint(1, 3000) for _ in range(2000)] + part + [7] * 90 + [0])
    monkeypatch.setattr(suffix, "_types", None)
    body = text.tolist()
    assert suffix.suffix_array(text).tolist() == sorted(range(len(body)), key=lambda i: body[i:])
