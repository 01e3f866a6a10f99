import random

import numpy as np
import xxhash

from civiclens.llm import simhash
from civiclens.llm.simhash import fingerprint, near_duplicates, representatives, trie_links


def classes(prints):
    """Smallest position in reach, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ("", " \t\x0b\n", "One", "One TWO", "one two\x0cthree", "É é À a b c", "a b a b a b a b", "x" * 9999, "a b " * 5000):
        assert fingerprint(text.encode()) == plain_fingerprint(text), text[:20]


def test_trie_links_are_those_of_all_pairs(monkeypatch):
    rnd = random.Random(5)
    centres = [rnd.getrandbits(64) for _ in range(20)]
    prints = {c ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 4))) & (2**64 - 1) for c in centres for _ in range(40)}
    prints = sorted(prints | {rnd.getrandbits(64) for _ in range(300)})
    for frontier in (7, 1 << 18):
        monkeypatch.setattr(simhash, "FRONTIER", frontier)
        turned = lambda x: (x << 32 | x >> 32) & (2**64 - 1)
        linked = list(range(len(prints)))

        def find(i):
            while linked[i] != i:
                i = linked[i]
            return i

        for turn in (lambda x: x, turned):
            leaves = sorted(map(turn, prints))
            back = [prints.index(turned(x) if turn is turned else x) for x in leaves]
            for i, j in zip(*trie_links(np.array(leaves, dtype=np.uint64), None, 0, 0)):
                a, b = back[i], back[j]
                assert find(a) is not None
                x, y = find(a), find(b)
                linked[max(x, y)] = min(x, y)
        assert [find(i) for i in range(len(prints))] == classes(prints)


def near_copies(seed, n):
    rnd = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.randint(60, 200))] for _ in range(12)]
    for i in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2])):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        yield i * 3 + 1, " ".join(words)


def test_classes_are_those_of_brute_force(texts):
    docs = [*near_copies(6, 150), (8, "a"), (11, ""), (12, None), (14, "\n")]
    random.Random(1).shuffle(docs)
    rows = {r.doc_id: r for r in near_duplicates(texts(*docs)).collect()}
    docs = dict(sorted(docs))
    prints = [plain_fingerprint(t or "") for t in docs.values()]
    ids = list(docs)
    for i, root in zip(ids, classes(prints)):
        assert rows[i].component_id == ids[root]
        assert int(rows[i].fingerprint, 16) == prints[ids.index(i)] and len(rows[i].fingerprint) == 16


def test_chains_and_a_hub(spark, tmp_path):
    from civiclens.llm.common import Scratch
    from civiclens.llm.components import components

    chain = [(k, k + 1) for k in range(0, 300)]
    hub = [(5000, k) for k in range(1000, 3000)]
    links = spark.createDataFrame([*chain, *hub, (9, 9), (1, 0)], "u long, v long")
    rows = {r.node: r.root for r in components(links, Scratch(spark, "test")).collect()}
    want = {k: 0 for k in range(1, 301)} | {k: 1000 for k in [*range(1001, 3000), 5000]}
    assert rows == want


def test_one_document_of_each_class_stays(texts):
    text = " ".join(f"w{i}" for i in range(50))
    frame = texts((5, text), (3, text), (3, text), (9, text + "  "), (4, "other words entirely"), (None, text), (6, None), (8, ""))
    kept = representatives(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect() if r.text) == [(0, text), (3, text), (4, "other words entirely")]
    assert [r.doc_id for r in kept.collect() if not r.text] == [6]
    rows = near_duplicates(texts((None, "a b c d"), (None, None))).collect()
    assert [r.component_id for r in rows] == [None, None]
    assert near_duplicates(texts()).collect() == []
