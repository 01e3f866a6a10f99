import random

from civiclens.llm.common import Scratch
from civiclens.llm.simhash import fingerprint, representatives, similar_classes


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs):
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: shingles(t) for i, t in docs.items()}
    for i in docs:
        for j in docs:
            a, b = sets[i], sets[j]
            if j < i and (a == b or 5 * len(a & b) >= 4 * len(a | b)):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in docs}


def made(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 160))] for _ in range(15)]
    docs = {500: "", 501: None, 502: "a b c d", 503: "A b  c d", 504: "a b c"}
    for i in range(180):
        text = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 6)):
            at = rnd.randrange(len(text))
            text[at : at + rnd.randint(0, 2)] = [rnd.choice(words)]
        docs[2 * i + 1] = " ".join(text)
    return docs


def test_classes_by_jaccard_are_those_of_brute_force(texts):
    docs = made(3)
    want = brute(docs)
    found = {r.doc_id: r.component_id for r in similar_classes(texts(*docs.items())).collect()}
    assert found == want
    assert {r.doc_id for r in representatives(texts(*docs.items())).collect()} == set(want.values())
    far = sum((fingerprint((docs[i] or "").encode()) ^ fingerprint((docs[j] or "").encode())).bit_count() > 3 for i, j in want.items())
    assert far > 20


def test_only_what_can_meet_is_written(texts, monkeypatch):
    rnd = random.Random(4)
    word = lambda: f"w{rnd.randrange(10**9)}"
    common = [word() for _ in range(5)]
    docs = {i: " ".join([word() for _ in range(100)] + common) for i in range(40)}
    near = docs[0].split()
    near[50] = word()
    docs[40], docs[41] = " ".join(near), docs[1]
    written, stage = {}, Scratch.stage

    def counted(self, frame, name):
        out = stage(self, frame, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "stage", counted)
    found = {r.doc_id: r.component_id for r in similar_classes(texts(*docs.items())).collect()}
    assert found == {i: {40: 0, 41: 1}.get(i, i) for i in docs}
    # 41 sets have one element in common, and two of them the elements of a near copy.
    assert written["nodes"] == 41 and written["prefixes"] <= 2 * 21 + 41
    assert written["tried"] == 1 and written["sets-first"] == 2
