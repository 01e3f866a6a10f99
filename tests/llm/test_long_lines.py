import random

from test_lines import words_distance

from civiclens.llm import lines
from civiclens.llm.common import Scratch
from civiclens.llm.lines import repeated_lines, within_edits


def brute(docs):
    seen, out = [], {}
    for doc_id, text in sorted(docs.items()):
        for number, line in enumerate(text.split("\n")):
            words = line.split()
            for other in seen:
                shorter, longer = sorted((len(words), len(other)))
                most = 0 if longer < 8 else max(1, shorter // 10)
                if longer - shorter <= most and words_distance(words, other) <= most:
                    out.setdefault(doc_id, []).append(number)
                    break
            seen.append(words)
    return out


def edited(rnd, line, n):
    line = list(line)
    for _ in range(n):
        at = rnd.randrange(len(line))
        line[at : at + rnd.choice([0, 1, 1])] = [] if rnd.random() < 0.3 else [rnd.choice(["x", "y", f"n{rnd.randrange(99)}"])]
    return line


def test_longer_lines_may_have_more_edits(texts):
    rnd = random.Random(8)
    base = [[rnd.choice("abcdefgh") * rnd.randint(1, 9) for _ in range(rnd.choice([6, 7, 8, 19, 20, 21, 30, 35, 64, 100]))] for _ in range(30)]
    docs = {i: "\n".join(" ".join(edited(rnd, rnd.choice(base), rnd.randint(0, 12) // 2)) for _ in range(4)) for i in range(100)}
    found = {r.doc: r.removed for r in repeated_lines(texts(*docs.items())).collect()}
    assert found == brute(docs)


def test_two_and_three_edits_and_a_line_under_eight_words(texts):
    words = [f"w{i}" for i in range(30)]
    three = [*words[:3], "x", *words[4:12], *words[13:25], "y", *words[25:]]
    docs = {1: words, 2: three, 3: ["z", *three[1:]], 4: words[:25], 5: ["x", "y", *words[2:25]], 6: ["x", "y", "z", *words[3:25]]}
    docs |= {11: list("abcdefgh"), 12: list("abcdefg"), 13: list("abcdef"), 14: list("1234567"), 15: list("12345678")}
    found = repeated_lines(texts(*[(i, " ".join(line)) for i, line in docs.items()])).collect()
    assert {r.doc for r in found} == {2, 3, 5, 6, 12, 15}


def test_edits_are_counted_exactly():
    rnd = random.Random(3)
    for _ in range(2000):
        a = [rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randint(0, 9))]
        b = [rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randint(0, 9))]
        most = rnd.randint(0, 5)
        assert within_edits(a, b, most) == (words_distance(a, b) <= most)


def test_lines_with_the_same_sketch_in_another_order(texts):
    """The earliest line of their keys has the same words elsewhere, so only the words tell that it is not near."""
    words = [f"w{i}" for i in range(40)]
    docs = {1: [*words[20:], *words[:20]], 2: words, 3: [*words[:10], "x", *words[11:]], 4: [*words[20:], *words[1:20], "y"]}
    found = repeated_lines(texts(*[(i, " ".join(line)) for i, line in docs.items()])).collect()
    assert {r.doc for r in found} == {3, 4}


def staged(monkeypatch):
    """The rows of every intermediate table, by name, and their schemas."""
    found, stage = {"schemas": {}}, Scratch.stage

    def kept(self, frame, name):
        out = stage(self, frame, name)
        found[name], found["schemas"][name] = out.collect(), out.schema
        return out

    monkeypatch.setattr(Scratch, "stage", kept)
    return found


def test_lines_that_share_pairs_of_words_by_chance_meet_nobody(texts, monkeypatch):
    rnd, found = random.Random(5), staged(monkeypatch)
    runs = set()
    docs = []
    while len(docs) < 200:
        line = [f"w{rnd.randrange(60)}" for _ in range(25)]
        own = set(zip(line, line[1:], line[2:]))
        if not own & runs:
            runs |= own
            docs.append((len(docs), " ".join(line)))
    assert repeated_lines(texts(*docs)).collect() == []
    assert found["starred-keys"] == []


def test_lines_with_many_keys_in_common_are_one_pair_once(texts, spark, monkeypatch):
    """A run that lines repeat is one key, and what is joined grows with the pairs of lines, not with their keys."""
    rnd, found = random.Random(6), staged(monkeypatch)
    common = [f"c{k}" for k in range(20)]
    docs = {}
    for i in range(40):
        own = [f"o{rnd.randrange(9999)}" for _ in range(rnd.randint(8, 14))]
        docs[i] = " ".join([*own, *common, *["is", "on"] * rnd.randint(14, 16)])
    assert {r.doc: r.removed for r in repeated_lines(texts(*docs.items())).collect()} == brute(docs)
    keys = [(r.doc, r.key) for r in found["met-keys"]]
    assert len(keys) == len(set(keys))
    crowded = spark.createDataFrame(found["crowded-keys"], found["schemas"]["crowded-keys"])
    monkeypatch.setattr(type(crowded), "distinct", lambda frame: frame)
    pairs = lines._all_pairs(crowded, crowded).collect()
    assert 0 < len(pairs) <= 1.1 * len(set(pairs))
