import random

from civiclens.llm.lines import LEAST_WORDS, deduplicated, repeated_lines, variant_hashes, within_one_word


def words_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute(docs):
    seen, out = [], {}
    for doc_id, text in sorted(docs.items()):
        for number, line in enumerate(text.split("\n")):
            words = line.encode().split()
            if not words:
                continue
            long = len(words) >= LEAST_WORDS
            for other in seen:
                if words == other or (long and len(other) >= LEAST_WORDS and words_distance(words, other) <= 1):
                    out.setdefault(doc_id, []).append(number)
                    break
            seen.append(words)
    return out


def made(seed):
    rnd = random.Random(seed)
    lines = [[rnd.choice("abc") * rnd.randint(1, 2) for _ in range(rnd.randint(1, 14))] for _ in range(60)]
    docs = {}
    for i in range(40):
        out = []
        for _ in range(rnd.randint(0, 6)):
            line = list(rnd.choice(lines))
            change = rnd.random()
            at = rnd.randrange(len(line))
            if change < 0.2:
                line[at] = rnd.choice("xyz")
            elif change < 0.35:
                del line[at]
            elif change < 0.5:
                line.insert(at, rnd.choice(["a", "zz"]))
            out.append(rnd.choice(["", " ", "\t"]) + " ".join(line))
            if rnd.random() < 0.2:
                out.append("")
        docs[i] = "\n".join(out)
    return docs


def test_lines_are_those_of_brute_force(texts):
    docs = made(4)
    found = {r.doc: r.removed for r in repeated_lines(texts(*docs.items())).collect()}
    assert found == brute(docs)


def test_one_template_with_thousands_of_fillings(texts):
    """All lines differ from each other in one word: one row per line, not one per pair."""
    docs = {i: f"this line has ten words and the last is {i}" for i in range(3000)}
    found = {r.doc: r.removed for r in repeated_lines(texts(*docs.items())).collect()}
    assert found == {i: [0] for i in range(1, 3000)}


def test_variants_and_verification():
    rnd = random.Random(2)
    for _ in range(300):
        a = [rnd.choice([b"a", b"b"]) for _ in range(rnd.randint(1, 6))]
        b = [rnd.choice([b"a", b"b"]) for _ in range(rnd.randint(1, 6))]
        assert within_one_word(a, b) == (words_distance(a, b) <= 1)
    line = [b"a", b"b", b"c", b"d"]
    hashes = list(zip(*(h.tolist() for h in variant_hashes(line))))
    for i in range(4):
        without = line[:i] + line[i + 1 :]
        assert hashes[i + 1] == tuple(h[0] for h in variant_hashes(without))


def test_nulls_repeated_rows_long_texts_and_no_rows(texts):
    long = " ".join(str(k % 700) for k in range(30_000))
    frame = texts((1, "a b"), (1, "a b"), (2, None), (None, "a b"), (3, "\n \n"), (4, "a b\nc\r\na b"), (5, long), (6, long + " end"))
    rows = deduplicated(frame)
    assert rows.columns == frame.columns
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in rows.collect())
    assert kept == [
        (False, 1, "a b"),
        (False, 1, "a b"),
        (False, 2, None),
        (False, 3, "\n \n"),
        (False, 4, "c\r"),
        (False, 5, long),
        (False, 6, ""),
        (True, 0, "a b"),
    ]
    assert deduplicated(texts()).collect() == []


def test_texts_under_one_id_and_names_the_operator_uses(texts, spark):
    p, q = (" ".join(f"{c}{k}" for k in range(12)) for c in "pq")
    frame = texts((0, p), (1, p), (1, q), (1, q))
    for name in ("_removed", "removed", "row", "doc", "tag", "first", "n", "halves", "counts", "key", "_id", "odd name", "dot.ted"):
        frame = frame.withColumn(name, frame["line"])
    rows = deduplicated(frame)
    assert rows.columns == frame.columns
    assert sorted((r.doc_id, r.text, r["dot.ted"], r.row) for r in rows.collect()) == [(0, p, 1, 1), (1, "", 1, 1), (1, q, 1, 1), (1, q, 1, 1)]
