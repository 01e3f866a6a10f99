import random

import numpy as np

from civiclens.llm import decontam
from civiclens.llm.decontam import Item, Words, clean, common_subsequence, leaks, word_list


def corpus():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice(["ba", "du", "ki", "lo", "me", "na", "ri", "so"]) for _ in range(rnd.randint(1, 4)))
    common = [word() for _ in range(30)]
    text = lambda n: [rnd.choice(common) if rnd.random() < 0.5 else word() for _ in range(n)]
    items = [(i, " ".join(text(rnd.randint(15, 50))) + ". " + " ".join(text(6)) + ".") for i in range(30)]
    docs, want = [], set()
    for d in range(200):
        words = text(rnd.randint(5, 300))
        at = rnd.randint(0, len(words))
        if d % 4 == 0:  # whole, in other case and punctuation
            i, item = rnd.choice(items)
            words[at:at] = [w.upper() + rnd.choice(["", ",", "!"]) for w in item.split()]
            want.add((d, i))
        elif d % 4 == 1:  # a paraphrase with its answer
            i, item = rnd.choice(items)
            parts = item.split()
            words[at:at] = [w if k % 5 or k >= len(parts) - 6 else word() + "x" for k, w in enumerate(parts)]
            want.add((d, i))
        elif d % 4 == 2:  # five words only
            i, item = rnd.choice(items)
            words[at:at] = item.split()[3:8]
        docs.append((d, " ".join(words)))
    return items, docs, want


def test_leaks_are_found_and_clean_documents_left(spark, texts):
    items, docs, want = corpus()
    benchmark = spark.createDataFrame([*items, (77, None), (None, "a b c"), (78, " -- ")], "item_id long, text string")
    odd = [(900, None), (901, ""), (None, "nothing"), (902, "?!"), (903, "word " * 60_000)]
    frame = texts(*docs, *odd, docs[4])
    found = leaks(frame, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert len(found) == len(want) + sum(d == docs[4][0] for d, _ in want)
    kept = clean(frame, benchmark)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None and r.doc_id < 900) == sorted(
        d for d, _ in docs if d not in {x for x, _ in want}
    )
    assert kept.where("doc_id >= 900 OR doc_id IS NULL").count() == 5


def test_items_in_blocks_and_empty_tables(spark, texts, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 11)
    items, docs, want = corpus()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in leaks(texts(*docs), benchmark).collect()} == want
    assert leaks(texts(), benchmark).collect() == []
    assert leaks(texts(*docs[:3]), benchmark.where("false")).collect() == []


def test_words():
    assert word_list("One, “two” don't ÉTÉ 3.5\t…x_y-z\u2014w") == [w.encode() for w in "one two don t été 3 5 x y z w".split()]
    assert word_list("") == word_list(" -- ") == []
    words = Words.of(["a b", "", "-", "c " * 700_000])
    assert words.bounds.tolist() == [0, 2, 2, 2, 700_002]
    assert len(set(words.terms[2:].tolist())) == 1 and words.terms[2] == Words.of(["x c"]).terms[1]


def test_common_subsequences_and_answers():
    rnd = random.Random(1)
    for _ in range(200):
        a = [rnd.choice("abc") for _ in range(rnd.randint(0, 9))]
        b = [rnd.choice("abc") for _ in range(rnd.randint(0, 9))]
        table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert common_subsequence(a, b) == table[-1, -1]
    item = Item.of(1, "One two three four. The answer is five!")
    assert item.answer == [b"the", b"answer", b"is", b"five"]
    assert Item.of(1, "one two three four five six seven eight").answer == [b"seven", b"eight"]


def test_recall_of_the_candidate_search(spark, folder):
    """Every document that holds an item word for word is found."""
    from civiclens.llm.decontam import op1_latent_decontamination

    bare = lambda text: b" " + b" ".join(word_list(text)) + b" "
    docs = {r.doc_id: bare(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r.item_id: bare(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    found = {(r.doc_id, r.item_id) for r in op1_latent_decontamination(spark, folder).collect()}
    assert whole and whole <= found


def shared_terms(texts, stride, vocabulary):
    """T'T of the texts' passages, each cut out by itself."""
    total = np.zeros((len(vocabulary),) * 2, dtype=np.int64)
    for text in texts:
        terms = Words.of([text]).terms
        passages = [terms[s : s + decontam.WINDOW] for s in decontam.window_starts(len(terms), stride).tolist()]
        rows = np.array([[(p == v).sum() for v in vocabulary] for p in passages], dtype=np.int64).reshape(-1, len(vocabulary))
        total += rows.T @ rows
    return total


def test_pairs_of_terms_are_counted_over_all_passages(monkeypatch):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("abcdefghij") for _ in range(n)) for n in [0, 1, 2, 23, 24, 25, 31, 32, 33, 47, 48, 49, 500]]
    vocabulary = np.unique(Words.of(["a b c d e f"]).terms)
    for dense, places in ((decontam.DENSE_TERMS, decontam.PART_PLACES), (0, 7)):
        monkeypatch.setattr(decontam, "DENSE_TERMS", dense)
        monkeypatch.setattr(decontam, "PART_PLACES", places)
        for stride in (decontam.STRIDE, decontam.ITEM_STRIDE):
            pairs = decontam.Pairs(vocabulary)
            total = np.zeros((len(vocabulary),) * 2, dtype=np.int64)
            for some in (texts[:9], texts[9:], []):
                pairs.add(Words.of(some), stride)
                for term, other, n in pairs.take():
                    at = np.searchsorted(vocabulary, term), np.searchsorted(vocabulary, other)
                    total[at] += n
                    total[at[::-1]] += np.where(term == other, 0, n)
            assert (total == shared_terms(texts, stride, vocabulary)).all()


def test_the_space_is_fitted_on_all_passages(spark, texts, monkeypatch):
    """Also where the corpus has more than 20,000."""
    rnd = random.Random(6)
    items = [(1, "a b c d e f g h"), (2, "a c e g i k m o")]
    docs = [(i, " ".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(2_000))) for i in range(100)]
    seen, fit = [], decontam.latent_space
    monkeypatch.setattr(decontam, "latent_space", lambda frame, *rest: seen.append(frame.collect()) or fit(frame, *rest))
    leaks(texts(*docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    vocabulary = np.unique(Words.of([text for _, text in items]).terms)
    want = shared_terms([t for _, t in docs], decontam.STRIDE, vocabulary)
    assert sum(len(decontam.window_starts(2_000, decontam.STRIDE)) for _ in docs) > 20_000
    want += shared_terms([t for _, t in items], decontam.ITEM_STRIDE, vocabulary)
    found = np.zeros_like(want)
    for r in seen[0]:
        found[np.searchsorted(vocabulary, r.term), np.searchsorted(vocabulary, r.other)] += r.n
    assert (found == want).all()
