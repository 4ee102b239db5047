import numpy as np
from llm_helpers import SF_SMALL, sentence

from tessera.llm import decontamination as de


def sellers(item, text):
    """Least edit distance of the item to any stretch of the text, cell by cell."""
    line = [0] * (len(text) + 1)
    for w in item:
        new = [line[0] + 1]
        for j, x in enumerate(text):
            new.append(min(line[j] + (w != x), line[j + 1] + 1, new[j] + 1))
        line = new
    return min(line)


def brute(texts, items):
    out = []
    for a, t in enumerate(texts):
        words = de.words_of(t)
        for b, i in items:
            ws = de.words_of(i)
            if 0 < len(ws) < de.LEAST_WORDS and ws == words:
                out.append((a, b, 0))
            if len(ws) >= de.LEAST_WORDS and len(ws) - len(set(ws) & set(words)) <= 4 * de.allowed(len(ws)) + 2:
                d = sellers(ws, words)
                if d <= de.allowed(len(ws)):
                    out.append((a, b, d))
    return out


def edited(rng, words, edits):
    x = list(words)
    for _ in range(edits):
        at = rng.randrange(len(x))
        kind = rng.randrange(3)
        if kind == 0:
            x[at] = sentence(rng, 1)
        elif kind == 1:
            x.insert(at, sentence(rng, 1))
        else:
            del x[at]
    return x


def test_distances_equal_brute_force(rng):
    for _ in range(60):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        text = [rng.randrange(4) for _ in range(rng.randrange(0, 14))]
        pad = np.full((1, 16), -2, np.int32)
        pad[0, :len(text)] = text
        long = np.full((1, 10), -1, np.int32)
        long[0, :len(item)] = item
        assert de.distances(long, np.array([len(item)]), pad)[0] == sellers(item, text)


def test_recall_and_exact_verification(rng):
    items = [(i, sentence(rng, rng.randrange(12, 60))) for i in range(60)]
    block = de.Block([(i, de.words_of(t)) for i, t in items])
    assert all(c["recall"] >= de.RECALL for c in block.classes)
    texts, planted = [], []
    for n in range(300):
        i, t = items[n % 60]
        words = de.words_of(t)
        inner = b" ".join(w if isinstance(w, bytes) else w.encode() for w in edited(rng, words, n // 60 * de.allowed(len(words)) // 4)).decode()
        texts.append(sentence(rng, rng.randrange(0, 100)) + "\n" + inner.upper() + "! " + sentence(rng, rng.randrange(0, 100)))
    texts += [sentence(rng, 200) for _ in range(100)]
    want, got = set(brute(texts, items)), {(a, items[b][0], d) for a, b, d in block.search([de.words_of(t) for t in texts])}
    assert got <= want or {(a, b) for a, b, _ in got} <= {(a, b) for a, b, _ in want}
    assert len({x[:2] for x in got}) >= 0.97 * len({x[:2] for x in want}) and len(want) >= 280
    assert not [x for x in got if x[0] >= 300 and x[:2] not in {y[:2] for y in want}]


def test_seeds_find_what_the_walks_miss(rng, monkeypatch):
    monkeypatch.setattr(de, "MOST_TABLES", 0)
    items = [(i, sentence(rng, n)) for i, n in enumerate([5, 6, 9, 20, 21, 60, 400])] + [(90, "Yes, sir"), (91, "yes sir")]
    block = de.Block([(i, de.words_of(t)) for i, t in items])
    assert all(c["seeds"] is not None for c in block.classes)
    texts = ["yes sir!", "oh yes sir", "", "yes"]
    for n in range(60):
        words = de.words_of(items[n % 7][1])
        inner = b" ".join(w if isinstance(w, bytes) else w.encode() for w in edited(rng, words, de.allowed(len(words)) - n % 2)).decode()
        texts.append(f"{sentence(rng, rng.randrange(0, 60))} {inner} {sentence(rng, rng.randrange(0, 60))}")
    want = set(brute(texts, items))
    assert {(a, items[b][0], d) for a, b, d in block.search([de.words_of(t) for t in texts])} == want
    assert {x[:2] for x in want} >= {(0, 90), (0, 91)} and len(want) > 50


def test_long_items_are_found(rng):
    item = sentence(rng, 900)
    block = de.Block([(1, de.words_of(item))])
    inner = b" ".join(w if isinstance(w, bytes) else w.encode() for w in edited(rng, de.words_of(item), 175)).decode()
    assert [x[:2] for x in block.search([de.words_of(f"{sentence(rng, 50)} {inner} {sentence(rng, 50)}"), []])] == [(0, 0)]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = {}
    for a, b, d in brute([r.text for r in docs], items):
        want.setdefault(docs[a].doc_id, []).append((b, d))
    got = {r.doc_id: r for r in de.op8_decontamination(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    assert {k: list(zip(r["items"], r.distances)) for k, r in got.items() if r.contaminated} == {k: sorted(v) for k, v in want.items()}


def test_edges_of_the_input(spark, documents, rng, monkeypatch):
    item = "The quick brown fox jumps over the lazy dog, and runs away from “it” again."
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "yes"), (5, item), (6, "é à ü ö ñ ç ß ø")], "item_id bigint, text string")
    texts = [None, "", "the quick brown", item, item[:-12], "x " * 30000 + item, "É À Ü Ö Ñ Ç ß Ø", sentence(rng, 300), "the " * 500]
    monkeypatch.setattr(de, "BLOCK_WORDS", 10)
    docs = documents(texts + texts[3:4], [0, 1, 2, 3, 4, 5, 6, None, 8, 3])
    got = {(r.doc_id, tuple(h.item_id for h in r.hits)) for r in de.find(docs, bench).collect()}
    assert got == {(0, ()), (1, ()), (2, ()), (3, (1, 5)), (4, (1, 5)), (5, (1, 5)), (6, (6,)), (None, ()), (8, ())}
    kept = de.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["0", "1", "2", "8", "None"]
    assert de.clean(docs, bench.limit(0)).count() == len(texts) + 1
    assert de.find(documents([]), bench).count() == 0
