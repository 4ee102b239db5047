from collections import Counter

from llm_helpers import agrees, sentence

from tessera.llm import quality


def brute_repeats(words):
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(wins)
    return len({i + j for i, w in enumerate(wins) if n[w] > 1 for j in range(5)})


def test_oracle_agrees_on_the_smallest_tables(spark):
    agrees(spark, "op4_quality")


def test_repeated_words(rng):
    for n in (0, 1, 4, 5, 6, 9, 10, 30, 200):
        for k in (1, 2, 3, 50):
            words = [bytes([97 + rng.randrange(k)]) for _ in range(n)]
            assert quality.repeated_words(words) == brute_repeats(words)
    base = sentence(rng, 50).split()
    assert quality.repeated_words(base + base) == 100


def test_common_lines_go_and_copies_stay(spark, documents, rng):
    banner = "This Site uses cookies in 2024 for all of its pages"
    own = [sentence(rng, 30) for _ in range(40)]
    mixed = [f"{x}\n{banner.upper() if i % 2 else banner}\n{sentence(rng, 12)}" for i, x in enumerate(own)]
    page = "\n".join(sentence(rng, 15) for _ in range(8))
    near = [page.replace(page.split()[3 * i], f"word{i}", 1) for i in range(30)]
    only = [f"{banner}\n{banner.lower()}\nshort tail {i}" for i in range(3)]
    texts = mixed + [page] * 30 + near + only
    docs = documents(texts)
    verdict, _ = quality.judge(docs)
    got = {int(r.name): r for r in verdict.collect()}
    assert len(got) == len(texts)
    assert all(got[i].kept and got[i].n_removed_words == 11 for i in range(40))
    assert all(got[i].kept and got[i].n_removed_words == 0 for i in range(40, 100))
    assert not any(got[i].kept for i in range(100, 103))
    kept = {r.doc_id: r for r in quality.clean(docs).collect()}
    assert sorted(kept) == list(range(100))
    assert kept[0].text == mixed[0].replace(banner + "\n", "") and kept[0].n_chars == len(kept[0].text)
    assert kept[45].text == page
    assert quality.clean(docs).columns == docs.columns


def test_boilerplate_of_many_lines_goes(spark, documents, rng):
    texts, ids = [], []
    for k, own in ((1, 0), (5, 1), (10, 3), (30, 10)):
        for host in range(4):
            block = [sentence(rng, 4) for _ in range(k)]
            for i in range(25):
                mine = block + [sentence(rng, 60) for _ in range(own)]
                rng.shuffle(mine)
                texts.append("\n".join(mine) if own else f"{block[0]} of year {2000 + i} for us and for all others")
                ids.append((f"{k}-{host}", 4 * k if own else len(texts[-1].split())))
    verdict, _ = quality.judge(documents(texts, source=[h for h, _ in ids]))
    got = {int(r.name): r for r in verdict.collect()}
    assert [got[i].n_removed_words for i in range(len(texts))] == [n for _, n in ids]
    assert all(got[i].kept == (ids[i][0][0] != "1" or ids[i][0][:2] == "10") for i in range(len(texts)))


def test_verdicts_do_not_change_as_the_host_grows(spark, documents, rng):
    banner = [sentence(rng, 6), sentence(rng, 7)]
    planted = [f"{sentence(rng, 9)}\n{banner[0]}\n{banner[1]}" for _ in range(30)] + ["\n".join(banner) + f"\nyes {i}" for i in range(9)]
    told = []
    for others in (60, 600):
        docs = documents(planted + [f"{sentence(rng, 25)}\n{sentence(rng, 25)}" for _ in range(others)])
        rows = {int(r.name): r for r in quality.judge(docs)[0].collect()}
        told.append([(rows[i].kept, rows[i].n_removed_words) for i in range(len(planted))])
    assert told[0] == told[1] == [(True, 13)] * 30 + [(False, 13)] * 9


def test_edges_of_the_input(spark, documents, rng):
    texts = [None, "", " \n\t\n", "one two", sentence(rng, 40), "a\n" * 50, "x" * 50000, sentence(rng, 30000), "é ü\n\né ü #$"]
    verdict, _ = quality.judge(documents(texts + texts, [1, 1, None] * 6, [None, "h", "h"] * 6))
    rows = verdict.collect()
    assert len(rows) == 18
    assert sorted(r.n_words for r in rows) == sorted(2 * [len((t or "").split()) for t in texts])
    assert {(r.n_words, r.kept) for r in rows if r.n_words in (40, 30000, 2)} == {(40, True), (30000, True), (2, False)}
    assert quality.judge(documents([]))[0].count() == 0 and quality.clean(documents([])).count() == 0
