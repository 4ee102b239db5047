import hashlib
import tracemalloc

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import SF_SMALL, sentence
from tokenizers import Tokenizer

from tessera.llm import bpe, common

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(encoder, texts):
    ids, sizes = encoder.encode(texts)
    assert len(ids) == sizes.sum()
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def expect(texts):
    return [e.ids for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_every_character_between_letters_and_spaces():
    chars = [chr(c) for c in range(1, 0x3200) if not 0xD800 <= c < 0xE000] + ["\U0001F600", "\U00010348", "\U00020000"]
    texts = ["".join(f"a{c}b {c} {c}{c}7{c}" for c in chars[i:i + 50]) for i in range(0, len(chars), 50)]
    encoder = bpe.Encoder(bpe.vocabulary(PATH))
    for text, got, want in zip(texts, ids_of(encoder, texts), expect(texts)):
        assert got == want, text[:40]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aaaab bs'tre\n\n  \t.,!19é ñ漢́🙂<|>")) | st.characters(codec="utf-8"), max_size=60), max_size=6))
def test_random_texts(texts):
    encoder = bpe.Encoder(bpe.vocabulary(PATH))
    assert ids_of(encoder, texts or [""]) == expect(texts or [""])
    ids, sizes = encoder.encode(texts or [""])
    assert bpe.decode_flat(ids, sizes, encoder.vocab) == [LIBRARY.decode(i, skip_special_tokens=False) for i in expect(texts or [""])]


def test_special_tokens_long_words_and_forgetting(rng, monkeypatch):
    texts = ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "x" * 20000, " " * 3000 + "a", "ab" * 9000,
             sentence(rng, 20000), None, "", "\n", " ", " a", "a ", "a\n b \nc\n\nd", "'s 's'ss 'll", "\r\n\r\n"]
    monkeypatch.setattr(bpe, "KEPT_UNITS", 5)
    monkeypatch.setattr(bpe, "FIRST_UNITS", 3)
    encoder = bpe.Encoder(bpe.vocabulary(PATH))
    for _ in range(3):
        for i in range(0, len(texts), 3):
            assert ids_of(encoder, texts[i:i + 3]) == expect(texts[i:i + 3])


def test_units_and_ids_a_few_at_a_time(rng, monkeypatch):
    texts = [sentence(rng, 300), "x" * 500, None, "é" * 40 + "\n\n" + sentence(rng, 30), "a<|endoftext|> b", ""]
    monkeypatch.setattr(bpe, "MERGED_CHARS", 20)
    monkeypatch.setattr(bpe, "DECODED_IDS", 7)
    monkeypatch.setattr(common, "GATHERED", 5)
    encoder = bpe.Encoder(bpe.vocabulary(PATH))
    assert ids_of(encoder, texts) == ids_of(encoder, texts) == expect(texts)
    ids, sizes = encoder.encode(texts)
    assert bpe.decode_flat(ids, sizes, encoder.vocab) == [t or "" for t in texts]


def test_memory_of_a_block_of_new_words(rng):
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(1000)) for _ in range(150)]
    vocab = bpe.vocabulary(PATH)
    encoder = bpe.Encoder(vocab)
    tracemalloc.start()
    try:
        bpe.decode_flat(*encoder.encode(texts), vocab)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 50 * sum(map(len, texts))


def test_query_equals_the_library(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {r.doc_id: (len(i), sha(",".join(map(str, i))), sha(LIBRARY.decode(i, skip_special_tokens=False)))
            for r, i in zip(rows, expect([r.text for r in rows]))}
    assert {r.doc_id: tuple(r)[1:] for r in bpe.op6_bpe(spark, SF_SMALL).collect()} == want


def test_tables(spark, documents, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 10)
    texts = ["one two", None, "", "one two", "naïve café\n"]
    coded = bpe.encode(documents(texts, [3, 3, None, 1, 2]), PATH)
    assert sorted(((r.doc_id, r.ids) for r in coded.collect()), key=repr) == sorted(zip([3, 3, None, 1, 2], expect(texts)), key=repr)
    assert sorted(r.decoded for r in bpe.decode(coded, PATH).collect()) == sorted(t or "" for t in texts)
    assert bpe.encode(documents([]), PATH).count() == 0
    odd = spark.createDataFrame([([50256, 10**6, -4, 0],), ([],), (None,), ([195, 195],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, PATH).collect()] == ["<|endoftext|>!", "", None, LIBRARY.decode([195, 195])]
