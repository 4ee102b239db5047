import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import SF_SMALL, sentence
from tokenizers import Tokenizer

from tessera.llm import token_files as tf
from tessera.llm.common import scratch

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 64), st.integers(1, 150)), max_size=12), st.integers(0, 2**32))
def test_round_trip_of_any_widths(runs, seed):
    rng = np.random.default_rng(seed)
    ids = np.concatenate([rng.integers(0, 1 << bits, n, dtype=np.uint64) if bits < 64 else rng.integers(
        0, 2**64 - 1, n, dtype=np.uint64, endpoint=True) for bits, n in runs] or [np.empty(0, np.uint64)])
    words, offsets = tf.pack(ids)
    assert len(offsets) == -(-len(ids) // tf.BLOCK)
    assert (tf.unpack(words, offsets, len(ids)) == ids).all()


def test_packing_density():
    assert len(tf.pack(np.ones(120, np.uint64))[0]) == 2
    assert len(tf.pack(np.full(128, 2**15 - 1))[0]) == 32
    words, _ = tf.pack(np.array([1 << 60, 5, 1 << 63], np.uint64))
    assert len(words) == 5 and words[0] >> np.uint64(60) == 0


def expect(texts):
    return [e.ids for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aAbB sS'tT\n\t\x1c\xa0 .,!19éÉİΣσḰßǅ漢🙂<|>")) | st.characters(codec="utf-8"), max_size=50), min_size=1, max_size=6))
def test_encoder_equals_the_library(texts):
    ids, sizes = tf.word_encoder(PATH).encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == expect(texts)


def test_every_letter_before_punctuation_equals_the_library():
    """A letter that the normalizer splits in two joins the punctuation after it."""
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha()]
    texts = [f"{ch}{'.,;:!?'[i % 6]} a{ch}{'.,;:!?'[(i + 1) % 6]}" for i, ch in enumerate(letters)] + ["İ! İ. xİ?", "İ" * 3 + ","]
    encoder = tf.WordEncoder(PATH)
    library = encoder.library
    ids, sizes = encoder.encode(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_special_tokens_and_forgetting(rng, monkeypatch):
    monkeypatch.setattr(tf, "KEPT_WORDS", 6)
    monkeypatch.setattr(tf, "FIRST_WORDS", 3)
    encoder = tf.WordEncoder(PATH)
    texts = ["a<|endoftext|>B <|startoftext|>", None, "", "Don't we'LL 's", "x" * 5000, sentence(rng, 3000), "<|ENDOFTEXT|> <|", "the, the. The"]
    for _ in range(2):
        for i in range(len(texts) - 1):
            ids, sizes = encoder.encode(texts[i:i + 2])
            assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == expect(texts[i:i + 2])


def test_query_equals_the_library(spark):
    rows = sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id)
    want, start = {}, 0
    for r, ids in zip(rows, expect([r.text for r in rows])):
        ids = [*ids, 1]
        want[r.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: tuple(r)[1:] for r in tf.op1_token_files(spark, SF_SMALL).collect()} == want


def test_tables(spark, documents, monkeypatch):
    texts, ids = ["one two", None, "", "one two", "naïve café\n", "b"], [3, 3, None, 1, 2, 3]
    path = scratch(spark, "t")
    tf.write(documents(texts, ids), path, tf.library_encoder(PATH), end_id=1)
    rows = sorted(tf.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.id for r in rows] == [None, 1, 2, 3, 3, 3]
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    assert sorted(r.ids for r in rows) == sorted([*x, 1] for x in expect(texts))
    path = scratch(spark, "t")
    tf.write(documents([]), path, tf.library_encoder(PATH), end_id=1)
    assert tf.read(spark, path).count() == 0 and tf.read(spark, path, digest=True).count() == 0


def test_other_encoders_and_wide_ids(spark, documents):
    path = scratch(spark, "t")
    tf.write(documents(["aaa", "b"]), path, lambda: lambda texts: (
        np.array([1 << 62 if c == "a" else 7 for t in texts for c in t], np.int64), np.array([len(t) for t in texts])), end_id=0)
    assert [r.ids for r in sorted(tf.read(spark, path).collect(), key=lambda r: r.start)] == [[1 << 62] * 3 + [0], [7, 0]]


def test_a_block_looks_each_distinct_word_up_once():
    """Also with punctuation at its end: a word of letters and its tail are kept apart."""
    encoder, looked = tf.WordEncoder(PATH), []

    class Looked(tf._Known):
        def __getitem__(self, key):
            looked.append(key)
            return super().__getitem__(key) if key in self else self.__missing__(key)

    encoder.known = Looked(encoder.names)
    texts = ["The sea, the land; the sky.\n", " the sea. The land, THE SKY! "] * 50
    ids, sizes = encoder.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == expect(texts)
    assert sorted(encoder.names) == sorted([b"the", b"sea", b"land", b"sky", b",", b";", b".", b"!"])
    assert len(looked) == 7 + 6  # distinct words, and those with a tail


def test_places_that_few_selectors_fit_pack_as_densely(rng):
    wide = [rng.randrange(1 << 12, 1 << 15) for _ in range(1 << 14)]
    ids = np.array([*wide, *[1] * 60, *wide[:68], *[1] * 256], np.uint64)
    words, offsets = tf.pack(ids)
    assert (tf.unpack(words, offsets, len(ids)) == ids).all()
    # 32 words a block of four ids each; sixty ones in a word; blocks of 128 ones in 3 words
    assert np.diff(offsets).tolist() == [32] * 128 + [1 + 17] + [3]
