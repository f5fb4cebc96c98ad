"""Words are told apart, also those made to collide under sums of powers."""

import numpy as np
import pytest

from strandmill.llm import common, language_id, ngram_join, packing, toxicity
from strandmill.llm.exact_dedup import exact_dedup


def morse(k, letters):
    """A Thue-Morse word of 2^k letters."""
    return "".join(letters[bin(n).count("1") % 2] for n in range(1 << k))


@pytest.mark.parametrize("k", range(1, 13))
def test_morse_words_have_hashes_of_their_own(k):
    words = [morse(k, x) for x in ("ab", "ba", "aq", "qa")]
    assert len({common.word_hash(w) for w in words}) == len(words)


def test_hash_depends_on_bytes_and_length_alone():
    rng = np.random.default_rng(1)
    words = {bytes(rng.integers(1, 256, int(n)).astype(np.uint8)) for n in [*range(1, 300), *rng.integers(1, 40, 3000), 5000, 70000]}
    words |= {b"a" * n for n in range(1, 300)} | {b"\0" * n for n in range(1, 40)}
    words = list(words)
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    got = common.hashes(raw, starts, ends)
    assert len(set(got.tolist())) == len(words)
    back = list(reversed(range(len(words))))
    raw2 = np.frombuffer(b"".join(words[k] for k in back), np.uint8)
    ends2 = np.cumsum([len(words[k]) for k in back])
    again = common.hashes(raw2, ends2 - [len(words[k]) for k in back], ends2)
    assert again[::-1].tolist() == got.tolist()
    assert len(common.hashes(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


def encoded(encoder, texts):
    raw = "".join(texts).encode()
    offs = np.cumsum([0, *(len(t.encode()) for t in texts)])
    ids, first = encoder.encode(np.frombuffer(raw, np.uint8), offs)
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]


def test_packing_compares_bytes_where_hashes_are_equal(monkeypatch):
    encoder = packing.WordEncoder(packing.tokenizer_path(), added=True)
    texts = ["one two three", "two", morse(10, "ab") + " " + morse(10, "ba"), "", "four, two"]
    want = encoded(encoder, texts)
    assert want == [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in texts]
    real = common.hashes
    monkeypatch.setattr(common, "hashes", lambda data, starts, ends: real(data, starts, ends) % np.uint64(3))  # all words collide
    encoder.forget()
    assert encoded(encoder, texts) == want
    monkeypatch.setattr(common, "hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    encoder.forget()
    assert [encoded(encoder, [t])[0] for t in ("one", "two", "six", "one")] == [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID] for t in ("one", "two", "six", "one")]


def test_documents_of_colliding_words_are_not_linked(spark):
    docs = spark.createDataFrame([(1, morse(10, "ab")), (2, morse(10, "ba")), (3, morse(10, "ab"))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.ngram_join(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_null_ids_have_defined_flags(spark):
    docs = spark.createDataFrame([(None, "a"), (1, "a"), (None, "b")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.group_size, r.kept) for r in exact_dedup(docs).collect())
    assert got == [("1", 2, True), ("None", 1, True), ("None", 2, False)]
    for held in (toxicity.held_out("doc_id"), language_id.held_out("doc_id")):
        assert [r[0] for r in docs.where("doc_id is null").select(held).collect()] == [False, False]


def test_orders_of_postings_equal_lexsorts():
    from strandmill.llm.line_dedup import order_of, order_of_places

    rng = np.random.default_rng(8)
    for n in (0, 1, 5, 4000):
        major = rng.integers(0, 300, n).astype(np.uint64) << np.uint64(40)
        minor = rng.integers(0, 1 << 32, n).astype(np.uint32)
        assert (order_of(major, minor) == np.lexsort((minor, major))).all()
        doc, line = rng.permutation(n).astype(np.int64), rng.integers(0, 9, n)
        for d in (doc, doc - 5, doc + (1 << 45)):
            assert (order_of_places(d, line) == np.lexsort((line, d))).all()
