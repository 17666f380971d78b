import hashlib
import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from edgeframe.llm import bpe

TEXTS = [
    "Hello  World's 123 été ÇA\x00​日本 İ don't <|endoftext|> x <|startoftext|>y",
    "naïve\n\n\t foo--bar's 're 'LL 'sss''t",
    "�\U0001f600 a\x1cb \x85 c\xa0d ß ẞ ΑΣ ﬁ Ⅷ ² x²y µ×÷ª",
    "",
    " \t\r\n\x0b\x0c",
    "<|endoftext|><|endoftext|>a<|endof text|>",
    "K ſ é á́́",
    "\x01\x02' \x00\x00a\x00'S",
    "ab" * 3000,
    "thetheinginging " * 500,
]


@pytest.fixture(scope="module")
def library(vocabulary_path):
    return Tokenizer.from_file(vocabulary_path)


@pytest.fixture(scope="module")
def vocabulary(vocabulary_path):
    return bpe.Vocabulary(bpe.read_vocabulary(vocabulary_path))


def _expected(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_same_ids_as_the_library(library, vocabulary):
    found = [ids.tolist() for ids in bpe.Encoder(vocabulary).encode(t.encode() for t in TEXTS)]
    assert found == _expected(library, TEXTS)


def test_random_texts_of_many_scripts(library, vocabulary):
    rng = random.Random(5)
    letters = [chr(c) for c in range(1, 0x250)] + list("ابहि漢字ㄱ가́̈😀👍🏽‍﻿힣") + list(" \n\t") * 30
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 50))) for _ in range(3000)]
    found = [ids.tolist() for ids in bpe.Encoder(vocabulary).encode(t.encode() for t in texts)]
    assert found == _expected(library, texts)


def test_results_do_not_depend_on_what_is_remembered(vocabulary):
    texts = [t.encode() for t in TEXTS] * 2
    plain = [ids.tolist() for ids in bpe.Encoder(vocabulary).encode(texts)]
    assert [ids.tolist() for ids in bpe.Encoder(vocabulary, memory=3).encode(texts)] == plain


def test_both_paths_are_taken(vocabulary):
    encoder = bpe.Encoder(vocabulary)
    list(encoder.encode([b"hello worlds thandertion ereaingsh and of the"]))
    assert 0 < encoder.merged < encoder.seen


def _merged(merges, lists):
    sizes = np.array([len(x) for x in lists], np.int64)
    flat = np.array([i for x in lists for i in x], np.int32)
    ids, counts = merges.apply(flat, sizes)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def test_vectorised_merging_equals_one_word_at_a_time(vocabulary):
    rng = random.Random(2)
    words = ["".join(rng.choices("thandeingor", k=rng.randint(1, 20))) for _ in range(500)]
    spelled = [[*w[:-1], w[-1] + vocabulary.end] for w in words]
    many = _merged(bpe.Merges(vocabulary), [[vocabulary.ids[s] for s in w] for w in spelled])
    for symbols, ids in zip(spelled, many):
        while True:  # the rule, by its definition
            ranked = [
                (vocabulary.ranks[pair], i)
                for i, pair in enumerate(zip(symbols, symbols[1:]))
                if pair in vocabulary.ranks
            ]
            if not ranked:
                break
            _, i = min(ranked)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        assert [vocabulary.names[i] for i in ids] == symbols


def test_unknown_symbols_do_not_merge():
    spec = '{"model": {"vocab": {"a": 0, "b": 1, "ab": 2}, "merges": ["a b"]}}'
    merges = bpe.Merges(bpe.Vocabulary(spec))
    assert _merged(merges, [[0, 1], [0, -2, 1], [], [1]]) == [[2], [0, 1], [], [1]]


def test_vocabulary_without_word_ends():
    spec = {
        "model": {
            "type": "BPE",
            "vocab": {**{c: i for i, c in enumerate(bpe.byte_letters())}, "ab": 256, "bc": 257, "abc": 258},
            "merges": ["b c", "a b", "a bc"],
        },
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
    }


    text = json.dumps(spec)
    library = Tokenizer.from_str(text)
    texts = ["abc", "ab", "abab cab", "bcabc aabbcc", "x"]
    # Pieces are parted at white space, so only vocabularies that drop it give the library's ids.
    want = [[i for w in t.split() for i in library.encode(w, add_special_tokens=False).ids] for t in texts]
    assert [x.tolist() for x in bpe.Encoder(bpe.Vocabulary(text)).encode(t.encode() for t in texts)] == want


def test_digests_and_round_trip(spark, frame, library, vocabulary_path, odd):
    rows = odd + [(10 + i, t) for i, t in enumerate(TEXTS)]
    found = bpe.digests(frame(rows), vocabulary_path).collect()
    expected = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append(
            (
                key,
                len(ids),
                hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
            )
        )
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert bpe.digests(frame(rows).where("false"), vocabulary_path).count() == 0


def test_encoded_keeps_columns(frame, library, vocabulary_path):
    rows = bpe.encoded(frame([(1, "hello there"), (2, None)]), vocabulary_path).orderBy("doc_id").collect()
    assert rows[0].ids == library.encode("hello there", add_special_tokens=False).ids
    assert rows[1].ids == [] and rows[1].score == "x"
