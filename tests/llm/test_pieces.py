from __future__ import annotations

import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from corpusmill.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.load(PATH)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def test_encoding_and_decoding_equal_the_library(model, library):
    rng = random.Random(4)
    signs = "ab the er in  \n\t▁▁é中😀ﬁ.,==--__//  xX01'\"<>s   "
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += [" " * n for n in range(70)] + ["a" * n for n in range(60)] + ["<s> </s> <0x41> <unk>", "a" * 5000]
    texts += ["".join(rng.choice(model.pieces[259:]).replace("▁", " ") for _ in range(6)) for _ in range(3000)]
    encode, decode = pieces.Encoder(model), pieces.Decoder(model)
    for text in texts:
        ids = library.encode(text)
        assert encode(text).tolist() == ids
        assert decode(ids) == library.decode(ids)


def test_remembering_less_gives_the_same(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "HELD_CHUNKS", 3)
    monkeypatch.setattr(pieces, "HELD_PAIRS", 3)
    encode = pieces.Encoder(model)
    text = "the quick brown fox jumps over the lazy dog\nagain and again"
    assert encode(text).tolist() == library.encode(text) and len(encode.recent) <= 3


def test_pairs_equal_merging_again(model):
    encode = pieces.Encoder(model)
    rng = random.Random(8)
    for _ in range(2000):
        a, b = rng.choice(model.whole), rng.choice(model.whole)
        assert encode.fits(a, b) == (pieces.recorded_merges(a + b, model.scores)[1] == [a, b])


def test_odd_rows(odd, model, library):
    found = pieces.decode(pieces.encode(odd, model), model).collect()
    assert len(found) == odd.count()
    for r in found:
        assert r["ids"] == library.encode(r["text"] or "") and r["decoded"] == library.decode(r["ids"])


def test_both_steps_in_one_task(odd, model):
    def rows(found):
        return sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in found.collect())

    one, two = rows(pieces.round_trip(odd, model)), rows(pieces.decode(pieces.encode(odd, model), model))
    assert len(one) == odd.count()
    assert one == two


def test_empty_table(documents, model):
    assert pieces.decode(pieces.encode(documents([]), model), model).count() == 0
