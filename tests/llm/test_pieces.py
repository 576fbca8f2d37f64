from __future__ import annotations

import random

import pytest

from holdfast.llm import pieces
from holdfast.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PATH)


def random_texts(n, size=60):
    draw = random.Random(9)
    letters = "aabetion\n\t  .,Ähé日本語€𝔸<0x0A>'sxyz__--==0019\x00"
    found = ["".join(draw.choice(letters) for _ in range(draw.randrange(size))) for _ in range(n)]
    return found + [" " * draw.randrange(40) + t for t in found[: n // 4]]


def test_ids_equal_the_library_and_decode_to_the_text(library, model):
    encoder, decoder = pieces.StreamingEncoder(model, most=500), pieces.Decoder(model)
    for text in ["", " ", "<s>", "</s> <unk>", *random_texts(3000)]:
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode(text), repr(text)
        assert decoder.decode(ids) == text


def test_neighbours_stay_apart_as_merging_says(model):
    encoder, draw = pieces.StreamingEncoder(model), random.Random(7)
    known = sorted(model.ids.values())
    for text in random_texts(400):
        encoder.encode(text)
    pairs = [(draw.choice(known), draw.choice(known)) for _ in range(20_000)]
    pairs += [divmod(k, len(model.pieces)) for k in encoder.pairs if k >= 0]
    for a, b in pairs:
        text = [model.pieces[a], model.pieces[b]]
        if all(encoder.merged(t) == [t] for t in text):
            assert encoder._compatible(a, b) == (encoder.merged("".join(text)) == text), text


def test_streams_commit_early_and_stay_small(library, model):
    encoder = pieces.StreamingEncoder(model)
    draw = random.Random(2)
    text = "".join(draw.choice("abcdetionrs") for _ in range(20_000))
    runs = list(encoder.stream("▁" + text))
    assert len(runs) > 100 and max(r[-1][2] - r[0][1] for r in runs) < 400
    assert [p[0] for r in runs for p in r] == library.encode(text)
    assert [p[1] for r in runs for p in r][1:] == [p[2] for r in runs for p in r][:-1]


def test_unigram_paths_have_the_best_score():
    model = pieces.PieceModel.__new__(pieces.PieceModel)
    draw = random.Random(4)
    vocabulary = {"".join(draw.choice("ab▁") for _ in range(draw.randrange(1, 5))) for _ in range(25)} | {"a", "▁"}
    model.pieces = sorted(vocabulary)
    model.scores = [-draw.randrange(1, 40) / 4 for _ in model.pieces]
    model.bytes, model.silent, model.unknown, model.merges, model.prefix = {}, set(), 0, False, False
    model._finish({p: k for k, p in enumerate(model.pieces)})
    encoder = pieces.StreamingEncoder(model)
    for _ in range(200):
        text = "".join(draw.choice("ab▁") for _ in range(draw.randrange(1, 90)))
        best = [0.0]
        for i in range(1, len(text) + 1):
            ways = [best[j] + model.scores[model.ids[text[j:i]]] for j in range(max(0, i - 5), i) if text[j:i] in model.ids]
            best.append(max([*ways, best[-1] + model.unknown_score]))
        path = [p for run in encoder.stream(text, every=8) for p in run]
        assert "".join(text[a:b] for _, a, b in path) == text
        score = sum(model.scores[k] if k >= 0 else model.unknown_score for k, _, _ in path)
        assert abs(score - best[-1]) < 1e-6


def test_tables_with_nulls_repeats_and_clashing_columns(spark, docs, library):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "long words " * 20_000), (5, "y" * 30_000)]
    frame = docs(rows).withColumnsRenamed({"kept": "ids", "source": "decoded"})
    encoded = pieces.encode_pieces(frame, PATH)
    decoded = pieces.decode_pieces(encoded, PATH)
    assert sorted(decoded.columns) == sorted(frame.columns)
    for r in decoded.collect():
        assert r.decoded == r.text
        assert r.ids == (None if r.text is None else library.encode(r.text))
    assert pieces.decode_pieces(pieces.encode_pieces(frame.limit(0), PATH), PATH).count() == 0
