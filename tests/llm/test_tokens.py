from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from holdfast.llm import tokens
from holdfast.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
END = 2


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def random_texts(n):
    draw = random.Random(4)
    letters = "aabetion  \n\t\r.,;:!?'-|\"()sdmtre 's 'll 're<|>09²½éÉßñ日本語€𝔸\u0301\x1c\x85\xa0\u2003\x00"
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(0, 60))) for _ in range(n)]


def test_spans_encode_like_whole_texts(library):
    encoder = tokens.SpanEncoder(PATH, most=300)
    special = ["<|endoftext|>", "a<|endoftext|>b", "it's we'll x'sy", "  two  spaces ", "a\n\nb", "a \n b", "word" * 50]
    for text in special + random_texts(4000):
        assert np.frombuffer(encoder.ids(text), "<u2").tolist() == ids_of(library, text), repr(text)


def test_white_space_around_spaces_is_kept_whole(library):
    encoder = tokens.SpanEncoder(PATH, most=300)
    texts = ["".join(t) for n in range(7) for t in itertools.product("a \n", repeat=n)]
    for text in texts + [f"x.{t}9" for t in texts]:
        assert np.frombuffer(encoder.ids(text), "<u2").tolist() == ids_of(library, text), repr(text)


@pytest.mark.parametrize("name", ["word", "digits", "prefix"])
def test_tokenizers_that_split_otherwise_get_whole_texts(library, tmp_path, name):
    from tokenizers import Tokenizer, pre_tokenizers

    if name == "word":
        path = tokenizer_path("word_bpe_49k.json")
    else:
        other = Tokenizer.from_file(PATH)
        own = pre_tokenizers.ByteLevel(add_prefix_space=name == "prefix")
        parts = [pre_tokenizers.Digits(individual_digits=True), own] if name == "digits" else [own]
        other.pre_tokenizer = pre_tokenizers.Sequence(parts) if len(parts) > 1 else own
        path = str(tmp_path / "other.json")
        other.save(path)
    own, encoder = Tokenizer.from_file(path), tokens.SpanEncoder(path)
    assert not encoder.known and tokens.SpanEncoder(PATH).known
    for text in ["in 1984 and 2001", "Two words", *random_texts(300)]:
        assert np.frombuffer(encoder.ids(text), encoder.width).tolist() == ids_of(own, text)


def test_smallest_id_and_zero_are_not_null(spark, docs, tmp_path):
    rows = [(-(1 << 63), "a"), (0, "b"), (None, "c"), (None, "d"), (-1, "e")]
    made = tokens.write_tokens(docs(rows), str(tmp_path / "t"), PATH, END)
    found = tokens.read_tokens(spark, made).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, -(1 << 63), -1, 0]


def test_files_hold_all_documents_in_order(spark, docs, library, tmp_path):
    rows = [(k * 7 % 101, t) for k, t in enumerate(random_texts(101))]
    rows += [(500, None), (501, ""), (502, "long text " * 30_000), (3, rows[0][1]), (3, rows[0][1]), (None, "no id")]
    made = tokens.write_tokens(docs(rows), str(tmp_path / "t"), PATH, END)
    opened = tokens.open_tokens(str(tmp_path / "t"))
    assert opened == made and sum(p[1] for p in made.parts) == len(rows)
    found = tokens.read_tokens(spark, opened).orderBy("start").collect()
    keys = [(r.doc_id is not None, r.doc_id) for r in found]
    assert keys == sorted(keys, key=lambda k: (k[0], k[1] or 0))
    place = 0
    for r in found:
        assert r.start == place and r.ids[-1] == END and r.n_tokens == len(r.ids)
        place += len(r.ids)
    want = sorted((str(i), [*ids_of(library, t), END]) for i, t in rows)
    assert sorted((str(r.doc_id), r.ids) for r in found) == want
    digests = tokens.read_tokens(spark, opened, digest=True).orderBy("start").collect()
    assert [r.ids_crc32 for r in digests] == [zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in found]


def test_an_empty_table_makes_an_empty_folder(spark, docs, tmp_path):
    made = tokens.write_tokens(docs([]), str(tmp_path / "t"), PATH, END)
    assert sum(p[2] for p in made.parts) == 0
    assert tokens.read_tokens(spark, made).collect() == []
