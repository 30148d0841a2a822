"""Byte-level BPE against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidepool.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def pair():
    with open(PATH, "rb") as f:
        return bpe.Vocabulary(f.read()), Tokenizer.from_file(PATH)


def same(pair, text):
    own, library = pair
    ids = np.frombuffer(own.encode(text), "<u4")
    expect = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == expect, text[:100]
    assert own.decode(ids) == library.decode(expect, skip_special_tokens=False)


def test_random_letters_and_tokens(pair):
    rng = random.Random(5)
    tokens = [d.decode("utf-8", "ignore") for d in pair[0].data]
    for i in range(4000):
        same(pair, "".join(rng.choices("aeothn 'sld" if i % 2 else "abcdefghijklmnopqrstuvwxyz", k=rng.randint(0, 30))))
        same(pair, "".join(rng.choices(tokens, k=rng.randint(1, 6))))


def test_spaces_scripts_and_special_tokens(pair):
    rng = random.Random(6)
    for _ in range(3000):
        same(pair, "".join(rng.choices([*" \n\t  ab'sS1é漢\x1c\x85 =-\U0001F600", "<|endoftext|>", "don't", "  "], k=rng.randint(0, 25))))
    own = pair[0]
    assert own.encode("<|endoftext|>", match_special=False) != own.encode("<|endoftext|>")


def test_code_points(pair):
    for c in [*range(0x3000), *range(0x3000, 0x30000, 13), *range(0x30000, 0x110000, 997)]:
        if not 0xD800 <= c < 0xE000:
            same(pair, f"a{chr(c)}{chr(c)} {chr(c)}1")


def test_both_splits_agree(pair):
    rng = random.Random(10)
    for _ in range(4000):
        text = "".join(chr(rng.randrange(256)) if rng.random() < 0.4 else rng.choice(" \n\t'sadé1\xa0\x85!") for _ in range(rng.randint(0, 30)))
        assert pair[0].split_latin(text) == pair[0].split_any(text), text


def test_long_pieces(pair, monkeypatch):
    rng = random.Random(7)
    text = "".join(rng.choices(["ab", " ", "  ", "\n", "1", "'s", " x", "é", "!"], k=4000))
    monkeypatch.setattr(bpe, "PIECE", 50)
    same(pair, text)
    same(pair, "a" * 3000 + "ab" * 3000 + "=" * 777)


def test_forgetting_changes_nothing(pair, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    rng = random.Random(8)
    for _ in range(50):
        same(pair, " ".join("".join(rng.choices("abcdef", k=rng.randint(1, 9))) for _ in range(30)))


def test_decode_of_broken_and_unknown_ids(pair):
    own, library = pair
    rng = random.Random(9)
    for _ in range(500):
        ids = rng.choices(range(50257), k=6) + [rng.randrange(256)]
        assert own.decode(np.array(ids, np.uint32)) == library.decode(ids, skip_special_tokens=False)
    assert own.decode(np.array([64, 10**6], np.uint32)) == library.decode([64])
    assert own.decode(np.array([], np.uint32)) == ""


def test_dataframe(spark, pair):
    rows = [(1, "Hello  world's", 3), (1, "Hello  world's", 3), (None, None, 4), (2, "", 5), (3, "漢字 " * 20_000, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS int")
    got = bpe.encode_decode(df, PATH)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    for r in got.collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == pair[1].encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")
    again = bpe.decode(bpe.encode(df, PATH), PATH)
    assert sorted(r.decoded for r in again.collect()) == sorted(t or "" for _, t, _ in rows)
    assert bpe.encode(df.limit(0), PATH).collect() == []
