import hashlib
import random
import struct

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from textloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LETTERS = "abcdeé ñüß漢字🙂 \n\t'sretall0123!?.,-_THE the<|endoftext|> ​"
CASES = [None, "", "a<|endoftext|>b<|endoftext|>", "  x   ", "aaaaaaaa" * 50 + " x y", "x" * 3000, "!" * 999, " " * 500 + "a", "0123456789" * 40, "I'll we've don't 'S", "é \U0001f468‍\U0001f469"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def test_same_ids_as_library(library):
    coder, rng = bpe.encoder(PATH), random.Random(5)
    texts = [t for t in CASES if t] + ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert list(coder.encode(text)) == want
        assert coder.decode(coder.encode(text)) == library.decode(want, skip_special_tokens=False)


def test_query_columns_and_round_trip(spark, library):
    rows = [(i, t, 1) for i, t in enumerate(CASES * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in bpe.round_trip(docs, PATH).collect()}
    for i, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    assert sorted(r.text for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()) == sorted(t or "" for _, t, _ in rows)
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0


def test_pieces_are_those_of_the_published_pattern():
    plain, rng = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""), random.Random(6)
    signs = "'s'r't'vemld aZé漢0٣²!.\n\t\x1c\x85\u00a0\u0301 ʼ’  "
    texts = [t for t in CASES if t] + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 40))) for _ in range(20_000)]
    assert all(regex.findall(bpe.PIECES, t) == plain.findall(t) for t in texts)


def test_a_corpus_of_many_words_is_encoded_once():
    """With room for 120,000 pieces, a quarter of a million words were all encoded anew at each return."""
    coder, asked = bpe.Encoder(PATH), []
    coder.piece = lambda piece: asked.append(piece) or b"\0\0\0\0"
    text = " ".join("".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(280_000))
    for _ in range(2):
        coder.packed(text)
    assert len(asked) == len(set(asked)) == 280_000
