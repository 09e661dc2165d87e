import os

import pytest

from stemma.llm.tokens import CHUNK, TOKENIZER_DIR, decode_ids, encode_texts, pieces

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER_DIR), reason="no vocabulary files")
TEXTS = [None, "", " ", "Hello world", "<|endoftext|> is text", "it's  naïve — 日本 \n\n\t x", "a" * 300_000, "one two  three\n" * 20_000, " \n" * 90_000 + "x", "\u0000￿ 🙂 é"]


def test_ids_match_another_library_and_decode(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(TOKENIZER_DIR, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    df = spark.createDataFrame([(k, x, "ids") for k, x in enumerate(TEXTS)], "doc_id long, text string, ids string")
    made = encode_texts(df)
    got = {r.doc_id: r.ids for r in made.collect()}
    assert got[0] == [] and got[1] == []
    for k, x in enumerate(TEXTS):
        assert got[k] == t.encode(x or "", add_special_tokens=False).ids, k
    back = {r.doc_id: (bytes(r.raw), r.text) for r in decode_ids(made).collect()}
    assert all(back[k] == ((x or "").encode(), x or "") for k, x in enumerate(TEXTS))


def test_pieces_join_and_cut_before_white_space():
    text = "word  and \n more " * 20_000
    parts = list(pieces(text))
    assert len(parts) > 2 and "".join(parts) == text
    assert all(p[0].isspace() for p in parts[1:]) and not any(p[-1].isspace() for p in parts[:-1])
    assert list(pieces("x" * (3 * CHUNK))) == ["x" * (3 * CHUNK)]


def test_cut_characters_decode_to_their_bytes(spark):
    ids = encode_texts(spark.createDataFrame([(1, "🙂")], "doc_id long, text string")).first().ids
    half = decode_ids(spark.createDataFrame([(1, ids[:1]), (2, None)], "doc_id long, ids array<int>"))
    raw = {r.doc_id: bytes(r.raw) for r in half.collect()}
    assert "🙂".encode().startswith(raw[1]) and raw[2] == b""
    assert encode_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
