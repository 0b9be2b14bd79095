from __future__ import annotations

import os

import pytest

from parcella.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no model file at hand")

TEXTS = [
    "Hello world", "  two  spaces   three ", "tab\tand\nline\r\n", "", " ", "▁", "a▁b", "naïve café 漢字 🙂", "<s> </s> <0x0A>",
    "x" * 5000, "\x00\x01", "é" * 10, "1234567890", "a" + " " * 60 + "b", "مرحبا", "end ",
]


def test_ids_equal_sentencepiece_and_come_back(docs_of, words):
    rows = list(enumerate([*TEXTS, *(words(i, 40) for i in range(20)), None, TEXTS[0]]))
    got = {r.doc_id: r for r in pieces.encode(docs_of(rows, clash=True)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        assert got[i].parity and got[i].round_trip, text
        assert (got[i].ids is None) == (text is None) and got[i].n_tokens == len(got[i].ids or [])
        assert got[i].decoded == (None if text is None else text.replace("▁", " "))
    assert pieces.encode(docs_of([])).count() == 0


def test_long_texts_are_cut_without_a_trace(monkeypatch, words):
    import sentencepiece

    data = open(pieces.MODEL, "rb").read()
    tokenizer, settings = pieces.build(data)
    judge = sentencepiece.SentencePieceProcessor(model_proto=data)
    monkeypatch.setattr(pieces, "PART_CHARS", 37)
    monkeypatch.setattr(pieces, "SLICE_BYTES", 100)
    texts = [words(1, 300), "a   b    c " * 50, "x" * 400, "ab ▁ ▁▁ cd " * 30]
    assert len(pieces.prepared(texts[0], settings)) > 10
    assert pieces.encode_texts(tokenizer, settings, texts) == judge.encode(texts)


@pytest.mark.parametrize("line", [1, 3, 256])
def test_different_words_are_encoded_once(monkeypatch, words, line):
    import sentencepiece

    data = open(pieces.MODEL, "rb").read()
    tokenizer, settings = pieces.build(data)
    judge = sentencepiece.SentencePieceProcessor(model_proto=data)
    odd = ["a \n\nb\n c\nd \n", "\n", "\nx\n", " \n", "▁▁\n▁ x", "b ", "é\u00a0ö \t 漢字\r\n🙂"]
    texts = [*TEXTS, *odd, words(1, 300), words(1, 300), *odd[:4], *TEXTS]
    asked = []

    class Counting:
        def __getattr__(self, name):
            return getattr(tokenizer, name)

        def encode_batch_fast(self, parts, **options):
            asked.extend(parts)
            return tokenizer.encode_batch_fast(parts, **options)

    monkeypatch.setattr(pieces, "WORDS_A_LINE", line)
    assert settings["words"]
    assert pieces.encode_texts(Counting(), settings, texts) == judge.encode(texts)
    asked.clear()
    assert pieces.encode_texts(Counting(), settings, ["some words come again"] * 1000)[999] == judge.encode("some words come again")
    assert sum(map(len, asked)) == len("▁some▁words▁come▁again")


def test_batches_are_cut_by_their_text():
    import pyarrow as pa

    batch = pa.record_batch({"k": range(6), "t": ["abc", None, "", "x" * 50, "ab", "c"]})
    cut = list(pieces.bounded_slices(batch, 4))
    assert pa.Table.from_batches(cut).to_pydict() == batch.to_pydict()
    assert [c.num_rows for c in cut] == [4, 2]


def unigram(normalizer: bytes) -> bytes:
    """A small unigram model in wire format: every printable ASCII character, some words."""
    import struct

    def entry(number, body):
        return bytes([number << 3 | 2, len(body)]) + body

    def piece(text, score, kind):
        return entry(1, entry(1, text.encode()) + b"\x15" + struct.pack("<f", score) + bytes([0x18, kind]))

    out = piece("<unk>", 0.0, pieces.UNKNOWN)
    for i, c in enumerate(["▁", *map(chr, range(33, 127))]):
        out += piece(c, -6.0 - i / 100, pieces.NORMAL)
    for i, w in enumerate(["▁the", "▁th", "he", "▁cat", "at", "▁a", "ing"]):
        out += piece(w, -2.0 - i / 10, pieces.NORMAL)
    trainer = bytes([3 << 3, pieces.UNIGRAM])
    return out + entry(2, trainer) + entry(3, normalizer)


@pytest.mark.parametrize("squeeze", [0, 1])
def test_unigram_scores_are_rebuilt(squeeze):
    import sentencepiece

    data = unigram(bytes([3 << 3, 1, 4 << 3, squeeze, 5 << 3, 1]))
    judge = sentencepiece.SentencePieceProcessor(model_proto=data)
    tokenizer, settings = pieces.build(data)
    texts = ["the cat", "a thing  at the end", "", "chatting", " lead", "trail  "]
    assert pieces.encode_texts(tokenizer, settings, texts) == judge.encode(texts)
