"""Token counts and the streaming codec against the library of the vocabulary."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from snapforge.llm import bpe_codec, token_counts, vocabulary

PATH = public_tokenizers.path("word_bpe_49k.json")
BITS = ["a", "th", "ing", "'s", "'re", "'", "<|endoftext|>", " ", "\n", "é", "é", "Σ", "İ", "1", "--", "中", "🙂", "՘"]


@pytest.fixture(scope="module")
def words():
    return vocabulary.parsed(vocabulary.read_content(PATH))


@pytest.mark.parametrize("chunk", [1 << 16, 16, 7])
def test_like_the_library(words, monkeypatch, chunk):
    monkeypatch.setattr(vocabulary, "CHUNK", chunk)
    library, pick = Tokenizer.from_file(PATH), random.Random(chunk)
    encoder, counter, decoder = bpe_codec.Encoder(words), token_counts.Counter(words), bpe_codec.Decoder(words)
    texts = ["", "'", "x" * 5000, "!?" * 3000, "".join(pick.choice("etaoinshr") for _ in range(9000))]
    texts += ["".join(pick.choice(BITS) for _ in range(pick.randint(1, 200))) for _ in range(150)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = encoder.encode(text)
        assert np.frombuffer(packed, np.int32).tolist() == ids
        assert counter.count(text) == len(ids)
        assert bpe_codec.decoded(packed, decoder) == library.decode(ids, skip_special_tokens=False)


def test_stream_holds_no_more_than_its_buffer(words):
    ahead = bpe_codec.lookahead(words)
    stream, pick, out = bpe_codec.WordEncoder(words, ahead), random.Random(3), []
    data = bytes(pick.choice(b"etaoinshrdlu") for _ in range(20_000))
    for k in range(0, len(data), 100):
        out += stream.feed(data[k:k + 100])
        assert len(stream.held) <= 2 * ahead
    whole, _ = bpe_codec.merged([*(words.inner[b] for b in data[:-1]), words.last[data[-1]]], words)
    assert out + stream.finish() == whole


def test_bytes_become_text_again(words):
    decoder = bpe_codec.Decoder(words, joined=False)
    encoder = bpe_codec.Encoder(words)
    ids = np.frombuffer(encoder.encode("grüße 🙂 中"), np.int32).tolist()
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == "grüße 🙂 中 "


def test_rows(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (2, ""), (None, "the cat <|endoftext|>")], "n_tokens long, text string")
    assert sorted(r["n_tokens"] for r in token_counts.with_token_counts(rows, PATH).collect()) == [0, 0, 0, 3]
    both = bpe_codec.encode(rows, PATH, decoded_col="decoded")
    again = bpe_codec.decode(both.select("ids", "decoded"), PATH, out="again")
    assert again.where("not (decoded <=> again)").count() == 0 and both.where("size(ids) > 0").count() == 1
    assert bpe_codec.encode(rows.limit(0), PATH).count() == 0


def test_short_words_need_no_stream(words, monkeypatch):
    """Words that are remembered are merged at once, with the tokens of the stream."""
    encoder, pick = bpe_codec.Encoder(words), random.Random(3)
    made = ["".join(pick.choice("etaoinshré中🙂") for _ in range(pick.randint(1, 64))) for _ in range(500)]
    expected = [encoder._word(word) for word in made]
    monkeypatch.setattr(bpe_codec.WordEncoder, "feed", None)
    assert [encoder.known[word] for word in made] == expected


def test_later_letters_as_by_pattern():
    later = vocabulary._later()
    assert all((c in later) == bool(vocabulary.regex.match(f"[{vocabulary._later_letters()}]", c))
               for c in map(chr, [*range(0x3000), *range(0x1E000, 0x20000)]))
