"""Numbers of words, on which near duplicates rest."""

from __future__ import annotations

import random

import pytest

from snapforge.llm import near_duplicates


def alternating(n: int, first: int = 0) -> str:
    """The Thue-Morse word of ``n`` letters, for which polynomials modulo a power of two meet."""
    return "".join("ab"[(k.bit_count() + first) % 2] for k in range(n))


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096, 1 << 21])
def test_words_made_to_meet_do_not(n):
    one, other = (near_duplicates.word_hashes(alternating(n, first)) for first in (0, 1))
    assert len(one) == len(other) == 1 and one[0] != other[0]


def test_documents_without_a_common_word_are_not_linked(spark):
    rows = spark.createDataFrame([(1, alternating(1024, 0)), (2, alternating(1024, 1))], "doc_id long, text string")
    assert {(r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(rows).collect()} == {(1, True), (2, True)}


def test_random_words_never_share_a_number():
    rng = random.Random(3)
    words = {"".join(rng.choices("abé", k=rng.choice([rng.randint(1, 12), rng.randint(1, 8000)]))) for _ in range(4000)}
    numbers = near_duplicates.word_hashes("\n".join(sorted(words)))
    assert len(set(numbers.tolist())) == len(numbers) == len(words)


def test_words_of_chunks_are_those_of_the_text(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice(["Ab", "c", " ", "\t", "\n", "\x0b", "é", " ", "\x1f"]) for _ in range(3000))
    whole = near_duplicates.word_hashes(text).tolist()
    for chunk in (1, 7, 100):
        monkeypatch.setattr(near_duplicates, "TEXT_CHUNK", chunk)
        assert near_duplicates.word_hashes(text).tolist() == whole
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    words = near_duplicates.re.findall("[^\x20\x09-\x0d]+", lower)
    assert whole == [near_duplicates._digest(w.encode()) for w in words]
