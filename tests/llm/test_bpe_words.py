import random

import public_tokenizers

from turnout.llm import bpe


def test_short_words_are_the_merged_ones_with_fewer_merges(monkeypatch):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        coder = bpe.Codec(f.read())
    pick = random.Random(3)
    tokens = sorted(coder.id_of)
    odd = [b"".join(pick.choice(tokens) for _ in range(pick.randint(1, 6))) for _ in range(2000)]
    odd += [bytes(pick.choice(letters) for _ in range(pick.randint(1, 60)))
            for letters in (b"aab ", b"etaoinshrdlu", b"0123456789=-_.", bytes(range(256))) for _ in range(500)]
    for word in odd:
        assert list(coder.tails.row(word)) == coder.merged(word)

    syllables = ["an", "the", "on", "ver", "keit", "rhe", "éch", "ou", "ing", "st", "re", "wh", "io", "ç", "ble"]
    words = list(dict.fromkeys(" " + "".join(pick.choices(syllables, k=pick.randint(2, 6))) for _ in range(20_000)))
    want = {word: coder.merged(word.encode()) for word in words}
    merges = []
    plain = bpe.Codec.merge
    monkeypatch.setattr(bpe.Codec, "merge", lambda self, part: merges.append(1) or plain(self, part))
    assert {word: list(coder.known[word]) for word in words} == want
    assert len(merges) < len(words) / 2
    # memories that start anew on the way change nothing
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    monkeypatch.setattr(bpe, "PAIRS", 50)
    again = bpe.Tails(coder)
    assert all(list(again.row(word.encode())) == want[word] for word in words[:2000])
    assert len(again) <= 50 and len(again.neighbours) <= 50


def test_vocabulary_without_all_bytes_is_merged():
    coder = bpe.Codec('{"model": {"vocab": {"a": 0, "b": 1, "ab": 2}, "merges": ["a b"]}, "added_tokens": []}')
    assert not coder.complete
    assert coder.encode("aabab") == [0, 2, 2]
