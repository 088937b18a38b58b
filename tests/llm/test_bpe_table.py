"""The table of pieces: what comes again stays in it, and what leaves it changes no id."""

import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pagewright.llm import bpe


def ranks():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return bpe.parse_ranks(file.read())


def test_pieces_that_come_again_are_replayed_once(monkeypatch):
    """Each part has the same words and new ones, so that the table is full again and again."""
    monkeypatch.setattr(bpe, "PIECES_KEPT", 150)
    replayed, runs = [], bpe._runs
    monkeypatch.setattr(bpe, "_runs", lambda pieces: runs(replayed.extend(found := list(pieces)) or found))
    codec, rng = bpe.Codec(ranks(), P.PATTERN), random.Random(3)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks(), special_tokens={})
    most = 0
    for _ in range(60):
        text = "".join(" " + w for w in ["the", "house", "bridge", "water"]) + "".join(" " + "".join(rng.choices("abcdeé", k=12)) for _ in range(40))
        assert [ids.tolist() for ids in codec.encode([text, ""])] == [library.encode_ordinary(text), []]
        most = max(most, len(codec.packed))
    assert replayed.count(" house") == replayed.count(" the") == 1  # they were replayed at each emptying before
    assert len(replayed) > 60 * 40 and most <= 150 + 2 * 60  # the rest did leave: a full table and the part that overfills it


@pytest.mark.parametrize("gap", [0, 7])
def test_decoding_by_parts_and_with_gaps_between_ranks(monkeypatch, gap):
    monkeypatch.setattr(bpe, "DECODED", 3, raising=False)
    shifted = {token: rank + (gap if rank >= 300 else 0) for token, rank in ranks().items()}
    codec = bpe.Codec(shifted, P.PATTERN)
    text = "the house 中文 naïve 😀 " * 5
    (ids,) = codec.encode([text])
    assert codec.decode(ids) == text.encode() and codec.decode(ids[:0]) == b""
    for unknown in [max(shifted.values()) + 1] + [302] * bool(gap):
        with pytest.raises(LookupError):
            codec.decode(np.array([unknown], "<u4"))
