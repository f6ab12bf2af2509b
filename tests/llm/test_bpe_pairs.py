"""The memo of token pairs."""

from tidemark.llm import bpe


def test_pairs_are_worked_out_once_and_the_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 2)
    asked = []
    fits = bpe.Fits(lambda left, right: asked.append((left, right)) or left < right)
    assert [fits[3 << 20 | 70_000], fits[3 << 20 | 70_000], fits[9 << 20 | 1]] == [True, True, False]
    assert asked == [(3, 70_000), (9, 1)]
    for left in range(20):
        assert fits[left << 20 | 5] == (left < 5) and len(fits) <= 6
