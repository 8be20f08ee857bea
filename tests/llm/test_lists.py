"""What op3's inverted lists carry through shuffles."""

from __future__ import annotations

from strandloom.llm import minhash

from .test_operators import brute_groups, collected, edited, frame, words


def test_entries_of_lists_do_not_repeat_the_lists(spark, monkeypatch):
    """Each entry of a list carried all values of its node, so what was shuffled grew with their square."""
    monkeypatch.setattr(minhash, "SMALL_LIST", 4)
    apart, written = [], minhash.materialise

    def seen(df, name, *how):
        if name == "apart":
            apart.append(dict(df.dtypes))
        return written(df, name, *how)

    monkeypatch.setattr(minhash, "materialise", seen)
    base = words(5, 150)
    data = [(i, edited(base, i, 0.02 + 0.10 * (i % 5) / 4), *[None] * 7) for i in range(60)]
    assert collected(minhash.near_duplicates(frame(spark, data)).drop("text_hash")) == brute_groups(data, 2, 80)
    assert apart and not [c for x in apart for c, kind in x.items() if kind.startswith("array")]
    assert len(apart) == 3
