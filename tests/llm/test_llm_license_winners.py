"""The size reduction chooses the templates of op8 that are confirmed."""

import random

from rankflow.llm import licenses


class _Constant:
    def __init__(self, size):
        self.size = size

    def compress(self, data):
        return b"x" * self.size


def test_winners_reject_and_order():
    assert licenses.winners([-10, -60, -25, 5, -40, -60]) == [(-60, 1), (-60, 5), (-40, 4)]
    assert licenses.winners([0, 3, 0]) == [] and licenses.winners([]) == []


def test_a_compressor_without_reductions_finds_nothing(monkeypatch):
    text = "Some words. Released under the MIT License\nmore words here"
    assert [x[2] for x in licenses.scan(text)] == ["MIT"]
    made = [(name, needed, notice, _Constant(10**6), heading) for name, needed, notice, _, heading in licenses.templates()]
    monkeypatch.setattr(licenses, "templates", lambda: made)
    assert licenses.scan(text) == []


def test_the_template_with_the_best_reduction_is_asked_first(monkeypatch):
    asked = []
    confirm = licenses.confirm
    monkeypatch.setattr(licenses, "confirm", lambda told, needed, notice: asked.append(" ".join(needed)) or confirm(told, needed, notice))
    licenses.scan("noise " * 20 + "Licensed under the Apache License, Version 2.0" + " noise" * 20)
    assert asked[0] == "apache 2.0" and len(asked) < len(licenses.templates())


def test_winners_lose_no_notice_in_noise(monkeypatch):
    """Against confirming every template: all wordings of the list, whole and with a changed word, in noise."""
    rng = random.Random(3)
    texts = []
    for _, _, notice in licenses.NOTICES:
        words = notice.split()
        for line in (notice, " ".join([*words[:1], "also", *words[1:]])):
            noise = [" ".join("".join(rng.choice("aeiounrstl") for _ in range(rng.randint(2, 9))) for _ in range(60)) for _ in range(2)]
            texts.append(f"{noise[0]}\n\n{line}\n\n{noise[1]}")
    found = [[x[:4] for x in licenses.scan(t)] for t in texts]
    monkeypatch.setattr(licenses, "winners", lambda sizes: sorted((s, i) for i, s in enumerate(sizes)))
    every = [[x[:4] for x in licenses.scan(t)] for t in texts]
    assert found == every and sum(map(len, found)) >= len(licenses.NOTICES)
