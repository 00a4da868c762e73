"""The bound of chains that cannot hold a passage is the longest common subsequence of both margins, and cheap where margins share little."""

import random

import numpy as np

from signalforge.llm import fuzzy_passages as P


def test_only_words_that_both_margins_hold_are_compared(monkeypatch):
    asked, plain = [], P.lcs_rows
    monkeypatch.setattr(P, "lcs_rows", lambda a, b: asked.append(len(a) + len(b)) or plain(a, b))
    rng = random.Random(2)
    for _ in range(300):
        one, two = ([rng.randrange(60) for _ in range(95)] for _ in range(2))
        two[30:53] = one[30:53]
        asked.clear()
        chain = np.array(one, "uint32"), 0, np.array(two, "uint32"), 0, np.array([[30, 30], [48, 48]], "int32")
        got = P.can_hold(*chain)
        need = int(np.ceil(P.IDENTITY * P.LEAST - 1e-9)) - 23
        margins = [(one[:30], two[:30]), (one[53:83], two[53:83])]
        assert got == (sum(len(b) - plain(a, b)[-1].bit_count() for a, b in margins) >= need)
        shared = [sum(w in b for w in a) + sum(w in a for w in b) for a, b in margins]
        assert all(n in shared for n in asked)
        assert len(P.align(*chain)) >= 23
