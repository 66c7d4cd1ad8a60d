"""Long unbroken texts: the same ids as position by position, in time."""

import random
import time

from raillark.llm import viterbi


def test_long_segments(monkeypatch):
    own = viterbi.lattice()
    rng = random.Random(3)
    pool = list("abcdefghijklmnopqrstuvwxyzäéß日本語🙂\x00<>0123")
    texts = ["".join(rng.choices(pool, k=n)) for n in (1, 2, 40, 257, 400)] + ["the" * 200, "a" * 300]
    short = []
    with monkeypatch.context() as m:
        m.setattr(viterbi, "LONG", 1 << 30)
        short = [own.solve([t])[0].tolist() for t in texts]
    assert [own.solve_long(t).tolist() for t in texts] == short
    began = time.perf_counter()
    assert len(own.solve(["".join(rng.choices(pool, k=300_000))])[0])
    assert time.perf_counter() - began < 30
