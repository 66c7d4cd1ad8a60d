"""Lines of few words, and of scripts without blanks, go like any other."""

import random
import re

from raillark.llm import line_dedup

PUNCT = re.compile("[\x20\x09-\x0d!-/:-@\\[-`{-~]+")


def test_lines_of_any_size(spark):
    rng = random.Random(4)
    rows = [(d, "\n".join(" ".join(rng.choices("abcdefgh", k=rng.randint(0, 7))) for _ in range(6))) for d in range(60)]
    rows += [(100, "今日は良い天気です。\nแมวนอนอยู่บนหลังคา"), (101, "แมวนอนอยู่บนหลังคา\n今日は良い天気です。"), (102, "今日は雨です。\n--\n--")]
    rows += [(110, "p q r s"), (111, "p q r s t"), (112, "p q r"), (113, "R q, p")]
    seen, want = [], set()
    for d, text in rows:
        for k, line in enumerate(text.split("\n")):
            s = {w for w in PUNCT.split(line.lower()) if w}
            if s and any(100 * len(s & t) >= 80 * len(s | t) for t in seen):
                want.add((d, k))
            seen.append(s)
    assert {(101, 0), (101, 1), (111, 0), (113, 0)} <= want and not {(102, 1), (102, 2), (112, 0)} & want
    gone, _ = line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.line_no) for r in gone.collect()} == want
