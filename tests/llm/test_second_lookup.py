"""Unresolved lines are compared again with the postings that can match, not with whole lists."""

import numpy as np
from pyspark.sql import functions as F

from raillark.llm import line_dedup as ld


def test_rows_looked_up_can_match(spark):
    rng = np.random.default_rng(4)
    rows = []
    for d in range(900):
        n = int(rng.integers(4, 300)) if d < 890 else ld.LONGEST
        rows.append(((int(rng.integers(1, 4)) << ld._SIZE) | n, d, 0, 0, 0, int(rng.integers(0, n - -(-80 * n // 100) + 1))))
    posts = spark.createDataFrame(rows, "key long, doc_id long, line_no long, sketch long, sketch2 long, mark long")
    open_lines = spark.createDataFrame([(d, 0) for d in (3, 8, 21, 895)], "doc_id long, line_no long")

    def fits(a, b):
        (n, p), (m, q) = ((r[0] & ld.LONGEST, r[5]) for r in (a, b))
        if a[0] >> ld._SIZE != b[0] >> ld._SIZE:
            return False
        return max(n, m) >= ld.LONGEST and 100 * min(n, m) >= 50 * max(n, m) or 100 * min(n, m) >= 80 * max(n, m) and 180 * (1 + min(n - p - 1, m - q - 1) + min(p, q)) >= 80 * (n + m)

    asked = [r for r in rows if r[1] in (3, 8, 21, 895)]
    want = {r[1] for r in rows if any(fits(r, a) for a in asked)}
    got = ld.looked_up(posts, open_lines, 80).collect()
    assert len(got) == len({r.doc_id for r in got}) and {r.doc_id for r in got} == want and len(want) < 450
    assert {r.doc_id for r in got if r.mark >> ld._FLAG & 1} == {3, 8, 21, 895}
    assert {r.doc_id: r.mark & ((1 << ld._SIDE) - 1) for r in got} == {r[1]: r[5] for r in rows if r[1] in want}


def test_near_misses_among_many_sizes(spark, monkeypatch):
    """Lines with many candidates that fail, and one that does not, come out as by brute force."""
    rng = np.random.default_rng(9)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join([w for w in base if rng.random() > 0.11] + [f"y{rng.integers(0, 30)}" for _ in range(3)]) for _ in range(160)]
    texts += [" ".join(base[: 6 + k % 50]) + f" z{k}" for k in range(160)]
    sets = [set(t.split()) for t in texts]
    want = {b for b in range(len(sets)) if any(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a in range(b))}
    seen = []
    own = ld.looked_up
    monkeypatch.setattr(ld, "looked_up", lambda posts, open_lines, percent: seen.append((open_lines.count(), posts.count())) or own(posts, open_lines, percent))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").where(F.col("text") != "")
    gone, _ = ld.removed_lines(docs)
    assert {r.doc_id for r in gone.collect()} == want and seen and seen[0][0] > 0
