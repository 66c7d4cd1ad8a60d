"""The toxicity model learns from every labelled row, however many and however long."""

import numpy as np

from raillark.llm import toxicity


def test_every_label_is_used(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 1500)  # three shards
    rng = np.random.default_rng(3)
    words = np.array([f"w{k}" for k in range(300)])
    y = (rng.random(9000) < 0.3).astype(int)
    rows = [(d, " ".join(rng.choice(words, 6)) + (f" bad{d % 3000}" if t else f" good{d % 3000}"), "en") for d, t in enumerate(y.tolist())]
    long = " ".join(words[:250].tolist() * 30)  # over 30,000 characters
    rows += [(10_000 + d, f"{long} {'vile' if d % 2 else 'kind'}", "en") for d in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(d, int(t)) for d, t in enumerate(y)] + [(10_000 + d, d % 2) for d in range(80)], "doc_id long, toxic int")
    seen, own = [], toxicity.trained
    counted, counts = [], toxicity.calibration_counts
    monkeypatch.setattr(toxicity, "trained", lambda rows, *a, **k: (seen.append([(r.shard, r["count"]) for r in rows.groupBy("shard").count().collect()]), own(rows, *a, **k))[1])
    monkeypatch.setattr(toxicity, "calibration_counts", lambda rows, model: (counted.append(counts(rows, model)), counted[-1])[1])
    model = toxicity.fit(docs, labels)
    parts = docs.select(toxicity.part_of(docs.doc_id).alias("part")).groupBy("part").count().collect()
    n = {r.part: r["count"] for r in parts}
    assert len(seen[0]) == 3 and sum(c for _, c in seen[0]) == n[1] + n[3]
    assert counted[0][3].sum() == n[0]
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    toxic, clean = np.mean([got[d] for d in range(9000) if y[d]]), np.mean([got[d] for d in range(9000) if not y[d]])
    assert toxic > 0.6 and clean < 0.2
