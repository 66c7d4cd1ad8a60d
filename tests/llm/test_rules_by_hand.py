"""The divergence verdict against plain Python, and references that do not depend on the partitions."""

import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from raillark.llm import quality_rules, scan

DATA = "/root/testdata/sf0.001"
PUNCT = re.compile("[\x20\x09-\x0d!-/:-@\\[-`{-~]+")
WORDS = re.compile("[^\x20\x09-\x0d]+")


def kind(c):
    if c < "\x80":
        return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if c in " \t\n\x0b\x0c\r" else 4 if c in ".,;:?'\"()-" else 5 if c in "!/_" else 6
    g = unicodedata.category(c)
    return {"Lu": 1, "Lt": 1}.get(g, {"L": 0, "M": 0, "N": 2, "Z": 3, "P": 4}.get(g[0], 6))


def js(p, q):
    half = lambda a, b: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b, strict=True) if x > 0)
    return math.sqrt(max(0.0, (half(p, q) + half(q, p)) / 2))


def test_classes_of_code_points():
    texts = ["aZ9 ,!~\n", "éÉß٣ …■▒�", "日本🙂𝒜\U00020000", "", None]
    got = np.concatenate([quality_rules.class_counts(p) for p in scan.slices(pa.array(texts))])
    for row, text in zip(got, texts, strict=True):
        want = Counter(kind(c) if ord(c) < 0x20000 else 0 for c in text or "")
        assert row.tolist() == [want[k] for k in range(7)]


@pytest.mark.parametrize("parts", [1, 40])
def test_verdicts(spark, parts):
    df = spark.read.parquet(f"{DATA}/documents.parquet").repartition(parts)
    docs = df.toPandas()
    refs = quality_rules.references(df)
    got = {r.doc_id: r for r in quality_rules.judged(df).collect()}
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    langs, counts, shares = {}, {}, {}
    for text, lang in zip(docs.text, docs.lang, strict=True):
        w = [x for x in PUNCT.split(lower(text)) if x]
        counts.setdefault(lang, Counter()).update(w)
        c = Counter(map(kind, text))
        if len(w) >= 50 and len(text) >= 200:
            shares.setdefault(lang, []).append([c[k] / len(text) for k in range(7)])
    for lang, c in counts.items():
        if sum(c.values()) >= 2000 and lang in shares:
            steps = np.minimum(499, (np.array(shares[lang]) * 500).astype(int))
            middle = np.sort(steps, 0)[math.ceil(len(steps) / 2) - 1]
            share = np.where(middle > 0, (middle + 0.5) / 500, 0)
            langs[lang] = share / share.sum(), c
    assert sorted(langs) == refs.languages
    for i, text, lang in zip(docs.doc_id, docs.text, docs.lang, strict=True):
        words = WORDS.findall(text)
        inner = [x for x in PUNCT.split(lower(text)) if x]
        runs = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {k + d for k in range(len(words) - 2) if runs[tuple(words[k : k + 3])] > 1 for d in range(3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        off = False
        if lang in langs:
            own = Counter(map(kind, text))
            if len(text) >= 200:
                off |= js([own[k] / len(text) for k in range(7)], langs[lang][0]) > 0.13 + 1.4 / math.sqrt(len(text))
            if len(inner) >= 50:
                total = sum(langs[lang][1].values())
                top = sorted(langs[lang][1].values(), reverse=True)[:24]
                best = [w for w, n in langs[lang][1].items() if n > top[-1]]
                ties = [w for w, n in langs[lang][1].items() if n == top[-1]]
                if len(best) + len(ties) == 24:  # ties at the last place are broken by hashes
                    best += ties
                    have = Counter(inner)
                    p, q = [have[w] / len(inner) for w in best], [langs[lang][1][w] / total for w in best]
                    assert got[i].word_distance == pytest.approx(js([*p, 1 - sum(p)], [*q, 1 - sum(q)]), abs=1e-6)
            off |= bool(got[i].word_distance and got[i].word_distance > 0.20 + 1.9 / math.sqrt(len(inner)))
        assert (got[i].base_failed, got[i].kept) == (failed, not failed and not off)
