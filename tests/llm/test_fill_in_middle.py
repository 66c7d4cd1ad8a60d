"""Units, forms and exact restoring against plain Python."""

import hashlib
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from raillark.llm import fill_in_middle as fim

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("a b\n\tñ \U0001f600\x85<P>", max_size=40), max_size=6))
def test_units(texts):
    flat, parent, ordinal = fim.units(pa.array([t.encode() for t in texts], pa.large_binary()))
    want = [(u, row, k) for row, t in enumerate(texts) for k, u in enumerate(UNIT.findall(t))]
    assert [(u.decode(), row, k) for u, row, k in zip(flat.to_pylist(), parent.to_pylist(), ordinal.tolist(), strict=True)] == want


def plain(doc_id, text):
    """The contract by plain Python: (n, form, prefix, middle, output)."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(b"42:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_rows_equal_plain_python(spark, edge_docs, no_docs, monkeypatch):
    more = [(k, t) for k, t in enumerate(["<P>", "a <S> b", "<", "< P >", " ", "\n\n", "x", "é é  y ", "<<M", None, "w " * 5000] * 12)]
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).withColumn("n", F.lit(1)).withColumn("form", F.lit("x"))
    monkeypatch.setattr(fim, "SLICE_BYTES", 64)
    out = fim.transformed(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = sorted(map(repr, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect())))
    rows = docs.collect()
    assert got == sorted(repr((r.doc_id, *plain(r.doc_id, r.text))) for r in rows)
    assert sorted((r.doc_id or 0, r.back) for r in out.collect()) == sorted((r.doc_id or 0, r.text or "") for r in rows)
    assert {r.form for r in out.collect()} == {"plain", "spm", "psm"}
    assert fim.transformed(no_docs).count() == 0
