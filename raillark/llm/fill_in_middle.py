"""Fill-in-middle transformation of documents with ``pyarrow.compute`` (operator 12).

A text is cut into units, a run of white space with the word after it.  Two cuts
drawn from the document's id split the units into prefix, middle and suffix, which are
written back in another order between sentinels.

Each slice of a batch is one column pipeline without a loop over rows: a mark is put
behind every word (byte FF, which no UTF-8 text holds), the text is split at the marks into a
list of units, the lists are flattened with their parents' indices, each unit's ordinal
is its place less its parent's offset, units are filtered by role, the roles' lists are rebuilt from counts, and
``binary_join`` makes the pieces.  Draws come from the id alone, so every run and
partitioning gives the same rows; draws and digests are DataFrame functions.

Defined results: a null or empty text has no unit and stays plain and empty; a text that
holds a sentinel stays plain, so any output can be undone; a null ``doc_id`` draws from
the bare seed; rows that share a ``doc_id`` share its draws.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raillark.llm.workspace import pick

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Percent of texts that are transformed, and of these the percent whose suffix leads.
RATE, SPM = 50, 80
SLICE_BYTES = 1 << 22
_WORD = r"([^\x20\x09-\x0D]+)"
_MARK = b"\xff"
#: Of UTF-8, each code point's first byte.
_LEAD = r"[^\x80-\xBF]"


def _sliced(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``SLICE_BYTES``, a longer text alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + SLICE_BYTES, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def units(text: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Units of all rows, the row and the ordinal of each."""
    lists = pc.split_pattern(pc.replace_substring_regex(text, pattern=_WORD, replacement=rb"\1" + _MARK), pattern=_MARK)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(flat), 0)  # what follows the last mark may be empty
    flat, parent = flat.filter(full), parent.filter(full)
    rows = parent.to_numpy()
    first = np.searchsorted(rows, np.arange(len(text)))
    return flat, parent, np.arange(len(rows)) - first[rows]


def pieces(flat: pa.Array, parent: pa.Array, role: pa.Array, n_rows: int) -> pa.Array:
    """The units of a role joined row by row."""
    counts = np.bincount(parent.filter(role).to_numpy(), minlength=n_rows)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, flat.filter(role)), pa.scalar(b"", flat.type))


def _transformed(rate: int, spm: int):
    """Rows (doc_id, text, h1 to h4) as (doc_id, n, form, prefix_chars, middle_chars, output)."""
    mark = lambda x: pa.scalar(x.encode(), pa.large_binary())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
        h = [batch.column(k).to_numpy() for k in range(2, 6)]
        flat, parent, ordinal = units(text)
        rows = parent.to_numpy()
        n = np.bincount(rows, minlength=batch.num_rows)
        first, second = h[0] % (n + 1), h[1] % (n + 1)
        lo, hi = np.minimum(first, second)[rows], np.maximum(first, second)[rows]
        roles = (ordinal < lo, (ordinal >= lo) & (ordinal < hi), ordinal >= hi)
        prefix, middle, suffix = (pieces(flat, parent, pa.array(r), batch.num_rows) for r in roles)
        plain = pc.or_(pc.equal(pc.binary_length(text), 0), pa.array(h[2] % 100 >= rate))
        for sentinel in (PREFIX, SUFFIX, MIDDLE):
            plain = pc.or_(plain, pc.match_substring(text, pattern=sentinel.encode()))
        leads = pa.array(h[3] % 100 < spm)
        empty = mark("")
        by_spm = pc.binary_join_element_wise(mark(SUFFIX), suffix, mark(PREFIX), prefix, mark(MIDDLE), middle, empty)
        by_psm = pc.binary_join_element_wise(mark(PREFIX), prefix, mark(SUFFIX), suffix, mark(MIDDLE), middle, empty)
        output = pc.if_else(plain, text, pc.if_else(leads, by_spm, by_psm))
        form = pc.if_else(plain, "plain", pc.if_else(leads, "spm", "psm"))
        chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.count_substring_regex(x, pattern=_LEAD).cast(pa.int64())) for x in (prefix, middle)]
        columns = [batch.column(0), pa.array(n, pa.int64()), form, *chars, output.cast(pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _sliced(batch, 1):
                yield work(part)

    return run


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of each id."""
    hexes = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(hexes, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]


def transformed(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row of ``docs``."""
    base = pick(docs, doc_id="bigint", text="string")
    drawn = base.select("doc_id", "text", *(h.alias(f"h{k}") for k, h in enumerate(draws(F.col("doc_id"), seed), 1)))
    return drawn.mapInArrow(_transformed(rate, spm), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over the whole of ``documents``; digests of its outputs and of the texts restored from them."""
    out = transformed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digest = lambda c: F.sha2(c, 256)
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    return out.select(*columns, digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_DRAW = ", ".join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
#: The same in DuckDB SQL.
ORACLE = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '{_UNIT}') AS u, {_DRAW} FROM t),
c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(list_slice(u, 1, a), '') AS prefix, array_to_string(list_slice(u, a + 1, b), '') AS middle, array_to_string(list_slice(u, b + 1, n), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""
