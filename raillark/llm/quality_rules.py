"""Quality rules by distribution divergence (operator 1).

Base counts of each text come first.  A text that passes them is held against a
reference of its language: the histogram of character classes and the histogram
of the language's commonest words, each by Jensen-Shannon distance.  A text that
names no language is held against the nearest reference of the ``UNNAMED`` languages
of most words; one of a named language without reference gets no verdict, nor does a
histogram below a minimum length.

References are gathered from the whole table: per language the median share of each
character class (which no minority of junk moves) and the counts of words, of
which the ``TOP_WORDS`` commonest are kept.  All words are counted, by a partial
aggregation.  Every language of ``REFERENCE_WORDS`` words has a reference, made in Spark as
one row of a few hundred bytes.  Up to ``MOST_LANGUAGES`` rows are sent to all tasks; where a
column of site tags or the like gives more, they stay a table and are joined by language.

Defined results: a null text has no words and fails the base rule; null languages
have no reference of their own; repeated rows each get their row.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from raillark.llm import scan
from raillark.llm.workspace import free_name, pick, stored

TOP_WORDS = 24
#: Parts in which the words of one language are ranked.
SALTS = 64
#: A language needs this many words for a reference of its own.
REFERENCE_WORDS = 2000
#: Texts that name no language are held against the references of so many languages, those of most words.
UNNAMED = 64
#: So many references are sent to every task (some 600 bytes each); more are joined by language.
MOST_LANGUAGES = 4096
#: Guards: fewer characters or words give no verdict of that histogram.
MIN_CHARS, MIN_WORDS = 200, 50
#: The largest distances that pass; the word limit widens for short texts.
CHAR_LIMIT, CHAR_SLACK, WORD_LIMIT, WORD_SLACK = 0.13, 1.4, 0.20, 1.9
#: Steps that the shares of character classes are counted in.
STEPS = 500
MIN_BASE_WORDS, MAX_REPEAT_PERCENT = 50, 50

CLASSES = ("lower", "upper", "digit", "space", "stop", "mark", "symbol")
#: Classes of code points up to here come from a table; higher ones are letters of Han extensions.
_TABLED = 0x20000


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point by its general category; ASCII punctuation is split into stops, marks and symbols.

    Letters without case, and marks on letters, count as lower case, so that a passage
    in another script is no divergence.
    """
    of = {"Lu": 1, "Lt": 1, "Nd": 2, "Nl": 2, "No": 2, "Zs": 3, "Zl": 3, "Zp": 3}
    by_group = {"L": 0, "M": 0, "P": 4, "S": 6, "C": 6}
    table = np.array([of.get(c, by_group.get(c[0], 6)) for c in map(unicodedata.category, map(chr, range(_TABLED)))], np.int8)
    for b in range(0x80):
        c = chr(b)
        table[b] = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 if scan.SPACE[b] else 4 if c in ".,;:?'\"()-" else 5 if c in "!/_" else 6
    return table


_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


class References(NamedTuple):
    languages: list[str]
    chars: np.ndarray  # (languages, classes), rows sum to 1
    words: np.ndarray  # (languages, TOP_WORDS) hashes, 0 where there are fewer
    shares: np.ndarray  # (languages, TOP_WORDS + 1), the last for all other words


def class_counts(part: scan.Slice) -> np.ndarray:
    """(rows, classes) numbers of characters."""
    rows = len(part.bounds) - 1
    data = part.data
    table = _classes()
    n = len(CLASSES) + 1
    ascii_table = np.full(256, n - 1, np.int8)  # the last class: bytes above ASCII, seen below
    ascii_table[:0x80] = table[:0x80]
    doc = np.repeat(np.arange(rows, dtype=np.int64) * n, np.diff(part.bounds))
    counts = np.bincount(doc + scan.through(ascii_table, data), minlength=rows * n).reshape(rows, n)[:, : n - 1]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int32)
        b0, b1, b2, b3 = (padded[lead + k] for k in range(4))
        point = np.where(b0 < 0xE0, (b0 & 31) << 6 | (b1 & 63), np.where(b0 < 0xF0, (b0 & 15) << 12 | (b1 & 63) << 6 | (b2 & 63), (b0 & 7) << 18 | (b1 & 63) << 12 | (b2 & 63) << 6 | (b3 & 63)))
        kind = np.where(point < _TABLED, table[np.minimum(point, _TABLED - 1)], 0)
        counts = counts + np.bincount(doc[lead] // n * (n - 1) + kind, minlength=rows * (n - 1)).reshape(rows, n - 1)
    return counts


def base_counts(part: scan.Slice) -> dict[str, np.ndarray]:
    """The contract's counts of each row."""
    rows = len(part.bounds) - 1
    w, hasher, data = scan.words(part)
    n_words = np.diff(w.first)
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    word_points = np.concatenate([[0], np.cumsum(point[w.end] - point[w.start])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])

    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([part.bounds[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    ends = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, starts)], part.bounds[np.searchsorted(part.bounds, starts, "right")])
    worded = np.searchsorted(w.start, ends) > np.searchsorted(w.start, starts)
    starts, ends = starts[worded], ends[worded]
    doc = np.searchsorted(part.bounds, starts, "right") - 1
    lines = hasher(starts, ends)
    order = np.lexsort((lines, doc))
    again = (lines[order][1:] == lines[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    dup_lines = np.bincount(doc[order][1:][again], minlength=rows)

    window, at = scan.runs(w, 3)
    repeated = np.zeros(len(w.hash) + 1, np.int32)
    if len(at):
        own = scan.mix(window + w.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(own)
        same = own[order][1:] == own[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hits = at[twice]
        np.add.at(repeated, hits, 1)
        np.add.at(repeated, hits + 3, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(repeated[:-1]) > 0)])
    return {
        "n_words": n_words,
        "word_chars": np.diff(word_points[w.first]),
        "n_symbols": np.diff(symbols[part.bounds]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": np.diff(covered[w.first]),
    }


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (square root, base 2) of rows of two arrays of distributions."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0.0).sum(-1)
        right = np.where(q > 0, q * np.log2(q / m), 0.0).sum(-1)
    return np.sqrt(np.maximum(0.0, (left + right) / 2))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, kind, key, amount): class shares, words and documents of each slice."""
    for batch in batches:
        langs = batch.column(0)
        for part in scan.slices(batch.column(1)):
            named = langs.slice(part.lo, part.hi - part.lo).to_pylist()
            names = sorted({x for x in named if x is not None})
            of = {x: k for k, x in enumerate(names)}
            lang = np.array([of.get(x, -1) for x in named])
            counts = class_counts(part).astype(float)
            total = counts.sum(1)
            w, _, _ = scan.words(part, lower=True, sep=scan.PUNCT)
            base = np.diff(w.first) >= MIN_BASE_WORDS
            out: list[tuple] = []
            kinds = [pa.string(), pa.string(), pa.int64(), pa.float64()]
            for k, name in enumerate(names):
                rows = (lang == k) & base & (total >= MIN_CHARS)
                if rows.any():
                    step = np.minimum(STEPS - 1, (counts[rows] / total[rows, None] * STEPS).astype(np.int64))
                    key, n = np.unique(step + np.arange(len(CLASSES)) * STEPS, return_counts=True)
                    out += [(name, "class", int(c), float(s)) for c, s in zip(key, n, strict=True)]
                    out.append((name, "docs", 0, float(rows.sum())))
                own = w.hash[lang[w.doc] == k]
                if len(own):
                    key, n = np.unique(own.view(np.int64), return_counts=True)
                    out.append((name, "words", 0, float(len(own))))
                    yield pa.RecordBatch.from_arrays([pa.repeat(name, len(key)), pa.repeat("word", len(key)), pa.array(key), pa.array(n, pa.float64())], ["lang", "kind", "key", "amount"])
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["lang", "kind", "key", "amount"])


def reference_rows(docs: DataFrame) -> DataFrame:
    """lang, total, docs, middle, top: one row for each language of ``REFERENCE_WORDS`` words, stored."""
    parts = pick(docs, lang="string", text="string").mapInArrow(_gather, "lang string, kind string, key long, amount double").groupBy("lang", "kind", "key").agg(F.sum("amount").alias("amount"))
    parts = stored(parts, "counts")  # used three times
    known = parts.where("kind in ('words', 'docs')").groupBy("lang").agg(F.max(F.when(F.col("kind") == "words", F.col("amount"))).alias("total"), F.max(F.when(F.col("kind") == "docs", F.col("amount"))).alias("docs"))
    known = known.where((F.col("total") >= REFERENCE_WORDS) & F.col("docs").isNotNull())
    common = parts.where("kind = 'word'").withColumn("salt", F.pmod("key", F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):  # a language's words are ranked in parts first
        rank = Window.partitionBy(*keys).orderBy(F.desc("amount"), "key")
        common = common.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= TOP_WORDS).drop("r")
    top = common.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct((-F.col("amount")).alias("less"), "key"))).alias("top"))  # TOP_WORDS entries
    # the step at which half of a language's documents are reached, in each class
    steps = parts.where("kind = 'class'").join(known.select("lang", "docs"), "lang").withColumn("of", F.floor(F.col("key") / STEPS))
    reached = F.sum("amount").over(Window.partitionBy("lang", "of").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    half = steps.withColumn("reached", reached).where(F.col("reached") >= F.col("docs") / 2).groupBy("lang", "of").agg((F.min("key") % STEPS).alias("step"))
    middle = half.groupBy("lang").agg(*(F.coalesce(F.max(F.when(F.col("of") == k, F.col("step"))), F.lit(0)).alias(f"m{k}") for k in range(len(CLASSES))))
    rows = known.join(top, "lang").join(middle, "lang")
    return stored(rows.select("lang", "total", "docs", F.array(*(f"m{k}" for k in range(len(CLASSES)))).alias("middle"), "top"), "references")


def references_of(rows: list[dict]) -> References:
    """The references that rows of :func:`reference_rows` describe."""
    rows = sorted(rows, key=lambda r: r["lang"])
    chars = np.zeros((len(rows), len(CLASSES)))
    words = np.zeros((len(rows), TOP_WORDS), np.int64)
    shares = np.zeros((len(rows), TOP_WORDS + 1))
    for k, r in enumerate(rows):
        middle = np.array(r["middle"])
        share = np.where(middle > 0, (middle + 0.5) / STEPS, 0.0)
        chars[k] = share / max(share.sum(), 1e-9)
        for j, word in enumerate(r["top"]):
            words[k, j], shares[k, j] = word["key"], -word["less"] / r["total"]
        shares[k, -1] = max(0.0, 1 - shares[k, :-1].sum())
    return References([r["lang"] for r in rows], chars, words, shares)


class Known(NamedTuple):
    """References of all languages, or None where they stay a table, and those that texts of no named language are held against."""

    named: References | None
    common: References
    table: DataFrame | None


def known_references(docs: DataFrame, most: int = MOST_LANGUAGES) -> Known:
    """The languages' references; they reach the driver only if they are ``most`` rows or fewer."""
    table = reference_rows(docs)
    plain = lambda rows: references_of([r.asDict(recursive=True) for r in rows])
    common = plain(table.orderBy(F.desc("total"), "lang").limit(UNNAMED).collect())
    n = table.count()
    if n <= UNNAMED and n <= most:
        return Known(common, common, None)
    if n <= most:
        return Known(plain(table.collect()), common, None)
    return Known(None, common, table)


def references(docs: DataFrame) -> References:
    """The references of all languages, which must be ``MOST_LANGUAGES`` or fewer."""
    found = known_references(docs).named
    if found is None:
        raise ValueError(f"more than {MOST_LANGUAGES} languages; use known_references")
    return found


def distances(part: scan.Slice, langs: list[str | None], refs: References) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per row: distance of characters and of words (NaN: no verdict), and the two lengths."""
    counts = class_counts(part).astype(float)
    n_chars = counts.sum(1)
    w, _, _ = scan.words(part, lower=True, sep=scan.PUNCT)
    n_words = np.diff(w.first)
    rows = len(n_chars)
    if not refs.languages:
        return np.full(rows, np.nan), np.full(rows, np.nan), n_chars, n_words
    own = {x: k for k, x in enumerate(refs.languages)}
    lang = np.array([own.get(x, -1) for x in langs])
    unnamed = np.array([x is None for x in langs], bool)
    by_char, by_word = np.full(rows, np.inf), np.full(rows, np.inf)
    for k in range(len(refs.languages)) if unnamed.any() else np.unique(lang[lang >= 0]):
        rows_k = np.flatnonzero((lang == k) | unnamed)
        if not len(rows_k):
            continue
        p = counts[rows_k] / np.maximum(1, n_chars[rows_k])[:, None]
        by_char[rows_k] = np.minimum(by_char[rows_k], distance(p, refs.chars[k][None]))
        held = np.flatnonzero(refs.words[k])
        held = held[np.argsort(refs.words[k][held])]
        place = np.full(rows, -1)
        place[rows_k] = np.arange(len(rows_k))
        near = np.flatnonzero(place[w.doc] >= 0)
        hashes, vocabulary = w.hash[near].view(np.int64), refs.words[k][held]
        at = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(held) - 1))
        hit = vocabulary[at] == hashes if len(held) else np.zeros(len(at), bool)
        part_words = np.bincount(place[w.doc[near[hit]]] * len(held) + at[hit], minlength=len(rows_k) * len(held)).reshape(len(rows_k), -1) if len(held) else np.zeros((len(rows_k), 0))
        size = np.maximum(1, n_words[rows_k])[:, None]
        p = np.zeros((len(rows_k), TOP_WORDS + 1))
        p[:, :-1][:, held] = part_words / size
        p[:, -1] = np.maximum(0, 1 - p[:, :-1].sum(1))
        by_word[rows_k] = np.minimum(by_word[rows_k], distance(p, refs.shares[k][None]))
    none = (lang < 0) & ~unnamed
    by_char[none | (n_chars < MIN_CHARS)] = np.nan
    by_word[none | (n_words < MIN_WORDS)] = np.nan
    return by_char, by_word, n_chars, n_words


def held_against(part: scan.Slice, langs: list[str | None], rows: list[dict | None] | None, known: References | None, common: References) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distances of the rows of named languages to their own references, of the others to the nearest common one."""
    if known is common:
        return distances(part, langs, common)
    if known is None:  # each row brings its language's reference
        known = references_of(list({r["lang"]: r for r in rows if r is not None and r["total"] is not None}.values()))
    other = object()  # no language
    out = distances(part, [other if x is None else x for x in langs], known)
    if any(x is None for x in langs):
        char, word, *_ = distances(part, [None if x is None else other for x in langs], common)
        unnamed = np.array([x is None for x in langs])
        out = (np.where(unnamed, char, out[0]), np.where(unnamed, word, out[1]), *out[2:])
    return out


def diverges(char: np.ndarray, word: np.ndarray, n_chars: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Whether a distance is over its limit, which widens for short texts; NaN never is."""
    with np.errstate(invalid="ignore"):
        return (char > CHAR_LIMIT + CHAR_SLACK / np.sqrt(np.maximum(1, n_chars))) | (word > WORD_LIMIT + WORD_SLACK / np.sqrt(np.maximum(1, n_words)))


def _with_references(docs: DataFrame, known: Known) -> tuple[DataFrame, str]:
    """``docs`` and the name of the column that brings references where they are too many for the driver."""
    name = free_name(docs, "_reference")
    if known.table is None or "lang" not in docs.columns:
        return docs, name
    table = known.table.select(F.struct("lang", "total", "docs", "middle", "top").alias(name))
    return docs.join(table, docs["lang"].cast("string") == F.col(f"{name}.lang"), "left"), name


def _judge(batch: pa.RecordBatch, part: scan.Slice, names: list[str], reference: str, known: References | None, common: References) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Base counts, the base verdict, the verdict, and both distances of a slice."""
    rows = slice(part.lo, part.hi)
    langs = batch.column(names.index("lang"))[rows].cast(pa.string()).to_pylist() if "lang" in names else [None] * (part.hi - part.lo)
    own = batch.column(names.index(reference))[rows].to_pylist() if reference in names else [None] * len(langs)
    base = base_counts(part)
    char, word, n_chars, n = held_against(part, langs, own, known, common)
    failed = (base["n_words"] < MIN_BASE_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])
    return base, failed, ~failed & ~diverges(char, word, n_chars, n), char, word


def judged(docs: DataFrame, known: Known | None = None) -> DataFrame:
    """One row a document: base counts, distances and verdict."""
    known = known or known_references(docs)
    rows, reference = _with_references(pick(docs, doc_id="bigint", lang="string", text="string"), known)
    names, named, common = rows.columns, known.named, known.common
    if named is common:
        named = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = common if named is None and reference not in names else named
        for batch in batches:
            for part in scan.slices(batch.column(2)):
                base, failed, kept, char, word = _judge(batch, part, names, reference, own, common)
                columns = [pa.array(base[k].astype(np.int64)) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part.lo : part.hi], *columns, pa.array(failed), pa.array(kept), pa.array(char, from_pandas=True), pa.array(word, from_pandas=True)],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance"],
                )

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, char_distance double, word_distance double"
    return rows.mapInArrow(run, schema)


def kept_rows(docs: DataFrame, known: Known | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    known = known or known_references(docs)
    rows, reference = _with_references(docs, known)
    names, named, common, width = rows.columns, known.named, known.common, len(docs.columns)
    if named is common:
        named = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = common if named is None and reference not in names else named
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for part in scan.slices(batch.column(names.index("text"))):
                keep[part.lo : part.hi] = _judge(batch, part, names, reference, own, common)[2]
            yield pa.RecordBatch.from_arrays(batch.columns[:width], names[:width]).filter(pa.array(keep))

    return rows.mapInArrow(run, docs.schema)


def op1_distribution_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over the whole of ``documents``."""
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
