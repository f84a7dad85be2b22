"""Quality rules: repetition coverage by rolling n-gram hashes.

For every document the words (maximal runs without ASCII white space) are
hashed to 64 bits and the hashes of all windows of ``n`` words are rolled
forward in numpy: ``H[n+1][i] = H[n][i] * BASE + h[i + n]``.  Equal window
hashes are duplicated n-grams; the characters inside them (union of the
windows, first occurrence included) divided by the characters in words is the
coverage of that length.  Duplicated lines are measured the same way.  Only
windows whose two halves of length ``n`` are already duplicated can be
duplicated at ``n + 1``, so a text without repetition costs one sort.

Everything is per document, so the operator is one narrow Arrow pass: no
shuffle, no state between rows, memory bound by one batch.

Defined results: a null text counts as no text (0 words, fails the base rule);
an empty text likewise; texts shorter than ``n`` words have no window of that
length; repeated rows are judged one by one and stay repeated; columns of the
input are carried unchanged by :func:`filter_repetitive` and the measured
columns never clash because they are only added by :func:`measure`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices

# Fixed values of the contract.
WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
BASE_WINDOW = 8
BASE_MIN_WORDS = 20
BASE_MAX_REPEAT_PERCENT = 30

_ROLL = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash


@dataclass(frozen=True)
class RepetitionRules:
    """Upper bounds, in percent of the characters in words, above which a text is rejected.

    ``ngram_percent`` maps the n-gram length to the bound on characters inside
    duplicated n-grams; ``line_percent`` bounds the characters of lines equal to
    an earlier line, ``line_count_percent`` their share of all lines with a word.
    """

    ngram_percent: dict[int, int] = field(
        default_factory=lambda: {5: 40, 6: 38, 7: 36, 8: 34, 9: 32, 10: 30}
    )
    line_percent: int = 30
    line_count_percent: int = 40


def _window_hashes(words: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Hashes of all windows, length after length (each rolled from the one before)."""
    rolled = words
    for n in range(1, max(lengths) + 1):
        if n > 1:
            if len(rolled) < 2:
                return
            rolled = rolled[:-1] * _ROLL + words[n - 1 :]
        yield n, rolled


def _duplicated_windows(words: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """Start positions of the windows that occur at least twice, per length."""
    out = {n: np.empty(0, np.int64) for n in lengths}
    starts = None  # duplicated starts at the previous length that was looked at; None: not yet
    previous = 0
    for n, rolled in _window_hashes(words, lengths):
        if n not in out:
            continue
        if starts is None:
            at, values = None, rolled
        else:  # a duplicated window of n words holds n - previous + 1 duplicated windows of the previous length
            mark = np.zeros(len(words) + 1, bool)
            mark[starts] = True
            both = mark[: len(rolled)].copy()
            for shift in range(1, n - previous + 1):
                both &= mark[shift : shift + len(rolled)]
            at = np.flatnonzero(both)
            values = rolled[at]
        ordered = np.sort(values)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            break
        hit = np.flatnonzero(np.isin(values, twice))
        starts = hit if at is None else at[hit]
        previous = n
        out[n] = starts
    return out


def _covered(starts: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Mask of the words inside at least one of the windows."""
    edge = np.zeros(n_words + 1, np.int64)
    edge[starts] += 1
    edge[starts + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def _line_stats(data: bytes) -> tuple[int, int, int]:
    """Lines with a word; those equal to an earlier one; code points in the words of the latter."""
    if b"\n" not in data:
        return (1 if data.strip(WHITE) else 0), 0, 0
    lines = [x for x in data.split(b"\n") if x.strip(WHITE)]
    if len(set(lines)) == len(lines):
        return len(lines), 0, 0
    seen: set[bytes] = set()
    again = chars = 0
    for x in lines:
        if x in seen:
            again += 1
            chars += len(x.translate(None, WHITE).decode("utf-8"))
        else:
            seen.add(x)
    return len(lines), again, chars


def measure_text(data: bytes, rules: RepetitionRules) -> tuple:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, worst_percent)``."""
    words = data.split()
    n_words = len(words)
    bare = data.translate(None, WHITE)
    word_chars = len(bare) if bare.isascii() else len(bare.decode("utf-8"))
    n_symbols = len(bare) - len(bare.translate(None, SYMBOLS))
    n_lines, dup_lines, dup_line_chars = _line_stats(data)
    lengths = sorted({*rules.ngram_percent, BASE_WINDOW})
    found: dict[int, np.ndarray] = {}
    if n_words > lengths[0]:
        hashed = np.fromiter(map(hash, words), np.int64, n_words).view(np.uint64)
        found = _duplicated_windows(hashed, lengths)
    repeat = 0
    covered_chars = dict.fromkeys(rules.ngram_percent, 0)
    sizes = None
    for n, starts in found.items():
        if not len(starts):
            continue
        mask = _covered(starts, n, n_words)
        if n == BASE_WINDOW:
            repeat = int(mask.sum())
        if n in covered_chars:
            if sizes is None:
                sizes = np.fromiter((len(w) if w.isascii() else len(w.decode("utf-8")) for w in words), np.int64, n_words)
            covered_chars[n] = int(sizes[mask].sum())
    failed = n_words < BASE_MIN_WORDS or 100 * repeat > BASE_MAX_REPEAT_PERCENT * n_words
    too_much = (
        any(100 * covered_chars[n] > most * word_chars for n, most in rules.ngram_percent.items())
        or 100 * dup_line_chars > rules.line_percent * word_chars
        or 100 * dup_lines > rules.line_count_percent * n_lines
    )
    worst = max(covered_chars.values(), default=0)
    return n_words, word_chars, n_symbols, dup_lines, repeat, failed, not failed and not too_much, dup_line_chars, worst


#: Columns that :func:`measure` returns after the key.
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_chars long, dup_ngram_chars long"
)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: RepetitionRules | None = None) -> DataFrame:
    """One row per input row: the id, the base counts, the coverages and the verdict ``kept``.

    ``dup_ngram_chars`` is the largest count of characters inside duplicated
    n-grams over the rule's lengths, ``dup_line_chars`` the characters in words
    of lines equal to an earlier line.
    """
    rules = rules or RepetitionRules()
    slim = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    kind = slim.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [measure_text(v or b"", rules) for v in batch.column(1).to_pylist()]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 9
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2
            arrays = [batch.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]]
            names = ["_id", *[m.split()[0] for m in MEASURES.split(", ")]]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return slim.mapInArrow(run, f"_id {kind}, {MEASURES}").withColumnRenamed("_id", id_col)


def filter_repetitive(docs: DataFrame, text_col: str = "text", rules: RepetitionRules | None = None) -> DataFrame:
    """The rows of ``docs`` that pass the base rule and the repetition rules, columns unchanged."""
    rules = rules or RepetitionRules()
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            keep = pa.array([measure_text(v or b"", rules)[6] for v in texts], pa.bool_())
            yield batch.filter(keep)

    return docs.mapInArrow(run, docs.schema)
