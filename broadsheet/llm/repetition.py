"""Quality rules by repetition: how much of a text lies inside repeated n-grams and lines."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import hashed, rolling, small_batches, words_of

SYMBOLS = re.compile(r"[#*$%&|<>]")
# Fixed values, published rules: share of characters of words that may lie in repeats of
# an n-gram, by its length, and in repeats of a line.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20
MIN_WORDS = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = pa.schema(
    [("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS)]
    + [("line_share", pa.float64()), ("ngram_shares", pa.list_(pa.float64()))]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
)
SPARK_SCHEMA = (
    "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    + ", line_share double, ngram_shares array<double>, base_failed boolean, kept boolean"
)


def _covered(starts: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Which words lie in one of the windows that begin at `starts`."""
    edge = np.zeros(n_words + 1, np.int64)
    edge[starts] += 1
    edge[starts + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def _repeated(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Starts of windows found at least twice, and of those found earlier already; None
    if there is none."""
    by_value = np.sort(windows)
    if not (by_value[1:] == by_value[:-1]).any():
        return None
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    later = order[1:][same]
    return np.union1d(later, order[:-1][same]), later


def measure(text: str | None, ngram_limits=NGRAM_LIMITS, line_limit=LINE_LIMIT) -> tuple:
    """The figures of one text, in the order of SCHEMA after doc_id."""
    text = text or ""
    words = words_of(text)
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    chars = int(lengths.sum())

    seen, dup_lines, dup_chars = set(), 0, 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                own = words_of(line)
                if own:
                    dup_lines += 1
                    dup_chars += sum(map(len, own))
            else:
                seen.add(line)
    line_share = dup_chars / chars if chars else 0.0

    h = hashed(words)
    found = _repeated(rolling(h, 3))
    repeat_words = int(_covered(found[0], 3, n).sum()) if found else 0
    shares = []
    for k in ngram_limits:
        # Where no window repeats, no longer one does.
        found = _repeated(rolling(h, k)) if found else None
        shares.append(float(lengths[_covered(found[1], k, n)].sum() / chars) if found else 0.0)

    failed = n < MIN_WORDS or 100 * repeat_words > 50 * n
    over = line_share > line_limit or any(s > m for s, m in zip(shares, ngram_limits.values()))
    return (
        n, chars, len(SYMBOLS.findall(text)), dup_lines, repeat_words, line_share, shares,
        failed, not failed and not over,
    )


def _measured(batches, ngram_limits, line_limit):
    for batch in batches:
        rows = [
            (i, *measure(t, ngram_limits, line_limit))
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        ]
        if rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA)]
            yield pa.RecordBatch.from_arrays(columns, schema=SCHEMA)


def repetition_rules(
    docs: DataFrame, ngram_limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT
) -> DataFrame:
    """One row for each row of `docs` (doc_id, text; other columns are not read).

    `kept` is false for texts of under 50 words, for texts with over half of their words
    in repeated windows of three, and where the characters of repeats exceed a limit: of
    n-grams seen earlier in the text, for each length, or of lines seen earlier. A null
    or empty text has no words: all counts are 0 and it is not kept. Lines without a
    word do not count as repeats. Each row is judged alone, so ties, repeated rows and
    null ids change nothing; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    limits = dict(ngram_limits)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(lambda batches: _measured(batches, limits, line_limit), SPARK_SCHEMA)
