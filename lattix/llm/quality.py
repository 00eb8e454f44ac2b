"""Quality rules: how much of a text lies inside repeated n-grams and lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lattix.llm.batches import SPACE, RollingHash, mapped, mixed, pieces, text_bytes, window_hashes, word_spans

#: Most of a text's word characters that repeated windows of so many words may hold, in hundredths.
COVERED = {5: 30, 7: 28, 10: 25}
#: Most of a text's characters in lines that repeat an earlier line, in hundredths; and of its lines.
DUP_LINE_CHARS, DUP_LINES = 30, 50
#: Most symbols to words, in hundredths.
SYMBOLS = 100
MIN_WORDS, REPEATED_WORDS, BASE_WINDOW = 10, 20, 5

_SYMBOL = np.zeros(256, np.bool_)
_SYMBOL[list(b"#*$%&|<>")] = True


def _again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key: whether it occurs twice or more, and whether it occurred earlier."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, np.bool_)
    same[1:-1] = ranked[1:] == ranked[:-1]
    twice, later = np.zeros(len(keys), np.bool_), np.zeros(len(keys), np.bool_)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts per text; chars_n: code points of words inside windows of n words that the text holds twice or more."""
    data, offsets = text_bytes(texts)
    n = len(texts)
    per_row = lambda rows, weights=None: np.bincount(rows, weights, n).astype(np.int64)
    points = np.zeros(len(data) + 1, np.int64)  # code points before each byte
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    hashed = RollingHash(data)
    starts, ends, rows = word_spans(data, offsets, SPACE)
    chars = points[ends] - points[starts]
    marks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_SYMBOL[data], out=marks[1:])
    out = {"n_words": per_row(rows), "word_chars": per_row(rows, chars), "n_symbols": marks[offsets[1:]] - marks[offsets[:-1]]}

    feeds = np.zeros(256, np.bool_)
    feeds[10] = True
    line_starts, line_ends, line_rows = word_spans(data, offsets, feeds)  # lines of no characters have no word
    words_before = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    full = words_before[1] > words_before[0]
    line_starts, line_ends, line_rows = line_starts[full], line_ends[full], line_rows[full]
    salt = mixed(np.arange(n, dtype=np.uint64))
    _, later = _again(hashed(line_starts, line_ends) ^ salt[line_rows])
    line_chars = points[line_ends] - points[line_starts]
    out |= {"n_lines": per_row(line_rows), "n_dup_lines": per_row(line_rows[later]), "line_chars": per_row(line_rows, line_chars), "dup_line_chars": per_row(line_rows[later], line_chars[later])}

    items = hashed(starts, ends)
    for size in sorted({BASE_WINDOW, *COVERED}):
        keys = window_hashes(items, size)
        inside = rows[: len(keys)] == rows[size - 1 :] if len(keys) else np.zeros(0, np.bool_)
        found = np.zeros(len(keys), np.bool_)
        found[inside] = _again(keys[inside] ^ salt[rows[: len(keys)][inside]])[0]
        step = np.zeros(len(items) + 1, np.int64)
        at = np.flatnonzero(found)
        np.add.at(step, at, 1)
        np.add.at(step, at + size, -1)
        covered = np.cumsum(step)[: len(items)] > 0
        out[f"words_{size}"] = per_row(rows[covered])
        out[f"chars_{size}"] = per_row(rows[covered], chars[covered])
    return out


def verdicts(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """base_failed and kept."""
    failed = (m["n_words"] < MIN_WORDS) | (100 * m[f"words_{BASE_WINDOW}"] > REPEATED_WORDS * m["n_words"])
    kept = ~failed & (100 * m["n_symbols"] <= SYMBOLS * m["n_words"])
    kept &= (100 * m["n_dup_lines"] <= DUP_LINES * m["n_lines"]) & (100 * m["dup_line_chars"] <= DUP_LINE_CHARS * m["line_chars"])
    for size, most in COVERED.items():
        kept &= 100 * m[f"chars_{size}"] <= most * m["word_chars"]
    return failed, kept


def measure_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its counts, base_failed and kept.

    Rolling hashes give every window of 5, 7 and 10 words and every line; those that a text holds more than once
    are marked and their characters counted. Works on each row alone: no shuffle, repeated rows and ids are measured
    each, null and empty texts have no words and fail, other columns are not read. A text is held whole, in pieces with its
    neighbours of at most ``PIECE`` bytes. Equality is that of 64-bit hashes within one text. An empty table gives none;
    there are no ties, as a threshold that is just met doesn't fail.
    """

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            m = measures(batch["text"])
            failed, kept = verdicts(m)
            m["n_repeat_words"] = m[f"words_{BASE_WINDOW}"]
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(m[k]) for k in names), pa.array(failed), pa.array(kept)], ["doc_id", *names, "base_failed", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return mapped(docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text"), measured, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, with all their columns as they are, whatever their names.

    Each row is judged by its own text, whatever its id, repeated or none; null and empty texts go; an empty table gives none.
    """

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col):
            yield batch.filter(pa.array(verdicts(measures(batch[text_col]))[1]))

    return mapped(docs, kept, docs.schema)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts),
grouped AS (SELECT doc_id, line, count(*) AS c FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
line_sums AS (SELECT doc_id, sum(c) AS n_lines, sum(c - 1) AS n_dup_lines, sum(c * length(line)) AS line_chars, sum((c - 1) * length(line)) AS dup_line_chars FROM grouped GROUP BY doc_id),
tokens AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
windows AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM tokens, (VALUES (5), (7), (10)) t(n) WHERE i + n - 1 <= len(w)),
repeated AS (SELECT doc_id, n, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, n, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS i FROM repeated),
sums AS (
  SELECT c.doc_id, count(*) FILTER (c.n = 5) AS words_5, sum(length(t.w[t.i])) FILTER (c.n = 5) AS chars_5,
    sum(length(t.w[t.i])) FILTER (c.n = 7) AS chars_7, sum(length(t.w[t.i])) FILTER (c.n = 10) AS chars_10
  FROM covered c JOIN tokens t USING (doc_id, i) GROUP BY c.doc_id),
all_in AS (
  SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(w.text) - length(regexp_replace(w.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(l.line_chars, 0) AS line_chars, coalesce(l.dup_line_chars, 0) AS dup_line_chars,
    coalesce(s.words_5, 0)::BIGINT AS n_repeat_words, coalesce(s.chars_5, 0) AS chars_5, coalesce(s.chars_7, 0) AS chars_7, coalesce(s.chars_10, 0) AS chars_10
  FROM words w LEFT JOIN line_sums l USING (doc_id) LEFT JOIN sums s USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * n_symbols <= 100 * n_words AND 100 * n_dup_lines <= 50 * n_lines
    AND 100 * dup_line_chars <= 30 * line_chars AND 100 * chars_5 <= 30 * word_chars AND 100 * chars_7 <= 28 * word_chars AND 100 * chars_10 <= 25 * word_chars AS kept
FROM all_in
"""
