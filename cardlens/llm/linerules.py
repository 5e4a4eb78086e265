"""Line-first quality rules (operator 7).

Every line of a text is judged on its own; lines that fail are removed, and a
document that loses too much of its words is rejected.  Line rules:

* ``caps``: three words or more, no lower-case letter, and more upper-case
  letters than letters without case (shouting);
* ``symbols``: more than 0.2 symbols ``#*$%&|<>`` or exclamation marks a word;
* ``navigation``: two separators ``| » › · •`` or more with at most five words
  between two of them on average;
* ``punctuation``: the line doesn't end in a sentence mark (of Latin, Arabic,
  Indic, Chinese, Japanese, Armenian or Ethiopic script);
* ``boilerplate``: cookie, copyright, licence, script and login phrases;
* ``repeat``: equal to an earlier line of the text;
* ``stutter``: more than half of the words of a line of ten words or more
  equal the word before.

Words are runs of bytes other than 0x20 and 0x09-0x0D.  A null text has no
words; it and an empty text fail the base rules and clean to ''.  Repeated
rows are judged one by one; very long texts are judged whole; an empty table
gives no rows; only doc_id and text are read, whatever other columns are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, ragged, split_words

SYMBOLS = r"[#*$%&|<>]"
SENTENCE_END = r"""[.!?…:;؟؛۔।॥。！？：；｡։።]["'”’»)\]」』）】》]*[\x20\x09-\x0D]*$"""
SEPARATORS = r"[|»›·•]"
BOILERPLATE = (r"(?i)\b(cookies? (policy|settings|preferences)|accept (all )?cookies|all rights reserved|terms of (use|service)"
               r"|privacy policy|enable javascript|lorem ipsum|copyright (©|\(c\)|\d{4})|spdx-license-identifier"
               r"|licensed under|permission is hereby granted|log ?in to|sign up (for|to)|subscribe to our|read more)\b")

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_lines long, n_removed_lines long, kept_words long")


def row_sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.concatenate(([0], np.cumsum(values)))
    return np.diff(ends[np.concatenate(([0], np.cumsum(counts)))]).astype(np.int64)


def numpy(a: pa.Array) -> np.ndarray:
    return pc.fill_null(a, 0 if not pa.types.is_boolean(a.type) else False).to_numpy(zero_copy_only=False)


def repeated(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found elsewhere in the same row, found earlier in it) for each value."""
    rows = np.repeat(np.arange(len(counts)), counts)
    order = np.argsort(values, kind="stable")  # rows ascend among equal values
    same = (values[order][1:] == values[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    twice, again = np.zeros(len(values), bool), np.zeros(len(values), bool)
    again[order[1:]] = same
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, again


def repeat_words(number: np.ndarray, counts: np.ndarray, distinct: int) -> np.ndarray:
    """Words of each text that lie in a 3-word window found twice in it."""
    windows = np.maximum(counts - 2, 0)
    at = ragged(np.cumsum(counts) - counts, windows)
    n = number.astype(np.int64)
    key = (n[at] * distinct + n[at + 1]) * distinct + n[at + 2]
    hit = at[repeated(key, windows)[0]]
    covered = np.zeros(len(number), bool)
    for k in range(3):
        covered[hit + k] = True
    return row_sum(covered, counts)


def judge(column: pa.Array) -> tuple[dict, pa.Array, np.ndarray, np.ndarray]:
    """Base counts of each text; lines of all texts, lines per text, kept flags."""
    column = column.cast(pa.string())
    counts, number, distinct = split_words(column)
    chars = np.fromiter((len(w.decode("utf-8")) for w in distinct), np.int64, len(distinct))
    lists = pc.split_pattern(column, "\n")
    per_text = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lines = lists.flatten()
    line_words, line_number, line_distinct = split_words(lines)
    coded = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    earlier = repeated(coded, per_text)[1] & (line_words > 0)

    find, count = pc.match_substring_regex, pc.count_substring_regex
    ends = numpy(find(lines, SENTENCE_END))
    marks = numpy(count(lines, r"[#*$%&|<>!]"))
    bars = numpy(count(lines, SEPARATORS))
    lower = numpy(find(lines, r"\p{Ll}"))
    shouting = (line_words >= 3) & ~lower
    rest = lines.filter(pa.array(shouting))
    shouting[shouting] = numpy(count(rest, r"[\p{Lu}\p{Lt}]")) > numpy(count(rest, r"\p{Lo}"))
    stutter = np.zeros(len(line_number), bool)
    stutter[1:] = line_number[1:] == line_number[:-1]
    first = (np.cumsum(line_words) - line_words)[line_words > 0]
    stutter[first] = False
    bad = earlier | numpy(find(lines, BOILERPLATE))
    bad |= shouting
    bad |= marks > 0.2 * line_words
    bad |= (bars >= 2) & (line_words - bars <= 5 * (bars + 1))
    bad |= (line_words > 0) & ~ends
    bad |= (line_words >= 10) & (2 * row_sum(stutter, line_words) > line_words)
    keep = ~bad | (line_words == 0)
    base = {"n_words": counts, "word_chars": row_sum(chars[number], counts) if len(number) else counts,
            "n_symbols": numpy(count(column, SYMBOLS)).astype(np.int64), "n_dup_lines": row_sum(earlier, per_text),
            "n_repeat_words": repeat_words(number, counts, max(1, len(distinct))), "n_lines": per_text,
            "n_removed_lines": row_sum(~keep, per_text), "kept_words": row_sum(np.where(keep, line_words, 0), per_text)}
    return base, lines, per_text, keep


def assess(docs: DataFrame, min_kept: float = 0.6, min_words: int = 50, max_repeat: int = 50,
           text: str = "text") -> DataFrame:
    """Counts and verdict of each document: ``base_failed`` (fewer than
    ``min_words`` words, or more than ``max_repeat`` % of them in repeated
    windows) and ``kept`` (it passes the base rules, and the lines that pass
    hold at least ``min_kept`` of its words)."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), **judge(batch.column(text))[0]}

    counts = arrow_map(docs.select(F.col("doc_id").cast("long"), text), run, SCHEMA, text)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    return (counts.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("kept_words") >= F.col("n_words") * F.lit(min_kept))))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text): the lines that pass, in order."""

    def run(batch: pa.RecordBatch) -> dict:
        _, lines, per_text, keep = judge(batch.column(text))
        parts = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(row_sum(keep, per_text)))), pa.int32()),
            lines.filter(pa.array(keep)))
        return {"doc_id": batch.column("doc_id"), "text": pc.binary_join(parts, "\n")}

    return arrow_map(docs.select(F.col("doc_id").cast("long"), text), run, "doc_id long, text string", text)
