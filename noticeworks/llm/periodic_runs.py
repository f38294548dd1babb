"""Periodic run detection by recursive frequency splitting.

A run is a stretch of words with smallest period q (words q apart are identical) and a length of at least
max(LEAST, POWER * q) that no neighbouring word extends. Each of its words occurs at least POWER times in it, so:

1. words that occur less often within their segment (first the whole text) can't be in a run; they split it, and
   the pieces are counted and split anew until nothing changes. All texts of a batch are split together, and a segment is
   counted again only if it was cut. Of prose next to nothing is left;
2. surviving segments are scanned lag by lag. A run with period q spans POWER multiples of q in a row, which hold the same
   word, so lag q looks at one word in q, and a segment of n words costs about n log n. Where an earlier run with a smaller
   period covers such a row no other run can (two periods of one stretch have their divisor as a period), so it is skipped; what
   remains is compared word by word and extended to both sides.

Rows are worked on where Spark has read them; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.bpe import spans
from noticeworks.llm.shared import bundled, others, unbundled, words

LEAST, POWER = 6, 4
RUNS = "array<struct<start: long, length: long, period: long>>"


def survivors(words: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches that are left when no word is too rare in its segment any more. words: the words, as
    numbers, of texts of these lengths, one after another."""
    at, segment, size = np.arange(len(words)), np.repeat(np.arange(len(lengths)), lengths), int(words.max(initial=0)) + 1
    out: list[tuple[int, int]] = []
    while len(at):
        # how often each word occurs in its segment
        _, which, count = np.unique(segment * size + words[at], return_inverse=True, return_counts=True)
        often = count[which] >= POWER
        first = np.flatnonzero(np.diff(segment, prepend=-1))
        whole = np.logical_and.reduceat(often, first)
        ends = np.append(first[1:], len(at)) - 1
        out += zip(at[first[whole]].tolist(), (at[ends[whole]] + 1).tolist(), strict=True)
        # what is left of the cut segments; a cut or another segment in between starts a new one
        left = often & ~np.repeat(whole, ends + 1 - first)
        at, old = at[left], segment[left]
        segment = np.cumsum((np.diff(at, prepend=-2) != 1) | (np.diff(old, prepend=-1) != 0))
        long_enough = np.bincount(segment)[segment] >= LEAST if len(at) else left[:0]
        at, segment = at[long_enough], segment[long_enough]
    return sorted(x for x in out if x[1] - x[0] >= LEAST)


def _same(w: np.ndarray, start: int, stop: int, lag: int) -> bool:
    return bool((w[start:stop] == w[start + lag : stop + lag]).all())


def _matching(w: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from `at` on, in steps of 1 or -1, equal the word `lag` after them."""
    n, size = 0, 16
    while True:
        size = min(size, len(w) - lag - at - n if step > 0 else at + 1 - n)
        if size <= 0:
            return n
        here = slice(at + n, at + n + size) if step > 0 else slice(at - n - size + 1, at - n + 1)
        unlike = np.flatnonzero(w[here] != w[here.start + lag : here.stop + lag])
        if len(unlike):
            return n + int(unlike[0] if step > 0 else size - 1 - unlike[-1])
        n, size = n + size, size * 4


def lag_scan(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words w."""
    found: list[tuple[int, int, int]] = []
    n, starts, reach = len(w), np.empty(0, np.int64), np.empty(0, np.int64)  # runs so far by start, and the furthest end up to each
    for q in range(1, n // POWER + 1):
        row = w[::q]
        same = row[1:] == row[:-1]
        # POWER multiples of q in a row with the same word
        hits = np.flatnonzero(np.logical_and.reduce([same[k : len(same) - POWER + 2 + k] for k in range(POWER - 1)])) * q
        if not len(hits):
            continue
        if len(starts):
            before = np.searchsorted(starts, hits, "right") - 1
            hits = hits[(before < 0) | (reach[np.maximum(before, 0)] <= hits + (POWER - 1) * q)]
        end = -1
        for at in hits.tolist():
            last = at + (POWER - 1) * q
            if last < end or not _same(w, at, last - q + 1, q):
                continue
            back = _matching(w, at - 1, q, -1) if at else 0
            ahead = _matching(w, last - q + 1, q, 1)
            start, end = at - back, last + 1 + ahead
            if end - start >= max(LEAST, POWER * q):
                found.append((start, end - start, q))
        if found and len(starts) < len(found):
            order = np.array(sorted((s, s + length) for s, length, _ in found))
            starts, reach = order[:, 0], np.maximum.accumulate(order[:, 1])
    return found


def batch_runs(texts: list[str | None]) -> list[tuple[list[tuple[int, int, int]], str]]:
    """For each text its runs by start and period, and the words that no run repeats, joined by one space."""
    split = [(t or "").encode().split() for t in texts]  # of bytes: the white space of ASCII
    number: dict[bytes, int] = {}
    lengths = np.array([len(x) for x in split])
    w = np.fromiter((number.setdefault(x, len(number)) for words in split for x in words), np.int64, int(lengths.sum()))
    ends = np.cumsum(lengths)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in split]
    for a, b in survivors(w, lengths):
        k = int(np.searchsorted(ends, a, "right"))
        base = a - int(ends[k] - lengths[k])
        runs[k] += [(base + s, length, q) for s, length, q in lag_scan(w[a:b])]
    return [(sorted(r, key=lambda x: (x[0], x[2])), b" ".join(_kept(x, r)).decode()) for x, r in zip(split, runs, strict=True)]


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    if not runs:
        return words
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(stays)]


def periodic_runs(df: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed") -> DataFrame:
    """All columns of df but text_col, with the text's runs (array of start, length, period; by start, then period; words are
    counted from 0) and the collapsed text: the words that no run holds after its first `period` words, joined by one space.

    Null and empty texts and such without words have no runs and an empty collapsed text. Columns named as runs_col or
    collapsed_col (in any case) are replaced; others stay, whatever their names. Each row is judged by itself, so repeated rows
    get equal results; an empty table gives no rows. Texts of any length are whole in one task.
    """
    keep = others(df, text_col, runs_col, collapsed_col)
    packed = df.select(bundled(df, keep), F.col(text_col).alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in (x for b in it for x in spans(b, "text")):
            found = batch_runs(texts)
            runs = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x, _ in found], kind)
            yield pa.RecordBatch.from_arrays([part.column(0), runs, pa.array([c for _, c in found], pa.string())], names=["row", "runs", "collapsed"])

    out = packed.mapInArrow(run, packed.select("row").withColumns({"runs": F.lit(None).cast(RUNS), "collapsed": F.lit(None).cast("string")}).schema)
    return out.select(*unbundled(keep), F.col("runs").alias(runs_col), F.col("collapsed").alias(collapsed_col))


def planted(doc_id: Column, text: Column) -> Column:
    """The text of the contract: where crc32(doc_id) ends in 0, the words from a on repeat their first p words."""

    def repeat(w: Column) -> Column:
        n = F.size(w)
        h = F.crc32(doc_id.cast("string").cast("binary"))
        g = F.floor(h / 10)
        a = F.pmod(g, F.greatest(n, F.lit(1)))
        p = F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))) + 1
        moved = F.transform(w, lambda x, i: F.when(i >= a, F.get(w, (a + F.pmod(i - a, p)).cast("int"))).otherwise(x))
        return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), F.array_join(moved, " "))

    return F.coalesce(F.get(F.transform(F.array(words(text)), repeat), F.lit(0)), text)


def op13_periodic_runs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = periodic_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    # the longest run, then the smallest start and period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws("", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    out = found.withColumn("best", best)
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
