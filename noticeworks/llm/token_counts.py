"""Token counts with a whole-token shortcut.

Offline, the merges are run over every vocabulary string; those that come out as one token are proven
whole. While counting, a pre-token that is a proven string counts as one without any merge; only the
rest is merged (the new pre-tokens of some megabytes of text in one rank queue), and remembered by each
task up to a bound. Texts are counted where Spark has
read them; nothing is shuffled. The vocabulary and the proven strings are broadcast; their size is
that of the vocabulary file, checked in read_vocabulary().
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.bpe import CACHE, CACHED_LENGTH, Merger, Pairs, chunks, read_vocabulary, spans
from noticeworks.llm.shared import bundled, others, unbundled

#: Fixed value: the pattern of the byte-level pre-tokenizer.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters
    stand for themselves, the other bytes in ascending order for the characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The merges of a byte-level BPE file of the tokenizers library."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without a prefix space or normalizer is counted")
        table, vocab = byte_of_char(), model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[m[k]] for m in pairs], np.int64) for k in (0, 1))
        self.pairs = Pairs(left, right, np.arange(len(pairs)), max(vocab.values()) + 1)
        self.made = [vocab[a + b] for a, b in pairs]
        char_of = {b: c for c, b in table.items()}
        self.byte_ids = [vocab[char_of[b]] for b in range(256)]
        self.specials = sorted((x["content"] for x in spec["added_tokens"]), key=len, reverse=True)
        special = set(self.specials)
        self.vocabulary = [bytes(map(table.__getitem__, s)) for s in vocab if s not in special]

    def merger(self) -> Merger:
        return Merger(self.byte_ids, self.pairs, self.made)

    def whole(self) -> list[str]:
        """The vocabulary strings that are text and that the merges encode as one token."""
        merger, found = self.merger(), []
        for run in chunks([("", piece) for piece in self.vocabulary]):
            pieces = [piece for _, piece in run]
            counts = np.diff(merger.merge(pieces)[1], prepend=0)
            for piece in itertools.compress(pieces, (counts == 1).tolist()):
                try:
                    found.append(piece.decode())
                except UnicodeDecodeError:
                    continue  # part of a character
        return found


class Counter:
    """Counts the tokens of texts; remembers the counts of up to CACHE pre-tokens that aren't whole."""

    def __init__(self, merger: Merger, specials: list[str], whole: list[str]):
        self.merger, self.whole, self.split = merger, whole, regex.compile(BYTE_LEVEL).findall
        self.cut = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.known: dict[str, int] = dict.fromkeys(whole, 1)

    def learn(self, tokens: set[str]) -> dict[str, int]:
        """The counts of those of the tokens that aren't known."""
        if len(self.known) >= CACHE + len(self.whole):
            self.known = dict.fromkeys(self.whole, 1)
        new: dict[str, int] = {}
        for run in chunks([(t, t.encode()) for t in tokens.difference(self.known)]):
            ends = self.merger.merge([piece for _, piece in run])[1]
            new.update(zip((t for t, _ in run), np.diff(ends, prepend=0).tolist(), strict=True))
        self.known.update((t, n) for t, n in new.items() if len(t) <= CACHED_LENGTH)
        return new

    def batch(self, texts: list[str | None]) -> list[int]:
        """The number of tokens of each text; the texts' new pre-tokens are merged together."""
        parts = [self.cut.split(x or "") if self.cut else [x or ""] for x in texts]
        split = [[*itertools.chain.from_iterable(map(self.split, p))] for p in parts]
        new = self.learn(set(itertools.chain.from_iterable(split)))
        known, out = self.known, []
        for p, tokens in zip(parts, split, strict=True):
            counts = list(map(known.get, tokens))
            if None in counts:
                counts = [known[t] if t in known else new[t] for t in tokens]
            out.append(len(p) - 1 + sum(counts))
        return out


def count_tokens(df: DataFrame, path: str, text_col: str = "text", count_col: str = "n_tokens") -> DataFrame:
    """df with the number of tokens of each text in count_col (a column of that name, in any case, is replaced; others stay,
    whatever their names). Null and empty texts have none. Special strings inside texts count as one token each. Repeated rows are
    counted alike; an empty table gives no rows."""
    df, own = df.select(bundled(df, keep := others(df, count_col)), F.col(text_col).alias("text")), ["row", "n"]
    merges = Merges(read_vocabulary(path))
    tables = df.sparkSession.sparkContext.broadcast((merges.byte_ids, merges.pairs, merges.made, merges.specials, merges.whole()))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *three, specials, whole = tables.value
        counter = Counter(Merger(*three), specials, whole)
        for b in it:
            for part, texts in spans(b, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counter.batch(texts), pa.int64())], names=own)

    return df.mapInArrow(batches, df.select("row", F.lit(0).cast("long").alias("n")).schema).select(*unbundled(keep), F.col("n").alias(count_col))


def op3_token_counts(spark, sf_dir, limit: int = 1024):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    slim = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    counted = count_tokens(slim, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
