"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The adjacent pairs of pre-tokens wait in buckets, one for each merge rank; a two-level bitmap over the
ranks finds the lowest one by find-first-set. A bucket holds positions of a linked list of parts,
taken leftmost first; an entry whose pair has changed since is skipped. A merge costs a constant
number of steps, so pre-tokens of megabytes are no slower by the byte than short ones; short ones that
a task has not met before share a queue by the thousands.

Texts are encoded where Spark has read them, batch by batch; nothing is shuffled. Each task
remembers the encodings of up to `CACHE` pre-tokens and starts afresh beyond that. The rank table is
broadcast: its size is that of the vocabulary, checked against MAX_VOCABULARY_BYTES.
"""

from __future__ import annotations

import array
import base64
import itertools
import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.shared import bundled, others, unbundled

#: Pre-tokens that a task remembers, and the longest of them in characters. Common ones come back at once after
#: a fresh start, and most of the others are met only once, so more would save little.
CACHE, CACHED_LENGTH = 200_000, 64
MAX_VOCABULARY_BYTES = 64 << 20
#: Ranks in one word of the lower bitmap; bytes of pre-tokens that share a queue, and of texts that are split together.
WIDTH, CHUNK_BYTES, SPAN_BYTES = 256, 1_000_000, 4_000_000
#: Bits of an id in a pair's key; entries from which on a bucket is merged in vectors.
SHIFT, LARGE = 24, 24


class Pairs:
    """The pairs of token ids that merge, sorted by (left, right) and by (right, left); what one token may merge with is a slice of either."""

    def __init__(self, left: np.ndarray, right: np.ndarray, ranks: np.ndarray, size: int):
        self.size, self.sides = size, []
        for mine, other in ((left, right), (right, left)):
            order = np.lexsort((other, mine))
            starts = np.searchsorted(mine[order], np.arange(size + 1))
            self.sides.append((starts, other[order].astype(np.int32), ranks[order].astype(np.int32)))

    def ranks(self, side: int, token: int, others: np.ndarray) -> np.ndarray:
        """The rank of the token (side 0: as the left part, side 1: as the right one) with each of the others; -1 where they don't merge."""
        starts, names, ranks = self.sides[side]
        lo, hi = starts[token], starts[token + 1]
        if lo == hi:
            return np.full(len(others), -1, np.int32)
        names, at = names[lo:hi], np.searchsorted(names[lo:hi], others)
        at[at == hi - lo] = 0
        return np.where(names[at] == others, ranks[lo:hi][at], -1)

    def table(self) -> dict[int, int]:
        """Rank by key: left id << SHIFT | right id."""
        starts, names, ranks = self.sides[0]
        keys = np.repeat(np.arange(self.size, dtype=np.int64), np.diff(starts)) << SHIFT | names
        return dict(zip(keys.tolist(), ranks.tolist(), strict=True))


class Merger:
    """Merges pieces of bytes to token ids. Everything in its loop is a small integer: the ids of adjacent
    parts, packed to one number, look up the rank of their merge, and a rank the id that it makes."""

    def __init__(self, byte_ids: list[int], pairs: Pairs, made: Sequence[int]):
        """byte_ids: the id of each byte; made: the id that the merge of each rank makes."""
        self.byte_ids, self.pairs, self.made = np.array(byte_ids, np.int32), pairs, made
        self.rank_of = pairs.table().get
        self.first = np.array([self.rank_of(a << SHIFT | b, -1) for a in byte_ids for b in byte_ids], np.int32)  # the ranks of pairs of bytes

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and where each piece's end.

        All pieces lie in one linked list, with a barrier between two, and share one queue: the lowest rank
        over all is also the lowest of each piece that has it. The entries of a large bucket that are their
        pieces' only ones in it don't touch each other and are merged together."""
        lengths = np.array([len(p) + 1 for p in pieces])
        barriers = np.cumsum(np.concatenate([[0], lengths]))
        data = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8)
        n = len(data)
        piece_of = np.repeat(np.arange(len(pieces) + 1, dtype=np.int32), [1, *lengths])
        # lists of machine integers, each with a view of it as a vector
        make = lambda values: array.array("i", values.astype(np.int32).tobytes())
        view = lambda values: np.frombuffer(values, np.int32)
        ids, rank_at = make(self.byte_ids[data]), make(np.append(self.first[data[:-1].astype(np.int64) << 8 | data[1:]], -1))
        after, before = make(np.arange(1, n + 1)), make(np.arange(-1, n - 1))
        v_ids, v_rank_at, v_after, v_before = map(view, (ids, rank_at, after, before))
        v_ids[barriers] = -1  # makes a key negative, which none is
        v_rank_at[barriers] = v_rank_at[barriers[1:] - 1] = -1
        # the first entries, by rank and position
        places = np.flatnonzero(v_rank_at >= 0)
        places = places[np.argsort(v_rank_at[places], kind="stable")]
        distinct, starts = np.unique(v_rank_at[places], return_index=True)
        entries = dict(zip(distinct.tolist(), np.split(places, starts[1:]), strict=True)) if len(places) else {}
        buckets: dict[int, list[int]] = {}  # rank -> positions of left parts that came up later
        low: dict[int, int] = {}  # word of the bitmap -> its bits, one for each rank that waits
        high = 0  # one bit for each word that isn't zero
        fresh: list[int] = distinct.tolist()  # ranks that wait and have no bit yet
        rank_of, made = self.rank_of, self.made

        def together(at: np.ndarray, whole: int) -> None:
            """Merges the pairs at these positions, which are in different pieces."""
            gone = v_after[at]
            end, where = v_after[gone], v_before[at]
            v_after[at], v_before[end] = end, at
            v_ids[at], v_ids[gone], v_rank_at[gone] = whole, -1, -1
            for side, place, other in ((0, at, end), (1, where, where)):
                ranks = self.pairs.ranks(side, whole, v_ids[other])
                v_rank_at[place] = ranks
                new = np.flatnonzero(ranks >= 0)
                for r, p in zip(ranks[new].tolist(), place[new].tolist(), strict=True):
                    if r in buckets:
                        buckets[r].append(p)
                    else:
                        buckets[r] = [p]
                        fresh.append(r)

        while True:
            for rank in fresh:
                word = rank // WIDTH
                low[word] = low.get(word, 0) | 1 << rank % WIDTH
                high |= 1 << word
            fresh.clear()
            if not high:
                break
            word = (high & -high).bit_length() - 1
            bits = low[word]
            rank = word * WIDTH + (bits & -bits).bit_length() - 1
            low[word] = bits = bits & (bits - 1)
            if not bits:
                high &= high - 1
            whole = made[rank]
            bucket = buckets.pop(rank, [])
            begun = entries.pop(rank, None)
            if len(bucket) + (0 if begun is None else len(begun)) >= LARGE:
                at = np.array(bucket, np.int64) if begun is None else np.concatenate([begun, np.array(bucket, np.int64)])
                at = at[v_rank_at[at] == rank]
                at.sort()
                same = np.diff(piece_of[at], prepend=-1) == 0
                same[:-1] |= same[1:]
                together(at[~same], whole)
                bucket = at[same].tolist()
            else:
                if begun is not None:
                    bucket += begun.tolist()
                bucket.sort()
            for done, at in enumerate(bucket, 1):
                if rank_at[at] != rank:
                    continue  # stale: the pair has changed
                gone = after[at]
                end = after[at] = after[gone]
                before[end] = at
                ids[at] = whole
                ids[gone] = rank_at[gone] = -1
                rank_at[at] = right = rank_of(whole << SHIFT | ids[end], -1)
                if right >= 0:
                    if right in buckets:
                        buckets[right].append(at)
                    else:
                        buckets[right] = [at]
                        fresh.append(right)
                where = before[at]
                rank_at[where] = left = rank_of(ids[where] << SHIFT | whole, -1)
                if left >= 0:
                    if left in buckets:
                        buckets[left].append(where)
                    else:
                        buckets[left] = [where]
                        fresh.append(left)
                if (-1 < right < rank or -1 < left < rank) and done < len(bucket):
                    # the lower rank comes first; what is left of this bucket waits
                    buckets[rank] = bucket[done:] + buckets.get(rank, [])
                    fresh.append(rank)
                    break
        alive = v_ids >= 0
        return v_ids[alive].astype("<u4"), np.cumsum(alive)[barriers[1:]]


@dataclass
class Tables:
    """What the tasks of an encoder need, made once: bounded by the size of the vocabulary."""

    ranks: dict[bytes, int]
    pairs: Pairs

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> Tables:
        """Every way to make a token from two others."""
        get, ways = ranks.get, []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                if (a := get(token[:i])) is not None and (b := get(token[i:])) is not None:
                    ways.append((a, b, rank))
        left, right, rank = np.array(ways, np.int64).reshape(-1, 3).T
        return cls(ranks, Pairs(left, right, rank, max(ranks.values()) + 1))

    def merger(self) -> Merger:
        # the rank of a merge is the id of the token
        return Merger([self.ranks[bytes([b])] for b in range(256)], self.pairs, range(self.pairs.size))


def chunks(pieces: list[tuple[str, bytes]], size: int = CHUNK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The pre-tokens, with their bytes, in runs of about `size` bytes."""
    run, held = [], 0
    for p in pieces:
        run.append(p)
        held += len(p[1])
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


class Encoder:
    """Encodes texts to token ids, packed as little-endian unsigned 32-bit integers; remembers the ids of up to CACHE pre-tokens."""

    def __init__(self, tables: Tables, pattern: str):
        self.ranks, self.merger, self.split = tables.ranks, tables.merger(), regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def learn(self, tokens: set[str]) -> dict[str, bytes]:
        """The packed ids of those of the tokens that aren't known."""
        if len(self.known) >= CACHE:
            self.known = {}
        new, get, rest = {}, self.ranks.get, []
        for t in tokens.difference(self.known):
            piece = t.encode()
            if (whole := get(piece)) is not None:
                new[t] = struct.pack("<I", whole)
            else:
                rest.append((t, piece))
        for run in chunks(rest):
            ids, ends = self.merger.merge([piece for _, piece in run])
            packed, start = ids.tobytes(), 0
            for (t, _), end in zip(run, (4 * ends).tolist(), strict=True):
                new[t] = packed[start:end]
                start = end
        self.known.update((t, p) for t, p in new.items() if len(t) <= CACHED_LENGTH)
        return new

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """The packed ids of each text; the texts' new pre-tokens are merged together."""
        split = [self.split(x or "") for x in texts]
        new = self.learn(set(itertools.chain.from_iterable(split)))
        known = self.known
        out: list[bytes] = []
        for tokens in split:
            packed = list(map(known.get, tokens))
            if None in packed:
                packed = [known[t] if t in known else new[t] for t in tokens]
            out.append(b"".join(packed))
        return out


class Decoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {v: k for k, v in ranks.items()}

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, unpack(ids or b"")))


def spans(batch: pa.RecordBatch, text_col: str, size: int = SPAN_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """The batch in slices of about `size` bytes of text, with their texts."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths, 1):
        held += n
        if held >= size or i == len(lengths):
            part = batch.slice(start, i - start)
            yield part, part.column(text_col).to_pylist()
            start, held = i, 0


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


def unpack(ids: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(ids) // 4}I", ids)


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return data


def _mapped(df: DataFrame, read: str, made: list[str], begin: Callable[[], Callable[[list], list[list[bytes]]]], stays: bool = False) -> DataFrame:
    """df without `read` (unless it is to stay) and with the binary columns `made`, which the function that begin() gives each task makes from the values of
    column `read`. Columns named as a made one, in any case, are replaced; others stay, whatever their names."""
    keep = others(df, *made, *([] if stays else [read]))
    packed = df.select(bundled(df, keep), F.col(read).alias("read"))
    places = [f"made{k}" for k in range(len(made))]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = begin()  # a task's own: a worker that waits for the next task holds no memory
        for b in it:
            for part, values in spans(b, "read"):
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(x, pa.binary()) for x in work(values)]], names=["row", *places])

    out = packed.mapInArrow(batches, packed.select("row", *[F.lit(b"").alias(c) for c in places]).schema)
    return out.select(*unbundled(keep), *[F.col(c).alias(name) for c, name in zip(places, made, strict=True)])


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All columns of df but text_col, with the token ids of the text as packed little-endian unsigned
    32-bit integers in ids_col (a column of that name, in any case, is replaced). Null and empty texts have no ids; repeated rows
    are encoded alike; an empty table gives no rows."""
    tables = df.sparkSession.sparkContext.broadcast(Tables.of(parse_ranks(read_vocabulary(path))))

    def begin():
        encoder = Encoder(tables.value, pattern)
        return lambda texts: [encoder.batch(texts)]

    return _mapped(df, text_col, [ids_col], begin)


def decode(df: DataFrame, path: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """All columns of df, with the bytes of the packed ids in decoded_col (replaced if it is there).
    Null ids decode to no bytes; an id that the vocabulary lacks is an error."""
    data = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def begin():
        decoder = Decoder(parse_ranks(data.value))
        return lambda ids: [list(map(decoder.decode, ids))]

    return _mapped(df, ids_col, [decoded_col], begin, stays=True)


def round_trip(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """encode() and then decode() of what it gave, in one pass over the texts."""
    tables = df.sparkSession.sparkContext.broadcast(Tables.of(parse_ranks(read_vocabulary(path))))

    def begin():
        encoder, decoder = Encoder(tables.value, pattern), Decoder(tables.value.ranks)

        def work(texts: list[str | None]) -> list[list[bytes]]:
            ids = encoder.batch(texts)
            return [ids, list(map(decoder.decode, ids))]

        return work

    return _mapped(df, text_col, [ids_col, decoded_col], begin)


def op4_bpe_round_trip(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
