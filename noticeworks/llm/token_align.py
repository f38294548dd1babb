"""Cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizers A and B cut the same bytes. An A token and a B token link where their bytes overlap; byte offsets where tokens
of both end cut them into groups. How often two ids link in the corpus is the score of their links.

1. Texts are cut where both tokenizers must: before a single space between two characters that are no white space.
   The pieces between these cuts are aligned once and remembered by each Python worker up to a bound: tokens, groups and links of a
   text are those of its pieces in a row. New pieces of some megabytes of text go through the tokenizers together.
2. A task numbers its documents and gathers them in chunks of bounded size. For a chunk it inverts the links: each id pair gets a
   bitmap of the chunk's documents that hold it, and one for each binary digit of the further links of the pair in a document
   (the multiplicity planes). A bitmap is compressed: two bytes for each document, or a bit for each document of
   the chunk where that is less. Batches of a chunk are OR-merged as it closes, and a pair's bitmaps of all chunks are the
   parts of one bitmap over the corpus, so a pair that stands in every document is as many rows as there are chunks.
3. Popcounts, added up by pair in Spark, give each pair's documents (of the bitmaps) and links (of the planes, weighted by their digit). The
   highest of each B id follows from those.
4. The postings return the scores: each chunk's bitmaps meet their pairs' scores, and add them up at the documents whose
   bits are set. No text is tokenized again.

The highest counts of B ids are broadcast: a row for each id of its vocabulary.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from noticeworks.llm.bpe import read_vocabulary, spans
from noticeworks.llm.shared import bundled, others, unbundled, written
from noticeworks.llm.token_counts import byte_of_char

#: Pieces and links of pieces that a worker remembers; pieces that are tokenized together.
CACHE, CACHED_LINKS, TOGETHER = 250_000, 4_000_000, 5_000
#: Bytes of text that are worked on together.
SPAN = 1_000_000
#: Documents (two bytes number them) of a chunk, links from which on it is closed, and documents of bitmaps unpacked together.
CHUNK_DOCS, CHUNK_LINKS, UNPACKED = 1 << 16, 2_000_000, 500_000
#: The mark of a space in the pieces of B, and its pieces for single bytes.
SPACE, BYTE = "▁", regex.compile(r"<0x([0-9A-F]{2})>")
#: Where both tokenizers cut; the space begins the next piece.
CUT = regex.compile(r"(?<=\S) (?=\S)")


class Aligner:
    """Aligns pieces of text. a_path: a byte-level BPE file of the tokenizers library; b_path: a sentencepiece model."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.a = Tokenizer.from_str(read_vocabulary(a_path).decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=read_vocabulary(b_path))
        table = byte_of_char()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            # a special token isn't written in characters of bytes, and isn't made
            self.a_bytes[i] = bytes(map(table.get, token)) if all(c in table for c in token) else token.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in name.lstrip(SPACE) for name in names):
            raise ValueError("B has pieces that go on behind a word's end; texts can't be cut there")
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := BYTE.fullmatch(name)) else name.replace(SPACE, " ").encode() for name in names]
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))

    def tokens(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Both tokenizers' ids of pieces, each of which begins with a space; no ids where the bytes of either differ from the piece."""
        a = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        b = self.b.encode([p[1:] for p in pieces], num_threads=1)  # which adds the space
        for k, p in enumerate(pieces):
            raw = p.encode()
            if b"".join(map(self.a_bytes.__getitem__, a[k])) != raw or b"".join(map(self.b_bytes.__getitem__, b[k])) != raw:
                a[k] = b[k] = []
        return a, b


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of slices of these sizes, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Pieces:
    """Aligned pieces by number: their tokens, groups, links (as keys a * size of B + b) and groups' text."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.rows: list[list] = [[], [], [], [], []]  # arrays of n_a, n_b, n_groups, n_links and keys
        self.text: list[str | None] = []  # None: the bytes differ
        self.odd: set[str] = set()  # what isn't cut out of a text by its spaces alone

    def learn(self, new: list[str]) -> None:
        """new: pieces without the space that each begins with."""
        self.odd.update(filter(_at_white_space, new))
        for at in range(0, len(new), TOGETHER):
            run = new[at : at + TOGETHER]
            self.number.update(zip(run, range(len(self.text), len(self.text) + len(run)), strict=True))
            self._align(*self.aligner.tokens([" " + p for p in run]))

    def _align(self, a: list[list[int]], b: list[list[int]]) -> None:
        n_a, n_b = (np.array([len(x) for x in side]) for side in (a, b))
        ids_a, ids_b = (np.fromiter(itertools.chain.from_iterable(side), np.int64, int(n.sum())) for side, n in ((a, n_a), (b, n_b)))
        ends_a, ends_b = np.cumsum(self.aligner.a_size[ids_a]), np.cumsum(self.aligner.b_size[ids_b])
        # a link for each stretch between two ends of either; pieces end in both, so none spans two
        ends = np.union1d(ends_a, ends_b)
        link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        both_a = np.isin(ends_a, ends_b, assume_unique=True)  # A tokens that end a group
        both_b = np.isin(ends_b, ends_a, assume_unique=True)
        piece_of_a, piece_of_b = np.repeat(np.arange(len(a)), n_a), np.repeat(np.arange(len(b)), n_b)
        count = lambda which: np.bincount(which, minlength=len(a))
        columns = n_a, n_b, count(piece_of_a[both_a]), count(piece_of_a[link_a]), ids_a[link_a] * len(self.aligner.b_bytes) + ids_b[link_b]
        for held, column in zip(self.rows, columns, strict=True):
            held.append(column)
        # the groups' text: an A token follows the B tokens of earlier groups, a B token the A tokens up to its own group's end
        group_a, group_b = (np.cumsum(both) - both for both in (both_a, both_b))
        place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a)
        place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
        out = np.empty(len(ids_a) + len(ids_b), object)
        for ids, place, both, end in ((ids_a, place_a, both_a, "|"), (ids_b, place_b, both_b, ";")):
            out[place] = [f"{i}{end if last else ','}" for i, last in zip(ids.tolist(), both.tolist(), strict=True)]
        stops = np.cumsum(n_a + n_b).tolist()
        listed = out.tolist()
        self.text += ["".join(listed[i:j]) if j > i else None for i, j in zip([0, *stops], stops)]

    def columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A row of n_a, n_b, n_groups and n_links for each piece, where its keys start, all keys, and which pieces are good."""
        self.rows = [[np.concatenate(r) if r else np.zeros(0, np.int64)] for r in self.rows]
        n = np.stack([r[0] for r in self.rows[:4]])
        return n, np.cumsum(n[3]) - n[3], self.rows[4][0], np.array([t is not None for t in self.text], bool)

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The pieces of each text; new ones are learned. Texts aren't empty."""
        if len(self.text) >= CACHE or sum(map(len, self.rows[4])) >= CACHED_LINKS:
            self.clear()
        split = [t.split(" ") for t in texts]
        self.odd.update(filter(_at_white_space, set(itertools.chain.from_iterable(split)).difference(self.number)))
        split = [parts if self.odd.isdisjoint(parts) else CUT.split(t) for parts, t in zip(split, texts, strict=True)]
        self.learn(list(set(itertools.chain.from_iterable(split)).difference(self.number)))
        return [list(map(self.number.__getitem__, parts)) for parts in split]


def _at_white_space(part: str) -> bool:
    return not part or part.strip() != part


@functools.lru_cache(1)
def _pieces(a_path: str, b_path: str) -> Pieces:
    """A Python worker's own, for all its tasks: the tokenizers are read once, and pieces met in one task are known in the next."""
    return Pieces(Aligner(a_path, b_path))


#: A posting row: the bitmap of one pair in one chunk; plane 0 holds the documents with a link, plane k those whose
#: further links have the binary digit of 2^(k - 1).
POSTING = [("chunk", pa.int64()), ("pair", pa.int64()), ("plane", pa.int32()), ("held", pa.int32()), ("bits", pa.binary())]
FACTS = [("row", None), ("low", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string())]


class Chunk:
    """The links of up to CHUNK_DOCS documents."""

    def __init__(self, number: int):
        self.number, self.docs, self.links = number, 0, 0
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, docs: np.ndarray, n_docs: int) -> None:
        """Links (pair, document of the batch) of a batch, as sorted distinct (pair, document) and their multiplicity."""
        both, times = np.unique(keys << 16 | (docs + self.docs), return_counts=True)
        self.parts.append((both, times.astype(np.int32)))
        self.docs += n_docs
        self.links += len(both)

    def postings(self) -> list[pa.Array]:
        """The columns of POSTING: the batches' bitmaps OR-merged. A document is in one batch, so no multiplicities meet."""
        both = np.concatenate([b for b, _ in self.parts] or [np.zeros(0, np.int64)])
        times = np.concatenate([t for _, t in self.parts] or [np.zeros(0, np.int32)])
        order = np.argsort(both, kind="stable")
        both, times = both[order], times[order] - 1
        planes = [(0, both)] + [(k + 1, both[times >> k & 1 > 0]) for k in range(int(times.max(initial=0)).bit_length())]
        made = [_bitmaps(b, self.docs) for _, b in planes]
        pairs, held, bits = (np.concatenate([m[k] for m in made]) if k < 2 else pa.concat_arrays([m[k] for m in made]) for k in range(3))
        plane = np.repeat(np.array([k for k, _ in planes], np.int32), [len(m[0]) for m in made])
        return [pa.array(np.full(len(pairs), self.number)), pa.array(pairs), pa.array(plane), pa.array(held), bits]


def _bitmaps(both: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Pairs, numbers of documents and bitmaps of sorted (pair, document)."""
    pair, low = both >> 16, (both & 0xFFFF).astype("<u2")
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    held = np.diff(np.append(first, len(pair))).astype(np.int32)
    width = -(-docs // 8)
    dense = 2 * held > width
    # a bitmap's width is odd, by which it is told from a list
    width |= 1
    sizes = np.where(dense, width, 2 * held)
    out = np.zeros(int(sizes.sum()), np.uint8)
    starts, end = np.cumsum(sizes) - sizes, np.append(first[1:], len(pair))
    out[ragged(starts[~dense], sizes[~dense])] = low[~np.repeat(dense, held)].view(np.uint8)
    for k in np.flatnonzero(dense).tolist():
        mark = np.zeros(8 * width, bool)
        mark[low[first[k] : end[k]]] = True
        out[starts[k] : starts[k] + width] = np.packbits(mark, bitorder="little")
    offsets = np.append(starts, len(out)).astype(np.int64)
    bits = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(out)])
    return pair[first], held, bits.cast(pa.binary())


def documents_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The documents in bitmaps, one bitmap after another, and how many each has."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data, sizes = np.frombuffer(column.buffers()[2], np.uint8), np.diff(offsets)
    dense = sizes % 2 == 1
    held = sizes // 2
    unpacked = {}
    for k in np.flatnonzero(dense).tolist():
        unpacked[k] = np.flatnonzero(np.unpackbits(data[offsets[k] : offsets[k + 1]], bitorder="little"))
        held[k] = len(unpacked[k])
    out = np.empty(int(held.sum()), np.int64)
    starts = np.cumsum(held) - held
    out[ragged(starts[~dense], held[~dense])] = data[ragged(offsets[:-1][~dense], sizes[~dense])].view("<u2")
    for k, docs in unpacked.items():
        out[starts[k] : starts[k] + len(docs)] = docs
    return out, held


def _aligned(docs: DataFrame, a_path: str, b_path: str, digest: bool, chunk_links: int) -> DataFrame:
    """docs (row, text) as rows of two kinds: the documents with FACTS and their chunk, and the POSTING rows of their pairs."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(a_path, b_path)
        numbers = (TaskContext.get().partitionId() << 32 | k for k in itertools.count())
        chunk = Chunk(next(numbers))

        def rows(arrays: dict[str, pa.Array], n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([arrays.get(f.name, pa.nulls(n, f.type)) for f in shape], schema=shape)

        def closed() -> Iterator[pa.RecordBatch]:
            columns = dict(zip((n for n, _ in POSTING), chunk.postings(), strict=True))
            whole = rows(columns, len(columns["pair"]))
            for at in range(0, len(columns["pair"]), 100_000):
                yield whole.slice(at, 100_000)

        shape = None
        for b in it:
            shape = shape or pa.schema([(n, kind or b.schema.field("row").type) for n, kind in FACTS] + POSTING)
            for part, texts in spans(b, "text", SPAN):
                for at in range(0, len(texts), CHUNK_DOCS):
                    some = texts[at : at + CHUNK_DOCS]
                    if chunk.docs + len(some) > CHUNK_DOCS or chunk.links >= chunk_links:
                        yield from closed()
                        chunk = Chunk(next(numbers))
                    base = chunk.docs
                    facts, groups = _documents(pieces, some, chunk)
                    text = [hashlib.sha256(g.encode()).hexdigest() if g and digest else g for g in groups]
                    columns = {"row": part.column(0).slice(at, len(some)), "low": pa.array(np.arange(base, chunk.docs, dtype=np.int32)), "groups": pa.array(text, pa.string()), "chunk": pa.array(np.full(len(some), chunk.number))}
                    yield rows(columns | dict(zip(("n_a", "n_b", "n_groups", "n_links"), map(pa.array, facts), strict=True)), len(some))
        if chunk.docs:
            yield from closed()

    longs = dict.fromkeys(("n_a", "n_b", "n_groups", "n_links"), "long")
    kinds = {"low": "int"} | longs | {"groups": "string", "chunk": "long", "pair": "long", "plane": "int", "held": "int", "bits": "binary"}
    return docs.mapInArrow(run, StructType([StructField("row", docs.schema["row"].dataType), *docs.select(*[F.lit(None).cast(t).alias(c) for c, t in kinds.items()]).schema]))


def _documents(pieces: Pieces, texts: list[str | None], chunk: Chunk) -> tuple[np.ndarray, list[str]]:
    """n_a, n_b, n_groups and n_links of each text, and its groups; its links go to the chunk."""
    full = [i for i, t in enumerate(texts) if t]
    numbers = pieces.numbers([texts[i] for i in full])
    n, key_at, keys, good = pieces.columns()
    flat, sizes = np.fromiter(itertools.chain.from_iterable(numbers), np.int64), np.zeros(len(texts), np.int64)
    sizes[full] = [len(x) for x in numbers]
    doc = np.repeat(np.arange(len(texts)), sizes)
    bad = np.zeros(len(texts), bool)
    bad[doc[~good[flat]]] = True
    flat, doc = flat[~bad[doc]], doc[~bad[doc]]
    facts = np.stack([np.bincount(doc, n[k][flat], len(texts)).astype(np.int64) for k in range(4)])
    links = n[3][flat]
    chunk.add(keys[ragged(key_at[flat], links)], np.repeat(doc, links), len(texts))
    groups, text = [""] * len(texts), pieces.text
    for i, own in zip(full, numbers, strict=True):
        if not bad[i]:
            groups[i] = "".join(map(text.__getitem__, own))[:-1]  # without the last ;
    return facts, groups


def _returned(scored: DataFrame) -> DataFrame:
    """(chunk, low, n_best, count_sum): the scores of each chunk's bitmaps added up at its documents."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, np.zeros((2, CHUNK_DOCS), np.int64)
        for b in it:
            chunks, held = (b.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "held"))
            # slices of one chunk and a bounded number of documents
            cuts = np.flatnonzero((np.diff(chunks) != 0) | (np.diff(np.cumsum(held) // UNPACKED) != 0)) + 1
            for start, end in itertools.pairwise([0, *cuts.tolist(), b.num_rows] if b.num_rows else []):
                if chunks[start] != now:
                    if now is not None:
                        yield _sums(now, own)  # chunks come one after another
                    now, own = int(chunks[start]), np.zeros((2, CHUNK_DOCS), np.int64)
                part = b.slice(start, end - start)
                low, n = documents_of(part.column("bits"))
                weight, links, best = (part.column(c).to_numpy(zero_copy_only=False) for c in ("weight", "links", "best"))
                np.add.at(own[0], low, np.repeat(weight * best, n))
                np.add.at(own[1], low, np.repeat(weight * links, n))
        if now is not None:
            yield _sums(now, own)

    return scored.mapInArrow(run, "chunk long, low int, n_best long, count_sum long")


def _sums(chunk: int, own: np.ndarray) -> pa.RecordBatch:
    low = np.flatnonzero(own[1])
    columns = [np.full(len(low), chunk), low.astype(np.int32), own[0][low], own[1][low]]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["chunk", "low", "n_best", "count_sum"])


class Alignment:
    """documents: the columns of the given documents without the text, with n_a, n_b, n_groups, n_links, groups (`a1,a2|b1;a3|b2`, or its
    sha256), n_best (links whose pair has the highest count of its B id) and count_sum (the counts of its links). pairs: a, b,
    docs and links of each pair of ids that link; ids of A and B."""

    def __init__(self, documents: DataFrame, pairs: DataFrame):
        self.documents, self.pairs = documents, pairs


def align(df: DataFrame, a_path: str, b_path: str, text_col: str = "text", digest: bool = False, chunk_links: int = CHUNK_LINKS) -> Alignment:
    """Aligns the tokens of each text by A (byte-level BPE file of the tokenizers library, given a space before the text) and B
    (sentencepiece model, which adds one), both without special tokens: their strings in a text are plain text.

    Texts that are null, empty or not what the tokens of A or B spell have no tokens: zeros, and no groups (''). Columns named as a made
    one (in any case) are replaced; others stay, whatever their names. Repeated rows count as often as they are there;
    an empty table gives no rows. The whole texts are aligned; a text is in one task.
    """
    made = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")
    keep = others(df, text_col, *made)
    docs = df.select(bundled(df, keep), F.col(text_col).alias("text"))
    size_b = _size(b_path)
    both = written(_aligned(docs, a_path, b_path, digest, chunk_links), "aligned")
    weight = F.when(F.col("plane") == 0, F.lit(1).cast("long")).otherwise(F.expr("shiftleft(1L, plane - 1)"))
    postings = both.where("pair is not null").select("chunk", "pair", "held", weight.alias("weight"), "bits", "plane")
    counts = postings.groupBy("pair").agg(F.sum(F.when(F.col("plane") == 0, F.col("held")).otherwise(0)).cast("long").alias("docs"), F.sum(F.col("held") * F.col("weight")).alias("links"))
    counts = written(counts.withColumn("b", F.pmod("pair", F.lit(size_b))), "pairs")
    most = F.broadcast(written(counts.groupBy("b").agg(F.max("links").alias("most")), "most"))  # a row for each id of B
    scores = counts.join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).cast("long").alias("best"))
    # a chunk is of bounded size, so it fits one task
    scored = postings.join(scores, "pair").select("chunk", "held", "weight", "links", "best", "bits").repartition("chunk").sortWithinPartitions("chunk")
    sums = _returned(scored)
    facts = both.where("pair is null").select("row", "chunk", "low", *made[:5])
    out = facts.join(sums, ["chunk", "low"], "left").select(*unbundled(keep), *made[:5], *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in made[5:]])
    return Alignment(out, counts.select(F.floor(F.col("pair") / size_b).cast("long").alias("a"), "b", "docs", "links"))


def _size(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=read_vocabulary(b_path)).get_piece_size()


def op11_token_alignment(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return found.documents.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
