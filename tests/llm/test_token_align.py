import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from noticeworks.llm import token_align as T
from noticeworks.llm.token_counts import byte_of_char

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "  \n\t ", "a", " a", "a ", "a  b", "a \n b", "'s're'LL", "it's  o'clock", "<|endoftext|>", "x <|endoftext|> <s> </s> <unk> <0x41> y", "日本語の テキスト", "🙂🙃 é́ ﬁ½ ³", "  x\r\n\r\n  y",
    "a▁b", "▁", "one two▁ three", "a" * 3000, "ab " * 2000, "\x00 \x01 \x1c x\x1f y", "a b  c", "　 x  y", "a\x85 b", "tab\tand\x0bothers\x0c here", "the the  the", "the the  the", "-- ... !!! ?!", "x​ y", "naïve Ünïcödé ",
]
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Brute:
    """Whole texts by the libraries, and overlaps byte range by byte range."""

    def __init__(self):
        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        self.chars = byte_of_char()

    def cut(self, text):
        want = (" " + (text or "")).encode()
        a = self.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = self.b.encode(text or "")
        bytes_a = [bytes(map(self.chars.__getitem__, self.a.id_to_token(i))) for i in a]
        names = [self.b.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(n[3:5], 16)]) if len(n) == 6 and n.startswith("<0x") else n.replace("▁", " ").encode() for n in names]
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            return [], [], [], ""
        ranges = lambda parts: list(zip(np.cumsum([0, *map(len, parts)]).tolist(), np.cumsum([*map(len, parts)]).tolist()))
        ra, rb = ranges(bytes_a), ranges(bytes_b)
        links, j = [], 0
        for i, (s, e) in enumerate(ra):
            while rb[j][1] <= s:
                j += 1
            k = j
            while k < len(rb) and rb[k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        groups, at = [], (0, 0)
        for end in sorted({e for _, e in ra} & {e for _, e in rb}):
            to = next(i for i in range(at[0], len(ra)) if ra[i][1] == end) + 1, next(i for i in range(at[1], len(rb)) if rb[i][1] == end) + 1
            groups.append(",".join(map(str, a[at[0] : to[0]])) + "|" + ",".join(map(str, b[at[1] : to[1]])))
            at = to
        return a, b, links, ";".join(groups)

    def table(self, texts):
        cut = [self.cut(t) for t in texts]
        counts = Counter(x for _, _, links, _ in cut for x in links)
        docs = Counter(x for _, _, links, _ in cut for x in set(links))
        most = {}
        for (_, b), n in counts.items():
            most[b] = max(n, most.get(b, 0))
        rows = [(len(a), len(b), g.count(";") + 1 if g else 0, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), g) for a, b, links, g in cut]
        return rows, {(a, b): (docs[a, b], n) for (a, b), n in counts.items()}


@pytest.fixture(scope="module")
def brute():
    return Brute()


def noise(n):
    rng = random.Random(6)
    return ["".join(rng.choice("abcde  éßÑ日🙂01.,'\n\t ") for _ in range(rng.randrange(120))) for _ in range(n)]


def given(spark, sf):
    return [r[0] for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("text").collect()]


@pytest.mark.parametrize("chunk_links", [T.CHUNK_LINKS, 500])
def test_alignments_are_those_of_whole_texts(spark, brute, chunk_links):
    texts = given(spark, "sf0.001") + ODD + noise(200)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = T.align(df, A_PATH, B_PATH, chunk_links=chunk_links)
    rows, pairs = brute.table(texts)
    got = {r["doc_id"]: (*(r[n] for n in NAMES), r["groups"]) for r in found.documents.collect()}
    assert len(got) == len(texts)
    for i, want in enumerate(rows):
        assert got[i] == want, repr(texts[i])[:200]
    assert {(r["a"], r["b"]): (r["docs"], r["links"]) for r in found.pairs.collect()} == pairs


def test_query_on_the_given_table(spark, brute):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rows, _ = brute.table([r["text"] for r in table])
    want = {d["doc_id"]: (*r[:6], hashlib.sha256(r[6].encode()).hexdigest() if r[6] else "") for d, r in zip(table, rows, strict=True)}
    out = T.op11_token_alignment(spark, "/root/testdata/sf0.01")
    assert out.columns == ["doc_id", *NAMES, "groups_sha256"]
    got = {r["doc_id"]: tuple(r)[1:] for r in out.collect()}
    assert got == want


def test_bitmaps_come_back():
    rng = np.random.default_rng(2)
    for docs in (1, 9, 300, 5000, 65536):
        sets = [np.unique(rng.integers(0, docs, rng.integers(1, docs + 1))) for _ in range(12)] + [np.arange(docs)]
        both = np.concatenate([(k * 7 << 16) | s for k, s in enumerate(sets)])
        pair, held, bits = T._bitmaps(both, docs)
        assert pair.tolist() == [7 * k for k in range(len(sets))] and held.tolist() == [len(s) for s in sets]
        for column in (bits, pa.concat_arrays([bits, bits]).slice(len(sets))):
            low, n = T.documents_of(column)
            assert n.tolist() == held.tolist() and low.tolist() == np.concatenate(sets).tolist()


def test_repeated_rows_names_that_clash_and_empty_tables(spark, brute):
    rows = [(1, "the cat", "r", 5), (1, "the cat", "r", 5), (None, None, None, 6), (2, "the dog", "s", 7)]
    df = spark.createDataFrame(rows, "doc_id long, TEXT string, N_A string, row int")
    out = T.align(df, A_PATH, B_PATH, "TEXT").documents
    assert out.columns == ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    want, _ = brute.table([r[1] for r in rows])
    got = [(r["doc_id"], r["row"], *(r[n] for n in NAMES), r["groups"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(((r[0], r[3], *w) for r, w in zip(rows, want, strict=True)), key=str)
    empty = T.align(df.limit(0), A_PATH, B_PATH, "TEXT")
    assert empty.documents.count() == 0 and empty.pairs.count() == 0
