import base64
import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from noticeworks.llm import bpe, token_counts

SF = "/root/testdata/sf0.01"
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = [
    None, "", " ", "  \n\t ", "a", "'s're'LL", "<|endoftext|>", "x<|endoftext|><|endoftext|>y <|endoftext|>", "日本語のテキスト", "🙂🙃 é́", "  x\r\n\r\n  y",
    "a" * 5000, "ab" * 3000, "é" * 2000, "1234567890" * 500, "-" * 4001, "x y " * 5000, "\x00\x01\x02", "Ünïcödé naïve ﬁ ½ ² Ⅷ ٣", "the the  the",
]


def noise(n):
    rng = random.Random(5)
    return ["".join(rng.choice("abcde éßÑ日🙂0123.,'\n\t") for _ in range(rng.randrange(200))) for _ in range(n)]


def test_encoding_is_the_library_s(spark):
    texts = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + ODD + noise(300)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (bpe.unpack(bytes(r["ids"])), bytes(r["decoded"])) for r in bpe.decode(bpe.encode(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN), P.path("byte_bpe_50k.tiktoken")).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == (tuple(LIBRARY.encode_ordinary(t or "")), (t or "").encode())


def test_merges_that_go_down_in_rank():
    # the merge of a and b makes a pair of lower rank, which comes before the other pairs of that rank
    ranks = {b"aba": 0, b"ab": 1, b"ba": 2, b"abab": 3} | {bytes([b]): 10 + b for b in range(256)}
    name, merger, rng, pieces, want = {v: k for k, v in ranks.items()}, bpe.Tables.of(ranks).merger(), random.Random(2), [], []
    for _ in range(300):
        piece = bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 14)))
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        pieces.append(piece)
        want.append(parts)

    def merged(run):
        ids, ends = merger.merge(run)
        return [[name[i] for i in ids[a:b].tolist()] for a, b in zip([0, *ends], ends)]

    # by themselves, and as large buckets of many pieces
    assert [merged([p])[0] for p in pieces] == want and merged(pieces) == want


def test_very_long_pre_tokens():
    encoder = bpe.Encoder(bpe.Tables.of(RANKS), P.PATTERN)
    for text in ("a" * 300_000, "the" * 100_000, "=-" * 150_000, "é" * 100_000, " " * 300_000):
        assert encoder.batch([text]) == [struct.pack(f"<{len(ids := LIBRARY.encode_ordinary(text))}I", *ids)]


def test_counts_are_the_library_s(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + ODD + noise(300)
    df = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int").repartition(3)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, P.path("byte_bpe_50k.json")).collect()}
    assert got == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_queries(spark):
    from noticeworks.llm.queries import queries

    rows = {r["doc_id"]: r for r in queries()["op4_bpe_round_trip"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = LIBRARY.encode_ordinary(r["text"])
        want = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest())
        assert tuple(rows[r["doc_id"]])[1:] == want
    counts = queries()["op3_token_counts"](spark, SF)
    assert counts.where((F.col("n_tokens") > 1024) != F.col("over_limit")).count() == 0


def test_empty_table_and_bad_vocabulary(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string, ids string")
    assert bpe.encode(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect() == []
    assert token_counts.count_tokens(df, P.path("byte_bpe_50k.json")).collect() == []
    bad = tmp_path / "x.json"
    bad.write_text('{"model": {"type": "Unigram"}, "pre_tokenizer": {"type": "Metaspace"}, "normalizer": null, "added_tokens": []}')
    with pytest.raises(ValueError):
        token_counts.count_tokens(df, str(bad))
