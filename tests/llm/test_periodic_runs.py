import hashlib
import random
import re
import zlib

import numpy as np

from noticeworks.llm import periodic_runs as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """Every maximal stretch by comparing all pairs of words at each distance."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i + q - start
            smallest = next(p for p in range(1, q + 1) if all(w[k] == w[k + p] for k in range(start, start + length - p)))
            if smallest == q and length >= max(6, 4 * q):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(w, runs):
    return [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]


def moved(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def row(doc_id, text):
    w = moved(doc_id, text)
    runs = brute(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(kept(w, runs))))


def texts():
    rng = random.Random(3)
    out = [None, "", " \n", "a", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b", "a b c " * 4, "x a b c " * 3 + "x", "é 日 " * 5, "  x   x " * 3]
    for _ in range(400):  # few words: many runs that touch and overlap
        out.append(" ".join(rng.choice("ab" if rng.random() < 0.5 else "abc") for _ in range(rng.randrange(60))))
    for _ in range(200):  # runs inside prose, and runs of runs
        inner = [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))]
        inner = inner * rng.randrange(3, 7) + inner[: rng.randrange(len(inner))]
        prose = lambda: [rng.choice("abcdefghijklmnopq") for _ in range(rng.randrange(20))]
        w = prose() + inner + prose()
        out.append(" ".join(w * rng.choice([1, 1, 4, 5])))
    return out


def test_runs_and_collapsed_text_are_those_of_brute_force(spark):
    all_ = texts()
    for t, (runs, collapsed) in zip(all_, P.batch_runs(all_), strict=True):
        w = WORD.findall(t or "")
        assert runs == brute(w), t
        assert collapsed == " ".join(kept(w, runs))
    assert [P.batch_runs([t])[0] for t in all_[:60]] == P.batch_runs(all_[:60])


def test_query_is_brute_force_s(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts())] + [(7, "a b " * 9), (7, "a b " * 9), (None, "a " * 7), (-1, "b " * 7)]
    rng = random.Random(8)
    rows += [(1000 + i, " ".join(rng.choice(["la", "le", "lo", "da", "de", "di"]) for _ in range(rng.randrange(1, 90)))) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in P.op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sum(r[2] is not None for r in got) > 100
    assert sorted(got, key=str) == sorted((row(*r) for r in rows), key=str)


def test_given_documents(spark):
    """The registered query on the given table; brute force where a text is short enough for it."""
    docs = {r[0]: r[1] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    got = {r[0]: tuple(r) for r in P.op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == docs.keys()
    short = {k: t for k, t in docs.items() if len(t or "") < 8000}
    assert len(short) > 100
    for k, t in short.items():
        assert got[k] == row(k, t)


def test_long_texts_take_linear_work():
    w = np.zeros(400_000, np.int64)
    assert P.lag_scan(w) == [(0, 400_000, 1)]
    w = np.tile(np.arange(1000), 300)
    assert P.lag_scan(w) == [(0, 300_000, 1000)]
    rng = np.random.default_rng(1)
    (runs, _), = P.batch_runs([" ".join(map(str, rng.integers(0, 50_000, 300_000)))])
    assert runs == []


def test_names_that_clash_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a a a a a a", "r", 3, 4)], "row long, Text string, RUNS string, start long, `a b` int")
    out = P.periodic_runs(df, "Text")
    assert out.columns == ["row", "start", "a b", "runs", "collapsed"]
    assert [tuple(r) for r in out.collect()] == [(1, 3, 4, [(0, 6, 1)], "a")]
    assert P.periodic_runs(df.limit(0), "Text").count() == 0
