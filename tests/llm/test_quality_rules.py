import collections
import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from noticeworks.llm import quality_rules as Q

SF = "/root/testdata/sf0.01"
ODD = [None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "a b c d a b c", "x " * 4000, "l\nl\nl\n\n \nm", "é ü #*$ %&|<> a", "a b a b a b a", "w\x0bx\x0cy\rz", "\u00a0a\u00a0 b", " ".join(str(i) for i in range(5000)) + " 1 2 3 4"]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i, g in enumerate(zip(w, w[1:], w[2:])):
        if seen[g] > 1:
            covered |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_windows_whose_hashes_meet(spark, monkeypatch):
    # the hash of a window is the length of its first word: different windows meet all the time
    monkeypatch.setattr(Q.F, "xxhash64", lambda *c: F.length(c[0]).cast("long"))
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["a", "b", "cc", "dd", "e"]) for _ in range(rng.randrange(60))) for _ in range(200)]
    assert stats_of(spark, texts) == {i: brute(t) for i, t in enumerate(texts)}


def test_estimates_against_every_half_of_small_groups(spark):
    rng, rows, groups = np.random.default_rng(1), [], {}
    for g in range(6):
        x = rng.normal(size=(13, 4)) @ (rng.normal(size=(4, 4)) * 0.3) * [1, 0.6, 0.8, 0.9] + [2, 0.5, 0.6, 0.7]
        if g % 2:
            x[:5] += rng.normal(size=4) * 3
        groups[f"g{g}"] = z = np.clip(np.round(np.abs(x) * Q.SCALE), 0, Q.TOP).astype(int)
        rows += [(f"g{g}", *map(int, r)) for r in z]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"z_{a} long" for a in Q.DIMS))
    found = {r["g"]: r["det"] for r in Q.robust_estimates(df).collect()}
    floor = np.diag(np.square([Q.FLOOR[a] for a in Q.DIMS]))
    det = lambda z: np.linalg.slogdet(Q.CONSISTENCY[0.5] * np.cov(z.T / Q.SCALE, bias=True) + floor)[1]
    least = {g: min(det(z[list(c)]) for c in itertools.combinations(range(13), 7)) for g, z in groups.items()}
    # never below the least of all 1,716 halves, that itself in half of the groups, and far below all rows' determinant
    assert all(least[g] - 1e-6 <= found[g] <= least[g] + 0.6 < det(z) for g, z in groups.items())
    assert sum(found[g] < least[g] + 1e-6 for g in groups) >= 3


def stats_of(spark, texts):
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in Q.text_statistics(df).collect()}


def test_statistics_against_brute_force(spark):
    rng = random.Random(3)
    texts = ODD + [" ".join(rng.choice("abcd") for _ in range(rng.randrange(60))) for _ in range(200)] + [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    assert stats_of(spark, texts) == {i: brute(t) for i, t in enumerate(texts)}


def test_query_keeps_good_documents_and_drops_bad_ones(spark):
    out = Q.op5_quality_rules(spark, SF).cache()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.count() == docs.count() and out.columns == list(Q.OUTPUT)
    assert out.where((F.col("base_failed") != ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))) | (F.col("base_failed") & F.col("kept"))).count() == 0
    judged = out.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("not base_failed")
    good, bad = judged.where("quality = 1"), judged.where("quality = 0")
    assert good.where("not kept").count() == 0
    assert bad.where("kept").count() <= 0.05 * bad.count()


def test_outlier_is_rejected_whatever_its_group(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
    plain = [(i, " ".join(word() for _ in range(100)), rng.choice(["en", None]), rng.choice(["a", "b", None])) for i in range(300)]
    junk = [(1000 + i, " ".join(word() + "###" for _ in range(100)), lang, src) for i, (lang, src) in enumerate([("en", "a"), (None, None), ("xx", "zz")])]
    df = spark.createDataFrame(plain + junk, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in Q.quality_rules(df).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[1000 + i] for i in range(3))


def test_a_source_s_own_estimate_counts_at_any_size(spark):
    """Long words are normal in one source and odd in another of the same language, however few texts there are."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(n, n + 3)))
    text = lambda n: " ".join(word(n) for _ in range(80))
    rows = [(f"short {i}", text(4), "en", "short") for i in range(12)] + [(f"long {i}", text(13), "en", "long") for i in range(12)]
    rows += [(f"other {i}", text(4), "en", f"s{i % 5}") for i in range(60)] + [("odd", text(13), "en", "short")]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    far = {r["doc_id"]: r["distance"] for r in Q.quality_rules(df).collect()}
    assert max(far[f"long {i}"] for i in range(12)) < 0.7 * far["odd"] and max(far[f"short {i}"] for i in range(12)) < 2


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None, None, 5), (1, None, None, None, 5)], "doc_id long, text string, lang string, source string, kept int")
    assert [(r["n_words"], r["base_failed"], r["kept"]) for r in Q.quality_rules(df).collect()] == [(0, True, False)] * 2
    assert Q.quality_rules(df.limit(0)).collect() == []
    assert "text" not in Q.quality_rules(df, keep_text=False).columns
    # columns named like working ones
    names = ["row", "pair", "hash", "g", "e", "key", "_words", "_lines", "z_symbols", "m_symbols", "start", "ep"]
    df = spark.createDataFrame([(1, "a b", "en", "s", *range(12))], "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} int" for n in names))
    got = Q.quality_rules(df).first()
    assert [got[n] for n in names] == list(range(12)) and got["n_words"] == 2


def words_of(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


def verdicts(spark, texts):
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    return [r["kept"] for r in Q.quality_rules(df).orderBy("doc_id").collect()]


def test_junk_of_over_a_third_of_a_group_is_rejected(spark):
    rng = random.Random(2)
    plain = [" ".join(words_of(rng, 100)) for _ in range(300)]
    near = " ".join(w + "###" for w in words_of(rng, 100))
    for junk in ([f"{near} {i}" for i in range(160)], [near] * 400):
        kept = verdicts(spark, plain + junk)
        assert all(kept[:300]) and not any(kept[300:])


def test_repetition_alone_rejects_and_a_little_stays(spark):
    rng = random.Random(4)
    plain = ["\n".join([" ".join(words_of(rng, 100)), *words_of(rng, 6), *["end"] * (4 if i % 50 == 0 else 0)]) for i in range(300)]
    lines = " ".join(words_of(rng, 200)) + "\n" + "\n".join(rng.choice(["one", "two", "three"]) for _ in range(60))
    phrase = words_of(rng, 24)
    repeats = " ".join([*phrase, *words_of(rng, 52), *phrase])
    assert brute(lines)[3] / 61 > 0.9 and brute(lines)[4] / 260 < 0.4 and 0.45 < brute(repeats)[4] / 100 <= 0.5
    kept = verdicts(spark, [*plain, lines, repeats])
    assert all(kept[:300]) and kept[300:] == [False, False]
