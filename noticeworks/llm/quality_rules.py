"""Quality rules: robust multivariate outliers.

Each text's statistics become a vector of four transformed values: log of the mean word length, the
square root of the share of symbols, and -log(1 - x) of the share of repeated lines and of the share of
words in repeated 3-word windows over the base limit of that share, so that both grow without bound.
For each language and source a minimum-covariance-determinant estimate is made: from four robust and plain
starts, concentration steps (mean and covariance of the `share` of rows nearest by Mahalanobis distance)
are repeated until the determinant gets no smaller, and the estimate of least determinant remains. The
share is a half, and each distinct text of a group counts once, so that junk of up to nearly half of a group's texts, or one text copied however often, has no
part in the estimate. Every language and source has an estimate of its own, drawn towards that of its language by the weight of
`prior` texts (and that of a language towards that of all): n distinct texts count n of n + prior, at any size. A text whose
squared distance from its group's estimate is above `cutoff` is rejected.

All of it is built-in functions. The statistics are row-wise, without a shuffle. The estimates come
from groupBy sums with partial aggregation, so a group that holds a third of all rows costs no more
than the others: equal vectors of a group are first counted together, and every step goes over those counts. Medians and
distance quantiles come from exact percentiles over values cut into a bounded number of steps, so an aggregation buffer is bounded too. Values are fixed-point integers:
sums don't depend on the order of rows, and reruns agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeworks.llm.shared import SPACES, others, unused, words, written

#: Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
DIMS = ("word_length", "symbols", "repeated_lines", "repeated_words")
#: Standard deviations are at least these, so that a statistic that is 0 nearly everywhere rejects no small value. They are
#: tolerances of edited prose, whatever the corpus: words an eighth longer or shorter, a symbol in 400 characters, a fifth of the
#: lines or an eighth of the words (of a half, the base limit) repeated. Pass others for other kinds of text.
FLOOR = {"word_length": 0.12, "symbols": 0.05, "repeated_lines": 0.2, "repeated_words": 0.3}
#: The base rule: more repeated words than this share fail.
MOST_REPEATED = 0.5
#: 0.9999 quantile of chi-squared with 4 degrees of freedom.
CUTOFF = 23.51
#: Steps to a unit in the fixed-point vectors, and the largest value kept (transformed values lie under 32).
SCALE, TOP = 256, 32 * 256
#: Makes the covariance of the nearest share of normal rows that of all, for 4 dimensions.
CONSISTENCY = {0.5: 2.109, 0.75: 1.486, 1.0: 1.0}
#: An estimate has settled once a step takes less than this off the logarithm of its determinant.
SETTLED = 1e-3
#: Tables of up to so many groups (about 150 bytes each) are broadcast.
BROADCAST_GROUPS = 100_000


def _repeated_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more; w is an array of words. Equal windows meet
    by sorting (a hash above the position, in 64 bits) and are then compared word by word; where two
    different windows meet, the windows themselves are sorted."""
    n = F.size(w)
    starts = F.sequence(F.lit(0), n - 3)
    bits = F.greatest(F.lit(16), F.ceil(F.log2(n.cast("double") + 1))).cast("int")
    window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    shift = lambda name, x: F.call_function(name, x, bits)
    key = lambda x: shift("shiftright", x)
    packed = F.transform(starts, lambda i: shift("shiftleft", window(i)) + i)
    place = lambda x: (x - shift("shiftleft", key(x))).cast("int")
    same = lambda a, b: (F.get(w, a) == F.get(w, b)) & (F.get(w, a + 1) == F.get(w, b + 1)) & (F.get(w, a + 2) == F.get(w, b + 2))
    both = lambda pairs: F.array_sort(F.array_distinct(F.flatten(F.transform(pairs, lambda p: F.array(p["a"], p["b"])))))

    def by_text() -> Column:
        s = F.array_sort(F.transform(starts, lambda i: F.struct(F.array_join(F.slice(w, i + 1, 3), " ").alias("t"), i.alias("i"))))
        equal = lambda s: F.filter(F.transform(s, lambda x, i: F.when((i > 0) & (x["t"] == F.get(s, i - 1)["t"]), F.struct(F.get(s, i - 1)["i"].alias("a"), x["i"].alias("b")))), lambda p: p.isNotNull())
        return both(_with(s, equal))

    def marks(s: Column) -> Column:
        # both members of each equal adjacent pair
        met = F.transform(s, lambda x, i: F.when((i > 0) & (key(x) == key(F.get(s, i - 1))), F.struct(place(F.get(s, i - 1)).alias("a"), place(x).alias("b"))))
        return _with(F.filter(met, lambda p: p.isNotNull()), lambda found: F.when(F.forall(found, lambda p: same(p["a"], p["b"])), both(found)).otherwise(by_text()))

    # a window covers its word and the two after it, as far as the next marked window
    covered = lambda m: F.aggregate(F.transform(m, lambda p, i: F.when(i + 1 < F.size(m), F.least(F.lit(3), F.get(m, i + 1) - p)).otherwise(F.lit(3))), F.lit(0), lambda a, x: a + x)
    counted = _with(F.sort_array(packed), lambda s: _with(marks(s), covered))
    distinct = F.size(F.array_distinct(F.transform(packed, key))) == n - 2
    return F.when(n < 4, F.lit(0)).when(distinct, F.lit(0)).otherwise(counted)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long; columns of
    these names are replaced, others stay). Null and empty texts have zeros."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    w, found = unused(df, "words"), unused(df, "lines")
    count = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    out = df.withColumns({w: words(F.col(text_col)), found: F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)})
    longs = {
        "n_words": F.size(w),
        "word_chars": F.length(text) - count(SPACES),
        "n_symbols": count(SYMBOLS),
        "n_lines": F.size(found),
        "n_dup_lines": F.size(found) - F.size(F.array_distinct(found)),
        "n_repeat_words": _repeated_words(F.col(w)),
    }
    return out.withColumns({k: v.cast("long") for k, v in longs.items()}).drop(w, found)


def _vector() -> dict[str, Column]:
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    unbounded = lambda x: -F.log(F.greatest(F.lit(1.0) - x, F.lit(1e-6)))
    raw = {
        "word_length": F.log1p(F.when(F.col("n_words") > 0, F.col("word_chars") / F.col("n_words")).otherwise(0.0)),
        "symbols": F.sqrt(share("n_symbols", "word_chars")),
        "repeated_lines": unbounded(share("n_dup_lines", "n_lines")),
        "repeated_words": unbounded(share("n_repeat_words", "n_words") / MOST_REPEATED),
    }
    return {f"z_{k}": F.least(F.round(v * SCALE), F.lit(TOP)).cast("long") for k, v in raw.items()}


def _pairs() -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(DIMS) for b in DIMS[i:]]


def _cholesky(cov: dict[tuple[str, str], Column]) -> dict[str, Column]:
    """Columns l_a_b of the lower factor of a covariance matrix, in an order in which each can use those before."""
    made: dict[str, Column] = {}
    at = lambda a, b: F.col(f"l_{a}_{b}")
    for i, a in enumerate(DIMS):
        for j, b in enumerate(DIMS[: i + 1]):
            rest = cov[(b, a)]
            for c in DIMS[:j]:
                rest = rest - at(a, c) * at(b, c)
            made[f"l_{a}_{b}"] = F.sqrt(F.greatest(rest, F.lit(1e-9))) if a == b else rest / at(b, b)
    return made


def _distance() -> Column:
    """Squared Mahalanobis distance of the row's vector from the group's m_* by the group's factor l_*_*, by forward substitution."""
    solved: list[Column] = []
    for i, a in enumerate(DIMS):
        rest = F.col(f"z_{a}") / SCALE - F.col(f"m_{a}")
        for j, b in enumerate(DIMS[:i]):
            rest = rest - F.col(f"l_{a}_{b}") * solved[j]
        solved.append(rest / F.col(f"l_{a}_{a}"))
    return sum((x * x for x in solved[1:]), solved[0] * solved[0])


def _with_factor(stats: DataFrame, cov: dict[tuple[str, str], Column]) -> DataFrame:
    """stats with the factor of each row's matrix and the logarithm of its determinant."""
    for name, value in _cholesky(cov).items():
        stats = stats.withColumn(name, value)
    det = sum((2 * F.log(f"l_{a}_{a}") for a in DIMS), F.lit(0.0))
    return stats.select(*KEYS, *[f"m_{a}" for a in DIMS], *[f"l_{a}_{b}" for i, a in enumerate(DIMS) for b in DIMS[: i + 1]], det.alias("det"))


def _small(df: DataFrame, label: str) -> DataFrame:
    """A table with a few rows for each group, written once; broadcast only while its size allows, else joined by shuffle."""
    table = written(df, label)
    return F.broadcast(table) if table.count() <= BROADCAST_GROUPS else table


def _starts(rows: DataFrame) -> DataFrame:
    """Four first estimates of each group: medians with the coordinates' median deviations alone, with the
    correlations of their hyperbolic tangents, with those of their spatial signs; and plain mean and covariance."""
    mid = _small(rows.groupBy("g").agg(*[F.expr(f"percentile(z_{a}, 0.5, c)").alias(f"m_{a}") for a in DIMS]), "median")
    away = rows.join(mid, "g").groupBy("g").agg(*[F.max(f"m_{a}").alias(f"m_{a}") for a in DIMS], *[F.expr(f"percentile(abs(z_{a} - m_{a}), 0.5, c)").alias(f"d_{a}") for a in DIMS])
    scales = _small(away.select("g", *[(F.col(f"m_{a}") / SCALE).alias(f"m_{a}") for a in DIMS], *[F.greatest(F.lit(FLOOR[a]), 1.4826 * F.col(f"d_{a}") / SCALE).alias(f"s_{a}") for a in DIMS]), "scales")
    scaled = rows.join(scales, "g").withColumns({f"y_{a}": (F.col(f"z_{a}") / SCALE - F.col(f"m_{a}")) / F.col(f"s_{a}") for a in DIMS})
    norm = F.sqrt(F.greatest(sum((F.col(f"y_{a}") * F.col(f"y_{a}") for a in DIMS), F.lit(0.0)), F.lit(1e-12)))
    # in fixed point, so that sums don't depend on the order of rows
    forms = {"tanh": lambda c: F.round(F.tanh(c) * 4096), "sign": lambda c: F.round(c / norm * 4096), "plain": lambda c: F.round(c * SCALE)}
    cut = {f"{k}_{a}": form(F.col(f"y_{a}")).cast("long") for k, form in forms.items() for a in DIMS}
    sums = scaled.select("g", "c", *[v.alias(k) for k, v in cut.items()]).groupBy("g").agg(
        F.sum("c").alias("n"), *[F.sum(F.col("c") * F.col(f"plain_{a}")).alias(f"t_{a}") for a in DIMS], *[F.sum(F.col("c") * F.col(f"{k}_{a}") * F.col(f"{k}_{b}")).alias(f"{k}_{a}_{b}") for k in forms for a, b in _pairs()]
    )
    known = _small(sums, "sums")
    each = scales.join(known, "g").withColumn("start", F.explode(F.array(*map(F.lit, range(4)))))
    s = lambda a, b: F.col(f"s_{a}") * F.col(f"s_{b}")
    root = lambda k, a: F.sqrt(F.greatest(F.col(f"{k}_{a}_{a}").cast("double"), F.lit(1.0)))
    cov = {}
    for a, b in _pairs():
        if a == b:
            like = {0: s(a, a), 1: s(a, a), 2: s(a, a)}
        else:
            like = {0: F.lit(0.0)} | {k: 0.99 * s(a, b) * F.col(f"{form}_{a}_{b}") / (root(form, a) * root(form, b)) for k, form in ((1, "tanh"), (2, "sign"))}
        plain = s(a, b) * (F.col(f"plain_{a}_{b}") / F.col("n") - F.col(f"t_{a}") / F.col("n") * (F.col(f"t_{b}") / F.col("n"))) / SCALE / SCALE + (FLOOR[a] ** 2 if a == b else 0.0)
        cov[a, b] = F.when(F.col("start") == 3, plain).when(F.col("start") == 0, like[0]).when(F.col("start") == 1, like[1]).otherwise(like[2])
    mean = {f"m_{a}": F.col(f"m_{a}") + F.when(F.col("start") == 3, F.col(f"s_{a}") * F.col(f"t_{a}") / F.col("n") / SCALE).otherwise(0.0) for a in DIMS}
    return _with_factor(each.withColumns(mean), cov)


def _step(rows: DataFrame, stats: DataFrame, share: float, consistency: float) -> DataFrame:
    """A concentration step: mean and covariance of the rows within the `share` quantile of the distance."""
    # distances in 1,024 steps of their logarithm: all rows of a step are in or out together
    near = rows.join(stats, "g").withColumn("bin", F.least(F.lit(1023), F.floor(F.log1p(_distance()) * 64)).cast("int")).select(*KEYS, "bin", "c", *[f"z_{a}" for a in DIMS])
    limit = _small(near.groupBy(*KEYS).agg(F.ceil(F.expr(f"percentile(bin, {share}, c)")).alias("limit")), "limit")
    core = near.join(limit, list(KEYS)).where("bin <= limit")
    sums = core.groupBy(*KEYS).agg(F.sum("c").alias("n"), *[F.sum(F.col("c") * F.col(f"z_{a}")).alias(f"s_{a}") for a in DIMS], *[F.sum(F.col("c") * F.col(f"z_{a}") * F.col(f"z_{b}")).alias(f"p_{a}_{b}") for a, b in _pairs()])
    mean = sums.withColumns({f"m_{a}": F.col(f"s_{a}") / F.col("n") / SCALE for a in DIMS})
    cov = {(a, b): consistency * (F.col(f"p_{a}_{b}") / F.col("n") / SCALE / SCALE - F.col(f"m_{a}") * F.col(f"m_{b}")) + (FLOOR[a] ** 2 if a == b else 0.0) for a, b in _pairs()}
    return _with_factor(mean, cov)


def _least(stats: DataFrame, keep: int) -> DataFrame:
    """Of each group the `keep` estimates of least determinant."""
    return stats.withColumn("place", F.row_number().over(Window.partitionBy("g").orderBy("det", "start"))).where(F.col("place") <= keep).drop("place")


def robust_estimates(rows: DataFrame, share: float = 0.5, most_steps: int = 20) -> DataFrame:
    """One row for each group g (share: a key of CONSISTENCY): m_*, the factor l_*_* of the regularised
    estimate and det, the logarithm of its determinant. rows: g and z_*.

    Each of four starts makes two concentration steps; the two of least determinant go on until no
    determinant gets smaller (or for `most_steps`), and the least of all remains."""
    zs = [f"z_{a}" for a in DIMS]
    rows = written(rows.groupBy("g", *zs).agg(F.count("*").alias("c")), "vectors")
    stats = _small(_starts(rows), "mcd")
    for _ in range(2):
        stats = _small(_step(rows, stats, share, CONSISTENCY[share]), "mcd")
    stats = _small(_least(stats, 2), "mcd")
    done = None
    for _ in range(most_steps):
        then = _step(rows, stats, share, CONSISTENCY[share])
        old = stats.select(*KEYS, F.col("det").alias("before"))
        # all rows of a distance step go together, so a determinant may rise: the smaller one stays
        then = _small(then.join(old, list(KEYS)), "mcd")
        better = F.col("det") < F.col("before") - SETTLED
        stay = stats.join(then.where(~better).select(*KEYS), list(KEYS), "semi")
        done = _small(stay if done is None else done.unionByName(stay), "mcd")
        # only estimates that still move go on
        stats = _small(then.where(better).drop("before"), "mcd")
        if not stats.limit(1).count():
            break
    stats = stats if done is None else done.unionByName(stats)
    return _small(_least(stats, 1).drop("start"), "mcd")


def _drawn(est: DataFrame, sizes: DataFrame, to: DataFrame, prior: int) -> DataFrame:
    """Estimates drawn towards others. est and to: g, m_* and l_*_*; sizes: g, parent (a g of `to`) and n."""
    factor = lambda a, b: F.col(f"l_{a}_{b}")
    up_to = lambda a: DIMS[: DIMS.index(a) + 1]
    cov = {(a, b): sum((factor(a, k) * factor(b, k) for k in up_to(a)), F.lit(0.0)) for a, b in _pairs()}
    parents = to.select(F.col("g").alias("parent"), *[F.col(f"m_{a}").alias(f"pm_{a}") for a in DIMS], *[v.alias(f"p_{a}_{b}") for (a, b), v in cov.items()])
    both = est.join(_small(sizes, "sizes"), "g").join(_small(parents, "parents"), "parent").withColumn("own", F.col("n") / (F.col("n") + prior))
    mixed = lambda x, y: F.col("own") * x + (1 - F.col("own")) * y
    both = both.select("g", F.lit(0).alias("start"), *[mixed(F.col(f"m_{a}"), F.col(f"pm_{a}")).alias(f"m_{a}") for a in DIMS], *[mixed(v, F.col(f"p_{a}_{b}")).alias(f"c_{a}_{b}") for (a, b), v in cov.items()])
    return _small(_with_factor(both, {k: F.col(f"c_{k[0]}_{k[1]}") for k in cov}).drop("start"), "drawn")


def quality_rules(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", prior: int = 20, share: float = 0.5, most_steps: int = 20, cutoff: float = CUTOFF, keep_text: bool = True) -> DataFrame:
    """df with the statistics, base_failed, distance (squared) and kept; columns of these names are
    replaced, others stay, whatever their names. keep_text=False leaves the text out.

    base_failed: under 50 words, or over half of the words repeated. kept: not base_failed, and a distance
    of at most `cutoff`. Rows that failed the base don't enter the estimates. Null languages and sources
    are groups of their own. Empty tables give no rows; equal rows get equal verdicts.
    """
    name = lambda *cols: F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in cols])
    own = others(df, *MADE, *([] if keep_text else [text_col]))
    # the caller's columns travel in one column, so that none meets a working name
    rows = df.select(F.struct(*own).alias("row"), F.col(text_col).alias("text"), name(lang_col).alias("lang"), name(lang_col, source_col).alias("pair"))
    stats = text_statistics(rows).withColumn("hash", F.xxhash64("text")).drop("text")
    stats = stats.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).withColumns(_vector())
    # the statistics are the costly part: they are computed once
    stats = written(stats, "quality")
    zs = [f"z_{a}" for a in DIMS]
    good = stats.where(~F.col("base_failed"))
    named = lambda level, key: F.concat(F.lit(f"{level} "), key)
    levels = good.select(F.explode(F.array(F.struct(named("pair", F.col("pair")).alias("g"), named("lang", F.col("lang")).alias("parent")), F.struct(named("lang", F.col("lang")).alias("g"), F.lit("all").alias("parent")), F.struct(F.lit("all").alias("g"), F.lit(None).cast("string").alias("parent")))).alias("x"), "hash", *zs)
    levels = written(levels.select("x.*", "hash", *zs).distinct().drop("hash"), "levels")
    sizes = written(levels.groupBy("g", "parent").agg(F.count("*").alias("n")), "sizes")
    est = robust_estimates(levels.select("g", *zs), share, most_steps)
    of = lambda level: est.where(F.col("g").startswith(level))
    all_ = of("all")
    langs = _drawn(of("lang "), sizes.where("g like 'lang %'"), all_, prior)
    pairs = _drawn(of("pair "), sizes.where("g like 'pair %'"), langs, prior)
    est = _small(pairs.unionByName(langs).unionByName(all_.select(*pairs.columns)), "estimates")
    return _judged(stats, est, cutoff).select(*[F.col("row").getField(c).alias(c) for c in own], *MADE)


def _judged(stats: DataFrame, est: DataFrame, cutoff: float) -> DataFrame:
    """Each row by the estimate of its language and source; a row that failed the base may lack one."""
    values = [c for c in est.columns if c != "g"]
    side = est.select(F.col("g").alias("of"), F.struct(*values).alias("e"))
    stats = stats.join(side, F.concat(F.lit("pair "), "pair") == F.col("of"), "left").drop("of")
    out = stats.withColumns({c: F.col(f"e.{c}") for c in values}).withColumn("distance", _distance())
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff))


#: The columns that quality_rules makes.
MADE = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept")
#: An estimate's group and start.
KEYS = ("g", "start")
OUTPUT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_quality_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return quality_rules(docs, keep_text=False).select(*OUTPUT)
