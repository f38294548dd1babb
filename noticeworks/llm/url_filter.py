"""URL filters: a cascade of Bloom filters that answers membership exactly, without joins.

Level 1 encodes the listed keys. Level 2 encodes the corpus's keys that level 1 lets through by
mistake, level 3 the listed keys that level 2 lets through, and so on until a level makes no
mistake over the complete key universe (the listed keys and every key of the corpus). A key is
then listed when the first level that rejects it is an even one. Only keys that level 1 lets
through are ever shuffled: the listed ones and a small share of false positives.

The bits are computed by Spark, and their number is known from counts before anything is fetched.
A list that needs more than `max_filter_bits` isn't sent to the executors: membership then comes
from a shuffled join of the distinct keys, with the same result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticeworks.llm.shared import ascii_lower, unused, written

RULES_SCHEMA = "host string, path string, verdict string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?` or `#`, A-Z lower-cased; path: from there up to `?`
    or `#`. A null url, or one without `://`, has an empty host and an empty path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _bits(key: Column, level: int, hashes: int, size: int) -> Column:
    """Places of a key's bits. The level comes before the key, so that keys that meet in one level part in the next."""
    own = F.concat(F.lit(f"{level}|"), key)
    return F.array(*[F.pmod(F.xxhash64(own, F.lit(i)), F.lit(size)) for i in range(hashes)])


#: Each level lets a small share of the other side's keys through; so many aren't reached with any sensible filter.
MOST_LEVELS = 100


class BloomLevel:
    """One Bloom filter: `size` bits in 64-bit words, kept as a constant of the plan."""

    def __init__(self, keys: DataFrame, n: int, level: int, bits_per_key: int):
        self.level, self.size = level, 64 * max(1, math.ceil(bits_per_key * n / 64))
        self.hashes = max(1, round(0.69 * bits_per_key))
        at = keys.select(F.explode(_bits(F.col("key"), level, self.hashes, self.size)).alias("b"))
        found = at.groupBy(F.expr("cast(b div 64 as int)").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("v"))
        words = ["0"] * (self.size // 64)
        for w, v in found.collect():  # at most size / 64 rows
            words[w] = str(v)
        self.words = ",".join(words)

    def lets_through(self, key: Column) -> Column:
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")  # folded to one constant
        hit = lambda b: F.get(words, F.shiftright(b, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), (b % 64).cast("int"))) != 0
        # a null key has null bits
        return F.when(key.isNotNull(), F.forall(_bits(key, self.level, self.hashes, self.size), hit))


class BloomCascade:
    """Exact membership of `key` in `listed` for every key of `universe` (one string column each)."""

    def __init__(self, listed: DataFrame, universe: DataFrame, bits_per_key: int = 12):
        listed = listed.select(F.col(listed.columns[0]).alias("key")).where("key is not null").distinct()
        universe = universe.select(F.col(universe.columns[0]).alias("key")).where("key is not null")
        self.levels: list[BloomLevel] = []
        if not (n := listed.count()):
            return
        self.levels.append(BloomLevel(listed, n, 1, bits_per_key))
        passed = universe.where(self.levels[0].lets_through(F.col("key")))
        both = listed.withColumn("listed", F.lit(1)).unionByName(passed.withColumn("listed", F.lit(0)))
        marked = written(both.groupBy("key").agg(F.max("listed").alias("listed")), "cascade")
        sides = {1: marked.where("listed = 1").select("key"), 0: marked.where("listed = 0").select("key")}
        while len(self.levels) < MOST_LEVELS:
            turn = len(self.levels) % 2  # after an odd level, the false positives are keys that aren't listed
            side = 0 if turn else 1
            sides[side] = sides[side] if len(self.levels) == 1 else sides[side].where(self.levels[-1].lets_through(F.col("key")))
            if not (n := sides[side].count()):
                return
            self.levels.append(BloomLevel(sides[side], n, len(self.levels) + 1, bits_per_key))
        raise RuntimeError(f"{MOST_LEVELS} levels leave mistakes at {bits_per_key} bits for each key")

    def contains(self, key: Column) -> Column:
        member = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels), 0, -1):
            member = F.when(F.coalesce(self.levels[k - 1].lets_through(key), F.lit(False)), member).otherwise(F.lit(k % 2 == 0))
        return F.coalesce(member, F.lit(False)) & key.isNotNull()


def _candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys that a rule could have: the last `labels` labels of the host and the first `length` characters of the path."""
    labels = F.split(host, r"\.", -1)
    made = [F.when((F.size(labels) >= n) & (F.length(path) >= size), F.struct(F.array_join(F.slice(labels, -n, n), ".").alias("h"), F.substring(path, 1, size).alias("p"))) for n, size in shapes]
    return F.array_compact(F.array(*made)) if made else F.array().cast("array<struct<h:string,p:string>>")


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", bits_per_key: int = 12, max_filter_bits: int = 1 << 24) -> DataFrame:
    """`pages` with host, path, rule and verdict (columns of these names are replaced; all others stay).

    A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with the
    rule's path. The longest rule string wins, then the longer host; a rule listed both as allow and as
    block blocks. A url that fits no listed rule gets `default`. Null rules and null urls fit nothing;
    repeated rules count once; rules with another verdict than allow or block, or none, fit nothing. An empty list or table gives
    `default` or no rows. Lists beyond max_filter_bits are joined by shuffle instead, by the same rules.
    """
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").where("host is not null and path is not null and verdict in ('allow', 'block')")
    shapes = [(r.labels, r.size) for r in rules.select(F.size(F.split("host", r"\.", -1)).alias("labels"), F.length("path").alias("size")).distinct().collect()]
    host, path = host_and_path(F.col(url_col))
    clear = pages.drop(*[c for c in pages.columns if c.lower() in ("host", "path", "rule", "verdict") and c != url_col])
    seen = clear.withColumns({"host": host, "path": path})
    listed = {v: rules.where(F.col("verdict") == v).select(F.concat("host", "path").alias("key")) for v in ("block", "allow")}
    keys = _candidates(F.col("host"), F.col("path"), sorted(shapes))
    if rules.count() * bits_per_key > max_filter_bits:
        return _by_join(seen, rules, keys, default)
    universe = pages.select(host.alias("host"), path.alias("path")).select(F.explode(F.transform(keys, lambda k: F.concat(k.h, k.p))).alias("key"))
    cascades = {v: BloomCascade(k, universe, bits_per_key) for v, k in listed.items()}
    verdict = lambda k: F.when(cascades["block"].contains(k), F.lit("block")).when(cascades["allow"].contains(k), F.lit("allow"))
    hits = F.transform(keys, lambda k: F.struct(F.length(F.concat(k.h, k.p)).alias("n"), F.length(k.h).alias("nh"), F.concat(k.h, k.p).alias("rule"), verdict(F.concat(k.h, k.p)).alias("verdict")))
    best = F.array_max(F.filter(hits, lambda x: x.verdict.isNotNull()))
    b = unused(seen, "best")
    return seen.withColumn(b, best).withColumns({"rule": F.col(f"{b}.rule"), "verdict": F.coalesce(f"{b}.verdict", F.lit(default))}).drop(b)


def _by_join(seen: DataFrame, rules: DataFrame, keys: Column, default: str) -> DataFrame:
    """The way for lists beyond the filter's size bound: distinct (host, path) pairs are matched by a shuffled join."""
    b = unused(seen, "best")
    pairs = seen.select("host", "path").distinct().withColumn("k", F.explode(keys))
    one = rules.groupBy(F.concat("host", "path").alias("rule")).agg(F.max("verdict").alias("v"))  # "block" is above "allow"
    fits = pairs.withColumn("rule", F.concat("k.h", "k.p")).join(one, "rule")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), F.length("k.h").alias("nh"), "rule", "v")).alias(b))
    out = seen.join(best, ["host", "path"], "left")
    return out.withColumns({"rule": F.col(f"{b}.rule"), "verdict": F.coalesce(f"{b}.v", F.lit(default))}).select(*seen.columns, "rule", "verdict")


#: The rules of the registered query.
RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def op1_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(RULES, T.StructType.fromDDL(RULES_SCHEMA))
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = r"""
with cut as (
    select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), parts as (
    select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from cut
), rules(rhost, rpath, v) as (
    values ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), fits as (
    select page_id, host, path, rhost || rpath as rule, v,
           row_number() over (partition by page_id order by length(rhost || rpath) desc nulls last) as rn
    from parts left join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from fits where rn = 1
"""
