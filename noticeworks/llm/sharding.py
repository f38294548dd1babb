"""Sharding by a k-d tree over document metadata.

A node that is to become k shards is cut along its widest metadata dimension where ceil(k / 2) / k of
its bytes lie, until every leaf is one shard; a leaf then holds the target bytes. The dimensions are the
logarithm of the size, the language and the source. Their coordinates are shares of all bytes: sizes stand
in ascending and names in descending order of their bytes, and a coordinate is the share of bytes before
it and half of its own, in 16 bits. The width of a node is thus the share of the corpus that its range spans.

Equal texts (CRC-32 and size) are one group: all its rows have the metadata of its smallest id, and behind the
coordinate a row's key has the CRC and a hash of its id. Where both ends of a group that a cut falls on are too
far from the goal, it is pinned whole to one side and the cut is sought again without it; only a group that outweighs
`whole` of a shard is cut, by ids.

The weighted medians are found by Spark: a histogram of bytes over 65,536 steps of the key, then of the
one step where the cut lies, until that step weighs little. The driver holds the tree: a few numbers for
each shard. Rows get a node number; no rows are sorted or moved for it. Slots are numbered within hash
buckets of a shard and shifted by the sums of the buckets before, so no task holds a whole shard.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from noticeworks.llm.shared import others, written

#: Bits of the key: coordinate, CRC-32, id hash; and of one histogram.
DIM_BITS, CRC_BITS, ID_BITS, STEP_BITS = 16, 32, 15, 16
KEY_BITS = DIM_BITS + CRC_BITS + ID_BITS
#: A group with this share of all rows is broadcast (there are at most 1 / HEAVY of them); up to so many others are, too.
HEAVY, BROADCAST_GROUPS = 0.001, 200_000
#: After so many pins a node is cut beside the group that the cut falls on (in tables of few texts).
PINS = 3


@dataclass
class Node:
    shards: int
    first: int
    dim: int = 0
    cut: int | None = None  # rows with a lower key go left
    left: int = 0
    right: int = 0
    pins: dict[int, bool] = field(default_factory=dict)  # CRC -> whether its group goes left


def _shift(value: Column, bits: int) -> Column:
    return F.call_function("shiftleft", value.cast("long"), F.lit(bits))


def _by_node(nodes: dict[int, object], default: object, node: Column | None = None) -> Column:
    """A literal table from node number to value."""
    as_sql = lambda x: f"{x!r}D" if isinstance(x, float) else f"{x}L" if isinstance(x, int) and x.bit_length() > 31 else str(x)
    whole = all(isinstance(x, int) for x in nodes.values()) and any(x.bit_length() > 31 for x in nodes.values())
    table = F.expr("map(" + ", ".join(f"{n}, {f'{x}L' if whole else as_sql(x)}" for n, x in nodes.items()) + ")")
    return F.coalesce(F.element_at(table, F.col("node") if node is None else node), F.lit(default))


def _pinned(nodes: dict[int, Node], left: bool, node: Column | None = None) -> Column:
    """Whether the row's group is pinned to that side of its node."""
    at = F.col("node") if node is None else node
    out = F.lit(False)
    for n, found in nodes.items():
        if crcs := [c for c, side in found.pins.items() if side == left]:
            out = out | ((at == n) & F.expr(f"crc in ({', '.join(f'{c}L' for c in crcs)})"))
    return out


def _key(nodes: dict[int, Node], node: Column | None = None) -> Column:
    dim = _by_node({n: x.dim for n, x in nodes.items()}, 0, node)
    key = _shift(F.get(F.col("dims"), dim), CRC_BITS + ID_BITS).bitwiseOR(_shift(F.col("crc"), ID_BITS)).bitwiseOR(F.col("idh"))
    return F.when(_pinned(nodes, True, node), F.lit(-1)).when(_pinned(nodes, False, node), F.lit((1 << KEY_BITS) - 1)).otherwise(key)


def _nearer(step: Row, goal: float) -> int:
    """The end of the step that lies nearer to the goal."""
    return step["bin"] if 2 * goal < 2 * step["upto"] - step["w"] else step["bin"] + 1


def _cuts(rows: DataFrame, nodes: list[Node], open_: list[int], dims: int, tolerance: float, most: float) -> None:
    """Sets dim, pins and cut of the open nodes. most: the bytes up to which a group stays whole."""
    extents = rows.where(F.col("node").isin(open_)).groupBy("node").agg(F.sum("size").alias("all"), *[(F.max(F.get("dims", F.lit(d))) - F.min(F.get("dims", F.lit(d)))).alias(f"w{d}") for d in range(dims)]).collect()
    total = {r["node"]: r["all"] for r in extents}
    for r in extents:
        widths = [r[f"w{d}"] for d in range(dims)]
        nodes[r["node"]].dim = widths.index(max(widths))
    goals = {n: total[n] * nodes[n].left / nodes[n].shards for n in total}
    before, behind = dict.fromkeys(total, 0), dict.fromkeys(total, 0)  # bytes pinned to the left and to the right
    seek = {n: (0, 0, KEY_BITS) for n in total}  # key prefix, bytes before it, bits below it
    while seek:
        now, steps = seek, {n: below - min(STEP_BITS, below) for n, (_, _, below) in seek.items()}
        of_node = lambda k: _by_node({n: x[k] for n, x in now.items()}, 0)  # noqa: B023, E731
        shifted = lambda bits: F.call_function("shiftright", F.col("key"), bits)
        keyed = rows.where(F.col("node").isin(list(now))).select("node", "size", _key({n: nodes[n] for n in now}).alias("key"))
        inside = keyed.where(shifted(of_node(2)) == of_node(0).cast("long"))
        bins = inside.groupBy("node", shifted(_by_node(steps, 0)).alias("bin")).agg(F.sum("size").alias("w"))
        cum = bins.withColumn("upto", F.sum("w").over(Window.partitionBy("node").orderBy("bin")) + of_node(1).cast("long"))
        cross = cum.where(F.col("upto") >= _by_node({n: goals[n] for n in now}, 0.0)).groupBy("node").agg(F.min(F.struct("bin", "w", "upto")).alias("c")).select("node", "c.*").collect()
        seek = {}
        for r in cross:
            n, low, start = r["node"], steps[r["node"]], r["upto"] - r["w"]
            if low and r["w"] > tolerance * total[n]:
                left, right = before[n] + r["w"] <= goals[n], behind[n] + r["w"] <= total[n] - goals[n]
                if low == ID_BITS and r["w"] <= most and (left or right):  # the step is one group, which fits on a side
                    if len(nodes[n].pins) >= PINS or min(goals[n] - start, r["upto"] - goals[n]) <= tolerance * total[n]:
                        nodes[n].cut = _nearer(r, goals[n]) << low
                        continue
                    nodes[n].pins[r["bin"] & ((1 << CRC_BITS) - 1)] = left
                    (before if left else behind)[n] += r["w"]
                    seek[n] = (0, before[n], KEY_BITS)
                else:
                    seek[n] = (r["bin"], start, low)
            else:
                nodes[n].cut = _nearer(r, goals[n]) << low


def _groups(rows: DataFrame) -> DataFrame:
    """(of, bytes, n, several, given): each group's rows, whether its names differ, and the names of its smallest id."""
    pairs = rows.groupBy("crc", "size", "names").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    groups = pairs.groupBy("crc", "size").agg(F.sum("n").alias("n"), F.count("*").alias("several"), F.min(F.struct("id", "names")).alias("least"))
    return written(groups.select(F.col("crc").alias("of"), F.col("size").alias("bytes"), "n", "several", F.col("least.names").alias("given")), "groups")


def _with_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows with the names of their group; groups of many rows are broadcast, so that none of them gathers in one task."""
    all_ = groups.agg(F.sum("n")).first()[0] or 0
    heavy = groups.where(F.col("n") >= HEAVY * all_)
    few = groups.where((F.col("n") < HEAVY * all_) & (F.col("several") > 1))

    def named(df: DataFrame, other: DataFrame) -> DataFrame:
        return df.join(other.select("of", "bytes", "given"), (F.col("crc") == F.col("of")) & (F.col("size") == F.col("bytes")), "left").withColumn("names", F.coalesce("given", "names"))

    working = ("of", "bytes", "given")
    if few.count() <= BROADCAST_GROUPS:
        return named(rows, F.broadcast(heavy.unionByName(few))).drop(*working)
    first = named(rows, F.broadcast(heavy))
    rest = named(first.where("given is null").drop(*working), few)
    return first.where("given is not null").unionByName(rest).drop(*working)


def _with_coordinates(rows: DataFrame, dims: int) -> DataFrame:
    """rows with dims, from the 16-bit names: the size's logarithm in steps of 1/1,024 and a hash of each other name.
    The tables of coordinates have at most 65,536 rows for each dimension."""
    log = F.least(F.lit((1 << DIM_BITS) - 1), F.floor(F.log2(F.col("size").cast("double")) * 1024)).cast("int")
    rows = rows.withColumn("names", F.concat(F.array(log), "names"))
    steps = written(rows.select("size", F.posexplode("names").alias("dim", "name")).groupBy("dim", "name").agg(F.sum("size").alias("w")), "steps")
    # sizes by size, names by weight
    line = Window.partitionBy("dim").orderBy(F.when(F.col("dim") == 0, F.lit(0)).otherwise(-F.col("w")), "name")
    share = (F.sum("w").over(line) - F.col("w") / 2) / F.sum("w").over(Window.partitionBy("dim"))
    placed = written(steps.select("dim", "name", F.floor(share * ((1 << DIM_BITS) - 1)).cast("int").alias("place")), "places")
    for d in range(dims):
        side = placed.where(F.col("dim") == d).select(F.col("name"), F.col("place").alias(f"place{d}"))
        rows = rows.join(F.broadcast(side), F.get("names", F.lit(d)) == F.col("name")).drop("name")
    return rows.withColumn("dims", F.array(*[F.col(f"place{d}") for d in range(dims)])).drop("names", *[f"place{d}" for d in range(dims)])


def shard_by_kd_tree(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", dim_cols: tuple[str, ...] = ("lang", "source"), tolerance: float = 0.002, bucket_rows: int = 2000, keep_text: bool = True, whole: float = 0.9) -> DataFrame:
    """docs with size (UTF-8 bytes of the text plus 8), text_crc32, shard (from 0) and slot (from 0, without
    gaps in each shard); columns of these names are replaced. keep_text=False leaves the text out.

    Equal texts share a shard, whatever their other columns, unless all of them together weigh more than `whole`
    of a shard or too much for the rest of a node. Null texts count as empty; null languages and sources are
    names of their own. Where texts are few and long, shards are as near equal as whole documents allow, and
    some may be empty. Equal rows get neighbouring slots in any order; an empty table gives no rows. Other
    columns stay, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = lambda c: F.pmod(F.xxhash64(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))), F.lit(1 << DIM_BITS)).cast("int")
    made = ("size", "text_crc32", "shard", "slot")
    own = others(docs, *made, *([] if keep_text else [text_col]))
    # the caller's columns travel in one column, so that none meets a working name
    meta = docs.select(
        F.struct(*own).alias("row"), F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        F.array(*[name(c) for c in dim_cols]).cast("array<int>").alias("names"), F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << ID_BITS)).alias("idh"),
    )
    if not keep_text:
        meta = written(meta, "sizes")
    slim = meta.drop("row")
    slim = slim if not keep_text else written(slim, "sizes")
    dims = 1 + len(dim_cols)
    with_dims = lambda df: _with_coordinates(_with_group(df, groups), dims)
    groups = _groups(slim)
    slim = written(with_dims(slim).select("size", "dims", "crc", "idh"), "metadata")

    nodes, open_ = [Node(shards, 0)], [0]
    if shards < 2:
        open_ = []
    most = whole * (slim.agg(F.sum("size")).first()[0] or 0) / shards
    routed = slim.withColumn("node", F.lit(0))
    rounds: list[list[int]] = []
    while open_:
        for n in open_:
            nodes[n].left = nodes[n].shards // 2
        _cuts(routed, nodes, open_, dims, tolerance, most)
        rounds.append(open_)
        after = []
        for n in open_:
            half = nodes[n]
            if half.cut is None:  # a node without rows, or with pinned ones only
                half.cut = 0
            count = half.left
            half.left, half.right = len(nodes), len(nodes) + 1
            nodes += [Node(count, half.first), Node(half.shards - count, half.first + count)]
            after += [i for i in (half.left, half.right) if nodes[i].shards > 1]
        # a small table for each level, so that the next one's plans stay small
        routed, open_ = written(_route(routed, nodes, rounds[-1:]), "level"), after

    placed = _route(with_dims(meta), nodes, rounds)
    leaves = {i: n.first for i, n in enumerate(nodes) if n.shards == 1}
    return _with_slots(placed.withColumn("shard", _by_node(leaves, 0).cast("int")), own, shards, bucket_rows)


def _route(meta: DataFrame, nodes: list[Node], rounds: list[list[int]]) -> DataFrame:
    """meta with each row's node after the rounds. A lambda binds the node of each round, so that the
    expression grows with the number of rounds and not with its power."""
    at = F.col("node") if "node" in meta.columns else F.lit(0)
    for cut in rounds:

        def go(node: Column) -> Column:
            by = lambda f, d: _by_node({n: f(nodes[n]) for n in cut}, d, node)
            # a node that isn't cut in this round stays
            low = _key({n: nodes[n] for n in cut}, node) < by(lambda x: x.cut, 0).cast("long")
            return F.when(by(lambda x: x.left, -1) < 0, node).when(low, by(lambda x: x.left, -1)).otherwise(by(lambda x: x.right, -1))

        at = F.get(F.transform(F.array(at), go), F.lit(0))
    return meta.withColumn("node", at)


def _with_slots(placed: DataFrame, own: list[str], shards: int, bucket_rows: int) -> DataFrame:
    placed = written(placed.select("row", "id", "size", "crc", "shard"), "placed")
    buckets = max(1, min(4096, -(-placed.count() // (shards * bucket_rows))))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("id", "crc"), F.lit(buckets)).cast("int"))
    sums = placed.groupBy("shard", "bucket").count()  # at most shards * 4,096 rows
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("shard", "bucket").orderBy("crc", "id", "size")
    numbered = placed.withColumn("no", F.row_number().over(within)).join(F.broadcast(shifts), ["shard", "bucket"])
    return numbered.select(*[F.col("row").getField(c).alias(c) for c in own], "size", F.col("crc").alias("text_crc32"), "shard", (F.col("shift") + F.col("no") - 1).cast("long").alias("slot"))


def op9_kd_shards(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    out = shard_by_kd_tree(docs, keep_text=False)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
