"""K-d tree sharding with native Spark operations.

Rows are put into shards of near equal bytes. Equal texts form a group and stay together;
a node of the tree is split at the weighted median of its widest metadata dimension.
Medians are exact to a given share of a shard: each round counts bytes in a fixed number
of buckets between two bounds, for all nodes of a level in one job, and narrows the bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.common import stored, text_of

COORD_BITS, TIE_BITS = 20, 42
BUCKETS = 2048
# A group heavier than this share of a shard is placed before the tree is built. There
# are at most HEAVY * shards of them, which bounds what the driver handles.
HEAVY = 50
# Bytes that a split may be off, as a share of a shard.
TOLERANCE = 0.0005
ROWS_PER_SLOT_BUCKET = 20_000


def kd_shards(docs: DataFrame, shards: int = 8, target_bytes: int | None = None,
              dimensions: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    Size is the UTF-8 bytes of the text plus 1; a null text has none and counts as equal
    to an empty text. ``target_bytes``, if given, sets the number of shards: leaves are
    split until they reach it. Dimensions are numeric columns, taken as the smallest of a
    group; nulls lie below all values. A group stays whole unless no shard has room for
    it; then its rows are dealt by the hash of doc_id. Slots count from 0 in each shard.
    An empty table gives no rows; other columns are not read.
    """
    dimensions = dimensions or {
        "size": F.octet_length(text_of()),
        "source": F.crc32(F.col("source").cast("string").cast("binary")),
        "lang": F.crc32(F.col("lang").cast("string").cast("binary")),
        "doc_id": F.col("doc_id"),
    }
    names = [f"_d{i}" for i in range(len(dimensions))]
    text = text_of()
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_hash"),
        *[c.cast("double").alias(n) for n, c in zip(names, dimensions.values(), strict=True)])
    key = ["_hash", "text_crc32", "size"]
    groups = stored(rows.groupBy(*key).agg(
        F.sum("size").alias("_weight"), F.count("*").alias("_rows"),
        *[F.min(n).alias(n) for n in names]), "kd-groups")
    whole = groups.agg(F.sum("_weight").alias("w"), F.sum("_rows").alias("n"), *[
        f(n).alias(f"{p}{n}") for n in names for p, f in (("lo", F.min), ("hi", F.max))]).first()
    total = whole["w"] or 0
    if target_bytes:
        shards = max(1, -(-total // target_bytes))
    scaled = groups.select(*key, "_weight", *[
        _composite(n, whole[f"lo{n}"], whole[f"hi{n}"]).alias(n) for n in names])
    heavy = scaled.where(F.col("_weight") * shards * HEAVY > total).select(
        *key, "_weight").collect()
    placed, load = _place_heavy(heavy, shards, total / shards)
    light = scaled.where(F.col("_weight") * shards * HEAVY <= total)
    leaf = _tree(light, names, shards, [max(0.0, total / shards - x) for x in load],
                 total / shards * TOLERANCE)
    by_group = light.select(*key, leaf.alias("shard"), F.lit(0.0).alias("_from"),
                            F.lit(1.0).alias("_to"))
    if placed:
        values = ", ".join(
            f"({h}L, {c}L, {s}L, {shard}, {low!r}D, {high!r}D)" for h, c, s, shard, low, high in placed)
        by_group = by_group.unionByName(docs.sparkSession.sql(
            "SELECT * FROM VALUES " + values
            + " AS t(_hash, text_crc32, size, shard, _from, _to)"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sharded = rows.select("doc_id", *key, draw.alias("_draw")).join(by_group, key).where(
        (F.col("_draw") >= F.col("_from")) & (F.col("_draw") < F.col("_to")))
    return _with_slots(sharded, whole["n"] or 0).select(
        "doc_id", "size", "text_crc32", "shard", "slot")


def _composite(name: str, low: float | None, high: float | None) -> Column:
    """Dimension scaled to the range of the table, then the group's hash to break ties."""
    span = (high - low) if low is not None and high > low else 1.0
    top = (1 << COORD_BITS) - 1
    coord = F.coalesce(F.floor((F.col(name) - F.lit(low or 0.0)) / span * (top - 1)) + 1,
                       F.lit(0)).cast("long")
    return F.shiftleft(coord, TIE_BITS).bitwiseOR(
        F.col("_hash").bitwiseAND(F.lit((1 << TIE_BITS) - 1)))


def _place_heavy(groups: list, shards: int, capacity: float) -> tuple[list, list[float]]:
    """Puts the heaviest group first, whole where a shard has room, else in shares."""
    load, placed = [0.0] * shards, []
    for g in sorted(groups, key=lambda g: (-g["_weight"], g["_hash"])):
        key, weight = (g["_hash"], g["text_crc32"], g["size"]), g["_weight"]
        least = min(range(shards), key=lambda s: load[s])
        if load[least] + weight <= capacity:
            load[least] += weight
            placed.append((*key, least, 0.0, 1.0))
            continue
        done = 0.0
        rooms = sorted(range(shards), key=lambda s: load[s])
        for i, s in enumerate(rooms):
            room = max(0.0, capacity - load[s])
            share = 1.0 - done if i == shards - 1 else min(1.0 - done, room / weight)
            if share > 0:
                load[s] += share * weight
                end = 1.0 if done + share > 1 - 1e-12 else done + share
                placed.append((*key, s, done, end))
                done = end
    return placed, load


def _tree(light: DataFrame, names: list[str], shards: int, room: list[float],
          tolerance: float) -> Column:
    """The shard of a group as one expression of its dimensions."""
    open_nodes = {0: (0, shards)}  # node: its first shard and the one behind its last
    splits: dict[int, tuple[str, int]] = {}

    def node(level_nodes: dict[int, tuple[int, int]]) -> Column:
        def walk(n: int) -> Column:
            if n not in splits:
                return F.lit(n if n in level_nodes else -1)
            name, at = splits[n]
            return F.when(F.col(name) < F.lit(at), walk(2 * n + 1)).otherwise(walk(2 * n + 2))
        return walk(0)

    leaves: dict[int, int] = {}
    while open_nodes:
        leaves |= {n: a for n, (a, b) in open_nodes.items() if b - a == 1}
        open_nodes = {n: ab for n, ab in open_nodes.items() if ab[1] - ab[0] > 1}
        if not open_nodes:
            break
        at_level = light.withColumn("_node", node(open_nodes)).where(F.col("_node") >= 0)
        stats = {r["_node"]: r for r in at_level.groupBy("_node").agg(
            F.sum("_weight").alias("w"), *[f(n).alias(f"{p}{n}") for n in names
                                          for p, f in (("lo", F.min), ("hi", F.max))]).collect()}
        wanted = {}
        for n, (a, b) in open_nodes.items():
            mid = (a + b) // 2
            left, both = sum(room[a:mid]), sum(room[a:b])
            if n not in stats:
                splits[n] = (names[0], 0)
                continue
            s = stats[n]
            name = max(names, key=lambda d: (s[f"hi{d}"] - s[f"lo{d}"]) >> TIE_BITS)
            share = left / both if both else (mid - a) / (b - a)
            wanted[n] = [name, s[f"lo{name}"], s[f"hi{name}"] + 1, s["w"] * share]
        splits |= _medians(at_level, wanted, tolerance)
        open_nodes = {k: v for n, (a, b) in open_nodes.items() for k, v in (
            (2 * n + 1, (a, (a + b) // 2)), (2 * n + 2, ((a + b) // 2, b)))}

    def walk(n: int) -> Column:
        if n in leaves:
            return F.lit(leaves[n])
        name, at = splits[n]
        return F.when(F.col(name) < F.lit(at), walk(2 * n + 1)).otherwise(walk(2 * n + 2))

    return walk(0)


def _medians(rows: DataFrame, wanted: dict[int, list], tolerance: float) -> dict[int, tuple[str, int]]:
    """For each node the key below which about the wanted bytes lie."""
    found: dict[int, tuple[str, int]] = {}
    while wanted:
        bucket = F.lit(None).cast("long")
        for n, (name, low, high, _) in wanted.items():
            width = max(1, -(-(high - low) // BUCKETS))
            inside = (F.col("_node") == n) & (F.col(name) >= F.lit(low)) & (F.col(name) < F.lit(high))
            bucket = F.when(inside, F.floor(F.expr(
                f"({name} - {low}L) div {width}L"))).otherwise(bucket)
        counts: dict[int, list] = {n: [] for n in wanted}
        counted = rows.select("_node", "_weight", bucket.alias("_bucket")).where(
            F.col("_bucket").isNotNull()).groupBy("_node", "_bucket").agg(
            F.sum("_weight").alias("w")).collect()
        for r in counted:
            counts[r["_node"]].append((r["_bucket"], r["w"]))
        for n, (name, low, high, need) in list(wanted.items()):
            width = max(1, -(-(high - low) // BUCKETS))
            at, end, weight = low, low, 0
            for b, w in sorted(counts[n]):
                at, end, weight = low + b * width, low + (b + 1) * width, w
                if need < w:
                    break
                need -= w
            else:
                at, weight = end, 0
            if weight <= 2 * tolerance or width == 1:
                found[n] = (name, end if 2 * need > weight else at)
                del wanted[n]
            else:
                wanted[n] = [name, at, min(end, high), need]
    return found


def _with_slots(rows: DataFrame, count: int) -> DataFrame:
    """Numbers the rows of each shard from 0: a count per bucket, then within a bucket."""
    buckets = max(32, count // ROWS_PER_SLOT_BUCKET)
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("doc_id", "_hash"), F.lit(buckets)))
    sizes = rows.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "_part", F.coalesce(
        F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("shard", "_part").orderBy("doc_id", "_hash")
    return rows.withColumn("_at", F.row_number().over(inside) - 1).join(
        offsets, ["shard", "_part"]).withColumn("slot", F.col("_offset") + F.col("_at"))
