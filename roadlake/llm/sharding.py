"""K-d tree sharding with distributed weighted medians, in DataFrame operations only.

Every row has a place in a box of metadata dimensions and a weight in bytes. A node that is to become several shards is
split along the dimension in which it is widest, at the place that divides its bytes as its shards are divided. All
nodes of a level are split together. The place is found by counting bytes in a few thousand bins of the order and again
within the bin that holds it, so what reaches the driver is one row per node however many rows there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.session import cut_lineage

VALUE_BITS, ID_BITS, ROW_BITS = 20, 22, 20  # a key: the value's place in the box, then ties by content, then by row
KEY_BITS = VALUE_BITS + ID_BITS + ROW_BITS
BIN_BITS = 13
CHUNK_BITS = 10  # rows of a chunk within which slots are numbered


def as_number(column: Column, kind: T.DataType) -> Column:
    """A dimension as a double, in its own order: text by its first six bytes; what is no finite number is null."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.BooleanType)):
        column = F.unix_timestamp(column) if not isinstance(kind, T.BooleanType) else column.cast("int")
    elif not isinstance(kind, T.NumericType):
        column = F.conv(F.rpad(F.hex(F.substring(column.cast("string").cast("binary"), 1, 6)), 12, "0"), 16, 10)
    number = column.cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def cases(node: Column, of_node: dict[int, Column], otherwise: Column | None = None) -> Column:
    """The expression of the row's node; null, or `otherwise`, for nodes without one."""
    first, *rest = of_node.items()
    chain = reduce(lambda c, item: c.when(node == item[0], item[1]), rest, F.when(node == first[0], first[1]))
    return chain if otherwise is None else chain.otherwise(otherwise)


def split_keys(rows: DataFrame, targets: dict[int, float]) -> dict[int, int]:
    """For each node, the key below which its weight is nearest to the target; `rows` has node, key and size."""
    found: dict[int, tuple[int, float]] = {n: (0, 0.0) for n in targets}  # the bin's number at the present width, the weight before it
    width = KEY_BITS
    while True:
        step = min(BIN_BITS, width)
        width -= step
        prefix = F.shiftright("key", width)
        inside = cases(F.col("node"), {n: F.shiftright("key", width + step) == at for n, (at, _) in found.items()}, F.lit(False))
        bins = rows.where(inside).groupBy("node", prefix.alias("bin")).agg(F.sum("size").alias("weight"), F.count("*").alias("n"))
        before = F.sum("weight").over(Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
        rest = cases(F.col("node"), {n: F.lit(targets[n] - weight) for n, (_, weight) in found.items()})
        bins = bins.withColumn("before", F.coalesce(before, F.lit(0)))
        # the bin in which the target lies, or the last one
        chosen = bins.groupBy("node").agg(F.max_by(F.struct("bin", "before", "weight", "n"), F.when(F.col("before") <= rest, F.col("bin"))).alias("b")).where("b is not null").select("node", "b.*").collect()
        for r in chosen:
            found[r.node] = (r.bin, found[r.node][1] + r.before)
        if not width or all(r.n <= 1 or r.weight <= targets[r.node] / 10_000 for r in chosen):
            whole = {r.node: r.weight for r in chosen}
            return {n: (at + (2 * (targets[n] - weight) >= whole.get(n, 0))) << width for n, (at, weight) in found.items()}


def kd_shards(docs: DataFrame, shards: int = 24, dimensions: Sequence[str] = ("doc_id", "lang", "source"), id_col: str = "doc_id", text_col: str = "text", target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row: shards of nearly equal bytes, each a box of the metadata.

    With `target_bytes` there are as many shards as give leaves of at most about that size. Slots number a shard's rows
    from 0 without gaps: rows are numbered within chunks of at most 2^CHUNK_BITS rows, and two levels of sums of chunk
    counts give each chunk's first slot, so no task holds a shard. `docs` must be a table scan or otherwise give its
    rows in the same order when it is computed again.

    A null text has no bytes (size 8, checksum 0). A null dimension is placed at the low end, a constant one is never
    split along; equal places and repeated rows are ordered by a hash of id, checksum and row. A single document larger
    than a shard stays whole. An empty table gives an empty result; dimensions may have any names.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    kinds = {f.name: f.dataType for f in docs.schema}
    names = [f"d{k}" for k in range(len(dimensions))]
    rows = cut_lineage(docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("row"),
        *(as_number(F.col(f"`{d}`"), kinds[d]).alias(n) for d, n in zip(dimensions, names, strict=True))))
    box = rows.agg(F.sum("size").alias("size"), *(f(n).alias(f"{f.__name__}_{n}") for n in names for f in (F.min, F.max))).first()
    if target_bytes:
        shards = max(1, -(-(box["size"] or 0) // target_bytes))
    spread = {n: (box[f"max_{n}"] or 0.0) - (box[f"min_{n}"] or 0.0) for n in names}
    scaled = {n: F.coalesce((F.col(n) - F.lit(box[f"min_{n}"])) / spread[n], F.lit(0.0)) if spread[n] > 0 else F.lit(0.0) for n in names}
    ties = F.shiftleft(F.xxhash64("doc_id", "text_crc32").bitwiseAND((1 << ID_BITS) - 1), ROW_BITS) + F.xxhash64("row").bitwiseAND((1 << ROW_BITS) - 1)
    placed = rows.select("doc_id", "size", "text_crc32", "row", ties.alias("ties"), *(scaled[n].alias(n) for n in names), F.lit(0).alias("node"))
    leaves = {0: shards}  # by node; a node's number is that of its first shard
    while box["size"] and any(n > 1 for n in leaves.values()):
        open_nodes = [node for node, n in leaves.items() if n > 1]
        stats = {r.node: r for r in placed.where(F.col("node").isin(open_nodes)).groupBy("node").agg(F.sum("size").alias("size"), *((F.max(n) - F.min(n)).alias(n) for n in names)).collect()}
        widest = {node: max(names, key=lambda n: stats[node][n]) for node in open_nodes if node in stats}
        if not widest:
            break
        left = {node: leaves[node] // 2 for node in widest}
        value = {n: F.shiftleft(F.floor(F.col(n) * ((1 << VALUE_BITS) - 1)).cast("long"), ID_BITS + ROW_BITS) for n in names}
        keyed = placed.withColumn("key", cases(F.col("node"), {node: value[n] for node, n in widest.items()}, F.lit(0).cast("long")) + F.col("ties"))
        at = split_keys(keyed, {node: stats[node]["size"] * left[node] / leaves[node] for node in widest})
        moved = cases(F.col("node"), {node: F.when(F.col("key") >= F.lit(at[node]), node + left[node]).otherwise(node) for node in widest}, F.col("node"))
        placed = cut_lineage(keyed.withColumn("node", moved).drop("key"))  # metadata only; expressions nested level in level do not compile
        leaves = {node: n for node, n in leaves.items() if n == 1} | {k: v for node in widest for k, v in ((node, left[node]), (node + left[node], leaves[node] - left[node]))}
    return slots(placed.withColumnRenamed("node", "shard")).select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot")


def slots(rows: DataFrame) -> DataFrame:
    """`rows` (shard, row) with a gapless number within the shard, in the order of `row`."""
    rows = rows.withColumn("chunk", F.shiftright("row", CHUNK_BITS)).withColumn("span", F.shiftright("chunk", CHUNK_BITS))
    chunks = rows.groupBy("shard", "span", "chunk").agg(F.count("*").alias("n"))
    spans = chunks.groupBy("shard", "span").agg(F.sum("n").alias("n"))
    ahead = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("shard", "span", F.coalesce(F.sum("n").over(ahead("shard", "span")), F.lit(0)).alias("first_of_span"))
    chunks = chunks.select("shard", "span", "chunk", F.coalesce(F.sum("n").over(ahead("shard", "span", "chunk")), F.lit(0)).alias("first_of_chunk")).join(spans, ["shard", "span"])
    chunks = chunks.select("shard", "chunk", (F.col("first_of_span") + F.col("first_of_chunk")).alias("first_slot"))
    within = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("row"))
    return rows.withColumn("within", within).join(chunks, ["shard", "chunk"]).withColumn("slot", F.col("first_slot") + F.col("within") - 1)
