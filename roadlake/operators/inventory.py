"""What moves in unknown CAN traffic: per id, per byte and per bit; and the copies a bus makes of its messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlake.functions.bits import byte_at, word_of_hex
from roadlake.functions.rounding import half_up
from roadlake.operators.ordered import prev, scan
from roadlake.operators.summary import nearest_rank
from roadlake.session import cut_lineage

SESSION = ["session", "device"]
ID = [*SESSION, "can_id"]
MINUTE_MS = 60_000
COUNTER_MIN_VALUES = 8


def with_words(frames: DataFrame, order: list[str], chunk: int = MINUTE_MS) -> DataFrame:
    """Frames with their payload as one BIGINT and the id's previous frame, materialised, as every inventory reads them."""
    words = frames.withColumn("word", word_of_hex(F.col("data_hex")))
    return cut_lineage(scan(words, ID, order, {"before": prev(F.struct("word", "t_ms"))}, chunk))


def id_inventory(words: DataFrame, bucket_ms: int = 1000) -> DataFrame:
    """Per id: frames, rate over the session's span, upper median period, most common length (longer on a tie)."""
    span = words.groupBy(*SESSION).agg(((F.max("t_ms") - F.min("t_ms")) / F.lit(1000.0)).alias("duration_s"))
    lengths = words.groupBy(*ID, "dlc").agg(F.count("*").alias("n")).groupBy(*ID).agg(
        F.sum("n").alias("count"), F.least(F.lit(8), F.max_by("dlc", F.struct("n", "dlc"))).alias("dlc")
    )
    periods = words.where("before IS NOT NULL").select(*ID, (F.col("t_ms") - F.col("before.t_ms")).alias("period"))
    median = nearest_rank(periods, ID, "period", {"median_period_ms": lambda n: F.floor(n / 2) + 1}, bucket_ms)
    out = lengths.join(span, SESSION).join(median.select(*ID, "median_period_ms"), ID, "left")
    rate = F.when(F.col("duration_s") > 0, F.col("count") / F.col("duration_s")).otherwise(0.0)
    return out.select(*ID, "count", rate.alias("rate_hz"), F.col("median_period_ms").cast("double").alias("median_period_ms"), "dlc")


def byte_inventory(words: DataFrame, ids: DataFrame) -> DataFrame:
    """Per id and byte: distinct values, range, and class. A byte is a counter when at least 90 % of its steps, or of
    its low nibble's, are one same non-zero step.

    Values and steps are counted per distinct value before anything is gathered: at most 528 rows per byte."""
    index = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("byte")
    bytes_ = words.select(*ID, "word", F.col("before.word").alias("was"), index)
    value, was = byte_at(F.col("word"), F.col("byte")), byte_at(F.col("was"), F.col("byte"))
    step = (value - was).bitwiseAND(F.lit(255).cast("long"))
    facts = F.array(
        F.struct(F.lit("value").alias("kind"), value.alias("v")),
        F.struct(F.lit("step").alias("kind"), step.alias("v")),
        F.struct(F.lit("nibble").alias("kind"), step.bitwiseAND(F.lit(15).cast("long")).alias("v")),
    )
    counts = bytes_.select(*ID, "byte", F.explode(facts).alias("f")).where("f.v IS NOT NULL").groupBy(*ID, "byte", "f.kind", "f.v").agg(
        F.count("*").alias("n")
    )
    kind, v = F.col("kind"), F.col("v")

    def top(name: str) -> Column:
        return F.max_by(v, F.when(kind == name, F.struct("n", "v"))).alias(f"{name}_top"), F.max(F.when(kind == name, F.col("n"))).alias(f"{name}_n")

    grouped = counts.groupBy(*ID, "byte").agg(
        F.count_if(kind == "value").alias("distinct"), F.min(F.when(kind == "value", v)).alias("min"), F.max(F.when(kind == "value", v)).alias("max"),
        F.sum(F.when(kind == "value", F.col("n"))).alias("frames"), *top("step"), *top("nibble"),
    )

    def counter(name: str) -> Column:
        return (F.col(f"{name}_top") != 0) & (F.col(f"{name}_n") * 10 >= (F.col("frames") - 1) * 9)

    counts_up = (F.col("frames") >= COUNTER_MIN_VALUES) & (counter("step") | counter("nibble"))
    kind_of = F.when(F.col("distinct") <= 1, "constant").when(counts_up, "counter").otherwise("varying")
    return grouped.join(ids.select(*ID, "dlc"), ID).where(F.col("byte") < F.col("dlc")).select(
        *ID, "byte", kind_of.alias("class"), "distinct", "min", "max"
    )


def moving_ids(bytes_: DataFrame) -> DataFrame:
    """Ids with at least one byte that is not constant."""
    return bytes_.where("class <> 'constant'").select(*ID).distinct()


def _entropy(p: Column) -> Column:
    return F.when((p <= 0) | (p >= 1), 0.0).otherwise(-(p * F.log2(p) + (F.lit(1.0) - p) * F.log2(F.lit(1.0) - p)))


def bit_inventory(words: DataFrame, ids: DataFrame) -> DataFrame:
    """Per id and bit: share of transitions that flip it, and the entropy of its value.

    Rows are spread by byte and counted by bit within it, eight sums a side, which combine map-side."""
    spread = words.select(*ID, "word", F.col("before.word").alias("was"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("byte"))
    value = byte_at(F.col("word"), F.col("byte"))
    flips = byte_at(F.col("word").bitwiseXOR(F.col("was")), F.col("byte"))

    def total(source: str, bit: int) -> Column:
        return F.sum(F.getbit(F.col(source), F.lit(bit)).cast("long"))

    per_byte = spread.select(*ID, "byte", value.alias("v"), flips.alias("x")).groupBy(*ID, "byte").agg(
        F.count("*").alias("n"), F.array(*[F.struct(total("v", b).alias("ones"), F.coalesce(total("x", b), F.lit(0)).alias("flips")) for b in range(8)]).alias("bits")
    )
    rows = per_byte.join(ids.select(*ID, "dlc"), ID).where(F.col("byte") < F.col("dlc")).select(*ID, "byte", "n", F.posexplode("bits").alias("i", "b"))
    return rows.select(
        *ID, (F.col("byte") * 8 + F.col("i")).alias("bit"),
        half_up(F.col("b.flips") / F.greatest(F.col("n") - 1, F.lit(1))).alias("flip_rate"),
        half_up(_entropy(F.col("b.ones") / F.greatest(F.col("n"), F.lit(1)))).alias("entropy"),
    )


# ---- duplicates ----

MESSAGE = ["session", "base_us", "can_id", "dt_us", "data_hex"]


def copies(messages: DataFrame) -> DataFrame:
    """Distinct messages with the number of exact copies."""
    return messages.groupBy(*MESSAGE).agg(F.count("*").alias("copies"))


def duplicate_report(messages: DataFrame) -> DataFrame:
    """Messages, distinct messages and the share of repeats, per session."""
    totals = copies(messages).groupBy("session").agg(F.sum("copies").alias("messages"), F.count("*").alias("distinct_messages"))
    return totals.withColumn("duplicate_share", F.lit(1.0) - F.col("distinct_messages") / F.col("messages"))


def copy_histogram(messages: DataFrame) -> DataFrame:
    return copies(messages).groupBy("session", "copies").agg(F.count("*").alias("distinct_messages"))


def copies_per_second(messages: DataFrame) -> DataFrame:
    """Per frame: messages, distinct ones and the median number of copies (the frame bounds the group)."""
    return copies(messages).groupBy("session", "base_us").agg(
        F.sum("copies").alias("messages"), F.count("*").alias("distinct_messages"), F.median("copies").alias("median_copies")
    )


def repeat_order(messages: DataFrame, position: str, chunk: int = 1_000_000) -> DataFrame:
    """Per session: identical neighbours in frame order, and repeats whose neighbour differs. Messages of one position come
    in the order of their content, so that the answer does not hang on how the rows were read."""
    body = F.struct("can_id", "dt_us", "data_hex")
    firsts = messages.groupBy(*MESSAGE).agg(F.min(position).alias("_first"))
    seen = scan(messages.select(*MESSAGE, position), ["session", "base_us"], [position, "can_id", "dt_us", "data_hex"], {"before": prev(body)}, chunk)
    judged = seen.join(firsts, MESSAGE)
    same = F.coalesce(F.col("before") == body, F.lit(False))
    return judged.groupBy("session").agg(
        F.count_if(same).alias("adjacent_pairs"), F.count_if((F.col(position) > F.col("_first")) & ~same).alias("separate_repeats")
    )


def filled_share(frames: DataFrame) -> DataFrame:
    """Share of IMU points filled in, per session."""
    return frames.groupBy("session").agg(F.sum("imu").alias("imu_samples"), F.sum("imu_missing").alias("filled")).withColumn(
        "filled_share", F.col("filled") / F.nullif(F.col("imu_samples"), F.lit(0))
    )
