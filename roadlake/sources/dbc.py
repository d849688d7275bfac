"""DBC files as a signal table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.functions.bits import bits_needed
from roadlake.operators.ordered import last_known, scan

ID_MASK = 0x1FFFFFFF

# The two line forms that matter.
_MESSAGE = r"^\s*BO_\s+(\d+)\s+(\w+)\s*:\s*(\d+)"
_SIGNAL = r'^\s*SG_\s+(\w+)\s*(M|m\d+M?)?\s*:\s*(\d+)\|(\d+)@([01])([+-])\s*\(([^,]+),([^)]+)\)\s*\[[^\]]*\]\s*"([^"]*)"'


def _group(line: Column, pattern: str, n: int) -> Column:
    return F.nullif(F.regexp_extract(line, pattern, n), F.lit(""))


def parse_dbc(lines: DataFrame, lines_per_chunk: int = 10_000) -> DataFrame:
    """`lines`: dbc, line_no, line. A signal belongs to the last message line above it."""
    line = F.col("line")
    tagged = lines.select(
        "dbc", F.col("line_no").cast("long").alias("line_no"), "line",
        F.when(
            line.rlike(_MESSAGE),
            F.struct(
                _group(line, _MESSAGE, 1).cast("long").bitwiseAND(F.lit(ID_MASK)).alias("can_id"),
                _group(line, _MESSAGE, 2).alias("message"),
                _group(line, _MESSAGE, 3).cast("int").alias("dlc"),
            ),
        ).alias("bo"),
    )
    owned = scan(tagged, ["dbc"], ["line_no"], {"owner": last_known(F.col("bo"))}, lines_per_chunk)
    signals = owned.where(line.rlike(_SIGNAL) & F.col("owner").isNotNull())
    return signals.select(
        "dbc", "line_no", "owner.can_id", "owner.message", "owner.dlc",
        _group(line, _SIGNAL, 1).alias("signal"),
        _group(line, _SIGNAL, 2).alias("mux"),
        _group(line, _SIGNAL, 3).cast("int").alias("start"),
        _group(line, _SIGNAL, 4).cast("int").alias("length"),
        (_group(line, _SIGNAL, 5) == "1").alias("little_endian"),
        (_group(line, _SIGNAL, 6) == "-").alias("signed"),
        F.trim(_group(line, _SIGNAL, 7)).cast("double").alias("scale"),
        F.trim(_group(line, _SIGNAL, 8)).cast("double").alias("offset"),
        F.coalesce(_group(line, _SIGNAL, 9), F.lit("")).alias("unit"),
    )


def read_dbc(spark: SparkSession, path: str) -> DataFrame:
    """Every .dbc file under `path`; the file's base name is the DBC's name."""
    text = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_name"))
    lines = text.select(
        F.regexp_replace("file", r"\.dbc$", "").alias("dbc"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line")
    )
    return parse_dbc(lines)


def multiplexed(signals: DataFrame) -> DataFrame:
    """Per message (dbc, can_id): `selector`, the field of its multiplexer, and `listed`, the values that choose signals.

    A signal tagged m<k> is in a frame only if the selector holds k; a table without a `mux` column has none."""
    mux = F.col("mux") if "mux" in signals.columns else F.lit(None).cast("string")
    field = F.struct("start", "length", "little_endian", "signed")
    return signals.groupBy("dbc", "can_id").agg(F.max(F.when(mux == "M", field)).alias("selector"), F.collect_set(chosen_by(mux)).alias("listed"))


def chosen_by(mux: Column) -> Column:
    """The selector value that a tag m<k> or m<k>M stands for; null for other signals."""
    return _group(mux, r"^m(\d+)", 1).cast("long")


def with_layout(signals: DataFrame) -> DataFrame:
    """Add `need_bytes`: the payload bytes a message needs before any of its signals may be decoded, which is its
    length or the furthest byte any of its fields reaches."""
    reach = F.ceil(bits_needed(F.col("start"), F.col("length"), F.col("little_endian")) / 8).cast("int")
    needed = signals.groupBy("dbc", "can_id").agg(F.greatest(F.max("dlc"), F.max(reach)).alias("need_bytes"))
    return signals.join(needed, ["dbc", "can_id"])
