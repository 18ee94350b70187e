"""Game-record text -> full games.

A record is a block of header tags and the move text with clock comments. Files with either
line ending, a byte order mark, or several records without blank lines between are read.
The reader splits the files at record starts, wherever file splits fall, so large files are
read in parallel, and every field is a column expression over the record's text.

Only the main line counts: side lines in parentheses, nested to any depth, go with their
comments and clocks. A clock belongs to the move before it; a move without one has NULL in
its place, and a game without any has empty clock arrays. Comments may hold parentheses and
semicolons; a semicolon elsewhere, and a line that begins with a per cent sign, hide the rest
of the line. A line that begins with the Event tag starts a record, even inside a comment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plyscope.functions.tiers import base_seconds, tier_of, time_control_category

# The formats of a record.
START = "[Event "
CLOCK = r"\{[^}]*?\[%clk\s+(\d+:\d{1,2}:\d{1,2}(?:\.\d+)?)\][^}]*\}"
COMMENT = r"\{[^}]*\}"
LINE_COMMENT = r"(\{[^}]*\})|;[^\n]*|(?m:^%[^\n]*)"
HEADER = r"(?s)^(?:\s*\[[^\n]*\][ \t]*(?:\n|$))*"
NUMBER_PREFIX = r"^\d+\.+"
ENDINGS = ("1-0", "0-1", "1/2-1/2", "*")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per record, with plain line feeds and its whole header."""
    rows = spark.read.option("lineSep", "\n" + START).text(path)
    plain = F.regexp_replace(F.regexp_replace("value", "\r\n?", "\n"), "^[\ufeff\\s]+", "")
    whole = F.when(plain.startswith("["), plain).otherwise(F.concat(F.lit(START), plain))
    rest = [c for c in rows.columns if c != "value"]
    return rows.where(F.length(plain) > 0).select(whole.alias("value"), *rest)


def tag(name: str) -> Column:
    found = F.regexp_extract("value", rf'\[{name} "([^"]*)"\]', 1)
    return F.when(F.length(found) > 0, found)


def clock_seconds(text: Column) -> Column:
    """``H:MM:SS`` to seconds."""
    parts = F.split(text, ":")
    return parts[0].cast("double") * 3600 + parts[1].cast("double") * 60 + parts[2].cast("double")


def move_text() -> Column:
    """What follows the header lines."""
    return F.regexp_replace("value", HEADER, "")


def main_line(text: Column) -> Column:
    """Words of the main line: moves without numbers, and clocks as ``@H:MM:SS``."""
    text = F.regexp_replace(text, LINE_COMMENT, "$1")
    text = F.regexp_replace(F.regexp_replace(text, CLOCK, " @$1 "), COMMENT, " ")
    words = F.split(F.trim(F.regexp_replace(text, r"([()])", " $1 ")), r"\s+")

    def step(state: Column, word: Column) -> Column:
        depth = state["depth"] + F.when(word == "(", 1).when((word == ")") & (state["depth"] > 0), -1).otherwise(0)
        outside = (state["depth"] == 0) & ~word.isin("(", ")")
        kept = F.when(outside, F.array_append(state["kept"], word)).otherwise(state["kept"])
        return F.struct(depth.cast("int").alias("depth"), kept.alias("kept"))

    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("kept"))
    # only records with side lines need their words told apart by depth
    flat = F.when(text.contains("(") | text.contains(")"), F.aggregate(words, start, step, lambda s: s["kept"])).otherwise(words)
    bare = F.transform(flat, lambda w: F.regexp_replace(w, NUMBER_PREFIX, ""))
    return F.filter(bare, lambda w: (w != "") & ~w.isin(*ENDINGS) & ~w.startswith("$"))


def is_clock(word: Column) -> Column:
    return word.startswith("@")


def every_second(values: Column, start: int) -> Column:
    return F.filter(values, lambda _, i: i % 2 == start)


def parse_records(records: DataFrame, extra_tags=()) -> DataFrame:
    """Full games from record texts; column names follow the full-game schema.

    ``extra_tags`` adds further header tags as lower-case columns.
    """
    df = records.withColumn("_words", main_line(move_text()))
    shown = F.transform(
        "_words",
        lambda w, i: F.struct(
            w.alias("san"),
            F.when(is_clock(F.get("_words", i + 1)), clock_seconds(F.substring(F.get("_words", i + 1), 2, 20))).alias("clock"),
        ),
    )
    df = df.withColumn("_shown", F.filter(shown, lambda m: ~is_clock(m["san"])))
    timed = F.exists("_shown.clock", lambda t: t.isNotNull())
    df = df.withColumns(
        {
            "_sans": F.col("_shown.san"),
            "_clocks": F.when(timed, F.col("_shown.clock")).otherwise(F.array().cast("array<double>")),
            "white_elo": tag("WhiteElo").try_cast("int"),
            "black_elo": tag("BlackElo").try_cast("int"),
            "time_control": tag("TimeControl"),
        }
    )
    base = base_seconds(F.col("time_control"))
    kept = [c for c in records.columns if c != "value"]
    return df.select(
        *kept,
        *[tag(name).alias(name.lower()) for name in extra_tags],
        tag("White").alias("white_player"),
        tag("Black").alias("black_player"),
        "white_elo",
        "black_elo",
        tier_of(F.col("white_elo")).alias("white_skill_tier"),
        tier_of(F.col("black_elo")).alias("black_skill_tier"),
        tag("Result").alias("result"),
        "time_control",
        time_control_category(base).alias("time_control_category"),
        base.alias("base_time"),
        F.size("_sans").alias("num_moves"),
        F.coalesce(tag("ECO"), F.lit("")).alias("opening_eco"),
        F.coalesce(tag("Opening"), F.lit("")).alias("opening_name"),
        F.transform("_sans", lambda s: F.struct(s.alias("move_san"))).alias("moves"),
        every_second(F.col("_clocks"), 0).alias("clock_times_white"),
        every_second(F.col("_clocks"), 1).alias("clock_times_black"),
    )


def clock_text(seconds: Column) -> Column:
    """Whole seconds as ``H:MM:SS``."""
    s = F.floor(seconds)
    two = lambda v: F.lpad(v.cast("string"), 2, "0")
    return F.concat(
        F.floor(s / 3600).cast("string"), F.lit(":"), two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60)
    )


def ingest(spark: SparkSession, path: str, out: str) -> None:
    """Parse record files and store the games by time control."""
    parse_records(read_records(spark, path)).write.mode("overwrite").partitionBy(
        "time_control_category"
    ).parquet(out)
