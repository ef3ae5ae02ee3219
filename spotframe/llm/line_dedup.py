"""Line deduplication over overlapping windows of three consecutive lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import stable

WINDOW = 3


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Every row with its ``lines`` and the ``removed`` line numbers (from 0, ascending); other columns stay.

    Lines are cut at newlines and compared unchanged. A window is ``window`` consecutive lines of a document, or all
    lines of a shorter one. Of equal windows in all documents the first stays, by id and then by line; every later one
    covers its lines, and covered lines are removed. Windows of spaces, tabs and line ends only are left alone.

    A null text has no lines; a null id comes before all others; rows that repeat an id and a text count as one
    document, and are cut alike; an empty table gives no rows. Columns called ``lines`` or ``removed`` are replaced.
    """
    key = [F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_key")]
    lines = F.coalesce(F.split(F.col(text_col), "\n"), F.array().cast("array<string>"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("_lines") - window, F.lit(0)))
    texts = F.transform(starts, lambda i: F.array_join(F.slice("_lines", i + 1, window), "\n"))
    hashes = F.transform(texts, lambda t: F.when(F.translate(t, " \t\r\n", "") != "", F.unhex(F.md5(t))))
    windows = (
        docs.select(*key, lines.alias("_lines"))
        .where(F.size("_lines") > 0)
        .select("_id", "_key", F.posexplode(hashes).alias("_pos", "_hash"))
        .where(F.col("_hash").isNotNull())
    )
    # Read three times below; the hashes take a fraction of the text.
    windows = stable(windows)
    place = F.struct("_id", "_pos")
    first = windows.groupBy("_hash").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    repeated = first.where(F.col("_first") != F.col("_last")).select("_hash", "_first")
    later = windows.join(repeated, "_hash").where(place != F.col("_first"))
    found = later.groupBy("_id", "_key").agg(F.collect_set("_pos").alias("_starts"))
    marked = docs.select("*", *key).join(
        found.select(F.col("_id").alias("_i"), F.col("_key").alias("_k"), "_starts"),
        F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k")),
        "left",
    )
    covered = F.array_distinct(
        F.flatten(F.transform("_starts", lambda s: F.sequence(s, F.least(s + window, F.size("_lines")) - 1)))
    )
    others = [c for c in docs.columns if c not in ("lines", "removed")]
    return (
        marked.withColumn("_lines", lines)
        .select(
            *others,
            F.col("_lines").alias("lines"),
            F.coalesce(F.array_sort(covered), F.array().cast("array<int>")).alias("removed"),
        )
    )


def kept_text(lines: str = "lines", removed: str = "removed"):
    """The lines that are left, joined by newlines."""
    number = F.sequence(F.lit(0), F.size(lines) - 1)
    left = F.when(F.size(lines) > 0, F.array_except(number, F.col(removed)))
    return F.array_join(F.transform(left, lambda i: F.element_at(F.col(lines), i + 1)), "\n")


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with the text that is left, all columns as they were. A row whose lines all go, goes; a row without lines stays."""
    marked = repeated_lines(docs.select("*"), id_col, text_col).where((F.size("removed") == 0) | (F.size("removed") < F.size("lines")))
    text = F.when(F.size("removed") == 0, F.col(text_col)).otherwise(kept_text())
    return marked.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])
