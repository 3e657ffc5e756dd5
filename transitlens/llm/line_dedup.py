"""Line dedup over overlapping three-line windows (operator 10).

Lines are what stands between line feeds.  Lines of white space only (space,
tab, VT, FF, CR) are passed over when windows are formed and always stay.
Every ``size`` consecutive other lines of a document form a window, hashed to
128 bits.  A window that starts earlier in the corpus ((doc_id, line) order)
or earlier in the same document is a repeat; the lines covered by repeats are
merged, so overlapping repeats leave as one passage.

Scale: windows are counted with partial aggregation, which keeps one row per
window and task; only windows that repeat are joined back, on the hash, with
one row per hash on one side, so Spark can split a hash that a third of all
documents share.  Line numbers are gathered per document alone.

Defined cases: null text stays null (0 lines); a document with fewer than
``size`` lines has no window and stays whole; null doc_id sorts last; rows that
repeat both doc_id and text are one document (each keeps or loses the same
lines); rows that repeat only the doc_id are ordered by a hash of their text;
extra columns stay as they are; empty table, no rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from transitlens.llm.common import Scratch

_ID, _KEY, _DROP, _FROM, _TO = "__id", "__key", "__drop", "__from", "__to"
NULL_LAST = (1 << 63) - 1
BLANK = "[ \\t\\x0B\\f\\r]"


def _counted(text: Column) -> Column:
    """(line number, line) of the lines that are not blank."""
    numbered = F.transform(F.split(text, "\n", -1), lambda l, i: F.struct(i.alias("i"), l.alias("l")))
    return F.filter(numbered, lambda s: F.regexp_replace(s["l"], BLANK, "") != "")


def _windows(lines: Column, size: int) -> Column:
    def one(i):
        part = [F.get(lines, i + k) for k in range(size)]
        text = [p["l"] for p in part]
        return F.struct(F.array(*[p["i"] for p in part]).alias("lines"), F.xxhash64(*text).alias("h1"),
                        F.xxhash64(F.lit("second"), *text).alias("h2"))
    return F.when(F.size(lines) >= size, F.transform(F.sequence(F.lit(0), F.size(lines) - size), one))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({_ID: F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_LAST)), _KEY: F.xxhash64("text")})


def repeated_lines(docs: DataFrame, size: int = 3) -> DataFrame:
    """(__id, __key, __drop): sorted numbers of the lines to remove from a document."""
    windows = (docs.select(_ID, _KEY, _counted(F.col("text")).alias("c"))
               .select(_ID, _KEY, F.explode(_windows(F.col("c"), size)).alias("w"))
               .select(_ID, _KEY, "w.lines", "w.h1", "w.h2"))
    here = F.struct(F.col(_ID), F.col(_KEY), F.col("lines")[0].alias("at"))
    first = (windows.groupBy("h1", "h2").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("h1", "h2", "first"))
    later = windows.join(first, ["h1", "h2"]).filter(here != F.col("first"))
    return later.groupBy(_ID, _KEY).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("lines")))).alias(_DROP))


def _runs(drop: str) -> tuple[Column, Column]:
    """First lines of the runs of consecutive numbers in a sorted array, and the lines after the runs."""
    d = F.col(drop)
    start = F.filter(d, lambda x, i: (i == 0) | (F.get(d, i - 1) != x - 1))
    end = F.transform(F.filter(d, lambda x, i: (i == F.size(d) - 1) | (F.get(d, i + 1) != x + 1)), lambda x: x + 1)
    return start, end


def _cut(text: Column) -> Column:
    """Text without the runs [__from, __to) of lines: the stretches between them, joined."""
    lines = F.split(text, "\n", -1)
    begin, stop = F.concat(F.array(F.lit(0)), F.col(_TO)), F.concat(F.col(_FROM), F.array(F.size(lines)))
    part = F.filter(F.arrays_zip(begin.alias("a"), stop.alias("b")), lambda p: p["b"] > p["a"])
    return F.array_join(F.flatten(F.transform(part, lambda p: F.slice(F.col("__split"), p["a"] + 1, p["b"] - p["a"]))), "\n")


def line_dedup(docs: DataFrame, size: int = 3) -> DataFrame:
    """All columns of ``docs``, with repeated passages cut from ``text``, and
    n_lines (those that count) and n_removed."""
    tmp = Scratch(docs.sparkSession, "line-dedup")
    keyed = _keyed(docs)
    found = repeated_lines(keyed.select(_ID, _KEY, "text"), size)
    first, after = _runs(_DROP)
    drops = tmp.write(found.select(_ID, _KEY, F.size(_DROP).cast("long").alias("__n"), first.alias(_FROM), after.alias(_TO)), "drops")
    # it grows with the corpus: dealt by key at any size
    joined = keyed.join(drops.hint("merge"), [_ID, _KEY], "left").withColumn("__split", F.split("text", "\n", -1))
    n_lines = F.coalesce(F.size(_counted(F.col("text"))), F.lit(0)).cast("long")
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    return joined.select(*keep, F.greatest(n_lines, F.lit(0)).alias("n_lines"), F.coalesce("__n", F.lit(0)).cast("long").alias("n_removed"),
                         F.when(F.col("__n").isNull(), F.col("text")).otherwise(_cut(F.col("text"))).alias("text"))
