"""Removing repeated runs of lines: a suffix array over line ids by distributed prefix doubling.

The lines of a text that hold a word, stripped of white space at both ends, become ids; a
text is the sequence of its ids.  Suffixes are ranked by their first line, then by their
first two, four and so on lines: the rank of a prefix twice as long is the rank of a pair
of ranks, found by one range sort over the distinct pairs.  Suffixes whose prefix occurs
once are dropped at every step, so the work shrinks to what is repeated.  The suffixes of one
rank are an interval of the suffix array with that many lines in common; how many exactly
each has in common with another (its longest common prefix) is found by :func:`run_lengths`.

A repeated run is deleted where it has at least ``min_lines`` lines, or is a single line of
at least ``LONG_WORDS`` words.  The first suffix of each interval, in the order (id,
position), is the original; at every other one the run is a later copy.  As a run's own parts
of ``min_lines`` lines are repeated where it is, the intervals of that depth tell which lines
go; overlapping copies join into maximal runs.

Edge cases: ids may have any type that orders; lines without a word are not counted and
stay; null and empty texts have no lines; a line repeated in a text is a run that overlaps
itself, of which the first ``min_lines`` - 1 further lines go with it; rows with the same id
and text are one text and stay alike; a null id comes before all others; very long texts are
lines like others; an empty table gives no rows; other columns pass through
:func:`drop_repeated` untouched.  Equality of 64-bit hashes stands for equality of lines and
texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import SPACE, SPACE_CLASS, WORD_CLASS, col, cut, few_tasks, fresh, ranked, split_join, stage

MIN_LINES = 2
#: A single line of so many words is a run.
LONG_WORDS = 50
#: Texts to change, and line numbers in them, that may be broadcast: 40 and 4 bytes each, so under 30 MB.
BROADCAST_TEXTS = 300_000
BROADCAST_LINES = 4_000_000


def _id(name: str) -> Column:
    """An id that is never null, so that joins find it; a null id comes first."""
    return F.struct(col(name).isNotNull().alias("some"), col(name).alias("id"))


def _print(name: str) -> Column:
    return F.xxhash64(F.coalesce(col(name), F.lit("")))


def line_ids(docs: DataFrame, id_col: str, text_col: str, long_words: int = LONG_WORDS) -> DataFrame:
    """Rows (id, print, idx, line, r, long): the idx-th line with a word is line number ``line`` and has the id ``r``; ``long``: it has ``long_words`` words."""
    line = lambda x, i: F.struct(i.alias("line"), F.btrim(x, F.lit(SPACE)).alias("bare"))
    lines = F.filter(F.transform(F.split(F.coalesce(col(text_col), F.lit("")), "\n"), line), lambda x: x["bare"] != "")
    found = docs.select(_id(id_col).alias("id"), _print(text_col).alias("print"), F.posexplode(lines).alias("idx", "x"))
    # A line of n words has 2 n - 1 characters at least, so short ones are not matched; no words are cut out to count them.
    many = f"^(?:{WORD_CLASS}++{SPACE_CLASS}++){{{long_words - 1}}}{WORD_CLASS}"
    long = (F.char_length("x.bare") >= 2 * long_words - 1) & F.col("x.bare").rlike(many)
    return found.select("id", "print", "idx", "x.line", F.xxhash64("x.bare").alias("r"), long.alias("long"))


def repeated_lines(lines: DataFrame) -> DataFrame:
    """The suffixes whose first line occurs more than once: (id, print, idx, lines, r, long)."""
    often = cut(lines.groupBy("r").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    found = split_join(lines, often, "r", "n").select("id", "print", "idx", F.array("line").alias("lines"), "r", "long")
    return cut(found.dropDuplicates(["id", "print", "idx"]))


def longer(active: DataFrame, length: int, step: int, rows: int | None = None) -> DataFrame:
    """Of suffixes ranked by their first ``length`` lines those whose first ``length + step`` lines are repeated, with the rank of these; ``rows``: how many suffixes there are, if known."""
    ahead = active.select("id", "print", (F.col("idx") - step).alias("idx"), F.col("lines").alias("more"), F.col("r").alias("r2"))
    pairs = cut(few_tasks(active.join(ahead, ["id", "print", "idx"]), rows))
    names = pairs.groupBy("r", "r2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranks = ranked(names, ["r", "r2"], "rank")  # written once; what is read twice is a join with one row a partition
    both = F.concat("lines", F.slice("more", length - step + 1, step))
    return cut(few_tasks(split_join(pairs, ranks, ["r", "r2"], "n").select("id", "print", "idx", both.alias("lines"), F.col("rank").alias("r")), rows))


def repeated_windows(active: DataFrame, min_lines: int) -> DataFrame:
    """Suffixes whose first ``min_lines`` lines occur elsewhere: (id, print, idx, lines, r); ``r`` is the rank of that prefix."""
    active, length = active.drop("long"), 1
    while length < min_lines:
        step = min(length, min_lines - length)
        active = longer(active, length, step)
        length += step
    return active


def run_lengths(active: DataFrame) -> DataFrame:
    """Rows (id, print, idx, run): for each suffix the most lines from its first that also occur elsewhere, 1 or more.

    Doubling goes on until no prefix is repeated; level k holds the suffixes whose first 2^k
    lines are repeated, in one interval of the suffix array for each rank.  A suffix that is
    in level k, not in the next, has between 2^k and 2^(k+1) lines in common with the
    nearest of its interval.  These are found from level k - 1 down to 0: an interval is cut
    by the rank of what follows the lines already known to be common.  Members that share it
    go on behind it; where one is alone its interval also stays as it is, for the lower levels.
    """
    place = ["id", "print", "idx"]
    levels, sizes = [active.select(*place, "r")], [active.count()]
    while sizes[-1]:
        length = 1 << (len(levels) - 1)
        one = levels[-1].withColumn("lines", F.array().cast("array<int>"))
        levels.append(longer(one, length, length, sizes[-1]).select(*place, "r"))
        sizes.append(levels[-1].count())
    done: list[DataFrame] = []
    going: DataFrame | None = None  # (id, print, idx, interval, had, open): ``open`` rows still look for their length
    held = 0  # rows of ``going``
    for k in range(len(levels) - 2, -1, -1):
        if going is not None:
            ahead = levels[k].select("id", "print", F.col("idx").alias("at"), F.col("r").alias("next"))
            rows = cut(few_tasks(going.withColumn("at", F.col("idx") + F.col("had")).join(ahead, ["id", "print", "at"], "left").drop("at"), held))
            parts = rows.where("next is not null").groupBy("interval", "had", "next").agg(F.count(F.lit(1)).alias("n"))
            parts = cut(few_tasks(parts, held))
            known = split_join(rows.where("next is not null"), parts, ["interval", "had", "next"], "n")
            known = known.unionByName(rows.where("next is null").withColumn("n", F.lit(1).cast("long")))
            moved = F.struct(F.xxhash64("interval", "had", "next").alias("interval"), (F.col("had") + (1 << k)).alias("had"), "open")
            left = F.struct("interval", "had", (F.col("open") & (F.col("n") < 2)).alias("open"))
            both = F.when(F.col("n") > 1, F.array(moved, left)).otherwise(F.array(left))
            going = few_tasks(known.select(*place, F.explode(both).alias("x")).select(*place, "x.*"), 2 * held)
        on = levels[k + 1].select(*place, F.lit(False).alias("ends"))
        if k == 0:
            done.append(levels[0].join(on, place, "left_anti").select(*place, F.lit(1).alias("run")))
            break
        members = levels[k].join(on, place, "left").select(*place, F.xxhash64(F.lit(k), "r").alias("interval"), F.lit(1 << k).alias("had"), F.coalesce("ends", F.lit(True)).alias("open"))
        members = few_tasks(members, sizes[k])
        going, held = _wanted(members if going is None else going.unionByName(members), 2 * held + sizes[k])
    if going is not None:
        done.append(going.where("open").select(*place, F.col("had").alias("run")))
    out = done[0] if done else active.select(*place, F.lit(1).alias("run"))
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _wanted(rows: DataFrame, most: int) -> tuple[DataFrame, int]:
    """The rows of intervals in which some row is still open, and how many they are; ``most``: at most so many rows come in."""
    rows = cut(rows)
    open_ones = rows.groupBy("interval", "had").agg(F.max("open").alias("some"), F.count(F.lit(1)).alias("n")).where("some").drop("some")
    open_ones = cut(few_tasks(open_ones, most))
    held = open_ones.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return split_join(rows, open_ones, ["interval", "had"], "n").drop("n"), held


def _later(windows: DataFrame) -> DataFrame:
    """The windows that are not the first of their rank."""
    place = F.struct("id", "print", "idx")
    first = cut(windows.groupBy("r").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")))
    return split_join(windows, first, "r", "n").where(~place.eqNullSafe(F.col("first")))


def later_copies(active: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """Rows (id, print, gone): the line numbers of each text that repeat an earlier run; ``active``: its repeated lines."""
    if min_lines < 1:
        raise ValueError("min_lines has to be at least 1")
    found = _later(repeated_windows(active, min_lines)).select("id", "print", "lines")
    if min_lines > 1:
        found = found.unionByName(_later(active.where("long").drop("long")).select("id", "print", "lines"))
    gone = found.select("id", "print", F.explode("lines").alias("line")).distinct()
    return gone.groupBy("id", "print").agg(F.sort_array(F.collect_list("line")).alias("gone"))  # at most a text's own lines


def with_kept_text(docs: DataFrame, id_col: str, text_col: str, min_lines: int, kept: str, gone: str, active: DataFrame | None = None) -> DataFrame:
    """``docs`` with the text without later copies and the line numbers left out; ``active``: the repeated lines, if they are known."""
    if min_lines < 1:
        raise ValueError("min_lines has to be at least 1")
    active = repeated_lines(stage(line_ids(docs, id_col, text_col))) if active is None else active
    found = later_copies(active, min_lines)
    names = {c: fresh(docs, c) for c in ("id", "print")}
    found = cut(found.select(F.col("id").alias(names["id"]), F.col("print").alias(names["print"]), F.col("gone").alias(gone)))
    texts, numbers = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(gone)), F.lit(0))).first()
    if texts <= BROADCAST_TEXTS and numbers <= BROADCAST_LINES:
        found = F.broadcast(found)  # else the texts are shuffled by id
    joined = docs.join(found, _id(id_col).eqNullSafe(F.col(names["id"])) & (_print(text_col) == F.col(names["print"])), "left")
    lines = F.split(col(text_col), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    text = F.when(F.col(gone).isNull(), col(text_col)).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    return joined.select(*[col(c) for c in docs.columns], text.alias(kept), F.coalesce(F.col(gone), F.array().cast("array<int>")).alias(gone))


def runs_of_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, of_kept: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per text: id, n_removed, removed_lines, kept (the text that stays) and longest_run (lines that also occur elsewhere, 0 if none).

    ``of_kept``: what to give of the text that stays, as a digest; texts are then not shuffled to join the runs.
    """
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    active = repeated_lines(stage(line_ids(texts, "id", "text")))
    runs = cut(run_lengths(active).groupBy("id", "print").agg(F.max("run").alias("run")))
    found = with_kept_text(texts, "id", "text", min_lines, "kept", "gone", active)
    kept = F.col("kept") if of_kept is None else of_kept(F.col("kept"))
    found = found.select("id", _print("text").alias("print"), kept.alias("kept"), "gone")
    names = runs.select(F.col("id").alias("by_id"), F.col("print").alias("by_print"), "run")
    found = found.join(names, _id("id").eqNullSafe(F.col("by_id")) & (F.col("print") == F.col("by_print")), "left")
    return found.select(
        F.col("id").alias(id_col), F.size("gone").cast("long").alias("n_removed"), F.col("gone").alias("removed_lines"), "kept", F.coalesce("run", F.lit(0)).cast("long").alias("longest_run")
    )


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with later copies cut from the texts; texts that have no word left are dropped."""
    kept, gone = fresh(docs, "kept"), fresh(docs, "gone")
    found = with_kept_text(docs, id_col, text_col, min_lines, kept, gone)
    emptied = (F.size(F.col(gone)) > 0) & (F.btrim(F.col(kept), F.lit(SPACE)) == "")
    return found.where(~emptied).select(*[F.col(kept).alias(c) if c == text_col else col(c) for c in docs.columns])
