"""Line dedup by winnowing over line hashes.

The sequence of a document are its lines that hold a word.  Of every ``run`` consecutive lines the leftmost with the smallest hash is
a fingerprint, so every repeated run of at least ``run`` lines shares a fingerprint at the same place in all its copies.
Fingerprints that occur once are done with.  The others are extended both ways: every window of ``run`` lines that holds one is
looked up, and what an earlier document, or an earlier place of the same one, has as well is deleted; neighbouring windows
make up whole repeated runs, however long.  The first copy of a run stays.  Windows meet at their least (document, place), so no pairs
of copies are listed.

Lines may be whole paragraphs, so a run can also be measured by its words: with ``passage`` given, every shorter run (one line, or two
where RUN is three) of more than that many words is a window as well, looked up by its own hash in the same tables.  The op7 contract has no such
windows; the pipeline uses PASSAGE.

Edge cases: NULL and empty texts have no lines and stay as they are (NULL gives an empty text).  Lines without a word are no part of the sequence
and always stay.  A text of fewer than ``run`` lines and no more than ``passage`` words is never changed.  Order is by ``doc_id`` (NULL ids come last), then by text; of repeated
rows with one id and text, all count as the same place and are cut alike.  All other columns are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.text import let, stored, words

RUN = 3  # lines; shorter repeats stay, but for those of many words where asked
PASSAGE = 50  # words; with it, one or two lines of more are a run

WORDED = "[^ \\t-\\r]"


def _fingerprints(h: Column, run: int) -> Column:
    """Places of the leftmost least hash of every window of ``run`` hashes."""
    window = lambda i: F.slice(h, i + 1, run)
    place = lambda i: let(window(i), lambda s: F.array_position(s, F.array_min(s))).cast("int") + i - 1
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(h) - run), place))


def repeated_windows(lines: DataFrame, run: int, passage: int | None = None) -> DataFrame:
    """(id, th, starts): per document the windows (start and size) of ``run`` lines, or of fewer with over ``passage`` words, that occur earlier too.

    ``lines`` holds id, th and the line hashes h (two per line, so that 128 bits tell lines apart), with ``passage`` also each line's words n.
    """

    def window(i: Column, size: int) -> Column:
        own = F.slice("h", i + 1, size)
        return F.struct(i.alias("start"), F.lit(size).alias("size"), F.xxhash64(own).alias("p"), F.xxhash64(F.lit("second"), own).alias("q"))

    def passages(size: int) -> Column:
        """The windows of ``size`` lines with over ``passage`` words."""
        total = lambda i: sum((F.get("h", i + j)["n"] for j in range(1, size)), F.get("h", i)["n"])  # noqa: E731  NULL outside the text
        starts = F.filter(F.sequence(F.lit(0), F.size("h") - size), lambda i: (i >= 0) & (total(i) > passage))
        return F.transform(starts, lambda i: window(i, size))

    def mark(at: Column) -> Column:
        """A fingerprint with the windows that hold it."""
        around = F.sequence(F.greatest(F.lit(0), at - (run - 1)), F.least(at, F.size("h") - run))
        return F.struct(at.alias("at"), F.get("h", at)["a"].alias("fp"), F.transform(around, lambda i: window(i, run)).alias("windows"))

    places = _fingerprints(F.transform("h", lambda x: x["a"]), run)
    marks = lines.where(F.size("h") >= run).select("id", "th", F.explode(let(places, lambda p: F.transform(p, mark))).alias("m"))
    marks = marks.select("id", "th", "m.*")
    spot = F.struct("id", "th", "at")
    often = marks.groupBy("fp").agg(F.min(spot).alias("x"), F.max(spot).alias("y")).where("x < y").select("fp")
    # Stored, like the table of first places below: a join of plain shuffles is split where a line or passage is frequent.
    near = marks.drop("at").join(stored(often, "frequent-lines"), "fp")
    windows = near.select("id", "th", F.explode("windows").alias("w"))
    if passage is not None:
        windows = windows.union(lines.select("id", "th", F.explode(F.concat(*[passages(size) for size in range(1, run)]))))
    windows = stored(windows.select("id", "th", "w.*"), "line-windows")
    spot = F.struct("id", "th", "start")
    ends = windows.groupBy("p", "q").agg(F.min(spot).alias("first"), F.max(spot).alias("last"))
    first = stored(ends.where("first < last").select("p", "q", "first"), "first-places")
    late = windows.join(first, ["p", "q"]).where(spot > F.col("first"))
    return late.groupBy("id", "th").agg(F.collect_set(F.struct("start", "size")).alias("starts"))  # at most ``run`` per line of a document


def dedup_lines(docs: DataFrame, run: int = RUN, passage: int | None = None) -> DataFrame:
    """The input with ``text`` cut, and n_lines, n_removed, n_runs (maximal removed runs) added; a row per document.

    With ``passage`` fewer than ``run`` lines count as a run too if they have more than so many words.  Columns of these names in the input are replaced.
    """
    # NULL ids sort last; the text's hash tells rows of one id apart.
    ident = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"))
    text = F.coalesce("text", F.lit(""))
    worded = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORDED))
    counted = lambda x: [] if passage is None else [F.size(words(x)).alias("n")]
    hashes = F.transform(worded, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit("second"), x).alias("b"), *counted(x)))
    lines = docs.select(ident.alias("id"), F.xxhash64("text").alias("th"), hashes.alias("h"))
    found = stored(repeated_windows(lines, run, passage), "line-runs")
    found = found.select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("starts").alias("__starts"))
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed", "n_runs", "__id", "__th", "__starts")]
    same = ident.eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__th"))
    # Texts are moved to their runs whatever the size of these: a broadcast would fit small inputs only, and change the plan.
    joined = docs.select(*kept).join(found.hint("merge"), same, "left")

    places = F.array_sort(F.array_distinct(F.flatten(F.transform("__starts", lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))))
    apart = lambda s: F.filter(s, lambda x, i: F.coalesce(x - F.get(s, i - 1) > 1, F.lit(True)))

    def cut(all_lines: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(all_lines) - 1)
        sequence = F.filter(numbers, lambda i: F.get(all_lines, i).rlike(WORDED))  # a place's line number
        gone = let(sequence, lambda q: F.transform(places, lambda at: F.get(q, at)))
        return F.array_join(F.transform(F.array_except(numbers, gone), lambda i: F.get(all_lines, i)), "\n")

    hit = F.col("__starts").isNotNull()
    out = {c: F.col(f"`{c}`") for c in kept}
    out["text"] = F.when(hit, let(F.split(text, "\n"), cut)).otherwise(text)
    out["n_lines"] = F.size(worded).cast("long")
    out["n_removed"] = F.when(hit, F.size(places)).otherwise(0).cast("long")
    out["n_runs"] = F.when(hit, F.size(let(places, apart))).otherwise(0).cast("long")
    return joined.select(*[c.alias(n) for n, c in out.items()])
