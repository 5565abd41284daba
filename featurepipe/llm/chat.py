"""Operator 4: chat formatting by quotation linking, with DataFrame functions only.

Each line's quote level is the number of ``>`` marks that begin it; own text has level 0. Runs of
quoted lines of one level are passages; a passage of level n quotes what the answered message holds
at level n - 1. Passages and their single lines are normalised (white space runs to one space, A-Z
lower-cased) and hashed, as are the whole own text of every message and the paragraphs and lines of
all its levels. A range sort by (conversation, hash, level, turn) puts each quote behind its
original. The level below counts first; where no turn holds a passage there, as when the message between is
missing, the next lower one does, down to own text. Then the shallowest passages count first, whole
passages before single lines, and the latest turn wins. Replies thus form trees; conversations are
ordered tree by tree, every reply after its original, with quotes removed.

Roots are found by pointer jumping, one join per doubling of the longest reply chain, and
places by a range partitioning, so a conversation of any size never meets in one task.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurepipe.functions import once
from featurepipe.llm.common import ASCII_LOWER, ASCII_UPPER
from featurepipe.operators.ordering import dense_index
from featurepipe.session import broadcast_if_small, materialize

_MARKS = r"^[ \t>]*>"                   # one class, so that a match takes no stack however long it is


def _normal(text: Column) -> Column:
    return F.translate(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), ASCII_UPPER, ASCII_LOWER)


def _hash(text: Column) -> list[Column]:
    """128 bits of a normalised passage."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _lines(text: Column) -> Column:
    """array<struct<level, body>> of the lines of a text; the level is the number of ``>`` that begin
    the line, spaces and tabs between them allowed, and bodies lose these marks and one space."""
    def told(marks: Column, line: Column) -> Column:
        body = F.substr(line, F.length(marks) + 1)
        return F.struct(F.length(F.translate(marks, " \t", "")).alias("level"), F.when(
            (F.length(marks) > 0) & body.startswith(" "), F.substr(body, F.lit(2))).otherwise(body).alias("body"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n", -1), lambda s: F.when(
        s.contains(">"), once(F.regexp_extract(s, _MARKS, 0), lambda marks: told(marks, s))).otherwise(
        F.struct(F.lit(0).alias("level"), s.alias("body"))))


def _own_text(lines: Column) -> Column:
    """The unquoted lines joined, without blank lines (spaces and tabs) at the ends; of blank lines
    alone the last one stays."""
    own = F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["body"])

    def cut(own: Column) -> Column:
        said = F.transform(own, lambda s, i: F.when(F.length(F.translate(s, " \t", "")) > 0, i))
        first, last = (F.coalesce(end(said), F.size(own) - 1) for end in (F.array_min, F.array_max))
        return F.array_join(F.slice(own, first + 1, last - first + 1), "\n")

    def whole(own: Column) -> Column:
        full = [F.length(F.translate(F.element_at(own, k), " \t", "")) > 0 for k in (1, -1)]
        return F.when(F.size(own) == 0, "").when(full[0] & full[1], F.array_join(own, "\n")).otherwise(cut(own))

    return once(own, whole)


def _run_starts(lines: Column) -> Column:
    """0-based places of the lines whose level is not that of the line before."""
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    return F.filter(places, lambda i: (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]))


def _passages(lines: Column, starts: Column) -> Column:
    """array<struct<level, body>> of the runs of quoted lines of one level, lines kept apart by line ends."""
    runs = F.transform(starts, lambda s, k: F.slice(lines, s + 1, F.coalesce(F.get(starts, k + 1), F.size(lines)) - s))
    return F.transform(F.filter(runs, lambda r: F.get(r, F.lit(0))["level"] > 0), lambda r: F.struct(
        F.get(r, F.lit(0))["level"].alias("level"), F.array_join(F.transform(r, lambda x: x["body"]), "\n").alias("body")))


def _units(passages: Column, split: str) -> Column:
    """array<struct<level, unit>>: the normalised parts of passages."""
    return F.flatten(F.transform(passages, lambda p: F.transform(F.split(p["body"], split), lambda t: F.struct(
        p["level"].alias("level"), _normal(t).alias("unit")))))


_PASSAGE = ["conv_id", "h1", "h2"]


def _nearest_levels(asked: DataFrame, given: DataFrame) -> DataFrame:
    """``asked`` with ``held``, the highest level below the quote's own at which an earlier turn holds
    the passage; rows without one go.

    A passage comes with the list of its levels and their first turns. A list of L levels takes L*L/2
    marks in the conversation's text, so it stays short beside that text.
    """
    first = given.groupBy(*_PASSAGE, "held").agg(F.min("turn").alias("first"))
    levels = first.groupBy(*_PASSAGE).agg(F.collect_list(F.struct("held", "first")).alias("levels"))
    below = F.filter("levels", lambda x: (x["held"] < F.col("level")) & (x["first"] < F.col("by")))
    return (asked.join(levels, _PASSAGE).withColumn("held", F.array_max(F.transform(below, lambda x: x["held"])))
            .where("held IS NOT NULL").drop("levels"))


def _latest_holders(asked: DataFrame, given: DataFrame) -> DataFrame:
    """``asked`` with ``parent``, the latest turn before ``by`` that holds the passage at level ``held``.

    Both sides are sorted into ranges of (passage, level, turn), where each quote follows its original.
    A passage that goes over several ranges takes its last holder along: at most one passage crosses
    each border, so the table of what is carried has about as many rows as there are ranges. No
    quote meets more than one row, however many turns hold its passage.
    """
    key = [*_PASSAGE, "held"]
    points = asked.withColumn("turn", F.col("by")).unionByName(
        given.join(asked.select(*_PASSAGE).distinct(), _PASSAGE, "left_semi"), allowMissingColumns=True)
    points = points.withColumn("holds", F.col("by").isNull()).persist(StorageLevel.MEMORY_AND_DISK)
    order = ["turn", "holds", "mark", "rank"]                  # quotes of a turn before what it holds itself
    ranged = materialize(points.repartitionByRange(*key, *order).withColumn("part", F.spark_partition_id()), "chat-ranges")
    points.unpersist()
    said = F.when(F.col("holds"), F.col("turn"))
    span = Window.partitionBy("part", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ends = ranged.groupBy(*key, "part").agg(F.max(said).alias("last"))
    wide = ends.groupBy(*key).agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select(*key)
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = broadcast_if_small(ends.join(broadcast_if_small(wide), key).withColumn("carried", F.max("last").over(before))
                                 .select(*key, "part", "carried"))
    return (ranged.withColumn("here", F.max(said).over(span)).where("NOT holds").join(carried, [*key, "part"], "left")
            .withColumn("parent", F.coalesce("here", "carried")))


def format_chats(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """``(conv_id, turn, role, text, n_quoted, parent_turn, root_turn, place)`` of every row.

    ``text`` is the message without quoted lines, ``n_quoted`` their number, ``parent_turn`` the
    quoted earlier turn (null if none is found at any level), ``root_turn`` the first of its reply tree and
    ``place`` the 0-based position in the conversation's reply order. Null texts are empty.
    Null conversations or turns quote nothing and are ordered first. Rows that repeat a turn stand
    side by side and quote alike only if their texts do. Other columns are not read.
    """
    base = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                        F.col(text_col).alias("said"))
    lines = _lines(F.col("said"))
    read = (base.withColumn("lines", lines)
            .select("conv_id", "turn", "role", "said", F.size(F.filter("lines", lambda x: x["level"] > 0)).cast("long").alias("n_quoted"),
                    _own_text(F.col("lines")).alias("text"), F.when(F.exists("lines", lambda x: x["level"] > 0), F.col("lines")).alias("lines")))
    read = (read.withColumn("starts", _run_starts(F.col("lines")))
            .select("conv_id", "turn", "role", "said", "n_quoted", "text", _passages(F.col("lines"), F.col("starts")).alias("passages")))

    quoting = read.where("passages IS NOT NULL AND conv_id IS NOT NULL AND turn IS NOT NULL")
    whole = F.transform("passages", lambda p: F.struct(p["level"].alias("level"), _normal(p["body"]).alias("unit"), F.lit(1).alias("rank")))
    single = F.transform(_units(F.col("passages"), "\n"), lambda u: F.struct(u["level"], u["unit"], F.lit(0).alias("rank")))
    asked = (quoting.select("conv_id", "turn", "said", F.explode(F.concat(whole, single)).alias("q")).where("q.unit != ''")
             .select("conv_id", F.col("turn").alias("by"), F.xxhash64("said").alias("mark"), *_hash(F.col("q.unit")), "q.level", "q.rank")
             .distinct())
    # originals only of conversations that quote at all
    heard = read.join(asked.select("conv_id").distinct(), "conv_id", "left_semi").where("turn IS NOT NULL")
    own = F.transform(F.concat(F.array("text"), F.split("text", r"\n[ \t]*\n"), F.split("text", "\n")),
                      lambda t: F.struct(F.lit(0).alias("level"), _normal(t).alias("unit")))
    quoted = F.concat(F.transform("passages", lambda p: F.struct(p["level"].alias("level"), _normal(p["body"]).alias("unit"))),
                      _units(F.col("passages"), r"\n[ \t]*\n"), _units(F.col("passages"), "\n"))
    parts = F.array_distinct(F.when(F.col("passages").isNull(), own).otherwise(F.concat(own, quoted)))
    given = (heard.select("conv_id", "turn", F.explode(parts).alias("p")).where("p.unit != ''")
             .select("conv_id", *_hash(F.col("p.unit")), F.col("p.level").alias("held"), "turn").distinct())
    given = materialize(given, "chat-passages")
    best = F.max(F.struct((F.col("held") - F.col("level")).alias("near"), -F.col("level"), "rank", "parent")).alias("best")
    parent = (_latest_holders(_nearest_levels(asked, given), given).where("parent IS NOT NULL").groupBy("conv_id", "by", "mark").agg(best)
              .select("conv_id", F.col("by").alias("turn"), "mark", F.col("best.parent").alias("parent_turn")))
    parent = materialize(parent, "chat-parents")

    up = parent.groupBy("conv_id", "turn").agg(F.max("parent_turn").alias("up"))
    while True:                                             # pointer jumping: chains halve each round
        higher = up.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("higher"))
        jumped = materialize(up.join(higher, ["conv_id", "up"], "left")
                             .select("conv_id", "turn", F.coalesce("higher", "up").alias("up"), F.col("higher").isNotNull().alias("moved")), "chat-roots")
        up = jumped.drop("moved")
        if not jumped.where("moved").limit(1).count():
            break

    out = (read.withColumn("mark", F.xxhash64("said")).drop("passages", "said")
           .join(parent, ["conv_id", "turn", "mark"], "left").join(up, ["conv_id", "turn"], "left")
           .withColumn("root_turn", F.coalesce("up", "turn")))
    order = ["root_turn", "turn", "mark", F.coalesce("role", F.lit(""))]
    return (dense_index(out, order, partition_by=["conv_id"], name="place")
            .select("conv_id", "turn", "role", "text", "n_quoted", "parent_turn", "root_turn", "place"))
