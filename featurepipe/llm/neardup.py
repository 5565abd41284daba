"""Operator 1: near-duplicate documents by bottom-k sketches and inverted lists.

A document's set holds the 64-bit hashes of its distinct word shingles; its sketch the k
smallest. Equal sets (equal size and 128-bit digest) form one class, and only classes go on.

1. Inverted lists. Two sets of Jaccard similarity t share about t*k of the k smallest values of
   their union, and each of those is in both sketches. With t = 0.8 and k = 48, fewer than 20
   are shared with probability below 1e-9; with sets of at most k shingles the sketches are the
   sets and the bound is certain. So a class lists itself only under the k - 20 + 1 rarest
   of its retained values: any two sketches that share 20 meet in one list at least, and values
   of passages that many documents share fill no lists unless they are most of a document.
2. A list's pivot is its most central member, the one with the fewest values of its own. All
   members are paired with their pivots; union-sketch estimation drops pairs whose k smallest
   union values hold fewer than 20/48 common ones, exact intersection of the full sets confirms
   the rest, and the links give components.
3. What two members of a list share besides is a pair inside their pivot's group. Groups in
   more than one component are cut into pieces of about 512 members, and every two pieces
   meet in a task that counts common retained values by matrix product, drops pairs with
   fewer than 20/48, confirms the rest on full sets and returns only the links that join two
   components. Pieces of the same component never meet, so thousands of near copies
   around one text cost one pair a member; no pair becomes a row unless it is such a link.

Intermediates (sketches, lists, full sets of listed classes) are tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from featurepipe.llm.common import WordHashes, connected_components, list_array, text_groups
from featurepipe.session import materialize

K = 48            # retained values of a sketch
PIECE = 512       # members of a group that a task compares with as many others
SHARED = 20       # of them shared by any linked pair, with probability above 1 - 1e-9
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    """Finishing step of the one hash function: spreads a 64-bit state over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list, width: int, seen: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; empty for null and for texts without words."""
    words = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    flat = seen.of([w for ws in words for w in ws]).view(np.uint64)
    out, at = [], 0
    if len(flat) >= width:
        run = flat[: len(flat) - width + 1].copy()
        for j in range(1, width):
            run = run * _MULT + flat[j: len(flat) - width + 1 + j]
        run = _mix(run).view(np.int64)
    for ws in words:
        n = len(ws)
        if n >= width:
            out.append(np.unique(run[at: at + n - width + 1]))
        elif n:
            state = np.array([n], np.uint64)
            for h in flat[at: at + n]:
                state = state * _MULT + h
            out.append(_mix(state).view(np.int64))
        else:
            out.append(np.empty(0, np.int64))
        at += n
    return out


_SKETCHES = "id long, n long, f1 long, f2 long, sketch array<long>"
_SETS = "id long, n long, f1 long, f2 long, sketch array<long>, whole binary"


def _sketcher(width: int, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for batch in batches:
            for rows, texts in text_groups(batch, "text"):
                sets = shingle_sets(texts, width, seen)
                marks = np.frombuffer(b"".join(xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
                cols = [rows.column(0), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(marks[:, 0]), pa.array(marks[:, 1]),
                        list_array([s[:K] for s in sets], pa.int64())]
                names = ["id", "n", "f1", "f2", "sketch"]
                if whole:
                    cols.append(pa.array([s.tobytes() for s in sets], pa.binary()))
                    names.append("whole")
                yield pa.RecordBatch.from_arrays(cols, names)
    return run


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = []
        for x, y in zip(batch.column("whole_a"), batch.column("whole_b"), strict=True):
            s, t = np.frombuffer(x.as_py(), np.int64), np.frombuffer(y.as_py(), np.int64)
            both.append(len(np.intersect1d(s, t, assume_unique=True)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), batch.column("n_a"), batch.column("n_b"),
             pa.array(both, pa.int64())], ["a", "b", "n_a", "n_b", "both"])


def _lists(classes: DataFrame) -> DataFrame:
    """``(value, id, n, alone)``: each class under the rarest of its retained values that must be met."""
    held = classes.select("id", "n", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    often = held.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = Window.partitionBy("id")
    need = F.ceil(F.col("k") * SHARED / K)
    return (held.join(often, "value")
            .withColumn("alone", F.col("k") - F.count(F.lit(1)).over(own))      # values no other class holds
            .withColumn("nth", F.row_number().over(own.orderBy("df", "value")))
            .where(F.col("nth") + F.col("alone") <= F.col("k") - need + 1)
            .select("value", "id", "n", "alone"))


def _close_sizes(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the threshold, with set sizes and intersection."""
    def side(name: str, *cols: str) -> DataFrame:
        return sets.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in cols])

    least = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, K)
    common = F.size(F.array_intersect(least, F.array_intersect("sketch_a", "sketch_b")))
    likely = (pairs.join(side("a", "sketch"), "a").join(side("b", "sketch"), "b")
              .where(common * K >= SHARED * F.size(least)).select("a", "b"))
    held = likely.join(side("a", "n", "whole"), "a").join(side("b", "n", "whole"), "b")
    return (held.mapInArrow(_exact, "a long, b long, n_a long, n_b long, both long")
            .where(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))))


def _common(rows: list[np.ndarray], cols: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of all ``rows`` with all ``cols`` (or ``rows``), by products of incidence blocks."""
    sets, first = rows + (cols or []), len(rows) if cols else 0
    who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    held = often[at] > 1
    at, who = (np.cumsum(often > 1) - 1)[at[held]], who[held]
    order = np.argsort(at, kind="stable")
    at, who = at[order], who[order]
    out = np.zeros((len(rows), len(cols or rows)), np.float32)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, 4096):
        part = slice(*np.searchsorted(at, (low, low + 4096)))
        block = np.zeros((len(sets), 4096), np.float32)
        block[who[part], at[part] - low] = 1
        out += block[: len(rows)] @ block[first:].T
    return out


def _joiner(percent: int):
    """Links between two pieces of a group that join two components; see the module's text."""
    def run(table: pa.Table) -> pa.Table:
        ids, comp, n = (np.asarray(table.column(c)) for c in ("id", "c", "n"))
        right = np.asarray(table.column("right"))
        x, y = np.flatnonzero(~right), np.flatnonzero(right)
        alone = not len(y)                                    # a piece with itself
        y = x if alone else y
        sketch = [np.asarray(v.values) for v in table.column("sketch")]
        need = np.array([-(-len(v) * SHARED // K) for v in sketch])
        seen = _common([sketch[i] for i in x], None if alone else [sketch[i] for i in y])
        likely = ((seen >= np.maximum(need[x][:, None], need[y][None, :])) & (comp[x][:, None] != comp[y][None, :])
                  & (100 * np.minimum(n[x][:, None], n[y][None, :]) >= percent * np.maximum(n[x][:, None], n[y][None, :])))
        rows, cols = likely.any(1), likely.any(0)             # the same of a piece with itself
        x, y, likely = x[rows], y[cols], likely[rows][:, cols]
        links = []
        if len(x):
            whole = {i: np.frombuffer(table.column("whole")[int(i)].as_py(), np.int64) for i in {*x.tolist(), *y.tolist()}}
            both = _common([whole[i] for i in x.tolist()], None if alone else [whole[i] for i in y.tolist()]).astype(np.int64)
            linked = likely & (100 * both >= percent * (n[x][:, None] + n[y][None, :] - both))
            root: dict[int, int] = {}
            for i, j in zip(*np.nonzero(linked), strict=True):
                a, b = int(comp[x[i]]), int(comp[y[j]])
                while a in root:
                    a = root[a]
                while b in root:
                    b = root[b]
                if a != b:
                    root[max(a, b)] = min(a, b)
                    links.append((int(ids[x[i]]), int(ids[y[j]])))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})
    return run


def _pieces(members: DataFrame) -> DataFrame:
    """``(p, x, y, id, c, right)``: the members of every two pieces of a group that must meet."""
    sizes = members.groupBy("p", "c").agg(F.count(F.lit(1)).alias("m"))
    mixed = (sizes.groupBy("p").agg(F.count(F.lit(1)).alias("parts"), F.sum(F.when(F.col("m") < PIECE, F.col("m")).otherwise(0)).alias("small"))
             .where("parts > 1").select("p", "small"))
    big = F.col("m") >= PIECE
    placed = (members.join(sizes, ["p", "c"]).join(mixed, "p")
              .withColumn("of", F.when(big, F.col("c")))      # pieces of one large component, or of many small ones
              .withColumn("piece", F.xxhash64(
                  "of", F.when(big, F.pmod(F.xxhash64("id"), F.ceil(F.col("m") / PIECE)))
                  .otherwise(F.pmod(F.xxhash64("c"), F.ceil(F.col("small") / PIECE)))))
              .select("p", "id", "c", "of", "piece"))
    placed = materialize(placed, "near-pieces")
    kinds = placed.groupBy("p", "piece").agg(F.first("of").alias("of"))
    meet = (kinds.select("p", F.col("piece").alias("x"), F.col("of").alias("ox"))
            .join(kinds.select("p", F.col("piece").alias("y"), F.col("of").alias("oy")), "p")
            .where("x <= y AND (ox IS NULL OR oy IS NULL OR ox != oy)").select("p", "x", "y"))
    left = placed.join(meet.withColumn("piece", F.col("x")), ["p", "piece"]).withColumn("right", F.lit(False))
    right = placed.join(meet.where("x < y").withColumn("piece", F.col("y")), ["p", "piece"]).withColumn("right", F.lit(True))
    return left.unionByName(right).select("p", "x", "y", "id", "c", "right")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; shingles hold
    ``width`` words, a shorter text is one shingle. Rows are linked when 100 * intersection
    >= ``percent`` * union; component_id is the smallest id reachable and kept marks its row.
    Texts without words (or null) have an empty set and are linked with nothing. Rows with a
    null id get a null component and are kept. Of rows that repeat an id with other texts, the
    one with the smallest set speaks for the id; every row gets that id's component. An empty
    table gives an empty result; other columns of ``docs`` are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    drawn = materialize(base.mapInArrow(_sketcher(width, False), _SKETCHES), "near-sketches")

    key = ["n", "f1", "f2"]
    speaks = (drawn.where("n > 0 AND id IS NOT NULL").groupBy("id")
              .agg(F.min(F.struct(*key)).alias("k")).select("id", "k.*"))
    reps = speaks.groupBy(*key).agg(F.min("id").alias("rep"))
    classes = (drawn.join(reps.withColumnRenamed("rep", "id"), ["id", *key])
               .groupBy("id", "n").agg(F.any_value("sketch").alias("sketch")))
    lists = materialize(_lists(classes), "near-lists")

    # full sets of the listed classes only, worked out again from their texts
    listed = lists.groupBy("id").agg(F.first("n").alias("rn"))
    marks = reps.select(F.col("rep").alias("id"), *key).join(listed.select("id"), "id", "left_semi")
    whole = (base.join(listed.select("id"), "id", "left_semi")
             .mapInArrow(_sketcher(width, True), _SETS).join(marks, ["id", *key], "left_semi"))
    sets = materialize(whole, "near-sets")
    sets = sets.dropDuplicates(["id"]) if sets.count() > listed.count() else sets

    pivots = lists.groupBy("value").agg(F.min(F.struct("alone", "id", "n")).alias("p"))
    star = materialize(lists.join(pivots, "value").where(F.col("id") != F.col("p.id"))
                       .select(F.col("p.id").alias("p"), "id", "n", F.col("p.n").alias("pn")).distinct(), "near-star")
    pairs = star.where(_close_sizes("n", "pn", percent)).select(F.col("p").alias("a"), F.col("id").alias("b"))
    links = materialize(_confirm(pairs, sets, percent).select("a", "b"), "near-links")

    found = connected_components(links)
    grouped = star.select("p", "id").unionByName(star.select("p", F.col("p").alias("id")).distinct())
    named = (grouped.join(found, F.col("id") == F.col("node"), "left")
             .select("p", "id", F.coalesce("component", "id").alias("c")))
    more = (_pieces(named).join(sets.select("id", "n", "sketch", "whole"), "id")
            .groupBy("p", "x", "y").applyInArrow(_joiner(percent), "a long, b long"))
    found = connected_components(links.unionByName(materialize(more, "near-links")))

    named = (speaks.join(reps, key)
             .join(found, F.col("rep") == F.col("node"), "left")
             .select("id", F.coalesce("component", "rep").alias("component")))
    return (drawn.select("id", "n").join(named, "id", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
