"""Records of CSV files whose quoted fields hold line breaks, cut in parallel.

A line break ends a record only outside quotes, and whether a block of a file begins inside quotes
depends on everything before it. So every line is a function of two states (outside, inside): where
it ends if it begins there. ``line_ends`` gives both answers by regex in the scan; a block's function
is the composition of its lines' functions, and the state at the start of each block is a running
composition over the blocks of its file, one narrow row each. A second scan then cuts every block
from its known state without a shuffle of text. Only what a block's border cuts in two is put
together by a shuffle: at most two pieces a block.

A malformed line cannot shift the rest of a file as a count of quotes would: a quote inside an
unquoted field is an ordinary character, so most lines end outside whatever came before them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurepipe.session import materialized

BLOCK = ("file", "block")
WHOLE, BEGINS, WITHIN, ENDS = 0, 1, 2, 3          # what of a record a row of ``_cut`` holds
_BROADCAST_ROWS = 100_000                         # most block states that a join broadcasts
BLANK = "".join(map(chr, range(33)))              # a record of these only is no row


def _patterns(sep: str) -> tuple[str, str]:
    """Regexes of a line that ends inside quotes, for one that begins outside and one inside them.
    Every repetition is possessive: no backtracking and no recursion, however long a line is."""
    end = re.escape(sep) + r"\r"
    quoted = r'(?:[^"]++|"")*+'
    rest = rf'(?:(?:"{quoted}"[^{end}]*+|[^"{end}][^{end}]*+)?+[{end}])*+"{quoted}\z'
    return rf"\A{rest}", rf'\A{quoted}(?:\z|"[^{end}]*+[{end}]{rest})'


def text_lines(spark: SparkSession, files: str | Sequence[str]) -> DataFrame:
    """``file, block, pos, value``: the lines of text files (ended by a line feed; a carriage return
    before it stays), with their place in scan order."""
    return spark.read.option("lineSep", "\n").text(files if isinstance(files, str) else list(files)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), "value")


def line_ends(value: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside quotes if it begins outside them, and if it begins inside them."""
    outside, inside = _patterns(sep)
    quote = value.contains('"')
    return quote & value.rlike(outside), ~quote | value.rlike(inside)


def _runs(batch) -> Iterator[tuple[str, int, int, int]]:
    """``(file, block, start, end)`` of the stretches of a batch's rows that lie in one block."""
    import numpy as np
    files = batch.column("file").dictionary_encode()
    where = np.stack([files.indices.to_numpy(zero_copy_only=False), batch.column("block").to_numpy()])
    cuts = [0, *(np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if lo < hi:
            yield files.dictionary[int(where[0, lo])].as_py(), int(where[1, lo]), lo, hi


def _block_functions(batches: Iterator) -> Iterator:
    """Compose the functions of a block's lines, which come together and in order."""
    import pyarrow as pa

    def row(*held) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(held, types)], ["file", "block", "a", "b"])

    key, a, b = None, False, True
    for batch in batches:
        ends_a, ends_b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        for file, block, lo, hi in _runs(batch):
            if (file, block) != key:
                if key is not None:
                    yield row(*key, a, b)
                key, a, b = (file, block), False, True
            for x, y in zip(ends_a[lo:hi], ends_b[lo:hi]):
                a, b = y if a else x, y if b else x
    if key is not None:
        yield row(*key, a, b)


def block_states(lines: DataFrame, sep: str) -> DataFrame:
    """``file, block, inside``: the blocks that begin inside quotes. Lines that change no state are
    left out before anything leaves the scan, and no text does."""
    a, b = line_ends(F.col("value"), sep)
    per_block = (lines.select(*BLOCK, a.alias("a"), b.alias("b")).where("a OR NOT b")
                 .mapInArrow(_block_functions, "file string, block long, a boolean, b boolean"))
    # running composition: the last block that ends alike from both states decides, and each later
    # one that swaps them turns it over. A block of lines that change nothing has no row here.
    past = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed = per_block.withColumn("n", F.sum(F.when(F.col("a") & ~F.col("b"), 1).otherwise(0)).over(past))
    last = F.last(F.when(F.col("a") == F.col("b"), F.struct("a", "n")), ignorenulls=True).over(past)
    ends = fixed.select(*BLOCK, F.coalesce(last["a"], F.lit(False)).alias("base"), (F.col("n") - F.coalesce(last["n"], F.lit(0))).alias("turns"))
    ends = ends.select(*BLOCK, (F.col("base") != (F.col("turns") % 2 == 1)).alias("state"))
    blocks = lines.select(*BLOCK).dropDuplicates().join(ends, list(BLOCK), "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(*BLOCK, F.coalesce(F.last("state", ignorenulls=True).over(before), F.lit(False)).alias("inside")).where("inside")


def _cut(sep: str):
    """The function that cuts lines, block by block, into records and pieces of records. Lines with
    neither a quote nor a carriage return go through whole stretches at a time."""
    outside, inside = _patterns(sep)

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        opens, stays = (re.compile(p.replace(r"\z", r"\Z")).match for p in (outside, inside))
        key, held, state, entered, n, seen = None, [], False, False, 0, False
        parts, heads, texts = [], [], []

        def emit(part: int, text: str) -> None:
            nonlocal seen
            heads.append(not seen and part in (WHOLE, BEGINS) and text.strip(BLANK) != "")
            seen = seen or heads[-1]
            parts.append(part)
            texts.append(text)

        def out() -> pa.RecordBatch:
            nonlocal n
            rows = pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(key[0], pa.string()), len(texts)), pa.repeat(pa.scalar(key[1], pa.int64()), len(texts)),
                pa.array(np.arange(n, n + len(texts))), pa.array(parts, pa.int32()), pa.array(heads, pa.bool_()), pa.array(texts, pa.string()),
            ], ["file", "block", "pos", "part", "head", "record"])
            n += len(texts)
            for rest in (parts, heads, texts):
                rest.clear()
            return rows

        def close() -> Iterator:
            if key is not None and state:              # the block ends inside quotes
                emit(WITHIN if entered else BEGINS, "".join(held))
            if texts:
                yield out()

        def plain(lines: list[str]) -> None:
            nonlocal held
            if state:
                held += ["\n".join(lines), "\n"]
                return
            while lines and not seen:
                emit(WHOLE, lines.pop(0))
            texts.extend(lines)
            parts.extend([WHOLE] * len(lines))
            heads.extend([False] * len(lines))

        for batch in batches:
            begins, values = batch.column("inside"), batch.column("value")
            marked = pc.or_(pc.match_substring(values, '"'), pc.match_substring(values, "\r")).to_numpy(zero_copy_only=False)
            for file, block, lo, hi in _runs(batch):
                if (file, block) != key:
                    yield from close()
                    key, held, n, seen = (file, block), [], 0, block > 0
                    state = entered = begins[lo].as_py()
                lines, at = values.slice(lo, hi - lo).to_pylist(), 0
                for k in [*np.flatnonzero(marked[lo:hi]).tolist(), hi - lo]:
                    if at < k:
                        plain(lines[at:k])
                    at = k + 1
                    if k == hi - lo:
                        break
                    value, end = lines[k], "\n"
                    if value.endswith("\r"):
                        value, end = value[:-1], "\r\n"
                    pieces = value.split("\r")             # a lone carriage return ends a line too
                    for i, text in enumerate(pieces):
                        after = state
                        if '"' in text:
                            after = bool(stays(text) if state else opens(text))
                        if after:
                            held.append(text + ("\r" if i < len(pieces) - 1 else end))
                        else:
                            emit(ENDS if entered else WHOLE, "".join(held) + text)
                            held, entered = [], False
                        state = after
                if texts:
                    yield out()
        yield from close()

    return cut


def _parts(placed: DataFrame, sep: str) -> DataFrame:
    return placed.select(*BLOCK, F.coalesce("inside", F.lit(False)).alias("inside"), "value").mapInArrow(
        _cut(sep), "file string, block long, pos long, part int, head boolean, record string")


def first_records(lines: DataFrame, sep: str = ",") -> DataFrame:
    """``file, record``: each file's first record that is not blank, where its first block holds it whole."""
    first = _parts(lines.where("block = 0").withColumn("inside", F.lit(False)), sep)
    return first.where(F.col("head") & (F.col("part") == WHOLE)).select("file", "record")


def cut_records(lines: DataFrame, sep: str = ",") -> DataFrame:
    """``file, block, pos, head, record``: the records of files (``text_lines``), each with the place
    where it begins and whether it is the first of its file that is not blank.

    A record keeps the line breaks inside its quotes as they are. One that never closes its quotes
    goes on to the end of its file, as for any reader of such files. Lines are cut twice: for the
    whole records, which no shuffle moves, and for the pieces at the borders of blocks. The blocks
    that begin inside quotes are found beforehand and written, a narrow row each.
    """
    states, _ = materialized(block_states(lines, sep), "csv-states")
    if states.count() <= _BROADCAST_ROWS:                       # a broadcast join keeps the scan's order
        placed = lines.join(F.broadcast(states), list(BLOCK), "left")
    else:
        placed = lines.join(states, list(BLOCK), "left").sortWithinPartitions(*BLOCK, "pos")
    parts = _parts(placed, sep)
    whole = parts.where(F.col("part") == WHOLE).drop("part")
    # a file has at most two pieces a block: the end of a record and the beginning of another
    order = Window.partitionBy("file").orderBy("block", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = parts.where(F.col("part") != WHOLE).withColumn("nth", F.sum(F.when(F.col("part") == BEGINS, 1).otherwise(0)).over(order))
    joined = pieces.groupBy("file", "nth").agg(
        F.min(F.struct("block", "pos")).alias("at"), F.max("head").alias("head"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "pos", "record"))), lambda p: p["record"]), "").alias("record"))
    return whole.unionByName(joined.select("file", "at.block", "at.pos", "head", "record"))
