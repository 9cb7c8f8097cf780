"""Records of large CSV and JSON files, read by many tasks however few the files are.

A record may hold the line breaks and commas that files are cut at, in quotes. Whether a byte is inside quotes
depends on all bytes before it, but only through a small state: the parity of the quotes, and for JSON the depth
of brackets. So two passes do: the first gives each byte range its effect on the state (for both parities it may
start with), a running sum over the ranges of a file gives each range its start, and the second pass cuts every
range on its own. A record belongs to the range it starts in; what crosses a border is put together afterwards.

Ranges are those of Spark's text source (`spark.sql.files.maxPartitionBytes`), which cuts at a separator.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuemart.session import use_checkpoints

#: Rows of the table of range starts that may be sent to all tasks: about 100 bytes for each range of 128 MB.
MOST_RANGES = 500_000

#: A record as a whole, the start of one that goes on, a part of one, and its end.
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3

_OUT = "path string, at bigint, kind int, first boolean, value string"


def _pieces(spark: SparkSession, paths: str | list[str], separator: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.option("lineSep", separator)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("piece")
    )


def _segments(batches) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Parts of the batches that lie in one range each, in the order of the file."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at, path = batch.column("at"), batch.column("path")
        new = np.flatnonzero(
            (np.diff(at.to_numpy(zero_copy_only=False)) != 0) | pc.not_equal(path.slice(1), path.slice(0, len(path) - 1)).to_numpy(zero_copy_only=False)
        )
        cuts = [0, *(new + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            yield path[low].as_py(), at[low].as_py(), batch.slice(low, high - low)


def _effects(pieces: DataFrame, effect: Callable[[pa.RecordBatch, int], tuple[int, int, int]]) -> DataFrame:
    """Per range: how it turns the parity, and what it adds to the depth if it starts outside or inside quotes.

    effect(part, parity) gives the same for a part of a range that has the parity by now, if the range starts
    outside. `opens` is the first character of a file that is no white space, null in its later ranges.
    """

    def run(batches):
        held, state, opens = None, [0, 0, 0], None
        for path, at, part in _segments(batches):
            if (path, at) != held:
                if held:
                    yield row(held, state, opens)
                held, state, opens = (path, at), [0, 0, 0], None
            if at == 0 and opens is None:
                opens = next((t[0] for p in part.column("piece") if (t := p.as_py().lstrip(" \t\r\n\ufeff"))), None)
            turn, outside, inside = effect(part, state[0])
            state = [state[0] ^ turn, state[1] + outside, state[2] + inside]
        if held:
            yield row(held, state, opens)

    def row(key, state, opens):
        columns = [*[pa.array([x]) for x in (*key, *state)], pa.array([opens], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["path", "at", "turn", "outside", "inside", "opens"])

    return pieces.mapInArrow(run, "path string, at bigint, turn bigint, outside bigint, inside bigint, opens string")


def _starts(effects: DataFrame) -> DataFrame:
    """Per range: whether it starts inside quotes, and at which depth."""
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    quoted = effects.withColumn("quoted", F.coalesce(F.sum("turn").over(before), F.lit(0)) % 2)
    adds = F.when(F.col("quoted") == 1, F.col("inside")).otherwise(F.col("outside"))
    return quoted.withColumn("adds", adds).withColumn("depth", F.coalesce(F.sum("adds").over(before), F.lit(0))).withColumn(
        "single", F.coalesce(F.max("opens").over(Window.partitionBy("path")) != "[", F.lit(False))
    ).select("path", "at", "quoted", "depth", "single")


def _with_starts(pieces: DataFrame, effects: DataFrame) -> list[DataFrame]:
    """The pieces of each range with its start, in groups of files so small that their starts can be sent to all tasks.

    Rows stay in the order of the file: nothing moves but the starts. A range without a start means that the
    files were cut differently this time, say after a change of the cluster, and is an error.
    """
    use_checkpoints(pieces.sparkSession)
    starts = _starts(effects).checkpoint()
    groups = max(1, -(-starts.count() // MOST_RANGES))
    out = []
    for group in range(groups):
        mine = F.pmod(F.xxhash64("path"), F.lit(groups)) == group
        met = pieces.where(mine).join(F.broadcast(starts.where(mine)), ["path", "at"], "left")
        sure = F.when(F.col("quoted").isNull(), F.raise_error(F.lit("a range was cut differently in the second pass"))).otherwise(F.col("quoted"))
        out.append(met.withColumn("quoted", sure.cast("bigint")))
    return out


def _put_together(found: DataFrame, glue: str) -> DataFrame:
    """(path, at, first, value): whole records as they are, and those in parts glued, at the range of their head.

    Parts are at most two per range, so a window over the parts of a file is small.
    """
    parts = found.where(F.col("kind") != WHOLE)
    order = F.when(F.col("kind") == HEAD, 1).otherwise(0)
    number = F.sum(order).over(Window.partitionBy("path").orderBy("at", order).rowsBetween(Window.unboundedPreceding, 0))
    named = parts.withColumn("number", number).withColumn("order", order)
    ordered = F.array_sort(F.collect_list(F.struct("at", "order", "value", "first")))
    glued = named.groupBy("path", "number").agg(ordered.alias("all"))
    glued = glued.select("path", F.col("all")[0]["at"].alias("at"), F.col("all")[0]["first"].alias("first"), F.array_join(F.transform("all", lambda x: x["value"]), glue).alias("value"))
    return found.where(F.col("kind") == WHOLE).select("path", "at", "first", "value").unionByName(glued)


def _rows(path: str, at: int, kinds: list[int], firsts: list[bool], values: pa.Array) -> pa.RecordBatch:
    n = len(values)
    columns = [pa.array([path] * n, pa.string()), pa.array(np.full(n, at, np.int64)), pa.array(kinds, pa.int32()), pa.array(firsts, pa.bool_()), values]
    return pa.RecordBatch.from_arrays(columns, ["path", "at", "kind", "first", "value"])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


# CSV


def _quotes(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def csv_records(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, at, first, value): the records of CSV files as text, line breaks in quotes included.

    Quotes are doubled inside quotes, so each record has an even number of them. `first` marks the first record
    of a file. Empty lines outside quotes are no records. A file that ends inside quotes ends its last record.
    """
    lines = _pieces(spark, paths, "\n", glob)

    def effect(part, parity):
        return int(_quotes(part.column("piece")).sum() & 1), 0, 0

    def run(batches):
        held, open_, started, top = None, [], True, False
        for path, at, part in _segments(batches):
            if (path, at) != held:
                if held and open_:
                    yield _rows(*held, [HEAD if started else MIDDLE], [top and started], pa.array(["\n".join(open_)], pa.string()))
                held, open_, top = (path, at), [], at == 0
                started = part.column("quoted")[0].as_py() == 0
                opened = not started
            text = part.column("piece")
            after = np.cumsum(np.append(int(opened), _quotes(text))) & 1
            ends = np.flatnonzero(after[1:] == 0) + 1
            opened = bool(after[-1])
            if not len(ends):
                open_ += text.to_pylist()
                continue
            offsets = np.concatenate([[0], ends])
            kinds, firsts = np.full(len(ends), WHOLE), np.zeros(len(ends), bool)
            whole = text.slice(0, int(ends[-1]))
            values = whole if len(ends) == len(whole) else pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), whole), "\n")
            if open_:
                values = pa.concat_arrays([pa.array(["\n".join([*open_, values[0].as_py()])], pa.string()), values.slice(1)])
            if not started:
                kinds[0], started = TAIL, True
            full = np.flatnonzero((kinds != WHOLE) | ~pc.match_substring_regex(values, r"^\r?$").to_numpy(zero_copy_only=False))
            open_ = text.slice(int(ends[-1])).to_pylist()
            if len(full):
                if top and kinds[full[0]] == WHOLE:
                    firsts[full[0]], top = True, False
                yield _rows(path, at, kinds[full].tolist(), firsts[full].tolist(), values.take(pa.array(full)))
        if held and open_:
            yield _rows(*held, [HEAD if started else MIDDLE], [top and started], pa.array(["\n".join(open_)], pa.string()))

    found = _union([p.mapInArrow(run, _OUT) for p in _with_starts(lines, _effects(lines, effect))])
    records = _put_together(found, "\n")
    # The carriage return of a line that ends a record is outside quotes.
    return records.withColumn("value", F.regexp_replace("value", r"\r\z", ""))


# JSON


def _bytes(pieces: pa.Array) -> np.ndarray:
    """The bytes of all pieces, each with the comma that the text source took away."""
    whole = pc.binary_join_element_wise(pieces, pa.scalar(",", pieces.type), pa.scalar("", pieces.type))
    _, offsets, data = whole.buffers()
    ends = np.frombuffer(offsets, np.int32)[whole.offset : whole.offset + len(whole) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]


def _marks(data: np.ndarray, parity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Per byte: whether it is outside strings, and what it adds to the depth there; and the parity at the end."""
    quote = data == 34
    slash = data == 92
    if slash.any():
        # A quote is escaped by an odd number of backslashes before it.
        places = np.arange(len(data))
        last = np.maximum.accumulate(np.where(slash, -1, places))
        quote &= (places - 1 - np.append(-1, last[:-1])) % 2 == 0
    inside = (np.cumsum(quote) + parity) & 1
    step = ((data == 91) | (data == 123)).astype(np.int64) - ((data == 93) | (data == 125))
    return inside == 0, step, int(inside[-1]) if len(data) else parity


def json_values(spark: SparkSession, paths: str | list[str], glob: str | None = "*.json") -> DataFrame:
    """(path, at, first, value): the elements of each file's array as JSON text, or the file's only value.

    Strings may hold brackets, commas and escaped quotes. Empty arrays and empty files have no values.
    """
    pieces = _pieces(spark, paths, ",", glob)

    def effect(part, parity):
        outside, step, end = _marks(_bytes(part.column("piece")), parity)
        return end ^ parity, int(step[outside].sum()), int(step[~outside].sum())

    def run(batches):
        held, open_, parity, depth, started, single, within = None, [], 0, 0, True, False, False

        def left():
            rest = b"".join(open_).decode()
            if single:
                # The file's only value: its last comma is the one that was put there.
                return _rows(*held, [HEAD if held[1] == 0 else MIDDLE], [held[1] == 0], pa.array([rest], pa.string()))
            if depth <= 1 and parity == 0:
                # The range ends outside the array, or with the comma after a value.
                return None
            return _rows(*held, [HEAD if started else MIDDLE], [False], pa.array([rest], pa.string()))

        for path, at, part in _segments(batches):
            if (path, at) != held:
                if held and (rows := left()):
                    yield rows
                held, open_ = (path, at), []
                parity, depth = part.column("quoted")[0].as_py(), part.column("depth")[0].as_py()
                started, single = depth <= 1 and parity == 0, part.column("single")[0].as_py()
                within = depth >= 1 or parity == 1
            data = _bytes(part.column("piece"))
            if single:
                open_.append(data.tobytes())
                continue
            outside, step, parity_after = _marks(data, parity)
            moved = np.where(outside, step, 0)
            level = depth + np.cumsum(moved)
            # A value starts after the array's bracket, and ends at a comma on its level or at the last bracket.
            begin = outside & (data == 91) & (level == 1)
            end = outside & (((data == 44) & (level == 1)) | ((data == 93) & (level == 0)))
            raw, kinds, values, at_byte = data.tobytes(), [], [], 0
            for k in np.flatnonzero(begin | end).tolist():
                if end[k]:
                    text = (b"".join(open_) + raw[at_byte:k]).decode() if within else ""
                    open_, kind = [], WHOLE if started else TAIL
                    if kind == TAIL or text.strip():
                        kinds.append(kind)
                        values.append(text if kind == TAIL else text.strip())
                    started = True
                    within = data[k] == 44
                else:
                    within, started, open_ = True, True, []
                at_byte = k + 1
            if within:
                open_.append(raw[at_byte:])
            parity, depth = parity_after, int(level[-1])
            if values:
                yield _rows(path, at, kinds, [False] * len(values), pa.array(values, pa.string()))
        if held and (rows := left()):
            yield rows

    found = _union([p.mapInArrow(run, _OUT) for p in _with_starts(pieces, _effects(pieces, effect))])
    whole = _put_together(found, "")
    value = F.when(F.col("first"), F.regexp_replace("value", r",\s*\z", "")).otherwise(F.col("value"))
    return whole.withColumn("value", F.trim(value)).where("value != ''")

