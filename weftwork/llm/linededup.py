"""Line dedup by winnowing: window minima over hashes of line runs find repeated runs of lines, which are then extended.

The lines of a text are what ``\\n`` separates; a line is compared without white space at its ends. A line weighs as
many words as it has, one at least. A gram is the shortest run of lines from a given line on that weighs ``gram_words``;
a window is the shortest run from a given line on that weighs ``min_words``. The gram with the smallest hash within each
window (the first of equals) is a fingerprint. So every repeated run of lines that weighs ``min_words`` holds one that
is chosen in all its places, and no match is shorter than a gram.

Each fingerprint is joined to its first position, by document id and line number. From there the match is extended
both ways, line by line, as long as both texts agree, up to the fingerprints next to it, which have matches of their
own; the matched run is deleted from the later text. Fewer than ``2 * min_words`` lines lie between two fingerprints, so
what is joined is bounded. The two runs may not overlap when they lie in one text: the match ends before the later run
begins.

The first place of a fingerprint may agree on less than another early one. So the windows over each repeated fingerprint,
the shortest runs of ``min_words`` from a line on and up to a line, are looked up as a whole too: a window that stands
anywhere earlier is deleted. Each line of a repeated run that weighs ``min_words`` lies in such a window, and each window
of the run holds one of its fingerprints, so all lines of all these runs go.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import free_name, quoted, written
from weftwork.llm.textbatch import Hasher, run_hashes, signed, sliced, text_buffers, word_spans

GRAM_WORDS, MIN_WORDS = 8, 16

_LINES = "doc_id long, version long, lines array<long>, weights array<int>, marks array<int>, grams array<long>"


def line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and weight of each line, and the number of lines before each text; every text has one line at least."""
    breaks = np.flatnonzero(data == 10)
    texts = len(offsets) - 1
    per_text = np.diff(np.searchsorted(breaks, offsets)) + 1
    before = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)
    # A line starts at the start of its text or behind a break, and ends at the next break or the end of the text.
    starts = np.zeros(int(before[-1]), np.int64)
    ends = np.zeros_like(starts)
    first = np.zeros(len(starts), bool)
    first[before[:-1]] = True
    last = np.zeros(len(starts), bool)
    last[before[1:] - 1] = True
    starts[first], starts[~first] = offsets[:-1], breaks + 1
    ends[last], ends[~last] = offsets[1:], breaks
    assert texts == int(first.sum())
    word_starts, word_ends, _ = word_spans(data, offsets)
    low, high = np.searchsorted(word_starts, starts), np.searchsorted(word_starts, ends)
    words = high - low
    full = words > 0
    a, b = starts.copy(), starts.copy()
    a[full], b[full] = word_starts[low[full]], word_ends[high[full] - 1]
    return Hasher(data).of(a, b), np.maximum(words, 1), before


def fingerprints(hashes: list[int], weights: list[int], gram_words: int, min_words: int) -> list[tuple[int, int]]:
    """The chosen grams of one text: first line, hash."""
    n = len(hashes)
    ends, total, end = [], 0, 0
    for start in range(n):
        while end < n and total < gram_words:
            total += weights[end]
            end += 1
        if total < gram_words:
            break
        ends.append(end)
        total -= weights[start]
    grams = []
    for start, end in enumerate(ends):
        value = 0
        for h in hashes[start:end]:
            value = (value * 0x9E3779B97F4A7C15 + h + 1) % (1 << 64)
            value ^= value >> 29
        grams.append(value)
    chosen, total, end, last = set(), 0, 0, 0
    for start in range(len(ends)):
        while end < n and total < min_words:
            total += weights[end]
            end += 1
        if total < min_words:
            break
        last = max(last, start)
        while last + 1 < len(ends) and ends[last + 1] <= end:  # ends rise, so the grams within a window lie side by side
            last += 1
        chosen.add(min((grams[k], k) for k in range(start, last + 1))[1])
        total -= weights[start]
    return [(k, grams[k]) for k in sorted(chosen)]


def _winnow(gram_words: int, min_words: int):
    def run(batches):
        for batch in sliced(batches, "text"):
            data, offsets = text_buffers(batch.column(2))
            hashes, weights, before = line_hashes(data, offsets)
            marks, grams, counts = [], [], []
            for k in range(batch.num_rows):
                own = slice(before[k], before[k + 1])
                found = fingerprints(hashes[own].tolist(), weights[own].tolist(), gram_words, min_words)
                marks.extend(line for line, _ in found)
                grams.extend(gram for _, gram in found)
                counts.append(len(found))
            ends = pa.array(before.astype(np.int32))
            mark_ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.ListArray.from_arrays(ends, pa.array(signed(hashes))),
                    pa.ListArray.from_arrays(ends, pa.array(np.minimum(weights, min_words).astype(np.int32))),
                    pa.ListArray.from_arrays(mark_ends, pa.array(marks, pa.int32())),
                    pa.ListArray.from_arrays(mark_ends, pa.array(signed(np.array(grams, dtype=np.uint64)))),
                ],
                names=["doc_id", "version", "lines", "weights", "marks", "grams"],
            )

    return run


def windows(hashes: np.ndarray, weights: np.ndarray, wanted: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, ends and hashes of the shortest runs of ``min_words`` from a line on, and up to a line, that hold a wanted line."""
    n = len(hashes)
    sums = np.concatenate([[0], np.cumsum(weights, dtype=np.int64)])
    lines = np.arange(n)
    on = np.searchsorted(sums, sums[:-1] + min_words)
    back = np.searchsorted(sums, sums[1:] - min_words, side="right") - 1
    pairs = np.concatenate([np.stack([lines, on], 1)[on <= n], np.stack([back, lines + 1], 1)[back >= 0]])
    marked = np.zeros(n + 1, np.int64)
    marked[wanted + 1] = 1
    marked = np.cumsum(marked)
    pairs = np.unique(pairs[marked[pairs[:, 1]] > marked[pairs[:, 0]]], axis=0)
    return pairs[:, 0], pairs[:, 1], run_hashes(hashes, pairs[:, 0], pairs[:, 1])


def _contexts(min_words: int):
    """For each wanted fingerprint its lines, those back to the one before it, and those on to the end of the next.

    And, with an end ``to``, all windows over wanted fingerprints.
    """

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                lines, marks = row["lines"], row["marks"]
                place = {at: k for k, at in enumerate(marks)}
                for w in row["wanted"]:
                    at, k = w["at"], place[w["at"]]
                    begin = marks[k - 1] if k else 0
                    end = marks[k + 1] + min_words if k + 1 < len(marks) else len(lines)
                    out.append((w["hash"], w["is_first"], row["doc_id"], row["version"], at, lines[begin:at], lines[at:end], None))
                at = np.array([w["at"] for w in row["wanted"]])
                found = windows(np.array(lines, np.int64).view(np.uint64), np.array(row["weights"]), at, min_words)
                for begin, end, value in zip(*(x.tolist() for x in (found[0], found[1], signed(found[2])))):
                    out.append((value, None, row["doc_id"], row["version"], begin, None, None, end))
            columns = list(zip(*out)) or [[] for _ in range(8)]
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32()]
            names = ["hash", "is_first", "doc_id", "version", "at", "back", "on", "to"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def agreement(own: list[int], other: list[int], room: int) -> int:
    """How many values agree from the start, at most ``room``."""
    n = 0
    for x, y in zip(own[: max(room, 0)], other):
        if x != y:
            break
        n += 1
    return n


def _runs(batches):
    for batch in batches:
        begins, ends = [], []
        for row in batch.to_pylist():
            at = row["at"]
            room = at - row["first_at"] if (row["doc_id"], row["version"]) == (row["first_id"], row["first_version"]) else 1 << 30
            back = agreement(row["back"][::-1], row["first_back"][::-1], room - 1)
            on = agreement(row["on"], row["first_on"], room - back)
            begins.append(at - back)
            ends.append(at + on)
        columns = [batch.column(0), batch.column(1), pa.array(begins, pa.int32()), pa.array(ends, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "begin", "end"])


def _union(batches):
    """The numbers of the lines that the runs of a text cover, and for each line up to the last of them whether it goes."""
    for batch in batches:
        drops, masks = [], []
        for runs in batch.column(2):
            begins, ends = (runs.values.field(k).to_numpy() for k in (0, 1))
            covered = np.zeros(int(ends.max()) + 1, np.int64)
            np.add.at(covered, begins, 1)
            np.add.at(covered, ends, -1)
            covered = np.cumsum(covered[:-1]) > 0
            drops.append(np.flatnonzero(covered).astype(np.int32))
            masks.append(covered)
        columns = [batch.column(0), batch.column(1), pa.array(drops, pa.list_(pa.int32())), pa.array(masks, pa.list_(pa.bool_()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "drop", "mask"])


def repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", gram_words: int = GRAM_WORDS, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, version, drop, mask)``: for each text with repeated runs, the numbers of the lines to delete.

    ``mask`` tells for each line, up to the last one to delete, whether it goes.

    ``version`` is a hash of the text, which tells texts apart that share an id; of these, and of repeated rows,
    the first in order of the hash counts as earlier. Rows with a null id or text are not looked at.
    """
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(F.col(text_column)).alias("version"), F.col(text_column).alias("text")
    ).filter("doc_id is not null and text is not null")
    lines = written(texts.mapInArrow(_winnow(gram_words, min_words), _LINES), "lines")
    marks = lines.select("doc_id", "version", F.inline(F.arrays_zip("marks", "grams"))).toDF("doc_id", "version", "at", "hash")
    place = F.struct("doc_id", "version", "at")
    firsts = marks.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    wanted = marks.join(firsts.select("hash", "first"), "hash").withColumn("is_first", place == F.col("first"))
    wanted = wanted.groupBy("doc_id", "version").agg(F.collect_set(F.struct("at", "hash", "is_first")).alias("wanted"))
    own = lines.select("doc_id", "version", "lines", "weights", "marks").dropDuplicates(["doc_id", "version"])
    both = own.join(wanted, ["doc_id", "version"]).select("doc_id", "version", "lines", "weights", "marks", "wanted")
    schema = "hash long, is_first boolean, doc_id long, version long, at int, back array<long>, on array<long>, to int"
    contexts = written(both.mapInArrow(_contexts(min_words), schema), "line-contexts")
    first = contexts.filter("is_first").select(
        "hash", F.col("doc_id").alias("first_id"), F.col("version").alias("first_version"), F.col("at").alias("first_at"),
        F.col("back").alias("first_back"), F.col("on").alias("first_on"),
    )
    later = contexts.filter("not is_first").join(first, "hash").drop("hash", "is_first", "to")
    later = later.select("doc_id", "version", *[c for c in later.columns if c not in ("doc_id", "version")])
    found = later.mapInArrow(_runs, "doc_id long, version long, begin int, end int")
    runs = contexts.filter("to is not null").select("hash", "doc_id", "version", "at", "to")
    earliest = runs.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last").drop("last")
    # In one text, the earlier place has to end before the later one begins.
    apart = (F.col("doc_id") != F.col("first.doc_id")) | (F.col("version") != F.col("first.version")) | (F.col("at") - F.col("first.at") >= F.col("to") - F.col("at"))
    again = runs.join(earliest, "hash").filter(apart).select("doc_id", "version", F.col("at").alias("begin"), F.col("to").alias("end"))
    found = found.unionAll(again).groupBy("doc_id", "version").agg(F.collect_set(F.struct("begin", "end")).alias("runs"))
    return found.mapInArrow(_union, "doc_id long, version long, drop array<int>, mask array<boolean>")


def without_repeated_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    gram_words: int = GRAM_WORDS,
    min_words: int = MIN_WORDS,
    count_column: str = "lines_dropped",
) -> DataFrame:
    """``docs`` with its repeated runs of lines deleted, and ``count_column``, their number.

    What is left of a text are its other lines, joined by ``\\n``; a text all of whose lines are repeated becomes empty.
    Rows with a null id or text come back as they are. All columns stay, whatever their names; only one that is called
    as ``count_column`` is replaced.
    """
    drops = written(repeated_lines(docs, id_column, text_column, gram_words, min_words), "line-drops")
    row, found = free_name("row", docs), free_name("found", docs)
    rows = docs.select(F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias(row))
    text = F.col(row)[text_column]
    # Both sides are shuffled at every size: the list of lines grows with the documents.
    drops = drops.select(F.col("doc_id").alias("drop_id"), F.col("version").alias("drop_version"), F.struct("drop", "mask").alias(found))
    same = (F.col(row)[id_column].cast("long") == F.col("drop_id")) & (F.xxhash64(text) == F.col("drop_version"))
    joined = rows.join(drops.hint("merge"), same, "left")
    kept = F.filter(F.split(text, "\n", -1), lambda _, i: ~F.coalesce(F.get(F.col(found)["mask"], i), F.lit(False)))
    changed = F.when(F.col(found).isNull(), text).otherwise(F.array_join(kept, "\n")).alias(text_column)
    dropped = F.when(F.col(found).isNull(), 0).otherwise(F.size(F.col(found)["drop"])).alias(count_column)
    return joined.select(*[changed if c == text_column else F.col(row)[c].alias(c) for c in docs.columns if c != count_column], dropped)
