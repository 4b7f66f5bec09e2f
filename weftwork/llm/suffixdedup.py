"""Repeated byte strings, found by suffix arrays over shards that hold all places of a string.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else.

1. *Shards.* Every window of ``LENGTH`` bytes has an anchor: the run of ``GRAM`` bytes with the smallest hash in it, the
   leftmost of equals. Equal windows have equal anchors at the same distance, so all places of a repeated window carry
   the same anchor hash. The windows of one anchor lie side by side and make up a region of the text.
2. *Counting.* Regions with an anchor that occurs once hold nothing repeated. Regions that occur twice as a whole are
   repeated as a whole. This settles all but the regions at the ends of repeats and around changes. Of these, only
   such can hold a repeated window as share one of ``PARTS`` strings around the anchor with another region: a window
   reaches ``i`` steps to the left of the anchor, and ``PARTS - 1 - i`` to the right, for some ``i``.
3. *Clipping.* What is left is cut out of the texts, and the same is done again with ``STEPS`` strings: a region is
   clipped to the windows between the first and the last of its steps that it shares.
4. *Suffix arrays.* The different regions of an anchor whose regions are not settled go to one shard. A shard's text is
   sorted by induced sorting, and a window is repeated if its permuted common prefix reaches ``LENGTH``.
5. *Hot anchors.* An anchor with more than ``HOT`` different regions, or more than ``SHARD_BYTES`` of them, would overload
   a shard. Its windows are hashed and counted one by one instead, with a partial sum in each task.
6. The spans of a text are merged and cut out.

So most repeats, the exact copies, are settled by counting, and the suffix arrays decide about the edges of repeats.

A line that fills large parts of the table gives one anchor, and one region, a large share of all rows. Such keys are
broadcast instead of joined by a shuffle, which would send their rows to one task.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftwork.llm.common import written
from weftwork.llm.suffixarray import permuted_prefixes, suffix_array
from weftwork.llm.textbatch import Hasher, mix, signed, sliced, text_buffers
from weftwork.operators.joins import adaptive_join

LENGTH, GRAM, HOT, PARTS, STEPS = 400, 64, 3000, 4, 16
SHARD_BYTES = 1 << 20
SEGMENT = 1 << 20  # windows of a long text that are looked at at once
BROADCAST_ROWS, BROADCAST_SPANS = 500_000, 2_000_000
HEAVY_ROWS, HEAVY_KEYS = 1000, 100_000

_REGIONS = "doc_id long, version long, first int, last int, anchor long, region long, parts array<long>"
_SPANS = "doc_id long, version long, start int, stop int"


def sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive keys: of block ends and block starts that meet."""
    n = len(keys) - width + 1
    size = -(-len(keys) // width) * width
    padded = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    heads = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    tails = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(tails[:n], heads[width - 1 : width - 1 + n])


def regions(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """For all texts: text number, first and last window of each region in it, hashes of its anchor, the region, and its parts."""
    out = []
    hasher = Hasher(data)
    bits = np.uint64((1 << 24) - 1)
    for begin in range(0, max(len(data) - length + 1, 0), SEGMENT):
        end = min(begin + SEGMENT, len(data) - length + 1)
        at = np.arange(begin, end + length - gram)
        keys = (hasher.of(at, at + gram) & ~bits) | (at - begin).astype(np.uint64)
        anchor = (sliding_minimum(keys, length - gram + 1) & bits).astype(np.int64) + begin
        text = np.searchsorted(offsets, np.arange(begin, end), side="right") - 1
        valid = np.arange(begin, end) + length <= offsets[text + 1]
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        stop = valid.copy()
        stop[:-1] &= ~valid[1:] | new[1:]
        first, last = np.flatnonzero(new), np.flatnonzero(stop)
        number, anchor = text[first], anchor[first]
        first, last = first + begin, last + begin
        step = (length - gram) // PARTS
        parts = np.zeros((len(first), PARTS), dtype=np.uint64)  # 0 where the region does not reach so far
        for i in range(PARTS):
            a, b = anchor - step * i, anchor + gram + step * (PARTS - 1 - i)
            reached = (a >= first) & (b <= last + length)
            parts[reached, i] = mix(hasher.of(a[reached], b[reached]) + np.uint64(i + 1))
        whole = mix(hasher.of(first, last + length) + (anchor - first).astype(np.uint64))
        out.append((number, first - offsets[number], last - offsets[number], hasher.of(anchor, anchor + gram), whole, parts))
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), np.zeros((0, PARTS), np.uint64)
    return tuple(np.concatenate(column) for column in zip(*out))


def _find_regions(length: int, gram: int):
    def run(batches):
        for batch in sliced(batches, "text"):
            data, offsets = text_buffers(batch.column(2))
            text, first, last, anchor, whole, parts = regions(data, offsets, length, gram)
            at = pa.array(text)
            parts = pa.ListArray.from_arrays(pa.array(np.arange(len(text) + 1, dtype=np.int32) * PARTS), pa.array(signed(parts).reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at), batch.column(1).take(at), pa.array(first.astype(np.int32)),
                    pa.array(last.astype(np.int32)), pa.array(signed(anchor)), pa.array(signed(whole)), parts,
                ],
                names=["doc_id", "version", "first", "last", "anchor", "region", "parts"],
            )

    return run


_PIECES = "doc_id long, version long, first int, anchor long, n long, piece binary, at int, parts longs"
_PIECES_DDL = _PIECES.replace("longs", "array<long>")


def _steps(piece: bytes, anchor: int, length: int, gram: int) -> tuple[int, list[int]]:
    """Where the anchor lies in a region, and the hashes of its ``STEPS`` strings; 0 where the region does not reach so far."""
    data = np.frombuffer(piece, np.uint8)
    hasher = Hasher(data)
    may = np.arange(len(data) - length, length - gram + 1)  # every window of the region holds its anchor
    at = int(may[np.flatnonzero(signed(hasher.of(may, may + gram)) == anchor)[0]])
    step, i = (length - gram) // STEPS, np.arange(STEPS)
    a, b = at - step * i, at + gram + step * (STEPS - 1 - i)
    reached = (a >= 0) & (b <= len(data))
    parts = np.zeros(STEPS, dtype=np.uint64)
    parts[reached] = mix(hasher.of(a[reached], b[reached]) + (i[reached] + 1).astype(np.uint64))
    return at, signed(parts).tolist()


def _cut_pieces(length: int, gram: int):
    def run(batches):
        for batch in sliced(batches, "text"):
            out = []
            for doc_id, version, text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                for w in wanted:
                    piece = data[w["first"] : w["last"] + length]
                    out.append((doc_id, version, w["first"], w["anchor"], w["n"], piece, *_steps(piece, w["anchor"], length, gram)))
                    if len(out) > 10_000:
                        yield _batch(out, _PIECES)
                        out = []
            yield _batch(out, _PIECES)

    return run


def _clipped(pieces: DataFrame, length: int, gram: int) -> DataFrame:
    """The pieces, cut down to the windows of the steps whose strings they share with another one."""
    marks = pieces.select("piece_id", "n", F.posexplode("parts").alias("step", "part")).filter("part <> 0")
    twice = marks.groupBy("part").agg(F.count("*").alias("places"), F.min("n").alias("least")).filter("places > 1 and least = 1")
    steps = adaptive_join(marks.select("piece_id", "step", "part"), twice.select("part"), ["part"])
    steps = steps.groupBy("piece_id").agg(F.min("step").alias("low"), F.max("step").alias("high"))
    step, rest = (length - gram) // STEPS, (length - gram) % STEPS
    begin = F.greatest(F.col("at") - step * (F.col("high") + 1) - rest, F.lit(0))
    end = F.least(F.col("at") - step * F.col("low"), F.length("piece") - length)
    joined = adaptive_join(pieces.drop("parts"), steps, ["piece_id"]).withColumn("begin", begin).withColumn("end", end)
    return joined.select(
        "doc_id", "version", (F.col("first") + F.col("begin")).cast("int").alias("first"), "anchor", "n",
        F.substring(F.col("piece"), F.col("begin") + 1, F.col("end") - F.col("begin") + length).alias("piece"),
    )


_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "longs": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    parts = [p.split() for p in schema.split(", ")]
    columns = list(zip(*rows)) or [[] for _ in parts]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, parts)], names=[n for n, _ in parts])


def _sort_shard(length: int):
    """Spans of repeated windows in the regions of a shard that occur once as a whole."""

    def run(shard: pa.Table) -> pa.Table:
        pieces = [np.frombuffer(p, np.uint8) for p in shard.column("piece").to_pylist()]
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes + 1)
        starts = ends - sizes - 1
        data = np.zeros(int(ends[-1]), np.uint8)
        symbols = np.zeros(int(ends[-1]), np.uint16)  # 0 stands behind each region
        room = np.zeros(int(ends[-1]), np.int32)
        for p, a in zip(pieces, starts):
            data[a : a + len(p)] = p
            symbols[a : a + len(p)] = p.astype(np.uint16) + 1
            room[a : a + len(p)] = np.arange(len(p), 0, -1)
        order = suffix_array(symbols)
        del symbols
        repeated = permuted_prefixes(order, room, Hasher(data), length) >= length
        rows = []
        keys = [shard.column(c).to_pylist() for c in ("doc_id", "version", "first", "n")]
        for k, (doc_id, version, first, n) in enumerate(zip(*keys)):
            found = np.flatnonzero(repeated[starts[k] : starts[k] + sizes[k]])
            if n == 1 and len(found):
                breaks = np.flatnonzero(np.diff(found) > 1)
                for a, b in zip(found[np.append(0, breaks + 1)].tolist(), found[np.append(breaks, len(found) - 1)].tolist()):
                    rows.append((doc_id, version, first + a, first + b + length))
        return pa.Table.from_batches([_batch(rows, _SPANS)])

    return run


_WINDOWS = "doc_id long, version long, start int, window long, n long"


def _hash_windows(length: int):
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                pieces = [np.frombuffer(p, np.uint8) for p in part.column(5).to_pylist()]
                windows = np.array([len(p) - length + 1 for p in pieces])
                begins = np.cumsum([0, *(len(p) for p in pieces)])[:-1]
                within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
                at = np.repeat(begins, windows) + within
                row = pa.array(np.repeat(np.arange(len(pieces)), windows))
                hashes = signed(Hasher(np.concatenate(pieces)).of(at, at + length))
                first = np.repeat(part.column(2).to_numpy(), windows)
                columns = [part.column(0).take(row), part.column(1).take(row), pa.array((first + within).astype(np.int32)), pa.array(hashes), part.column(4).take(row)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "start", "window", "n"])

    return run


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _spread_join(rows: DataFrame, counted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys are in ``counted``, which holds each once and in ``places`` how many of the rows have it.

    Keys of more than ``HEAVY_ROWS`` rows and a ``HEAVY_KEYS``-th of all are broadcast, so these are fewer than ``HEAVY_KEYS``.
    """
    places, most = counted.agg(F.sum("places"), F.max("places")).first()
    limit = max(HEAVY_ROWS, (places or 0) // HEAVY_KEYS)
    if (most or 0) <= limit:
        return adaptive_join(rows, counted.select(*keys), keys)
    heavy = F.broadcast(counted.filter(F.col("places") > limit).select(*keys))
    others = counted.filter(F.col("places") <= limit).select(*keys)
    shuffled = adaptive_join(rows.join(heavy, keys, "left_anti"), others, keys)
    return rows.join(heavy, keys, "left_semi").unionByName(shuffled)


def _versioned(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))


def _same(one: DataFrame, two: DataFrame):
    return one["doc_id"].eqNullSafe(two["doc_id"]) & (one["version"] == two["version"])


def repeated_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """``(doc_id, version, starts, stops)``: byte ranges to remove, for texts that have any; ``version`` is a hash of the text.

    Texts are bytes of UTF-8, null is empty. Every row counts, repeated ones and those with a null id too.
    """
    texts = _versioned(docs, id_column, text_column)
    long_texts = texts.filter(F.octet_length("text") >= length)
    found = written(long_texts.mapInArrow(_find_regions(length, gram), _REGIONS), "regions")
    several = written(found.groupBy("anchor").agg(F.count("*").alias("places")).filter("places > 1"), "several")
    found = written(_spread_join(found, several, ["anchor"]).select("doc_id", "version", "first", "last", "anchor", "region", "parts"), "shared-regions")
    kinds = found.groupBy("anchor", "region").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "version", "first", "last", "parts")).alias("one")
    )
    kinds = written(kinds, "region-kinds")
    whole = _spread_join(found, kinds.filter("n > 1").withColumnRenamed("n", "places"), ["anchor", "region"])
    spans = whole.select("doc_id", "version", F.col("first").alias("start"), (F.col("last") + length).cast("int").alias("stop"))

    open_anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 and least = 1")
    unsettled = written(adaptive_join(kinds, open_anchors.select("anchor"), ["anchor"]), "open-regions")
    parts = unsettled.select("anchor", "region", F.explode("one.parts").alias("part")).filter("part <> 0")
    twice = parts.groupBy("part").agg(F.count("*").alias("places")).filter("places > 1").select("part")
    sharing = adaptive_join(parts, twice, ["part"]).select("anchor", "region").distinct()
    unsettled = written(adaptive_join(unsettled, sharing, ["anchor", "region"]), "sharing-regions")
    open_anchors = unsettled.groupBy("anchor").agg(F.min("n").alias("least")).filter("least = 1").select("anchor")
    unsettled = adaptive_join(unsettled, open_anchors, ["anchor"])
    wanted = written(
        unsettled.select("one.doc_id", "one.version", "one.first", "one.last", "anchor", "n")
        .groupBy("doc_id", "version")
        .agg(F.collect_list(F.struct("first", "last", "anchor", "n")).alias("wanted")),
        "unsettled",
    )
    rows = wanted.count()
    if rows:
        source = long_texts
        if rows <= BROADCAST_ROWS:  # 16 bytes a row: only texts that are needed are shuffled
            keys = F.broadcast(wanted.select("doc_id", "version"))
            source = long_texts.join(keys, _same(long_texts, keys), "left_semi")
        source = source.dropDuplicates(["doc_id", "version"])
        joined = source.join(wanted, _same(source, wanted)).select(source["doc_id"], source["version"], "text", "wanted")
        pieces = joined.mapInArrow(_cut_pieces(length, gram), _PIECES_DDL).withColumn("piece_id", F.monotonically_increasing_id())
        pieces = written(_clipped(written(pieces, "region-texts"), length, gram), "clipped-regions")
        size = pieces.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum(F.length("piece")).alias("bytes"), F.min("n").alias("least"))
        size = written(size.filter("least = 1"), "anchor-sizes")  # others hold nothing that is open
        too_large = (F.col("kinds") > hot) | (F.col("bytes") > SHARD_BYTES)
        volume = size.filter(~too_large).agg(F.sum("bytes")).first()[0] or 0
        shards = max(1, -(-int(volume) // SHARD_BYTES))
        cold = adaptive_join(pieces, size.filter(~too_large).select("anchor"), ["anchor"])
        cold = cold.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
        # Few bytes mean much sorting here, so the shards are not gathered into partitions by their size.
        tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards // 64)
        sorted_spans = cold.repartition(tasks, "shard").groupBy("shard").applyInArrow(_sort_shard(length), _SPANS)
        spans = spans.unionByName(sorted_spans)
        hot_anchors = size.filter(too_large).select("anchor")
        if not hot_anchors.isEmpty():
            heated = adaptive_join(pieces, hot_anchors, ["anchor"]).select("doc_id", "version", "first", "anchor", "n", "piece")
            windows = written(heated.mapInArrow(_hash_windows(length), _WINDOWS), "hot-windows")
            twice = windows.groupBy("window").agg(F.sum("n").alias("all"), F.count_if(F.col("n") == 1).alias("places"))
            twice = written(twice.filter("all > 1 and places > 0"), "repeated-windows")
            late = _spread_join(windows.filter("n = 1"), twice, ["window"])
            spans = spans.unionByName(late.select("doc_id", "version", "start", (F.col("start") + length).cast("int").alias("stop")))
    # Spans that meet become one before those of a text are gathered.
    text = Window.partitionBy("doc_id", "version").orderBy("start", "stop")
    reached = F.max("stop").over(text.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(F.col("start") > F.col("reached"), 1).otherwise(0)).over(text.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = spans.distinct().withColumn("reached", reached).withColumn("run", run)
    runs = runs.groupBy("doc_id", "version", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    by_text = runs.groupBy("doc_id", "version").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    return written(by_text.select("doc_id", "version", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops")), "spans")


def _digests(batches):
    for batch in sliced(batches, "text"):
        rows = []
        for doc_id, text, starts, stops in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode()
            kept, at = hashlib.sha256(), 0
            for a, b in zip(starts or (), stops or ()):
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            removed = sum(stops or ()) - sum(starts or ())
            rows.append((doc_id, len(data), removed, len(starts or ()), kept.hexdigest()))
        yield _batch(rows, _DIGESTS)


_DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def with_spans(docs: DataFrame, spans: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, text, starts, stops)`` of every row; the ranges are null where nothing is repeated."""
    texts = _versioned(docs, id_column, text_column)
    rows, ranges = spans.agg(F.count("*"), F.sum(F.size("starts"))).first()
    small = rows <= BROADCAST_ROWS and (ranges or 0) <= BROADCAST_SPANS  # about 32 bytes a row and 8 a range
    other = F.broadcast(spans) if small else spans
    return texts.join(other, _same(texts, other), "left").select(texts["doc_id"], "text", "starts", "stops")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row of ``docs``. Other columns are not read."""
    spans = repeated_spans(docs, id_column, text_column, length)
    return with_spans(docs, spans, id_column, text_column).mapInArrow(_digests, _DIGESTS)
