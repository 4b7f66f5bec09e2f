"""Bounded-space online packing of documents into token windows.

Each task keeps ``OPEN`` windows. Full windows are cut off long documents and leave at once; the rest of a document
goes to the open window that it fills best. When none fits, the fullest window leaves and a new one opens; a gap of
more than ``PADDING`` ids in it is filled by a cut from the document that did not fit. What is open at the end of a
task is written with its ids and merged in rounds of fewer tasks, which put the pieces one after the other and cut
them where a window is full, so that only one sequence of all is far from full.
"""

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import written
from weftwork.llm.textbatch import sliced
from weftwork.llm.tokens import encoder, vocabulary

WINDOW, OPEN, END_ID, FAN_IN, PADDING = 2048, 64, 1, 16, 8

_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "open boolean, ids binary"
)
_NAMES = [part.split()[0] for part in _SCHEMA.split(", ")]


class _Windows:
    """The open windows of one task, and the rows that left."""

    def __init__(self, round_no: int, window: int, limit: int, with_ids: bool):
        self._base = (round_no << 56) | (TaskContext.get().partitionId() << 32)
        self._window, self._limit, self._with_ids = window, limit, with_ids
        self._made = self._sequences = self._size = 0
        self._held: list = []
        self._free: list[tuple[int, int]] = []  # (free tokens, window number), in order
        self._pieces: dict[int, list] = {}
        self._rows: list[tuple] = []

    def add(self, doc_id, start: int, total: int, ids: np.ndarray) -> None:
        """One piece: its document, its first id there, the document's length, its ids."""
        while len(ids) >= self._window:
            self._leave([(doc_id, start, total, ids[: self._window])])
            ids, start = ids[self._window :], start + self._window
        while len(ids):
            taken = self._place(doc_id, start, total, ids)
            ids, start = ids[taken:], start + taken

    def _place(self, doc_id, start: int, total: int, ids: np.ndarray) -> int:
        """Puts the piece where it fits best and tells how many of its ids are placed."""
        at = bisect_left(self._free, (len(ids), -1))
        if at < len(self._free):
            free, number = self._free.pop(at)
        elif len(self._free) < self._limit:
            free, number = self._window, self._made
            self._made += 1
        else:
            gap, fullest = self._free.pop(0)
            pieces = self._pieces.pop(fullest)
            taken = gap if gap > PADDING else 0
            if taken:
                pieces.append((doc_id, start, total, ids[:taken]))
            self._leave(pieces)
            return taken
        self._pieces.setdefault(number, []).append((doc_id, start, total, ids))
        if free == len(ids):
            self._leave(self._pieces.pop(number))
        else:
            insort(self._free, (free - len(ids), number))
        return len(ids)

    def _leave(self, pieces: list, is_open: bool = False) -> None:
        sequence, offset = self._base | self._sequences, 0
        self._sequences += 1
        for doc_id, start, total, ids in pieces:
            data = ids.astype("<u4").tobytes()
            keep = data if is_open or self._with_ids else None
            self._rows.append((doc_id, start, len(ids), zlib.crc32(data), total, sequence, offset, is_open, keep))
            offset += len(ids)

    def leave_open(self) -> None:
        for _, number in self._free:
            self._leave(self._pieces.pop(number), is_open=True)
        self._free = []

    def fill(self, pieces: list) -> None:
        """Pieces that other tasks left go one after the other into one window, cut where it is full."""
        for doc_id, start, total, ids in pieces:
            while len(ids):
                take = min(len(ids), self._window - self._size)
                self._held.append((doc_id, start, total, ids[:take]))
                ids, start, self._size = ids[take:], start + take, self._size + take
                if self._size == self._window:
                    self._leave(self._held)
                    self._held, self._size = [], 0

    def leave_held(self, is_open: bool) -> None:
        if self._held:
            self._leave(self._held, is_open)
        self._held, self._size = [], 0

    def rows(self) -> pa.RecordBatch:
        columns = list(zip(*self._rows)) or [[] for _ in _NAMES]
        types = [pa.int64()] * 7 + [pa.bool_(), pa.binary()]
        self._rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=_NAMES)


def _pack_texts(path: str, pieces: str | None, end_id: int, window: int, limit: int, with_ids: bool):
    def run(batches):
        windows, encode = _Windows(0, window, limit, with_ids), encoder(path, pieces)
        for batch in sliced(batches, "text", holds=True):
            ids, before = encode.column(batch.column(1))
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                own = np.append(ids[before[k] : before[k + 1]], np.uint32(end_id))
                windows.add(doc_id, 0, len(own), own)
            yield windows.rows()
        windows.leave_open()
        yield windows.rows()

    return run


def _merge_windows(round_no: int, last: bool, window: int, with_ids: bool):
    def run(batches):
        windows = _Windows(round_no, window, 0, with_ids)
        for batch in batches:
            for pieces in batch.column(0).to_pylist():
                found = [(p["doc_id"], p["start"], p["doc_tokens"], np.frombuffer(p["ids"], "<u4")) for p in pieces]
                windows.fill(found)
            yield windows.rows()
        windows.leave_held(is_open=not last)
        yield windows.rows()

    return run


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    pieces: str | None = "space-led",
    end_id: int = END_ID,
    window: int = WINDOW,
    open_windows: int = OPEN,
    with_ids: bool = False,
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of every piece, and ``ids`` if wanted.

    A document is its token ids and ``end_id``; a null or empty text is ``end_id`` alone. Every row of ``docs`` is
    packed, repeated ones and those with a null id too. Sequences hold up to ``window`` ids, gapless from offset 0.
    Other columns of ``docs`` are not read.
    """
    path = tokenizer or vocabulary("byte_bpe_50k.json")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    made = written(texts.mapInArrow(_pack_texts(path, pieces, end_id, window, open_windows, with_ids), _SCHEMA), "packed")
    parts = [made.filter("not open")]
    tasks, round_no = made.filter("open").select(F.expr("sequence_id >> 32").alias("task")).distinct().count(), 0
    while tasks:
        tasks, round_no = (tasks + FAN_IN - 1) // FAN_IN, round_no + 1
        left = (
            made.filter("open")
            .groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "doc_tokens", "ids"))).alias("pieces"))
            .select("pieces", "sequence_id")
        )
        left = left.repartition(tasks, F.expr(f"pmod(sequence_id >> 32, {tasks})")) if tasks > 1 else left.coalesce(1)
        last = tasks == 1
        made = left.sortWithinPartitions("sequence_id").select("pieces")
        made = written(made.mapInArrow(_merge_windows(round_no, last, window, with_ids), _SCHEMA), "merged")
        parts.append(made.filter("not open"))
        if last:
            break
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(*_NAMES[:7], *(["ids"] if with_ids else []))
