"""Benchmark decontamination by greedy string tiling.

Words are lower-cased (A-Z) runs of bytes that are not white space. A document and a benchmark text are compared when
they share a seed, a run of ``min_match`` words. The comparison covers the benchmark text with tiles: the longest runs
of words that both share and that no tile covers yet, found by running Karp-Rabin, with search lengths that fall to
``min_match``. Tiles may lie in any order, so reordered passages are found. A document is contaminated when tiles
cover ``percent`` of the words of a benchmark text.

Most pairs need no tiling. Of an item that is covered by ``percent`` at most the other words are not, so of any larger
set of its words one lies under a shared seed. That set is chosen where seeds are rarest in the benchmark, and only the
seeds over it are looked up (`Items`). Of the items found, only those are tiled whose words under shared seeds reach
``percent``, which bounds what tiles can cover. So a phrase that many items and many documents share costs no pairs, and
no contaminated pair is lost.

The benchmark is the query set: texts of equal words become one in Spark, then it is worked off in blocks of bounded
size, each held against all documents in one scan without a shuffle.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import written
from weftwork.llm.textbatch import shingles, sliced, text_buffers, word_hashes

MIN_MATCH, PERCENT = 5, 75
BLOCK_BYTES = 8 << 20  # benchmark text that is held against the documents at once

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BASE, _MODULUS = 1_000_003, (1 << 61) - 1


def _windows(words: list[int], marked: list[bool], length: int):
    """Position and Karp-Rabin hash of every run of ``length`` unmarked words; the hash rolls along."""
    drop = pow(_BASE, length, _MODULUS)
    value = run = 0
    for k, word in enumerate(words):
        if marked[k]:
            value = run = 0
            continue
        value = (value * _BASE + word) % _MODULUS
        run += 1
        if run > length:
            value = (value - words[k - length] * drop) % _MODULUS
        if run >= length:
            yield k - length + 1, value


def tiles(text: list[int], item: list[int], min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """``(position in text, position in item, length)`` of the tiles, in the order found."""
    if min(len(text), len(item)) < min_match:
        return []
    in_text, in_item = [False] * len(text), [False] * len(item)
    found: list[tuple[int, int, int]] = []
    length, left = min(len(text), len(item)), len(item)
    while left >= min_match:
        table: dict[int, list[int]] = {}
        for at, value in _windows(item, in_item, length):
            table.setdefault(value, []).append(at)
        matches = []
        for at, value in _windows(text, in_text, length) if table else ():
            for other in table.get(value, ()):
                if at and other and not in_text[at - 1] and not in_item[other - 1] and text[at - 1] == item[other - 1]:
                    continue  # part of the match that begins one word earlier
                n = 0
                while (
                    at + n < len(text) and other + n < len(item) and text[at + n] == item[other + n]
                    and not in_text[at + n] and not in_item[other + n]
                ):
                    n += 1
                if n >= length:
                    matches.append((-n, at, other))
        placed = hidden = 0
        for n, at, other in sorted(matches):
            n = -n
            if any(in_text[at : at + n]) or any(in_item[other : other + n]):
                hidden += 1
                continue
            in_text[at : at + n] = [True] * n
            in_item[other : other + n] = [True] * n
            found.append((at, other, n))
            placed += 1
            left -= n
        if placed and hidden:
            continue  # what the tiles left of the hidden matches may still be long enough
        if length == min_match:
            break
        length = max(min_match, length // 2)
    return found


class Items:
    """A block of the benchmark: its items' words, their seeds, and which items are looked up by a seed."""

    def __init__(self, ids: list[int], words: np.ndarray, ends: np.ndarray, min_match: int, percent: int):
        self.ids, self.words, self.ends, self.min_match = ids, words, ends, min_match
        self.sizes = np.diff(ends)
        grams, self.before = shingles(words, ends, min_match)
        self.seeds, self.seed = np.unique(grams, return_inverse=True)
        self.needed = -(-percent * self.sizes // 100)  # words that have to be covered
        often = np.bincount(self.seed)[self.seed]  # by place: how many places of the block have its seed
        owner = np.repeat(np.arange(len(ids)), self.sizes)
        at = np.arange(len(words)) - ends[owner]
        last = np.diff(self.before)[owner] - 1
        over = [np.where((at - k >= 0) & (at - k <= last), self.before[owner] + at - k, -1) for k in range(min_match)]
        cost = np.max([np.where(place >= 0, often[place], 0) for place in over], axis=0)
        order = np.lexsort((cost, owner))
        chosen = order[np.arange(len(order)) - ends[owner[order]] <= (self.sizes - self.needed)[owner[order]]]
        rare = np.unique(np.concatenate([place[chosen] for place in over]))
        rare = rare[rare >= 0]
        rare_owner = np.searchsorted(self.before, rare, side="right") - 1
        order = np.lexsort((rare_owner, self.seed[rare]))
        self._rare_owner = rare_owner[order]
        self._rare_from = np.searchsorted(self.seed[rare][order], np.arange(len(self.seeds) + 1))

    def candidates(self, shared: np.ndarray) -> list[int]:
        """Items whose words under the ``shared`` seeds (a flag for each seed) are enough."""
        numbers = np.flatnonzero(shared)
        parts = [self._rare_owner[self._rare_from[n] : self._rare_from[n + 1]] for n in numbers.tolist()]
        found = np.unique(np.concatenate(parts)) if parts else []
        out = []
        for i in found:
            at = np.flatnonzero(shared[self.seed[self.before[i] : self.before[i + 1]]])
            # each place covers ``min_match`` words, less where the next one follows sooner
            covered = np.minimum(np.diff(at), self.min_match).sum() + self.min_match if len(at) else 0
            if covered >= self.needed[i]:
                out.append(int(i))
        return out

    def item(self, i: int) -> list[int]:
        return self.words[self.ends[i] : self.ends[i + 1]].tolist()


def _scan(items: Items, percent: int):
    min_match, seeds = items.min_match, items.seeds

    def run(batches):
        shared = np.zeros(len(seeds), dtype=bool)
        for batch in sliced(batches, "text"):
            data, offsets = text_buffers(batch.column(1))
            words, firsts = word_hashes(data, offsets)
            grams, before = shingles(words, firsts, min_match)
            at = np.searchsorted(seeds, grams)
            at[at == len(seeds)] = 0
            hits = np.flatnonzero(seeds[at] == grams)
            text = np.searchsorted(before, hits, side="right") - 1
            edges = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else []
            rows = []
            for a, b in zip(edges, np.append(edges, len(text))[1:]):
                k, own = int(text[a]), hits[a:b] - before[text[a]]
                shared[at[hits[a:b]]] = True
                candidates = items.candidates(shared)
                shared[at[hits[a:b]]] = False
                if not candidates:
                    continue
                # Only words under a seed can lie in a tile; a break stands where they are not adjacent.
                at_word = np.unique((own[:, None] + np.arange(min_match)).ravel())
                at_word = at_word[at_word < firsts[k + 1] - firsts[k]]
                values = words[firsts[k] + at_word].tolist()
                breaks = np.flatnonzero(np.diff(at_word) > 1) + 1
                for cut in breaks[::-1].tolist():
                    values.insert(cut, -1)
                for i in candidates:
                    item = items.item(i)
                    got = tiles(values, item, min_match)
                    covered = sum(n for _, _, n in got)
                    if 100 * covered >= percent * len(item):
                        rows.append((k, items.ids[i], len(item), covered, len(got)))
            picked = batch.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
            columns = [pa.array([r[c] for r in rows], pa.int64()) for c in range(1, 5)]
            yield pa.RecordBatch.from_arrays([picked, *columns], names=["doc_id", "item_id", "item_words", "covered", "n_tiles"])

    return run


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    min_match: int = MIN_MATCH,
    percent: int = PERCENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(doc_id, item_id, item_words, covered, n_tiles)``: the contaminated documents and what they contain.

    Benchmark texts of the same words count as one, named by the smallest id. Texts of fewer than ``min_match`` words
    and nulls match nothing; a benchmark row with a null id is not used. Repeated document rows give repeated results,
    rows with a null id results with a null id. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    items = benchmark.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text).alias("text")).filter(
        "item_id is not null and text is not null"
    )
    # Equal for texts of the same words, and no longer than they are; so repeats are gone before a block is read.
    same = F.trim(F.regexp_replace(F.translate("text", _UPPER, _UPPER.lower()), r"[\x20\x09-\x0D]+", " "))
    items = written(items.groupBy(same.alias("text")).agg(F.min("item_id").alias("item_id")), "benchmark")
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-volume // block_bytes))
    out = None
    for block in range(blocks):
        rows = sorted((r.item_id, r.text) for r in items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect())
        words, firsts = word_hashes(*text_buffers(pa.array([t for _, t in rows], pa.string())))
        long = [k for k in range(len(rows)) if firsts[k + 1] - firsts[k] >= min_match]
        if not long:
            continue
        flat = np.concatenate([words[firsts[k] : firsts[k + 1]] for k in long])
        ends = np.concatenate([[0], np.cumsum([firsts[k + 1] - firsts[k] for k in long])]).astype(np.int64)
        found = Items([rows[k][0] for k in long], flat, ends, min_match, percent)
        part = texts.mapInArrow(_scan(found, percent), "doc_id long, item_id long, item_words long, covered long, n_tiles long")
        if blocks > 1:  # so that the driver holds one block at a time
            part = written(part, "contaminated")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, item_words long, covered long, n_tiles long")
    return out
