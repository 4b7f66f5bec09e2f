"""Toxicity: a lexicon learned from labels, fuzzy look-up by a Levenshtein automaton, and the context of each hit.

The lexicon holds terms (whole words) and stems (word beginnings) that mark toxic documents. Its terms stand in a trie;
a word is run against it together with an automaton that accepts all words at a distance of one edit, so misspelled
terms are found in one walk. A hit counts as quoted, as addressed to someone, or as plain, by the words and marks in a
window around it. A logistic regression over the sums of the hits gives the score.

Labels are learned on a bounded sample: at most ``SAMPLE`` labelled documents of either class.
"""

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import written
from weftwork.llm.textbatch import LOWER, SLICE_BYTES, Hasher, sliced, spans, text_buffers

SAMPLE = 10_000  # labelled documents of each class that are learned from
CONTEXTS = 3  # different words before a term that have to be seen in toxic documents, at least
CHANCE = 0.05  # wanted number of terms that are found although their words fell into toxic documents by chance
PURITY = 0.9  # share of a term's contexts that lie in toxic documents
STEM_LENGTHS, STEM_WORDS, STEM_PURITY = range(4, 8), 3, 0.98
WINDOW = 40  # bytes on either side of a hit that count as its context
FUZZY_LENGTH = 5  # shortest term that may be misspelled
CACHE = 2_000_000

#: Words that report what others say, and words that address someone, in the languages of the corpus.
REPORTING = {"said", "says", "wrote", "quote", "quoted", "called", "word", "term", "dit", "selon", "sagte", "schrieb", "dijo", "llamó"}
ADDRESS = {"you", "your", "youre", "u", "tu", "toi", "vous", "du", "dich", "ihr", "usted", "tú", "ustedes"}
QUOTES = "\"“”„«»‹›"

JOINERS = {0xAD, 0x200C, 0x200D}  # soft hyphen and joiners, which stand within words


def _letters() -> np.ndarray:
    """By code point: whether it belongs to words, as letters, marks, numbers and joiners do."""
    return np.array([c in JOINERS or unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)])


_INSIDE = _letters()
_edges = np.flatnonzero(np.diff(_INSIDE.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
_WORD = re.compile("[" + "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in _edges.tolist()) + "]+")


def inside_words(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 texts belong to words."""
    inside = _INSIDE[:256][data]
    for start in range(0, len(data), SLICE_BYTES):  # characters that begin in a slice; a long text makes no large tables
        lead = start + np.flatnonzero(data[start : start + SLICE_BYTES] >= 128)
        if not len(lead):
            continue
        inside[lead] &= data[lead] < 0xC0  # bytes within a character keep what its first byte has set
        lead = lead[data[lead] >= 0xC0]
        size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        code = data[lead].astype(np.int64) & (0x7F >> size)
        for k in range(1, 4):
            more = size > k
            at = np.minimum(lead[more] + k, len(data) - 1)
            code[more] = code[more] << 6 | data[at] & 0x3F
        word = _INSIDE[np.minimum(code, 0x10FFFF)]
        for k in range(4):
            own = size > k
            at, value = lead[own] + k, word[own]
            there = at < len(data)
            inside[at[there]] = value[there]
    return inside


EXACT, STEM, FUZZY = range(3)


@dataclass
class Trie:
    """Terms by their characters; ``term`` is set where one ends."""

    children: dict = field(default_factory=dict)
    term: str | None = None

    def add(self, term: str) -> None:
        node = self
        for c in term:
            node = node.children.setdefault(c, Trie())
        node.term = term

    def within(self, word: str, distance: int = 1) -> list[tuple[int, str]]:
        """Terms at most ``distance`` edits away. A state of the automaton is the row of edit counts after a prefix;
        a branch of the trie ends where no entry of its state is within the distance."""
        found: list[tuple[int, str]] = []
        stack = [(self, tuple(range(len(word) + 1)))]
        while stack:
            node, state = stack.pop()
            if node.term is not None and state[-1] <= distance:
                found.append((state[-1], node.term))
            for c, child in node.children.items():
                row = [state[0] + 1]
                for k, own in enumerate(word):
                    row.append(min(row[k] + 1, state[k + 1] + 1, state[k] + (own != c)))
                if min(row) <= distance:
                    stack.append((child, tuple(row)))
        return sorted(found)


@dataclass
class Lexicon:
    """Terms and stems with their weights; ``look_up`` finds the best entry for a word."""

    terms: dict[str, float]
    stems: dict[str, float]

    def __post_init__(self):
        self._trie = Trie()
        self._heads, self._tails = set(), set()
        for term in self.terms:
            if len(term) >= FUZZY_LENGTH:
                self._trie.add(term)
                half = len(term) // 2
                self._heads.add(term[:half])
                self._tails.add(term[half:])
        self._longest = max(map(len, self.terms), default=0)
        self._sizes = sorted({len(x) for x in self._heads | self._tails})
        self._lengths = sorted({len(x) for x in self.stems})

    def look_up(self, word: str) -> tuple[int, float] | None:
        weight = self.terms.get(word)
        if weight is not None:
            return EXACT, weight
        for n in self._lengths:
            weight = self.stems.get(word[:n])
            if weight is not None:
                return STEM, weight
        # One edit leaves the first or the second half of the term as it is.
        if FUZZY_LENGTH - 1 <= len(word) <= self._longest + 1 and any(word[:n] in self._heads or word[-n:] in self._tails for n in self._sizes):
            near = self._trie.within(word)
            if near:
                return FUZZY, max(self.terms[term] for _, term in near)
        return None


N_FEATURES = 10


def features(hits: list[tuple[int, float, int]], words: int) -> list[float]:
    """``hits``: (kind, weight, context) with context 0 plain, 1 quoted, 2 addressed."""
    out = [0.0] * N_FEATURES
    for kind, weight, context in hits:
        out[kind] += weight
        out[3 + context] += weight
    best = max((w for k, w, _ in hits if k != FUZZY), default=0.0)
    total = sum(out[:3])
    return [float(np.log1p(x)) for x in out[:6]] + [best, float(np.log1p(len(hits))), total / (words + 20.0) * 10, float(np.log1p(words)) / 5]


def context_of(before: str, after: str) -> int:
    """Quoted if a quotation mark is open before the hit or a reporting word stands near; addressed if someone is."""
    near = set(_WORD.findall(before)[-3:] + _WORD.findall(after)[:3])
    opened = sum(before.count(q) for q in QUOTES) % 2 == 1 and any(q in after for q in QUOTES)
    if opened or near & REPORTING:
        return 1
    return 2 if near & ADDRESS else 0


class Scanner:
    """Features of all texts of a column; each distinct word is looked up once in a worker."""

    def __init__(self, lexicon: Lexicon):
        self._lexicon = lexicon
        self._known: dict[int, tuple[int, float]] = {}
        self._seen = np.zeros(0, np.uint64)

    def column(self, column: pa.Array) -> np.ndarray:
        data, offsets = text_buffers(column)
        starts, ends = spans(inside_words(data), offsets)
        firsts = np.searchsorted(starts, offsets)
        texts = len(offsets) - 1
        hits: list[list] = [[] for _ in range(texts)]
        if len(starts):
            lower = LOWER[data]
            hashes = Hasher(lower).of(starts, ends)
            distinct, one = np.unique(hashes, return_index=True)
            if len(self._seen) > CACHE:
                self._seen, self._known = self._seen[:0], {}
            at = np.searchsorted(self._seen, distinct)
            new = np.ones(len(distinct), dtype=bool)
            there = at < len(self._seen)
            new[there] = self._seen[at[there]] != distinct[there]
            raw, lowered = data.tobytes(), lower.tobytes()
            look_up = self._lexicon.look_up
            for h, a, b in zip(distinct[new].tolist(), starts[one[new]].tolist(), ends[one[new]].tolist()):
                found = look_up(lowered[a:b].decode(errors="replace").lower())
                if found:
                    self._known[h] = found
            self._seen = np.insert(self._seen, at[new], distinct[new])
            wanted = np.fromiter(self._known, dtype=np.uint64)
            places = np.flatnonzero(np.isin(hashes, wanted)) if len(wanted) else []
            for k in places:
                text = int(np.searchsorted(firsts, k, side="right")) - 1
                a, b = int(starts[k]), int(ends[k])
                before = raw[max(int(offsets[text]), a - WINDOW) : a].decode(errors="ignore").lower()
                after = raw[b : min(int(offsets[text + 1]), b + WINDOW)].decode(errors="ignore").lower()
                hits[text].append((*self._known[int(hashes[k])], context_of(before, after)))
        counts = np.diff(firsts)
        return np.array([features(h, int(n)) for h, n in zip(hits, counts)], dtype=np.float64).reshape(texts, N_FEATURES)


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Newton steps with a ridge on the weights, so that features that never vary get none."""
    full = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(full.shape[1])
    penalty = np.full(full.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        slope = full.T @ (p - y) / len(y) + penalty * w / 10
        bend = (full * (p * (1 - p) + 1e-9)[:, None]).T @ full / len(y) + np.diag(penalty / 10 + 1e-9)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w[:-1], float(w[-1])


def held_out(doc_id: str = "doc_id"):
    """Every fifth document by a checksum of its id is never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def sample_labels(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` labelled ids of each class, ``(doc_id, toxic)``; ids with both labels count as toxic."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    return known.filter("toxic = 1").orderBy(order).limit(sample).unionAll(known.filter("toxic = 0").orderBy(order).limit(sample))


def _contexts(batches):
    """``(word, previous word, toxic)`` once for each text; copies of a text add nothing new."""
    for batch in sliced(batches, "text"):
        seen: Counter = Counter()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = _WORD.findall((text or "").lower())
            seen.update((w, p, toxic) for w, p in {(w, p) for w, p in zip(words, ["", *words]) if 2 < len(w)})
        keys = list(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32()))],
            names=["word", "previous", "toxic"],
        )


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The lexicon and the regression, from ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``.

    Without labels, or with labels of one class, every document gets the score of that class (0 without labels).
    """
    spark = docs.sparkSession
    rows = [(r.doc_id, r.toxic) for r in sample_labels(labels, sample).collect()]  # bounded by ``sample``
    chosen = spark.createDataFrame(rows, "doc_id long, toxic int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    seen = texts.select("text", "toxic").mapInArrow(_contexts, "word string, previous string, toxic int").distinct()
    by_word = seen.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    by_word = written(by_word, "label-words")
    v, toxic, n = by_word.agg(F.count("*"), F.sum("toxic"), F.sum("n")).first()
    # Contexts that a word needs before chance is ruled out, for all words together.
    needed = max(CONTEXTS, int(np.ceil(np.log(max(v, 1) / CHANCE) / np.log(n / toxic)))) if toxic and toxic < n else CONTEXTS
    share = F.col("toxic") / F.col("n")
    weight = F.log((F.col("toxic") + 0.5) / (F.col("n") - F.col("toxic") + 0.5))
    terms = by_word.filter((F.col("toxic") >= needed) & (share >= PURITY)).select("word", weight.alias("w")).collect()
    by_stem = (
        by_word.withColumn("stem", F.explode(F.array(*[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEM_LENGTHS])))
        .filter("stem is not null")
        .groupBy("stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"), F.sum((F.col("toxic") > 0).cast("int")).alias("words"))
        .filter((F.col("toxic") >= needed) & (F.col("words") >= STEM_WORDS) & (share >= STEM_PURITY))
        .select("stem", weight.alias("w"))
        .collect()
    )
    stems: dict[str, float] = {}
    for stem, w in sorted(by_stem, key=lambda r: (len(r[0]), r[0])):
        if not any(stem[:n] in stems for n in range(3, len(stem))):
            stems[stem] = w
    lexicon = Lexicon({w: max(x, 0.1) for w, x in terms}, {s: max(x, 0.1) for s, x in stems.items()})
    found = texts.select("doc_id", "text", "toxic").mapInArrow(_features_of(lexicon, keep=2), "x array<double>, toxic int").collect()
    y = np.array([r.toxic for r in found], dtype=np.float64)
    if not len(found) or y.min() == y.max():
        return Model(lexicon, np.zeros(N_FEATURES), 10.0 if len(found) and y.min() == 1 else -10.0)
    # The sample has as many toxic as clean documents as it can get; each class counts as it does among all labels.
    weights, bias = fit_logistic(np.array([r.x for r in found]), y)
    known = labels.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out()).agg(F.avg("toxic")).first()[0]
    shift = np.log(known / (1 - known)) - np.log(y.mean() / (1 - y.mean())) if 0 < known < 1 else 0.0
    return Model(lexicon, weights, float(bias + shift))


def _features_of(lexicon: Lexicon, keep: int):
    def run(batches):
        scanner = Scanner(lexicon)
        for batch in sliced(batches, "text"):
            x = scanner.column(batch.column(1))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES), pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([flat, batch.column(keep)], names=["x", "toxic"])

    return run


def _scores(model: Model):
    def run(batches):
        scanner = Scanner(model.lexicon)
        for batch in sliced(batches, "text"):
            score = pa.array(model.score(scanner.column(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), score], names=["doc_id", "held_out", "score"])

    return run


def toxicity(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``; null and empty texts have no hits.

    A null id counts as not held out. Repeated rows get the same score. Other columns are not read.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    texts = texts.select("doc_id", "text", F.coalesce(held_out(), F.lit(False)).alias("held_out"))
    scored = texts.mapInArrow(_scores(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _clean(model: Model, text_column: str):
    def run(batches):
        scanner = Scanner(model.lexicon)
        for batch in sliced(batches, text_column):
            score = model.score(scanner.column(batch.column(batch.schema.get_field_index(text_column))))
            yield batch.filter(pa.array(score < 0.5))

    return run


def without_toxic(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score stays below one half, with all their columns, in one pass; null ids are scored too."""
    return docs.mapInArrow(_clean(model, text_column), docs.schema)
