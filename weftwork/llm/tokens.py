"""Token ids of whole texts: every distinct piece of text is encoded once by the tokenizer library, then looked up.

A tokenizer splits a text before it merges symbols, and never merges across such a split. Cutting a text at
some of these splits and encoding the parts gives the ids of the whole text. Two ways of cutting are known:

* ``"word"``: at white space, for tokenizers that drop white space;
* ``"space-led"``: a word with one blank before it, a run of white space, its last character where no word takes it,
  as byte-level tokenizers do. Texts with white space beyond ASCII are encoded whole.

In both, a letter or digit of ASCII beside a punctuation mark of ASCII (but for the apostrophe) is a split too.
Without one of them (``None``) every text is encoded whole.

A piece of letters alone is one word for the tokenizer's merging model, which is then asked at once; all other
pieces take the whole way through the library.
"""

import os
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa

from weftwork.llm.textbatch import SPACE, Hasher, held, text_buffers, word_spans

CACHE_BYTES = 32 << 20  # of hashes and ids that a worker keeps at most; then it starts anew

#: The UTF-8 forms of white space beyond 0x20 and 0x09-0x0D.
_OTHER_SPACE = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8b\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|\xef\xbb\xbf"
)


_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[x for x in range(33, 127) if chr(x) != "'" and not chr(x).isalnum()]] = True


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


def vocabulary(name: str) -> str:
    """The path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def space_led_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces, which cover all bytes."""
    n = len(data)
    blank = SPACE[data]
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    first[0] = True
    before = np.ones(n, dtype=bool)  # is the byte before of another kind, or another text's
    before[1:] = blank[1:] != blank[:-1]
    before |= first[:n]
    after = np.concatenate([before[1:], [True]])
    start = before & blank  # runs of white space
    last = blank & after & ~first[1:]  # their last byte, unless it ends the text
    start |= last
    word = before & ~blank
    led = np.zeros(n, dtype=bool)
    led[1:] = (data[:-1] == 0x20) & ~first[1:n]
    start |= word & ~led
    starts = np.flatnonzero(start)
    return starts, np.append(starts[1:], n) if len(starts) else starts


def cut_at_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces, cut between ASCII letters or digits and ASCII punctuation."""
    word, mark = _WORD[data], _MARK[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = (word[:-1] & mark[1:]) | (mark[:-1] & word[1:])
    stop = cut.copy()
    cut[starts] = True
    stop[ends] = True
    return np.flatnonzero(cut), np.flatnonzero(stop)


class Encoder:
    """Encodes Arrow columns of texts; one stands in each Python worker."""

    def __init__(self, path: str, pieces: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._pieces = pieces
        self._forget()

    def _forget(self):
        self._hashes = np.zeros(0, np.uint64)
        self._at = np.zeros(0, np.int64)  # for each hash: where its ids lie
        self._count = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and how many each text has."""
        flat, counts = [], []
        for k in range(0, len(texts), 20_000):
            lists = [e.ids for e in self._tokenizer.encode_batch(texts[k : k + 20_000], add_special_tokens=False)]
            counts += map(len, lists)
            flat.append(np.fromiter(chain.from_iterable(lists), dtype=np.uint32))
        counts = np.array(counts, dtype=np.int64)
        return (np.concatenate(flat) if flat else np.zeros(0, np.uint32)), counts

    def _learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]
        words = [self._word(t) for t in texts]
        tokenize = self._tokenizer.model.tokenize
        lists = [[token.id for token in tokenize(w)] if w else None for w in words]
        rest = [k for k, w in enumerate(words) if not w]
        ids, counts = self._encode([texts[k] for k in rest])
        ends_of = np.cumsum(counts)
        for k, a, b in zip(rest, (ends_of - counts).tolist(), ends_of.tolist()):
            lists[k] = ids[a:b].tolist()
        counts = np.fromiter(map(len, lists), dtype=np.int64)
        ids = np.fromiter(chain.from_iterable(lists), dtype=np.uint32)
        at = len(self._ids) + np.cumsum(counts) - counts
        where = np.searchsorted(self._hashes, hashes)
        self._hashes = np.insert(self._hashes, where, hashes)
        self._at = np.insert(self._at, where, at)
        self._count = np.insert(self._count, where, counts)
        self._ids = np.concatenate([self._ids, ids])

    def _word(self, text: str) -> str | None:
        """The form in which the merging model takes a piece that is one word of letters, else None."""
        if self._pieces == "word":
            if not text.isalpha() or not text.isascii() and not unicodedata.is_normalized("NFC", text):
                return None
            text = "".join(c.lower() for c in text) if not text.isascii() else text.lower()
            if not text.isalpha():
                return None
        elif not (text[1:] if text[0] == " " else text).isalpha():
            return None
        return text.encode().decode("latin-1").translate(_BYTE_LETTERS)

    def column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the number of ids before each text (with the total); null counts as empty."""
        data, offsets = text_buffers(column)
        if self._pieces is None:
            ids, counts = self._encode([t or "" for t in column.to_pylist()])
            return ids, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        if self._pieces == "word":
            starts, ends = cut_at_marks(data, *word_spans(data, offsets)[:2])
            whole = np.zeros(0, np.int64)
        else:
            found = np.fromiter((m.start() for m in _OTHER_SPACE.finditer(data)), dtype=np.int64)
            whole = np.unique(np.searchsorted(offsets, found, side="right") - 1)
            starts, ends = cut_at_marks(data, *space_led_pieces(data, offsets))
            if len(whole):
                inside = np.isin(np.searchsorted(offsets, starts, side="right") - 1, whole)
                begins = offsets[whole]
                starts, ends = np.append(starts[~inside], begins), np.append(ends[~inside], offsets[whole + 1])
                order = np.argsort(starts)
                starts, ends = starts[order], ends[order]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self._hashes.nbytes + self._at.nbytes + self._count.nbytes + self._ids.nbytes > CACHE_BYTES:
            self._forget()
        distinct, one, inverse = np.unique(Hasher(data).of(starts, ends), return_index=True, return_inverse=True)
        where = np.searchsorted(self._hashes, distinct)
        new = np.ones(len(distinct), dtype=bool)
        there = where < len(self._hashes)
        new[there] = self._hashes[where[there]] != distinct[there]
        if new.any():
            self._learn(data, distinct[new], starts[one[new]], ends[one[new]])
            where = np.searchsorted(self._hashes, distinct)
        at, count = self._at[where][inverse], self._count[where][inverse]
        before = np.cumsum(count) - count
        ids = self._ids[np.repeat(at - before, count) + np.arange(int(count.sum()))]
        totals = np.append(before, count.sum())
        return ids, totals[np.searchsorted(starts, offsets)].astype(np.int64)


def encoder(path: str, pieces: str | None) -> Encoder:
    """The worker's encoder for a tokenizer file. A worker holds one at a time, and none while it does other work."""
    return held((path, pieces), lambda: Encoder(path, pieces))
