"""Hashes of texts, whole and in segments, and the memory that a very long text takes."""

import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from weftwork.llm import textbatch
from weftwork.llm.textbatch import Hasher, run_hashes, text_buffers, word_hashes


def test_equal_ranges_have_equal_hashes_wherever_they_stand(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, 300_000, dtype=np.uint8)
    data[200_000:200_500] = data[100:600]
    starts = rng.integers(0, len(data) - 400, 5000)
    ends = starts + rng.integers(0, 400, 5000)
    whole = Hasher(data).of(starts, ends)
    one, two = Hasher(data).of(np.array([100, 200_000]), np.array([600, 200_500]))
    assert one == two
    for k in range(0, 5000, 500):  # the hash of a range alone
        assert whole[k] == Hasher(data[starts[k] : ends[k]]).of(np.array([0]), np.array([ends[k] - starts[k]]))[0]
    monkeypatch.setattr(textbatch, "SEGMENT_BYTES", 1000)
    assert (Hasher(data).of(starts, ends) == whole).all()
    order = np.argsort(starts)
    assert (Hasher(data).of(starts[order], ends[order]) == whole[order]).all()


def test_runs_of_values():
    values = np.random.default_rng(2).integers(0, 1 << 63, 200_000, dtype=np.uint64)
    values[150_000:150_100] = values[:100]
    one, two, other = run_hashes(values, np.array([0, 150_000, 1]), np.array([100, 150_100, 100]))
    assert one == two != other


def test_words_of_a_long_text_hash_as_in_short_ones(monkeypatch):
    words = [f"Wort{k}é" for k in range(2000)]
    short, _ = word_hashes(*text_buffers(pa.array(words)))
    monkeypatch.setattr(textbatch, "SEGMENT_BYTES", 777)
    long, _ = word_hashes(*text_buffers(pa.array([" ".join(words)])))
    assert (short == long).all()


_STEPS = {
    "words": "w, f = textbatch.word_hashes(*textbatch.text_buffers(column)); textbatch.shingles(w, f, 5)",
    "lines": "from weftwork.llm.linededup import line_hashes; line_hashes(*textbatch.text_buffers(column))",
    "regions": "from weftwork.llm.suffixdedup import regions; regions(*textbatch.text_buffers(column), 400, 64)",
    "toxicity": "from weftwork.llm.toxicity import Lexicon, Scanner; Scanner(Lexicon({'idiot': 1.0}, {'scum': 1.0})).column(column)",
}


@pytest.mark.parametrize("step", _STEPS)
def test_one_text_of_40_mb_takes_bounded_memory(step):
    code = f"""
import resource
import pyarrow as pa
from weftwork.llm import textbatch
import weftwork.llm.linededup, weftwork.llm.suffixdedup, weftwork.llm.toxicity
most = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
column = pa.array([("Wörter und words, 日本 Zeile " * 16 + "\\n") * 75_000])
before = most()
{_STEPS[step]}
print(most() - before)
"""
    taken = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert taken < 600  # MB; a text and what its words need, but no tables as long as the text
