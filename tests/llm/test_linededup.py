"""Line dedup against a plain walk over all texts."""

import hashlib
import random
import re

from weftwork.llm import queries
from weftwork.llm.linededup import fingerprints, repeated_lines, without_repeated_lines

FOLDER = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


def words(line):
    return re.findall(r"[^\x20\x09-\x0D]+", line)


def plain(rows, gram_words=8, min_words=16):
    """Which repeated runs are guaranteed to go, and which lines are allowed to: (must, may) by row."""
    texts = sorted((i, [line.strip(SPACE) for line in t.split("\n")]) for i, t in rows if i is not None and t is not None)
    seen, seen_grams, must, may = set(), set(), {}, {}
    for i, lines in texts:
        weight = [max(1, len(words(x))) for x in lines]
        must[i], may[i] = set(), set()
        for start in range(len(lines)):
            total = 0
            for end in range(start, len(lines)):
                total += weight[end]
                key = tuple(lines[start : end + 1])
                if total >= min_words:
                    if key in seen and end == start:
                        must[i].add(start)
                    seen.add(key)
                    break
        grams = []
        for start in range(len(lines)):
            total = 0
            for end in range(start, len(lines)):
                total += weight[end]
                if total >= gram_words:
                    grams.append((start, end + 1))
                    break
        for start, end in grams:
            key = tuple(lines[start:end])
            if key in seen_grams:
                may[i].add(start)
                may[i].update(range(start, end))
            seen_grams.add(key)
    return must, may


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    must, may = plain(rows)
    cleaned = {r.doc_id: r for r in without_repeated_lines(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()}
    assert sum(map(len, must.values())) > 100
    for i, text in rows:
        lines, left = text.split("\n"), cleaned[i].text.split("\n") if cleaned[i].lines_dropped < len(text.split("\n")) else []
        assert len(left) + cleaned[i].lines_dropped == len(lines)
        at, dropped = 0, set()
        for k, line in enumerate(lines):  # match from the left; a dropped line is one that cannot be matched
            if at < len(left) and left[at] == line and len(lines) - k >= len(left) - at:
                at += 1
            else:
                dropped.add(k)
        assert at == len(left)
        long_kept = [k for k in must[i] if k not in dropped and lines[k] in left and lines.count(lines[k]) == 1]
        assert not long_kept, (i, long_kept)
        if not may[i]:
            assert cleaned[i].lines_dropped == 0
    digests = {r.doc_id: (r.lines_dropped, r.text_sha256) for r in queries.QUERIES["op7_line_dedup"](spark, FOLDER).collect()}
    assert digests == {i: (r.lines_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for i, r in cleaned.items()}


def test_runs(spark):
    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    short = ["a b c", "d e f g", "h i j k l", "m n o p q", "r"]
    rows = [
        (1, "\n".join(["x", a, "tail 1"])),
        (2, "\n".join(["y", " " + a + "\t", "tail 2"])),
        (3, "\n".join(["head", *short, "end of three"])),
        (4, "\n".join(["begin", *short, "end of four"])),
        (5, a),
        (6, "\n".join([a, a, "z", a])),
        (7, "\n".join(["a b c", "d e f g"])),
        (8, None), (None, a), (9, ""), (10, "r"), (5, a), (11, "r\n" * 40000),
    ]
    frame = spark.createDataFrame([(*r, "s", 3) for r in rows], "doc_id long, text string, hash string, lines_dropped int")
    found = sorted(((r.doc_id or 0, r.text, r.lines_dropped) for r in without_repeated_lines(frame.repartition(5)).collect()), key=lambda r: r[0])
    by_id = {i: (t, n) for i, t, n in found}
    assert len(found) == len(rows)
    assert by_id[1] == (rows[0][1], 0) and by_id[3] == (rows[2][1], 0)
    assert by_id[2] == ("y\ntail 2", 1)
    assert by_id[4] == ("begin\nend of four", 5)
    assert by_id[5] == ("", 1) and by_id[6] == ("z", 3)
    assert by_id[7] == (rows[6][1], 0) and by_id[8] == (None, 0) and by_id[0] == (a, 0) and by_id[9] == ("", 0)
    assert by_id[10] == ("r", 0) and by_id[11][1] > 39000
    assert without_repeated_lines(frame.limit(0)).count() == 0


def test_shared_passages_in_random_places(spark):
    rng = random.Random(2)
    passages = [["p%d w%d " % (p, k) * rng.randrange(1, 6) for k in range(rng.randrange(3, 9))] for p in range(12)]
    rows = []
    for i in range(300):
        lines = ["u%d %d" % (i, k) + " q" * rng.randrange(12) for k in range(rng.randrange(2, 10))]
        at = rng.randrange(len(lines))
        rows.append((i, "\n".join(lines[:at] + rng.choice(passages) + lines[at:])))
    left = {r.doc_id: r.text for r in without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    for p, lines in enumerate(passages):
        if sum(len(words(x)) for x in lines) >= 16:
            assert sum(any(f"p{p} " in x for x in text.split("\n")) for text in left.values()) <= 1
    assert all(f"u{i} 0" in text for i, text in left.items())


def repeats(rows, min_words=16):
    """All lines of later runs of ``min_words`` that stand earlier too, apart from each other."""
    texts = sorted((i, [line.strip(SPACE) for line in t.split("\n")]) for i, t in rows)
    first, out = {}, {i: set() for i, _ in texts}
    for i, lines in texts:
        for start in range(len(lines)):
            total = 0
            for end in range(start, len(lines)):
                total += max(1, len(words(lines[end])))
                if total >= min_words:
                    at = first.setdefault(tuple(lines[start : end + 1]), (i, start))
                    if at[0] != i or at[1] + end - start < start:
                        out[i].update(range(start, end + 1))
                if total >= 3 * min_words:
                    break
    return out


def test_other_places_than_the_first_of_a_fingerprint(spark):
    line = lambda name: " ".join(f"{name}{k}" for k in range(10))
    rows = [(1, "xfy"), (2, "almb"), (3, "clmd"), (4, "flg"), (5, "hmi"), (6, "plmfq"), (7, "rlmfs"), (8, "tfu"), (9, "vlmfw")]
    rows = [(i, "\n".join(map(line, t))) for i, t in rows]
    left = {r.doc_id: r.text for r in without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left[3] == line("c") + "\n" + line("d") and left[7] == line("r") + "\n" + line("s") and left[9] == line("v") + "\n" + line("w")
    # Versions of passages: pieces of different lengths in many texts, lines of one word to twelve.
    rng = random.Random(7)
    passages = [["p%d.%d " % (p, k) + "w " * rng.randrange(12) for k in range(14)] for p in range(15)]
    rows = []
    for i in range(500):
        lines = []
        for part in range(rng.randrange(1, 4)):
            a = rng.randrange(13)
            lines += ["u%d.%d" % (i, part) + " q" * rng.randrange(9)] + rng.choice(passages)[a : a + rng.randrange(1, 9)]
        rows.append((i, "\n".join(lines)))
    rows += [(500, "\n".join(f"line {k % 20}" for k in range(60))), (501, "\n".join(["z"] * 100))]
    want = repeats(rows)
    found = {r.doc_id: set(r.drop) for r in repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert sum(map(len, want.values())) > 1000
    assert not {i: lines - found.get(i, set()) for i, lines in want.items() if lines - found.get(i, set())}


def test_every_repeated_run_of_the_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = repeats([(r.doc_id, r.text) for r in docs.collect() if r.text is not None and r.doc_id is not None])
    found = {r.doc_id: set(r.drop) for r in repeated_lines(docs).collect()}
    assert not {i: lines - found.get(i, set()) for i, lines in want.items() if lines - found.get(i, set())}


def test_many_lines_take_seconds():
    import time

    rng = random.Random(12)
    start = time.monotonic()
    found = fingerprints([rng.getrandbits(64) for _ in range(100_000)], [rng.randrange(1, 9) for _ in range(100_000)], 8, 16)
    assert len(found) > 10_000 and time.monotonic() - start < 10


def test_a_text_of_many_lines(spark):
    lines = [f"line number {k} of a text that is long enough" for k in range(100_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["first", *lines[500:], "last"]))]
    found = {r.doc_id: r for r in without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].lines_dropped == 0 and found[2].lines_dropped == 99_500 and found[2].text == "first\nlast"


def test_columns_of_clashing_names(spark):
    text = "\n".join(f"these are the words of line {k} here" for k in range(9))
    names = "doc_id long, lines_dropped string, __drop string, row int, found int, drop_id int, text string, version int, mask int"
    rows = [(k, "mine", "d", 1, 2, 3, text, 4, 5) for k in (1, 2)]
    found = without_repeated_lines(spark.createDataFrame(rows, names), count_column="_lines_dropped").orderBy("doc_id").collect()
    assert [r.asDict() | {"text": ""} for r in found] == [
        dict(zip([n.split()[0] for n in names.split(", ")], row)) | {"text": "", "_lines_dropped": dropped} for row, dropped in zip(rows, (0, 9))
    ]
    assert [r.text for r in found] == [text, ""]
