"""Small documents with every awkward case, and the contracts spelled out in plain Python."""

import hashlib
import random
import re
from collections import Counter

SPACE = r"[\x20\x09-\x0D]+"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, block int, size string, node string,"
    " row int, `key` string, rank int, copies string, round int, text_hash string"
)


def lower(text):
    return text.translate(_LOWER)


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def corpus(seed=7, n=60):
    """(doc_id, text, lang, source) with nulls, empties, repeated rows, ties, shared passages and near copies."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 6))) for _ in range(80)] + ["The", "K", "ǅ"]
    sentence = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    shared = [sentence(45) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [sentence(rng.randint(1, 70)) for _ in range(rng.randint(1, 4))]
        if i % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), shared[i % 4])
        text = rng.choice(["\n", " ", "\n\t", "  "]).join(parts)
        if rows and i % 7 == 0:
            old = words(rows[-1][1])
            if old:
                old[rng.randrange(len(old))] = "edited"
            text = " ".join(old)
        rows.append([i, text, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "ä", "Z", None])])
    rows += [
        [1000, None, None, None],
        [1001, "", "en", "a"],
        [1002, " \n\t ", "en", "a"],
        [1003, "one", "en", "b"],
        [1004, "ONE", "en", "b"],
        [1005, "two words", "fr", "b"],
        [1006, "é" * 1500, "fr", "ä"],
        [1007, "aaaa bbbb " * 400, "fr", "ä"],
        [1008, " ".join(shared * 12), "en", "Z"],
        [5, rows[5][1], "en", "a"],
        [6, "another text under a used id " + shared[0], "en", None],
        [None, rows[3][1], "en", "a"],
        [None, None, None, None],
        [None, "no id, own text " + shared[1], "en", "a"],
        [2**40, rows[9][1], "en", "b"],
        [-3, "x\x02y \x85 z " + shared[2], "en", "b"],
    ]
    return [tuple(r) for r in rows]


def frame(spark, rows=None):
    """The corpus with extra columns whose names clash with the operators' own."""
    rows = corpus() if rows is None else rows
    return spark.createDataFrame(
        [(*r, 1, 2, "s", "n", 3, "k", 4, "c", 5, "h") for r in rows], SCHEMA
    ).repartition(5)


def repeats(texts, width, covered_by):
    """Flags of the places covered by a window that starts twice or more in all texts."""
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        flags = [False] * len(t)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                flags[i : i + width] = [True] * width
        out.append(flags)
    return out


def collected(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())
