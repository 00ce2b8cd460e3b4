"""Substring, suffix and line dedup against plain Python."""

from collections import Counter, defaultdict

import numpy as np
import pytest
import texts as T

from gaugelake.llm import arrays, debruijn, lines, suffixes


@pytest.mark.parametrize("k, block_bytes", [(5, 2_000), (12, 4_000), (35, 1 << 23)])
def test_debruijn_removes_exactly_the_covered_words(spark, k, block_bytes):
    rows = T.corpus()
    got = debruijn.remove_repeats(T.frame(spark), k, block_bytes)
    docs = [tuple(T.words(r[1])) for r in rows]
    want = Counter()
    for row, doc, flags in zip(rows, docs, T.repeats(docs, k, None), strict=True):
        kept = " ".join(w for w, gone in zip(doc, flags, strict=True) if not gone)
        want[row[0], len(doc), sum(flags), kept, T.sha(kept.encode())] += 1
    assert T.collected(got, "doc_id", "n_words", "n_removed", "kept_text", "kept_sha256") == want


def test_debruijn_paths_are_compacted_and_repeat(spark):
    rows = [(i, "x%d y%d " % (i, i) + "a b c d e f g h " + "z%d" % i, "en", "s") for i in range(5)]
    rows.append((9, "p q c d e f r s", "en", "s"))
    paths = debruijn.remove_repeats(T.frame(spark, rows), 3, 200, spans=True).collect()
    by_path = defaultdict(set)
    for p in paths:
        by_path[p.path].add((p.doc_id, p.first_word, p.end_word))
    assert all(len(v) > 1 for v in by_path.values())
    # c d e f is cut out of a..h where the sixth document enters and leaves it.
    assert sorted((len(v), next(iter(v))[2] - next(iter(v))[1]) for v in by_path.values()) == [(5, 4), (5, 4), (6, 4)]


@pytest.mark.parametrize("width, block_bytes", [(30, 2_000), (64, 3_000), (400, 1 << 23)])
def test_suffixes_remove_exactly_the_covered_bytes(spark, width, block_bytes):
    rows = T.corpus()
    got = suffixes.remove_repeats(T.frame(spark), width, block_bytes)
    docs = [(r[1] or "").encode() for r in rows]
    want = Counter()
    for row, doc, flags in zip(rows, docs, T.repeats(docs, width, None), strict=True):
        kept = bytes(b for b, gone in zip(doc, flags, strict=True) if not gone)
        spans = sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags))
        want[row[0], len(doc), sum(flags), spans, T.sha(kept)] += 1
    assert T.collected(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


@pytest.mark.parametrize("documents, least", [(3, 20), (2, 1)])
def test_lines_stay_in_the_largest_document_only(spark, documents, least):
    rows = T.corpus() + [(2000 + i, f"own line {i}\n  A COMMON LINE OF SOME LENGTH \nend", "en", "s") for i in range(4)]
    key = lambda x: T.lower(x.strip(" \t\n\r\x0b\x0c"))
    holders = defaultdict(set)
    for doc, text, *_ in rows:
        for x in (text or "").split("\n"):
            if doc is not None and len(key(x)) >= least:
                holders[key(x)].add(doc)
    keeper = {k: max(v) for k, v in holders.items() if len(v) >= documents}
    want = Counter()
    for doc, text, *_ in rows:
        every = (text or "").split("\n")
        kept = [x for x in every if key(x) not in keeper or keeper[key(x)] == doc]
        want[doc, len(every), len(every) - len(kept), T.sha("\n".join(kept).encode())] += 1
    got = lines.drop_repeated_lines(T.frame(spark, rows), documents, least, 2_000)
    assert sum(n for (_, _, dropped, _), n in want.items() if dropped) >= 3
    assert T.collected(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == want


def test_empty_tables(spark):
    none = T.frame(spark, [])
    assert debruijn.remove_repeats(none).count() == suffixes.remove_repeats(none).count() == 0
    assert lines.drop_repeated_lines(none).count() == 0


def test_bloom_filter_has_no_false_negative():
    keys = arrays.mix(np.arange(5_000, dtype=np.uint64))
    bloom = lines.Bloom(len(keys))
    bloom.add(keys)
    assert bloom.holds(keys).all()
    assert bloom.holds(arrays.mix(np.arange(5_000, 50_000, dtype=np.uint64))).mean() < 0.01


def test_packed_keys_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000):
        keys = arrays.distinct(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        back, rest = arrays.unpack_keys(arrays.pack_keys(keys) + b"rest")
        assert (back == keys).all() and bytes(rest) == b"rest"
    keys = arrays.distinct(rng.integers(0, 1 << 63, 500, dtype=np.uint64))
    found = arrays.SortedHashes(keys[::2]).find(keys)
    assert (found[::2] == np.arange(250)).all() and (found[1::2] == -1).all()
