"""The Jaccard join, the language model's rules and the alignment against plain Python."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import texts as T

from gaugelake.llm import components, decontaminate, parity, quality
from gaugelake.llm.shared import Scratch


def _sets(rows, k):
    out = []
    for _, text, *_ in rows:
        w = T.words(T.lower(text or ""))
        out.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)] if w else []))
    return out


def _roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def _near_copies():
    """A cluster of near copies of one text, some linked only through others."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(24):
        w = list(base)
        for j in range(i % 8):
            w[(13 * j + 5 * i) % 120] = f"e{i}_{j}"
        rows.append((500 + i, " ".join(w), "en", "s"))
    return rows


@pytest.mark.parametrize("k, percent, tile", [(3, 90, 400), (5, 80, 5), (1, 60, 400)])
def test_components_and_links_are_exact(spark, monkeypatch, k, percent, tile):
    monkeypatch.setattr(parity, "_TILE", tile)
    rows = T.corpus() + _near_copies()
    sets = _sets(rows, k)
    linked = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    roots = _roots(len(rows), linked)
    smallest = defaultdict(lambda: None)
    for i, (doc, *_) in enumerate(rows):
        if doc is not None and (smallest[roots[i]] is None or doc < smallest[roots[i]]):
            smallest[roots[i]] = doc
    want = Counter(
        (r[0], len(sets[i]), smallest[roots[i]] if sets[i] else r[0]) for i, r in enumerate(rows)
    )
    out, links = parity.jaccard_components(T.frame(spark, rows), k, percent, every_link=True)
    assert T.collected(out, "doc_id", "n_shingles", "component_id") == want
    assert links.count() == len({frozenset((sets[i], sets[j])) for i, j in linked if sets[i] != sets[j]})
    spanning, some = parity.jaccard_components(T.frame(spark, rows), k, percent)
    assert T.collected(spanning, "doc_id", "n_shingles", "component_id") == want
    assert some.count() <= links.count()


def test_sketch_distance_bounds_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 40, 300).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.integers(0, 12) :], rng.integers(0, 1 << 40, 9).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        assert parity.distances(parity.bit_sketch(a)[None], parity.bit_sketch(b)[None])[0] <= apart
        assert parity.distances(parity.bit_sketch(a)[None], parity.bit_sketch(b[:40])[None])[0] <= len(np.setxor1d(a, b[:40]))
        assert parity.distances(parity.bit_sketch(b[:40])[None], parity.bit_sketch(a)[None])[0] <= len(np.setxor1d(a, b[:40]))
        if 100 * len(np.intersect1d(a, b)) >= 90 * len(np.union1d(a, b)):
            assert len(np.intersect1d(parity.words_of(a, 90), parity.words_of(b, 90)))


@pytest.mark.parametrize("percent, size", [(80, 7), (80, 12), (80, 40), (60, 25), (90, 60)])
def test_short_sets_meet_only_where_they_are_alike(percent, size):
    """Linked pairs of short sets share a key, also those with empty words; sets with nothing in common do not."""
    rng = np.random.default_rng(size)
    keys, empty = [], 0
    for _ in range(1500):
        a = rng.integers(0, 1 << 63, size).astype(np.uint64)
        least = -(-size * percent // 100)
        b = np.concatenate([a[: rng.integers(least, size + 1)], rng.integers(0, 1 << 63, 3).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        keys.append(parity.words_of(a, percent))
        empty += len(keys[-1]) > sum(
            min(parity.most_apart(2 * top, percent), size * (100 - percent) // percent) + 1
            for _, top in parity.bands_of(size, percent)
        )
        if 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)):
            assert len(np.intersect1d(keys[-1], parity.words_of(b, percent)))
    _, counts = np.unique(np.concatenate(keys), return_counts=True)
    assert counts.max() == 1
    assert empty or percent == 90


def test_one_document_of_each_group_stays(spark):
    rows = [r for r in T.corpus() if r[0] is not None] + _near_copies()
    frame = T.frame(spark, rows)
    out, _ = parity.jaccard_components(frame, 5, 80)
    groups = {(r.component_id if r.n_shingles else ("alone", r.doc_id, r.node)) for r in out.collect()}
    kept = parity.keep_one(frame)
    assert kept.columns == frame.columns
    empty = {r[0] for r in rows if not T.words(r[1])}
    stayed = [r.doc_id for r in kept.collect()]
    assert Counter(d for d in stayed if d not in empty and d != 6) == Counter(
        {g for g in groups if not isinstance(g, tuple) and g not in empty and g != 6}
    )
    assert empty <= set(stayed)


def test_one_document_of_groups_without_ids_stays(spark):
    text = [" ".join(f"{letter}{i}" for i in range(60)) for letter in "abcd"]
    near = [t + " more" for t in text]
    rows = [
        *[(1, text[0], "en", "s"), (None, text[0], "en", "s"), (None, near[0], "en", "s")],  # a copy with an id stays
        *[(None, t, "en", "s") for t in (text[1], text[1], near[1], near[1])],
        *[(None, text[2], "en", "s"), (2, near[2], "en", "s"), (2, near[2], "en", "s")],
        *[(None, text[3], "en", "s"), (None, None, "en", "s"), (None, " ", "en", "s"), (None, " ", "en", "s")],
    ]
    kept = parity.keep_one(T.frame(spark, rows))
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert len({text[1], near[1]} & {t for d, t in got if d is None}) == 1
    others = Counter({k: n for k, n in got.items() if k[1] not in (text[1], near[1])})
    assert others == Counter({(1, text[0]): 1, (2, near[2]): 1, (None, text[3]): 1, (None, None): 1, (None, " "): 2})
    assert got.total() == 7 and kept.columns == T.frame(spark, rows).columns


def test_components_of_a_long_path(spark, tmp_path):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.component_roots(edges, Scratch(spark, "test")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100}


def test_base_rules_and_model(spark):
    rows = T.corpus()
    got = quality.judge(T.frame(spark, rows)).collect()
    want = Counter()
    for doc, text, lang, _ in rows:
        w = T.words(text)
        seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        full = [x for x in (text or "").split("\n") if T.words(x)]
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        want[doc, lang or "", len(w), sum(map(len, w)), symbols, len(full) - len(set(full)), len(again), failed] += 1
    assert Counter(
        (r.doc_id, r.lang, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in got
    ) == want
    assert all(r.kept == (not r.base_failed and r.low_band <= r.perplexity <= r.high_band) for r in got)


def _model(texts, order=4):
    """Interpolated modified Kneser-Ney probabilities of the highest order, spelled out."""
    grams = Counter()
    for t in texts:
        s = "\x02" * (order - 1) + t.lower().replace("\x02", " ")
        grams.update(s[i : i + order] for i in range(len(s) - order + 1) if s[i + order - 1] != "\x02")
    levels = [grams]
    for k in range(order - 1, 0, -1):
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    p = {"": 1.0 / (len(levels[0]) + 1)}
    for k, level in enumerate(levels, 1):
        n = [0] + [sum(c == i for c in level.values()) for i in range(1, 5)]
        y = n[1] / max(n[1] + 2 * n[2], 1)
        d = [0] + [min(max(i - (i + 1) * y * n[i + 1] / max(n[i], 1), 0.1), i) for i in (1, 2, 3)]
        total, mass = Counter(), Counter()
        for g, c in level.items():
            total[g[:-1]] += c
            mass[g[:-1]] += d[min(c, 3)]
        above = {}
        for g, c in level.items():
            ctx = g[:-1]
            above[g] = max(c - d[min(c, 3)], 0) / total[ctx] + min(mass[ctx] / total[ctx], 1) * p[g[1:] if k > 1 else ""]
        p = above
    return p


def test_perplexity_is_that_of_the_spelled_out_model(spark):
    rows = T.corpus()
    got = quality.judge(T.frame(spark, rows)).collect()
    models = {}
    for lang in ("en", "fr", ""):
        models[lang] = _model([r[1] or "" for r in rows if (r[2] or "") == lang])
    want = Counter()
    for doc, text, lang, _ in rows:
        if not text:
            want[doc, None] += 1
            continue
        s = "\x02" * 3 + text.lower().replace("\x02", " ")
        logs = [math.log(models[lang or ""][s[i : i + 4]]) for i in range(len(s) - 3)]
        want[doc, round(math.exp(-sum(logs) / len(text)), 4)] += 1
    assert Counter((r.doc_id, r.perplexity and round(r.perplexity, 4)) for r in got) == want
    shuffled = quality.judge(T.frame(spark, rows), held_entries=1).collect()
    assert Counter((r.doc_id, r.perplexity and round(r.perplexity, 4), r.kept) for r in shuffled) == Counter(
        (r.doc_id, r.perplexity and round(r.perplexity, 4), r.kept) for r in got
    )


def test_rows_alike_but_for_their_language_are_scored_apart(spark):
    rows = T.corpus()
    text = next(r[1] for r in rows if r[1] and len(r[1]) > 200)
    rows += [(7000, text, "en", "s"), (7000, text, "fr", "s"), (7000, text, "fr", "s")]

    def judged(**how):
        found = quality.judge(T.frame(spark, rows), **how).collect()
        return Counter((r.doc_id, r.lang, r.perplexity and round(r.perplexity, 4), r.kept) for r in found)

    held = judged()
    assert judged(held_entries=1) == held
    assert sorted(k[1] for k, n in held.items() if k[0] == 7000 for _ in range(n)) == ["en", "fr", "fr"]


def test_bands_reject_strange_documents_and_keep_the_others(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdehilmnorst"), 5)) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary, 120)), "en", "s") for i in range(80)]
    # Letters in every order are hard to foresee, a text in an alphabet of its own is foreseen too well.
    rows.append((900, " ".join("".join(rng.choice(list("abcdehilmnorst"), 5)) for _ in range(120)), "en", "s"))
    rows.append((901, " ".join("".join(chr(int(c)) for c in rng.integers(0x4E00, 0x9000, 5)) for _ in range(120)), "en", "s"))
    out = {r.doc_id: r for r in quality.judge(T.frame(spark, rows)).collect()}
    assert all(out[i].kept for i in range(80))
    assert not out[900].base_failed and not out[900].kept and out[900].perplexity > out[900].high_band
    assert not out[901].base_failed and not out[901].kept and out[901].perplexity < out[901].low_band
    kept = quality.keep_good(T.frame(spark, rows))
    assert {r.doc_id for r in kept.collect()} == {d for d, r in out.items() if r.kept}
    assert kept.columns == T.frame(spark, rows).columns


def test_bands_follow_the_measured_range(spark):
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdehilmnorst"), 5))
    vocabulary = [word() for _ in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary, 120)), "en", "s") for i in range(80)]
    rows.append((900, " ".join(word() if i % 4 == 0 else rng.choice(vocabulary) for i in range(120)), "en", "s"))
    out = {r.doc_id: r for r in quality.judge(T.frame(spark, rows)).collect()}
    logs = sorted(math.log(out[i].perplexity) for i in range(80))
    spread = logs[60] - logs[20]
    assert math.log(out[0].high_band) - math.log(out[0].low_band) <= 7 * spread + 0.03
    assert all(out[i].kept for i in range(80)) and not out[900].base_failed and not out[900].kept


def _smith_waterman(a, b):
    """Best local score, match 2, mismatch and gap -1."""
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_scores():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = rng.integers(0, 6, rng.integers(1, 25)), rng.integers(0, 6, rng.integers(1, 40))
        score, agree, first, end = decontaminate.align(a, b)
        assert score == _smith_waterman(a.tolist(), b.tolist())
        if score:
            assert _smith_waterman(a.tolist(), b[first:end].tolist()) == score and 2 * agree >= score


def test_copies_edits_and_clean_documents(spark):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 4))
    item = [word() for _ in range(40)]
    edited = [w if i % 6 else word() for i, w in enumerate(item)]
    gapped = [w for i, w in enumerate(item) if i % 9] + ["tail"]
    noise = lambda n: [word() for _ in range(n)]
    docs = [
        (1, " ".join(noise(30) + item + noise(20)), "en", "s"),
        (2, " ".join(noise(300) + edited + noise(20)).upper(), "en", "s"),
        (3, "\n".join(gapped), "en", "s"),
        (4, " ".join(noise(400)), "en", "s"),
        (5, " ".join(item[:12] + noise(60)), "en", "s"),
        (6, None, None, None),
        (7, "", "en", "s"),
        (8, "short one here", "en", "s"),
        (1, " ".join(item), "en", "s"),
        (None, " ".join(item), "en", "s"),
    ]
    docs += [(100 + i, " ".join(noise(5) + item + noise(5)), "en", "s") for i in range(30)]  # the item is common
    bench = spark.createDataFrame(
        [(10, " ".join(item)), (11, None), (12, ""), (13, "short one here"), (14, " ".join(noise(200)))],
        "item_id long, text string",
    )
    frame = T.frame(spark, docs)
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(frame, bench).collect()}
    flagged = {1, 2, 3, None, *range(100, 130)}
    assert set(got) == {(d, 10) for d in flagged} | {(8, 13)}
    assert got[1, 10].score == 1.0 and got[100, 10].first_word == 5 and got[100, 10].end_word == 45
    assert 0.4 <= got[2, 10].score < 0.9
    kept = decontaminate.drop_contaminated(frame, bench)
    assert {r.doc_id for r in kept.collect()} == {4, 5, 6, 7} and kept.columns == frame.columns


@pytest.mark.parametrize("every", [4, 5])
def test_copies_with_every_nth_word_replaced(spark, every):
    rng = np.random.default_rng(every)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    items = [[word() for _ in range(n)] for n in (20, 38, 59, 64)]
    docs = []
    for i, item in enumerate(items):
        edited = [w if j % every < every - 1 else word() for j, w in enumerate(item)]
        docs.append((i, " ".join([word() for _ in range(30)] + edited + [word() for _ in range(30)]), "en", "s"))
    bench = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(T.frame(spark, docs), bench).collect()}
    assert set(got) == {(i, i) for i in range(4)} and min(got.values()) > 0.55
    assert decontaminate.drop_contaminated(T.frame(spark, docs), bench).count() == 0


def test_copies_with_one_seed_left(spark):
    item = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10 k11"
    docs = [
        (1, "before a1 b2 X d4 e5 X g7 h8 i9 X k11 after", "en", "s"),  # g7 h8 i9 alone is whole
        (2, "before " + item + " after", "en", "s"),
        (3, "k11 a1 X b2 X g7 h8 i9 c3 X d4 X e5 X", "en", "s"),  # its words, in no order
        (4, "only g7 h8 i9 of it", "en", "s"),
    ]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: (r.score, r.n_matched) for r in decontaminate.contaminated(T.frame(spark, docs), bench).collect()}
    assert got == {1: (13 / 22, 8), 2: (1.0, 11)}


def test_common_words_bound_the_score():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = rng.integers(0, 9, rng.integers(1, 25)), rng.integers(0, 9, rng.integers(1, 40))
        score, agree, _, _ = decontaminate.align(a, b)
        most = decontaminate._common(a, b)
        assert agree <= most == (Counter(a.tolist()) & Counter(b.tolist())).total() and score <= 2 * most


def test_seeds_of_many_items_are_taken_in_halves(monkeypatch):
    tail = "beta gamma delta epsilon zeta eta theta"
    items = decontaminate.Items([(i, f"alpha{i} {tail}{i}") for i in range(9)])
    texts = pa.array([f"see alpha{i} {tail}{i} here" for i in range(9)] + [None, "no seed at all"])
    once = decontaminate._matches(items, 0.4, texts)
    monkeypatch.setattr(decontaminate, "_HELD_PAIRS", 100)
    assert sorted(decontaminate._matches(items, 0.4, texts)) == sorted(once) and {m[0] for m in once} == set(range(9))


def test_texts_without_a_seed(spark):
    bench = spark.createDataFrame([(1, "nothing like this stands in any of the documents here")], "item_id long, text string")
    docs = T.frame(spark, [(1, "quite other words", "en", "s"), (2, None, None, None)])
    assert decontaminate.contaminated(docs, bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench).count() == 2


def test_a_large_benchmark_goes_in_slices(spark, monkeypatch):
    bench = spark.createDataFrame([(i, f"alpha{i} beta gamma delta epsilon zeta eta theta{i}") for i in range(9)], "item_id long, text string")
    docs = T.frame(spark, [(i, f"see alpha{i} beta gamma delta epsilon zeta eta theta{i} here", "en", "s") for i in range(9)])
    once = T.collected(decontaminate.contaminated(docs, bench), "doc_id", "item_id", "score")
    monkeypatch.setattr(decontaminate, "_SLICE_WORDS", 16)
    assert T.collected(decontaminate.contaminated(docs, bench), "doc_id", "item_id", "score") == once
    assert {(i, i, 1.0) for i in range(9)} <= set(once)


@pytest.mark.parametrize("judged", [parity.keep_one, quality.judge])
def test_texts_meet_python_in_small_batches(spark, judged):
    def batch_bytes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 4000, 1, 1).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), 300) as text", "'en' as lang")
    judged(docs.limit(10))
    sizes = [row.n for row in docs.mapInArrow(batch_bytes, "n long").collect()]
    assert sum(sizes) > 8_000_000 and max(sizes) < 3_000_000


def test_a_tile_gives_the_closest_pairs_of_a_row_first():
    n = 300
    bits = parity.bit_sketch(np.arange(100, dtype=np.uint64)).tobytes()
    same = {c: pa.array([0] * n, pa.int64()) for c in ("word", "first", "second", "side")}
    own = {c: pa.array(range(n), pa.int64()) for c in ("node", "label")}
    tile = pa.RecordBatch.from_pydict(same | own | {"n_shingles": pa.array([100] * n, pa.int64()), "bits": [bits] * n})
    few = pa.Table.from_batches(list(parity._tile_pairs(80, True, 4)([tile]))).to_pylist()
    assert len(few) < 5 * n and {"a": None, "b": None} in few
    every = pa.Table.from_batches(list(parity._tile_pairs(80, True, n)([tile]))).to_pylist()
    assert len(every) == n * (n - 1) // 2 and {"a": None, "b": None} not in every


def test_pairs_left_out_are_looked_at_again(spark, monkeypatch):
    docs = T.frame(spark, _near_copies())
    once = sorted(tuple(r) for r in parity.jaccard_components(docs, 3, 80)[0].select("doc_id", "component_id").collect())
    monkeypatch.setattr(parity, "_NEAREST", 1)
    again = sorted(tuple(r) for r in parity.jaccard_components(docs, 3, 80)[0].select("doc_id", "component_id").collect())
    assert again == once


def test_empty_tables(spark):
    none, bench = T.frame(spark, []), spark.createDataFrame([], "item_id long, text string")
    out, links = parity.jaccard_components(none)
    assert out.count() == links.count() == parity.keep_one(none).count() == 0
    assert quality.judge(none).count() == quality.keep_good(none).count() == 0
    assert decontaminate.contaminated(none, bench).count() == decontaminate.drop_contaminated(T.frame(spark), bench).count() - len(T.corpus()) == 0


def test_far_pairs_are_not_verified_and_settled_groups_not_looked_at_again(spark, monkeypatch):
    """Of 40 texts with a shared beginning and 24 near copies, only pairs that may be linked bring their sets, and
    a further round takes the groups with pairs left out alone."""
    start = " ".join(f"s{i}" for i in range(60))
    rows = [(i, start + "".join(f" o{i}_{j}" for j in range(100)), "en", "s") for i in range(40)] + _near_copies()
    verified, tiled, sent, looked = parity._verified, parity._tiled, [], []

    def counted(pairs, *others):
        sent.append(pairs.count())
        return verified(pairs, *others)

    def held(members, *others):
        looked.append(members.count())
        return tiled(members, *others)

    monkeypatch.setattr(parity, "_verified", counted)
    monkeypatch.setattr(parity, "_tiled", held)
    monkeypatch.setattr(parity, "_NEAREST", 1)
    out, _ = parity.jaccard_components(T.frame(spark, rows), 3, 80)
    sets = _sets(rows, 3)
    may = sum(
        100 * len(sets[i] & sets[j]) >= 60 * len(sets[i] | sets[j]) for i in range(len(rows)) for j in range(i)
    )
    assert 0 < sum(sent) <= may
    assert len(looked) > 1 and looked[1] < looked[0]
    kept = {r.doc_id for r in out.collect() if r.doc_id == r.component_id}
    assert kept >= set(range(40))


def test_a_large_tile_holds_few_pairs_at_a_time(monkeypatch):
    """Compared in parts, a tile gives each row's closest pairs as if compared at once, and the word of rows with others."""
    rng, n = np.random.default_rng(5), 90
    sets = [np.unique(rng.integers(0, 130, 100)).astype(np.uint64) for _ in range(n)]
    same = {c: pa.array([0] * n, pa.int64()) for c in ("first", "second", "side")} | {"word": pa.array([7] * n, pa.int64())}
    own = {c: pa.array(range(n), pa.int64()) for c in ("node", "label")}
    sizes, bits = pa.array([len(s) for s in sets], pa.int64()), [parity.bit_sketch(s).tobytes() for s in sets]
    tile = pa.RecordBatch.from_pydict(same | own | {"n_shingles": sizes, "bits": bits})
    once = pa.Table.from_batches(list(parity._tile_pairs(50, True, 3)([tile]))).to_pylist()
    monkeypatch.setattr(parity, "_PAIRS", 200)
    parts = pa.Table.from_batches(list(parity._tile_pairs(50, True, 3)([tile]))).to_pylist()
    assert parts == once and {"a": None, "b": 7} in once
    assert max(Counter(r["a"] for r in once if r["a"] is not None).values()) == 3
