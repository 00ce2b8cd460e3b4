"""Hard negatives, resampling and personal data against plain Python."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import texts as T
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugelake.llm import negatives, personal, resampling

VECTORS = "vec_id long, embedding array<double>, label int, `row` string, cell string, copies string, score int, rank int"
INF, NAN = math.inf, math.nan


# --- hard negatives ---------------------------------------------------------------------


def _vectors(rng, n, dims, wild=()):
    rows = []
    for i in range(n):
        center = [math.cos(i % 4 + j) for j in range(dims)]
        rows.append((i, [c + rng.uniform(-0.7, 0.7) for c in center], rng.choice([0, 0, 0, 1, 2])))
    return rows + list(wild)


def _mined(rows, divisor, scale=256):
    """All pairs, spelled out."""
    q = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x * scale) for x in vector):
            continue
        q.append((vec_id, [math.floor(x * scale) for x in vector], label))
    first = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for i, (anchor, a, label) in enumerate(q):
        if anchor is None or anchor % divisor:
            continue
        scored = [(sum(x * y for x, y in zip(a, b, strict=False)), v, k) for j, (v, b, k) in enumerate(q) if j != i]
        for p, positive, _ in sorted([r for r in scored if r[2] == label], key=first)[:5]:
            between = [r for r in scored if r[2] != label and 50 * p <= 100 * r[0] <= 95 * p]
            for rank, (s, v, _) in enumerate(sorted(between, key=first)[:3], 1):
                out.append((anchor, positive, rank, v, p, s))
    return Counter(out)


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "c", "n", 1, 2) for r in rows], VECTORS).repartition(3)


def _got(spark, rows, divisor):
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return T.collected(negatives.mine(_frame(spark, rows), F.col("vec_id") % divisor == 0), *columns)


def test_negatives_of_awkward_rows(spark):
    rng = random.Random(3)
    near = [math.cos(j) for j in range(13)]
    wild = [
        (None, near, 0),
        (None, near, 1),
        (10, near, 0),  # a used id
        (10, near, 0),
        (20, near, 0),  # an anchor that occurs three times
        (20, near, 0),
        (300, near, 1),
        (300, near, 1),
        (-50, near, 2),
        (400, None, 1),
        (401, near, None),
        (402, [0.1, None], 1),
        (403, [0.1, NAN], 1),
        (404, [INF], 1),
        (405, [1.7e308], 1),
        (410, [], 0),
        (411, [0.5], 1),
        (412, near + [0.25] * 9, 1),
        (420, [1000.0, -1000.0], 0),
    ]
    rows = _vectors(rng, 120, 13, wild)
    want = _mined(rows, 10)
    assert _got(spark, rows, 10) == want and sum(want.values()) > 100


def test_negatives_of_many_cells(spark, monkeypatch):
    monkeypatch.setattr(negatives, "_TABLE_BYTES", 30_000)
    monkeypatch.setattr(negatives, "_TILE", (7, 3))
    rows = _vectors(random.Random(5), 300, 20)
    assert _got(spark, rows, 6) == _mined(rows, 6)


def test_negatives_tie_by_id(spark):
    rows = [(i, [1.0, 0.0], i % 2) for i in range(0, 40)] + [(100 + i, [0.75, 1.0], i % 2) for i in range(20)]
    assert _got(spark, rows, 10) == _mined(rows, 10)


def test_negatives_of_huge_components(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(0.6, 1) * 10.0 ** rng.choice([3, 3, 5]) for _ in range(9)], i % 2) for i in range(40)]
    assert _got(spark, rows, 4) == _mined(rows, 4)
    huge = [(i, [1e30 * (1 + i), 0.5], i % 2) for i in range(12)]
    ends = {r.positive_score for r in negatives.mine(_frame(spark, huge), F.col("vec_id") % 4 == 0).collect()}
    assert ends <= {2**63 - 1}


def test_no_vectors_no_negatives(spark):
    assert not _got(spark, [], 10)
    assert not _got(spark, [(1, [0.5], 1), (2, [0.5], 1)], 10)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**70), 2**70) | st.integers(-300, 300), min_size=11, max_size=11), min_size=1, max_size=6))
def test_planes_hold_integers(rows):
    wide = any(abs(x) >= 2**61 for r in rows for x in r)
    q = np.array([r + [0] * 5 for r in rows], object if wide else np.int64)
    stacked = negatives.stack_planes(np.full(len(rows), 2), negatives.pack_planes(q))
    assert negatives.unpack_planes(stacked).tolist() == q.tolist()
    want = [[sum(x * y for x, y in zip(a, b, strict=True)) for a in q.tolist()] for b in q.tolist()]
    assert negatives.SubsetSums(q).scores(stacked, 0, len(rows)).tolist() == want


# --- resampling -------------------------------------------------------------------------

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text, buckets):
    words = _WORD.findall(T.lower(text or ""))
    return words, [zlib.crc32(x.encode()) % buckets for x in [*words, *map(" ".join, zip(words, words[1:], strict=False))]]


def _resampled(docs, target, percent=25, least=20, seed=7, buckets=10_000):
    corpus, aim, held = Counter(), Counter(), []
    for doc, text in docs:
        words, features = _features(text, buckets)
        corpus.update(features)
        held.append((doc, len(words), features))
    for text in target:
        aim.update(_features(text, buckets)[1])
    s_all, t_all = sum(corpus.values()), sum(aim.values())
    gain = [
        math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((corpus[b] + 1) * (t_all + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for doc, n, features in held:
        weight = sum(gain[b] for b in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n])
    able = sorted([r for r in rows if r[4] >= least], key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i for i, r in enumerate(able[: percent * len(able) // 100], 1)}
    return Counter((*r[:4], rank.get(id(r))) for r in rows)


def test_resampling_of_awkward_texts(spark):
    docs = T.corpus() + [
        (4000, "Ab\nab\r\nAB cd\n\n\ncd " + "é" * 90 + "\n" + "x" * 200 + " " + "y" * 49, "en", "a"),
        (4001, "a-b_c\x00d퟿z 12ab İstanbul", "en", "a"),
        (4002, "word\n" * 3000 + "word", "en", "a"),
        (4003, "\n", "en", "a"),
        (4004, "z" * 100_000 + " end", "en", "a"),
    ]
    target = ["the shared words abc", None, "", docs[4][1], "ab ab\nab"]
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, bucket int")
    got = resampling.resample(T.frame(spark, docs), aim)
    want = _resampled([d[:2] for d in docs], target)
    assert T.collected(got, "doc_id", "n_features", "weight", "score", "rank") == want
    small = resampling.resample(T.frame(spark, docs), aim, percent=60, least_words=1, seed=11, buckets=64)
    want = _resampled([d[:2] for d in docs], target, 60, 1, 11, 64)
    assert T.collected(small, "doc_id", "n_features", "weight", "score", "rank") == want


def test_resampling_of_test_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs, target = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    got = resampling.resample(docs, target)
    want = _resampled([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert T.collected(got, "doc_id", "n_features", "weight", "score", "rank") == want


def test_repeated_rows_are_ranked_apart(spark):
    docs = [(1, "some words of a text " * 5, "en", "a")] * 40 + [(None, "another text with words " * 6, "en", "a")] * 20
    ranks = [r["rank"] for r in resampling.resample(T.frame(spark, docs), spark.createDataFrame([("words",)], "text string")).collect()]
    assert sorted(r for r in ranks if r) == list(range(1, 16)) and len(ranks) == 60


def test_resampling_of_nothing(spark):
    docs, aim = T.frame(spark), spark.createDataFrame([], "text string")
    assert resampling.resample(T.frame(spark, []), aim).count() == 0
    got = resampling.resample(docs, aim)
    assert T.collected(got, "doc_id", "n_features", "weight", "score", "rank") == _resampled([d[:2] for d in T.corpus()], [])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=150), min_size=2, max_size=8))
def test_checksums_of_pairs(words):
    raw = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    sums = resampling.word_checksums(raw, ends - [len(w) for w in words], ends)
    assert sums.tolist() == [zlib.crc32(w) for w in words]
    sizes = np.array([len(w) for w in words])
    pairs = resampling.pair_checksums(sums[:-1], sums[1:], sizes[1:])
    assert pairs.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:], strict=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aB1é \n\r-", max_size=30), max_size=6))
def test_lines_have_all_features(some):
    texts = resampling.Texts(pa.array(some, pa.string()), 1 << 31)
    lines = texts.lines
    got = [Counter() for _ in some]
    per_line = [[] for _ in range(lines.n)]
    for line, bucket in zip(lines.line.tolist(), lines.bucket.tolist(), strict=True):
        per_line[line].append(bucket)
    for text, line in zip(texts.text.tolist(), texts.of.tolist(), strict=True):
        got[text].update(per_line[line])
    for text, bucket in zip(texts.crossing.tolist(), texts.across.tolist(), strict=True):
        got[text][bucket] += 1
    assert got == [Counter(_features(t, 1 << 31)[1]) for t in some]


# --- personal data ----------------------------------------------------------------------

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(text):
    return [int(c) for c in text if c in "0123456789"]


def _luhn(digits):
    doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def _base(text):
    found = [("email", m) for m in _EMAIL.finditer(text)]
    found += [("ip", m) for m in _IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [("card", m) for m in _CARD.finditer(text) if 16 <= len(_digits(m.group())) <= 19 and _luhn(_digits(m.group()))]
    found += [("phone", m) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return [(kind, m.start(), m.end()) for kind, m in found]


def _named(text):
    return [(personal.KINDS[k], s, e) for k, s, e in personal.spans_of(text)]


def _held(text):
    return [(k, text[s:e]) for k, s, e in _named(text) if k not in personal.BASE]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["1", "0", "4111 1111-1111 1111", "255", "256", ".", "@", "a", "é", "+", " ", "-", "(", ":", "%", "\n", "b.c"]), max_size=40))
def test_base_spans_are_the_patterns(parts):
    text = "".join(parts)
    assert [x for x in _named(text) if x[0] in personal.BASE] == _base(text)


def test_cues_lead_to_more():
    assert _held("write to ann.lee [at] mail [dot] org or bob(at)host.net") == [("mail", "ann.lee [at] mail [dot] org"), ("mail", "bob(at)host.net")]
    assert _held("IBAN: DE89 3704 0044 0532 0130 00, iban GB82WEST12345698765432.") == [
        ("iban", "DE89 3704 0044 0532 0130 00"),
        ("iban", "GB82WEST12345698765432"),
    ]
    assert _held("IBAN DE88 3704 0044 0532 0130 00") == []
    assert _held("SSN 078-05-1120, ssn: 000-05-1120, social security number 219-09-9999") == [("ssn", "078-05-1120"), ("ssn", "219-09-9999")]
    assert _held("account no. 12345678 and Passport number: X1234567, account 12") == [("account", "12345678"), ("account", "X1234567")]
    assert _held("http://ann:pw@host.org/x and https://host.org/@b") == [("login", "ann:pw")]
    assert _held("from 2001:db8::8a2e:370:7334 at 12:30:45 in std::vector and a::b") == [("ipv6", "2001:db8::8a2e:370:7334")]
    assert _held("tel:0930-555-2361, skype:ann.lee hotel: 12345") == [("contact", "0930-555-2361"), ("contact", "ann.lee")]
    assert _held("mailto:ann@host.org") == []  # the base span holds it


@pytest.mark.parametrize("part", ["1", "1.", "1 ", "@", "a@", "+1", ":", "a:", "1.1.1.1@", "account ", "[at]a.", "iban "])
def test_long_texts_take_time_in_proportion(part):
    short = part * (2_000 // len(part))
    assert [x for x in _named(short) if x[0] in personal.BASE] == _base(short)
    began = time.perf_counter()
    personal.spans_of(part * (500_000 // len(part)))
    assert time.perf_counter() - began < 20


def test_personal_data_of_rows(spark):
    rng = random.Random(2)
    some = ["ann@mail.org", "10.0.0.255", "4111 1111 1111 1111", "+1 (930) 555-2361", "x.1.2.3.4.5.6.7.8", "é@é.é", "+1 2 3"]
    rows = [(d, t and t + " " + " ".join(rng.choices(some, k=3)), *r) for d, t, *r in T.corpus()] + T.corpus()
    got = personal.summary(personal.find(T.frame(spark, rows)))
    want = Counter()
    for doc, text, *_ in rows:
        base = _base(text or "")
        counts = Counter(k for k, *_ in base)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        every = ",".join(f"{k}:{s}:{e}" for k, s, e in _named(text or ""))
        want[(doc, *[counts[k] for k in personal.BASE], T.sha(joined.encode()), every)] += 1
    columns = ("doc_id", *[f"n_{k}" for k in personal.BASE], "base_sha256", "spans")
    assert T.collected(got, *columns) == want
    assert personal.find(T.frame(spark, [])).count() == 0


def test_personal_data_of_test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.spans for r in personal.summary(personal.find(docs)).collect()}
    want = {r.doc_id: ",".join(f"{k}:{s}:{e}" for k, s, e in _base(r.text)) for r in docs.collect()}
    assert got == want and any(want.values())


def test_redaction(spark):
    rows = [(1, "to ann@mail.org, tel:0930-555-2361 é 10.0.0.1!", "en", "a"), (2, None, "en", "a")]
    got = {r.doc_id: r.text for r in personal.redact(personal.find(T.frame(spark, rows))).collect()}
    assert got == {1: "to [email], tel:[contact] é [ip]!", 2: ""}
