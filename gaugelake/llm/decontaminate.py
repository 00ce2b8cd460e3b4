"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Every n-gram of the test items is a seed, however common it is: which of them an edit has left whole
cannot be told beforehand. Passages that share a seed with an item, and enough words for the least
score, are aligned with it word by word; the score is the share of the best possible local alignment, so edited and paraphrased copies
score by what is left of them. A copy without three words in a row as in the item has no seed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugelake.llm import arrays

_NGRAM = 3
_PIECE = 64  # words of an item aligned at once; longer items are cut into pieces that overlap by half
_LEAST = 8  # words that have to agree, all of them in a shorter item
_MATCH, _MISMATCH, _GAP = 2, -1, -1
#: Words of test items held by a task at once; a larger benchmark is taken in so many passes.
_SLICE_WORDS = 500_000
#: Pairs of seed and place held at once; texts with more are taken in halves.
_HELD_PAIRS = 1_000_000

_FOUND = "doc_id long, item_id long, score double, n_matched long, first_word long, end_word long"


class Items:
    """Pieces of test items, small enough for every task to hold."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.pieces: list[tuple[int | None, np.ndarray]] = []
        hashes, bounds = arrays.word_hashes(pa.array([t for _, t in rows], pa.string()), lower=True)
        for (item, _), a, b in zip(rows, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            for lo in range(a, max(a + 1, b - _PIECE // 2), _PIECE // 2):
                if lo < b:
                    self.pieces.append((item, hashes[lo : min(b, lo + _PIECE)]))
        grams = [arrays.window_hashes(words, min(_NGRAM, len(words))) for _, words in self.pieces]
        seeds = np.concatenate([np.zeros(0, np.uint64), *grams])
        order = np.argsort(seeds, kind="stable")
        self.seeds = seeds[order]
        self.piece = np.repeat(np.arange(len(grams)), np.array([len(g) for g in grams], np.int64))[order]
        self.at = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)])[order]


def _all_grams(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that lie in one text, and their first words."""
    grams = arrays.window_hashes(hashes, width)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(text[: len(grams)] == text[width - 1 :]) if len(grams) else np.zeros(0, np.int64)
    return grams[at], at


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are among the sorted ones; a table of hash bits rules most out before the search."""
    table = np.zeros(1 << 20, bool)
    shift = np.uint64(44)
    table[(sorted_keys >> shift).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(keys >> shift).astype(np.int64)])
    at = np.searchsorted(sorted_keys, keys[maybe])
    at[at == len(sorted_keys)] = 0
    return maybe[sorted_keys[at] == keys[maybe]] if len(sorted_keys) else maybe[:0]


def _widths(items: Items) -> list[int]:
    return sorted({min(_NGRAM, len(words)) for _, words in items.pieces})


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int, int]:
    """Smith-Waterman of two word sequences: score, agreeing words, first word and word after the last.

    One row of the table per item word; gaps along a row are settled by a running maximum.
    """
    n = len(words)
    score, agree, begin = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64), np.arange(n + 1)
    place = np.arange(n + 1)
    best = (0, 0, 0, 0)
    for w in item:
        same = words == w
        diagonal = score[:-1] + np.where(same, _MATCH, _MISMATCH)
        above = score[1:] + _GAP
        up = above > diagonal
        row, row_agree, row_begin = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64), place.copy()
        cell = np.maximum(np.maximum(diagonal, above), 0)
        row[1:] = cell
        on = cell > 0
        row_agree[1:] = np.where(on, np.where(up, agree[1:], agree[:-1] + same), 0)
        row_begin[1:] = np.where(on, np.where(up, begin[1:], begin[:-1]), place[1:])
        lifted = row - _GAP * place  # a gap of any length costs the same as running down a slope
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, place, 0))
        better = top + _GAP * place > row
        score = np.where(better, top + _GAP * place, row)
        agree = np.where(better, row_agree[source], row_agree)
        begin = np.where(better, row_begin[source], row_begin)
        k = int(np.argmax(score))
        if score[k] > best[0]:
            best = (int(score[k]), int(agree[k]), int(begin[k]), k)
    return best


def _common(item: np.ndarray, words: np.ndarray) -> int:
    """How many words the two have in common, a repeated word as often as it stands in both."""
    own, counts = np.unique(item, return_counts=True)
    at = np.minimum(np.searchsorted(own, words), len(own) - 1)
    return int(np.minimum(np.bincount(at[own[at] == words], minlength=len(own)), counts).sum())


def _matches(items: Items, least_score: float, texts: pa.Array) -> list[tuple[int, int, float, int, int, int]]:
    """(text, piece, score, agreeing words, first word, end word) of every contaminated passage's best alignment."""
    hashes, bounds = arrays.word_hashes(texts, lower=True)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    keys, places = [], []
    for width in _widths(items):
        grams, at = _all_grams(hashes, bounds, width)
        hit = _find(items.seeds, grams)
        keys.append(grams[hit])
        places.append(at[hit])
    if not keys:
        return []
    keys, places = np.concatenate(keys), np.concatenate(places)
    if not len(keys):
        return []
    low, high = np.searchsorted(items.seeds, keys, "left"), np.searchsorted(items.seeds, keys, "right")
    many = high - low
    if many.sum() > _HELD_PAIRS and len(texts) > 1:
        half = len(texts) // 2
        rest = _matches(items, least_score, texts[half:])
        return _matches(items, least_score, texts[:half]) + [(half + t, *found) for t, *found in rest]
    entry = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
    place = np.repeat(places, many)
    piece = items.piece[entry]
    offset = place - items.at[entry]  # where the piece would begin
    order = np.lexsort((offset, piece, text[place]))
    doc, piece, offset = text[place][order], piece[order], offset[order]
    lengths = np.array([len(w) for _, w in items.pieces], np.int64)
    new = np.ones(len(order), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1]) | (np.diff(offset) > np.maximum(4, lengths[piece[1:]] // 2))
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(order))
    out = []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        words = items.pieces[piece[a]][1]
        n = len(words)
        lo = max(int(bounds[doc[a]]), int(offset[a]) - n // 2)
        hi = min(int(bounds[doc[a] + 1]), int(offset[b - 1]) + n + n // 2)
        most = _common(words, hashes[lo:hi])  # words can agree; no alignment scores more than _MATCH for each
        if most / n < least_score or most < min(_LEAST, n):
            continue
        score, agree, first, end = align(words, hashes[lo:hi])
        share = score / (_MATCH * n)
        if share >= least_score and agree >= min(_LEAST, n):
            base = lo - int(bounds[doc[a]])
            out.append((int(doc[a]), int(piece[a]), share, agree, base + first, base + end))
    return out


def _slices(benchmark: DataFrame):
    """The test items in slices of bounded size."""
    rows, words = [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        rows.append((r[0], r[1]))
        words += len((r[1] or "").split())
        if words >= _SLICE_WORDS:
            yield rows
            rows, words = [], 0
    if rows:
        yield rows


def contaminated(docs: DataFrame, benchmark: DataFrame, least_score: float = 0.4) -> DataFrame:
    """The best alignment of each (document, test item) that scores ``least_score`` or more.

    Columns doc_id, item_id, score (0 to 1), n_matched (agreeing words), first_word, end_word (place
    in the document's words). ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other
    columns are ignored. Null, empty and wordless texts match nothing; items of fewer than eight
    words have to occur whole. Rows that share a doc_id, or have none, share one result per item;
    empty tables give no row. Items longer than 64 words are judged by pieces of 64.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.sparkSession.createDataFrame([], _FOUND)
    for rows in _slices(benchmark):
        items = Items(rows)

        def matched(batches, items=items):
            for batch in arrays.pieces(batches):
                hits = _matches(items, least_score, batch.column("text"))
                ids = batch.column("doc_id").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[h[0]] for h in hits], pa.int64()),
                        pa.array([items.pieces[h[1]][0] for h in hits], pa.int64()),
                        pa.array([h[2] for h in hits], pa.float64()),
                        *(pa.array([h[i] for h in hits], pa.int64()) for i in (3, 4, 5)),
                    ],
                    names=["doc_id", "item_id", "score", "n_matched", "first_word", "end_word"],
                )

        found = found.unionByName(docs.mapInArrow(matched, _FOUND))
    fields = ["score", "n_matched", "first_word", "end_word"]
    best = F.max_by(F.struct(*fields), F.struct("score", "n_matched", -F.col("first_word"), -F.col("end_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least_score: float = 0.4) -> DataFrame:
    """``docs`` without the rows that hold a test item; all columns stay, nothing is shuffled."""
    for rows in _slices(benchmark):
        items = Items(rows)

        def clean(batches, items=items):
            for batch in arrays.pieces(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[[h[0] for h in _matches(items, least_score, batch.column("text"))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
