"""Token ids as wavelet matrices: one compressed file image per shard of documents.

A shard holds the ids of a range of documents in ascending doc_id order. Its wavelet matrix keeps
one bit-plane per id bit, highest first; each plane is followed by its ones moved behind its
zeros. With a directory of counts a plane answers rank and select, and from these follow the id
at a place, the number of times an id occurs in a range, and the place of its k-th occurrence.

File image, little endian: magic, then nine 64-bit integers (version, bits, tokens, documents, id
of the document end, sizes of the three sections, reserved), then the sections, each compressed by
zstandard: documents (ids, null flags, end offsets), zeros per plane with the rank directories,
planes.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugelake.llm import arrays
from gaugelake.llm.shared import Scratch, small_batches

_MAGIC = b"GLWAVE01"
_HEAD = struct.Struct("<9q")
_BLOCK = 512  # bits between entries of the rank directory
_END_ID = 2
_SHARD_BYTES = 16 * 1024 * 1024
_TEXT_BYTES = 3 * 1024 * 1024  # of a shard encoded at a time, in slices of a third
#: Offsets of this many shards (a few MB) may be broadcast; more are joined by a shuffle.
_BROADCAST_SHARDS = 200_000

_SHARD = "shard int, n_documents long, n_tokens long, image binary"
_TOKENS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class WaveletMatrix:
    """Rank and select over a sequence of unsigned integers."""

    def __init__(self, planes: list[np.ndarray], zeros: np.ndarray, ranks: list[np.ndarray], n: int):
        self.planes, self.zeros, self.ranks, self.n = planes, zeros, ranks, n
        self.bits = len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros, ranks = [], [], []
        ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for bit in range(bits - 1, -1, -1):
            plane = np.packbits(((ids >> bit) & 1).astype(np.uint8), bitorder="little")
            planes.append(plane)
            ranks.append(_directory(plane))
            ones = pa.Array.from_buffers(pa.bool_(), len(ids), [None, pa.py_buffer(plane)])
            held = pa.array(ids)
            first = np.asarray(held.filter(pc.invert(ones)))
            ids = np.concatenate([first, np.asarray(held.filter(ones))])
            zeros.append(len(first))
        return cls(planes, np.array(zeros, np.int64), ranks, len(ids))

    def decode(self) -> np.ndarray:
        """The whole sequence."""
        out = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for depth in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[depth], count=self.n, bitorder="little").view(bool)
            z = int(self.zeros[depth])
            above = np.empty_like(out)
            above[~ones] = out[:z]
            above[ones] = out[z:] | out.dtype.type(1 << (self.bits - 1 - depth))
            out = above
        return out

    def _rank1(self, depth: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // _BLOCK
        part = self.planes[depth][block * _BLOCK // 8 : (i + 7) // 8]
        count = int(self.ranks[depth][block]) + int(np.bitwise_count(part).sum(dtype=np.int64))
        if i % 8:
            count -= int(part[-1] >> (i % 8)).bit_count()
        return count

    def _select(self, depth: int, k: int, one: int) -> int:
        """Place of the k-th (from 0) bit of one kind in a plane."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._rank1(depth, mid + 1)
            if (ones if one else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for depth in range(self.bits):
            before = self._rank1(depth, i)
            one = self._rank1(depth, i + 1) - before
            value = value << 1 | one
            i = int(self.zeros[depth]) + before if one else i - before
        return value

    def _range(self, value: int, low: int, high: int) -> tuple[int, int]:
        if value >> self.bits:
            return 0, 0
        for depth in range(self.bits):
            a, b = self._rank1(depth, low), self._rank1(depth, high)
            if value >> (self.bits - 1 - depth) & 1:
                low, high = int(self.zeros[depth]) + a, int(self.zeros[depth]) + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, value: int, low: int = 0, high: int | None = None) -> int:
        """How often an id occurs at places low to high (exclusive)."""
        low, high = self._range(value, low, self.n if high is None else high)
        return high - low

    def occurrence(self, value: int, k: int) -> int:
        """Place of the k-th occurrence (from 0) of an id."""
        low, high = self._range(value, 0, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        at = low + k
        for depth in range(self.bits - 1, -1, -1):
            one = value >> (self.bits - 1 - depth) & 1
            at = self._select(depth, at - int(self.zeros[depth]) if one else at, one)
        return at


def _directory(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of a plane, and in all."""
    per_byte = np.bitwise_count(plane)
    short = -len(per_byte) % (_BLOCK // 8)
    per_block = np.pad(per_byte, (0, short)).reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(per_block)]).astype("<u4")


def write_image(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray, bits: int) -> bytes:
    """The file image of a shard."""
    matrix = WaveletMatrix.build(ids, bits)
    none = np.array([d is None for d in doc_ids], np.uint8)
    known = np.array([d or 0 for d in doc_ids], "<i8")
    pack = zstandard.ZstdCompressor(level=1).compress
    sections = [
        pack(known.tobytes() + none.tobytes() + ends.astype("<i8").tobytes()),
        pack(matrix.zeros.astype("<i8").tobytes() + b"".join(r.tobytes() for r in matrix.ranks)),
        pack(b"".join(p.tobytes() for p in matrix.planes)),
    ]
    head = _HEAD.pack(1, bits, len(ids), len(doc_ids), _END_ID, *map(len, sections), 0)
    return _MAGIC + head + b"".join(sections)


def read_image(image: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """The matrix, the doc_ids, and the place after each document's last id."""
    if image[: len(_MAGIC)] != _MAGIC:
        raise ValueError("not a wavelet file")
    _, bits, n, docs, _, *sizes, _ = _HEAD.unpack_from(image, len(_MAGIC))
    at, parts = len(_MAGIC) + _HEAD.size, []
    for size in sizes:
        parts.append(zstandard.ZstdDecompressor().decompress(image[at : at + size]))
        at += size
    known = np.frombuffer(parts[0], "<i8", docs).tolist()
    none = np.frombuffer(parts[0], np.uint8, docs, 8 * docs)
    ends = np.frombuffer(parts[0], "<i8", docs, 9 * docs)
    zeros = np.frombuffer(parts[1], "<i8", bits)
    wide, bytes_ = len(_directory(np.zeros(-(-n // 8), np.uint8))), -(-n // 8)
    ranks = np.frombuffer(parts[1], "<u4", bits * wide, 8 * bits).reshape(bits, wide)
    planes = np.frombuffer(parts[2], np.uint8).reshape(bits, bytes_)
    ids = [None if m else d for d, m in zip(known, none, strict=True)]
    return WaveletMatrix(list(planes), zeros, list(ranks), n), ids, ends


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes bytes as letters: printable ones as themselves, the others from code point 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Pieces:
    """Token ids of pieces of words, numbered as they come. Number 0 is the end of a document."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.ids, self.ends = array("I", [_END_ID]), array("q", [1])

    def add(self, piece: str, ids: list[int]) -> int:
        self.numbers[piece] = number = len(self.ends)
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        return number


def _gathered(values: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of values, one after the other, each given by its first place and its size."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(firsts - (ends - sizes), sizes) + np.arange(total)]


def _binary(edges: np.ndarray, raw: np.ndarray) -> pa.LargeBinaryArray:
    """The values that lie one behind the other between the edges."""
    buffers = [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(raw)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, buffers)


# Bytes of plain words: ASCII in lower case, and letters, digits and others apart.
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_LETTER, _DIGIT = 1, 2
_KINDS = np.zeros(256, np.uint8)
_KINDS[ord("a") : ord("z") + 1] = _KINDS[0x80:] = _LETTER
_KINDS[ord("0") : ord("9") + 1] = _DIGIT


class WordTokenizer:
    """Encodes texts with a word-level tokenizer of the library, each distinct piece of a word once.

    Words between ASCII white space are encoded on their own, as no token of such a tokenizer
    crosses white space. Words of ASCII and Latin-1 letters are put in lower case and cut into the
    tokenizer's pieces here, and every distinct piece is encoded by the library's model; all other
    words go through the whole library. Words and pieces are told apart by their bytes.
    """

    def __init__(self, path: str, pieces: Pieces | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.letters = _byte_letters()
        self.pieces = pieces or Pieces()

    @staticmethod
    def _plain(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which words, one behind the other in ``raw``, hold only ASCII and Latin-1 letters and no start of a special token."""
        odd = (raw < 0x21) | (raw == 0x7F) | (raw >= 0x80)
        lead = (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        odd[:-1][lead] = False
        odd[1:][lead] = False
        mark = (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
        odd[:-1] |= mark  # across two words it only costs a detour
        sums = np.concatenate([[0], np.cumsum(odd)])
        return sums[ends] == sums[np.concatenate([[0], ends[:-1]])]

    def _piece(self, piece: str) -> int:
        text = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return self.pieces.add(piece, [t.id for t in self.model.tokenize(text)])

    @staticmethod
    def _cut(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of plain words in lower case, and where the tokenizer's pieces start: a run of letters, a digit,
        a run of others, and before these an ending behind an apostrophe ('s 't 'm 'd 're 've 'll)."""
        low = _LOWER[raw]
        upper = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] < 0x9F)) + 1
        low[upper] += 0x20
        kind = _KINDS[low]
        first = kind == _DIGIT
        first[1:] |= kind[1:] != kind[:-1]
        first[starts] = True
        heads = np.flatnonzero(first & (low == ord("'")))
        if len(heads):
            # Behind the last byte stand two that end nothing; a start of a word ends the one before.
            after, begins = np.append(low, [0, 0]), np.zeros(len(low) + 2, bool)
            begins[starts] = begins[len(low) :] = True
            one, two = after[heads + 1], after[heads + 2]
            inside = ~begins[heads + 1]
            short = inside & np.isin(one, np.frombuffer(b"stmd", np.uint8))
            pair = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
            long = inside & ~begins[heads + 2] & pair
            first[heads[short | long] + 1] = False
            behind = np.concatenate([heads[short] + 2, heads[long] + 3])
            first[behind[behind < len(low)]] = True
        return low, np.flatnonzero(first)

    def _words(self, words: pa.Array, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words one behind the other, and the size of each."""
        numbers = self.pieces.numbers
        plain = self._plain(raw, ends)
        lengths = np.diff(ends, prepend=0)
        if not plain.all():
            raw, lengths = raw[np.repeat(plain, lengths)], lengths[plain]
        starts = np.cumsum(lengths) - lengths
        low, cuts = self._cut(raw, starts) if len(raw) else (raw, starts)
        coded = _binary(np.append(cuts, len(low)), low).dictionary_encode()
        held = coded.dictionary.cast(pa.large_string()).to_pylist()
        at = list(map(numbers.get, held))
        for i, number in enumerate(at):
            if number is None:
                at[i] = self._piece(held[i])
        of_plain = np.array(at, np.int64)[coded.indices.to_numpy()]
        places = np.searchsorted(cuts, np.append(starts, len(low)))
        text = words.cast(pa.large_string())
        others = text.filter(pa.array(~plain)).to_pylist()
        for word in set(others).difference(numbers):
            self.pieces.add(word, self.library.encode(word, add_special_tokens=False).ids)
        at = np.fromiter(map(numbers.__getitem__, others), np.int64, len(others))
        # Numbers of the pieces of all words: those of plain words, then a single one for each other word.
        every = np.concatenate([of_plain, at])
        firsts, sizes = np.empty(len(words), np.int64), np.ones(len(words), np.int64)
        firsts[~plain] = len(of_plain) + np.arange(len(at))
        if plain.any():
            firsts[plain], sizes[plain] = places[:-1], np.diff(places)
        every = _gathered(every, firsts, sizes)
        ids, stops = np.frombuffer(self.pieces.ids, np.uint32), np.frombuffer(self.pieces.ends, np.int64)
        widths = stops[every] - stops[every - 1]
        total = np.concatenate([[0], np.cumsum(widths)])
        word_ends = np.cumsum(sizes)
        return _gathered(ids, stops[every - 1], widths), total[word_ends] - total[word_ends - sizes]

    def encode(self, texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), each followed by the end id, and the place after each text's last id."""
        raw, off = arrays.text_buffer(texts)
        if len(off) < 2:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        starts, ends, bounds = arrays.word_bounds(raw, off) if len(raw) else (off[:0], off[:0], np.zeros(len(off), np.int64))
        lengths = ends - starts
        inside = ~arrays.SPACES[raw]
        edges = np.concatenate([[0], np.cumsum(lengths)])
        coded = _binary(edges, raw[inside]).dictionary_encode()
        distinct, of = coded.dictionary, coded.indices.to_numpy()
        data, places = arrays.text_buffer(distinct.cast(pa.large_string()))
        ids, sizes = self._words(distinct, data, places[1:]) if len(distinct) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        # One more word, the end of a document, stands behind the words of each.
        ids, sizes = np.append(ids, np.uint32(_END_ID)), np.append(sizes, 1)
        at = np.insert(of.astype(np.int32), bounds[1:], len(distinct))
        widths = sizes[at]
        stops = np.cumsum(widths)
        return _gathered(ids, (np.cumsum(sizes) - sizes)[at], widths), stops[bounds[1:] + np.arange(len(bounds) - 1)]


#: Pieces a Python worker keeps from shard to shard; beyond this many it starts anew.
_KEPT_PIECES = 500_000
_pieces: dict[str, Pieces] = {}


def _tokenizer(path: str) -> WordTokenizer:
    kept = _pieces.get(path)
    if kept is None or len(kept.numbers) > _KEPT_PIECES:
        kept = _pieces[path] = Pieces()
    return WordTokenizer(path, kept)


def _gathered_texts(batches) -> Iterator[pa.Table]:
    """The rows of a shard, so many at a time that words repeat, however small the batches are."""
    held, size = [], 0
    for piece in arrays.pieces(batches, _TEXT_BYTES // 3):
        held.append(piece)
        size += int(arrays.text_buffer(piece.column("text"))[1][-1])
        if size >= _TEXT_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _shards(path: str, bits: int):
    def rows(batches):
        kind = np.uint16 if bits <= 16 else np.uint32
        doc_ids, encoded, ends, total, tokenizer, shard = [], [], [], 0, None, None
        for texts in _gathered_texts(batches):
            shard = texts.column("shard")[0].as_py() if shard is None else shard
            tokenizer = tokenizer or _tokenizer(path)
            ids, stops = tokenizer.encode(texts.column("text"))
            doc_ids += texts.column("doc_id").to_pylist()
            encoded.append(ids.astype(kind))
            ends.append(stops + total)
            total += len(ids)
            del texts, ids, stops  # not held while the matrix is built
        if doc_ids:
            ids = np.concatenate(encoded)
            encoded.clear()
            pa.default_memory_pool().release_unused()
            image = write_image(ids, doc_ids, np.concatenate(ends), bits)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([len(doc_ids)], pa.int64()),
                    pa.array([total], pa.int64()),
                    pa.array([image], pa.binary()),
                ],
                names=["shard", "n_documents", "n_tokens", "image"],
            )

    return rows


def write_shards(docs: DataFrame, tokenizer_path: str, folder: str, bits: int = 16) -> DataFrame:
    """Encodes ``docs`` (columns doc_id and text; others are ignored) and writes one file image per shard.

    Returns the table read back: shard, n_documents, n_tokens, image, first (ids of all shards
    before it). Documents follow each other by ascending doc_id, rows without one first, rows of
    one doc_id by the first 64 characters of the text, then in an order of its hash; a null text is empty and has the end id only; an empty table gives no shard.
    ``tokenizer_path`` names a file of the tokenizers library that every executor has; ids must
    fit in ``bits`` bits, and no token may cross white space.
    """
    spark = small_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // _SHARD_BYTES))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        # The text keeps rows of one doc_id, or without any, out of one shard.
        .repartitionByRange(n, "doc_id", F.substring("text", 1, 64), F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.substring("text", 1, 64), F.xxhash64("text"), "text")
        .select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    )
    written = ordered.mapInArrow(_shards(tokenizer_path, bits), _SHARD)
    written.write.option("compression", "none").parquet(folder)
    return read_shards(spark, folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards of a folder, each with the number of ids before it."""
    shards = spark.read.schema(_SHARD).parquet(folder)
    sizes = shards.select("shard", "n_tokens")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))
    if sizes.count() <= _BROADCAST_SHARDS:
        firsts = F.broadcast(firsts)
    return shards.join(firsts, "shard")


def _documents(batches):
    for batch in batches:
        for image, first in zip(batch.column("image").to_pylist(), batch.column("first").to_pylist(), strict=True):
            matrix, doc_ids, ends = read_image(image)
            raw = memoryview(matrix.decode().astype("<u4"))
            starts = np.concatenate([[0], ends[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts + first, pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def token_documents(shards: DataFrame) -> DataFrame:
    """Per document of the shards: doc_id, start, n_tokens, ids_crc32, all read from the file images."""
    return shards.select("image", "first").mapInArrow(_documents, _TOKENS)


def pack_documents(docs: DataFrame, tokenizer_path: str, bits: int = 16) -> DataFrame:
    """Writes the shards to a fresh folder that the cluster shares, and reads the documents back."""
    scratch = Scratch(docs.sparkSession, "wavelet")
    return token_documents(write_shards(docs, tokenizer_path, f"{scratch.path}/shards", bits))
