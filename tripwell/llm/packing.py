"""Packing documents into fixed-length sequences along a space-filling curve.

1. Every text becomes token ids, closed by an end id. The ids it holds, hashed into
   buckets, form a vector of presences, which fixed random rows project to three
   dimensions. The cell of that point on a Hilbert curve is the document's key.
   Ids and keys are stored once, so the sort below never repeats the tokenizer.
2. The rows are dealt by ranges of (key, id) and sorted. Ties of the key, such as
   copies, are split by the id.
3. Each range lays its documents end to end and cuts every 2048 ids. What is left
   at the end of a range is cut at powers of two, so no sequence needs padding.

Ranges are independent: a lost task packs its own range again. Null texts hold only
the end id. Nothing but range bounds reaches the driver.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tripwell.llm.batches import handing_back
from tripwell.sources.storage import store

LENGTH = 2048
END_ID = 1
DIMENSIONS, BITS, BUCKETS = 3, 16, 4096
CACHED_WORDS, CACHED_CHARS = 500_000, 60
BATCH_CHARS = 1_500_000

# A run of Latin letters or of marks with a certain end, or else the rest of the word.
_PIECE = re.compile("[a-zß-öø-ÿ]++(?![^\\x00-\\x7f])|[!-&(-/:-@\\[-`{-~]++(?![^\\x00-\\x7f]|['\\x00-\\x08\\x0e-\\x1f\\x7f])"
                    "|[^ \\t\\n\\r\\x0b\\x0c]+")
_SIMPLE = re.compile("[a-zß-öø-ÿ]+|[!-&(-/:-@\\[-`{-~]+")
_WORD = re.compile("[^ \\t\\n\\r\\x0b\\x0c]+")
_tokenizers: dict[str, "WordTokenizer"] = {}


class WordTokenizer:
    """The ids of a vocabulary file whose words end at white space and between letters and marks.

    Texts are cut into lower-case pieces, and the ids of each different piece are
    computed once and kept in two generations: when the newer one is full it replaces
    the older one, from which pieces that are met again return. Runs of Latin letters or of marks whose end is certain are pieces;
    whatever else a word holds (digits, apostrophes, other scripts) goes to the
    tokenizer as it is, and so does a whole text that holds a special id's string.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.closes = np.zeros(self.size, bool)
        self.closes[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        """The pieces of this generation become the old one, and the old one goes."""
        self.now, self.before = {}, getattr(self, "now", {})

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, self.dtype)

    def _learn(self, pieces: list[str]) -> None:
        width = self.dtype.itemsize
        simple = [p for p in pieces if _SIMPLE.fullmatch(p)]
        for at in range(0, len(simple), 5000):
            some = simple[at:at + 5000]
            found = self._encode(" ".join(some))
            ends = np.flatnonzero(self.closes[found]) + 1
            if len(ends) != len(some) or ends[-1] != len(found):
                parts = [self._encode(p) for p in some]
                found, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
            packed, cuts = found.tobytes(), [0, *(ends * width).tolist()]
            self.now.update(zip(some, map(packed.__getitem__, map(slice, cuts, cuts[1:]))))
        for p in set(pieces).difference(simple):
            self.now[p] = self._encode(p).tobytes()

    def _pieces(self, text: str) -> list[str]:
        if any(s in text for s in self.special):
            return _WORD.findall(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            found = []
            for word in _WORD.findall(text):
                found += self._pieces(word) if max(word) < "\u0100" else [word]
            return found
        return _PIECE.findall(text.lower())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, without special ids."""
        if len(self.now) > CACHED_WORDS:
            self.forget()
        words = [self._pieces(t) for t in texts]
        missing = []
        for p in set(chain.from_iterable(words)).difference(self.now):
            known = self.before.get(p)
            if known is None:
                missing.append(p)
            else:
                self.now[p] = known
        self._learn(missing)
        found = [np.frombuffer(b"".join(map(self.now.__getitem__, w)), self.dtype) for w in words]
        for p in missing:
            if len(p) > CACHED_CHARS:
                del self.now[p]
        return found


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows), each coordinate of ``bits`` bits.

    The coordinates are turned into the transposed index by undoing, bit plane by
    bit plane, the swaps and inversions of the curve, then Gray-decoded.
    """
    x = [c.astype(np.uint64) for c in np.asarray(points).T]
    n = len(x)
    bit = np.uint64(1 << (bits - 1))
    while bit > 1:
        low = bit - np.uint64(1)
        for i in range(n):
            on = (x[i] & bit) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        bit >>= np.uint64(1)
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    bit = np.uint64(1 << (bits - 1))
    while bit > 1:
        flip = np.where((x[-1] & bit) != 0, flip ^ (bit - np.uint64(1)), flip)
        bit >>= np.uint64(1)
    x = [c ^ flip for c in x]
    key = np.zeros_like(x[0])
    for plane in range(bits - 1, -1, -1):
        for c in x:
            key = (key << np.uint64(1)) | ((c >> np.uint64(plane)) & np.uint64(1))
    return key.astype(np.int64)


@functools.cache
def _projection() -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every id below 65536, and the random rows of the buckets."""
    return _bucket(np.arange(1 << 16)), np.random.default_rng(20).standard_normal((BUCKETS, DIMENSIONS))


def _bucket(ids: np.ndarray) -> np.ndarray:
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(BUCKETS)).astype(np.int64)


def curve_keys(documents: list[np.ndarray]) -> np.ndarray:
    """Hilbert key of every document's hashed and projected vector of token presences."""
    buckets, rows = _projection()
    points = np.zeros((len(documents), DIMENSIONS))
    for i, ids in enumerate(documents):
        present = np.zeros(BUCKETS, bool)
        present[buckets[ids] if ids.itemsize == 2 else _bucket(ids)] = True
        held = np.flatnonzero(present)
        points[i] = rows[held].sum(axis=0) / np.sqrt(max(1, len(held)))
    cells = (np.tanh(points / 2) + 1) / 2 * ((1 << BITS) - 1)
    return hilbert_index(cells.astype(np.int64), BITS)


def tokenized(docs: DataFrame, vocabulary: str, text: str = "text", id_column: str = "doc_id",
              end_id: int = END_ID) -> DataFrame:
    """(doc_id, key, ids): ids closed by ``end_id``, compressed; see :func:`read_ids`."""
    picked = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text].alias("text"))

    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        model, squeeze = tokenizer(vocabulary), zstandard.ZstdCompressor(1).compress
        for batch in batches:
            texts, doc_ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            at = 0
            while at < len(texts):
                stop, chars = at, 0
                while stop < len(texts) and (chars == 0 or chars + len(texts[stop] or "") <= BATCH_CHARS):
                    chars += len(texts[stop] or "") + 1
                    stop += 1
                ids = [np.append(i, np.array([end_id], i.dtype)) for i in model.encode([t or "" for t in texts[at:stop]])]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids[at:stop], pa.int64()), "key": curve_keys(ids),
                    "ids": pa.array([squeeze(i.astype("<u4" if i.itemsize == 4 else "<u2").tobytes()) for i in ids], pa.binary()),
                    "width": pa.array([i.itemsize for i in ids], pa.int32())})
                at = stop

    return picked.mapInArrow(run, "doc_id long, key long, ids binary, width int")


def read_ids(squeezed: bytes, width: int) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(squeezed), f"<u{width}").astype("<u4")


class _Sequences:
    """Cuts one range of documents into sequences; holds at most one open sequence."""

    def __init__(self, first: int, length: int):
        self.next, self.length, self.open, self.fill = first, length, [], 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.length - self.fill)
            self.open.append((doc_id, at, ids[at:at + n], len(ids)))
            self.fill += n
            at += n
            if self.fill == self.length:
                self.flush(self.length)

    def flush(self, size: int) -> None:
        """Emit the first ``size`` open ids as one sequence."""
        offset, rest = 0, []
        for doc_id, start, ids, total in self.open:
            n = min(len(ids), size - offset)
            if n:
                piece = ids[:n]
                self.rows.append((doc_id, start, n, zlib.crc32(piece.tobytes()), total, self.next, offset, piece))
                offset += n
            if n < len(ids):
                rest.append((doc_id, start + n, ids[n:], total))
        self.open, self.fill, self.next = rest, self.fill - size, self.next + 1

    def close(self) -> None:
        while self.fill:
            self.flush(1 << (self.fill.bit_length() - 1))

    def take(self, with_ids: bool) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * 8
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        made = {n: pa.array(c, pa.int64()) for n, c in zip(names, columns)}
        if with_ids:
            cuts = np.cumsum([0, *map(len, columns[7])], dtype=np.int32)
            values = np.concatenate([np.zeros(0, np.int32), *columns[7]]).astype(np.int32)
            made["ids"] = pa.ListArray.from_arrays(pa.array(cuts), pa.array(values))
        self.rows = []
        return pa.RecordBatch.from_pydict(made)


def pack(docs: DataFrame, vocabulary: str, text: str = "text", id_column: str = "doc_id", length: int = LENGTH,
         end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, ids.

    ``length`` must be a power of two. Every id of every document lies in one piece.
    """
    rows = store(tokenized(docs, vocabulary, text, id_column, end_id), "tokens")

    @handing_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _Sequences(TaskContext.get().partitionId() << 36, length)
        for batch in batches:
            for doc_id, ids, width in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "width"))):
                made.add(doc_id, read_ids(ids, width))
                if len(made.rows) >= 2000:
                    yield made.take(with_ids)
        made.close()
        yield made.take(with_ids)

    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + ", ids array<int>" * with_ids)
    return rows.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id").mapInArrow(run, schema)
