"""Offset-preserving encoding with SentencePiece models, and decoding.

1. The normaliser walks the text once. At every place the longest rule of the model's
   compiled character map that is a prefix of the rest replaces what it matches; other
   characters stay. For every byte of the result it records where in the original the
   matched span began. Spaces become the model's visible space, with a leading one.
   Characters that begin no rule are copied in runs.
2. The normalised text is cut where no piece of the vocabulary can span: before a run
   of visible spaces that follows another character. The ids of each different cut are
   found once, by the model's own merges, and kept in two generations, so that
   frequent ones stay when rare ones are dropped.
3. The lengths of the pieces, laid along the recorded alignment, project every piece to
   its span of bytes in the original text. The bytes of a character that has no piece
   are byte pieces: the last carries the character's span, the others an empty one.

Decoding joins the pieces' texts; runs of byte pieces are read as UTF-8, each wrong
byte giving U+FFFD. Null texts are empty, and an empty text has the end id alone, with
an empty span at the end. Rows are independent, so repeated rows and ids, ties and
columns of any other name change nothing. A text of any length is encoded whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwell.llm.batches import hand_back, slices

SPACE = "▁"
KEPT, KEPT_CHARS = 150_000, 40
_encoders: dict[str, "PieceEncoder"] = {}


class CharacterMap:
    """Rules of a compiled character map: the size of a double-array trie, the trie, the replacements.

    A unit of the trie holds a label in its low byte, a flag for a value below it in
    bit 8, and an offset to its children in the upper bits, scaled by bit 9. A unit with
    the top bit set is a value: the place of the replacement, which ends at a zero byte.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if compiled else []
        self.texts = compiled[4 + size:]

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest rule that ``text`` holds at ``at``."""
        units, found = self.units, None
        if not units:
            return None
        place = self._children(units[0])
        for i in range(at, len(text)):
            place ^= text[i]
            if place >= len(units) or (units[place] & 0x800000FF) != text[i]:
                break
            unit = units[place]
            place ^= self._children(unit)
            if unit >> 8 & 1:
                start = units[place] & 0x7FFFFFFF
                found = i + 1 - at, self.texts[start:self.texts.index(0, start)]
        return found

    def first_bytes(self) -> bytes:
        """Bytes that begin a rule."""
        if not self.units:
            return b""
        root = self._children(self.units[0])
        return bytes(b for b in range(256)
                     if (root ^ b) < len(self.units) and (self.units[root ^ b] & 0x800000FF) == b and b)


class Normaliser:
    """The text a model sees, and for each of its bytes the original place it comes from."""

    def __init__(self, spec, user_pieces: list[bytes], as_suffix: bool):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.trim, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.as_suffix = as_suffix
        self.user = re.compile(b"|".join(map(re.escape, sorted(user_pieces, key=len, reverse=True)))) if user_pieces else None
        starts = set(self.map.first_bytes()) | {p[0] for p in user_pieces} | ({32} if self.trim else set())
        self.special = re.compile(b"[" + re.escape(bytes(sorted(starts))) + b"]") if starts else None
        self.space = SPACE.encode() if self.escape else b" "

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        raw = text.encode()
        out, places = self._plain(raw) if self.special is None else self._walked(raw)
        if not out:
            return b"", np.zeros(1, np.int64)
        widths = np.ones(len(out), np.int64)
        if self.escape:
            widths[np.frombuffer(out, np.uint8) == 32] = 3
            out = out.replace(b" ", self.space)
        first, end = int(places[0]) if len(out) else 0, int(places[-1])
        places = np.append(np.repeat(places[:-1], widths), end)
        mark = len(self.space)
        if self.prefix and not self.as_suffix:
            out, places = self.space + out, np.concatenate([np.full(mark, first), places])
        if self.trim:
            kept = len(out)
            while out.endswith(self.space, 0, kept):
                kept -= mark
            out, places = out[:kept], places[:kept + 1]
        if self.prefix and self.as_suffix:
            out, places = out + self.space, np.concatenate([places, np.full(mark, places[-1])])
        return out, places

    def _plain(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        return raw, np.arange(len(raw) + 1)

    def _walked(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """Rules applied from left to right; the places have one entry more, the end of what was read."""
        parts, places = [], []
        at, after_space = 0, self.trim
        while at < len(raw):
            hit = self.special.search(raw, at)
            stop = hit.start() if hit else len(raw)
            if stop > at:
                parts.append(raw[at:stop])
                places.append(np.arange(at, stop))
                after_space, at = False, stop
                continue
            length, new = self._prefix_at(raw, at)
            if after_space:
                new = new.lstrip(b" ")
            if new:
                parts.append(new)
                places.append(np.full(len(new), at))
                after_space = self.trim and new.endswith(b" ")
            at += length
        return b"".join(parts), np.concatenate([*places, [at]]).astype(np.int64)

    def _prefix_at(self, raw: bytes, at: int) -> tuple[int, bytes]:
        if self.user and (hit := self.user.match(raw, at)):
            return len(hit.group()), hit.group()
        if found := self.map.longest(raw, at):
            return found
        lead = raw[at]
        length = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return length, raw[at:at + length]


class PieceEncoder:
    """Ids, spans and decoded text of a model file."""

    def __init__(self, model: str | bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model if isinstance(model, bytes) else open(model, "rb").read())
        kind = type(proto.pieces[0])
        self.as_suffix = proto.trainer_spec.treat_whitespace_as_suffix
        users = [p.piece.encode() for p in proto.pieces if p.type == kind.USER_DEFINED]
        self.normaliser = Normaliser(proto.normalizer_spec, users, self.as_suffix)
        self.end_id = next((i for i, p in enumerate(proto.pieces) if p.piece == proto.trainer_spec.eos_piece), None)
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN)
        self.unknown_text = proto.trainer_spec.unk_surface.encode()
        self.strips = proto.normalizer_spec.add_dummy_prefix or proto.normalizer_spec.remove_extra_whitespaces
        self.strips_all = proto.normalizer_spec.remove_extra_whitespaces
        self.texts: list[bytes] = []
        self.is_byte = np.zeros(len(proto.pieces), bool)
        for i, p in enumerate(proto.pieces):
            if p.type == kind.BYTE:
                self.is_byte[i] = True
                self.texts.append(bytes([int(p.piece[3:5], 16)]))
            else:
                self.texts.append(b"" if p.type == kind.CONTROL else p.piece.encode())
        self.lengths = np.array(list(map(len, self.texts)))
        inside = any(SPACE in p.piece.lstrip(SPACE) for p in proto.pieces)
        self.cut = None if inside or users or self.as_suffix else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        # Merges work on the normalised text, so the copy of the model that makes them must leave it as it is.
        proto.normalizer_spec.precompiled_charsmap = b""
        for flag in ("add_dummy_prefix", "remove_extra_whitespaces", "escape_whitespaces"):
            setattr(proto.normalizer_spec, flag, False)
        self.merges = SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.now: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _merged(self, parts: list[str]) -> list[bytes]:
        return [array("i", ids).tobytes() for ids in self.merges.encode(parts, num_threads=1)]

    def ids(self, normalised: list[str]) -> list[np.ndarray]:
        if self.cut is None:
            return [np.frombuffer(x, np.int32) for x in self._merged(normalised)]
        if len(self.now) > KEPT:
            self.now, self.before = {}, self.now
        cuts = [self.cut.findall(t) for t in normalised]
        wanted = {c for cut in cuts for c in cut}.difference(self.now)
        missing = []
        for c in wanted:
            if (known := self.before.get(c)) is not None:
                self.now[c] = known
            else:
                missing.append(c)
        for at in range(0, len(missing), 5000):
            self.now.update(zip(missing[at:at + 5000], self._merged(missing[at:at + 5000])))
        found = [np.frombuffer(b"".join(map(self.now.__getitem__, cut)), np.int32) for cut in cuts]
        for c in missing:
            if len(c) > KEPT_CHARS:
                del self.now[c]
        return found

    def _widths(self, ids: np.ndarray, normalised: bytes) -> np.ndarray:
        """Bytes of the normalised text under each piece."""
        widths = self.lengths[ids]
        if (ids == self.unknown).any():
            # An unknown run ends where the next known piece begins, whose characters it can't hold.
            at = 0
            for i, piece in enumerate(ids.tolist()):
                if piece == self.unknown:
                    after = self.texts[ids[i + 1]] if i + 1 < len(ids) else b""
                    widths[i] = (normalised.find(after, at) if after else len(normalised)) - at
                at += int(widths[i])
        return widths

    def spans(self, ids: np.ndarray, normalised: bytes, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and the byte after the last, in the original, of every piece."""
        ends = np.cumsum(self._widths(ids, normalised))
        begin, end = places[np.concatenate([[0], ends[:-1]])] if len(ids) else ends, places[ends]
        lone = self.is_byte[ids]
        if lone.any():
            # Places inside a character name its first byte; byte pieces but the last have empty spans.
            lead = np.frombuffer(normalised, np.uint8)
            follows = np.append(lead, 0)[np.minimum(ends, len(lead))] & 0xC0 == 0x80
            first = places[np.maximum.accumulate(np.where(lead & 0xC0 != 0x80, np.arange(len(lead)), 0))] if len(lead) else lead
            begin = np.where(lone, first[np.minimum(ends - 1, len(lead) - 1)], begin)
            end = np.where(lone & follows, begin, end)
        return begin, end

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids with the end id, and the first and last byte of every piece in the original text."""
        normal = [self.normaliser.normalise(t) for t in texts]
        found = self.ids([n.decode() for n, _ in normal])
        made = []
        for t, (n, places), ids in zip(texts, normal, found):
            begin, end = self.spans(ids, n, places)
            last = [len(t.encode())]
            made.append((np.append(ids, np.int32(self.end_id)), np.append(begin, last), np.append(end, last)))
        return made

    def decode(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        known = self.is_byte[ids]
        edges = np.flatnonzero(np.diff(known, prepend=False, append=False)).tolist()
        out, at, begun = [], 0, False
        for a, b in [*zip(edges[::2], edges[1::2]), (len(ids), len(ids))]:
            texts = list(map(self.texts.__getitem__, ids[at:a].tolist()))
            if not begun and self.strips:
                for i, t in enumerate(texts):
                    if t:
                        texts[i] = t.removeprefix(SPACE.encode()) if ids[at + i] != self.unknown else t
                        if not (self.strips_all and t != texts[i] and not texts[i]):
                            begun = True
                            break
            if (ids[at:a] == self.unknown).any():
                texts = [self.unknown_text if j == self.unknown else t for j, t in zip(ids[at:a].tolist(), texts)]
            out.append(b"".join(texts).replace(SPACE.encode(), b" "))
            if b > a:
                begun = True
                out.append(_readable(b"".join(map(self.texts.__getitem__, ids[a:b].tolist()))))
            at = b
        return b"".join(out).decode()


def _readable(data: bytes) -> bytes:
    """Bytes as UTF-8, with U+FFFD for each byte that belongs to no character."""
    try:
        data.decode()
        return data
    except UnicodeDecodeError:
        return data.decode("utf-8", "surrogateescape").encode("utf-16", "surrogatepass").decode(
            "utf-16", "surrogatepass").translate({0xDC80 + i: 0xFFFD for i in range(128)}).encode()


def encoder(model: str) -> PieceEncoder:
    if model not in _encoders:
        _encoders[model] = PieceEncoder(model)
    return _encoders[model]


def encode(docs: DataFrame, model: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, ids, begins, ends, decoded): ids closed by the end id, their byte spans, and the text they decode to."""
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(model)
        for doc_ids, texts in slices(batches, "doc_id", "text"):
            found = made.encode([t or "" for t in texts])
            cuts = pa.array(np.cumsum([0, *(len(f[0]) for f in found)]), pa.int32())
            flat = (pa.array(np.concatenate(column).astype(np.int32)) for column in zip(*found))
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(doc_ids, pa.int64()),
                **{name: pa.ListArray.from_arrays(cuts, f) for name, f in zip(("ids", "begins", "ends"), flat)},
                "decoded": pa.array([made.decode(f[0]) for f in found], pa.string())})
        hand_back()

    return picked.mapInArrow(run, "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string")
