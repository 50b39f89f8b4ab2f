"""Token-id output: an adaptive context-mixing range coder in checksummed blocks.

A block is up to `BLOCK_IDS` ids (a longer document has a block of its own).
It is coded by itself: its model begins empty and its checksums cover it alone.
The ids are cut into lanes, each a run of neighbours with a coder state of its
own; all lanes share the block's model and move together, one id a step, so
numpy codes a whole step at once.  A step predicts with what all earlier steps
taught:

* order 2: the id last seen after the two ids before, and how sure it is;
* order 1: the same after one id;
* order 0: how often each id had to be written out.

How far the first two are to be trusted is learnt for every pair of their
confidences, which mixes the three into one distribution: first candidate,
second candidate, or the order-0 distribution.  Arithmetic coding is carry-free
with 16-bit output words and 64-bit states, which take both choices of a step
before they are looked at for words to put out.

Files are Parquet tables of blocks, ordered by (part, block): the documents of a
block, their lengths, and the frame, which holds the counts, the checksums of
ids and payload, and the payload.

Documents are ordered by id (missing first), then by a hash of the text; a null
text is an empty one, and repeated rows are repeated documents.  An empty table
gives no files and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lociflow.llm.common import batches, column, written

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
BLOCK_IDS = 1 << 20
#: Text that is cut into words at once.
SLICE_BYTES = 1 << 23
#: Lanes of a full block, and the fewest steps worth a lane.
LANES, LANE_IDS = 4096, 256
MAGIC = b"LCM2"
_HEAD = struct.Struct("<4sIIIII")  # magic, ids, lanes, id space, crc of the ids, crc of the payload

_TOP = np.uint64(1 << 48)
_BOTTOM = np.uint64(1 << 44)
_LOW48 = np.uint64((1 << 48) - 1)
_16, _48 = np.uint64(16), np.uint64(48)
_MIX_BITS = 12
_SLOTS, _GUIDE_BITS = 18, 12
#: From this sum on the counts of a block stay as they are, so ranges can always be divided by it.
_FULL = 1 << 30


class Model:
    """What a block has taught so far.

    A candidate and how sure it is share a number, and both orders a table: the
    second order's slots, then the ids.  Ids that were written out come first in
    the order-0 distribution, so that summing and searching the counts follows
    how many ids a block uses and not the id space.
    """

    def __init__(self, space: int) -> None:
        self.space = space
        self.known = np.zeros((1 << _SLOTS) + space + 1, np.int32)
        self.place, self.id_at = np.arange(space), np.arange(space)
        self.used = 0
        self.counts = np.ones(space, np.int64)
        # up to the end of the first place that isn't in use; all from there on are one wide
        self.cumulated = np.zeros(space + 2, np.uint64)
        self.cumulated[1] = 1
        self.total = np.uint64(space)
        self.guide: np.ndarray | None = None
        self.written: list[np.ndarray] = []
        self.trust = np.ones((32, 3), np.int64)
        self.steps = 0
        self._mixture()

    def _mixture(self) -> None:
        mix = 1 << _MIX_BITS
        share = self.trust * (mix - 3) // self.trust.sum(axis=1, keepdims=True) + 1
        share[:, 2] += mix - share.sum(axis=1)
        self.freq = share.astype(np.uint64)
        self.start = np.cumsum(self.freq, axis=1) - self.freq
        self.start1, self.start2 = self.start[:, 1].copy(), self.start[:, 2].copy()

    def _bring_forward(self, ids: np.ndarray) -> None:
        """Give ids (each once) that were not written out before the next places."""
        old, new = self.used, self.used + len(ids)
        left = self.place[ids]
        left = left[left >= new]
        self.place[ids] = -1
        moved = self.id_at[old:new]
        moved = moved[self.place[moved] >= 0]
        self.id_at[left], self.place[moved] = moved, left
        self.id_at[old:new], self.place[ids] = ids, np.arange(old, new)
        self.used = new

    def _count(self) -> None:
        ids = np.concatenate(self.written)
        self.written.clear()
        if self.total >= _FULL or not len(ids):
            return
        at = self.place.take(ids)
        if at.max() >= self.used:
            self._bring_forward(np.unique(ids[at >= self.used]))
            at = self.place.take(ids)
        n, c = self.used, self.cumulated
        self.counts[:n] += 32 * np.bincount(at, minlength=n)
        np.cumsum(self.counts[:n], out=c[1 : n + 1].view(np.int64))
        c[n + 1] = c[n] + np.uint64(1)
        self.total = c[n] + np.uint64(self.space - n)
        self.guide = None

    def stretch(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where places begin in the order-0 distribution, and how wide they are."""
        inside = np.minimum(place, self.used)
        start = self.cumulated.take(inside)
        width = self.cumulated.take(inside + 1) - start
        return start + (place - inside).view(np.uint64), width

    def find(self, mark: np.ndarray) -> np.ndarray:
        """The places that marks of the order-0 distribution fall into."""
        n, c = self.used, self.cumulated[: self.used + 1]
        if self.guide is None:
            # where evenly spaced marks fall; the last of these places stands for all that are one wide
            self.shift = np.uint64(max(0, int(self.total).bit_length() - _GUIDE_BITS))
            marks = np.arange((int(self.total) >> int(self.shift)) + 1, dtype=np.uint64) << self.shift
            self.guide = c.searchsorted(marks, side="right") - 1
        place = self.guide.take((mark >> self.shift).view(np.int64))
        late = (self.cumulated.take(place + 1) <= mark).nonzero()[0]
        place[late] = c.searchsorted(mark.take(late), side="right") - 1
        place += np.where(mark > c[n], mark - c[n], np.uint64(0)).view(np.int64)
        return place

    def predict(self, before2: np.ndarray, before1: np.ndarray) -> None:
        """Candidates of the two orders, and which mixture holds, for every lane."""
        mixed = (before2.view(np.uint64) * np.uint64(0x9E3779B1) + before1.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        self.at = np.empty((2, len(before1)), np.int64)
        np.right_shift(mixed, np.uint64(64 - _SLOTS), out=self.at[0].view(np.uint64))
        np.add(before1, 1 << _SLOTS, out=self.at[1])
        self.state = self.known.take(self.at)
        self.held, self.sure = self.state >> 2, self.state & 3
        self.first, self.second = self.held
        self.context = self.sure[0] * np.int64(8) + self.sure[1] * 2 + (self.first == self.second)

    def learn(self, ids: np.ndarray, cell: np.ndarray, written: np.ndarray) -> None:
        """Take in a step: its ids, the share of the mixture each fell into, and those written out."""
        small, state, sure = ids.astype(np.int32), self.state, self.sure
        self.known[self.at] = np.where(self.held == small, state + (sure < 3), np.where(sure == 0, small << 2, state - 1))
        self.trust += np.bincount(cell, minlength=96).reshape(32, 3)
        self.written.append(written)
        self.steps += 1
        if self.steps <= 8 or self.steps % 4 == 0:
            self._count()
            self._mixture()


def _settle(low: np.ndarray, range_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which states put out a word now, and their ranges, cut short where a carry threatens."""
    out = (low ^ (low + range_)) < _TOP
    tight = (range_ < _BOTTOM) & ~out
    if tight.any():
        range_ = np.where(tight, _BOTTOM - (low & (_BOTTOM - np.uint64(1))), range_)
        out |= tight
    return out.nonzero()[0], range_


class _Writer:
    def __init__(self, lanes: int) -> None:
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
        self.lanes: list[np.ndarray] = []
        self.words: list[np.ndarray] = []

    def _emit(self, at: np.ndarray, low: np.ndarray) -> None:
        # 16 bits are sorted by their digits; there are at most `LANES`
        self.lanes.append(at.astype(np.uint16))
        self.words.append((low >> _48).astype("<u2"))

    def put(self, start: np.ndarray, freq: np.ndarray, at: np.ndarray, start0: np.ndarray, freq0: np.ndarray, total: np.uint64) -> None:
        """A share of the mixture for the first lanes, and within it one of the order-0 distribution for those at ``at``."""
        m = len(start)
        unit = self.range[:m] >> np.uint64(_MIX_BITS)
        low, range_ = self.low[:m], unit * freq
        low += unit * start
        unit = range_.take(at) // total
        low[at] += unit * start0
        range_[at] = unit * freq0
        out, range_ = _settle(low, range_)
        self.range[:m] = range_
        at = out
        low, range_ = low.take(out), range_.take(out)
        while len(at):
            self._emit(at, low)
            low, range_ = (low & _LOW48) << _16, range_ << _16
            self.low[at], self.range[at] = low, range_
            out, range_ = _settle(low, range_)
            at, low, range_ = at.take(out), low.take(out), range_.take(out)

    def close(self) -> bytes:
        # two words pick a stretch of the range, whatever is read after them
        low, at = self.low + np.uint64((1 << 32) - 1), np.arange(len(self.low))
        self._emit(at, low)
        self._emit(at, low << _16)
        lanes = np.concatenate(self.lanes)
        words = np.concatenate(self.words)[np.argsort(lanes, kind="stable")]
        return np.bincount(lanes).astype("<u4").tobytes() + words.tobytes()


class _Reader:
    def __init__(self, payload: bytes, lanes: int) -> None:
        used = np.frombuffer(payload, "<u4", lanes).astype(np.int64)
        # the first states reach up to four words past a short lane
        self.words = np.append(np.frombuffer(payload, "<u2", offset=4 * lanes).astype(np.uint64), np.zeros(4, np.uint64))
        self.next = np.cumsum(used) - used
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
        self.code = np.zeros(lanes, np.uint64)
        for _ in range(4):
            self.code = (self.code << _16) | self.words.take(self.next)
            self.next += 1

    def look(self, start1: np.ndarray, start2: np.ndarray) -> np.ndarray:
        """The shares of the mixture that the first lanes hold."""
        m = len(start1)
        self.unit = self.range[:m] >> np.uint64(_MIX_BITS)
        ahead = self.code[:m] - self.low[:m]
        return (ahead >= self.unit * start1).astype(np.int64) + (ahead >= self.unit * start2)

    def enter(self, start: np.ndarray, freq: np.ndarray) -> None:
        self.low[: len(start)] += self.unit * start
        self.range[: len(start)] = self.unit * freq

    def look_within(self, at: np.ndarray, total: np.uint64) -> np.ndarray:
        self.unit = self.range.take(at) // total
        return np.minimum((self.code.take(at) - self.low.take(at)) // self.unit, total - np.uint64(1))

    def enter_within(self, at: np.ndarray, start: np.ndarray, freq: np.ndarray) -> None:
        self.low[at] += self.unit * start
        self.range[at] = self.unit * freq

    def drop(self, m: int) -> None:
        """Words for the first lanes whose range has become small."""
        low = self.low[:m]
        out, range_ = _settle(low, self.range[:m])
        at, low, range_ = out, low.take(out), range_.take(out)
        while len(at):
            next_ = self.next.take(at)
            self.code[at] = ((self.code.take(at) & _LOW48) << _16) | self.words.take(next_, mode="clip")
            self.next[at] = next_ + 1
            low, range_ = (low & _LOW48) << _16, range_ << _16
            self.low[at], self.range[at] = low, range_
            out, range_ = _settle(low, range_)
            at, low, range_ = at.take(out), low.take(out), range_.take(out)


def _lanes(n: int) -> tuple[int, int]:
    """Lanes and steps of a block of n ids: lane i has the ids from i * steps on."""
    lanes = max(1, min(LANES, n // LANE_IDS))
    steps = -(-n // lanes)
    return -(-n // steps) if steps else 1, steps


def _turned(table: np.ndarray, kind: np.typing.DTypeLike) -> np.ndarray:
    """The transposed table, written in strips that stay in the processor's cache."""
    out = np.empty(table.shape[::-1], kind)
    for at in range(0, len(table), 128):
        out[:, at : at + 128] = table[at : at + 128].T
    return out


def encode_block(ids: np.ndarray, space: int) -> bytes:
    """A frame of ids below ``space``."""
    n = len(ids)
    lanes, steps = _lanes(n)
    table = np.full(lanes * steps, space, "<u4")
    table[:n] = ids
    table = _turned(table.reshape(lanes, steps), np.int64)
    model, writer = Model(space), _Writer(lanes)
    before2 = before1 = np.full(lanes, space, np.int64)
    for t in range(steps):
        # the last lane may be shorter
        m = lanes - int((lanes - 1) * steps + t >= n)
        x = table[t, :m]
        model.predict(before2[:m], before1[:m])
        is_first, is_second = model.first == x, model.second == x
        cell = model.context * 3 + np.where(is_first, 0, 2 - is_second)
        at = (~(is_first | is_second)).nonzero()[0]
        written = x.take(at)
        writer.put(model.start.take(cell), model.freq.take(cell), at, *model.stretch(model.place.take(written)), model.total)
        model.learn(x, cell, written)
        before2, before1 = before1, x
    payload = writer.close() if n else b""
    raw = zlib.crc32(np.asarray(ids, "<u4").tobytes())
    return _HEAD.pack(MAGIC, n, lanes, space, raw, zlib.crc32(payload)) + payload


def decode_block(frame: bytes) -> np.ndarray:
    """The ids of a frame; ValueError when a checksum fails."""
    magic, n, lanes, space, raw, checked = _HEAD.unpack_from(frame)
    payload = frame[_HEAD.size :]
    if magic != MAGIC or zlib.crc32(payload) != checked:
        raise ValueError("the payload of a block is damaged")
    if n == 0:
        return np.empty(0, "<u4")
    steps = -(-n // lanes)
    table = np.zeros((steps, lanes), np.int64)
    model, reader = Model(space), _Reader(payload, lanes)
    before2 = before1 = np.full(lanes, space, np.int64)
    for t in range(steps):
        m = lanes - int((lanes - 1) * steps + t >= n)
        model.predict(before2[:m], before1[:m])
        outcome = reader.look(model.start1.take(model.context), model.start2.take(model.context))
        cell = model.context * 3 + outcome
        reader.enter(model.start.take(cell), model.freq.take(cell))
        x = table[t, :m]
        x[:] = np.where(outcome == 0, model.first, model.second)
        at = (outcome == 2).nonzero()[0]
        place = model.find(reader.look_within(at, model.total))
        reader.enter_within(at, *model.stretch(place))
        reader.drop(m)
        x[at] = written = model.id_at.take(place)
        model.learn(x, cell, written)
        before2, before1 = before1, x
    ids = _turned(table, np.dtype("<u4")).reshape(-1)[:n]
    if zlib.crc32(ids.tobytes()) != raw:
        raise ValueError("the ids of a block are damaged")
    return ids


# --- tokenizing --------------------------------------------------------------

# How byte-level vocabularies write a space, and kinds of bytes. A word is a run of one kind, with the
# space before it; over these kinds all versions of Unicode agree on what is a letter (À to ÿ but for × and ÷, whose
# bytes are looked for apart), a digit or neither. Apostrophes begin the pattern's short forms and count as odd.
_SPACE_MARK = "Ġ"
_SPACE, _LETTER, _DIGIT, _MARK, _LINE, _ODD = range(6)
_KINDS = bytes(
    _SPACE if b == 0x20 else _LINE if b == 0x0A else _DIGIT if 0x30 <= b <= 0x39
    else _LETTER if chr(b).isalpha() and b < 0x80 or 0x80 <= b < 0xC0 or b == 0xC3
    else _MARK if 0x20 < b < 0x7F and b != 0x27 else _ODD
    for b in range(256)
)
_SIGNS = (b"\xc3\x97", b"\xc3\xb7")
#: First bytes that white space may have, or none.
_UNSURE = frozenset([b"", *(bytes([b]) for b in (*range(0x21), 0xC2, 0xE1, 0xE2, 0xE3))])


def _word_starts(raw: bytes, begins: np.ndarray) -> np.ndarray:
    """Where the words of texts begin that stand one after the other, each from its place in ``begins`` on.

    A text is cut before its spaces, where the tokenizer's own pattern begins a
    new token whenever a character that is no space follows.  What lies between
    is cut where the kind changes, unless it holds an odd character or several
    line feeds in a row.
    """
    kinds = np.frombuffer(raw.translate(_KINDS), np.uint8)
    begins = begins[begins < len(raw)]
    starts = np.zeros(len(raw), bool)
    starts[1:] = (kinds[1:] != kinds[:-1]) & (kinds[:-1] != _SPACE)
    odd = kinds == _ODD
    odd[1:] |= (kinds[1:] == _LINE) & (kinds[:-1] == _LINE)
    if any(s in raw for s in _SIGNS):
        data = np.frombuffer(raw, np.uint8)
        odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    starts[begins] = True
    if odd.any():
        spaces = kinds == _SPACE
        spaces[begins] = True
        at = np.flatnonzero(spaces)
        whole = np.logical_or.reduceat(odd, at)
        starts &= ~np.repeat(whole, np.diff(at, append=len(raw)))
        starts[at[whole]] = True
    return np.flatnonzero(starts)


def _joins(word: bytes) -> bool:
    """Whether something that is no white space begins the word, after its own space if it has one."""
    rest = word[word[0] == 0x20 :]
    return rest[:1] not in _UNSURE or (rest != b"" and not rest.decode()[0].isspace())


class _Encoder:
    """Ids as bytes; one encoder a Python worker.

    The texts of a slice are cut into words in one pass over their bytes, and
    Arrow numbers the distinct ones.  The tokenizer sees each of these once and
    what it gave is remembered.  Hundreds of new words go to it in one text, each
    with its space, or after a line feed where it has none: the ids of these tell
    where a word begins.  `words` holds such, `pieces` those that are asked for
    alone.  Texts in which white space follows a space, or with an
    added token, are encoded whole.
    """

    REMEMBERED = 800_000
    JOINED = 256

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.space = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(_SPACE_MARK)]] = True
        self.line = np.frombuffer(self._ids(["\n"])[0], "<u4")
        self.pieces: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of_joined(self, words: list[bytes], between: bytes) -> list[bytes]:
        """Ids of words that all begin with a space, or of words without one and with a line feed between."""
        ids = np.frombuffer(self._ids([(between + between.join(words)).decode()])[0], "<u4")
        if between:
            starts = np.flatnonzero(ids == self.line[0]) if len(self.line) == 1 else np.empty(0, np.int64)
        else:
            starts = np.flatnonzero(self.spaced[ids])
        if len(starts) != len(words) or starts[0] != 0:
            return self._ids([w.decode() for w in words])
        data, ends = ids.tobytes(), (4 * np.append(starts[1:], len(ids))).tolist()
        return [data[a:b] for a, b in zip((4 * (starts + len(between))).tolist(), ends, strict=True)]

    def _learn(self, new: list[bytes]) -> None:
        """Remember the ids of words; none, if texts with them are to be encoded whole."""
        spaced = [w for w in new if w[0] == 0x20]
        if white := {w for w in spaced if w[1:2] in _UNSURE and not _joins(w)}:
            self.pieces.update(dict.fromkeys(white, b""))
            spaced = [w for w in spaced if w not in white]
        others = [w for w in new if w[0] != 0x20]
        alone = {w for w in others if b"\n" in w or not _joins(w)}
        self.pieces.update(zip(alone, self._ids([w.decode() for w in alone]), strict=True))
        for words, between in ((spaced, b""), ([w for w in others if w not in alone], b"\n")):
            for at in range(0, len(words), self.JOINED):
                some = words[at : at + self.JOINED]
                self.words.update(zip(some, self._ids_of_joined(some, between), strict=True))

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        found = list(map(self.words.get, words))
        missing = [w for w, ids in zip(words, found, strict=True) if ids is None]
        self._learn([w for w in missing if w not in self.pieces])
        learnt = iter([self.pieces[w] if ids is None else ids for w, ids in zip(missing, map(self.words.get, missing), strict=True)])
        return [next(learnt) if ids is None else ids for ids in found]

    def encode_all(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        for held in (self.pieces, self.words):
            # the older half goes; what of it still occurs comes back
            for key in list(islice(held, len(held) // 2 if len(held) > self.REMEMBERED else 0)):
                del held[key]
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        texts = texts.cast(pa.large_string()).fill_null("")
        if not pc.sum(pc.binary_length(texts)).as_py():
            return [b""] * len(texts)
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw, ends = texts.buffers()[2][int(ends[0]) : int(ends[-1])].to_pybytes(), ends - ends[0]
        starts = _word_starts(raw, ends[:-1])
        places = np.append(starts, len(raw))
        cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(raw)])
        cut = cut.dictionary_encode()
        found = self._ids_of(cut.dictionary.to_numpy(zero_copy_only=False).tolist())
        coded = pa.array(found, pa.large_binary()).take(cut.indices)
        firsts = np.searchsorted(starts, ends)
        bounds = np.frombuffer(coded.buffers()[1], np.int64)[firsts].tolist()
        data = memoryview(coded.buffers()[2] or b"")
        out = [bytes(data[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        whole = set()
        if b"" in found:
            unfit = np.array([not ids for ids in found])
            at = np.flatnonzero(unfit[cut.indices.to_numpy()])
            whole.update((np.searchsorted(firsts, at, side="right") - 1).tolist())
        for token in self.added:
            # added tokens are found before a text is split
            if token.encode() in raw:
                whole.update(np.flatnonzero(pc.match_substring(texts, token).to_numpy(zero_copy_only=False)).tolist())
        for i in whole:
            out[i] = self._ids([texts[i].as_py()])[0]
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def _by_size(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `SLICE_BYTES` of text; a longer text is alone or last."""
    for rows in parts:
        sizes = pc.fill_null(pc.binary_length(rows.column("text")), 0).to_numpy(zero_copy_only=False)
        before = (np.cumsum(sizes, dtype=np.int64) - sizes) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), rows.num_rows]
        yield from (rows.slice(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a)


# --- Spark -------------------------------------------------------------------


def write_ids(docs: DataFrame, path: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode (doc_id, text) in order of doc_id and write the blocks.

    Columns: part and block (the order of the files), ahead (ids of the part
    before the block), doc_ids and lengths, frame.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        part, block, ahead, size = TaskContext.get().partitionId(), 0, 0, 0
        held: list[tuple] = []

        def made(id_type: pa.DataType) -> pa.RecordBatch:
            names, lengths, ids = zip(*held, strict=True)
            frame = encode_block(np.frombuffer(b"".join(ids), "<u4"), encoder.space)
            schema = pa.schema([
                ("part", pa.int32()), ("block", pa.int32()), ("ahead", pa.int64()),
                ("doc_ids", pa.list_(id_type)), ("lengths", pa.list_(pa.int64())), ("frame", pa.binary()),
            ])
            return next(batches([(part, block, ahead, names, lengths, frame)], schema))

        for rows in _by_size(parts):
            id_type = rows.schema.field(0).type
            for name, ids in zip(column(rows, "doc_id"), encoder.encode_all(rows.column("text")), strict=True):
                ids += end
                n = len(ids) // 4
                if held and size + n > block_ids:
                    yield made(id_type)
                    block, ahead, size = block + 1, ahead + size, 0
                    held.clear()
                held.append((name, n, ids))
                size += n
        if held:
            yield made(id_type)

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))
    coded = ordered.mapInArrow(run, f"part int, block int, ahead long, doc_ids array<{kind}>, lengths array<long>, frame binary")
    return written(coded, "token-ids")


def read_ids(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document of the blocks."""
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    # one row a part, read without the frames: what stands before each part
    sizes = files.select("part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    base, before = 0, {}
    for part, n in sorted((r["part"], r["n"]) for r in sizes.groupBy("part").agg(F.sum("n").alias("n")).collect()):
        before[part] = base
        base += n
    sent = files.sparkSession.sparkContext.broadcast(before)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in parts:
            id_type = rows.schema.field(2).type.value_type
            schema = pa.schema([("doc_id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
            for i in range(rows.num_rows):
                part, ahead, names, lengths, frame = (rows.column(c)[i].as_py() for c in range(5))
                data = memoryview(decode_block(frame).tobytes())
                at, out = 0, []
                for name, n in zip(names, lengths, strict=True):
                    out.append((name, sent.value[part] + ahead + at, n, zlib.crc32(data[4 * at : 4 * (at + n)])))
                    at += n
                yield from batches(out, schema, 1 << 16)

    placed = files.select("part", "ahead", "doc_ids", "lengths", "frame")
    return placed.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
