"""Whole-text encoding with a public tokenizer, for use inside Arrow tasks."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lodestat.llm.packed import by_weight

_TAIL = ".,;:!?"  # marks that start an id of their own after a letter
_GAP = np.zeros(256, bool)  # ASCII white space
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SOLID = np.zeros(256, bool)  # ASCII bytes that are never white space, whatever the library takes for it
_SOLID[0x21:0x7F] = True
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_MARK = np.zeros(256, bool)
_MARK[[*_TAIL.encode()]] = True
_MEMO_BYTES = 64  # longer pieces are encoded, not remembered
_TOGETHER = 256  # pieces in one call of the library


def whole_texts(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and the place where each text ends; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, "uint8") if data is not None and data.size else np.zeros(0, "uint8")
    return (raw[ends[0]:ends[-1]], ends[1:] - ends[0]) if len(texts) else (raw[:0], ends[:0])


def _odd_space_before(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place may be white space beyond ASCII.

    Characters of general punctuation (quotes, dashes) are taken for it too: a place less to
    cut costs nothing but a longer piece.
    """
    one, two, three = (raw[np.maximum(at - k, 0)] for k in (1, 2, 3))
    low = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    return low | ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE1) & (two == 0x9A)) | ((three == 0xE3) & (two == 0x80))


def cut_before_space(raw: np.ndarray, at_space: np.ndarray) -> np.ndarray:
    """Places where white space (``at_space``, a mask of bytes) follows a character that is none."""
    at = np.flatnonzero(at_space)
    at = at[at > 0]
    before = raw[at - 1]
    return at[_SOLID[before] | ((before >= 0x80) & ~_odd_space_before(raw, at))]


def cut_before_mark(raw: np.ndarray) -> np.ndarray:
    """Places where a mark of ``_TAIL`` follows an ASCII letter or an accented letter of Latin-1."""
    at = np.flatnonzero(_MARK[raw])
    at = at[at > 0]
    one, two = raw[at - 1], raw[np.maximum(at - 2, 0)]
    return at[_ASCII_LETTER[one] | ((two == 0xC3) & (one >= 0x80) & (one != 0x97) & (one != 0xB7) & (at > 1))]


def pieces(raw: np.ndarray, cuts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Distinct pieces between neighbouring places, and the number of each piece in order."""
    array_type, offset = (pa.LargeBinaryArray, "<i8") if len(raw) >= 1 << 31 else (pa.BinaryArray, "<i4")
    cells = array_type.from_buffers(pa.large_binary() if offset == "<i8" else pa.binary(), len(cuts) - 1,
                                    [None, pa.py_buffer(cuts.astype(offset)), pa.py_buffer(np.ascontiguousarray(raw))])
    coded = cells.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions ``start .. start + size`` of every run, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class BatchEncoder:
    """Ids of all texts of an Arrow batch at once.

    The bytes are cut where white space follows other characters and where a mark follows a
    letter; tokenizers meant here never join characters across these places.  Arrow numbers
    the distinct pieces, only those unknown to the memo go to the library, and the ids of the
    texts are gathered by piece number.

    ``drops_space``: the tokenizer ignores white space (``word_bpe``) or keeps it in front of the
    next word (``byte_bpe``).  ``width``: bytes of one id, 2 or 4.
    ``literal``: strings of special tokens are ordinary text.  ``memo``: pieces remembered.
    """

    def __init__(self, path: str, drops_space: bool, width: int = 4, literal: bool = True, memo: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        self.literal, self.path, self.drops_space, self.width, self.type, self.limit, self.memo = literal, path, drops_space, width, {2: "<u2", 4: "<u4"}[width], memo, {}
        parts = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items()]
        parts = parts if all("<|" in text for _, text in parts) else []
        self.mark_id, self.mark = min(parts, default=(None, None))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids before each text and after the last."""
        raw, ends = whole_texts(texts)
        gap = _GAP[raw]
        if self.drops_space:
            # white space between pieces is nothing: leave it out, every run of it cuts
            edge = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1 if len(raw) else np.zeros(0, "int64")
            cuts = np.concatenate([edge, cut_before_mark(raw), ends])
            kept = np.cumsum(~gap, dtype="int32" if len(raw) < 1 << 31 else "int64")
            move = lambda at: np.where(at > 0, kept[np.maximum(at, 1) - 1], 0) if len(raw) else at
            cuts, ends, raw = move(cuts), move(ends), raw[~gap]
        else:
            cuts = np.concatenate([cut_before_space(raw, gap), cut_before_mark(raw), ends])
        place = np.zeros(len(raw) + 1, bool)
        place[0] = place[cuts] = True
        cuts = np.flatnonzero(place)
        if len(cuts) < 2:
            return np.zeros(0, self.type), np.zeros(len(ends) + 1, "int64")
        names, code = pieces(raw, cuts)
        first, size, ids = self._ids(names)
        out = ids[spread(first[code], size[code])]
        before = np.concatenate([[0], np.cumsum(size[code])])
        return out, np.concatenate([[0], before[np.searchsorted(cuts, ends)]])

    def _ids(self, names: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place and number of each piece's ids within the ids of all of them."""
        if len(self.memo) > self.limit:
            self.memo.clear()
        memo = self.memo
        found = list(map(memo.get, names))
        new = [i for i, f in enumerate(found) if f is None]
        for at in range(0, len(new), 1 << 14):
            part = new[at:at + (1 << 14)]
            for i, ids in zip(part, self.encode_words([names[i].decode() for i in part])):
                found[i] = ids
                if len(names[i]) <= _MEMO_BYTES:
                    memo[names[i]] = ids
        size = np.fromiter(map(len, found), "int64", len(found)) // self.width
        return np.cumsum(size) - size, size, np.frombuffer(b"".join(found), self.type)

    def encode_words(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, not remembered.

        A special token between two texts parts them, so one call of the library serves many
        texts; texts that hold such a token's own string are encoded one by one.
        """
        kind, tokenizer = self.type, self.tokenizer
        if self.mark is None:
            return [np.array(e.ids, kind).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out: list[bytes | None] = [None] * len(texts)
        alone = [i for i, t in enumerate(texts) if "<|" in t]
        for i in alone:
            out[i] = np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids, kind).tobytes()
        rest = [i for i, b in enumerate(out) if b is None]
        try:
            tokenizer.encode_special_tokens = False
            for at in range(0, len(rest), _TOGETHER):
                part = rest[at:at + _TOGETHER]
                ids = np.array(tokenizer.encode(self.mark.join([texts[i] for i in part]) + self.mark, add_special_tokens=False).ids, "int64")
                ends = np.flatnonzero(ids == self.mark_id).tolist()
                flat, start = ids.astype(kind).tobytes(), 0
                for i, end in zip(part, ends, strict=True):
                    out[i] = flat[start * self.width:end * self.width]
                    start = end + 1
        finally:
            tokenizer.encode_special_tokens = self.literal
        return out


def parts(texts: pa.Array, most: int = 1 << 22) -> list[tuple[int, int]]:
    """Slices of a batch with about ``most`` bytes of text each, which bound what one call of ``encode`` holds."""
    return by_weight(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), most)


def with_end(ids: np.ndarray, before: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    return np.insert(ids, before[1:], end_id), before + np.arange(len(before))


_BATCH_ENCODERS: dict[tuple, BatchEncoder] = {}


def batch_encoder(path: str, drops_space: bool, width: int = 4, literal: bool = True) -> BatchEncoder:
    """The worker's batch encoder; it lives as long as the worker, and so does its memo."""
    key = (path, drops_space, width, literal)
    if key not in _BATCH_ENCODERS:
        _BATCH_ENCODERS[key] = BatchEncoder(path, drops_space, width, literal)
    return _BATCH_ENCODERS[key]
