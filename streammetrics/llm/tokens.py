"""Token ids of many texts at once, equal to those of encoding each text by itself.

Most of a text is made of few distinct words. Arrow splits the texts of a batch into chunks and these into parts that the
tokenizer encodes independently of each other, and numbers the distinct ones; only distinct parts are looked up
in a bounded cache, new ones are encoded together, and the texts' ids are gathered by the numbers.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 16 << 20    # bytes of text that are encoded together
_PUNCTUATION = string.punctuation.replace("'", "")      # 's and the like are tokens of their own
_LETTERS = "[A-Za-zÀ-ÖØ-öø-įı-ɏ]+"                      # without İ, whose lower case is two code points
_IS_PLAIN = re.compile(rf" ?(?:{_LETTERS}|[{re.escape(_PUNCTUATION)}]+)").fullmatch     # one word or run of punctuation
_RARE_SPACES = r"\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: A chunk with white space elsewhere than in its first place, or there of a rare kind, or with nothing behind it.
_ODD = rf"^[ \n][ \n{_RARE_SPACES}]|^[{_RARE_SPACES}]|[ \n{_RARE_SPACES}]$"


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[tuple[list, pa.Array]]:
    """(ids, texts) of Arrow batches whose first two columns are id and text, about ``size`` bytes of text at a time."""
    for batch in batches:
        at, held = 0, 0
        widths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
        for row, width in enumerate(widths, 1):
            held += width
            if held >= size or row == len(widths):
                yield batch.column(0).slice(at, row - at).to_pylist(), batch.column(1).slice(at, row - at)
                at, held = row, 0


def gather(values: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of the numbered runs one after the other, where each begins and the last ends)."""
    starts = np.cumsum(sizes) - sizes
    size = sizes[numbers]
    bounds = np.append(0, np.cumsum(size))
    return values[np.repeat(starts[numbers] - bounds[:-1], size) + np.arange(bounds[-1])], bounds


class PartEncoder:
    """Parts → ids through a bounded cache; the parts themselves are up to the kind of tokenizer."""

    LIMIT = 600_000     # entries of the cache
    LONGEST = 64        # characters of a part that is kept
    TOGETHER = 512      # new parts in one call

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _together(self, parts: list[str]) -> list[bytes] | None:
        """Ids of plain parts from one call; None if they can't be told apart."""
        raise NotImplementedError

    def _encode(self, new: list[str]) -> dict[str, bytes]:
        found, plain = {}, []
        for part in new:
            if _IS_PLAIN(part) and "<|" not in part:
                plain.append(part)
            else:                              # "<|" may begin a special token
                found[part] = self.whole(part)
        for at in range(0, len(plain), self.TOGETHER):
            some = plain[at:at + self.TOGETHER]
            found.update(zip(some, self._together(some) or map(self.whole, some)))
        return found

    def _ids(self, parts: list[str]) -> list[bytes]:
        if len(self.parts) > self.LIMIT:       # without the older half; common parts come back at their next use
            self.parts = dict(islice(self.parts.items(), len(self.parts) // 2, None))
        known = self.parts
        known[""] = b""
        out = list(map(known.get, parts))
        new = [i for i, ids in enumerate(out) if ids is None]
        found = self._encode([parts[i] for i in new])
        for i in new:
            out[i] = found[parts[i]]
        known.update(found)
        for part in found:
            if len(part) > self.LONGEST:
                del known[part]
        return out

    def _gathered(self, parts: pa.LargeStringArray, a_chunk: int, chunks: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and bounds of the chunks, each of which has ``a_chunk`` parts."""
        numbered = parts.dictionary_encode()
        found = self._ids(numbered.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, bounds = gather(np.frombuffer(b"".join(found), "<u4"), sizes, numbered.indices.to_numpy())
        return gather(ids, np.diff(bounds[::a_chunk]), chunks.indices.to_numpy())


def _bounds(array: pa.LargeStringArray) -> np.ndarray:
    """Byte offsets of an array's values in its data."""
    return np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]


def _over(array: pa.LargeStringArray, cuts: np.ndarray) -> pa.LargeStringArray:
    """Strings between the given byte offsets of an array's data."""
    return pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), array.buffers()[2] or pa.py_buffer(b""))


def _lengths(array: pa.Array) -> np.ndarray:
    return pc.binary_length(array).to_numpy(zero_copy_only=False)


def _words(chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whether Latin letters with ASCII punctuation around them, bytes before the letters, bytes up to their end)."""
    word = pc.utf8_trim(chunks, _PUNCTUATION)
    plain = pc.and_(pc.match_substring_regex(word, f"^{_LETTERS}$"), pc.invert(pc.match_substring(chunks, "<|")))
    to_end = _lengths(pc.utf8_rtrim(chunks, _PUNCTUATION))
    return plain.to_numpy(zero_copy_only=False), to_end - _lengths(word), to_end


class WordEncoder(PartEncoder):
    """For a tokenizer that drops white space and splits words from punctuation, whose tokens show the end of a word.

    The chunks between ASCII white space are encoded independently of each other, and a chunk of Latin letters
    with ASCII punctuation around them is its letters' ids between those of its punctuation.
    """

    def __init__(self, path: str):
        super().__init__(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _together(self, parts: list[str]) -> list[bytes] | None:
        ids = np.array(self.tokenizer.encode(" ".join(parts), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(parts) or ends[-1] != len(ids):
            return None
        data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin and the last's end); a null text has none."""
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        chunks = lists.flatten().dictionary_encode()
        distinct = chunks.dictionary
        plain, begin, to_end = _words(distinct)
        start = _bounds(distinct)
        cuts = np.empty(3 * len(distinct) + 1, np.int64)      # before the word, the word, behind it
        cuts[0::3] = start
        cuts[1::3] = start[:-1] + np.where(plain, begin, 0)
        cuts[2::3] = np.where(plain, start[:-1] + to_end, start[1:])
        ids, bounds = self._gathered(_over(distinct, cuts), 3, chunks)
        at = lists.offsets.to_numpy()
        return ids, bounds[at - at[0]]


class ByteEncoder(PartEncoder):
    """For a byte-level tokenizer that joins one space to the word or punctuation behind it.

    A text is split before every space and line break. A chunk keeps that character; a line break is a token of its
    own, a space belongs to what follows it, and between them and the next stand Latin letters with ASCII
    punctuation around them, or something that is encoded as it is. A text where white space meets white space
    otherwise than one line break another, or with the beginning of a special token, is encoded whole.
    """

    _MARK = "\x01"       # before each chunk; a text that holds it is encoded whole

    def __init__(self, path: str):
        super().__init__(path)
        self.line_break = int(np.frombuffer(self.whole("\n"), "<u4")[0])

    def _together(self, parts: list[str]) -> list[bytes] | None:
        encoded = self.tokenizer.encode_batch_fast(["\n".join(parts)], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, "<u4")
        breaks = np.flatnonzero(ids == self.line_break)
        if len(breaks) != len(parts) - 1:
            return None
        data, ends = ids.tobytes(), [*(4 * breaks).tolist(), 4 * len(ids)]
        return [data[:ends[0]], *[data[a + 4:b] for a, b in zip(ends, ends[1:])]]

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin and the last's end); a null text has none."""
        texts = texts.cast(pa.large_string()).fill_null("")
        marked = pc.replace_substring(pc.replace_substring(texts, " ", f"{self._MARK} "), "\n", f"{self._MARK}\n")
        lists = pc.split_pattern(marked, self._MARK)
        chunks = lists.flatten().dictionary_encode()
        distinct = chunks.dictionary
        distinct_odd = pc.match_substring_regex(distinct, _ODD).to_numpy(zero_copy_only=False)
        lone = pc.equal(distinct, "\n").to_numpy(zero_copy_only=False)
        number, at = chunks.indices.to_numpy(), lists.offsets.to_numpy()
        at = at - at[0]
        odd, break_ = (distinct_odd & ~lone)[number], lone[number]
        odd[1:] |= break_[1:] & break_[:-1]                    # three line breaks or more
        whole = pc.or_(pc.match_substring(texts, self._MARK), pc.match_substring(texts, "<|")).to_numpy(
            zero_copy_only=False).copy()
        whole[np.repeat(np.arange(len(texts)), np.diff(at))[odd]] = True

        start, end = _bounds(distinct)[:-1], _bounds(distinct)[1:]
        breaks = pc.starts_with(distinct, "\n").to_numpy(zero_copy_only=False).astype(np.int64)
        first = breaks + pc.starts_with(distinct, " ").to_numpy(zero_copy_only=False)
        plain, begin, to_end = _words(pc.replace_substring_regex(distinct, "^[ \n]", ""))
        cuts = np.empty(4 * len(distinct) + 1, np.int64)       # line break, before the word, the word, behind it
        cuts[0::4] = _bounds(distinct)
        cuts[1::4] = start + breaks
        cuts[2::4] = np.where(plain & (begin > 0), start + first + begin, start + breaks)
        cuts[3::4] = np.where(plain, start + first + to_end, end)
        ids, bounds = self._gathered(_over(distinct, cuts), 4, chunks)
        bounds = bounds[at]
        if whole.any():
            own = [np.frombuffer(self.whole(t), "<u4") if w else ids[a:b]
                   for t, w, a, b in zip(texts.to_pylist(), whole.tolist(), bounds[:-1].tolist(), bounds[1:].tolist())]
            ids, bounds = np.concatenate(own), np.append(0, np.cumsum([len(o) for o in own]))
        return ids, bounds
