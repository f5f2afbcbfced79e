"""Byte-level BPE: cutting texts into chunks that encode alone, and two encoders over them.

`LibraryEncoder` calls the tokenizers library; `RankEncoder` is this package's own encoder and decoder. Both encode
each distinct chunk once: texts are cut where the pre-tokenizer always starts a new word, so the ids of a text are those
of its chunks in a row. Cuts, the dictionary of distinct chunks and the gathering of their ids are array operations over
some megabytes of text at a time; only chunks not met before cost a call each.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import claim_cache

#: Fixed value: the pre-tokenizer's pattern, as the public tokenizer file's documentation gives it.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text cut at once (a longer text is cut alone), and of chunks with their ids that a worker remembers.
SEGMENT, REMEMBERED = 6 << 20, 32 << 20
#: Words that the own encoder remembers, about 200 bytes each.
WORDS = 100_000
LETTER, MARK, DIGIT = 1, 2, 3
#: Kinds of ASCII bytes; 0 for white space, controls and all bytes of longer characters.
KIND = np.zeros(256, np.uint8)
KIND[33:127] = MARK
KIND[48:58] = DIGIT
KIND[[*range(65, 91), *range(97, 123)]] = LETTER


def cuts(data: np.ndarray, starts: np.ndarray, marks: bool) -> np.ndarray:
    """Places in UTF-8 bytes of several texts where a new word begins whatever stands around: the texts' starts, single spaces and line ends between other characters, and marks after an ASCII letter."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    for byte in (32, 10):
        at = np.flatnonzero(data[1 : n - 1] == byte) + 1
        before, after = data[at - 1], data[at + 1]
        # Characters from U+00C0 on whose first byte isn't that of a space: in two bytes, three (all but E1 to E3) or four.
        second, third, fourth = data[at - 2], data[at - 3], data[at - 4] if n > 3 else data[at - 1]
        inner = (before >= 0x80) & (before < 0xC0) & (((second >= 0xC3) & (second < 0xE0)) | ((second < 0xC0) & (((third >= 0xE4) & (third < 0xF0)) | ((third < 0xC0) & (fourth >= 0xF0)))))
        fine = ((KIND[before] > 0) | inner) & ((KIND[after] > 0) | ((after >= 0xC3) & ((after < 0xE0) | (after >= 0xE4))))
        cut[at[fine]] = True
        if byte == 10:
            cut[at[fine] + 1] = True
    if marks:
        kind = KIND[data]
        cut[1:n] |= (kind[1:] == MARK) & (kind[:-1] == LETTER)
    cut[starts] = True
    return np.flatnonzero(cut)


class _Cached:
    """Ids of texts through a dictionary of chunks; subclasses give encode_new and specials."""

    specials: list[str] = []

    def __init__(self) -> None:
        self._forget()
        self.special = re.compile(b"|".join(re.escape(x.encode()) for x in self.specials)) if self.specials else None
        self.whole_texts = any(c.isspace() for x in self.specials for c in x)

    def _forget(self) -> None:
        self.chunks, self.packed = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def encode_new(self, new: pa.StringArray) -> pa.Array:
        """Packed uint32 ids of each chunk, as large_binary."""
        raise NotImplementedError

    def segments(self, texts: pa.Array, end_id: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, past the last, ids of these in a row, where each begins and the last ends); nulls are empty. end_id comes after each text's ids."""
        texts = texts.cast(pa.string()) if texts.type != pa.string() else texts
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        if not len(texts):
            return
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        every = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        a = 0
        while a < len(texts):
            b = min(len(texts), max(a + 1, int(np.searchsorted(offsets, offsets[a] + SEGMENT, "right")) - 1))
            ids, starts = self._segment(every[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            if end_id is not None:
                ids = np.insert(ids, starts[1:], end_id)
                starts = starts + np.arange(len(starts))
            yield a, b, ids, starts
            a = b

    def _segment(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.unique(starts) if self.whole_texts else cuts(data, starts, not (self.special and self.special.search(data)))
        at = at.astype(np.int32)
        if len(at) < 2:
            return np.empty(0, np.uint32), np.zeros(len(starts), np.int64)
        found = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        if self.chunks.nbytes + self.packed.nbytes > REMEMBERED:
            self._forget()
        place = pc.index_in(found.dictionary, value_set=self.chunks)
        if place.null_count:
            new = found.dictionary.filter(place.is_null())
            place = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).copy()
            place[np.flatnonzero(pc.index_in(found.dictionary, value_set=new).is_valid().to_numpy(zero_copy_only=False))] = np.arange(len(self.chunks), len(self.chunks) + len(new))
            self.packed = pa.concat_arrays([self.packed, self.encode_new(new)])
            self.chunks = pa.concat_arrays([self.chunks, new])
        else:
            place = place.to_numpy(zero_copy_only=False)
        got = self.packed.take(pa.array(place[found.indices.to_numpy()]))
        ends = np.frombuffer(got.buffers()[1], np.int64)[got.offset : got.offset + len(got) + 1] // 4
        return np.frombuffer(got.buffers()[2], np.uint32)[ends[0] : ends[-1]], ends[np.searchsorted(at, starts)] - ends[0]

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """uint32 ids of each text; null is empty."""
        return [x for _, _, ids, starts in self.segments(pa.array(texts, pa.string())) for x in np.split(ids, starts[1:-1])]


class LibraryEncoder(_Cached):
    """Ids as the tokenizers library gives them with add_special_tokens=False."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        super().__init__()
        # Cuts are proved for byte-level words without normalising; chunks are told apart by how many bytes an id stands for.
        self.whole_texts |= bool(spec.get("normalizer")) or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel"
        self.whole_texts |= any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec["added_tokens"])
        self.size = np.zeros(1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]), np.int64)
        for t, i in spec["model"]["vocab"].items():
            self.size[i] = len(t)
        for t in spec["added_tokens"]:
            self.size[t["id"]] = len(t["content"].encode())
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.whole_texts |= len(line_end) != 1
        self.line_end = line_end[0]

    def encode_new(self, new: pa.StringArray) -> pa.Array:
        """Chunks go to the library many at once, as one text: those after a space in a row, the others with line ends between."""
        joins = pc.match_substring_regex(new, "^ ?[^\\p{Z}\\p{Cc}]+$")
        for x in self.specials:
            joins = pc.and_not(joins, pc.match_substring(new, x))
        joins = joins.to_numpy(zero_copy_only=False) & (not self.whole_texts)
        spaced = pc.starts_with(new, " ").to_numpy(zero_copy_only=False)
        groups = [np.flatnonzero(joins & spaced), np.flatnonzero(joins & ~spaced), np.flatnonzero(~joins)]
        sizes, ids, counts = pc.binary_length(new).to_numpy(), [], []
        for group, between in zip(groups[:2], ("", "\n")):
            for a in range(0, len(group), 2000):
                some = group[a : a + 2000]
                text = between.join(new.take(pa.array(some)).to_pylist())
                got = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                got = got[got != self.line_end] if between else got
                ends = np.searchsorted(np.cumsum(self.size[got]), np.cumsum(sizes[some])) + 1
                ids.append(got)
                counts.append(np.diff(ends, prepend=0))
        rest = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(new.take(pa.array(groups[2])).to_pylist(), add_special_tokens=False)]
        offsets = 4 * np.cumsum(np.concatenate([[0], *counts, [len(x) for x in rest]]).astype(np.int64))
        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(new), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate([*ids, *rest]).astype(np.uint32))])
        return packed.take(pa.array(np.argsort(np.concatenate(groups), kind="stable")))


def _byte_letters() -> dict[str, int]:
    """Letter -> byte of the byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankEncoder(_Cached):
    """Own byte-level BPE over a vocabulary file: merges as ranks of pairs, held beside the parts of a word.

    A short word is two arrays: the ids of its parts (an entry ends where the next begins, so the entries are the
    boundaries) and the merge rank of each neighbouring pair. Again and again the least rank is found by a scan,
    the boundary between its parts deleted and the two ranks beside it refreshed. Words of more than `long_word`
    bytes, for which scans would be quadratic, go through a heap over a linked list with the same order of merges.
    """

    NONE = 1 << 30

    def __init__(self, path: str, long_word: int = 96) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        super().__init__()
        model, letters = spec["model"], _byte_letters()
        vocab = model["vocab"]
        self.bytes_of: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.of_byte = [0] * 256
        for t, i in vocab.items():
            if len(t) == 1:
                self.of_byte[letters[t]] = i
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for n, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = n
            self.made.append(vocab[a + b])
        self.special_id = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special_id.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special_id, key=len, reverse=True))) + ")") if self.special_id else None
        self.pretoken = regex.compile(PRETOKEN).findall
        self.long_word = long_word
        self.words: dict[str, tuple[int, ...]] = {}
        self.tables: dict[str, pa.Array] = {}

    def word(self, w: bytes) -> tuple[int, ...]:
        parts = [self.of_byte[b] for b in w]
        if len(parts) > self.long_word:
            return self._long(parts)
        rank, none = self.rank.get, self.NONE
        ranks = [rank(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            parts[i] = self.made[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), none)
        return tuple(parts)

    def _long(self, parts: list[int]) -> tuple[int, ...]:
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank.get
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if parts[i] >= 0 else n
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of the two has merged since
            parts[i], parts[j] = self.made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (r := rank((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return tuple(p for p in parts if p >= 0)

    def _plain(self, text: str) -> list[int]:
        ids: list[int] = []
        for w in self.pretoken(text):
            found = self.words.get(w)
            if found is None:
                found = self.word(w.encode())
                if len(w) <= 32:
                    self.words[w] = found
            ids += found
        return ids

    def encode_new(self, new: pa.StringArray) -> pa.Array:
        if len(self.words) > WORDS:
            self.words = {}
        out = []
        for text in new.to_pylist():
            if self.split_special and self.split_special.search(text):
                ids: list[int] = []
                for part in self.split_special.split(text):
                    ids += [self.special_id[part]] if part in self.special_id else self._plain(part)
                out.append(array("I", ids).tobytes())
            else:
                out.append(array("I", self._plain(text)).tobytes())
        return pa.array(out, pa.large_binary())

    def decode(self, ids) -> str:
        """The text of the ids, specials included; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


    def _spans(self, kind: str, of: Callable[[int], bytes], ids: np.ndarray, starts: np.ndarray) -> Iterator[memoryview]:
        """Of each text, what its ids stand for in a row, by a table of what each id stands for."""
        if kind not in self.tables:
            self.tables[kind] = pa.array([of(i) for i in range(1 + max(self.bytes_of))], pa.large_binary())
        got = self.tables[kind].take(pa.array(ids))
        ends = np.frombuffer(got.buffers()[1], np.int64)[got.offset :]
        data = memoryview(got.buffers()[2] or b"")
        for i, j in zip(ends[starts[:-1]].tolist(), ends[starts[1:]].tolist()):
            yield data[i:j]

    def decoded(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """The text of each of several texts' ids, as decode gives it."""
        return [str(x, "utf-8", "replace") for x in self._spans("bytes", lambda i: self.bytes_of.get(i, b""), ids, starts)]

    def decimal(self, ids: np.ndarray, starts: np.ndarray) -> Iterator[memoryview]:
        """Of each of several texts, its ids as decimal numbers joined by commas."""
        return (x[:-1] for x in self._spans("decimal", b"%d,".__mod__, ids, starts))


_encoders: dict[tuple, _Cached] = {}


def encoder(kind: type, path: str) -> _Cached:
    """One encoder for each Python worker."""
    claim_cache(f"encoder {kind.__name__} {path}", _encoders.clear)
    if (kind, path) not in _encoders:
        _encoders[kind, path] = kind(path)
    return _encoders[kind, path]
