"""Token ids by a tokenizer file, inside tasks."""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

CACHE_ENTRIES = 200_000
BATCH_BYTES = 4 << 20
TOGETHER = 1_000

#: Marks at the end of a piece, which a byte-level tokenizer always splits from a letter or digit before them. They become
#: pieces of their own, with a character in front that says so.
_MARKS, _ALONE = r"([\pL\pN])([\pP\pS]+)( |$)", "\x00"


#: Byte-level tokenizers write each byte as a character: printable ones as themselves, the others from U+0100 on.
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = {b: chr(0x100 + k) for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}


class _Pieces:
    """Ids of text pieces as bytes, in ``known``. Of two generations of bounded size the older one is dropped when the
    younger is full; what is still in use moves over. Pieces with white space inside are never kept."""

    def __init__(self, encode_all):
        self.encode_all, self.known, self.older = encode_all, {}, {}

    def learn(self, wanted: list[str]) -> None:
        """Adds what is not known yet, in one go. No piece is in ``wanted`` twice."""
        if len(self.known) >= CACHE_ENTRIES:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        letters, spaced, own_letters, own, marks = [], [], [], [], []
        for piece in wanted:
            if piece in known:
                continue
            if piece in older:
                known[piece] = older[piece]
            elif piece.isalpha():
                letters.append(piece)
            elif piece[:1] == "\n":
                if piece.split() == [piece[1:]]:
                    (own_letters if piece[1:].isalpha() else own).append(piece[1:])
            elif piece[:1] == _ALONE:
                if piece.split() == [piece] != [_ALONE]:
                    marks.append(piece[1:])
            elif piece.split() == [piece]:
                spaced.append(piece)
        for words in letters, spaced:
            known.update(zip(words, self.encode_all(words, " "), strict=True))
        for words in own_letters, own:
            known.update(zip(["\n" + w for w in words], self.encode_all(words, "\n"), strict=True))
        known.update(zip([_ALONE + m for m in marks], self.encode_all(marks, ""), strict=True))


class Encoder:
    """Encodes whole texts to little-endian ids, two bytes each if the vocabulary allows, else four.

    A byte-level tokenizer without a normalizer splits a text before it merges: a space or line end
    between two other characters always starts a new split. Such texts are cut there and every
    different piece is encoded once per task. Texts with other white space, or several in a row, and other kinds
    of tokenizer go through the tokenizer whole. Both ways give the same ids. A piece of letters alone is one unit for the
    tokenizer's model, which is asked directly. Strings of the tokenizer's added tokens in a text become their ids, as
    the library does by default; with ``specials=False`` they are ordinary text.
    """

    def __init__(self, path: str, specials: bool = True):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not specials
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        conf = json.loads(self.tokenizer.to_str())
        pre = conf.get("pre_tokenizer") or {}
        self.splits = (
            conf.get("normalizer") is None and conf.get("post_processor") is None and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
        )
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values() if specials or not t.special]
        #: Strings that only the tokenizer itself may encode.
        self.whole = re.compile("|".join([_ALONE, *added]))
        model = conf["model"]
        self.letters = self.splits and model.get("type") == "BPE" and not model.get("dropout") and not any(
            model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.line_end = self._whole("\n")
        self.splits &= len(self.line_end) == self.dtype.itemsize
        self.pieces = _Pieces(self._many)

    def _bytes(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _whole(self, text: str) -> bytes:
        # without offsets, which nobody needs here
        return self._bytes(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _many(self, words: list[str], lead: str) -> list[bytes]:
        """Ids of each word behind a space, a line end or nothing."""
        if not (self.letters and all(map(str.isalpha, words))):
            return self._lines(words, lead)
        start, before = (self.line_end, "") if lead == "\n" else (b"", lead.translate(_BYTE_CHARS))
        tokenize, packed = self.tokenizer.model.tokenize, self._bytes
        chars = [word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_CHARS) for word in words]
        return [start + packed([t.id for t in tokenize(before + word)]) for word in chars]

    def _lines(self, words: list[str], lead: str) -> list[bytes]:
        """The same by the tokenizer itself, many words as lines of one text."""
        out: list[bytes] = []
        size, line_end = self.dtype.itemsize, np.frombuffer(self.line_end, self.dtype)[0]
        before, start = ("", self.line_end) if lead == "\n" else (lead, b"")
        for k in range(0, len(words), TOGETHER):
            raw = self._whole(before + f"\n{before}".join(words[k : k + TOGETHER]))
            cut = (np.flatnonzero(np.frombuffer(raw, self.dtype) == line_end) * size).tolist()
            begin = 0
            for end in [*cut, len(raw)]:
                out.append(start + raw[begin:end])
                begin = end + size
        return out

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        return list(encoded_texts(self, pa.array(texts, pa.large_string())))

    def encode_array(self, column: pa.Array) -> list[bytes]:
        """The same for an Arrow column, all of it cut at once."""
        texts = [t or "" for t in column.to_pylist()]
        if not self.splits:
            return list(map(self._whole, texts))
        # the first piece of a text has no space before it: it counts as behind a line end, which is cut off
        behind, none = pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string())
        cut = pc.replace_substring(column.cast(pa.large_string()).fill_null(""), "\n", " \n")
        cut = pc.replace_substring_regex(cut, _MARKS, rf"\1 {_ALONE}\2\3")
        parts = pc.split_pattern(pc.binary_join_element_wise(behind, cut, none), " ")
        pieces = parts.flatten().dictionary_encode()
        different = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.pieces.learn(different)
        ids = pa.array(list(map(self.pieces.known.get, different)), pa.large_binary()).take(pieces.indices)
        # a text with a piece that is not known has no joined ids
        joined = pc.binary_join(pa.ListArray.from_arrays(parts.offsets, ids), pa.scalar(b"", pa.large_binary())).to_pylist()
        width, whole = self.dtype.itemsize, self.whole
        return [self._whole(text) if own is None or whole.search(text) else own[width:] for text, own in zip(texts, joined)]

    def encode(self, text: str | None) -> bytes:
        return self.encode_batch([text])[0]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker; the file is read on the executor from the installed package."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded_texts(enc: Encoder, texts: pa.Array) -> Iterator[bytes]:
    """Ids of the texts of an Arrow column, a few megabytes of text, or one longer text, at a time."""
    ends, k, done = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(), dtype=np.int64), 0, 0
    while k < len(texts):
        end = max(k + 1, int(np.searchsorted(ends, done + BATCH_BYTES, side="right")))
        ids = enc.encode_array(texts.slice(k, end - k))
        # else the allocator keeps several times what is in use
        pa.default_memory_pool().release_unused()
        yield from ids
        k, done = end, int(ends[end - 1])
