"""Token ids of whole texts by a ``tokenizers`` vocabulary, distinct word by distinct word."""

import json
import os
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from rollcall.llm.common import spans

#: Bytes of text whose words are looked up together.
CHUNK = 2 << 20
#: Words remembered by a worker: so many recent ones, and as many before them.
REMEMBERED = 200_000
#: Letters of the longest word that is remembered.
LONG = 64
#: Below this letter no text changes under NFC, and lower case and classes are settled, but for
#: the one letter whose lower case is two characters.
_SETTLED, _DOUBLE = "ƀ", "\u0130"
#: Settled letters, with one mark behind them or none.
_PLAIN = r"^[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}]+[.,]?$"
_BLANK = re.compile(rb"[ \t\n\r]")
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[*b" \t\n\r"]] = True


class Remembered(dict):
    """Ids by word; a word that is not held is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word):
        ids = self.encode(word)
        if len(word) <= LONG:
            self[word] = ids
        return ids


class WordEncoder:
    """Encodes texts as the vocabulary does, each distinct word of some megabytes once.

    Texts are cut at spaces, tabs and line breaks only.  This holds for vocabularies whose
    pre-tokenizer drops white space, so that no token reaches across it; the constructor
    tries that.  Strings of special tokens are ordinary text, as the vocabularies' notes set it
    (``encode_special_tokens``): no document may end another by what it says.

    Of a vocabulary that lowers the text, cuts it by one pattern and maps its bytes, words of
    settled letters skip the library's general path: their pieces go straight to its model.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        trial = "an example's\n of\ttext, über 42 "
        if b"".join(self._general(w) for w in trial.split()) != self._general(trial):
            raise ValueError(f"tokens of {path} reach across white space")
        self.pattern = self._pattern(json.loads(self.tokenizer.to_str()))
        self.tokenize = self.tokenizer.model.tokenize
        # The printable stand-ins of bytes, in the order of the bytes they stand for.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.letters_held, self.others_held = Remembered(self._letters), Remembered(self._other)
        self.before = {}
        self.marks = {"": b""} | {mark: self._general(mark) for mark in ".,"}

    @staticmethod
    def _pattern(parts: dict):
        """The splitting pattern, if the vocabulary works as the short path does."""
        try:
            steps = [n["type"] for n in parts["normalizer"]["normalizers"]]
            split, octets = parts["pre_tokenizer"]["pretokenizers"]
            known = (
                steps == ["NFC", "Replace", "Lowercase"]
                and parts["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
                and (split["type"], split["behavior"], split["invert"]) == ("Split", "Removed", True)
                and (octets["type"], octets["add_prefix_space"], octets["use_regex"])
                == ("ByteLevel", False, False)
            )
            return regex.compile(split["pattern"]["Regex"]) if known else None
        except (KeyError, TypeError, ValueError):
            return None

    def _general(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.tokenize(shown)]).tobytes()

    def _other(self, word: str) -> bytes:
        """The ids of a word that is not letters alone, or letters and a mark."""
        known = self.before.get(word)
        if known is not None:
            return known
        if (
            self.pattern is None or max(word) >= _SETTLED or _DOUBLE in word or not word.isprintable()
        ):
            return self._general(word)
        return b"".join(map(self._piece, self.pattern.findall(word.lower())))

    def _letters(self, word: str) -> bytes:
        """The ids of settled letters in lower case, which are one piece."""
        known = self.before.get(word)
        return known if known is not None else self._piece(word)

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, one behind the other, and their numbers of ids.

        Settled letters, with a comma or a stop behind them or not, are a piece and a mark: a
        piece never goes from a letter on to a mark.  So few pieces are left to look up.
        """
        if self.pattern is None:
            plain = np.zeros(len(words), dtype=bool)
        else:
            plain = pc.match_substring_regex(words, _PLAIN).to_numpy(zero_copy_only=False)
        if len(self.letters_held) > REMEMBERED:
            self.letters_held, self.before = Remembered(self._letters), self.letters_held
        if len(self.others_held) > REMEMBERED // 4:
            self.others_held.clear()
        low = pc.utf8_lower(words.filter(pa.array(plain)))
        bare = pc.utf8_rtrim(low, ".,").dictionary_encode()
        others = _listed(words.filter(pa.array(~plain)))
        found = [
            *map(self.marks.__getitem__, ("", ".", ",")),
            *map(self.letters_held.__getitem__, _listed(bare.dictionary)),
            *map(self.others_held.__getitem__, others),
        ]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        # Each word is two of these parts; the second may be the empty one.
        parts = np.zeros((len(words), 2), dtype=np.int64)
        parts[plain, 0] = 3 + bare.indices.to_numpy()
        ends = [pc.ends_with(low, mark).to_numpy(zero_copy_only=False) for mark in ".,"]
        parts[plain, 1] = ends[0] + 2 * ends[1]
        parts[~plain, 0] = np.arange(len(found) - len(others), len(found))
        flat = np.frombuffer(b"".join(found), "<u4")
        return flat[_places(sizes, parts.ravel())], sizes[parts].sum(axis=1)

    def _flat(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts, one behind the other, and their numbers of ids."""
        data = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
        ends = np.cumsum([len(p) + 1 for p in parts])
        inside = ~_WHITE[data]
        starts, stops = spans(inside)
        offsets = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int32)
        words = pa.Array.from_buffers(
            pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
        ).dictionary_encode()
        ids, sizes = self._distinct(words.dictionary)
        word = words.indices.to_numpy()
        upto = np.concatenate(([0], np.cumsum(sizes[word])))
        return ids[_places(sizes, word)], np.diff(upto[np.searchsorted(starts, ends)], prepend=0)

    def encode(self, texts: pa.Array):
        """The ids of texts as unsigned 32-bit integers, about ``CHUNK`` bytes of them at a time.

        Yields how many of the texts come next, their ids one behind the other, and their
        numbers of ids.  A text of more bytes is cut at white space and comes by itself.
        """
        parts, size = [], 0
        for text in texts:
            octets = text.as_buffer().to_pybytes()
            if parts and size + len(octets) > CHUNK:
                yield len(parts), *self._flat(parts)
                parts, size = [], 0
            if len(octets) > CHUNK:
                ids = np.concatenate([self._flat([part])[0] for part in _cut(octets)])
                yield 1, ids, np.array([len(ids)])
                continue
            parts.append(octets)
            size += len(octets)
        if parts:
            yield len(parts), *self._flat(parts)


def _places(sizes: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Where the values of the taken ones, of ``sizes`` each, lie among those of all."""
    begins, own = np.cumsum(sizes) - sizes, sizes[taken]
    upto = np.cumsum(own)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(begins[taken] - upto + own, own)


def _listed(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _cut(text: bytes):
    """Parts of a long text, cut at white space."""
    at = 0
    while at < len(text):
        found = _BLANK.search(text, at + CHUNK)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


@cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder for each worker and vocabulary."""
    return WordEncoder(path)


def forget() -> None:
    """Drop the words a worker remembers: a later step of other work needs the room."""
    word_encoder.cache_clear()


@cache
def id_type(path: str) -> str:
    """The narrowest unsigned type that holds every id of a vocabulary."""
    return "<u2" if Tokenizer.from_file(path).get_vocab_size(True) <= 1 << 16 else "<u4"


def id_slices(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes of ids, cut into values of ``sizes`` ids each."""
    offsets = (np.concatenate(([0], np.cumsum(sizes))) * ids.itemsize).astype(np.int32)
    data = pa.py_buffer(np.ascontiguousarray(ids))
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), data])
