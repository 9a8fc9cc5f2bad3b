"""Token ids of many texts, through the tokenizers library, once per distinct word.

Both public vocabularies cut text in front of a blank that follows another character, in front of a
blank that precedes one, and between a letter and an ASCII character that is none; what comes after such
a cut does not depend on what came before. So a text's ids are the ids of its words, each with the blank
in front of it (or without, where the vocabulary drops white space), and a word's the ids of its pieces.
Texts with a blank between other white space are encoded whole.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
AFTER = r"(?=[\x00-\x40\x5b-\x60\x7b-\x7f]|\Z)"
#: Stands between words that are cut into pieces together; texts that hold it are encoded whole.
MARK = "\x01"
WITH_BLANKS = re.compile(rf"{MARK}|[ \n]*[{LETTERS}]+{AFTER}|[ \n]*[^ \n{MARK}]+|[ \n]+")
WITHOUT_BLANKS = re.compile(rf"{MARK}|[{LETTERS}]+{AFTER}|[^ \n{MARK}]+")
#: Pieces of Latin letters, which normalisation and word rules leave alone (but for their case).
PLAIN = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: A blank that INSEPARABLE may be about; quick to search for.
LOOSE_BLANK = re.compile(r" (?:\s|\Z)")
INSEPARABLE = re.compile(rf"\s (?:\s|\Z)|{MARK}")
TABLE_CHARACTERS = 10_000_000
#: Bytes of text worth handing over at a time: enough for words to repeat.
ENCODED_BYTES = 6_000_000


def byte_letters() -> dict[int, str]:
    """Translation of Latin-1 letters and the blank to the letters that stand for their UTF-8 bytes.

    The published rule of byte-level vocabularies: visible characters of Latin-1 stand for their own
    number, the other bytes, in ascending order, for the characters from 256 on.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    letter = {b: chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in (0x20, *range(0xC0, 0x100))}


class Codes(dict):
    """Numbers pieces in the order they are first met."""

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = code = len(self)
        return code


class WordEncoder:
    """Encodes texts; remembers pieces of TABLE_CHARACTERS in all (ids do not depend on what it remembers)."""

    def __init__(self, path: str, blanks: bool = True):
        """``blanks``: the vocabulary keeps blanks and case; else it drops white space and lower-cases."""
        self.pieces, self.lower = (WITH_BLANKS, False) if blanks else (WITHOUT_BLANKS, True)
        self.letters = byte_letters()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self._clear()

    def _clear(self) -> None:
        self.codes = Codes({MARK: 0})
        self.held = 0
        self.flat, self.sizes = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self) -> None:
        new, self.codes.new = self.codes.new, []
        model, letters = self.tokenizer.model, self.letters
        found: list = [None] * len(new)
        others = []
        for k, piece in enumerate(new):
            if PLAIN.fullmatch(piece):  # nothing but the model has a say in it
                text = (piece.lower() if self.lower else piece).translate(letters)
                found[k] = [t.id for t in model.tokenize(text)]
            else:
                others.append(k)
        for k, e in zip(others, self.tokenizer.encode_batch_fast([new[k] for k in others], add_special_tokens=False)):
            found[k] = e.ids
        self.held += sum(map(len, new))
        self.sizes = np.concatenate((self.sizes, np.fromiter(map(len, found), np.int64, len(found))))
        self.flat = np.concatenate((self.flat, np.array(list(chain.from_iterable(found)), np.uint32)))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of ids of each text."""
        whole = [k for k, t in enumerate(texts) if (LOOSE_BLANK.search(t) or MARK in t) and INSEPARABLE.search(t)]
        if not whole:
            return self._by_word(texts)
        rest = list(texts)
        for k in whole:
            rest[k] = ""
        flat, counts = self._by_word(rest)
        ends = np.cumsum(counts)
        ids = [self.tokenizer.encode(texts[k], add_special_tokens=False).ids for k in whole]
        for k, own in zip(whole, ids):
            counts[k] = len(own)
        return np.insert(flat, np.repeat(ends[whole], [len(x) for x in ids]), list(chain.from_iterable(ids))), counts

    def _by_word(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.held > TABLE_CHARACTERS:
            self._clear()
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        edges = lists.offsets.to_numpy()
        words = lists.flatten().dictionary_encode()
        word = words.indices.to_numpy().astype(np.int64) * 2
        if not self.lower:
            after_blank = np.ones(len(word), np.int64)
            after_blank[edges[:-1]] = 0
            word += after_blank
        strings = words.dictionary.to_pylist()
        seen = np.zeros(2 * len(strings), bool)
        seen[word] = True
        units = np.flatnonzero(seen)
        joined = MARK.join([" " + strings[u >> 1] if u & 1 else strings[u >> 1] for u in units.tolist()])
        codes = np.array(list(map(self.codes.__getitem__, self.pieces.findall(joined))), np.int64)
        self._learn()
        flat, sizes = ragged(self.flat, self.sizes, codes)
        into = np.concatenate(([0], np.cumsum(sizes)))
        sizes = np.diff(np.concatenate(([0], into[np.flatnonzero(codes == 0)], into[-1:])))[: len(units)]
        place = np.zeros(len(seen), np.int64)
        place[units] = np.arange(len(units))
        flat, sizes = ragged(flat, sizes, place[word])
        into = np.concatenate(([0], np.cumsum(sizes)))
        return flat, np.diff(into[edges])


def ragged(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen lists, one after the other, out of lists of the given sizes in ``flat``; and their sizes."""
    begins = np.cumsum(sizes) - sizes
    chosen = sizes[which]
    ends = np.cumsum(chosen)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    place = np.repeat((begins[which] - (ends - chosen)).astype(kind), chosen)
    place += np.arange(total, dtype=kind)
    return flat.take(place), chosen


def with_end(flat: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The ids of each text followed by the end id."""
    out = np.full(len(flat) + len(counts), end_id, flat.dtype)
    at = 0
    for k, n in enumerate(counts.tolist()):
        out[at + k : at + k + n] = flat[at : at + n]
        at += n
    return out


def encoder(path: str, blanks: bool = True) -> WordEncoder:
    """The process's encoder for ``path``. It hangs on the tokenizers module, which outlives a task."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_word_encoders", {})
    if (path, blanks) not in held:
        held[path, blanks] = WordEncoder(path, blanks)
    return held[path, blanks]
