"""Text cut into short units that byte-level tokenizers treat independently.

A unit is a run of white space with the non-space run after it. Under the pre-token pattern of the
byte-level vocabularies no token holds white space after another character, so a token ends where
a white-space run begins; tokens of a text are those of its units, one after the other. Invented
and natural words repeat, so each unit is encoded once and then looked up.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa

#: The characters with Unicode's White_Space property (fixed values).
WHITE_SPACE = (
    "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_UNIT = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]++|[{WHITE_SPACE}]++")

#: Entries of a worker's lookup table; when it is full, a new one takes over what is still used of it.
#: Bounds memory, not results.
TABLE_ENTRIES = 250_000
#: Longer units are encoded each time and not kept.
KEPT_CHARS = 64
#: Units joined into one text to be encoded.
JOINED = 64


#: What this Python worker keeps between tasks. Workers serve one operator after the other.
_kept: dict[tuple[str, ...], Any] = {}


def kept(key: tuple[str, ...], make: Callable[[], Any]) -> Any:
    """What the worker keeps under ``key``, made if it is missing; what others have left there goes."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Frees what other operators have left in this worker: for operators that keep nothing themselves."""
    _kept.clear()


_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACE_AND_WORD = re.compile(r" \S++")


def _cut_tail(unit: str) -> tuple[str, str] | None:
    """The unit before and from its trailing ASCII punctuation: after a letter that begins a token of its
    own, so the unit may be cut there."""
    if unit[-1] not in _PUNCTUATION:
        return None
    core = unit.rstrip(_PUNCTUATION)
    return (core, unit[len(core) :]) if core and core[-1].isalpha() and core[-1].isascii() else None


class UnitTable:
    """Unit to packed little-endian unsigned 32-bit ids, filled by ``encode`` on demand."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]]):
        self._encode = encode
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def pack(self, texts: list[str]) -> Iterator[bytes]:
        """The packed ids of each text, in order; what is new in any of them is encoded at once."""
        cut = [_UNIT.findall(text) for text in texts]
        if len(self._known) > TABLE_ENTRIES:
            self._known, self._older = {}, self._known
        missing = set().union(*cut).difference(self._known)
        if self._older:
            kept = missing.intersection(self._older)
            self._known.update(zip(kept, map(self._older.__getitem__, kept), strict=True))
            missing -= kept
        long = self._learn(missing)
        for units in cut:
            yield b"".join(map(self._known.__getitem__, units))
        for unit in long:
            del self._known[unit]

    def _learn(self, missing: set[str]) -> list[str]:
        """Puts the units into the table; returns those that are too long to stay."""
        known, cuts = self._known, {u: cut for u in missing if (cut := _cut_tail(u))}
        parts = set()
        for cut in cuts.values():
            parts.update(cut)
        wanted = list((missing.difference(cuts) | parts).difference(known))
        known.update(zip(wanted, self._encode(wanted), strict=True))
        for unit, (core, tail) in cuts.items():
            known[unit] = known[core] + known[tail]
        return [unit for unit in chain(wanted, cuts) if len(unit) > KEPT_CHARS]


class UnitMemo(dict):
    """Unit to packed ids, where ``encode`` takes one unit: what is new is encoded when it is met.

    For encoders that gain nothing from many units at once; units are then looked up a single time.
    """

    def __init__(self, encode: Callable[[str], bytes], older: UnitMemo | None = None):
        super().__init__()
        self._encode, self._older = encode, {} if older is None else older
        if older is not None:
            older._older = {}

    def __missing__(self, unit: str) -> bytes:
        ids = self._older.get(unit)
        if ids is None:
            cut = _cut_tail(unit)
            ids = self[cut[0]] + self[cut[1]] if cut else self._encode(unit)
        if len(unit) <= KEPT_CHARS:
            self[unit] = ids
        return ids

    def pack(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The packed ids of each text, in order."""
        for text in texts:
            yield b"".join(map(self.__getitem__, _UNIT.findall(text)))

    def renewed(self, entries: int) -> UnitMemo:
        """This table or, when it is full, a new one that takes over what is still used of it."""
        return self if len(self) <= entries else UnitMemo(self._encode, self)


def ids_of_units(units: list[str], encode: Callable[[list[str]], list], sizes: np.ndarray) -> list:
    """``encode(units)`` at the cost of fewer calls; ``sizes`` are the bytes that each id stands for.

    Units of a space and a word are joined into longer texts, and their ids cut where the units' bytes
    end. Where no token ends there, the tokenizer does not cut before spaces, and the units are encoded
    one by one.
    """
    words = [i for i, u in enumerate(units) if _SPACE_AND_WORD.fullmatch(u)]
    single = set(range(len(units))).difference(words)
    found: list = [None] * len(units)
    chunks = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
    for chosen, ids in zip(chunks, encode(["".join([units[i] for i in c]) for c in chunks]), strict=True):
        wanted = np.cumsum([len(units[i].encode()) for i in chosen])
        ends = np.cumsum(sizes[ids])
        cuts = np.searchsorted(ends, wanted)
        if ends[-1] != wanted[-1] or (ends[cuts] != wanted).any():
            single.update(chosen)
            continue
        begin = 0
        for i, end in zip(chosen, (cuts + 1).tolist(), strict=True):
            found[i] = ids[begin:end]
            begin = end
    rest = sorted(single)
    for i, ids in zip(rest, encode([units[i] for i in rest]), strict=True):
        found[i] = ids
    return found


#: Before this character, letters are the same to all libraries.
_SETTLED = "\u0530"


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for.

    Printable bytes of Latin-1 stand for themselves, the others in order for the characters from 256.
    """
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


#: Packs few ids without a format to be read each time.
_PACKS = [struct.Struct(f"<{n}I").pack for n in range(33)]


def packed(ids: list[int]) -> bytes:
    return _PACKS[len(ids)](*ids) if len(ids) < len(_PACKS) else struct.pack(f"<{len(ids)}I", *ids)


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library: ids of units, and the bytes of each id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self._model = self.tokenizer.model
        byte, self.entries = byte_characters(), []
        for i in range(self.tokenizer.get_vocab_size()):
            entry = self.tokenizer.id_to_token(i) or ""
            known = all(c in byte for c in entry)
            self.entries.append(bytes(byte[c] for c in entry) if known else entry.encode())
        self._sizes = np.array([len(e) for e in self.entries])
        self._characters = {b: c for c, b in byte.items()}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of_word(self, unit: str) -> list[int] | None:
        """The ids of a space and letters, one pre-token, which the model takes as it is; else None."""
        word = unit[1:]
        if word.isalpha() and unit[0] == " ":
            if unit.isascii():
                return [token.id for token in self._model.tokenize(self._characters[32] + word)]
            if max(word) < _SETTLED:
                mapped = unit.encode().decode("latin-1").translate(self._characters)
                return [token.id for token in self._model.tokenize(mapped)]
        return None

    def ids_of_unit(self, unit: str) -> list[int]:
        """As ``encode``, of one unit."""
        ids = self.ids_of_word(unit)
        return self.tokenizer.encode(unit, add_special_tokens=False).ids if ids is None else ids

    def ids(self, units: list[str]) -> list[list[int]]:
        """As ``encode``, words by the model alone."""
        found = [self.ids_of_word(unit) for unit in units]
        others = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(others, ids_of_units([units[i] for i in others], self.encode, self._sizes), strict=True):
            found[i] = ids
        return found


def text_slices(batch: pa.RecordBatch, column: str, chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``chars`` bytes of text, so that long texts do not pile up."""
    lengths = batch.column(column).fill_null("")
    sizes = pa.compute.binary_length(lengths).to_pylist()
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > chars:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < batch.num_rows:
        yield batch.slice(begin)
