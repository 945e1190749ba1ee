"""Token ids of blocks of whole texts, with the encodings of recent words kept by each worker.

The pre-tokenizer of byte-level BPE never joins a non-space character with a following space, so a
text may be cut before every space that follows a non-space character, and around every newline
between two non-space characters. Arrow makes these cuts and finds the distinct units of a block;
those are encoded by the tokenizers library, each once while it is remembered, and the ids of a
text are those of its units in order: exactly the ids of the whole text. The pre-tokenizer would
also cut a unit between letters and the ASCII marks behind them, so those are encoded on their own.
"""

from __future__ import annotations

import functools
import re
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: Text that is encoded at a time: the more, the more often its units repeat.
ENCODE_BYTES = 1 << 21
#: Units that a worker remembers: the newest, and as many that were in use before them.
REMEMBERED = 500_000

#: All white space, as str.isspace() has it.
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: Texts with it are cut with care: spaces behind white space, newlines that are not on their own.
_DOUBTFUL = rf"[{_SPACES}][ \n]|\n[{_SPACES}]|^\n|\n\z"
_CUT = re.compile(r"(?<=\S) ")
_LINES = re.compile(r"\S+(?:\n\S+)+")
#: Letters below it are letters by any edition of Unicode.
_PLAIN_END = "\u0250"
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


#: How byte-level vocabularies write a byte: printable ones as themselves, the others from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_WRITTEN = {b: 256 + i for i, b in enumerate(_OTHERS)}


class Units(dict):
    """From a unit to the ids of ``lead`` (a space or nothing) and the unit, as little-endian
    unsigned 32-bit integers. Units not yet known are encoded when they are asked for."""

    def __init__(self, tokenizer: Tokenizer, lead: str, bare: Units | None = None):
        super().__init__()
        self.lead, self.letter = lead, lead.translate(_WRITTEN)
        self.tokenizer, self.tokens = tokenizer, tokenizer.model.tokenize
        self.bare = self if bare is None else bare
        self.before: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, unit: str) -> bytes:
        found = self.before.get(unit)
        if found is None:
            word = unit.rstrip(_MARKS)
            if word.isalpha() and (word.isascii() or max(word) < _PLAIN_END):
                if len(word) < len(unit):
                    found = self[word] + self.bare[unit[len(word) :]]
                else:
                    if not word.isascii():
                        word = word.encode().decode("latin-1").translate(_WRITTEN)
                    ids = [token.id for token in self.tokens(self.letter + word)]
                    found = struct.pack(f"<{len(ids)}I", *ids)
            elif "\n" in unit and _LINES.fullmatch(unit):
                first, *rest = unit.split("\n")
                return self.bare["\n"].join([self[first], *map(self.bare.__getitem__, rest)])
            else:
                found = self._encode(self.lead + unit)
        self[unit] = found
        return found

    def age(self) -> None:
        """Forget the units that were not asked for since the last time, if there are many."""
        if len(self) > REMEMBERED // 2:
            self.before = dict(self)
            self.clear()


class Encoder:
    """Ids as the library gives them: the string of a special token in a text is that token."""

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        self.bare = Units(tokenizer, "")
        self.spaced = Units(tokenizer, " ", self.bare)

    def _line(self, unit: str) -> bytes:
        return self.bare["\n"] + self.bare[unit[1:]]

    def _whole(self, text: str) -> bytes:
        first, *rest = _CUT.split(text)
        return (self.bare[first] if first else b"") + b"".join(map(self.spaced.__getitem__, rest))

    def encode_block(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each followed by ``end`` if given, and how many each has.

        An empty or null text has no ids of its own.
        """
        self.bare.age()
        self.spaced.age()
        get = self.spaced.__getitem__
        texts = texts.fill_null("")
        doubtful = pc.match_substring_regex(texts, _DOUBTFUL)
        plain = pc.replace_substring(pc.if_else(doubtful, "", texts), "\n", " \n")
        units = pc.split_pattern(plain, " ")
        counts = pc.list_value_length(units).to_numpy().astype(np.int64)
        coded = units.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = coded.indices.to_numpy().astype(np.int64)
        begins = np.cumsum(counts) - counts
        # no space leads the first unit of a text
        heads = [distinct[c] for c in codes[begins]]
        codes[begins] = len(distinct) + np.arange(len(texts))
        found = [self._line(unit) if unit[:1] == "\n" else get(unit) for unit in distinct]
        found += [self.bare[head] if head else b"" for head in heads]
        for i in np.flatnonzero(doubtful.to_numpy(zero_copy_only=False)):
            found[len(distinct) + i] = self._whole(texts[i].as_py())
        if end is not None:
            codes = np.insert(codes, begins + counts, len(found))
            found.append(struct.pack("<I", end))
            counts += 1
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), "<u4")
        n = sizes[codes]
        until = np.cumsum(n)
        shift = (np.cumsum(sizes) - sizes)[codes] - (until - n)
        total = until[np.cumsum(counts) - 1]
        return pool[np.repeat(shift, n) + np.arange(n.sum())], np.diff(total, prepend=0)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; none for an empty or null one."""
        ids, counts = self.encode_block(pa.array(texts, pa.string()))
        return [found.tobytes() for found in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenizer_path(name: str = TOKENIZER) -> str:
    return public_tokenizers.path(name)
