"""Pre-tokens and token ids of whole texts, from the pieces between spaces.

The tokenizer files used here drop white space and treat what lies between as independent,
so the ids of a text are the ids of its space-free pieces, one after another. Only ASCII white
space is cut at; other white space stays inside a piece and is left to the tokenizer. A worker
remembers what it has found for pieces or pre-tokens it has seen, up to a bound. Of many texts
some are taken together: each distinct piece is cut once for all of them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise
from struct import pack
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Pieces that one worker remembers (twice so many just after a change), and the longest.
REMEMBERED = 250_000
LONGEST = 64
#: Bytes of the texts that are taken together, where none is longer itself.
TOGETHER = 4_000_000

# Printable ASCII and precomposed Latin letters: nothing to compose, and one letter is one
# letter after lower-casing, so pieces of these can be cut without the tokenizer's own steps.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# Pieces come alone or one a line.
_OTHER_LINE = re.compile(r"^[!-~À-ÖØ-öø-ÿ]*[^\n!-~À-ÖØ-öø-ÿ].*$", re.MULTILINE)
_PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|\n|[^a-zß-öø-ÿ0-9\n]+")
# Stands for the end of a line among ids; no token has it.
_END_OF_LINE = 0xFFFFFFFF


class Memory(dict):
    """Remembers ``find(piece)``; what was not asked for lately is forgotten first."""

    def __init__(self, find: Callable[[bytes], Any], size: int = REMEMBERED) -> None:
        super().__init__()
        self.find, self.size, self.older = find, size, {}

    def __missing__(self, piece: bytes) -> Any:
        found = self.older.get(piece)
        if found is None:
            found = self.find(piece)
        if len(piece) <= LONGEST:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found

    def of_all(self, pieces: list) -> dict:
        """Each of these distinct pieces with what ``find`` gives."""
        out = dict(zip(pieces, map(self.get, pieces), strict=True))
        missing = [piece for piece, found in out.items() if found is None]
        again = dict(zip(missing, map(self.older.get, missing), strict=True))
        new = [piece for piece, found in again.items() if found is None]
        again.update(zip(new, map(self.find, new), strict=True))
        out.update(again)
        short = [piece for piece in missing if len(piece) <= LONGEST][: self.size]
        if len(self) + len(short) > self.size:
            self.older = dict(self)
            self.clear()
        self.update(zip(short, map(again.__getitem__, short), strict=True))
        return out


class Words:
    """A tokenizer file, seen piece by piece."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.normalizer = self.tokenizer.normalizer
        self.splitter = self.tokenizer.pre_tokenizer
        self.model = self.tokenizer.model
        self.specials = [
            token.content for token in self.tokenizer.get_added_tokens_decoder().values()
        ]
        letters = "".join(map(chr, [*range(0x21, 0x7F), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
        cut = (self.splitter.pre_tokenize_str(c)[0][0] for c in letters)
        self.written = str.maketrans(dict(zip(letters, cut, strict=True)))
        self.plain = self._plain_works()
        self.remembered = Memory(self.ids_of_piece)
        self.remembered_pretokens = Memory(self._ids_of_pretoken)

    def _plain_works(self) -> bool:
        """Whether the short cut gives what this tokenizer gives."""
        probe = "It's a TEST's 12ab3 ÀÉÜß-éà'LL?!x'd"
        return all(
            self._short(piece) == self._long(piece) for piece in probe.split()
        )

    def _short(self, piece: str) -> list[str]:
        return [x.translate(self.written) for x in _PRETOKEN.findall(piece.lower())]

    def _long(self, piece: str) -> list[str]:
        return [x for x, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(piece))]

    def has_special(self, piece: str) -> bool:
        return any(special in piece for special in self.specials)

    def pretokens(self, piece: str) -> list[str]:
        """What the model gets to see of a piece without special tokens."""
        if self.plain and _PLAIN.fullmatch(piece):
            return self._short(piece)
        return self._long(piece)

    def ids_of_piece(self, piece: bytes) -> bytes:
        """Little-endian unsigned 32-bit integers."""
        text = piece.decode()
        if self.has_special(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = [t.id for x in self.pretokens(text) for t in self.model.tokenize(x)]
        return np.array(ids, "<u4").tobytes()

    def ids_of_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """``ids_of_piece`` of each distinct piece; those with a short cut are cut together."""
        text = b"\n".join(pieces).decode()
        if not self.plain:
            other = set(pieces)
        else:
            other = {line.encode() for line in _OTHER_LINE.findall(text)}
            if self.has_special(text):
                other.update(p for p in pieces if self.has_special(p.decode()))
        if not other:
            return self._ids_of_plain(pieces)
        plain = [p for p in pieces if p not in other]
        found = dict(zip(plain, self._ids_of_plain(plain), strict=True))
        return [found[p] if p in found else self.remembered[p] for p in pieces]

    def _ids_of_plain(self, pieces: list[bytes]) -> list[bytes]:
        if not pieces:
            return []
        cut = _PRETOKEN.findall((b"\n".join(pieces) + b"\n").decode().lower())
        known = self.remembered_pretokens.of_all(list(set(cut) - {"\n"}))
        known["\n"] = pack("<I", _END_OF_LINE)
        ids = b"".join(map(known.__getitem__, cut))
        ends = (4 * np.flatnonzero(np.frombuffer(ids, "<u4") == _END_OF_LINE)).tolist()
        return [ids[a + 4 : b] for a, b in zip([-4, *ends], ends, strict=False)]

    def _ids_of_pretoken(self, pretoken: str) -> bytes:
        """Of a pre-token as ``_PRETOKEN`` cuts it."""
        ids = [t.id for t in self.model.tokenize(pretoken.translate(self.written))]
        return pack(f"<{len(ids)}I", *ids)

    def count(self, pretoken: str) -> int:
        """Pieces that the model makes of a pre-token."""
        return len(self.model.tokenize(pretoken))

    def count_special(self, piece: str) -> int:
        return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def ids(self, text: str | None) -> bytes:
        return b"".join(map(self.remembered.__getitem__, (text or "").encode().split()))

    def ids_of_texts(self, texts: pa.Array) -> Iterator[bytes]:
        """``ids`` of each text, where a piece is looked up once for some texts."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
        first = np.flatnonzero(np.diff(ends // TOGETHER, prepend=-1)).tolist()
        for a, b in pairwise([*first, len(texts)]):
            yield from self._ids_together(texts.slice(a, b - a))

    def _ids_together(self, texts: pa.Array) -> Iterator[bytes]:
        cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        pieces = pc.dictionary_encode(cut.flatten())
        distinct = pieces.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self.ids_of_pieces(distinct), pa.large_binary()).take(pieces.indices)
        _, places, data = ids.buffers()
        at = np.frombuffer(places, np.int64)[cut.offsets.to_numpy()].tolist()
        for a, b in pairwise(at):
            yield data[a:b].to_pybytes() if b > a else b""


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    """One for each tokenizer file and worker process."""
    return Words(path)
