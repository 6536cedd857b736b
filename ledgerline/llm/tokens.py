"""Token ids by the tokenizers library, with pieces of text that recur encoded once.

Both kinds of tokenizer that are used here cut a text at white space before anything else, so a text's ids are those
of its pieces, joined. Where that could fail (rare white space, special tokens) the whole text goes to the library. A
piece that is one plain word, or one and a sign, needs no normalizing or further cutting: it goes to the library's
model at once.
"""

from __future__ import annotations

import json
import os
import re
from array import array

#: Pieces that a worker remembers; beyond it forgets all.
REMEMBERED = 1 << 19

_PIECES = re.compile(r" ?[^ \n\t\r]+|[ \n\t\r]+(?![^ \n\t\r])|[ \n\t\r]+")
_ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_ENDS = ".,;:!?|"
#: A run of these after a word is cut from it; not the apostrophe, which may be cut with the letters after it.
_SIGNS_AFTER = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_loaded: dict[int, Encoder] = {}


def _signs_of_bytes() -> dict[int, int]:
    """Byte-level BPE writes each byte as a printable sign: itself where it is one, else the next sign from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return dict(zip(plain, plain)) | {b: 256 + k for k, b in enumerate(rest)}


_SIGNS = _signs_of_bytes()


class _Known(dict):
    """Pieces and their ids; a piece that is missed is encoded."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece):
        if len(self) > REMEMBERED:
            self.clear()
        out = self[piece] = self.encode(piece)
        return out


class Encoder:
    """text -> its ids as little-endian unsigned 32-bit integers, in bytes."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        parts = json.loads(spec)
        kinds = [p["type"] for p in parts["normalizer"].get("normalizers", [])] if parts["normalizer"] else []
        before = parts["pre_tokenizer"] or {}
        split = [p for p in before.get("pretokenizers", []) if p["type"] == "Split"]
        #: White space is dropped: any run of it is a cut.
        self.dropped = kinds == ["NFC", "Replace", "Lowercase"] and bool(split) and split[0]["behavior"] == "Removed"
        #: A space goes with the word after it.
        self.kept = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not parts["normalizer"]
        self.special = [t["content"] for t in parts["added_tokens"]]
        self.ends = {c: self.whole(c) for c in _ENDS}
        plain = all(re.search("[A-Za-z0-9]", t) for t in self.special)  # else signs alone could be a special token
        self.known = _Known((self._bytes_piece if plain else lambda piece: self.whole(piece.decode())) if self.dropped else self._piece)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, piece: str) -> bytes | None:
        """Ids of a word of Latin letters, with a space before it or not and one sign after it or not; else None."""
        tail = b""
        if piece[-1] in _ENDS:
            tail, piece = self.ends[piece[-1]], piece[:-1]
        core = piece[1:] if piece[:1] == " " else piece
        if core.isascii():
            if not core.isalpha():
                return None
            signs = piece.replace(" ", "Ġ")
        elif _LATIN.fullmatch(core):
            signs = piece.encode().decode("latin-1").translate(_SIGNS)
        else:
            return None
        return array("I", [t.id for t in self.model.tokenize(signs)]).tobytes() + tail

    def _piece(self, piece: str) -> bytes:
        return self._word(piece) or self.whole(piece)

    def _bytes_piece(self, piece: bytes) -> bytes:
        """A word in capitals, or with signs after it, has the ids of the plain word and of the signs: those are encoded once for all of them."""
        core = piece.rstrip(_SIGNS_AFTER)
        if core.isalpha():
            plain = core.lower()
        elif not core.isascii() and _LATIN.fullmatch(text := core.decode()):
            plain = text.lower().encode()
        else:
            return self.whole(piece.decode())
        if plain != piece:
            return self.known[plain] + self.known[piece[len(core) :]] if len(core) < len(piece) else self.known[plain]
        signs = plain.decode() if plain.isascii() else plain.decode("latin-1").translate(_SIGNS)
        return array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()

    def __call__(self, text: str) -> bytes:
        if self.dropped:
            pieces = text.encode().split()  # at ASCII white space only
        elif self.kept and not _ODD.search(text) and not any(s in text for s in self.special):
            pieces = _PIECES.findall(text)
        else:
            return self.whole(text)
        return b"".join(map(self.known.__getitem__, pieces))


def encoder(spec: str) -> Encoder:
    """The worker's own encoder; it lasts from task to task."""
    key = hash(spec)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Encoder(spec)
    return _loaded[key]


def spec(spark, path: str):
    """The tokenizer file, read once by the driver and sent to the executors; a few MB."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())
