"""Token ids of whole texts with a byte-level tokenizer file, through a cache of text pieces.

A space between two characters that are not white space always starts a new piece in the
byte-level pre-tokenizer, so a text may be cut there and the pieces encoded apart: the ids
are those of the whole text (tests compare them). Frequent pieces come from a bounded cache;
a new piece of letters goes straight to the library's BPE model, all others to its whole
pipeline. Token spans follow from the ids: a byte-level token stands for a fixed number of
UTF-8 bytes, and the tokens of a text cover it without gaps.
"""

from __future__ import annotations

import os
from array import array
from operator import attrgetter

import numpy as np

from linclass.llm.text import KEPT

_ID = attrgetter("id")

#: White space other than the plain space and the line break: in ASCII, and beside it.
_ODD_ASCII = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_ODD = _ODD_ASCII + "".join(c for c in map(chr, range(128, 0x3001)) if c.isspace())

#: Pieces in each half (young, old) of the cache of one Python worker.
CACHE_PIECES = 300_000
#: Whole texts whose ids are kept for exact copies that come soon after.
CACHE_TEXTS = 2_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Pieces(dict):
    """Ids, as bytes, of a piece that follows a space; a missing one is encoded and kept."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # the byte-level alphabet: a visible character for each byte, asked of the library
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.space = level.pre_tokenize_str(" ")[0][0]
        self.shown: dict = {}
        for c in map(chr, [*range(0x800), *range(0x800, 0xD800, 0x400), *range(0xE000, 0x110000, 0x1000)]):
            self.shown.update(zip(c.encode(), level.pre_tokenize_str(c)[0][0], strict=True))
        self.old: dict = {}
        self.bare: dict = {}
        self.marks = {m: self.whole(m) for m in (",", ".", "\n")}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, before: str, p: str) -> bytes:
        """Ids of one pre-token: letters only, with or without the space before them."""
        shown = p if p.isascii() else p.encode().decode("latin-1").translate(self.shown)
        return array("I", list(map(_ID, self.model.tokenize(before + shown)))).tobytes()

    def start(self, p: str) -> bytes:
        """Ids of a piece without a space before it."""
        got = self.bare.get(p)
        if got is None:
            if p.isalpha():
                got = self.letters("", p)
            elif p[-1:] in (",", ".") and p[:-1].isalpha():
                got = self.letters("", p[:-1]) + self.marks[p[-1]]
            else:
                got = self.whole(p)
            if len(self.bare) > CACHE_PIECES // 4:
                self.bare.clear()
            self.bare[p] = got
        return got

    def __missing__(self, p: str) -> bytes:
        got = self.old.get(p)
        if got is None:
            if p.isalpha():
                got = self.letters(self.space, p)
            elif p[-1:] in (",", ".") and p[:-1].isalpha():  # letters and one mark are two pre-tokens
                got = self[p[:-1]] + self.marks[p[-1]]
            elif "\n" in p and p.split() == p.split("\n"):  # so is a single line break between two pieces
                head, *lines = p.split("\n")
                return self[head] + b"".join([self.marks["\n"] + self.start(x) for x in lines])
            else:
                got = self.whole(" " + p)
        self[p] = got
        return got

    def age(self) -> None:
        """Bound the cache: the younger half becomes the older, which is forgotten."""
        if len(self) > CACHE_PIECES:
            self.old = dict(self)
            self.clear()


def _plain(text: str, special: list[str]) -> bool:
    """Whether all white space of a text is single spaces and line breaks between other
    characters, and no special token is in it."""
    if "  " in text or "\n " in text or " \n" in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n" or any(s in text for s in special):
        return False
    return not any(c in text for c in (_ODD_ASCII if text.isascii() else _ODD))


class Encoder:
    """Ids of texts, and the bytes that each token stands for, for a tokenizer file at ``path``."""

    def __init__(self, path: str):
        self.cache = _Pieces(path)
        self.tokenizer = self.cache.tokenizer
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        self.texts: dict[str, bytes] = {}
        self.line_break = self.cache.marks["\n"]
        #: UTF-8 bytes of each id's text.
        self.n_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.n_bytes[i] = len(added[i].content.encode()) if i in added else len(token)

    def pieces(self, text: str) -> list[str]:
        """Cut a text at its single spaces. The first piece stands alone; the others are given
        without the space before them. Texts with special tokens stay whole, and so do places
        where a space touches other white space."""
        if self.special and any(s in text for s in self.special):
            return [text]
        parts = text.split(" ")
        if "" not in parts and list(map(str.strip, parts)) == parts:
            return parts
        out = [parts[0]]
        for p in parts[1:]:
            last = out[-1]
            if p and last and not p[0].isspace() and not last[-1].isspace():
                out.append(p)
            else:
                out[-1] = f"{last} {p}"
        return out

    def trim(self) -> None:
        """Keep only the younger half of the cache while the worker does other work."""
        self.cache.old = {}
        self.texts.clear()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        get, start, out = self.cache.__getitem__, self.cache.start, []
        for t in texts:
            got = self.texts.get(t) if t else b""
            if got is None:
                if _plain(t, self.special):
                    lines = [line.split(" ") for line in t.split("\n")]
                    got = self.line_break.join([start(c[0]) + b"".join(map(get, c[1:])) for c in lines])
                else:
                    cut = self.pieces(t)
                    got = start(cut[0]) + b"".join(map(get, cut[1:]))
                self.cache.age()
                if len(t) < 8192:
                    if len(self.texts) >= CACHE_TEXTS:
                        self.texts.clear()
                    self.texts[t] = got
            out.append(got)
        return out


#: The kind of tasks for which a worker keeps its encoders.
TOKENS = "tokens"


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; reused Python workers keep its cache between tasks, until
    one of another kind."""
    encoders = KEPT.setdefault(TOKENS, {})
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]
