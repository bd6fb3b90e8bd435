"""Exact encoding of many texts with a tokenizers file, remembering the ids of repeated chunks.

Both pre-tokenizers used here cut a text at a single space between two non-space
characters, so the ids of a text are the ids of its chunks, one after the other.  A
chunk met before costs one dictionary look-up; a new one goes through the library.
Texts for which chunking is not provably the same (runs of white space, special token
strings, the control characters U+001C to U+001F) go through the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np

from casewise.llm.common import worker_state

#: Chunks, and characters of chunks, kept per worker; beyond it the memory starts anew.  Bounds memory, never results.
MEMORY = 350_000
MEMORY_CHARS = 15_000_000
#: Chunks looked up before their ids are gathered.  Bounds memory, never results.
GATHER = 300_000
#: Pieces of up to three characters whose ids are kept for good.
SHORT = 50_000


def _byte_letters() -> dict[int, str]:
    """Byte -> letter of byte-level BPE: printable Latin-1 stays, the others take U+0100 onwards in order."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


LETTERS = _byte_letters()
_LETTER, _DIGIT, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_SHORT = "'(?:s|t|re|ve|m|ll|d)"
#: The two files' splitting rules, spelled out for Latin-1 text (fixed values).
_RULES = {
    "byte": re.compile(rf"{_SHORT}| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"),
    "word": re.compile(rf"{_SHORT}|[{_LETTER}]+|[{_DIGIT}]|[^{_SPACE}{_LETTER}{_DIGIT}]+"),
}
_ODD = re.compile(r"\s\s|[\x1c-\x1f]|^\s|\s$")
_CONTROL = re.compile("[\x1c-\x1f]")


class Numbers(dict):
    """chunk -> its number; a chunk not met before gets the next one and is listed in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        self.new.append(chunk)
        return n


class ChunkEncoder:
    """``encode(texts)``: one int32 array of ids per text, equal to the library's without special tokens added.

    ``kind`` is "byte" (byte-level, white space kept) or "word" (lower-cased, white space dropped).
    """

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind, self.rule = kind, _RULES[kind]
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.short: dict[str, list[int]] = {}
        self.letters = str.maketrans({chr(b): c for b, c in LETTERS.items()})
        self._forget()

    def _forget(self) -> None:
        """The ids of chunk n are ``sizes[n]`` entries of ``ids`` from ``starts[n]`` on."""
        self.known, self.chars = Numbers(), 0
        self.sizes, self.starts, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def _bounded(self) -> Numbers:
        """The memory of chunks, begun anew if it has grown too large (no look-up may be pending)."""
        if len(self.known) > MEMORY or self.chars > MEMORY_CHARS:
            self._forget()
        return self.known

    @classmethod
    def get(cls, path: str, kind: str) -> ChunkEncoder:
        """This worker's encoder for the file."""
        return worker_state(f"encoder_{kind}_{path}", lambda: cls(path, kind), "tokens")

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)

    def chunk_ids(self, chunk: str) -> list[int]:
        if not chunk.isascii():
            try:
                chunk.encode("latin-1")
            except UnicodeEncodeError:
                return self.library.encode(chunk, add_special_tokens=False).ids
        out: list[int] = []
        for piece in self.rule.findall(chunk.lower() if self.kind == "word" else chunk):
            ids = self.short.get(piece)
            if ids is None:
                raw = piece if piece.isascii() else piece.encode().decode("latin-1")
                if self.kind == "byte" or not piece.isascii() or not piece.isprintable():
                    raw = raw.translate(self.letters)
                ids = [t.id for t in self.model.tokenize(raw)]
                if len(piece) < 4 and len(self.short) < SHORT:
                    self.short[piece] = ids
            out += ids
        return out

    def _chunks(self, text: str) -> list[str] | None:
        """Chunks whose ids make up the text's, or None if the whole text must go to the library."""
        if "<|" in text and any(s in text for s in self.special):
            return None
        if self.kind == "word":
            if _CONTROL.search(text):
                return None
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text.split()
            return text.lower().split()
        words = text.split()
        if " ".join(words) != text and _ODD.search(text):
            return self._loose_chunks(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]] if rest else [first]

    @staticmethod
    def _loose_chunks(text: str) -> list[str] | None:
        if _CONTROL.search(text):
            return None
        first, *rest = re.split(r"(?<=\S) (?=\S)", text)
        return [first, *[" " + x for x in rest]]

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text; null counts as empty."""
        out, todo, held = [], [], 0
        known = self._bounded()
        for text in texts:
            if not text:
                out.append(np.empty(0, np.int32))
                continue
            chunks = self._chunks(text)
            if chunks is None:
                out.append(self.whole(text))
                continue
            todo.append((len(out), np.fromiter(map(known.__getitem__, chunks), np.int32, len(chunks))))
            out.append(None)
            held += len(chunks)
            if held > GATHER:
                out, todo, held = self._gather(out, todo), [], 0
                known = self._bounded()
        return self._gather(out, todo)

    def _learn(self) -> None:
        """Encodes the chunks met for the first time."""
        new, self.known.new = self.known.new, []
        self.chars += sum(map(len, new))
        tokenize, lead = self.model.tokenize, LETTERS[0x20]
        ids: list[int] = []
        ends: list[int] = []
        for c in new:
            word = c[1:] if self.kind == "byte" else c
            if word.isalpha() and word.isascii() and (self.kind == "word" or c[0] == " "):
                # a plain word is one piece, its letters stand for themselves
                ids += [t.id for t in tokenize(lead + word if self.kind == "byte" else word.lower())]
            else:
                ids += self.chunk_ids(c)
            ends.append(len(ids))
        end = np.array(ends, np.int64)
        start = np.concatenate([[0], end[:-1]])
        self.starts = np.concatenate([self.starts, len(self.ids) + start])
        self.sizes = np.concatenate([self.sizes, end - start])
        self.ids = np.concatenate([self.ids, np.array(ids, np.int32)])

    def _gather(self, out: list, todo: list) -> list[np.ndarray]:
        if self.known.new:
            self._learn()
        for at, places in todo:
            n = self.sizes[places]
            before = np.cumsum(n) - n
            out[at] = self.ids[np.repeat(self.starts[places] - before, n) + np.arange(int(n.sum()))]
        return out


def byte_table(path: str) -> list[bytes]:
    """The bytes that each id of a byte-level file stands for."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    back = {c: b for b, c in LETTERS.items()}
    table = [b""] * tok.get_vocab_size(with_added_tokens=True)
    for token, i in tok.get_vocab(with_added_tokens=True).items():
        table[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return table
