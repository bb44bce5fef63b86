"""Token ids of whole texts, made chunk by chunk with a bounded cache."""

from __future__ import annotations

import re
import sys
import types

CACHE = 600_000      # parts of words, and chunks, kept per Python worker (each)
_GAP = re.compile("[ \n]")
# Printable ASCII and accented Latin-1 characters, and gaps.
_LATIN = re.compile("[ \n!-~À-ÿ]*")
# ---- fixed values: the pre-tokenizer's pattern, for lower-cased text of that kind --------------
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \n]+")
# ------------------------------------------------------------------------------------------------


def byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself where it is a printable
    Latin-1 character, else one of those from U+0100 on, in byte order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, more = [], 0x100
    for b in range(256):
        letters.append(chr(b) if b in plain else chr(more))
        more += b not in plain
    return letters


def worker_cache(name: str) -> dict:
    """A dictionary that outlives the task: Spark uses its Python workers again."""
    shared = sys.modules.setdefault("_obsmart_worker", types.ModuleType("_obsmart_worker"))
    return shared.__dict__.setdefault(name, {})


class ChunkEncoder:
    """Little-endian unsigned 32-bit ids of texts, by a `tokenizers` file whose normalizer and
    pre-tokenizer drop white space: then no token spans a space or line feed, and the ids of a
    text are those of its chunks between them. A text of Latin letters is cut into the
    pre-tokenizer's parts here, and only new parts go to the vocabulary; any other text is cut at
    its gaps, and new chunks go through the whole tokenizer."""

    def __init__(self, path: str, cache: int = CACHE):
        import numpy as np
        from tokenizers import Tokenizer

        self._np, self._tokenizer, self._most = np, Tokenizer.from_file(path), cache
        self._model, self._ids, self._part = self._tokenizer.model, worker_cache(f"ids {path}"), worker_cache(f"parts {path}")
        self._letters = byte_letters()
        self._four = [i.to_bytes(4, "little") for i in range(self._tokenizer.get_vocab_size())]

    def _of_latin(self, text: str) -> bytes:
        parts = _PARTS.findall(text.lower())
        known, four, tokenize = self._part, self._four, self._model.tokenize
        if len(known) > self._most:
            known.clear()
        for part in set(parts).difference(known):
            letters = part if part.isascii() else "".join([self._letters[b] for b in part.encode()])
            known[part] = b"".join([four[t.id] for t in tokenize(letters)])
        return b"".join(map(known.__getitem__, parts))

    def _of_any(self, text: str) -> bytes:
        chunks = _GAP.split(text)
        if len(self._ids) > self._most:
            self._ids.clear()
        new = list(set(chunks).difference(self._ids))
        for i in range(0, len(new), 4096):
            part = new[i:i + 4096]
            for chunk, e in zip(part, self._tokenizer.encode_batch(part, add_special_tokens=False)):
                self._ids[chunk] = self._np.array(e.ids, dtype="<u4").tobytes()
        return b"".join(map(self._ids.__getitem__, chunks))

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._of_latin(t) if _LATIN.fullmatch(t) and "<|" not in t else self._of_any(t) for t in texts]


def public_tokenizer(name: str) -> str:
    """Place of a public tokenizer file on this machine (the same on every executor)."""
    import public_tokenizers

    return public_tokenizers.path(name)
