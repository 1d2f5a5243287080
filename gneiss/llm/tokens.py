"""Ids of whole texts as the tokenizers library gives them, with a bounded cache of pieces in each Python worker.

The splitting pattern of a byte-level vocabulary never continues past a space that follows a non-space character, so
the pieces that start at such spaces can be encoded on their own and their ids put together. Texts that hold the string
of an added token, and all texts of a tokenizer of another kind, go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

END_ID = 0
_SPACE_AFTER_SPACE = re.compile(r"\s ")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
#: Letters, and marks that the splitting pattern takes as one piece (no apostrophe: it may begin a contraction).
_LETTERS, _MARKS = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]{1,100}", r"[!-&(-/:-@\[-`{-~]{0,6}"
_WORD_AND_MARKS = re.compile(rf"( ?{_LETTERS})({_MARKS})(?:\n({_LETTERS})({_MARKS}))?").fullmatch
_CACHED_CHARS, _CACHE_ENTRIES, _MARK_ENTRIES, _TOGETHER = 48, 250_000, 10_000, 512


def _byte_chars() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 as is, others from U+0100 on."""
    as_is = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in as_is]
    return {b: chr(b) if b in as_is else chr(256 + others.index(b)) for b in range(256)}


_BYTE_CHARS = _byte_chars()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def splits_at_spaces(settings: dict) -> bool:
    """Whether pieces can be encoded on their own: plain byte-level pairs behind the usual splitting pattern alone."""
    splitter, model = settings["pre_tokenizer"] or {}, settings["model"]
    plain_text = not any(settings.get(k) for k in ("normalizer", "truncation", "padding"))
    plain_model = model["type"] == "BPE" and not any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    )
    usual = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
    return plain_text and plain_model and usual


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, equal to ``encode(text, add_special_tokens=False)`` of the file.

    The cache has two generations: a full one becomes the old one, and what is found there moves to the new one, so
    frequent pieces stay and single ones go.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        settings = json.loads(self.library.to_str())
        self.by_pieces = splits_at_spaces(settings)
        added = [re.escape(t["content"]) for t in settings["added_tokens"] if t["content"]]
        self.added = re.compile("|".join(added)) if added else None
        self.id_bytes = [i.to_bytes(4, "little") for i in range(max(self.library.get_vocab().values()) + 1)]
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        self.line_end = self._ids(["\n"])[0]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        """Ids of one run of letters with or without a space before it: the library's merges alone."""
        found = self.new.get(word) or self.old.get(word)
        if found is None:
            chars = word.replace(" ", "\u0120") if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_CHARS)
            table = self.id_bytes
            found = b"".join([table[k.id] for k in self.library.model.tokenize(chars)])
        self.new[word] = found
        return found

    def _mark(self, marks: str) -> bytes:
        if (found := self.marks.get(marks)) is None:
            if len(self.marks) > _MARK_ENTRIES:
                self.marks = {"": b""}
            found = self.marks[marks] = self._ids([marks])[0]
        return found

    def _add(self, missing: set[str]) -> None:
        """Find pieces that are not in the new generation: words, closing marks and a line end apart, others by the whole library."""
        rest, word, mark, line_end, new, old = [], self._word, self._mark, self.line_end, self.new, self.old
        for x in missing:
            if x in old:
                new[x] = old[x]
            elif m := _WORD_AND_MARKS(x):
                first, end, second, last = m.groups()
                if second:
                    new[x] = word(first) + mark(end) + line_end + word(second) + mark(last)
                elif end:
                    new[x] = word(first) + mark(end)
                else:
                    word(x)
            else:
                rest.append(x)
        for at in range(0, len(rest), _TOGETHER):
            part = rest[at : at + _TOGETHER]
            new.update(zip(part, self._ids(part), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for t in texts:
            if not self.by_pieces or (self.added and self.added.search(t)):
                out += self._ids([t])
                continue
            if len(self.new) > _CACHE_ENTRIES:
                self.old, self.new = self.new, {}
            if _SPACE_AFTER_SPACE.search(t):
                pieces = _BEFORE_SPACE.split(t)
            else:
                pieces = t.replace(" ", "\x00 ").split("\x00") if "\x00" not in t else _BEFORE_SPACE.split(t)
            found = list(map(self.new.get, pieces))
            if None in found:
                missing = {x for x, v in zip(pieces, found, strict=True) if v is None}
                self._add(missing)
                new = self.new
                found = [new[x] if v is None else v for x, v in zip(pieces, found, strict=True)]
                for x in [x for x in missing if len(x) > _CACHED_CHARS]:
                    del new[x]
            out.append(b"".join(found))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path)


def decoded(values: list[bytes | None]) -> list[str]:
    """Texts of UTF-8 bytes; null counts as empty."""
    return [(v or b"").decode("utf-8", "replace") for v in values]
