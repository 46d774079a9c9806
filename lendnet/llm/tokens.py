"""Token ids by a public tokenizer file, with a per-worker cache of pieces.

Both vocabularies cut a text at white space before merging, so a piece between blanks has the same ids
wherever it stands; a worker encodes each distinct piece once (in batches, by the ``tokenizers``
library) and joins the cached ids. A text with odd spacing is cut by a pattern instead of a plain
split, and one that holds a special token's string or control separators is encoded whole.
"""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np

WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
# white space other than blank and line feed, by which a text counts as oddly spaced
RARE_ASCII = ("\t", "\x0b", "\x0c", "\r")
RARE = tuple(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# where the libraries may differ on white space, or a special token's string stands: encoded whole
WHOLE_ASCII = ("\x00", "\x1c", "\x1d", "\x1e", "\x1f", "<|endoftext|>", "<|startoftext|>")
WHOLE = ("\u180e", "\u200b", "\ufeff")
MAX_PIECES = 600_000         # entries of a worker's young generation (about 120 MB; the old one is as large)
TAIL = tuple(".,;:!?")
BLANK = "\u0120"            # a blank, as byte-level vocabularies write it
LINE = "\n\n"               # marks a piece that starts a line, so has no leading blank


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as one visible character: printable Latin-1 bytes as
    themselves, the others as the characters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_LETTERS = _byte_letters()


def _little(ids: array) -> bytes:
    if ids.itemsize != 4 or sys.byteorder != "little":
        return np.array(ids, dtype="<u4").tobytes()
    return ids.tobytes()


def _has(text: str, strings) -> bool:
    return any(x in text for x in strings)


class Encoder:
    """Text -> little-endian unsigned 32-bit ids. ``spaced``: a leading blank belongs to the piece."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        # a leading blank is part of a word's piece in byte-level vocabularies without word-end marks
        self.spaced = self.tok.model.end_of_word_suffix is None
        self.parts: dict[str, bytes] = {}      # by exact string
        # by piece between blanks (each piece stands in one of the two); the same thing where a blank does not count
        self.cache: dict[str, bytes] = {} if self.spaced else self.parts
        self.old: dict[str, bytes] = {}        # of the generation before
        self.old_cache: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> list[bytes]:
        out = self.tok.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in out]

    def _words(self, pieces: list[str]) -> list[bytes | None]:
        """Ids of pieces that are one run of letters (the pre-tokenizer keeps those whole), straight
        from the merge model; None for any other piece."""
        merge, normal = self.tok.model.tokenize, self.tok.normalizer
        out: list = []
        for p in pieces:
            word = p[1:] if self.spaced and p[:1] == " " else p
            if normal is not None and word.isalpha():
                p = word = word.lower() if word.isascii() else normal.normalize_str(word)
            if word.isalpha() and max(word) < "\u1e00":
                out.append(_little(array("I", [t.id for t in merge(
                    (p if p.isascii() and not self.spaced else p.encode().decode("latin-1").translate(_LETTERS)))])))
            else:
                out.append(None)
        return out

    def _exact(self, strings) -> None:
        """Add ``strings`` to ``parts``; a word with one closing mark is built from its two parts."""
        parts, old = self.parts, self.old
        split, base = {}, set()
        for p in strings:
            if p in old:
                parts[p] = old[p]
                continue
            head = p[:-1].lstrip(" ")
            if p and p[-1:] in TAIL and head.isalpha() and head.lower().isalpha():
                split[p] = (p[:-1], p[-1])
                base.update(split[p])
            else:
                base.add(p)
        for p in base & old.keys():
            parts[p] = old[p]
        todo = [p for p in base if p not in parts]
        ids = self._words(todo)
        other = [p for p, x in zip(todo, ids) if x is None]
        parts.update(zip(todo, ids))
        parts.update(zip(other, self._ids(other)))
        for p, (head, tail) in split.items():
            parts[p] = parts[head] + parts[tail]

    def _learn(self, missing: list[str]) -> None:
        """Add pieces between blanks to ``cache``: words and words with one closing mark straight from the merge
        model (behind a blank, where one belongs to the piece), the others through ``_exact``."""
        cache, spaced, normal, merge = self.cache, self.spaced, self.tok.normalizer, self.tok.model.tokenize
        old = self.old_cache if spaced else self.old
        words, marked, other = [], [], []
        for p in missing:
            if p in old:
                cache[p] = old[p]
            elif p.isalpha():
                words.append(p)
            elif p[-1:] in TAIL and p[:-1].isalpha() and (spaced or p[:-1].lower().isalpha()):
                marked.append(p)
                words.append(p[:-1])
            else:
                other.append(p)
        lead = BLANK if spaced else ""
        for p in words:
            if p in cache:
                continue
            if p.isascii():
                ids = merge(lead + (p if normal is None else p.lower()))
            else:
                w = p if normal is None else normal.normalize_str(p)
                if not w.isalpha() or max(w) >= "\u1e00":
                    other.append(p)
                    continue
                ids = merge(lead + w.encode().decode("latin-1").translate(_LETTERS))
            cache[p] = _little(array("I", [t.id for t in ids]))
        tails = {c: self._ids([c])[0] for c in {p[-1] for p in marked}}
        if spaced:
            real = {p: p if p == "\n" else p[2:] if p.startswith(LINE) else " " + p for p in other}
            kept, self.parts = self.parts, {}
            self._exact(set(real.values()))
            for p, x in real.items():
                cache[p] = self.parts[x]
            self.parts = kept
        else:
            self._exact(set(other))
        for p in marked:
            cache[p] = cache[p[:-1]] + tails[p[-1]]

    def _pieces(self, text: str) -> tuple[dict, list[str]] | None:
        """(cache, its keys) for ``text``; None where it must be encoded whole."""
        ascii_ = text.isascii()
        if _has(text, WHOLE_ASCII) or not ascii_ and _has(text, WHOLE):
            return None
        if not self.spaced:
            return self.cache, text.split()
        if (_has(text, ("  ", "\n\n", " \n", "\n ")) or text[:1] in " \n" or text[-1:] in " \n"
                or _has(text, RARE_ASCII) or not ascii_ and _has(text, RARE)):
            return self.parts, CHUNK.findall(text)
        return self.cache, (LINE + text.replace("\n", " \n " + LINE)).split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text; the new pieces of the whole list go to the tokenizer in one batch."""
        if len(self.parts) + (len(self.cache) if self.spaced else 0) > MAX_PIECES:
            self.old, self.parts = self.parts, {}
            if self.spaced:
                self.old_cache, self.cache = self.cache, {}
            else:
                self.cache = self.parts
        out: list = [None] * len(texts)
        again, missing, exact = [], set(), set()
        for i, t in enumerate(texts):
            cut = self._pieces(t)
            if cut is None:
                out[i] = self._ids([t])[0]
                continue
            known, pieces = cut
            got = list(map(known.get, pieces))
            if None in got:
                holes = [j for j, g in enumerate(got) if g is None]
                (missing if known is self.cache else exact).update([pieces[j] for j in holes])
                again.append((i, known, pieces, got, holes))
            else:
                out[i] = b"".join(got)
        if exact:
            self._exact(exact)
        if missing:
            self._learn(list(missing))
        for i, known, pieces, got, holes in again:
            for j in holes:
                got[j] = known[pieces[j]]
            out[i] = b"".join(got)
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder of ``path``: kept for as long as the Python worker lives."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    kept = sys.modules[__name__].__dict__.setdefault("_kept", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def groups(texts: list, limit: int = 1 << 20):
    """Consecutive (lo, hi) ranges of about ``limit`` characters, so one list stays small in memory."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
