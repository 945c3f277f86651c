"""Token ids of whole texts, piece by piece, each piece encoded once while it is remembered.

A piece is a run without ASCII white space. The tokenizer's own splitting never joins
characters across white space, so the ids of a text are those of its pieces in turn. A
piece of common Latin letters and signs is lower-cased and split as the tokenizer's file
says, and only the words not seen before go to the library's model; every other piece (other
scripts, control characters, special tokens, other tokenizers) goes to the library whole.
Memory is bounded by bytes: the first pieces and words seen stay, later ones are forgotten
now and then. Ids do not depend on what is remembered.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

KNOWN_BYTES = 48 << 20  # remembered for good, pieces and words each, a worker
RECENT_BYTES = 16 << 20  # and for a while
ENTRY = 180  # bytes of an entry besides its contents, about
STEP = 4096  # pieces the library encodes at once

# The splitting of the tokenizer files whose words are handled here, and the
# characters for which lower case and composition are plain.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = r"[\x21-\x7E\xA1-\xAC\xAE-įı-ňŊ-ž]*"


class _Memory:
    """Ids by piece or word, within a budget of bytes."""

    def __init__(self):
        self.known: dict = {}
        self.recent: dict = {}
        self.used = self.lately = 0

    def keep(self, found: dict) -> None:
        size = sum(map(len, found)) + sum(map(len, found.values())) + ENTRY * len(found)
        if self.used + size <= KNOWN_BYTES:
            self.known.update(found)
            self.used += size
            return
        if self.lately + size > RECENT_BYTES:
            self.recent.clear()
            self.lately = 0
        if size <= RECENT_BYTES:
            self.recent.update(found)
            self.lately += size


def _byte_level() -> dict[int, str]:
    """Code points to the characters that stand for their UTF-8 bytes: printable bytes for
    themselves, the others in turn from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in shown]
    sign = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(other)}
    return {c: "".join(sign[b] for b in chr(c).encode()) for c in range(0x21, 0x250)}


def _splits_plainly(spec: dict) -> bool:
    """Whether a tokenizer file lower-cases, splits by ``SPLIT`` and has a word-end model."""
    normal = (spec.get("normalizer") or {}).get("normalizers") or []
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    model = spec.get("model") or {}
    return (
        [n.get("type") for n in normal] == ["NFC", "Replace", "Lowercase"]
        and [p.get("type") for p in parts] == ["Split", "ByteLevel"]
        and parts[0]["pattern"] == {"Regex": SPLIT}
        and (parts[0]["behavior"], parts[0]["invert"]) == ("Removed", True)
        and not parts[1]["add_prefix_space"]
        and not parts[1]["use_regex"]
        and model.get("type") == "BPE"
        and model.get("dropout") is None
        and spec.get("post_processor") is None
        and not any(a.get("normalized") for a in spec.get("added_tokens") or [])
    )


class PieceEncoder:
    """Encodes UTF-8 texts with the tokenizer whose file's content is ``spec``."""

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        content = json.loads(spec)
        self.plain = regex.compile(PLAIN).fullmatch if _splits_plainly(content) else None
        self.special = [a["content"] for a in content.get("added_tokens") or []]
        self.split = regex.compile(SPLIT).findall
        self.signs = _byte_level()
        self.tokenize = self.tokenizer.model.tokenize
        top = max(self.tokenizer.get_vocab().values(), default=0) + 1
        self.as_bytes = [i.to_bytes(4, "little") for i in range(top)]
        self.pieces, self.words = _Memory(), _Memory()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        get, recent = self.pieces.known.get, self.pieces.recent.get
        out: list[list[bytes | None]] = []
        gaps: list[tuple[list[bytes | None], list[bytes], list[int]]] = []
        missing: set[bytes] = set()
        for raw in texts:
            pieces = raw.split()
            ids = list(map(get, pieces))
            out.append(ids)
            if None in ids:
                at = [k for k, i in enumerate(ids) if i is None]
                for k in at:
                    ids[k] = recent(pieces[k])
                    if ids[k] is None:
                        missing.add(pieces[k])
                gaps.append((ids, pieces, at))
        if missing:
            found = self._encoded(list(missing))
            for ids, pieces, at in gaps:
                for k in at:
                    if ids[k] is None:
                        ids[k] = found[pieces[k]]
            self.pieces.keep(found)
        return [b"".join(ids) for ids in out]

    def _encoded(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        if self.plain is None:
            return self._whole(pieces)
        texts = b" ".join(pieces).decode().split(" ")
        rest: list[bytes] = []
        if not self.plain("".join(texts)) or any(s in t for s in self.special for t in texts):
            odd = [not self.plain(t) or any(s in t for s in self.special) for t in texts]
            rest = [p for p, o in zip(pieces, odd) if o]
            pieces = [p for p, o in zip(pieces, odd) if not o]
            texts = [t for t, o in zip(texts, odd) if not o]
        found, new = {}, {}
        get, recent, split, tokens = self.words.known.get, self.words.recent.get, self.split, self._word
        for piece, text in zip(pieces, texts):
            word = text.lower()
            if word.isalpha():
                own = get(word) or recent(word) or new.get(word)
                if own is None:
                    own = new[word] = tokens(word)
            else:
                ids = []
                for part in (word[:-1], word[-1]) if word[:-1].isalpha() else split(word):
                    own = get(part) or recent(part) or new.get(part)
                    if own is None:
                        own = new[part] = tokens(part)
                    ids.append(own)
                own = b"".join(ids)
            found[piece] = own
        self.words.keep(new)
        return found | self._whole(rest)

    def _word(self, word: str) -> bytes:
        text = word if word.isascii() else word.translate(self.signs)
        as_bytes = self.as_bytes
        return b"".join([as_bytes[t.id] for t in self.tokenize(text)])

    def _whole(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Pieces through the whole tokenizer, some thousands in one text."""
        out = {}
        for lo in range(0, len(pieces), STEP):
            some = pieces[lo : lo + STEP]
            texts = [p.decode() for p in some]
            found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            starts = np.zeros(len(texts), np.int64)
            np.cumsum(lengths[:-1] + 1, out=starts[1:])
            at = np.fromiter((o[0] for o in found.offsets), np.int64, len(found.ids))
            cuts = np.searchsorted(at, starts, "left").tolist() + [len(at)]
            data = np.asarray(found.ids, "<u4").tobytes()
            for piece, i, j in zip(some, cuts, cuts[1:]):
                out[piece] = data[4 * i : 4 * j]
        return out


@lru_cache(maxsize=2)
def encoder(spec: str) -> PieceEncoder:
    return PieceEncoder(spec)
