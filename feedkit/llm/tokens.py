"""Token ids of whole texts by a public tokenizer's library, inside tasks."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

#: How the tokenizer cuts lower-cased text into pieces, each encoded alone (fixed value, from its file).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for text of ASCII and Latin letters without marks to compose, and anything else.
PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
ODD = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]")
PIECES_KEPT = 1_000_000
#: Bytes that are looked up together, and the longest piece that is.
SEGMENT, LONGEST = 1 << 20, 255

# Plain text as bytes: lower case (A-Z, and of the Latin letters the second byte), what a byte belongs to, and two
# tables and factors to hash pieces with.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[0x80:0x9F] += 32
SPACE, LETTER, DIGIT, SIGN = range(4)
CLASS = np.full(256, SIGN, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
CLASS[48:58] = DIGIT
CLASS[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = LETTER
TABLES = np.random.default_rng(11).integers(1, 1 << 63, (2, 256), dtype=np.uint64)
POWERS = np.array([[pow(f, k, 1 << 64) for k in range(LONGEST + 1)] for f in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)], np.uint64)


class WordEncoder:
    """Ids of a tokenizer that lower-cases, drops white space and encodes pieces alone, whose last ids are marked (``</w>``).

    The ids of a text are then those of its pieces in a row. Pieces that come again are looked up; new ones
    are encoded by the library, many at once. Words with other signs, or with the tokenizer's special strings,
    are handed to the library as they stand, and so are whole texts if its file says that it works otherwise.
    The lookup is emptied when it is full. Texts of plain letters, digits and signs are cut and looked up as arrays,
    by two 64-bit hashes of each piece.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.last = np.zeros(size, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        about = json.loads(self.library.to_str())
        self.special = re.compile("|".join(re.escape(t["content"]) for t in about["added_tokens"]) or r"(?!)")
        self.opens = {t["content"][:1].encode() for t in about["added_tokens"]}  # what special strings begin with
        self.by_piece = _cut(about) == PATTERN and about["model"].get("end_of_word_suffix") == "</w>"
        self.pieces: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.pieces.clear()
        self.hashes = np.empty((2, 0), np.uint64)  # of known pieces, in order of the first
        self.spans = np.empty((2, 0), np.int64)  # where their ids begin in ``flat``, and how many
        self.flat = np.empty(0, self.dtype)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """For each text its ids, little-endian, as ``dtype``."""
        if not self.by_piece:
            return [x.tobytes() for x in self._ids([t.decode() for t in texts])]
        if len(self.pieces) + self.hashes.shape[1] > PIECES_KEPT:
            self._forget()
        out: list[list[bytes]] = [[] for _ in texts]
        plain: list[tuple[int, bytes]] = []
        size, other = 0, []

        def settle() -> None:
            nonlocal plain, size
            if plain:
                for (i, _), ids in zip(plain, self._encode_plain([t for _, t in plain]), strict=True):
                    out[i].append(ids)
            plain, size = [], 0

        for i, text in enumerate(texts):
            if b"'" in text or any(sign in text for sign in self.opens) or ODD.search(text.decode()):
                other.append(i)
                continue
            for part in segments(text):
                if size + len(part) > SEGMENT:
                    settle()
                plain.append((i, part))
                size += len(part)
        settle()
        for i, ids in zip(other, self._encode_words([texts[i] for i in other]), strict=True):
            out[i].append(ids)
        return [b"".join(parts) for parts in out]

    def _encode_plain(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts without odd signs, by their pieces' hashes."""
        data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        kind = CLASS[data]
        new = np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, len(data)))
        some = kind[start] != SPACE
        if not some.any():
            return [b""] * len(texts)
        if int(length[some].max()) > LONGEST:
            return self._encode_words(texts)
        place = np.arange(len(data), dtype=np.int32) - np.repeat(start.astype(np.int32), length)
        place = np.minimum(place, LONGEST, out=place).astype(np.uint8)
        hashes = []
        for table, powers in zip(TABLES, POWERS, strict=True):
            value = table[data]
            value *= powers[place]
            hashes.append(np.add.reduceat(value, start)[some])
        del value, place
        start, length = start[some], length[some]
        first, index, inverse = np.unique(hashes[0], return_index=True, return_inverse=True)
        second = hashes[1][index]
        at = np.minimum(np.searchsorted(self.hashes[0], first), max(self.hashes.shape[1] - 1, 0))
        known = (self.hashes[0][at] == first) & (self.hashes[1][at] == second) if self.hashes.shape[1] else np.zeros(len(first), bool)
        missing = index[~known]
        if len(missing):
            raw = data.tobytes()
            self._add(hashes[0][missing], hashes[1][missing], [raw[s : s + n].decode() for s, n in zip(start[missing].tolist(), length[missing].tolist(), strict=True)])
            at = np.searchsorted(self.hashes[0], first)
        begin, count = self.spans[:, at[inverse]]
        stop = np.cumsum(count)
        ids = self.flat[np.repeat(begin - (stop - count), count) + np.arange(int(stop[-1]))].tobytes()
        ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = (np.append(0, stop)[np.append(0, np.searchsorted(start, ends))] * self.dtype.itemsize).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _add(self, first: np.ndarray, second: np.ndarray, pieces: list[str]) -> None:
        ids = self._learned(pieces)
        count = np.array([len(x) // self.dtype.itemsize for x in ids], np.int64)
        begin = len(self.flat) + np.cumsum(count) - count
        self.flat = np.append(self.flat, np.frombuffer(b"".join(ids), self.dtype))
        at = np.searchsorted(self.hashes[0], first)  # both in order
        self.hashes = np.insert(self.hashes, at, np.stack([first, second]), axis=1)
        self.spans = np.insert(self.spans, at, np.stack([begin, count]), axis=1)

    def _encode_words(self, texts: list[bytes]) -> list[bytes]:
        odd: dict[str, bytes] = {}
        split = [self._split(text, odd) for text in texts]
        known = self.pieces
        new = list(set().union(*split).difference(known, odd))
        known.update(zip(new, self._learned(new), strict=True))
        if odd:
            odd = dict(zip(odd, (x.tobytes() for x in self._ids([word[1:] for word in odd])), strict=True))
            return [b"".join([odd[p] if p in odd else known[p] for p in pieces]) for pieces in split]
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]

    def _split(self, text: bytes, odd: dict[str, bytes]) -> list[str]:
        """The pieces of a text; words for the library have a space before them and are noted in ``odd``."""
        plain = text.decode()
        if not ODD.search(plain) and not self.special.search(plain):
            return PIECE.findall(plain.lower())
        out: list[str] = []
        for word in map(bytes.decode, text.split()):
            if ODD.search(word) or self.special.search(word):
                odd[f" {word}"] = b""
                out.append(f" {word}")
            else:
                out += PIECE.findall(word.lower())
        return out

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learned(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces by the library, many in one text; each piece ends in one marked id."""
        out: list[bytes] = []
        for at in range(0, len(pieces), 20_000):
            some = pieces[at : at + 20_000]
            runs = [some[i : i + 500] for i in range(0, len(some), 500)]
            for run, ids in zip(runs, self._ids([" ".join(run) for run in runs]), strict=True):
                stops = np.flatnonzero(self.last[ids]) + 1
                if len(stops) != len(run):
                    out += [x.tobytes() for x in self._ids(run)]
                    continue
                data, start = ids.tobytes(), 0
                for stop in (stops * self.dtype.itemsize).tolist():
                    out.append(data[start:stop])
                    start = stop
        return out


def segments(text: bytes) -> list[bytes]:
    """The text, cut at white space where it is longer than ``SEGMENT``."""
    parts = []
    while len(text) > SEGMENT:
        cut = max(text.rfind(b" ", 0, SEGMENT), text.rfind(b"\n", 0, SEGMENT))
        if cut <= 0:
            break
        parts.append(text[:cut])
        text = text[cut:]
    return [*parts, text]


def _cut(about: dict) -> str | None:
    """The pattern that a tokenizer's file gives for its pieces, if lower-casing comes before it."""
    steps = (about.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    normal = [step.get("type") for step in (about.get("normalizer") or {}).get("normalizers") or []]
    return steps[0].get("pattern", {}).get("Regex") if normal == ["NFC", "Replace", "Lowercase"] else None


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One for each Python worker, kept between its tasks."""
    return WordEncoder(path)
