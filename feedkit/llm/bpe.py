"""Byte-level BPE by a finite-state transducer, and decoding by a UTF-8 state machine.

A text is cut into pieces by the tokenizer's pattern and each piece is read byte by byte by a transducer compiled
from the merge ranks. Two facts make it one: any part of an encoding is the encoding of its own bytes, and a row of
tokens is an encoding if every two neighbours are (no merge that crosses their seam comes before those that made
them). That holds for files whose ranks are an order of merges, as training makes them. So after each byte exactly
one token can end there, and what follows depends only on the places where a later token may still begin. Such a
situation is a state; those that texts run into are numbered as they come up (lazy determinisation), a token is
emitted as soon as all places left agree on it, and no place is further back than the longest token.

At scale: documents stay where they are, there is no shuffle. What a Python worker keeps (pieces, transitions, seams) is
bounded and emptied when full, which costs time and never changes an id.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.tokens import LONGEST, POWERS, TABLES

#: What a worker keeps at most: pieces with their ids, transitions, seams.
PIECES_KEPT, STEPS_KEPT, SEAMS_KEPT = 800_000, 250_000, 250_000
#: Pieces of a text, and bytes of texts, that are worked on together.
PIECES, BATCH_BYTES = 100_000, 1 << 20
#: A place where no later token can begin.
DEAD = -1


def ranks_of(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, which are their ids, of a rank file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file) if token}


class Merges:
    """The merges of a rank file: which two parts a token is made from, and where merges cross a seam."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._seams: dict[tuple[int, int], bool] = {}

    def merged(self, data: bytes, below: int | None = None) -> list[int]:
        """Merge the bytes lowest rank first, leftmost first, as far as ranks lie ``below`` a limit."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [(self.ranks.get(a + b, -1), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, at = min(((r, i) for r, i in found if r >= 0 and (below is None or r < below)), default=(-1, 0))
            if rank < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge is the last that makes ``token``; None for a byte."""
        if token not in self._parts:
            data = self.token[token]
            made = self.merged(data, token) if len(data) > 1 else []
            self._parts[token] = (made[0], made[1]) if len(made) == 2 else None
        return self._parts[token]

    def reachable(self, token: int) -> bool:
        """Whether merging a token's bytes gives that token. One that does not is the id of a whole piece only."""
        return len(self.token[token]) == 1 or self.parts(token) is not None

    def seam_holds(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` side by side are the encoding of their bytes.

        Merges are undone at the seam, latest first. At each step the two tokens at the seam must not have merged
        before the merge that was undone last: one of a higher rank, or of the same rank further right.
        """
        if (left, right) in self._seams:
            return self._seams[left, right]
        if len(self._seams) >= SEAMS_KEPT:
            self._seams.clear()
        a, b, limit = left, right, len(self.token) + 1
        while True:
            across = self.ranks.get(self.token[a] + self.token[b], -1)
            if 0 <= across < limit:
                holds = False
                break
            undo_a, undo_b = self.parts(a), self.parts(b)
            if undo_a is None and undo_b is None:
                holds = True
                break
            if undo_b is None or (undo_a is not None and a > b):
                a, limit = undo_a[1], a  # of equal ranks the one on the left is merged first: at the seam, before the right token's
            else:
                b, limit = undo_b[0], b + 1  # the seam lies left of it and would be merged first at an equal rank
        self._seams[left, right] = holds
        return holds


#: A state: the places where a later token may begin and those that lead to them. Each has three numbers: the place
#: before, the token that ends there, and the trie's node for the bytes since. The first is where emitting stands.
State = tuple[int, ...]


class Transducer:
    """Ids of a piece, byte by byte. Transitions are worked out when first met."""

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        self._grow_trie()
        self._forget()

    def _grow_trie(self) -> None:
        """``child`` of (node << 8) | byte: a node that goes on, or for a token that none continues, -2 less the token."""
        known = self.merges.ranks
        tokens = [t for t, rank in known.items() if self.merges.reachable(rank)]
        inner = {b"": 0}
        for token in tokens:
            for i in range(1, len(token)):
                inner.setdefault(token[:i], len(inner))
        self.child: dict[int, int] = {}
        self.ends = [DEAD] * len(inner)  # the token that ends at a node
        for head, node in inner.items():
            if head:
                self.child[(inner[head[:-1]] << 8) | head[-1]] = node
        for token in tokens:
            if token in inner:
                self.ends[inner[token]] = known[token]
            else:
                self.child[(inner[token[:-1]] << 8) | token[-1]] = -2 - known[token]

    def _forget(self) -> None:
        start: State = (-1, -1, 0)
        self.numbers: dict[State, int] = {start: 0}
        self.states: list[State] = [start]
        self.steps: dict[int, int] = {}  # (state << 8) | byte -> (state << 1) | whether ids are emitted
        self.emitted: dict[int, list[int]] = {}

    def _step(self, state: State, byte: int) -> tuple[State, list[int]]:
        child, ends = self.child.get, self.ends
        before, tokens, nodes = list(state[::3]), list(state[1::3]), list(state[2::3])
        here = -1  # the token that ends here; one place alone has it
        for i, node in enumerate(nodes):
            if node == DEAD:
                continue
            node = child((node << 8) | byte, DEAD)
            if node != DEAD and here < 0:
                last = ends[node] if node >= 0 else -2 - node
                if last >= 0 and (tokens[i] < 0 or self.merges.seam_holds(tokens[i], last)):
                    here, origin = last, i
            nodes[i] = node if node >= 0 else DEAD
        if here < 0:
            raise ValueError(f"no token ends with byte {byte}; the rank file lacks single bytes")
        before.append(origin)
        tokens.append(here)
        nodes.append(0)
        hanging = [0] * len(nodes)  # places needed that hang on each
        for i in range(len(nodes) - 1, 0, -1):
            if nodes[i] != DEAD or hanging[i]:
                hanging[before[i]] += 1
        # emitting goes on while nothing is left to choose: no token may begin here, and one place alone hangs on it
        first, out = 0, []
        while nodes[first] == DEAD and hanging[first] == 1:
            place = first + 1
            while before[place] != first or not (nodes[place] != DEAD or hanging[place]):
                place += 1
            first = place
            out.append(tokens[first])
        after, number = [-1, tokens[first] if nodes[first] != DEAD else DEAD, nodes[first]], {first: 0}
        for i in range(first + 1, len(nodes)):
            if (nodes[i] != DEAD or hanging[i]) and before[i] in number:
                number[i] = len(number)
                after += number[before[i]], tokens[i], nodes[i]
        return tuple(after), out

    def _learn(self, key: int) -> int:
        after, emitted = self._step(self.states[key >> 8], key & 255)
        number = self.numbers.setdefault(after, len(self.states))
        if number == len(self.states):
            self.states.append(after)
        if emitted:
            self.emitted[key] = emitted
        step = self.steps[key] = (number << 1) | bool(emitted)
        return step

    def encode(self, piece: bytes) -> list[int]:
        """Ids of a piece. A piece that is itself a token is that token."""
        whole = self.merges.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.steps) > STEPS_KEPT:
            self._forget()
        at, out, steps = 0, [], self.steps
        for byte in piece:
            key = (at << 8) | byte
            step = steps.get(key)
            if step is None:
                step = self._learn(key)
            if step & 1:
                out += self.emitted[key]
            at = step >> 1
        state, rest = self.states[at], []
        i = len(state) // 3 - 1  # the last place is the end of the piece
        while i > 0:
            rest.append(state[3 * i + 1])
            i = state[3 * i]
        return out + rest[::-1]


#: What a byte of plain text is: the end of a text, white space, part of a letter, a digit, another sign.
END, WHITE, LETTER, DIGIT, SIGN = range(5)
KIND = np.full(256, SIGN, np.uint8)
KIND[0] = END
KIND[[9, 10, 11, 12, 13, 32]] = WHITE
KIND[48:58] = DIGIT
KIND[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = LETTER
#: What plain text lacks: other characters, and an apostrophe with a letter after it, where a piece may be a contraction.
ODD = regex.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]|'[a-z]")
#: A space that surely begins a piece.
BREAK = regex.compile(rb"(?<=[^\s]) (?=[^\s])")


class Encoder:
    """Ids of texts as 32-bit integers. Pieces that come again are looked up.

    Texts of plain letters, digits and signs are cut as arrays by what the public pattern says of them, and their pieces
    known by two 64-bit hashes; any other text, and any other pattern, is cut by the pattern itself.
    """

    def __init__(self, path: str, pattern: str):
        self.cut, self.public = regex.compile(pattern), pattern == public_tokenizers.PATTERN
        self.transducer = Transducer(ranks_of(path))
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.empty((2, 0), np.uint64)  # of known pieces, in order of the first
        self.spans = np.empty((2, 0), np.int64)  # where their ids begin in ``flat``, and how many
        self.flat = np.empty(0, "<i4")
        self.known: dict[str, bytes] = {}  # pieces of other texts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if self.hashes.shape[1] + len(self.known) > PIECES_KEPT:
            self._forget()
        out: list[list[np.ndarray]] = [[] for _ in texts]
        plain: list[tuple[int, bytes]] = []
        size = 0

        def settle() -> None:
            nonlocal plain, size
            if plain:
                for (i, _), ids in zip(plain, self._plain([part for _, part in plain]), strict=True):
                    out[i].append(ids)
            plain, size = [], 0

        for i, text in enumerate(texts):
            if not self.public or ODD.search(text):
                out[i] += self._by_pattern(text)
                continue
            for part in parts_of(text.encode()):
                plain.append((i, part))
                size += len(part)
                if size >= BATCH_BYTES:
                    settle()
        settle()
        return [np.concatenate(ids) if ids else np.empty(0, "<i4") for ids in out]

    def _by_pattern(self, text: str) -> Iterator[np.ndarray]:
        found = (m.group() for m in self.cut.finditer(text))
        while block := list(islice(found, PIECES)):
            for piece in set(block).difference(self.known):
                self.known[piece] = np.array(self.transducer.encode(piece.encode()), "<i4").tobytes()
            yield np.frombuffer(b"".join(map(self.known.__getitem__, block)), "<i4")
            if len(self.known) > PIECES_KEPT:
                self.known = {}

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        """A run of letters, digits or signs is a piece, with a space before it; white space but its last character is one."""
        data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        kind = KIND[data]
        solid, white = kind >= LETTER, kind == WHITE
        new = np.append(True, kind[1:] != kind[:-1])
        new[1:] &= ~(solid[1:] & (data[:-1] == 32))
        new[:-1] |= white[:-1] & solid[1:]
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, len(data)))
        some = kind[start] != END
        place = np.arange(len(data), dtype=np.int64) - np.repeat(start, length)
        place = np.minimum(place, LONGEST, out=place)
        first, second = (np.add.reduceat(table[data] * powers[place], start)[some] for table, powers in zip(TABLES, POWERS, strict=True))
        del place, kind, solid, white, new
        start, length = start[some], length[some]
        for i in np.flatnonzero(length > LONGEST).tolist():
            digest = hashlib.blake2b(data[start[i] : start[i] + length[i]].tobytes(), digest_size=16).digest()
            first[i], second[i] = np.frombuffer(digest, "<u8")
        distinct, index, inverse = np.unique(first, return_index=True, return_inverse=True)
        at = self._at(distinct)
        seen = np.zeros(len(distinct), bool)
        if self.hashes.shape[1]:
            seen = (self.hashes[0][at] == distinct) & (self.hashes[1][at] == second[index])
        new = index[~seen]
        if len(new):
            self._add(first[new], second[new], [data[s : s + n].tobytes() for s, n in zip(start[new].tolist(), length[new].tolist(), strict=True)])
            at = self._at(distinct)
        begin, count = self.spans[:, at[inverse]]
        stop = np.append(0, np.cumsum(count))
        ids = self.flat[np.repeat(begin - stop[:-1], count) + np.arange(int(stop[-1]))]
        ends = np.cumsum([len(t) + 1 for t in texts])
        cuts = stop[np.append(0, np.searchsorted(start, ends))].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _at(self, hashes: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.hashes[0], hashes), max(self.hashes.shape[1] - 1, 0))

    def _add(self, first: np.ndarray, second: np.ndarray, pieces: list[bytes]) -> None:
        ids = [self.transducer.encode(piece) for piece in pieces]
        count = np.array([len(x) for x in ids], np.int64)
        begin = len(self.flat) + np.cumsum(count) - count
        self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(ids), "<i4", int(count.sum())))
        at = np.searchsorted(self.hashes[0], first)  # both in order
        self.hashes = np.insert(self.hashes, at, np.stack([first, second]), axis=1)
        self.spans = np.insert(self.spans, at, np.stack([begin, count]), axis=1)


def parts_of(text: bytes) -> Iterator[bytes]:
    """The text in parts of about ``BATCH_BYTES``, cut where a piece begins."""
    at = 0
    while len(text) - at > BATCH_BYTES and (cut := BREAK.search(text, at + BATCH_BYTES)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


# ---------------------------------------------------------------- UTF-8, byte by byte

# What may follow in UTF-8. A state says which bytes may come next and which state they lead to;
# START also tells the bytes that begin a character.
START, ONE, TWO, THREE, AFTER_E0, AFTER_ED, AFTER_F0, AFTER_F4 = range(8)
NEXT = {
    START: [(0x00, 0x7F, START), (0xC2, 0xDF, ONE), (0xE0, 0xE0, AFTER_E0), (0xE1, 0xEC, TWO), (0xED, 0xED, AFTER_ED),
            (0xEE, 0xEF, TWO), (0xF0, 0xF0, AFTER_F0), (0xF1, 0xF3, THREE), (0xF4, 0xF4, AFTER_F4)],
    ONE: [(0x80, 0xBF, START)],
    TWO: [(0x80, 0xBF, ONE)],
    THREE: [(0x80, 0xBF, TWO)],
    AFTER_E0: [(0xA0, 0xBF, ONE)],
    AFTER_ED: [(0x80, 0x9F, ONE)],
    AFTER_F0: [(0x90, 0xBF, TWO)],
    AFTER_F4: [(0x80, 0x8F, TWO)],
}
MACHINE = [{byte: after for low, high, after in NEXT[state] for byte in range(low, high + 1)} for state in range(len(NEXT))]


def read_utf8(state: int, data: bytes) -> tuple[int, int, int]:
    """The state after ``data``, how many characters broke off or bytes begin none, and the bytes since the last border."""
    broken = tail = 0
    for byte in data:
        after = MACHINE[state].get(byte)
        if after is None and state != START:  # the character before broke off; this byte may begin one
            broken += 1
            state, tail = START, 0
            after = MACHINE[START].get(byte)
        if after is None:
            broken += 1
            after = START
        tail = tail + 1 if after != START else 0
        state = after
    return state, broken, tail


class Decoder:
    """Bytes of ids as they come in, held back to the end of a character. ``broken`` counts what is no UTF-8."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.state, self.held, self.broken = START, b"", 0

    def feed(self, ids: np.ndarray) -> bytes:
        """Bytes up to the last border of characters. Tokens that are whole characters take no step of the machine."""
        known = self.vocabulary
        data = self.held + b"".join(map(known.token.__getitem__, ids.tolist()))
        last, tail = -1, len(self.held)
        for i in np.flatnonzero(~known.whole[ids]).tolist():
            if i > last + 1:
                self._whole_token()
                tail = 0
            self.state, broken, since = read_utf8(self.state, known.token[ids[i]])
            self.broken += broken
            tail = since if self.state == START or since < len(known.token[ids[i]]) else tail + since
            last = i
        if len(ids) > last + 1:
            self._whole_token()
            tail = 0
        self.held = data[len(data) - tail :]
        return data[: len(data) - tail]

    def _whole_token(self) -> None:
        self.broken += self.state != START
        self.state = START

    def finish(self) -> bytes:
        """What is held back at the end: the beginning of a character, or nothing."""
        self.broken += self.state != START
        self.state, rest, self.held = START, self.held, b""
        return rest


class Vocabulary:
    """Bytes by id, and whether they are whole characters."""

    def __init__(self, path: str):
        ranks = ranks_of(path)
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.whole = np.array([read_utf8(START, token)[:2] == (START, 0) for token in self.token])


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker, kept between its tasks."""
    return Encoder(path, pattern)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _by_size(column: pa.Array) -> Iterator[pa.Array]:
    """The column in slices of about ``BATCH_BYTES``, a row at least."""
    at = 0
    sizes = np.diff(np.frombuffer(column.buffers()[1], "<i4", len(column) + 1, column.offset * 4)) if len(column) else np.empty(0)
    for block in np.split(np.arange(len(column)), np.flatnonzero(np.diff(np.cumsum(sizes) // BATCH_BYTES)) + 1):
        yield column.slice(at, len(block))
        at += len(block)


def _mapped(df: DataFrame, made: dict[str, str], values: Callable[[pa.Array], list[pa.Array]], of: str) -> DataFrame:
    """``df`` with the columns ``made`` (name, type), worked out from column ``of`` slice by slice; other columns pass as they are."""
    kept = [c for c in df.columns if c not in made]
    schema = T.StructType([*[df.schema[c] for c in kept], *[T.StructField(n, T._parse_datatype_string(t)) for n, t in made.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in _by_size(batch.column(0)):
                rest = batch.slice(at, len(part))
                at += len(part)
                if len(part):
                    yield pa.RecordBatch.from_arrays([*rest.columns[1:], *values(part)], names=[*kept, *made])

    return df.select(F.col(of).alias("__given"), *[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def _encoded(texts: pa.Array, path: str, pattern: str) -> list[np.ndarray]:
    return encoder(path, pattern).encode([t or "" for t in texts.to_pylist()])


def _ids(found: list[np.ndarray]) -> pa.Array:
    ends = np.append(0, np.cumsum([len(x) for x in found])).astype("<i4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))


def _decoded(rows: Iterable[np.ndarray], path: str) -> pa.Array:
    known, out = vocabulary(path), []
    for ids in rows:
        stream = Decoder(known)
        blocks = [stream.feed(ids[i : i + PIECES]) for i in range(0, len(ids), PIECES)]
        out.append(b"".join([*blocks, stream.finish()]))
    return pa.array(out, pa.binary())


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The rows with their ``ids`` (array of int): those of the whole ``text``, without special tokens.

    A null or empty text has no ids; a very long one is read in blocks of pieces. Rows stay as they are, repeated
    ones, null identifiers and ties included; of other columns only ``text`` goes, and one named ``ids`` is
    replaced. No rows give none.
    """
    return _mapped(docs, {"ids": "array<int>"}, lambda texts: [_ids(_encoded(texts, path, pattern))], "text").drop("text")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """The rows with the bytes of their ``ids`` as ``decoded`` instead of them; null ids count as none.

    Bytes come out as they stand, also where ids are not those of a text, such as half a character. An id that the file
    lacks fails.
    """

    def decoded(ids: pa.Array) -> list[pa.Array]:
        return [_decoded((np.asarray(row.values if row.is_valid else [], "<i4") for row in ids), path)]

    return _mapped(rows, {"decoded": "binary"}, decoded, "ids").drop("ids")


def there_and_back(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The rows with ``ids`` as of :func:`encode` and ``decoded`` as of :func:`decode` of them, by one worker for each task."""

    def both(texts: pa.Array) -> list[pa.Array]:
        found = _encoded(texts, path, pattern)
        return [_ids(found), _decoded(found, path)]

    return _mapped(docs, {"ids": "array<int>", "decoded": "binary"}, both, "text").drop("text")
