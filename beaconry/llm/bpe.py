"""Byte-level BPE by a lazily determinised transducer, and a streaming decoder.

Every prefix of a piece has one encoding, so the last token of a prefix is unique: the token that ends there, is itself
reachable by merges and may follow the last token of what is before it. The token trie, entered anew at every byte, is a
nondeterministic automaton for the tokens that may end at a place; its subsets are determinised when first met (a subset is named
by its longest member) and then looked up. The transducer keeps the last token of every prefix still open and emits tokens as soon
as all open beginnings agree on them: a look-ahead bounded by the longest token. All memories are bounded: they start afresh
beyond ``MOST_STATES`` states, ``MOST_PAIRS`` token pairs or ``MOST_PIECES`` pieces.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import prepare

MOST_STATES = 100_000
MOST_PAIRS = 400_000
MOST_PIECES = 200_000
FLUSH = 1024  # bytes of a piece between emissions


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from a file of lines: base64 of the token's bytes, blank, rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._begins = {token[:i] for token in ranks for i in range(1, len(token) + 1)}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._reset()

    def _reset(self) -> None:
        self._pairs = 0
        self._after: dict[int, dict[int, bool]] = {}  # for each token what may come before it; -1: the start
        self._names, self._numbers = [b""], {b"": 0}
        self._steps: list[dict[int, int]] = [{}]
        self._ending: list[tuple[tuple[int, int, dict[int, bool]], ...]] = [()]

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two parts whose merge makes ``token``; None for single bytes and for tokens that merges never reach."""
        if token not in self._halves:
            data = self.tokens[token]
            parts = [data[i:i + 1] for i in range(len(data))]
            while len(parts) > 2:
                best, i = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if best == 1 << 60:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._halves[token]

    def _reached(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self._split(token) is not None

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether no merge across the border comes before the merges that make ``a`` and ``b``.

        Seen backwards: the border parts at any time are one from the chain of right halves of ``a`` and one from the chain of left
        halves of ``b``; the part made last is undone first. A merge of the two comes true if its rank is below that of the
        merge that takes up the left part, and not above that of the right part (of equals the leftmost goes first).
        """
        taken_a = taken_b = 1 << 60
        while True:
            rank = self.ranks.get(self.tokens[a] + self.tokens[b], 1 << 60)
            if rank < taken_a and rank <= taken_b and rank < 1 << 60:
                return False
            whole_a, whole_b = len(self.tokens[a]) == 1, len(self.tokens[b]) == 1
            if whole_a and whole_b:
                return True
            if whole_b or not whole_a and a > b:
                taken_a, a = a, self._split(a)[1]
            else:
                taken_b, b = b, self._split(b)[0]

    def _build(self, state: int, byte: int) -> int:
        name = self._names[state] + bytes([byte])
        while name not in self._begins:
            name = name[1:]
        target = self._numbers.get(name)
        if target is None:
            target = self._numbers[name] = len(self._names)
            self._names.append(name)
            self._steps.append({})
            ending = [(len(name) - i, self.ranks[name[i:]]) for i in range(len(name)) if name[i:] in self.ranks]
            self._ending.append(tuple((n, x, self._after.setdefault(x, {-1: True})) for n, x in ending if self._reached(x)))
        self._steps[state][byte] = target
        return target

    def _emit(self, last: list[int], open_bytes: int) -> tuple[list[int], int]:
        """Tokens on which all open cuts agree, and how many bytes they cover."""
        end = len(last)
        chains = []
        for cut in range(end - open_bytes, end + 1):
            chain = [cut]
            while chain[-1] > 0:
                chain.append(chain[-1] - len(self.tokens[last[chain[-1] - 1]]))
            chains.append(chain)
        base = max(set(chains[0]).intersection(*chains[1:]))
        return [last[c - 1] for c in reversed(chains[-1]) if 0 < c <= base], base

    def encode(self, piece: bytes) -> list[int]:
        if len(self._names) > MOST_STATES or self._pairs > MOST_PAIRS:
            self._reset()
        steps, ending = self._steps, self._ending
        out: list[int] = []
        state, token = 0, 0
        last = [-1]  # the token emitted last, then the last token of every prefix after it
        for start in range(0, len(piece), FLUSH):
            for byte in piece[start:start + FLUSH]:
                state = steps[state].get(byte) or self._build(state, byte)
                for size, token, after in ending[state]:
                    before = last[-size]
                    fits = after.get(before)
                    if fits is None:
                        fits = after[before] = self._may_follow(before, token)
                        self._pairs += 1
                    if fits:
                        break
                last.append(token)
            if start + FLUSH < len(piece):
                tokens, used = self._emit(last[1:], min(len(self._names[state]), len(last) - 1))
                out += tokens
                del last[:used]
        tail, cut = [], len(last) - 1
        while cut:
            tail.append(last[cut])
            cut -= len(self.tokens[last[cut]])
        return out + tail[::-1]


class Pieces(dict):
    """Encoded pieces as bytes of 32-bit ids, filled by the transducer."""

    def __init__(self, transducer: Transducer):
        self.transducer = transducer

    def __missing__(self, piece: str) -> bytes:
        out = array("i", self.transducer.encode(piece.encode())).tobytes()
        if len(piece) < 64:
            if len(self) >= MOST_PIECES:
                self.clear()
            self[piece] = out
        return out


class Texts(dict):
    """Whole texts as bytes of 32-bit ids.

    The pattern never matches across a single blank between two characters that are not white space, so each blank with what
    follows it up to the next is looked up as one. Texts with other white space beside a blank are split as a whole.
    """

    def __init__(self, pattern: str, pieces: Pieces):
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.pieces = pieces

    def whole(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split.findall(text)))

    def __missing__(self, chunk: str) -> bytes | None:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        out = self.whole(" " + chunk)
        if len(chunk) < 64:
            if len(self) >= MOST_PIECES:
                self.clear()
            self[chunk] = out
        return out

    def forget(self) -> None:
        """Give the looked-up pieces back; the transducer stays."""
        self.clear()
        self.pieces.clear()

    def encode(self, text: str) -> bytes:
        first, *chunks = text.split(" ")
        if chunks and first and not first[-1].isspace():
            try:
                return self.whole(first) + b"".join(map(self.__getitem__, chunks))
            except TypeError:  # a chunk that can't be told apart from its neighbours
                pass
        return self.whole(text)


class Utf8Machine:
    """Incremental UTF-8 decoding: ``push`` gives the characters complete so far, ``close`` what is left.

    The state is the number of continuation bytes awaited and the range of the next one; an invalid byte gives U+FFFD
    for the longest valid beginning, as the standard decoder does.
    """

    def __init__(self) -> None:
        self._held = b""

    @staticmethod
    def _awaited(lead: int) -> tuple[int, int, int]:
        """After a leading byte: continuation bytes to come, and the bounds of the first of them."""
        if 0xC2 <= lead <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= lead <= 0xEF:
            return 2, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
        if 0xF0 <= lead <= 0xF4:
            return 3, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
        return 0, 0, 0

    def _unfinished(self, data: bytes) -> int:
        """How many bytes at the end begin a character that is valid so far."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if not 0x80 <= lead <= 0xBF:
                more, low, high = self._awaited(lead)
                rest = data[len(data) - back + 1:]
                return back if back <= more and (not rest or low <= rest[0] <= high) else 0
        return 0

    def push(self, data: bytes) -> str:
        data = self._held + data
        tail = self._unfinished(data)
        self._held = data[len(data) - tail:]
        return data[:len(data) - tail].decode("utf-8", "replace")

    def close(self) -> str:
        held, self._held = self._held, b""
        return held.decode("utf-8", "replace")


def decode_stream(chunks: Iterable[list[int]], tokens: dict[int, bytes]) -> Iterator[str]:
    """Text of token ids that arrive in chunks; a character split over tokens or chunks waits for its end."""
    machine = Utf8Machine()
    for ids in chunks:
        yield machine.push(b"".join(map(tokens.__getitem__, ids)))
    yield machine.close()


_READY: dict[tuple[bytes, str], Texts] = {}


def _ready(data: bytes, pattern: str) -> Texts:
    """Tables of this worker for one vocabulary."""
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _READY:
        _READY.clear()
        _READY[key] = Texts(pattern, Pieces(Transducer(read_ranks(data))))
    return _READY[key]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token ids of every whole text: doc_id, ids array<int>.

    Each match of ``pattern`` is encoded on its own by the ranks in the file ``path``, which the driver reads (a vocabulary of fixed
    size). Special tokens' strings are ordinary text. Null and empty texts give an empty array; null ids and repeated rows are
    kept row by row; other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    vocabulary = spark.sparkContext.broadcast(Path(path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _ready(vocabulary.value, pattern)
        for batch in batches:
            parts = [known.encode(t) if t else b"" for t in batch.column("text").to_pylist()]
            offsets = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype(np.int32)
            ids = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(parts))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), ids)], names=["doc_id", "ids"])
        known.forget()  # the worker goes on to other work

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, chunk: int = 4096) -> DataFrame:
    """Texts of encoded rows, with digests: doc_id, n_tokens, ids_sha256, decoded_sha256, text, ids.

    ids_sha256 is over the decimal ids joined by one blank, decoded_sha256 over the decoded bytes. Null ids count as none.
    """
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Path(path).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(vocabulary.value)
        tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        names = [str(i) for i in range(len(tokens))]
        for batch in batches:
            rows = batch.column("ids")
            flat, offsets = rows.flatten().to_numpy(), np.cumsum([0, *(n or 0 for n in rows.value_lengths().to_pylist())])
            out = {k: [] for k in ("n_tokens", "ids_sha256", "decoded_sha256", "text")}
            for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
                ids, machine, digest, texts = flat[lo:hi].tolist(), Utf8Machine(), hashlib.sha256(), []
                for at in range(0, len(ids), chunk):
                    data = b"".join(map(tokens.__getitem__, ids[at:at + chunk]))
                    digest.update(data)
                    texts.append(machine.push(data))
                texts.append(machine.close())
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
                out["decoded_sha256"].append(digest.hexdigest())
                out["text"].append("".join(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out["n_tokens"], pa.int64()), *(
                pa.array(out[k], pa.string()) for k in ("ids_sha256", "decoded_sha256", "text")), rows], names=["doc_id", *out, "ids"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, text string, ids array<int>")


