"""Byte-level BPE as a transducer that is determinised as it is used, and decoding as a stream.

Every prefix of a piece of text has one encoding, and its last token alone decides which tokens may follow: two tokens
stand side by side in an encoding only if no merge crosses from one to the other while either is built. So while bytes are
read, it is enough to follow, from each token boundary that may still matter, the path in the vocabulary's tree of bytes. A
state is the set of these paths, each with the token before it; its output is the last token of the prefix read so far.
Tokens are read off backwards from boundary to boundary. What lies before all live paths is certain and emitted; as tokens
are of bounded length, so is the lookahead. States and moves are made when first needed and kept in a table of bounded size.

Defined cases: null and empty texts have no ids; bytes that are not yet a whole character wait in the decoder, and bytes
that can never be one become U+FFFD; further columns are ignored; ids may be null or repeat.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import public_tokenizers
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemill.llm.common import map_lists, worker_state
from tunemill.llm.wordids import REMEMBERED, Remembered, WordIds

#: Moves that are kept before the table starts anew, and ids that are decoded at once.
KEPT_MOVES, DECODED = 400_000, 1 << 16
#: Bytes of a piece that are read before certain tokens are emitted.
EMIT_EACH = 1 << 12
ROOT, START, NO_RANK = 0, -1, 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    with fs.LocalFileSystem().open_input_stream(path) as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f.read().splitlines())}


def merge(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The definition: join the neighbours whose union has the lowest rank, leftmost first, until none has one."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], NO_RANK), i) for i in range(len(parts) - 1))
        if rank == NO_RANK:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Neighbours:
    """Which tokens may stand side by side, by walking along their own merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {rank: token for token, rank in ranks.items()}
        self.edges_of: dict[int, tuple | None] = {}
        self.parts: dict[bytes, tuple[bytes, bytes] | None] = {}

    def _halves(self, data: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes ``data``; null if its bytes do not merge into it."""
        if data not in self.parts:
            parts = [data[i:i + 1] for i in range(len(data))]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NO_RANK), i) for i in range(len(parts) - 1))
                if rank == NO_RANK:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self.parts[data] = tuple(parts) if len(parts) == 2 else None
        return self.parts[data]

    def _edges(self, token: int) -> tuple[list, list] | None:
        """(right, left): the parts that lie at the token's right and left edge while it is built, as (bytes, rank of the
        next part); null if its bytes do not merge into it in the order of ranks."""
        if token not in self.edges_of:
            data = self.tokens[token]
            sides, sound = ([], []), True
            for side, edges in zip((1, 0), sides):
                part, rank = data, NO_RANK
                while sound:
                    edges.append((part, rank))
                    if len(part) == 1:
                        break
                    halves, rank = self._halves(part), self.ranks[part]
                    sound = halves is not None and all([len(h) == 1 or self.ranks[h] < rank for h in halves])
                    part = halves[side] if sound else part
                edges.reverse()
            self.edges_of[token] = sides if sound else None
        return self.edges_of[token]

    def whole(self, token: int) -> bool:
        """Do the token's own bytes merge into it?"""
        data = self.tokens[token]
        return len(data) == 1 or self._halves(data) is not None

    def meet(self, before: int, after: int) -> bool:
        """May ``after`` stand right of ``before``?"""
        if not self.whole(after):
            return False
        left, right = self._edges(before), self._edges(after)
        if left is None or right is None:  # ranks out of order: by the definition
            a, b = self.tokens[before], self.tokens[after]
            return merge(a + b, self.ranks) == [a, b]
        a, b = left[0], right[1]
        i = j = 0
        while True:
            (end, grows), (start, next_) = a[i], b[j]
            across = self.ranks.get(end + start, NO_RANK)
            if across < grows and across <= next_ and across != NO_RANK:
                return False
            if grows == next_ == NO_RANK:
                return True
            if grows <= next_:
                i += 1
            else:
                j += 1


class Transducer:
    """``encode(piece)`` gives the ids of the bytes of one piece of text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {rank: token for token, rank in ranks.items()}
        self.neighbours = Neighbours(ranks)
        self.edges: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        nodes = 1
        for token, rank in ranks.items():
            node = ROOT
            for byte in token:
                step = node << 8 | byte
                node = self.edges.setdefault(step, nodes)
                nodes += node == nodes
            self.ends[node] = rank
        self.depth = [0] * nodes
        for step, node in self.edges.items():
            self.depth[node] = self.depth[step >> 8] + 1
        self.pairs: dict[int, bool] = {}
        self._clear()

    def _clear(self) -> None:
        """A state is its paths, oldest first, as (node, token before it); the last has just begun, after the state's output."""
        self.moves: dict[int, int] = {}
        self.states: list[tuple] = []
        self.outputs: list[int] = []
        self.numbers: dict[tuple, int] = {}
        self.start = self._number(((ROOT, START),))

    def _number(self, state: tuple) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.outputs.append(state[-1][1])
        return number

    def _follows(self, before: int, token: int) -> bool:
        key = (before + 1) << 32 | token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_MOVES:
                self.pairs.clear()
            known = self.pairs[key] = self.neighbours.whole(token) if before == START else self.neighbours.meet(before, token)
        return known

    def _move(self, number: int, byte: int) -> int:
        """The state after one more byte."""
        alive, last = [], None
        for node, before in self.states[number]:
            after = self.edges.get(node << 8 | byte)
            if after is None:
                continue
            alive.append((after, before))
            if last is None:
                token = self.ends.get(after)
                if token is not None and self._follows(before, token):
                    last = token
        alive.append((ROOT, last))
        return self._number(tuple(alive))

    def _back(self, lasts: list[int], at: int) -> list[int]:
        """The tokens of the first ``at`` bytes, from the last token of each prefix."""
        out = []
        while at > 0:
            out.append(lasts[at - 1])
            at -= len(self.tokens[lasts[at - 1]])
        out.reverse()
        return out

    def _certain(self, number: int, lasts: list[int]) -> int:
        """Bytes from the start whose tokens no further byte can change: the last boundary that all live paths share."""
        ends = {len(lasts) - self.depth[node] for node, _ in self.states[number]}
        while len(ends) > 1:
            latest = max(ends)
            ends = ends - {latest} | {latest - len(self.tokens[lasts[latest - 1]])}
        return ends.pop()

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        if len(self.moves) >= KEPT_MOVES:
            self._clear()
        number, moves, outputs, lasts, out = self.start, self.moves, self.outputs, [], []
        for byte in piece:
            step = number << 8 | byte
            number = moves.get(step)
            if number is None:
                number = moves[step] = self._move(step >> 8, byte)
            lasts.append(outputs[number])
            if len(lasts) >= EMIT_EACH:
                sure = self._certain(number, lasts)
                out += self._back(lasts, sure)
                del lasts[:sure]
        return out + self._back(lasts, len(lasts))


class Utf8Stream:
    """Text from bytes that come in any portions: at most three bytes of an unfinished character wait."""

    def __init__(self):
        self.waiting = b""

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        keep = self._unfinished(data[-3:])
        self.waiting = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", "replace")

    @staticmethod
    def _unfinished(tail: bytes) -> int:
        """Bytes at the end that begin a character and lack some of it."""
        for back in range(1, len(tail) + 1):
            byte = tail[-back]
            if byte & 0xC0 != 0x80:
                need = 4 if 0xF0 <= byte < 0xF5 else 3 if 0xE0 <= byte < 0xF0 else 2 if 0xC2 <= byte < 0xE0 else 1
                return back if need > back else 0
        return 0

    def close(self) -> str:
        text, self.waiting = self.waiting.decode("utf-8", "replace"), b""
        return text


class Codec:
    """Encoding of texts and decoding of ids for one rank file."""

    def __init__(self, path: str, pattern: str):
        self.transducer = Transducer(load_ranks(path))
        self.find = regex.compile(pattern).findall
        self.pieces = Remembered(self._piece, REMEMBERED // 4)
        self.words = WordIds(lambda texts: map(self._word, texts))
        self.table = self.transducer.tokens

    def _piece(self, piece: str) -> bytes:
        return array("I", self.transducer.encode(piece.encode())).tobytes()

    def _word(self, text: str) -> bytes:
        pieces = self.find(text)
        return self._piece(pieces[0]) if len(pieces) == 1 else b"".join([self.pieces[p] for p in pieces])

    def encode(self, text: str | None) -> bytes:
        return self.words.ids(text)

    def encode_all(self, texts):
        """Packed ids of each text; words that are new in a group of texts are encoded together."""
        return self.words.many(texts)

    def decode(self, ids: bytes):
        """The bytes of packed ids, a bounded portion at a time."""
        numbers = array("I", ids)
        for at in range(0, len(numbers), DECODED):
            yield b"".join(map(self.table.__getitem__, numbers[at:at + DECODED]))


def codec(path: str, pattern: str = public_tokenizers.PATTERN) -> Codec:
    return worker_state(f"codec {path} {pattern}", lambda: Codec(path, pattern))


ROWS = pa.schema([("doc_key", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
                  ("same_text", pa.bool_())])


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids of every document as little-endian 32-bit numbers."""
    def make():
        own = codec(path)
        return lambda rows: {"doc_key": rows["doc_key"], "ids": list(own.encode_all(rows["body"]))}

    rows = docs.select(F.col(key).cast("long").alias("doc_key"), F.col(text).alias("body"))
    return map_lists(rows, make, pa.schema([("doc_key", pa.int64()), ("ids", pa.binary())])).withColumnRenamed("doc_key", key)


def decoded(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of packed ids, decoded as a stream."""
    def make():
        own = codec(path)

        def whole(packed):
            stream = Utf8Stream()
            return "".join([stream.feed(part) for part in own.decode(packed or b"")]) + stream.close()
        return lambda r: {"doc_key": r["doc_key"], "text": [whole(x) for x in r["ids"]]}

    chosen = rows.select(F.col(key).cast("long").alias("doc_key"), F.col(ids).alias("ids"))
    return map_lists(chosen, make, pa.schema([("doc_key", pa.int64()), ("text", pa.string())])).withColumnRenamed("doc_key", key)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256, same_text) of every document, encoded and decoded in one pass."""
    def make():
        own = codec(path)

        def both(rows):
            out = {name: [] for name in ROWS.names}
            for doc, body, ids in zip(rows["doc_key"], rows["body"], own.encode_all(rows["body"])):
                stream, digest, parts = Utf8Stream(), hashlib.sha256(), []
                for part in own.decode(ids):
                    digest.update(part)
                    parts.append(stream.feed(part))
                same = "".join(parts) + stream.close() == (body or "")
                for name, value in zip(ROWS.names, (doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), digest.hexdigest(), same)):
                    out[name].append(value)
            return out
        return both

    rows = docs.select(F.col(key).cast("long").alias("doc_key"), F.col(text).alias("body"))
    return map_lists(rows, make, ROWS).withColumnRenamed("doc_key", key)
