"""Token ids of texts word by word, and the byte-level vocabularies of the tokenizers library.

The pre-tokenizer of a byte-level vocabulary starts a new piece at every single space that is followed by something
visible, so ids of a text are the ids of its space-separated words one after another. Each distinct word is encoded once
and remembered as bytes, as words repeat far more often than texts do. Words that are new in a group of texts are encoded
together.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tunemill.llm.common import worker_state

#: Distinct words in each of the two generations that a worker remembers, and the longest of them.
REMEMBERED, LONGEST = 450_000, 200
#: Characters of the texts that are split into words together.
GROUP_CHARS = 2_000_000
#: Words that the library encodes together.
TOGETHER = 64
NEXT_WORD = re.compile(r" (?=\S)")
#: A space that starts no word: white space or the end follows.
BARE_SPACE = re.compile(r" (?:\s|\Z)")
#: How a byte-level vocabulary writes a space.
LEAD = "Ġ"
ID_BYTES = 4


def pack(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(ID_BYTES, "little") for i in ids])


class WordIds:
    """Ids as little-endian 32-bit numbers. ``encode`` gives those of a list of texts, each a word or a space and a word.

    The memory has two generations: a full one becomes the older, and what is used again moves on.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes]], limit: int = REMEMBERED):
        self.encode, self.limit = encode, limit
        self.now: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, text: str | None) -> bytes:
        return self._group([text or ""])[0]

    def many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= GROUP_CHARS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> list[bytes]:
        """Words are coded by Arrow: each distinct word of the group is looked up once, and numpy puts the ids in place."""
        odd = {i: NEXT_WORD.split(t) for i, t in enumerate(texts) if BARE_SPACE.search(t)}
        words = pc.split_pattern(pa.array(["" if i in odd else t for i, t in enumerate(texts)], pa.large_string()), " ")
        starts = words.offsets.to_numpy()
        later = np.ones(int(starts[-1]), bool)
        later[starts[:-1]] = False
        flat = words.flatten()
        firsts = flat.filter(pa.array(~later)).to_pylist()
        coded = flat.filter(pa.array(later)).dictionary_encode()
        distinct, place = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        for i, own in odd.items():
            firsts[i] = own[0]
        if len(self.now) >= self.limit:
            self.older, self.now = self.now, {}
        n = len(distinct)
        distinct += [word for own in odd.values() for word in own[1:]]
        found = list(map(self.now.get, distinct))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        if unknown:
            learned = self._learn(dict.fromkeys([distinct[i] for i in unknown]))
            for i in unknown:
                found[i] = learned[distinct[i]]
        sizes = np.fromiter(map(len, found[:n]), np.int32, n) // ID_BYTES
        at = np.cumsum(sizes, dtype=np.int32) - sizes
        own = sizes[place]
        upto = np.cumsum(own, dtype=np.int32)
        pick = np.repeat(at[place] - (upto - own), own) + np.arange(upto[-1] if len(upto) else 0, dtype=np.int32)
        ids = np.frombuffer(b"".join(found[:n]), "<u4")[pick]
        ends = np.r_[0, upto][starts[1:] - np.arange(1, len(starts))].tolist()
        out, a = [], 0
        for i, (first, b) in enumerate(zip(self.encode(firsts), ends)):
            if i in odd:
                upto_odd = n + len(odd[i]) - 1
                out.append(first + b"".join(found[n:upto_odd]))
                n = upto_odd
            else:
                out.append(first + ids[a:b].tobytes())
            a = b
        return out

    def _learn(self, words: dict[str, bytes]) -> dict[str, bytes]:
        """Ids of words that the newer generation lacks; it has all but the longest of them afterwards."""
        new = []
        for word in words:
            ids = self.older.get(word)
            if ids is None:
                new.append(word)
            else:
                words[word] = ids
        words.update(zip(new, self.encode([" " + word for word in new])))
        self.now.update(words)
        for word in new:
            if len(word) > LONGEST:
                del self.now[word]
        return words


class Remembered(dict):
    """A function's values by argument; all are forgotten when there are too many."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) >= self.limit:
            self.clear()
        if len(key) <= LONGEST:
            self[key] = value
        return value


class _Library:
    """Ids of texts by the tokenizers library. Words that start with a space are encoded together and cut apart again: only the
    first token of such a word begins with a space."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.leads = np.zeros(max(vocabulary.values()) + 1, bool)
        self.leads[[i for token, i in vocabulary.items() if token.startswith(LEAD)]] = True

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), TOGETHER):
            own = texts[at:at + TOGETHER]
            joined = "".join(own)
            if joined.count(" ") == len(own) and not any([s in joined for s in self.specials]):
                ids = self._ids(joined)
                heads = (np.flatnonzero(self.leads[ids]) * ID_BYTES).tolist()
                if len(heads) == len(own):
                    raw = ids.tobytes()
                    yield from [raw[a:b] for a, b in zip(heads, [*heads[1:], len(raw)])]
                    continue
            yield from [self._ids(text).tobytes() for text in own]


def library_ids(path: str, limit: int = REMEMBERED) -> WordIds:
    """The encoder of this Python worker for a vocabulary; a smaller ``limit`` saves memory and costs time."""
    return worker_state(f"library_ids {path} {limit}", lambda: WordIds(_Library(path), limit))
