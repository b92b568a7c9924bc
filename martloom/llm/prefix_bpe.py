"""Byte-level BPE by dynamic programming over byte prefixes.

For every prefix of a piece exactly one token can end its encoding: the longest suffix token
whose predecessor, the last token of the prefix before it, may stand beside it. Two tokens may
stand side by side if encoding their joined bytes gives them back. Storing that last token
per prefix makes three things exact and cheap:

* encoding: walk back from the end;
* appending bytes: only the new prefixes are computed;
* editing: prefixes before the edit keep their tokens.

Null text encodes as the empty text: no ids, and the digest of nothing.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from martloom.llm.common import map_batches, sha256_hex

# The split pattern's classes over the code points up to U+024F, where the
# standard module's classes can be written out. Longer code points go to the full pattern.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼½¾"
SPACES = "\t-\r \x85\xa0"
CACHED_PIECES = 300_000  # a worker remembers this many pieces, then only those of its latest chunk
CHUNK_CHARS = 2_000_000  # texts are encoded together up to this size; a longer one stands alone
MATRIX_BYTES = 64  # longer pieces are encoded one at a time
CACHED_PAIRS = 300_000  # token pairs whose validity a worker remembers


class PrefixEncoding:
    """The encoding of a growing or edited byte string, kept as the last token of each prefix."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, bytearray(), [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self.vocabulary.extend(bytes(self.data), self.last)

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Put ``data`` for the bytes from ``start`` to ``end``; what stands before is not redone."""
        self.data[start:end] = data
        del self.last[start + 1:]
        self.vocabulary.extend(bytes(self.data), self.last)

    def ids(self) -> list[int]:
        return self.vocabulary.walk_back(self.last)


class Vocabulary:
    """Ranks of byte strings; a token's rank is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: data for data, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        # Every beginning of a token, with the token's id if it is one itself, else -1.
        self.beginnings = {data[:i]: -1 for data in ranks for i in range(1, len(data))} | ranks
        self._pairs: dict[int, bool] = {}
        self._index: tuple | None = None
        self._whole: dict[int, bool] = {}

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(data): int(rank) for data, rank in map(bytes.split, lines)})

    def merge(self, data: bytes) -> list[int]:
        """Encoding by the definition: join the neighbours of lowest rank, leftmost first."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            joined = [(self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best = min((x for x in joined if x[0] is not None), default=None)
            if best is None:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def stands_alone(self, token: int) -> bool:
        """Whether merging a token's bytes gives the token itself; others never appear."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = self.merge(self.token[token]) == [token]
        return known

    def may_follow(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self.stands_alone(right) and self.merge(self.token[left] + self.token[right]) == [left, right]
        return known

    def extend(self, data: bytes, last: list[int]) -> None:
        """Add to ``last`` the token that ends each further prefix of ``data``.

        Every prefix that is final sends its tokens forward, along the bytes that begin a token.
        """
        beginnings, pairs, size = self.beginnings, self._pairs, len(data)
        old = len(last)
        last += [None] * (size + 1 - old)
        for start in range(max(0, old - self.longest), size):
            before = last[start]
            if before is None:
                continue
            for end in range(start + 1, size + 1):
                token = beginnings.get(data[start:end])
                if token is None:
                    break
                if token < 0 or last[end] is not None:
                    continue
                if start == 0:
                    known = self.stands_alone(token)
                else:
                    known = pairs.get(before << 32 | token)
                    if known is None:
                        known = self.may_follow(before, token)
                if known:
                    last[end] = token
        for end in range(old, size + 1):
            if last[end] is None:
                raise ValueError(f"the vocabulary has no token for byte {data[end - 1]}")

    def walk_back(self, last: list[int]) -> list[int]:
        ids, end = [], len(last) - 1
        while end > 0:
            ids.append(last[end])
            end -= len(self.token[last[end]])
        return ids[::-1]

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one piece. A piece that is a token stays whole, even where merging could not reach it."""
        token = self.ranks.get(data)
        if token is not None:
            return [token]
        last = [-1]
        self.extend(data, last)
        return self.walk_back(last)

    def _trie(self) -> tuple:
        """The beginnings as arrays: sorted edge keys (node * 256 + byte), the node each leads to, a
        node's token or -1, and a token's length."""
        if self._index is None:
            node = {b"": 0} | {data: i + 1 for i, data in enumerate(self.beginnings)}
            edges = np.array([node[data[:-1]] << 8 | data[-1] for data in self.beginnings], np.int64)
            order = np.argsort(edges)
            length = np.zeros(max(self.token, default=0) + 1, np.int32)
            for token, data in self.token.items():
                length[token] = len(data)
            self._index = edges[order], (order + 1).astype(np.int32), np.array([-1, *self.beginnings.values()], np.int32), length
        return self._index

    def _valid(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``may_follow`` for arrays; a left of -1 stands for the beginning."""
        keys, inverse = np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)
        pairs, known = self._pairs, np.empty(len(keys), bool)
        for i, key in enumerate(keys.tolist()):
            answer = pairs.get(key)
            if answer is None:
                answer = self.may_follow(key >> 32, key & 0xFFFFFFFF) if key >= 0 else self.stands_alone(key & 0xFFFFFFFF)
            known[i] = answer
        return known[inverse]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """``encode_piece`` for many pieces: their prefix tables are the rows of one matrix."""
        out: list = [None] * len(pieces)
        rows = []
        for i, data in enumerate(pieces):
            if data in self.ranks or len(data) > MATRIX_BYTES:
                out[i] = self.encode_piece(data)
            elif data:
                rows.append(i)
            else:
                out[i] = []
        if not rows:
            return out
        edges, child, token_of, length_of = self._trie()
        sizes = np.array([len(pieces[i]) for i in rows], np.int32)
        width = int(sizes.max())
        data = np.frombuffer(b"".join([pieces[i].ljust(width, b"\0") for i in rows]), np.uint8).reshape(len(rows), width)
        last = np.full((len(rows), width + 1), -2, np.int32)
        last[:, 0] = -1
        for start in range(width):
            at = np.flatnonzero((sizes > start) & (last[:, start] > -2))
            node = np.zeros(len(at), np.int64)
            for end in range(start + 1, width + 1):
                on = sizes[at] >= end
                at, node = at[on], node[on]
                if not len(at):
                    break
                keys = node << 8 | data[at, end - 1]
                found = np.minimum(np.searchsorted(edges, keys), len(edges) - 1)
                on = edges[found] == keys
                at, node = at[on], child[found[on]].astype(np.int64)
                token = token_of[node]
                may = np.flatnonzero((token >= 0) & (last[at, end] == -2))
                if len(may):
                    row, token = at[may], token[may]
                    good = self._valid(last[row, start], token)
                    last[row[good], end] = token[good]
        end, at, steps = sizes.copy(), np.arange(len(rows)), []
        if (last[at, end] == -2).any():
            raise ValueError("the vocabulary lacks single bytes")
        while len(at):
            token = last[at, end[at]]
            steps.append((at, token))
            end[at] -= length_of[token]
            at = at[end[at] > 0]
        lists: list[list[int]] = [[] for _ in rows]
        for at, token in reversed(steps):
            for row, t in zip(at.tolist(), token.tolist()):
                lists[row].append(t)
        for i, ids in zip(rows, lists):
            out[i] = ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        token = self.token
        return b"".join([token[i] for i in ids])


def piece_finder(pattern: str):
    """``find(text)``: the matches of the split pattern, faster where all code points are below U+0250."""
    full = regex.compile(pattern).findall
    narrow = (pattern.replace(r"\s+(?!\S)", f"[{SPACES}]+(?![^{SPACES}])").replace(r"[^\s\p{L}\p{N}]", f"[^{SPACES}{LETTERS}{NUMBERS}]")
              .replace(r"\p{L}", f"[{LETTERS}]").replace(r"\p{N}", f"[{NUMBERS}]").replace(r"\s+", f"[{SPACES}]+"))
    if "\\" in narrow:
        return full
    fast, wide = re.compile(narrow).findall, re.compile("[^\x00-ɏ]").search
    return lambda text: (full if wide(text) else fast)(text)


@lru_cache(maxsize=2)
def _worker_state(path: str, pattern: str):
    """A Python worker's vocabulary and piece memory, shared by the tasks it runs in turn."""
    return Vocabulary.from_file(path), piece_finder(pattern), {}


def _encoder(path: str, pattern: str):
    vocabulary, find, memory = _worker_state(path, pattern)

    def encode_chunk(texts: list[str | None]) -> list[tuple[str, int, bytes]]:
        split = [find(text) if text else [] for text in texts]
        pieces = set().union(*split)
        new = [p for p in pieces if p not in memory]
        for piece, ids in zip(new, vocabulary.encode_pieces([p.encode() for p in new])):
            memory[piece] = (",".join(map(str, ids)), len(ids), vocabulary.decode(ids))
        chunk = {p: memory[p] for p in pieces}
        if len(memory) > CACHED_PIECES:
            memory.clear()
            memory.update(chunk)
        out = []
        for parts in split:
            found = [chunk[p] for p in parts]
            out.append((",".join([f[0] for f in found]), sum([f[1] for f in found]), b"".join([f[2] for f in found])))
        return out

    def encode(texts: list[str | None]):
        """For each text: comma-joined ids, their number and the decoded bytes."""
        begin, size = 0, 0
        for i, text in enumerate(texts):
            if i > begin and size + len(text or "") > CHUNK_CHARS:
                yield from encode_chunk(texts[begin:i])
                begin, size = i, 0
            size += len(text or "")
        yield from encode_chunk(texts[begin:])

    return encode


def encode_documents(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",),
                     with_ids: bool = False) -> DataFrame:
    """Encode and decode every text: ``keep`` columns, n_tokens, ids_sha256, decoded_sha256, and the
    ids themselves as an array if asked for.

    One narrow pass without a shuffle. A null or empty text has no tokens. Repeated rows are
    encoded each; columns outside ``keep`` and ``text`` are ignored, whatever their names.
    """
    fields = [docs.schema[c] for c in keep]
    schema = docs.select(*keep).schema
    for name, kind in (("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")):
        schema = schema.add(name, kind)
    if with_ids:
        schema = schema.add("token_ids", ArrayType(IntegerType()))
    names = [f.name for f in fields]

    def make():
        encode = _encoder(path, pattern)

        def step(texts, *kept):
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "token_ids": []}
            for ids, n, decoded in encode(texts):
                out["n_tokens"].append(n)
                out["ids_sha256"].append(sha256_hex(ids.encode()))
                out["decoded_sha256"].append(sha256_hex(decoded))
                if with_ids:
                    out["token_ids"].append(np.fromstring(ids, dtype=np.int32, sep=",") if n else np.empty(0, np.int32))
            return out | dict(zip(names, kept))

        return step

    return map_batches(docs, [F.col("text"), *keep], schema, make)


def decode_documents(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Texts of encoded documents: ``keep`` columns and the decoded text (null ids: empty)."""
    schema = encoded.select(*keep).schema.add("text", "string")

    def make():
        token = Vocabulary.from_file(path).token

        def step(ids, *kept):
            return {"text": [b"".join([token[i] for i in x or []]).decode("utf-8", "replace") for x in ids]} | dict(zip(keep, kept))

        return step

    return map_batches(encoded, [F.col("token_ids"), *keep], schema, make)
