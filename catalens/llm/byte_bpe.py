"""Byte-level BPE by prefix dynamic programming.

The BPE tokens of a string are such that each pair of neighbours, taken alone, would be encoded as just that pair; and of
all token sequences of a string only one has this property. So each byte prefix has exactly one valid last token: the
token t that ends there for which the prefix before t is valid and its last token and t are compatible. ``PrefixTable``
keeps those last tokens. Appending bytes only adds entries; after an edit, only entries behind it are made again, and
not even those once the table falls into step with the old one.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from catalens.llm.chunks import ChunkEncoder, slices
from catalens.llm.common import Memo, append, piped, with_columns

#: The pattern that splits a text before the merges (a fixed value of the rank files).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Ranks:
    """A vocabulary of byte strings with merge ranks, and which pairs of its tokens are compatible."""

    def __init__(self, ranks: dict[bytes, int], limit: int = 500_000):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split = Memo(self._split, 1 << 20)
        self.compatible = Memo(lambda pair: self._compatible(*pair), limit)
        self.last = Memo(self._last, limit)

    @classmethod
    def load(cls, path: str) -> Ranks:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def merge(self, data: bytes) -> list[bytes]:
        """BPE as defined: the pair of neighbours with the lowest rank, the first of equals, is merged until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; itself twice for a single byte; None if no merges lead to it."""
        data = self.bytes_of[token]
        if len(data) == 1:
            return token, token
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                return None
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return tuple(self.ranks[p] for p in parts)

    def _last(self, prefix: bytes) -> int:
        """The last token of a byte prefix; prefixes are shared by all strings that begin with them."""
        ranks, compatible = self.ranks, self.compatible
        for start in range(max(0, len(prefix) - self.longest), len(prefix)):
            token = ranks.get(prefix[start:])
            if token is not None and (not start or compatible[self.last[prefix[:start]], token]) and self.split[token]:
                return token
        raise ValueError("the vocabulary lacks a byte of the text")

    def ids(self, data: bytes) -> list[int]:
        """The ids of a byte string, last to first by the prefixes' last tokens; no prefix that isn't asked for is worked out."""
        if len(data) > 200:  # too deep to work out from its end
            return PrefixTable(self, data).ids()
        out, bytes_of, last = [], self.bytes_of, self.last
        while data:
            token = last[data]
            out.append(token)
            data = data[: -len(bytes_of[token])]
        return out[::-1]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether BPE of both tokens' bytes gives just these two: no merge across the border comes before those inside."""
        bound = 1 << 60
        while True:
            across = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if across is not None and across < bound:
                return False
            # undo the later of the two last merges; what then meets across the border could only merge before that
            whole_left, whole_right = len(self.bytes_of[left]) == 1, len(self.bytes_of[right]) == 1
            if whole_left and whole_right:
                return True
            if not whole_left and (whole_right or left > right):
                bound, left = left, self.split[left][1]
            else:
                # at equal rank the left merge comes first, so one across the border with this very rank wins
                bound, right = right + 1, self.split[right][0]


class PrefixTable:
    """The last token of each byte prefix of one growing, editable byte string."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, b"", []
        self.append(data)

    def _last(self, end: int) -> int:
        r = self.ranks
        ranks, compatible, data, last = r.ranks, r.compatible, self.data, self.last
        for start in range(max(0, end - r.longest), end):
            token = ranks.get(data[start:end])
            if token is None or r.split[token] is None:
                continue
            if start == 0 or compatible[last[start - 1], token]:
                return token
        raise ValueError("the vocabulary lacks a byte of the text")

    def append(self, more: bytes) -> None:
        """Add bytes at the end; no entry before them changes."""
        at = len(self.data)
        self.data += more
        for end in range(at + 1, len(self.data) + 1):
            self.last.append(self._last(end))

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace data[start:end]; returns how many entries were made anew."""
        tail, old = self.data[end:], self.last[end:]
        self.data = self.data[:start] + new + tail
        del self.last[start:]
        for at in range(start + 1, start + len(new) + 1):
            self.last.append(self._last(at))
        made, agree = len(new), 0
        for i in range(len(tail)):
            token = self._last(start + len(new) + i + 1)
            self.last.append(token)
            made += 1
            agree = agree + 1 if token == old[i] else 0
            # an entry looks back one token for the start and one for the neighbour: equal entries over two longest tokens repeat for ever
            if agree >= 2 * self.ranks.longest:
                self.last += old[i + 1 :]
                break
        return made

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.ranks.bytes_of[token])
        return out[::-1]


def piece_ids(ranks: Ranks, piece: bytes) -> list[int]:
    """Ids of one match of the pattern; a piece that is itself a token is that token, as the rank files' library has it."""
    token = ranks.ranks.get(piece)
    return [token] if token is not None else ranks.ids(piece)


_ENCODERS: dict[str, tuple[Ranks, ChunkEncoder]] = {}


def encoder(path: str) -> tuple[Ranks, ChunkEncoder]:
    """The vocabulary of a rank file and its encoder, kept by each Python worker."""
    if path not in _ENCODERS:
        ranks = Ranks.load(path)
        find = regex.compile(PATTERN).findall
        _ENCODERS[path] = ranks, ChunkEncoder(find, lambda piece: array("I", piece_ids(ranks, piece.encode())).tobytes(), 1_000_000)
    return _ENCODERS[path]


def encoded(path: str, text: str, to: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encode = encoder(path)
        for batch in batches:
            for part in slices(batch, text):
                ids, count = encode.column(part.column(part.schema.get_field_index(text)))
                offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                yield append(part, **{to: pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.view("<i4")))})

    return run


def _flat(column: pa.ListArray) -> tuple[list[int], list[tuple[int, int]]]:
    """All ids, and where each row's begin and end."""
    ends = np.cumsum(np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)).tolist()
    return column.flatten().to_numpy(zero_copy_only=False).tolist(), list(zip([0, *ends[:-1]], ends))


def decoded(path: str, ids: str, to: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, _ = encoder(path)
        for batch in batches:
            flat, spans = _flat(batch.column(batch.schema.get_field_index(ids)))
            parts = list(map(ranks.bytes_of.__getitem__, flat))
            yield append(batch, **{to: pa.array([b"".join(parts[a:b]) for a, b in spans], pa.binary())})

    return run


def encode(df: DataFrame, path: str, text: str = "text", to: str = "ids") -> DataFrame:
    """``df`` with column ``to``: the token ids (array<int>) of each whole text by the rank file at ``path``.

    A null or empty text has no ids. All other columns stay, with any names; an old column ``to`` is replaced. Rows are
    taken one by one, so repeated rows give repeated results, and an empty table an empty one.
    """
    return piped(df, with_columns(df.schema, f"`{to}` array<int>"), encoded(path, text, to))


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with column ``to``: the bytes (binary) that the token ids stand for; null ids give no bytes."""
    return piped(df, with_columns(df.schema, f"`{to}` binary"), decoded(path, ids, to))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names: dict[int, str] = Memo(str, 1 << 20)
    for batch in batches:
        column = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: B023,E731
        flat, spans = _flat(column("ids"))
        words = list(map(names.__getitem__, flat))
        hashes = [hashlib.sha256(",".join(words[a:b]).encode()).hexdigest() for a, b in spans]
        back = [hashlib.sha256(x).hexdigest() for x in column("decoded").to_pylist()]
        yield pa.RecordBatch.from_arrays([column("doc_id"), pa.array([b - a for a, b in spans], pa.int64()), pa.array(hashes, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def op6_byte_bpe(documents: DataFrame, path: str) -> DataFrame:
    """Per document: n_tokens, ids_sha256 (of the ids' decimal digits joined by commas) and decoded_sha256 (of the bytes decoded from the ids).

    Encoding, decoding and hashing run in one worker, so that ids don't go back and forth between it and the JVM.
    """
    return piped(documents.select("doc_id", "text"), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", encoded(path, "text", "ids"), decoded(path, "ids", "decoded"), _digests)
