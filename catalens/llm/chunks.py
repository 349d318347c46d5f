"""Encoding of columns of texts by space-separated chunks, so that each distinct chunk of a batch is looked up once.

A single space before a non-space character always begins a new match of the pre-tokenizer's pattern, and takes the
characters after it along. So a text can be cut before such spaces and the parts encoded by themselves. Where a space
stands between white space and more white space, or at the end behind white space, a run of white space would be torn;
texts with such a place are encoded whole. A line feed between characters that aren't white space is a match of its
own, so texts whose line feeds all stand so are cut before them as well.

A batch is cut by Arrow, its distinct chunks are asked for once each, and the ids of all chunks are gathered by NumPy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from catalens.llm.common import Memo

# all white space that any pattern in use knows
_S = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_TORN = rf"{_S} ({_S}|\z)"
_LINES = rf"{_S}\n|\n{_S}|\n\z|\A\n"

#: Bytes of text that are worked on at once.
SLICE = 8_000_000


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``most`` bytes together; a longer text is a part by itself."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // most
    edge = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def gathered(values: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``values[i]`` (little-endian uint32) for each i of ``index``, one behind the other, and how many each has."""
    flat = np.frombuffer(b"".join(values), "<u4")
    size = np.fromiter(map(len, values), np.int64, len(values)) // 4
    count = size[index]
    first = (np.cumsum(size) - size)[index] - (np.cumsum(count) - count)
    return flat[np.repeat(first, count) + np.arange(int(count.sum()))], count


def cut_at_spaces(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct chunks of all texts, the number of each chunk in turn, and how many chunks each text has."""
    parts = pc.split_pattern(texts, " ")
    coded = parts.flatten().dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().copy(), parts.value_lengths().to_numpy()


class Column:
    """The ids of a column's rows, filled in by groups of rows."""

    def __init__(self, rows: int):
        self.count = np.zeros(rows, np.int64)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def put(self, rows: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        self.count[rows] = count
        self.held.append((rows, ids))

    def put_bytes(self, rows: np.ndarray, ids: list[bytes]) -> None:
        self.put(rows, np.frombuffer(b"".join(ids), "<u4"), np.array([len(x) // 4 for x in ids], np.int64))

    def ids(self) -> np.ndarray:
        if len(self.held) == 1 and len(self.held[0][0]) == len(self.count):
            return self.held[0][1]
        out = np.empty(int(self.count.sum()), "<u4")
        start = np.cumsum(self.count) - self.count
        for rows, ids in self.held:
            count = self.count[rows]
            out[np.repeat(start[rows] - (np.cumsum(count) - count), count) + np.arange(len(ids))] = ids
        return out


def with_ends(ids: np.ndarray, count: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` behind those of each row."""
    count = count + 1
    last = np.cumsum(count) - 1
    out = np.full(len(ids) + len(count), end_id, "<u4")
    text = np.ones(len(out), bool)
    text[last] = False
    out[text] = ids
    return out, count


class ChunkEncoder:
    """``pieces(text)`` cuts a text into the parts that are encoded separately; ``encode(piece)`` gives little-endian bytes.

    ``added`` are strings that are ids of their own wherever they stand, as the added tokens of the tokenizers library.
    """

    def __init__(self, pieces: Callable[[str], list[str]], encode: Callable[[str], bytes], limit: int = 1_000_000, added: dict[str, int] | None = None):
        self.pieces, self.encode, self.added = pieces, encode, {k: np.array([v], "<u4").tobytes() for k, v in (added or {}).items()}
        self.of_piece = Memo(encode, limit // 4)
        self.of_chunk = Memo(lambda part: self._join(" " + part), limit // 8)
        self.of_line = Memo(self._line, limit)

    def _join(self, text: str) -> bytes:
        return b"".join(map(self.of_piece.__getitem__, self.pieces(text)))

    def _line(self, part: str) -> bytes:
        """A chunk that begins with a line feed, or else has a space before it."""
        if part.isalpha():  # one match
            return self.encode(" " + part)
        if part[:1] == "\n":
            return self._join(part)
        if part[:-1].isalpha() and not part[-1].isalnum() and not part[-1].isspace():  # a word and one mark
            return self.of_line[part[:-1]] + self.of_piece[part[-1]]
        return self._join(" " + part)

    def __call__(self, text: str | None) -> bytes:
        return self.column(pa.array([text], pa.string()))[0].tobytes()

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none), one text behind the other, and how many each has."""
        texts = pc.fill_null(texts, "")
        out = Column(len(texts))
        todo = np.ones(len(texts), bool)
        for token in self.added:
            todo &= ~_found(pc.match_substring(texts, token))
        self._whole(texts, np.flatnonzero(~todo), out)
        torn = _found(pc.match_substring_regex(texts, _TORN))
        self._whole(texts, np.flatnonzero(todo & torn), out)
        lines = _found(pc.match_substring_regex(texts, _LINES))
        self._cut(texts, np.flatnonzero(todo & ~torn & lines), self.of_chunk, out)
        rest = np.flatnonzero(todo & ~torn & ~lines)
        self._cut(texts, rest, self.of_line, out, "\n")
        return out.ids(), out.count

    def _whole(self, texts: pa.Array, rows: np.ndarray, out: Column) -> None:
        out.put_bytes(rows, [self._between(t) for t in texts.take(pa.array(rows)).to_pylist()])

    def _between(self, text: str) -> bytes:
        """Ids of a text that may hold added strings: of the leftmost first, and of what stands between them by itself."""
        parts = []
        while text:
            at, token = min(((i, t) for t in self.added if (i := text.find(t)) >= 0), default=(len(text), ""))
            parts.append(self._join(text[:at]))
            if token:
                parts.append(self.added[token])
            text = text[at + len(token) :]
        return b"".join(parts)

    def _cut(self, texts: pa.Array, rows: np.ndarray, of: Memo, out: Column, also: str = "") -> None:
        if not len(rows):
            return
        texts = texts.take(pa.array(rows))
        kinds, index, many = cut_at_spaces(pc.replace_substring(texts, also, " " + also) if also else texts)
        # a text's first chunk has no space before it
        head = np.cumsum(many) - many
        values = [self._join(kinds[i]) for i in index[head].tolist()]
        index[head] = len(kinds) + np.arange(len(rows))
        ids, count = gathered([*map(of.__getitem__, kinds), *values], index)
        out.put(rows, ids, np.add.reduceat(count, head))


def _found(mask: pa.Array) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False)
