"""Token ids in shards, each a wavelet matrix that answers access, count and occurrence queries without being unpacked.

A shard is one binary image: a header, the alphabet, the documents' lengths, and for each bit of the alphabet, highest
first, a rank directory and a plane of n bits. A plane is stably sorted by its bit (zeros first) to give the order of the next
one. Images are rows of a Parquet table that Spark writes and commits, so that a lost executor's shards are written
again by another, and any store that Spark can write will do.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.chunks import ChunkEncoder, slices, with_ends
from catalens.llm.common import byte_letters, byte_shower, partitions_for, shared_path

MAGIC, BLOCK = b"WMX2", 512
#: A shard is closed once it holds so many tokens (a longer document makes a longer shard).
SHARD_TOKENS = 1 << 19


class WaveletMatrix:
    """A sequence of unsigned ints below 2**32, in documents that end at ``ends``.

    ``ranks`` has for each plane how many ones stand before each block of ``BLOCK`` bits: rank reads one entry and one
    block, and select finds its block by binary search among the entries.
    """

    def __init__(self, n: int, alphabet: np.ndarray, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray], ends: np.ndarray):
        self.n, self.alphabet, self.planes, self.zeros, self.ranks, self.ends = n, alphabet, planes, zeros, ranks, ends

    @classmethod
    def build(cls, ids: np.ndarray, ends: np.ndarray | None = None) -> WaveletMatrix:
        seen = np.zeros(int(ids.max()) + 1 if len(ids) else 0, bool)
        seen[ids] = True
        alphabet = np.flatnonzero(seen).astype(np.uint32)
        code = np.zeros(len(seen), np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
        code[alphabet] = np.arange(len(alphabet))
        now = code[ids]
        planes, zeros, ranks = [], [], []
        for level in range(max(0, len(alphabet) - 1).bit_length() - 1, -1, -1):
            bit = ((now >> level) & 1).view(now.dtype).astype(bool)
            planes.append(np.packbits(bit))
            per = np.add.reduceat(np.bitwise_count(planes[-1]).astype(np.uint32), np.arange(0, len(planes[-1]), BLOCK // 8))
            ranks.append(np.concatenate([np.zeros(1, np.uint32), np.cumsum(per, dtype=np.uint32)]))
            low = np.compress(~bit, now)  # much faster than a mask as index
            zeros.append(len(low))
            now = np.concatenate([low, np.compress(bit, now)])
        return cls(len(ids), alphabet, planes, zeros, ranks, np.array([len(ids)] if ends is None else ends, np.int64))

    def to_bytes(self) -> bytes:
        head = struct.pack("<4sQIBQ", MAGIC, self.n, len(self.alphabet), len(self.planes), len(self.ends))
        gaps = np.diff(self.alphabet, prepend=np.uint32(0)).astype("<u4")
        sizes = np.diff(self.ends, prepend=0).astype("<u4")
        both = (x for r, p in zip(self.ranks, self.planes) for x in (r.astype("<u4").tobytes(), p.tobytes()))
        return b"".join([head, gaps.tobytes(), sizes.tobytes(), np.array(self.zeros, "<u8").tobytes(), *both])

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        magic, n, k, levels, docs = struct.unpack_from("<4sQIBQ", data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        at = struct.calcsize("<4sQIBQ")
        alphabet = np.cumsum(np.frombuffer(data, "<u4", k, at), dtype=np.uint32)
        ends = np.cumsum(np.frombuffer(data, "<u4", docs, at := at + 4 * k), dtype=np.int64)
        zeros = np.frombuffer(data, "<u8", levels, at := at + 4 * docs).tolist()
        at, width = at + 8 * levels, -(-n // 8)
        blocks = -(-width // (BLOCK // 8)) + 1
        planes, ranks = [], []
        for _ in range(levels):
            ranks.append(np.frombuffer(data, "<u4", blocks, at))
            planes.append(np.frombuffer(data, np.uint8, width, at + 4 * blocks))
            at += 4 * blocks + width
        return cls(n, alphabet, planes, zeros, ranks, ends)

    def _blocks(self, level: int, block: np.ndarray) -> np.ndarray:
        """The bits of some blocks, a row each; places behind the end are 0."""
        plane = self.planes[level]
        at = block[:, None] * (BLOCK // 8) + np.arange(BLOCK // 8)
        return np.unpackbits(np.where(at < len(plane), plane[np.minimum(at, len(plane) - 1)], 0).astype(np.uint8), axis=1)

    def _rank1(self, level: int, at: np.ndarray) -> np.ndarray:
        """How many ones the plane has before each place."""
        block = np.minimum(at // BLOCK, len(self.ranks[level]) - 1)
        inside = self._blocks(level, block) * (np.arange(BLOCK) < (at - block * BLOCK)[:, None])
        return self.ranks[level][block].astype(np.int64) + inside.sum(1, dtype=np.int64)

    def _select(self, level: int, one: int, nth: np.ndarray) -> np.ndarray:
        """The places of a plane's nth ones or zeros, from 0."""
        before = self.ranks[level].astype(np.int64)
        if not one:
            before = np.arange(len(before)) * BLOCK - before
        block = np.searchsorted(before, nth, "right") - 1
        hit = self._blocks(level, block) == one
        return block * BLOCK + (np.cumsum(hit, 1, dtype=np.int32) > (nth - before[block])[:, None]).argmax(1)

    def _bit(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at >> 3].astype(np.int64) >> (7 - (at & 7))) & 1

    def access(self, at) -> np.ndarray:
        """The tokens at some places."""
        at = np.asarray(at, np.int64)
        code = np.zeros(at.shape, np.int64)
        for level, zero in enumerate(self.zeros):
            bit, ones = self._bit(level, at), self._rank1(level, at)
            code = code * 2 + bit
            at = np.where(bit == 1, zero + ones, at - ones)
        return self.alphabet[code]

    def document(self, nth: int) -> np.ndarray:
        """The tokens of one document."""
        return self.access(np.arange(self.ends[nth - 1] if nth else 0, self.ends[nth]))

    def _code(self, token: int) -> int:
        code = int(np.searchsorted(self.alphabet, token))
        return code if code < len(self.alphabet) and self.alphabet[code] == token else -1

    def rank(self, token: int, before: int) -> int:
        """How often the token stands before a place."""
        span = self._span(token, before)
        return span[1] - span[0]

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _span(self, token: int, before: int) -> tuple[int, int]:
        code = self._code(token)
        if code < 0:
            return 0, 0
        a, b, top = 0, before, len(self.planes) - 1
        for level, zero in enumerate(self.zeros):
            ra, rb = self._rank1(level, np.array([a, b])).tolist()
            a, b = (zero + ra, zero + rb) if code >> (top - level) & 1 else (a - ra, b - rb)
        return a, b

    def select(self, token: int, nth: int) -> int:
        """The place of the token's nth occurrence, from 0."""
        a, b = self._span(token, self.n)
        if not 0 <= nth < b - a:
            raise IndexError("no such occurrence")
        return int(self._up(self._code(token), np.array([a + nth]))[0])

    def occurrences(self, token: int) -> np.ndarray:
        """All places of the token, ascending."""
        a, b = self._span(token, self.n)
        code = self._code(token)
        parts = [self._up(code, np.arange(s, min(b, s + 4096))) for s in range(a, b, 4096)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _up(self, code: int, at: np.ndarray) -> np.ndarray:
        """From places in the order behind the last plane to places of the sequence."""
        top = len(self.planes) - 1
        for level in range(top, -1, -1):
            one = code >> (top - level) & 1
            at = self._select(level, one, at - self.zeros[level] if one else at)
        return at

    def sequence(self) -> np.ndarray:
        """All tokens, from the last plane's order back to the first's."""
        top = len(self.planes) - 1
        now = np.zeros(self.n, np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32)
        for level in range(top, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n).view(bool)
            up, zero = np.empty_like(now), self.zeros[level]
            up[np.flatnonzero(~bit)] = now[:zero]
            up[np.flatnonzero(bit)] = now[zero:] | now.dtype.type(1 << (top - level))
            now = up
        return self.alphabet[now]


_ENCODERS: dict[str, ChunkEncoder] = {}


def byte_level_encoder(path: str) -> ChunkEncoder:
    """The encoder of a byte-level BPE file of the tokenizers library, kept by each Python worker.

    Its model is asked for each distinct match of the pre-tokenizer's pattern once. Added tokens are found in a text as the library finds them.
    """
    if path not in _ENCODERS:
        import regex
        from tokenizers import Tokenizer

        from catalens.llm.byte_bpe import PATTERN

        tokenizer = Tokenizer.from_file(path)
        tokenize, space, shown = tokenizer.model.tokenize, chr(byte_letters()[32]), byte_shower()
        added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}

        def ids(piece: str) -> bytes:
            word = piece[1:] if piece[:1] == " " else piece
            if word.isalnum() and word.isascii():  # letters and digits stand for their own bytes
                letters = space + word if word is not piece else word
            else:
                letters = shown(piece)
            return array("I", [t.id for t in tokenize(letters)]).tobytes()

        _ENCODERS[path] = ChunkEncoder(regex.compile(PATTERN).findall, ids, 1_400_000, added)
    return _ENCODERS[path]


def write_shards(df: DataFrame, encoder: Callable[[], ChunkEncoder], end_id: int, to: str, text: str = "text", doc_id: str = "doc_id", partitions: int | None = None) -> None:
    """Write the ids of each whole text, ``end_id`` behind it, as wavelet shards in ascending order of ``doc_id`` to folder ``to``.

    Rows are dealt by ranges of doc_id and, among rows of one id, of a hash of the text, so the order is global; null ids
    come first, repeated rows stay, side by side. A null or empty text is the end id alone. An empty table gives a table without rows.
    """
    n = partitions or partitions_for(df.sparkSession)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    dealt = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(), TaskContext.get().partitionId(), 0

        def image(docs: pa.Array, ids: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
            matrix = WaveletMatrix.build(ids, ends)
            listed = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()), listed, pa.array([matrix.to_bytes()], pa.binary())], names=["part", "before", "n_tokens", "docs", "image"])

        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        tokens = 0
        for batch in batches:
            for rows in slices(batch, "text"):
                ids, count = with_ends(*encode.column(rows.column(1)), end_id)
                docs, ends = rows.column(0), np.cumsum(count)
                while len(ends):  # whole documents, up to the first that fills a shard
                    k = min(len(ends), int(np.searchsorted(ends, SHARD_TOKENS - tokens)) + 1)
                    size = int(ends[k - 1])
                    held.append((docs[:k], ids[:size], ends[:k] + tokens))
                    docs, ids, ends, tokens = docs[k:], ids[size:], ends[k:] - size, tokens + size
                    if tokens >= SHARD_TOKENS:
                        yield image(*_joined(held))
                        before, held, tokens = before + tokens, [], 0
        if held:
            yield image(*_joined(held))

    dealt.mapInArrow(run, "part int, before long, n_tokens long, docs array<long>, image binary").write.option("compression", "zstd").parquet(to)


def _joined(held: list[tuple]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    docs, ids, ends = zip(*held)
    return pa.concat_arrays(docs), np.concatenate(ids), np.concatenate(ends)


def read_shards(spark, path: str) -> DataFrame:
    """The documents of a folder of shards: doc_id, start (ids of all documents before it), ids (little-endian uint32, end id included)."""
    shards = spark.read.parquet(path)
    sizes = sorted((r["part"], r["n"]) for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # one row for each task of the writer
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    firsts = spark.createDataFrame(starts, "part int, first long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, docs, image = (batch.column(i)[row] for i in range(3))
                matrix = WaveletMatrix.from_bytes(image.as_py())
                ids = matrix.sequence().astype("<u4")
                edges = np.concatenate([[0], matrix.ends])
                cells = pa.Array.from_buffers(pa.binary(), len(matrix.ends), [None, pa.py_buffer((4 * edges).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([docs.values, pa.array(edges[:-1] + start.as_py()), cells], names=["doc_id", "start", "ids"])

    return shards.join(F.broadcast(firsts), "part").select((F.col("first") + F.col("before")).alias("start"), "docs", "image").mapInArrow(run, "doc_id long, start long, ids binary")


def op9_wavelet(documents: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Per document, from the files read back: doc_id, start, n_tokens and ids_crc32."""
    spark = documents.sparkSession
    folder = shared_path(spark, "wavelet")
    write_shards(documents, lambda: byte_level_encoder(path), end_id, folder)
    return read_shards(spark, folder).select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
