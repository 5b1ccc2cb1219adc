"""Packing token sequences by vector bin packing with the dot-product heuristic."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from chatloom.llm.words import utf8

_CACHED_WORDS = 1_000_000
_CACHED_BYTES = 200
#: Marks that may follow the letters of a word; none of them is part of a special token.
_TAIL = b".,;:!?%$&*#)]\""
_ROWS_OUT = 20_000


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold at most, in each dimension at once."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], dtype=np.float64)


def whole_loss(length: int) -> int:
    """Loss-bearing tokens of a piece of plain text: all but the first, which nothing predicts."""
    return max(length - 1, 0)


@dataclass
class Piece:
    """A run of a document's ids; ``data`` holds them, 4 bytes each."""

    key: object
    start: int
    data: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.data) // 4

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.key, self.start, self.data[: 4 * at], self.doc_tokens),
            Piece(self.key, self.start + at, self.data[4 * at :], self.doc_tokens),
        )


class Pool:
    """Open pieces and their demand vectors; fills one sequence at a time.

    The next piece is the one whose demand has the largest dot product with what is left
    of the sequence, both as shares of the limits, among those that fit in every
    dimension. When none fits, the gap is filled by the head of the longest one.
    """

    def __init__(self, limits: Limits, loss: Callable[[int], int]) -> None:
        self.limits, self.loss = limits, loss
        self.cap = limits.vector()
        self.pieces: list[Piece | None] = []
        self.demand = np.zeros((0, 3))
        self.count = 0

    def add(self, pieces: list[Piece]) -> None:
        if not pieces:
            return
        rows = np.array([[p.length, 1, self.loss(p.length)] for p in pieces], dtype=np.float64)
        live = [i for i, p in enumerate(self.pieces) if p is not None]
        self.demand = np.vstack([self.demand[live], rows])
        self.pieces = [self.pieces[i] for i in live] + pieces
        self.count = len(self.pieces)

    def _take(self, i: int) -> Piece:
        piece = self.pieces[i]
        self.pieces[i] = None
        self.demand[i] = np.inf
        self.count -= 1
        return piece

    def sequence(self) -> list[Piece]:
        left, out = self.cap.copy(), []
        shares = np.where(np.isinf(self.demand), 0.0, self.demand / self.cap)
        while self.count:
            fits = (self.demand <= left).all(axis=1)
            if not fits.any():
                break
            gain = np.where(fits, shares @ (left / self.cap), -1.0)
            i = int(gain.argmax())
            left -= self.demand[i]
            out.append(self._take(i))
        room = int(min(left[0], left[2] + (1 if self.loss(1) == 0 else 0)))
        if self.count and room > 0 and left[1] >= 1:
            lengths = np.where(np.isinf(self.demand[:, 0]), -1, self.demand[:, 0])
            i = int(lengths.argmax())
            if lengths[i] > room:
                head, rest = self.pieces[i].cut(room)
                out.append(head)
                self.pieces[i] = rest
                self.demand[i] = [rest.length, 1, self.loss(rest.length)]
        return out


def unpadded(pieces: list[Piece], tokens: int) -> list[list[Piece]]:
    """Split a sequence that is not full into sequences of falling powers of two, which need no padding."""
    left = sum(p.length for p in pieces)
    if left == tokens:
        return [pieces]
    queue, out = list(reversed(pieces)), []
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        now: list[Piece] = []
        while size:
            piece = queue.pop()
            if piece.length > size:
                piece, rest = piece.cut(size)
                queue.append(rest)
            size -= piece.length
            now.append(piece)
        out.append(now)
    return out


def pack_stream(
    documents: Iterator[tuple[object, bytes]],
    limits: Limits,
    *,
    pool_size: int = 1024,
    loss: Callable[[int], int] = whole_loss,
) -> Iterator[list[Piece]]:
    """Sequences of pieces for (key, ids) in order; holds ``pool_size`` remainders at most.

    Full-length runs of a document are sequences of their own; what remains of it goes
    through the pool. Every id lies in exactly one piece.
    """
    pool, fresh, block = Pool(limits, loss), [], limits.tokens
    while loss(block) > limits.loss:
        block //= 2
    for key, data in documents:
        total = len(data) // 4
        for at in range(0, total - total % block, block):
            piece = Piece(key, at, data[4 * at : 4 * (at + block)], total)
            if block == limits.tokens:
                yield [piece]
            else:
                fresh.append(piece)
        if total % block:
            fresh.append(Piece(key, total - total % block, data[4 * (total - total % block) :], total))
        if pool.count + len(fresh) >= pool_size:
            pool.add(fresh)
            fresh = []
            while pool.count > pool_size // 2:
                yield from unpadded(pool.sequence(), limits.tokens)
    pool.add(fresh)
    while pool.count:
        yield from unpadded(pool.sequence(), limits.tokens)


def _letters(word: bytes) -> bool:
    text = word.decode("utf-8", "surrogatepass")
    return text.isalpha() and text.lower().isalpha()


class WordTokenizer:
    """Ids of a tokenizer that never joins words across white space, with a bounded word cache.

    It must also lower letters and never join a letter with the marks of ``_TAIL``, as
    word-level tokenizers do; then a word's letters and the marks after them are known on
    their own.
    """

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.known: dict[bytes, bytes] = {}
        suffix = json.loads(definition)["model"].get("end_of_word_suffix")
        vocab = self.tokenizer.get_vocab()
        #: Whether an id ends a word, if the vocabulary marks that.
        self.ends = np.zeros(max(vocab.values()) + 1, bool) if suffix else None
        if suffix:
            self.ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True

    def _encode(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _encode_letters(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are letters only, all in one text; each has one id that ends it."""
        if not words:
            return []
        text = b" ".join(words).decode("utf-8")
        ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
        if len(stops) != len(words) or stops[-1] != 4 * len(ids):
            return self._encode(words)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def _parts(self, word: bytes) -> tuple[bytes, bytes]:
        stem = word.rstrip(_TAIL)
        if len(stem) < len(word) and not stem[-1:].isalpha():
            last = stem.decode("utf-8", "surrogatepass")[-1:]
            if not (last.isalpha() and last.lower().isalpha()):
                stem = word
        return (stem.lower() if stem.isalpha() else stem), word[len(stem) :]

    def _learn(self, words: list[bytes]) -> None:
        parts = {w: self._parts(w) for w in words}
        fresh = list({p for pair in parts.values() for p in pair if p and p not in self.known})
        letters, others = [], []
        for part in fresh:
            only = self.ends is not None and (part.isalpha() or _letters(part))
            (letters if only else others).append(part)
        self.known.update(zip(letters, self._encode_letters(letters), strict=True))
        self.known.update(zip(others, self._encode(others), strict=True))
        for word, (stem, tail) in parts.items():
            self.known[word] = self.known[stem] + (self.known[tail] if tail else b"")

    def ids(self, text: str | None) -> bytes:
        known, words = self.known, utf8(text).split()
        if len(known) > _CACHED_WORDS:
            known.clear()
        missing = [w for w in set(words) if w not in known]
        long = [w for w in missing if len(w) > _CACHED_BYTES]
        self._learn([w for w in missing if len(w) <= _CACHED_BYTES])
        if long:
            own = dict(zip(long, self._encode(long), strict=True))
            return b"".join([own[w] if w in own else known[w] for w in words])
        return b"".join([known[w] for w in words])


@lru_cache(maxsize=1)
def _tokenizer(definition: str) -> WordTokenizer:
    """One per Python worker, so that its cache serves the next tasks too."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordTokenizer(definition)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    limits: Limits | None = None,
) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all rows.

    A document's ids are the tokenizer's, without special tokens, then ``end_id``; a null
    or empty text is that id alone. Each input partition packs its own documents in one
    pass, so nothing is shuffled and a lost task is simply run again. Sequences have
    ``limits.tokens`` ids or a power of two; ids of sequences hold the partition in the
    upper bits. Repeated rows and repeated or null ids are packed like any others.
    The definition of the tokenizer, a file of fixed size, travels with the tasks.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    limits = limits or Limits()
    id_type = docs.schema[id_col].dataType
    schema = (
        f"`{id_col}` {id_type.simpleString()}, start long, length long, ids_crc32 long, "
        "doc_tokens long, sequence_id long, offset long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = _tokenizer(definition), np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 33
        key_type = None

        def rows() -> Iterator[tuple[object, bytes]]:
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field(0).type
                keys, texts = batch.column(0), batch.column(1)
                for i in range(batch.num_rows):
                    yield keys[i].as_py(), tokenizer.ids(texts[i].as_py()) + end

        def table(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            arrays = [pa.array(columns[0], key_type), *(pa.array(c, pa.int64()) for c in columns[1:])]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays(arrays, names)

        out: list[tuple] = []
        for sequence in pack_stream(rows(), limits):
            offset = 0
            for p in sequence:
                out.append((p.key, p.start, p.length, zlib.crc32(p.data), p.doc_tokens, number, offset))
                offset += p.length
            number += 1
            if len(out) >= _ROWS_OUT:
                yield table(out)
                out = []
        if out:
            yield table(out)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
