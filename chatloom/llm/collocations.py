"""Phrases whose words stand together more often than their parts, counted in quotient filters.

Each shard of texts counts its phrases in a counting quotient filter. A phrase is the packed
numbers of its words; an invertible permutation spreads these keys evenly, the upper bits are
the quotient and say where in the filter a key lies, all other bits are stored as remainder.
So keys can be read back, counts are exact, and sorted filters merge like sorted lists.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.llm.shards import SHARD_BYTES, one_list, packed, shards, tables, unpacked
from chatloom.llm.words import LOWER_BYTES
from chatloom.operators.sequence import global_index
from chatloom.plans.staging import stage

# The characters that end a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
_STOP = b"."
_LOWER = bytes(_STOP[0] if i in ENDS else c for i, c in enumerate(LOWER_BYTES))
_U = np.uint64
#: Keys a range of the merged filter should hold, and keys merged at a time.
RANGE_KEYS = 1 << 20
#: Parts of a language's candidates that are ranked on their own first.
_BUCKETS = 32
#: Words of a shard whose phrases are packed at a time.
_SLICE = 1 << 18


def piece_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a text with a single ``.`` after each piece; no word holds one."""
    words = (text or b"").translate(_LOWER).replace(_STOP, b" . ").split()
    words.append(_STOP)
    return words


class Permutation:
    """An invertible mixing of keys of 2 * ``half`` bits, as pairs of halves (at most 64 bits each)."""

    # Odd factors, so that multiplying modulo a power of two can be undone.
    FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

    def __init__(self, half: int) -> None:
        self.half = half
        self.mask = _U((1 << half) - 1)

    def _round(self, value: np.ndarray, factor: int) -> np.ndarray:
        value = value * _U(factor)
        return (value ^ (value >> _U(29))) * _U(self.FACTORS[0]) >> _U(64 - self.half)

    def there(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for factor in self.FACTORS:
            high, low = low, (high ^ self._round(low + _U(factor % 1000), factor)) & self.mask
        return high, low

    def back(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for factor in reversed(self.FACTORS):
            high, low = (low ^ self._round(high + _U(factor % 1000), factor)) & self.mask, high
        return high, low


@dataclass(frozen=True)
class Packing:
    """Three word numbers of ``bits`` bits as a key of two halves; a missing third word is 0."""

    bits: int

    @property
    def half(self) -> int:
        return (3 * self.bits + 1) // 2

    def pack(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # The middle word is shared by the halves: its upper bits left, its lower bits right.
        spare = _U(self.half - self.bits)
        mask = _U((1 << (self.half - self.bits)) - 1)
        return (a << (_U(self.half - self.bits))) | (b >> spare), ((b & mask) << _U(self.bits)) | c

    def unpack(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        spare = _U(self.half - self.bits)
        mask, word = _U((1 << (self.half - self.bits)) - 1), _U((1 << self.bits) - 1)
        return high >> spare, ((high & mask) << spare) | (low >> _U(self.bits)), low & word


@dataclass
class Filter:
    """A sorted counting filter over permuted keys: halves in order, and their counts."""

    high: np.ndarray
    low: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray, counts: np.ndarray, half: int) -> Filter:
        if 2 * half <= 64:
            joined = (high << _U(half)) | low
            order = np.argsort(joined, kind="stable")
            joined = joined[order]
            first = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]])[: len(joined)])
        else:
            order = np.lexsort((low, high))
            x, y = high[order], low[order]
            first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])[: len(x)])
        if not len(first):
            return cls(high, low, counts)
        return cls(high[order][first], low[order][first], np.add.reduceat(counts[order], first))

    @classmethod
    def counting(cls, high: np.ndarray, low: np.ndarray, half: int) -> Filter:
        """The filter of keys that may repeat."""
        if 2 * half > 64:
            return cls.of(high, low, np.ones(len(high), np.int64), half)
        joined, counts = np.unique((high << _U(half)) | low, return_counts=True)
        return cls(joined >> _U(half), joined & _U((1 << half) - 1), counts)

    @classmethod
    def merged(cls, filters: list[Filter], half: int) -> Filter:
        parts = [np.concatenate([getattr(f, name) for f in filters]) for name in ("high", "low", "counts")]
        return cls.of(*parts, half)

    def cut(self, range_bits: int, half: int) -> Iterator[tuple[int, Filter]]:
        """The filter of each range: keys with equal upper ``range_bits`` bits."""
        owner = (self.high >> _U(half - range_bits)).astype(np.int64)
        edges = np.flatnonzero(np.diff(owner)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(owner)], strict=True):
            if b > a:
                yield int(owner[a]), Filter(self.high[a:b], self.low[a:b], self.counts[a:b])

    def to_bytes(self, range_bits: int, half: int) -> bytes:
        """Quotients as the number of keys of each, remainders in whole bytes, counts in one byte or more.

        Within a range a quotient has about as many bits as it takes to number the keys.
        """
        bits = min(max(len(self.counts).bit_length() - 1, 0), half - range_bits, 24)
        left = half - range_bits - bits
        quotient = ((self.high >> _U(left)) & _U((1 << bits) - 1)).astype(np.int64)
        used = np.bincount(quotient, minlength=1 << bits).astype("<u4")
        rest = self.high & _U((1 << left) - 1)
        small = np.minimum(self.counts, 255).astype(np.uint8)
        return b"".join(
            [
                np.array([len(self.counts), bits], "<u4").tobytes(),
                _short(used, 1 if used.max() < 256 else 4),
                _short(rest, (left + 7) // 8),
                _short(self.low, (half + 7) // 8),
                small.tobytes(),
                self.counts[self.counts >= 255].astype("<i8").tobytes(),
                bytes([1 if used.max() < 256 else 4]),
            ]
        )

    @classmethod
    def from_bytes(cls, data: bytes, owner: int, range_bits: int, half: int) -> Filter:
        n, bits = np.frombuffer(data, "<u4", 2).tolist()
        left, at = half - range_bits - bits, 8
        used, at = _long(data, at, 1 << bits, data[-1])
        rest, at = _long(data, at, n, (left + 7) // 8)
        low, at = _long(data, at, n, (half + 7) // 8)
        counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
        large = counts == 255
        counts[large] = np.frombuffer(data, "<i8", int(large.sum()), at + n)
        quotient = np.repeat(np.arange(1 << bits, dtype=_U), used.astype(np.int64))
        high = (_U(owner) << _U(half - range_bits)) | (quotient << _U(left)) | rest
        return cls(high, low, counts)


def _short(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each value."""
    eight = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return eight[:, :width].tobytes()


def _long(data: bytes, at: int, n: int, width: int) -> tuple[np.ndarray, int]:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    return out.view("<u8").reshape(n), at + n * width


def _numbered(docs: DataFrame, lang_col: str, text_col: str, shard_bytes: int) -> DataFrame:
    """Shards: word numbers in order (0 ends a piece), and (lang, word, n) of each number from 1 on."""

    def build(rows: list[tuple]) -> list[pa.Array]:
        numbers = count(1)
        known: dict[str, defaultdict] = {}
        parts = []
        for lang, text in rows:
            if (number := known.get(lang)) is None:
                number = known[lang] = defaultdict(numbers.__next__)
                number[_STOP] = 0
            words = piece_words(text)
            parts.append(np.fromiter(map(number.__getitem__, words), "<i4", len(words)))
        seq = np.concatenate(parts)
        n_words = sum(len(number) - 1 for number in known.values())
        often = np.bincount(seq, minlength=n_words + 1)
        # By number; numbers of one language are in order among themselves.
        own = [(lang, list(number)[1:], list(number.values())[1:]) for lang, number in known.items()]
        place = np.argsort(np.concatenate([np.array(n, np.int64) for _, _, n in own]))
        words = pa.array([w for _, texts, _ in own for w in texts], pa.binary()).take(pa.array(place))
        langs = pa.array(np.repeat(np.arange(len(own)), [len(n) for _, _, n in own])[place], pa.int32())
        langs = pa.DictionaryArray.from_arrays(langs, pa.array([lang for lang, _, _ in own], pa.string())).cast(pa.string())
        entries = pa.StructArray.from_arrays([langs, words, pa.array(often[1:])], ["lang", "word", "n"])
        return [
            pa.array([packed(seq)], pa.binary()),
            pa.array([n_words + 1], pa.int32()),
            one_list(entries),
        ]

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("t"))
    schema = "seq binary, n_words int, words array<struct<lang:string,word:binary,n:long>>"
    return stage(shards(rows, build, schema, 1, shard_bytes), "word-shards")


def _keys(ids: np.ndarray, packing: Packing, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed phrases of two and three words that begin in the first ``most`` words; 0 belongs to none."""
    a, b = ids[:-1], ids[1:]
    two = (a > 0) & (b > 0)
    three = two[:-1] & two[1:] if len(two) else two
    a, b, two, three = a[:most], b[:most], two[:most], three[:most]
    pair = packing.pack(a[two], b[two], np.zeros(int(two.sum()), _U))
    at = np.flatnonzero(three)
    triple = packing.pack(ids[at], ids[at + 1], ids[at + 2])
    return np.concatenate([pair[0], triple[0]]), np.concatenate([pair[1], triple[1]])


def _merge(filters: DataFrame, packing: Packing, range_bits: int, least: int) -> DataFrame:
    """(w1, w2, w3, a): phrases of at least ``least`` occurrences, ranges merged one at a time."""
    half = packing.half
    names = ["w1", "w2", "w3", "a"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixing = Permutation(half)
        owner, held, size = None, [], 0

        def closed() -> pa.RecordBatch:
            whole = Filter.merged(held, half)
            often = whole.counts >= least
            words = packing.unpack(*mixing.back(whole.high[often], whole.low[often]))
            arrays = [pa.array(w.astype(np.int64)) for w in words] + [pa.array(whole.counts[often])]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for range_, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if range_ != owner:
                    if held:
                        yield closed()
                    owner, held, size = range_, [], 0
                held.append(Filter.from_bytes(data, range_, range_bits, half))
                size += len(held[-1].counts)
                if size > 2 * RANGE_KEYS and len(held) > 1:
                    held = [Filter.merged(held, half)]
                    # What is left are different keys; the next merge waits until they have doubled.
                    size = len(held[0].counts) // 2
        if held:
            yield closed()

    dealt = filters.repartition("range").sortWithinPartitions("range")
    return dealt.select("range", "data").mapInArrow(run, "w1 long, w2 long, w3 long, a long")


@dataclass(frozen=True)
class PhraseCounts:
    """``words`` (id, lang, word, n) of the words at least ``least`` often, ``totals`` (lang, n) of all
    words, and ``phrases`` (w1, w2, w3, a): word ids, w3 is 0 in phrases of two words."""

    words: DataFrame
    totals: DataFrame
    phrases: DataFrame


def phrase_counts(
    docs: DataFrame,
    *,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = 10,
    shard_bytes: int = SHARD_BYTES,
    bits: int | None = None,
) -> PhraseCounts:
    """Exact counts of the phrases of two and three words that occur ``least`` times in a language.

    A phrase that often has words that often, so only those get numbers and keys.
    """
    parts = _numbered(docs, lang_col, text_col, shard_bytes)
    vocab = parts.select("shard", F.posexplode("words").alias("pos", "w")).select(
        "shard", (F.col("pos") + 1).alias("local"), "w.*"
    )
    counts = stage(vocab.groupBy("lang", "word").agg(F.sum("n").alias("n")), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    often = counts.where(F.col("n") >= least)
    words = stage(global_index(often, ["lang", "word"], "_at").select((F.col("_at") + 1).alias("id"), "lang", "word", "n"), "words")
    size = words.agg(F.coalesce(F.max("id"), F.lit(1)).alias("most"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    packing = Packing(max(bits or 0, size.most.bit_length(), 8))
    # About two phrases a word; a range's keys then fit a task with room to spare.
    range_bits = min(max((2 * size.n // RANGE_KEYS).bit_length(), 1), packing.half - 1)

    found = vocab.join(words.select("lang", "word", "id"), ["lang", "word"]).select("shard", "local", "id")
    known = stage(tables(found, F.struct("local", "id")), "word-numbers")
    joined = parts.select("shard", "seq", "n_words").join(known, "shard").select(
        "seq", "n_words", F.col("known.local").alias("local"), F.col("known.id").alias("id")
    )
    half = packing.half

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixing = Permutation(half)
        for batch in batches:
            for i in range(batch.num_rows):
                number = np.zeros(batch.column(1)[i].as_py(), _U)
                local, ids = (batch.column(k)[i].values.to_numpy(zero_copy_only=False) for k in (2, 3))
                number[local] = ids
                seq = unpacked(batch.column(0)[i].as_py())
                counted = Filter.merged(
                    [
                        Filter.counting(*mixing.there(*_keys(number[seq[at : at + _SLICE + 2]], packing, _SLICE)), half)
                        for at in range(0, len(seq), _SLICE)
                    ],
                    half,
                )
                for owner, part in counted.cut(range_bits, half):
                    data = part.to_bytes(range_bits, half)
                    yield pa.RecordBatch.from_arrays([pa.array([owner], pa.int32()), pa.array([data], pa.binary())], ["range", "data"])

    filters = joined.mapInArrow(run, "range int, data binary")
    phrases = stage(_merge(filters, packing, range_bits, least), "phrases")
    return PhraseCounts(words, totals, phrases)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly: counts up to 15 digits."""
    wide = [c.cast("decimal(15,0)") for c in (a, left, right)]
    top = F.lit(1_000_000).cast("decimal(7,0)") * (wide[0] * wide[0])
    return F.call_function("div", top, wide[1] * wide[2])


def collocations(
    docs: DataFrame,
    *,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = 10,
    inside: int = 50,
    top: int | None = 2000,
    shard_bytes: int = SHARD_BYTES,
    bits: int | None = None,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language, or all of them.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and into words at
    spaces and tabs. Candidates are phrases of two or three words that occur ``least`` times
    in a language. A candidate is cut where ``score`` is lowest; one of two words that lies in a
    longer one with ``inside`` percent of its occurrences is dropped. Null texts are empty, a
    null language is ``und``; repeated rows count each time, and languages without a
    candidate have no row. Other columns are not read.
    """
    counted = phrase_counts(
        docs, lang_col=lang_col, text_col=text_col, least=least, shard_bytes=shard_bytes, bits=bits
    )
    words, phrases = counted.words, counted.phrases
    word = {k: words.select(F.col("id").alias(f"w{k}"), F.col("n").alias(f"n{k}")) for k in (1, 2, 3)}
    pairs = stage(
        phrases.where("w3 = 0").join(word[1], "w1").join(word[2], "w2").select("w1", "w2", "n1", "n2", "a"), "pairs"
    )
    triples = phrases.where("w3 > 0")
    heads = pairs.select("w1", "w2", "n1", F.col("a").alias("head"))
    tails = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n2").alias("n3"), F.col("a").alias("tail"))
    # Both parts of a candidate occur at least as often, so they are all there.
    triples = stage(
        triples.join(heads, ["w1", "w2"]).join(tails, ["w2", "w3"]).select(
            "w1", "w2", "w3", "a", "n1", "n3", "head", "tail",
            _score(F.col("a"), F.col("n1"), F.col("tail")).alias("s1"),
            _score(F.col("a"), F.col("head"), F.col("n3")).alias("s2"),
        ),
        "triples",
    )
    longer = (
        triples.select("w1", "w2", "a")
        .unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
        .groupBy("w1", "w2")
        .agg(F.max("a").alias("most"))
    )
    kept = pairs.join(longer, ["w1", "w2"], "left").where(
        F.coalesce(100 * F.col("most") < inside * F.col("a"), F.lit(True))
    )
    first = F.col("s1") <= F.col("s2")
    scored = kept.select(
        "w1", "w2", F.lit(0).cast("long").alias("w3"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"),
        _score(F.col("a"), F.col("n1"), F.col("n2")).alias("score"),
    ).unionByName(
        triples.select(
            "w1", "w2", "w3", "a",
            F.when(first, F.col("n1")).otherwise(F.col("head")).alias("l"),
            F.when(first, F.col("tail")).otherwise(F.col("n3")).alias("r"),
            F.least("s1", "s2").alias("score"),
        )
    )
    text = {k: words.select(F.col("id").alias(f"w{k}"), F.col("word").cast("string").alias(f"t{k}")) for k in (2, 3)}
    named = (
        scored.join(words.select(F.col("id").alias("w1"), "lang", F.col("word").cast("string").alias("t1")), "w1")
        .join(text[2], "w2")
        .join(text[3], "w3", "left")
        .select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), "a", "l", "r", "score")
    )
    ranked = named.withColumn("rank", F.lit(None).cast("int"))
    if top is not None:
        # The best of each of some buckets first, so that one task ranks a bounded number.
        best = (F.desc("score"), F.desc("a"), "phrase")
        for share in ([F.pmod(F.hash("phrase"), F.lit(_BUCKETS))], []):
            place = F.row_number().over(Window.partitionBy("lang", *share).orderBy(*best))
            ranked = ranked.withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.join(counted.totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
