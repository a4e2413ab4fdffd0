"""SimHash near-duplicates with Golay-code fuzzy keys.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each
read as a word of the perfect binary Golay code (23, 12): every word lies
within three bits of exactly one codeword.  Decoding a segment and its
one-bit neighbours gives one or six codeword indices; a segment that differs
in one bit at most decodes to one of them.  Three differing bits in three
segments leave, by the pigeonhole principle, either

* one equal segment and another with one error at most: the key is the equal
  segment and a codeword index of the other (33 to 34 bits, six orders), or
* one error in each: the key is an index of each and their parities (39 bits).

One side of the join posts all keys of a fingerprint, the other only its own
indices; pairs that meet are verified by their bit distance, so no link is
lost and none is wrong.  Fingerprints are made distinct first: copies never
meet each other, and distinct fingerprints within three bits of one another
are few by geometry (at most 128 of them pairwise, whatever the corpus).

Cases: a null text, or one without words, has fingerprint zero, linked like any other; fewer
words than a shingle give one shingle of them all; repeated rows share a
fingerprint; a null doc_id is kept and never names a component unless all its
members are null; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import pick, text_groups, unused, written
from .graph import components

_SEED = 42
_GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, fixed value of the code
_LENGTH, _CHECK = 23, 11
_CUTS = ((0, 22), (22, 21), (43, 21))
MAX_DISTANCE = 3


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the words' shingles (ASCII lower case, repeats counted)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    run = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        hashes = [xxhash.xxh64_intdigest(run, _SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:n - 1] + 1])
        hashes = [xxhash.xxh64_intdigest(run[a:b], _SEED)
                  for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, extra: tuple[str, ...] = ("doc_id",), fp: str = "fp", uid: str = "uid") -> DataFrame:
    """The ``extra`` columns, the fingerprint as a signed long, and a number for each row."""
    own = docs.select(*dict.fromkeys((*extra, "text")))
    schema = StructType([*own.select(*extra).schema.fields, StructField(fp, LongType()), StructField(uid, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for part, texts in text_groups(batches):
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in extra], pa.array(fps), pa.array(np.arange(at, at + len(fps)))], [*extra, fp, uid])
            at += len(fps)

    return own.mapInArrow(run, schema)


def _syndromes(words: np.ndarray) -> np.ndarray:
    rest = words.copy()
    for shift in range(_LENGTH - 1, _CHECK - 1, -1):
        rest ^= ((rest >> shift) & 1) * (_GENERATOR << (shift - _CHECK))
    return rest


def _error_table() -> np.ndarray:
    """The at most three wrong bits that belong to each syndrome."""
    one = 1 << np.arange(_LENGTH, dtype=np.int64)
    table = np.zeros(1 << _CHECK, np.int64)
    for count in (1, 2, 3):
        places = np.indices((_LENGTH,) * count).reshape(count, -1)
        places = places[:, np.all(places[1:] > places[:-1], axis=0)]
        errors = one[places].sum(axis=0)
        table[_syndromes(errors)] = errors
    return table


_ERRORS = _error_table()


def codeword_index(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    return (words ^ _ERRORS[_syndromes(words)]) >> _CHECK


def _nearby(words: np.ndarray, bits: int) -> np.ndarray:
    """Indices of each word and its one-bit neighbours: six columns, -1 where there are fewer."""
    flips = np.concatenate([[0], 1 << np.arange(bits, dtype=np.int64)])
    found = np.sort(codeword_index((words[:, None] ^ flips[None, :]).ravel()).reshape(len(words), -1), axis=1)
    fresh = np.ones_like(found, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    place = np.cumsum(fresh, axis=1) - 1
    out = np.full((len(words), 6), -1, np.int64)
    rows, cols = np.nonzero(fresh)
    out[rows, place[rows, cols]] = found[rows, cols]
    return out


_ORDERS = [(a, b) for a in range(3) for b in range(3) if a != b]


def _keys(fps: np.ndarray, every: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, row of each key).  ``every``: keys of all fingerprints within the errors a case allows; else own keys."""
    u = fps.view(np.uint64)
    parts = [((u >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in _CUTS]
    index = [_nearby(p, bits) if every else codeword_index(p)[:, None] for p, (_, bits) in zip(parts, _CUTS, strict=True)]
    for k, (a, b) in enumerate(_ORDERS):
        rows, cols = np.nonzero(index[b] >= 0)
        yield (np.int64(k + 1) << 48) | (parts[a][rows] << 12) | index[b][rows, cols], rows
    parity = sum((np.bitwise_count(p).astype(np.int64) & 1) << i for i, p in enumerate(parts))
    parity = parity ^ 7 if every else parity
    all3 = (index[0][:, :, None, None] >= 0) & (index[1][:, None, :, None] >= 0) & (index[2][:, None, None, :] >= 0)
    rows, i, j, k = np.nonzero(all3)
    yield (np.int64(8) << 48) | (parity[rows] << 36) | (index[0][rows, i] << 24) | (index[1][rows, j] << 12) | index[2][rows, k], rows


def _posted(distinct: DataFrame, every: bool, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for i in range(0, len(fps), 2000):
                some = fps[i:i + 2000]
                for keys, rows in _keys(some, every):
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(some[rows])], ["key", name])

    return distinct.select("fp").mapInArrow(run, f"key long, {name} long")


def links(distinct: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(a, b): pairs of distinct fingerprints that differ in ``max_distance`` (at most 3) bits or fewer, a < b."""
    if not 0 <= max_distance <= MAX_DISTANCE:
        raise ValueError(f"the code's segments cover up to {MAX_DISTANCE} differing bits")
    one, other = _posted(distinct, True, "a"), _posted(distinct, False, "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
    return one.hint("merge").join(other, (one["key"] == other["key"]) & near).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links) of every document."""
    prints = written(fingerprints(pick(docs, "doc_id", "text"), shingle).drop("uid"), "simhash")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(distinct, max_distance)).withColumnRenamed("node", "fp")
    linked = distinct.join(roots, "fp")
    named = linked.join(linked.groupBy("root").agg(F.min("first").alias("least")), "root").select("fp", "least")
    final = distinct.join(named, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return prints.join(final, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the one of smallest doc_id (nulls last) stays."""
    columns = docs.columns
    fp, uid = unused("fp", columns), unused("uid", columns)
    rows = written(fingerprints(docs, shingle, tuple(columns), fp, uid), "simhash-rows")
    first = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col(uid).alias("uid"))
    distinct = written(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(first).alias("first")), "simhash-distinct")
    roots = components(links(distinct, max_distance)).withColumnRenamed("node", "fp")
    stay = distinct.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")) \
        .agg(F.min("first").alias("first")).select(F.col("first.uid").alias(uid))
    return rows.join(stay, uid, "left_semi").select(*columns)
