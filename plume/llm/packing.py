"""Best-fit packing of token sequences by hierarchical residual rounds.

Documents are encoded, closed with an end id, and cut into pieces only if they
are longer than a sequence.  Full pieces are sequences already.  The others
are dealt into groups of a bounded number of items; each group is packed best
fit (longest item first, into the fullest bin with room).  Nearly full bins
are emitted; the underfull ones become items of the next round, in fewer
groups, until one group is left.  When a round merges little, only its emptiest
bins go on, so the tree ends in one group that holds all that could still merge.

Cases: a null or empty text is the end id alone; repeated rows are packed each
for itself; ties go by piece number; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, text_groups, written
from .words import WordCache, segments, special_pattern

_PIECE = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = _PIECE + ", sequence_id long, offset long, fill long, done boolean"


@lru_cache(maxsize=2)
def _encoder(path: str):
    """(word cache of little-endian ids, special ids, their pattern) of a byte-level tokenizer file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}

    line_break = np.array(tokenizer.encode("\n", add_special_tokens=False).ids, "<u4")

    def encode(words: list[str]) -> list[bytes]:
        """Words are encoded in one call, a line each: a line break ends every word and is one id that no other word has."""
        out: list[bytes | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if not any(map(str.isspace, w[1:])) and not w.isspace()]
        lines = "".join([words[i] + "\n" for i in plain])
        ids = np.array(tokenizer.encode_batch_fast([lines], add_special_tokens=False)[0].ids, "<u4")
        breaks = np.flatnonzero(ids == line_break[0])
        if plain and len(line_break) == 1 and len(breaks) == len(plain):
            for i, a, b in zip(plain, np.append(0, breaks[:-1] + 1).tolist(), breaks.tolist(), strict=True):
                out[i] = ids[a:b].tobytes()
        rest = [i for i, v in enumerate(out) if v is None]
        for i, e in zip(rest, tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    return WordCache(encode), special, special_pattern(special)


def token_bytes(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers."""
    cache, special, pattern = _encoder(path)
    plan, parts = [], []
    for t in texts:
        row = []
        for k, s in enumerate(segments(t or "", pattern)):
            if k % 2:
                row.append(np.uint32(special[s]).tobytes())
            elif s:
                row.append(len(parts))
                parts.append(s)
        plan.append(row)
    if parts:
        values, which, bounds = cache.lookup(parts, joins_space=True)
    return [b"".join(x if isinstance(x, bytes) else b"".join([values[i] for i in which[bounds[x]:bounds[x + 1]].tolist()])
                     for x in row) for row in plan]


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """uid, doc_id, piece, start, length, ids_crc32: the pieces of every document, the first one the shorter."""
    end = np.uint32(end_id).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for part, texts in text_groups(batches):
            rows: list[tuple] = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), token_bytes(texts, vocabulary), strict=True):
                ids += end
                n = len(ids) // 4
                first = (n - 1) % capacity + 1
                begin = 0
                for k, stop in enumerate(range(first, n + 1, capacity)):
                    rows.append((uid, doc_id, k, begin, stop - begin, zlib.crc32(ids[4 * begin:4 * stop])))
                    begin, uid = stop, uid + 1
            names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return pick(docs, "doc_id", "text").mapInArrow(run, _PIECE)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of items given longest first: each goes to the fullest bin that has room."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has exactly r left
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, n in enumerate(lengths.tolist()):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - room
        left = room - n
        by_room[left].append(b)
        rooms |= 1 << left
    return bins, offsets


def _round(capacity: int, nearly: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="grp")
        items = rows.groupby("sequence_id", sort=True).agg(fill=("fill", "first")).reset_index()
        items = items.sort_values(["fill", "sequence_id"], ascending=[False, True], kind="stable")
        bins, offsets = best_fit(items["fill"].to_numpy(), capacity)
        first = items.groupby(bins)["sequence_id"].transform("first").to_numpy()  # a bin is named after its longest item
        fill = items.groupby(bins)["fill"].transform("sum").to_numpy()
        at = pd.DataFrame({"bin": first, "base": offsets, "total": fill}, index=items["sequence_id"].to_numpy())
        own = at.loc[rows["sequence_id"]]
        return rows.assign(sequence_id=own["bin"].to_numpy(), offset=rows["offset"].to_numpy() + own["base"].to_numpy(),
                           fill=own["total"].to_numpy(), done=own["total"].to_numpy() >= nearly)
    return pack


def _emptiest(open_bins: DataFrame, capacity: int, most: int) -> tuple[int, int]:
    """(fill, bins up to it): at least half of ``capacity``, and the largest with at most ``most`` bins beyond that.

    One row for each possible fill comes to the driver.
    """
    sizes = {r.fill: r.n for r in open_bins.groupBy("fill").agg(F.count_distinct("sequence_id").alias("n")).collect()}
    bound = capacity // 2
    count = sum(n for fill, n in sizes.items() if fill <= bound)
    for fill in sorted(f for f in sizes if f > capacity // 2):
        if count + sizes[fill] > most:
            break
        bound, count = fill, count + sizes[fill]
    return bound, count


def packed(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, group_items: int = 50_000,
           nearly_full: float = 0.995, least_gain: float = 0.02) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    ``group_items``: items of one group, which is what one task holds.  Each
    round deals the underfull bins of the one before into groups of that size,
    so the groups merge as a tree whose fan-in follows from how few bins a
    group leaves.  After a round that merged fewer than ``least_gain`` of its
    bins the others are emitted and only the emptiest go on: all that are at
    most half full (two bins that fit together have one such; best fit leaves
    at most one a group) and as many more, in the order of their room, as one
    group holds.  So the number of bins falls to one group's, which is the last.
    """
    nearly = int(np.ceil(capacity * nearly_full))
    cut = written(pieces(docs, vocabulary, capacity, end_id), "pieces").withColumns({
        "sequence_id": F.col("uid"), "offset": F.lit(0).cast("long"), "fill": F.col("length"),
        "done": F.col("length") == capacity})
    out, todo = cut.where("done"), cut.where("NOT done")
    count, rounds = todo.count(), 0
    while count:
        before, groups = count, -(-count // group_items)
        dealt = todo.withColumn("grp", F.pmod(F.xxhash64("sequence_id", F.lit(rounds)), F.lit(groups)))
        result = written(dealt.groupBy("grp").applyInPandas(_round(capacity, nearly), _PLACED), "packing-round")
        made = result.agg(F.count_distinct("sequence_id").alias("bins"),
                          F.count_distinct(F.when(~F.col("done"), F.col("sequence_id"))).alias("open")).first()
        if groups == 1 or made["open"] == 0:
            out = out.unionByName(result)
            break
        on, count = ~F.col("done"), made["open"]
        if made["bins"] > (1 - least_gain) * before:
            bound, count = _emptiest(result.where(on), capacity, group_items)
            on = on & (F.col("fill") <= bound)
        out, todo, rounds = out.unionByName(result.where(~on)), result.where(on), rounds + 1
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
