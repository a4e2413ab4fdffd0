"""MinHash near-duplicates: one permutation, banded buckets, star-shaped candidate edges.

A document's set holds its distinct word shingles.  One hash of every shingle
gives its bin (high bits) and its value; the least value of each of the
``BINS`` bins is the sketch.  An empty bin takes the value of a filled one:
the first of its own fixed random order of bins that is filled (optimal
densification).  The sketch is cut into ``BINS / ROWS`` bands, and equal bands
share a bucket.  With 64 bands of 8, two sets of similarity 0.8 miss each
other with probability 8e-6.

Documents of equal sets are one class.  Within a bucket classes are paired with
one centre only, a star, so the pairs grow with the members and not with their
square.  The centre is the member that meets most others in its buckets: near
copies differ from each other more than from what they have in common, and the
heaviest member is the one nearest to that.  Pairs are confirmed on the full
sets of words, and what hangs on one hub forms a group.  In further turns every
group sends one member of each bucket, drawn anew, to be paired with that of the
bucket's largest group and with a random one.  A group is one row of its bucket
by then, so thousands of near copies never meet pairwise.  A link may be missed
only if its texts share no bucket, or if they and what links them to their
groups fail to meet a centre in ``TURNS`` turns over all the buckets they share.

Cases: a null text, or one without words, has an empty set and is linked with
nothing; fewer words than a shingle give the whole sequence as one; repeated
rows are one class; a null doc_id is kept and never names a component (of
nulls alone it has none), and is not ``kept``; an empty table gives an empty
result; very long texts are taken whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, text_groups, written
from .graph import components

BINS, ROWS = 512, 8
TURNS = 4
_SEED = 71
_SHIFT = np.uint64(64 - BINS.bit_length() + 1)
_ORDER = np.random.default_rng(_SEED).permuted(np.tile(np.arange(BINS), (BINS, 1)), axis=1)


def shingle_set(text: str | None, shingle: int) -> set[bytes]:
    """The distinct shingles of a text (ASCII lower case, words joined by a space)."""
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return set(map(b" ".join, zip(*[words[k:] for k in range(max(1, min(shingle, len(words))))], strict=False))) \
        if len(words) >= shingle else {b" ".join(words)}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(texts: list[str | None], shingle: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct shingles; shingles are told apart by their words, not by the hash."""
    words = [(t or "").encode().lower().split() for t in texts]
    flat = np.empty(sum(map(len, words)), object)
    flat[:] = [w for own in words for w in own]
    codes, distinct = pd.factorize(flat)
    of_word = np.array([xxhash.xxh64_intdigest(w, _SEED) for w in distinct], np.uint64)
    out, at = [], 0
    for own in words:
        c = codes[at:at + len(own)]
        at += len(own)
        size = min(shingle, len(own))
        if not size:
            out.append(np.empty(0, np.uint64))
            continue
        places = np.arange(len(own) - size + 1)
        number = c[places].astype(np.int64)
        for k in range(1, size):
            number = np.unique(number << 32 | c[places + k], return_inverse=True)[1] if k > 1 else number << 32 | c[places + 1]
        first = np.unique(number, return_index=True)[1]
        h = np.full(len(first), size, np.uint64)
        for k in range(size):
            h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + of_word[c[first + k]])
        out.append(np.sort(h))
    return out


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin, empty bins densified; of a non-empty, sorted set."""
    bins = (hashes >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
    out = np.zeros(BINS, np.uint64)
    filled = np.zeros(BINS, bool)
    out[bins[first]], filled[bins[first]] = hashes[first], True
    empty, own = np.flatnonzero(~filled), filled.copy()
    for attempt in range(BINS):
        if not len(empty):
            break
        source = _ORDER[empty, attempt]
        found = own[source]
        out[empty[found]] = out[source[found]]
        empty = empty[~found]
    return out


def bands(sketches: np.ndarray) -> np.ndarray:
    """Bucket keys, a row for each sketch and a column for each band."""
    parts = sketches.reshape(len(sketches), -1, ROWS)
    key = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(ROWS):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def sketched(docs: DataFrame, shingle: int) -> DataFrame:
    """uid, doc_id, text, n_shingles, class_key (digest of the set, null if empty) and bucket keys of every document."""
    schema = "uid long, doc_id long, text string, n_shingles long, class_key binary, keys array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for part, texts in text_groups(batches):
            sets = shingle_hashes(texts, shingle)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if full:
                for i, row in zip(full, bands(np.stack([sketch(sets[i]) for i in full])), strict=True):
                    keys[i] = row
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(uid, uid + len(texts))), part.column("doc_id"), part.column("text"),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["uid", "doc_id", "text", "n_shingles", "class_key", "keys"])
            uid += len(texts)

    return pick(docs, "doc_id", "text").mapInArrow(run, schema)


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, least_percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.  ``texts``: node, text.

    Rows are dealt by (a, part of b), so a centre with many partners spreads
    over tasks; its set is built once for neighbouring rows.
    """
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(parts)))
    centres = dealt.select("a", "part").distinct().join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = dealt.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b") \
        .hint("merge").join(centres, ["a", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            text_a, text_b = batch.column("text_a"), batch.column("text_b")
            keep = []
            for k in range(len(a)):
                if a[k] != last:
                    last, last_set = a[k], shingle_set(text_a[k].as_py(), shingle)
                other = shingle_set(text_b[k].as_py(), shingle)
                common = len(last_set & other)
                keep.append(100 * common >= least_percent * (len(last_set) + len(other) - common))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def bucket_members(classes: DataFrame) -> DataFrame:
    """key, node, size, weight: the members of every bucket of two or more.

    weight: how many others a node meets in its buckets.  The nodes nearest to
    what near copies have in common weigh most, which makes them good centres.
    Buckets are counted with map-side aggregation before members are moved.
    """
    posted = classes.select("node", F.col("n_shingles").alias("size"), F.explode("keys").alias("key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("others")).where("others > 1")
    met = written(posted.join(shared, "key"), "minhash-met")
    weights = met.groupBy("node").agg(F.sum("others").alias("weight"))
    return written(met.drop("others").join(weights, "node").select("key", "node", "size", "weight"), "minhash-members")


def candidate_pairs(members: DataFrame, groups: DataFrame | None, least_percent: int, turn: int) -> DataFrame:
    """(a, b): pairs to confirm in this turn.  ``members``: key, node, size, weight; ``groups``: node, root found so far.

    Every group of a bucket sends one member, a heavy one.  These are paired
    with that of the largest group and, after the first turn, with a random one.
    """
    if groups is None:
        named, heavy = members.withColumn("root", F.col("node")), F.col("weight") * F.lit(1.0)
    else:
        named = members.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
        heavy = F.col("weight") * (1.0 - F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1000)) / 2000.0)  # by 0.5 to 1
    sent = written(named.groupBy("key", "root").agg(F.count("*").alias("n"), F.max(F.struct(heavy.alias("heavy"), "node", "size")).alias("m")), "minhash-sent")
    any_one = F.max_by("m", F.xxhash64("root", "key", F.lit(turn)))
    centres = sent.groupBy("key").agg(F.count("*").alias("count"), F.max(F.struct("n", "m"))["m"].alias("large"), any_one.alias("any_one")) \
        .where("count > 1").select("key", F.explode(F.array("large", *(["any_one"] if turn else []))).alias("x"))
    fits = 100 * F.least("x.size", "m.size") >= least_percent * F.greatest("x.size", "m.size")
    return sent.join(centres, "key").where(fits & F.expr("x.node <> m.node")) \
        .select(F.least("x.node", "m.node").alias("a"), F.greatest("x.node", "m.node").alias("b")).distinct()


def _groups(links: DataFrame) -> DataFrame:
    """node, root: linked nodes by the hub they hang on; a hub that hangs on a larger one takes its nodes along."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degrees = both.groupBy("a").agg(F.count("*").alias("n"))
    beside = both.join(degrees.select(F.col("a").alias("b"), "n"), "b").groupBy("a").agg(F.max(F.struct("n", "b")).alias("m"))
    hub = written(beside.join(degrees, "a").select("a", F.greatest("m", F.struct("n", F.col("a").alias("b")))["b"].alias("hub")), "minhash-hubs")
    over = hub.select(F.col("a").alias("hub"), F.col("hub").alias("root"))
    return hub.join(over, "hub").select(F.col("a").alias("node"), "root")


def links(classes: DataFrame, texts: DataFrame, shingle: int, least_percent: int, turns: int = TURNS) -> DataFrame:
    """(a, b): confirmed links that connect similar classes.  ``classes``: node, n_shingles, keys; ``texts``: node, text."""
    members = bucket_members(classes)
    texts = written(texts.join(members.select("node").distinct(), "node", "left_semi"), "minhash-texts")
    found = tried = None
    for turn in range(turns):
        pairs = candidate_pairs(members, None if turn == 0 else _groups(found), least_percent, turn)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "minhash-pairs")
        new = written(_confirmed(pairs, texts, shingle, least_percent), "minhash-links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = new if found is None else found.unionByName(new)
    return found


def near_duplicates(docs: DataFrame, shingle: int = 5, least_percent: int = 80, turns: int = TURNS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept of every document."""
    rows = written(sketched(docs, shingle), "minhash-sketches")
    narrow = rows.select("uid", "doc_id", "n_shingles", "class_key")
    classes = written(narrow.where("class_key IS NOT NULL").groupBy("class_key")
                      .agg(F.min("uid").alias("node"), F.min("doc_id").alias("first")), "minhash-classes")
    own = written(rows.select(F.col("uid").alias("node"), "n_shingles", "keys").join(classes.select("node"), "node"), "minhash-keys")
    found = links(own, rows.select(F.col("uid").alias("node"), "text"), shingle, least_percent, turns)
    roots = written(components(found), "minhash-roots")
    linked = classes.join(roots, "node")
    named = linked.join(linked.groupBy("root").agg(F.min("first").alias("least")), "root").select("node", "least")
    final = classes.join(named, "node", "left").select("class_key", F.coalesce("least", "first").alias("component"))
    component = F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return narrow.join(final, "class_key", "left").select("doc_id", "n_shingles", component.alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
