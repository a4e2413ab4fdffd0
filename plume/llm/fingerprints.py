"""Document fingerprints: one-permutation MinHash, densified, packed and bias-corrected.

Every shingle of a text is hashed once; the hash's high bits choose one of
``BINS`` bins and the smallest hash of each bin is its value.  An empty bin
takes the value of the first non-empty bin in a random order of its own
(optimal densification).  Of each value only ``BITS`` low-order bits are kept,
packed into longs.  Two fingerprints agree by chance in 1 / 2**BITS of their
bins, which the likeness corrects.

Everything is array expressions inside the row.  Sorting a text's hashes with
one marker per bin puts each bin's smallest hash at its front, or the marker
if the bin is empty.

Cases: a null text counts as empty; a text of fewer words than a shingle is
one shingle, so texts without words equal each other and nothing else;
repeated rows have equal fingerprints; very long texts are hashed whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, pick, unused

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 4
_PER_LONG = 64 // BITS
_LOW = (1 << (64 - BIN_BITS)) - 1  # a marker is the largest number of its bin


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def _hash_words(w: Column, shingle: int) -> Column:
    """Hashes of the shingles of ``shingle`` words, or of all words if there are fewer."""
    several = F.transform(F.sequence(F.lit(0), F.size(w) - shingle),
                          lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)]))
    return F.when(F.size(w) > shingle, several).otherwise(F.array(F.xxhash64(F.array_join(w, " "))))


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BIN_BITS)


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def with_fingerprint(docs: DataFrame, text: str, name: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the packed fingerprint (array of longs) of column ``text`` as ``name``."""
    own, columns = docs, docs.columns
    markers = F.array(*[F.lit(_signed((b << (64 - BIN_BITS)) | _LOW)) for b in range(BINS)])
    w, h, d = (unused(f"{name}_{x}", columns) for x in ("words", "hashes", "dense"))
    own = own.withColumn(w, words(F.col(text)))
    own = own.select(*columns, F.concat(_hash_words(F.col(w), shingle), markers).alias(h))
    own = own.select(*columns, F.sort_array(h).alias(h))
    own = own.select(*columns, F.filter(
        h, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(F.col(h), i - 1)))).alias(d))
    marker = F.lit(_LOW)
    low = F.lit((1 << BITS) - 1)

    def kept(x: Column, home: Column) -> Column:
        """The bits kept of a hash: from another of its eight low groups by bin, so that bins that share a hash differ."""
        return F.call_function("shiftright", x, (home.bitwiseAND(F.lit(7)) * BITS).cast("int")).bitwiseAND(low)

    def value(x: Column, filled: Column) -> Column:
        """A bin's kept bits; an empty bin takes the filled bin that comes first in the bin's own order."""
        borrowed = F.array_min(F.transform(
            filled, lambda y: F.xxhash64(_bin(x), _bin(y)).bitwiseAND(F.lit(~((1 << BITS) - 1))).bitwiseOR(kept(y, _bin(x)))))
        return F.when(x.bitwiseAND(marker) != marker, kept(x, _bin(x))).otherwise(borrowed).bitwiseAND(low)

    def packed(values: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)), lambda k: F.aggregate(
            F.slice(values, k * _PER_LONG + 1, F.lit(_PER_LONG)), F.lit(0).cast("long"),
            lambda a, v: F.shiftleft(a, BITS).bitwiseOR(v)))

    filled = F.filter(d, lambda x: x.bitwiseAND(marker) != marker)
    return own.select(*columns, let(filled, lambda f: let(F.transform(d, lambda x: value(x, f)), packed)).alias(name))


def likeness(one: Column, two: Column) -> Column:
    """Estimated Jaccard similarity (0 to 1) of two packed fingerprints."""
    spread = F.lit(int("1" * _PER_LONG, 1 << BITS))

    def differing(a: Column, b: Column) -> Column:
        x = a.bitwiseXOR(b)
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(x.bitwiseAND(spread)).cast("long")

    apart = F.aggregate(F.zip_with(one, two, differing), F.lit(0).cast("long"), lambda a, n: a + n)
    chance = 1.0 / (1 << BITS)
    return F.greatest(F.lit(0.0), (1.0 - apart / F.lit(float(BINS)) - chance) / (1.0 - chance))


def as_text(fingerprint: Column) -> Column:
    """Hex digits, one for each bin."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def _cuts(docs: DataFrame, parts: int) -> list[int]:
    """At most ``parts`` ids, in order, that cut the documents into about equal ranges; the last is the largest id."""
    shares = [(i + 1) / parts for i in range(parts)]
    row = docs.agg(F.percentile_approx("doc_id", shares, 10 * parts).alias("cuts"), F.max("doc_id").alias("top")).first()
    return sorted({*(row["cuts"] or []), row["top"]} - {None})


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """Number of cuts below the id; cuts are searched in two levels."""
    width = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    tops = F.array(*[F.lit(g[-1]).cast("long") for g in groups[:-1]]) if len(groups) > 1 else F.array().cast("array<long>")
    table = F.array(*[F.array(*[F.lit(x).cast("long") for x in g]) for g in groups])
    group = F.size(F.filter(tops, lambda x: x < doc_id))
    return group * width + F.size(F.filter(F.get(table, group), lambda x: x < doc_id))


def with_next(docs: DataFrame, columns: list[str], parts: int | None = None) -> DataFrame:
    """``docs`` with next_<column>: the values of the next document by descending doc_id, after the last the first.

    Documents are dealt out by ranges of ids.  The first document of a range
    is also sent to the range above, where it follows the last, so every
    neighbour is found inside one range and the rows move once.  Rows with the
    same id are ordered by text; rows without an id come last.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _cuts(docs, parts)
    order = [F.col("at").desc_nulls_last(), F.col("text"), F.col("n_chars")]
    if not cuts:  # no ids at all: one order by text
        ranged = docs.withColumns({"range": F.lit(0), "copy": F.lit(False), "at": F.lit(None).cast("long")})
        top = None
    else:
        top = cuts[-1]
        own = F.coalesce(_range_of(F.col("doc_id"), cuts), F.lit(0))
        # (range, is a copy, key of the order): the row itself; above it, if it may be the first of its range
        itself = F.struct(own.alias("range"), F.lit(False).alias("copy"), F.col("doc_id").alias("at"))
        above = F.struct((own + 1).alias("range"), F.lit(True).alias("copy"), F.col("doc_id").alias("at"))
        edge = F.array_contains(F.array(*[F.lit(x).cast("long") for x in cuts[:-1]]) if len(cuts) > 1
                                else F.array().cast("array<long>"), F.col("doc_id"))
        around = F.struct(F.lit(0).alias("range"), F.lit(True).alias("copy"), F.lit(None).cast("long").alias("at"))
        sent = F.array_compact(F.array(itself, F.when(edge, above), F.when(F.col("doc_id") == top, around)))
        ranged = docs.withColumn("sent", F.explode(sent)).select(*docs.columns, "sent.range", "sent.copy", "sent.at")
    # copies come after every row of the range; the copy of the very first document after those without id
    window = Window.partitionBy("range").orderBy(F.col("copy"), *order)
    after = ranged.withColumns({f"next_{c}": F.lead(c).over(window) for c in columns})
    if top is None:
        first = Window.partitionBy("range")
        after = after.withColumns({f"next_{c}": F.coalesce(f"next_{c}", F.first(c).over(first.orderBy(*order))) for c in columns})
    return after.where(~F.col("copy")).drop("range", "copy", "at")


def fingerprint_edits(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of every whole text, of its edited text, and their likeness.

    The edited text has the last floor(n_chars / 2) characters replaced by the
    first as many of the next document (descending doc_id).  Returns doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.
    """
    own = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    own = own.withColumn("n_chars", F.length("text").cast("long"))
    own = with_next(with_fingerprint(own, "text", "fp", shingle), ["text", "fp"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    own = own.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half)))
    own = with_fingerprint(own.drop("text", "next_text"), "edited", "edited_fp", shingle)
    return own.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
