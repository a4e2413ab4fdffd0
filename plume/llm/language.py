"""Language identification by prediction by partial matching.

For every language a tree of byte contexts up to ``order`` bytes holds how
often each byte followed.  The code length of a text is the sum over its bytes
of -log2 p(byte | context): the longest known context gives the byte's share,
or an escape (method C: distinct followers / (followers + distinct)) to the
next shorter one, down to 8 bits a byte.  The statistics are frozen: scoring
never changes them.  The language with the shortest code wins.

The score is that language's share of the likelihood, times the part of its own
gain that the text reaches: 8 bits a byte less the text's code length, over the
same of the language's own texts (each gram there coded as if its one
occurrence, where it has only one, had not been seen).  Texts in languages that
were not learnt, random letters and encoded data have codes of near 8 bits a
byte or more, and so scores near 0.

The trees are learnt from a bounded sample: of each language the
``rows_per_language`` rows of smallest hash (repeated rows once) among the rows
that may be learnt from and whose text has at most ``longest_learnt`` bytes (longer ones are
scored like any other).  So the model's size has a bound that does not depend
on the corpus, and it is broadcast.

Cases: a null text, or one without a letter, is ``und`` with score 0; so is
every text when there is nothing to learn from.  Rows without lang, and rows
without doc_id, are predicted but never learnt from.  Of equally short codes
the first language by name wins.  Very long texts are scored whole.  Repeated
rows give repeated results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import pick, text_groups

ORDER = 4
ROWS_PER_LANGUAGE = 500
LONGEST_LEARNT = 40_000
MAX_LANGUAGES = 500
_START = b"\n"  # a text's first bytes have these as context


def id_part(column: str = "doc_id", parts: int = 3) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def _joined(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with a start mark before each text, places of the texts' bytes, text of each place)."""
    data = np.frombuffer(b"".join(_START * order + t for t in texts), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    return data, np.arange(len(owner)) + (owner + 1) * order, owner


def _grams(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` bytes that end at each place, packed into a number."""
    out = np.zeros(len(places), np.uint64)
    for k in range(length):
        out |= data[places - k] << np.uint64(8 * k)
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each wanted key, whether it is there)."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class ContextTrees:
    """Code lengths of every known gram, and escape lengths of every known context, a column for each language."""

    languages: list[str]
    order: int
    grams: list[np.ndarray]     # by order: context and byte
    lengths: list[np.ndarray]
    contexts: list[np.ndarray]  # by order: context alone
    escapes: list[np.ndarray]
    typical: np.ndarray         # bits a byte of the language's own texts

    @classmethod
    def fit(cls, languages: list[str], order: int, rows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> ContextTrees:
        """``rows``: by order, (packed gram, language number, count)."""
        out = cls(languages, order, [], [], [], [], np.zeros(len(languages)))
        unseen = np.full((1, len(languages)), 8.0)  # of the next shorter gram, as if not seen here
        for k in range(order + 1):
            gram, lang, n = rows[k]
            keys, at = np.unique(gram, return_inverse=True)
            count = np.zeros((len(keys), len(languages)))
            np.add.at(count, (at, lang), n)
            ctx, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total = np.zeros((len(ctx), len(languages)))
            np.add.at(total, of, count)
            kinds = np.zeros_like(total)
            np.add.at(kinds, of, count > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                own = -np.log2(count / (total + kinds)[of])
            suffix = keys & np.uint64((1 << (8 * k)) - 1)
            shorter = out.code_lengths(suffix, k - 1)
            before = unseen[_find(out.grams[k - 1], suffix)[0]] if k else unseen
            unseen = np.where(count > 1, own, escape[of] + before)
            out.typical = (np.where(count > 0, unseen, 0) * count).sum(axis=0) / np.maximum(count.sum(axis=0), 1)
            out.lengths.append(np.where(count > 0, own, escape[of] + shorter).astype(np.float32))
            out.grams.append(keys)
            out.contexts.append(ctx)
            out.escapes.append(escape.astype(np.float32))
        return out

    def code_lengths(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Bits of the last byte of each gram (``order`` bytes of context), by language."""
        out = np.zeros((len(grams), len(self.languages)))
        left, grams = np.arange(len(grams)), grams.copy()
        for k in range(order, -1, -1):
            at, there = _find(self.grams[k], grams)
            out[left[there]] += self.lengths[k][at[there]]
            left, grams = left[~there], grams[~there]
            if not len(left):
                return out
            at, there = _find(self.contexts[k], grams >> np.uint64(8))
            out[left[there]] += self.escapes[k][at[there]]
            grams &= np.uint64((1 << (8 * k)) - 1)
        out[left] += 8.0
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text under each language."""
        out = np.zeros((len(texts), len(self.languages)))
        data, places, owner = _joined(texts, self.order)
        grams = _grams(data, places, self.order + 1)
        for k in range(self.order, -1, -1):
            at, there = _find(self.grams[k], grams)
            self._add(out, owner[there], self.lengths[k][at[there]])
            owner, grams = owner[~there], grams[~there]
            at, there = _find(self.contexts[k], grams >> np.uint64(8))
            self._add(out, owner[there], self.escapes[k][at[there]])
            grams &= np.uint64((1 << (8 * k)) - 1)
        out += 8.0 * np.bincount(owner, minlength=len(texts))[:, None]
        return out

    @staticmethod
    def _add(out: np.ndarray, owner: np.ndarray, bits: np.ndarray) -> None:
        for j in range(out.shape[1]):
            out[:, j] += np.bincount(owner, bits[:, j], minlength=len(out))

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        if not self.languages:
            return [("und", 0.0)] * len(texts)
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        bits = self.score(raw)
        best, least = bits.argmin(axis=1), bits.min(axis=1)
        share = 1.0 / np.exp2(-np.minimum(bits - least[:, None], 1000)).sum(axis=1)
        gain = 8.0 - least / np.maximum([len(r) for r in raw], 1)
        share *= np.clip(gain / np.maximum(8.0 - self.typical[best], 1e-9), 0.0, 1.0)
        return [(self.languages[b], float(s)) if t and any(map(str.isalpha, t)) else ("und", 0.0)
                for t, b, s in zip(texts, best.tolist(), share.tolist(), strict=True)]


def _up_to(bounds: list[Row], value: Column) -> Column:
    """Rows whose ``value`` is at most their language's ``h``; at most ``MAX_LANGUAGES`` bounds."""
    taken = F.lit(False)
    for b in bounds:
        taken = taken | ((F.col("lang") == b["lang"]) & (value <= b["h"]))
    return taken


def learn(docs: DataFrame, learnable: Column, order: int = ORDER, rows_per_language: int = ROWS_PER_LANGUAGE,
          longest_learnt: int = LONGEST_LEARNT) -> ContextTrees:
    """Context trees of the languages in ``lang``, from a bounded sample of the ``learnable`` rows."""
    if not 0 <= order <= 7:
        raise ValueError("order: 0 to 7 bytes of context")
    own = pick(docs, "doc_id", "text", "lang").where(learnable & F.col("lang").isNotNull() & (F.octet_length("text") <= longest_learnt))
    own = own.withColumn("h", F.xxhash64("doc_id", F.octet_length("text")))
    # the hash of each language's last row: found among the rows up to the 1/65,536 of all hashes that it lies in
    hashes = own.select("lang", "h").distinct()
    cells = hashes.groupBy("lang", F.shiftright("h", 48).alias("cell")).agg(F.count("*").alias("n"))
    upto = cells.withColumn("upto", F.sum("n").over(Window.partitionBy("lang").orderBy("cell")))  # 65,536 cells at most
    last = upto.groupBy("lang").agg(F.coalesce(F.min(F.when(F.col("upto") >= rows_per_language, F.col("cell"))), F.max("cell")).alias("h")) \
        .orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(last) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the model would have no bound")
    ranked = hashes.where(_up_to(last, F.shiftright("h", 48))) \
        .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    bounds = ranked.where(F.col("r") <= rows_per_language).groupBy("lang").agg(F.max("h").alias("h")).orderBy("lang").collect()
    languages = [b["lang"] for b in bounds]
    if not languages:
        return ContextTrees([], order, [], [], [], [], np.zeros(0))
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {x: i for i, x in enumerate(languages)}
        for part, texts in text_groups(batches):
            langs = np.array([number[x] for x in part.column("lang").to_pylist()])
            for lang in np.unique(langs):
                data, places, _ = _joined([t.encode() for t, x in zip(texts, langs, strict=True) if x == lang], order)
                for k in range(order + 1):
                    gram, n = np.unique(_grams(data, places, k + 1), return_counts=True)
                    size = len(gram)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(size, k, np.int32)), pa.array(np.full(size, lang, np.int32)),
                         pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))], ["k", "lang", "gram", "n"])

    sample = own.where(_up_to(bounds, F.col("h"))).groupBy("lang", "h").agg(F.min("text").alias("text"))  # a repeated row counts once
    counted = sample.select("lang", "text").mapInArrow(run, "k int, lang int, gram long, n long") \
        .groupBy("k", "lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    k = counted.column("k").to_numpy()
    columns = [counted.column("gram").to_numpy().view(np.uint64), counted.column("lang").to_numpy(), counted.column("n").to_numpy()]
    return ContextTrees.fit(languages, order, {i: tuple(c[k == i] for c in columns) for i in range(order + 1)})


def identify(docs: DataFrame, model: ContextTrees, extra: tuple[str, ...] = (), pred: str = "lang_pred",
             score: str = "score") -> DataFrame:
    """doc_id, the ``extra`` input columns, lang_pred and score of every whole text (under the names given)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample, see ``learn``
    kept = list(dict.fromkeys(("doc_id", *extra)))
    own = docs.select(*dict.fromkeys((*kept, "text")))
    schema = StructType([*own.select(*kept).schema.fields, StructField(pred, StringType()), StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_groups(batches):
            langs, scores = zip(*shared.value.predict_all(texts), strict=True)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [*kept, pred, score])

    return own.mapInArrow(run, schema)


def predict_held_out(docs: DataFrame, parts: int = 3, held: int = 1, **bounds) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learnt from the rows whose id part is not ``held``, predicted for all."""
    own = pick(docs, "doc_id", "text", "lang")
    model = learn(own, id_part(parts=parts) != held, **bounds)
    return identify(own, model).select(
        "doc_id", F.coalesce(id_part(parts=parts) == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
