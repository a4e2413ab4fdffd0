"""BPE encoding with a segment tree over adjacent pair ranks, and decoding.

Distinct words of a batch are encoded together (``bpe.MergeTable.encode_many``);
a word's ids and token strings are kept in a bounded cache of the worker.

Cases: a null or empty text has no ids and decodes to the empty text; special
strings of the vocabulary become their ids; repeated rows give repeated
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import fold, merge_table
from .common import pick, text_groups
from .words import WordCache, segments

_CACHES: dict[str, WordCache] = {}


def _cache(path: str) -> WordCache:
    """Words to (number of ids, their decimal text, their tokens' text)."""
    if path not in _CACHES:
        table = merge_table(path)

        def encode(words: list[str]) -> list[tuple[int, str, str]]:
            found = [ids.tolist() for ids in table.encode_many([w.encode() for w in words])]
            return [(len(ids), " ".join(map(str, ids)), " ".join(table.names[i] for i in ids)) for ids in found]

        _CACHES[path] = WordCache(encode)
    return _CACHES[path]


def encode_texts(texts: list[str | None], path: str) -> list[tuple[int, str, str]]:
    """(number of ids, ids as decimal text, decoded text) of each text."""
    table = merge_table(path)
    plan, parts = [], []
    for t in texts:
        row = []
        for k, s in enumerate(segments(t or "", table.special_split)):
            if k % 2:
                row.append((1, str(table.special[s]), s))
            elif s:
                row.append(len(parts))
                parts.append(fold(s))
        plan.append(row)
    if parts:
        values, which, bounds = _cache(path).lookup(parts, joins_space=False)
        sizes, ids, names = zip(*values, strict=True) if values else ((), (), ())
        running = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64)[which])]) if values else np.zeros(1, np.int64)
    out = []
    for row in plan:
        n, id_text, name_text = 0, [], []
        for x in row:
            if isinstance(x, tuple):
                n += x[0]
                id_text.append(x[1])
                name_text.append(x[2])
            else:
                a, b = bounds[x], bounds[x + 1]
                own = which[a:b].tolist()
                n += int(running[b] - running[a])
                id_text += [ids[i] for i in own]
                name_text += [names[i] for i in own]
        out.append((n, " ".join(id_text), " ".join(name_text)))
    return out


def encode_ids(texts: list[str | None], path: str) -> list[list[int]]:
    """The ids themselves."""
    return [[int(i) for i in ids.split()] for _, ids, _ in encode_texts(texts, path)]


def decode_ids(ids: list[int], path: str) -> str:
    """The token strings joined by a space, as a vocabulary without a decoder has it; unknown ids are left out."""
    names = merge_table(path).names
    return " ".join(names[i] for i in ids if i in names)


def codec(docs: DataFrame, vocabulary: str, texts_too: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text; ``texts_too`` adds ids and decoded."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if texts_too else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for part, texts in text_groups(batches):
            found = encode_texts(texts, vocabulary)
            columns = [part.column("doc_id"), pa.array([x[0] for x in found], pa.int64()),
                       pa.array([digest(x[1]) for x in found], pa.string()),
                       pa.array([digest(x[2]) for x in found], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if texts_too:
                columns += [pa.array([[int(i) for i in x[1].split()] for x in found], pa.list_(pa.int32())),
                            pa.array([x[2] for x in found], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return pick(docs, "doc_id", "text").mapInArrow(run, schema)
