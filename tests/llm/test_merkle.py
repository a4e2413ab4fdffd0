"""Merkle manifest against a plain tree built in one list."""

import hashlib
import zlib
from collections import Counter

import pytest

from llm_rows import base_rows, make, mixed, no_docs  # noqa: F401  fixtures

from plume.llm import merkle, queries


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_of(nodes):
    """Levels of runs of three up to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][k:k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def path_of(levels, k):
    """(left, right siblings) per level of node k."""
    out = []
    for nodes in levels[:-1]:
        run = k - k % 3
        out.append((nodes[run:k], nodes[k + 1:run + 3]))
        k //= 3
    return out


def expected(rows):
    """rows: (doc_id, text, lang, source)."""
    by_source = {}
    for i, text, lang, source in rows:
        n = None if text is None else len(text)
        leaf = leaf_of(i, source, lang, n, text)
        cut = i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and text is not None
        by_source.setdefault(source, []).append((i, leaf, leaf_of(i, source, lang, n, text.replace("\n", "")) if cut else leaf))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = tree_of([r[1] for r in by_source[s]])
    top = tree_of([trees[s][-1][0] for s in names])
    out = []
    for n, s in enumerate(names):
        for k, (i, leaf, edited) in enumerate(by_source[s]):
            path = path_of(trees[s], k) + path_of(top, n)
            folded = edited
            for left, right in path:
                folded = sha(*left, folded, *right)
            out.append((i, leaf, trees[s][-1][0], top[-1][0], sha(*[x for a, b in path for x in a + b]), folded, folded == top[-1][0]))
    return Counter(out)


@pytest.mark.parametrize("block_levels", [1, 2, 7])
def test_manifest(spark, mixed, block_levels):
    rows, docs = mixed
    rows = rows + [(700_000 + k, f"line\n{k}", "en", f"only{k}") for k in range(7)]
    got = merkle.manifest(merkle.document_leaves(make(spark, rows)), block_levels=block_levels).collect()
    want = expected(rows)
    assert Counter(tuple(r) for r in got) == want
    assert {r.verified for r in got} == {True, False}


def test_small_trees(spark, no_docs):
    assert merkle.manifest(merkle.document_leaves(no_docs)).count() == 0
    for rows in ([(1, "one", "en", "a")], [(1, "one", "en", None), (2, "a\nb", None, None)],
                 [(k, "x", "en", "s") for k in range(10)] + [(3, "y", "en", "t")]):
        got = merkle.manifest(merkle.document_leaves(make(spark, rows)), block_levels=1).collect()
        assert Counter(tuple(r) for r in got) == expected(rows)


def test_fields_do_not_run_together(spark):
    rows = [(1, "b", "a", "s"), (1, "", "ab", "s"), (1, None, "-", "s"), (1, "-", None, "s")]
    leaves = [r.leaf for r in merkle.document_leaves(make(spark, rows)).collect()]
    assert len(set(leaves)) == 4


def test_states_resume():
    leaves = [sha(str(k)) for k in range(100)]
    block = merkle.Block(leaves)
    assert block.root == tree_of(leaves)[-1][0]
    for k in (0, 1, 50, 98, 99):
        changed = leaves[:k] + [sha("new")] + leaves[k + 1:]
        assert block.fold(k, sha("new")) == tree_of(changed)[-1][0]
        assert block.fold(k, leaves[k]) == block.root


def test_whole_table(spark, base_rows):
    from llm_rows import SF
    got = queries.op13_merkle_manifest(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    want = {r.doc_id: leaf_of(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs}
    assert {r.doc_id: r.leaf for r in got} == want
    assert Counter(tuple(r) for r in got) == expected(base_rows)
