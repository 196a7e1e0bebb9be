"""Vector operators and the manifest against plain versions."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest

from brooklet.llm import embedding_dedup
from brooklet.llm.embedding_dedup import similar_vectors
from brooklet.llm.merkle import merkle_manifest, op12_merkle_manifest
from brooklet.llm.vector_codes import Books, assigned, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int, cls long, cell string, bucket long, code string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 7, "x", 9, "y", 1) for i, v, label in rows], VECTORS)


def sound(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def linked(rows):
    """(key, links, component) of each row, by all pairs."""
    units = []
    for _, v, _ in rows:
        x = np.asarray(v, np.float32).astype(np.float64) if sound(v) and any(v) else None
        units.append(None if x is None else x / np.linalg.norm(x))
    n = len(rows)
    near = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.9] for i in range(n)]
    group = list(range(n))
    for i in range(n):
        todo, seen = [i], {i}
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        group[i] = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
    return sorted(((rows[i][0], len(near[i]), group[i], rows[i][0] == group[i]) for i in range(n)), key=repr)


def found(spark, rows):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in similar_vectors(frame(spark, rows)).collect()), key=repr)


def near(rng, centre, noise, n):
    out = centre + rng.normal(size=(n, len(centre))) * noise / math.sqrt(len(centre))
    return [list(map(float, v)) for v in out]


def test_links_equal_those_of_all_pairs_in_crowds_of_every_width(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 24))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    vectors = near(rng, centres[0], 0.05, 120) + near(rng, centres[1], 0.25, 90) + near(rng, centres[2], 0.34, 90)
    # A chain from one crowd to the next, copies, and vectors of their own.
    vectors += [list(map(float, centres[0] * (1 - t) + centres[3] * t)) for t in np.linspace(0, 1, 40)]
    vectors += [vectors[0]] * 25 + near(rng, np.zeros(24), 1, 60)
    rows = [(i, v, i % 3) for i, v in enumerate(vectors)]
    assert found(spark, rows) == linked(rows)


def test_blocks_and_shares_count_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "PROBED", 24)
    rng = np.random.default_rng(6)
    centre = rng.normal(size=16)
    rows = [(i, v, 0) for i, v in enumerate(near(rng, centre / np.linalg.norm(centre), 0.36, 150))]
    assert found(spark, rows) == linked(rows)


def test_unsound_vectors_repeated_keys_and_other_lengths(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, v, 0), (1, v, 0), (None, v, 0), (4, None, 0), (5, [], 0), (6, [0.0] * 4, 0), (7, [1.0, None, 3.0, 4.0], 0), (8, [1.0, float("nan"), 3.0, 4.0], 0)]
    rows += [(9, [float("inf")] * 4, 0), (0, v + [0.0], 0), (10, [-x for x in v], 0), (11, [x * 3e37 for x in v], 0), (12, [1e-30] * 4, 0), (None, None, 0), (3, [1.0], 0), (2, [5.0], 0)]
    assert found(spark, rows) == linked(rows)
    assert found(spark, []) == []
    assert similar_vectors(frame(spark, [])).columns == ["vec_id", "n_links", "component_id", "kept"]


def test_pairs_at_the_threshold_are_found_in_a_large_table(spark):
    rng = np.random.default_rng(7)
    one = rng.normal(size=(1500, 64))
    one /= np.linalg.norm(one, axis=1)[:, None]
    other = rng.normal(size=one.shape)
    other -= np.einsum("ij,ij->i", one, other)[:, None] * one
    other /= np.linalg.norm(other, axis=1)[:, None]
    other = 0.9001 * one + math.sqrt(1 - 0.9001**2) * other
    rows = [(i, list(map(float, v)), 0) for i, v in enumerate(np.concatenate([one, other]))]
    got = found(spark, rows)
    assert sum(n for _, n, _, _ in got) >= 0.98 * 3000


def coded(rows, parts=16, entries=64):
    """Plain integer Lloyd rounds in Python."""
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows if sound(v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(rows[0][1]) // parts if rows else 0
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(2):
        at = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, a in zip(cut, at, strict=True) if a[p][1] == k]
                if mine:
                    books[p][k] = tuple(sum(x) // len(mine) for x in zip(*mine, strict=True))
    at = assign()
    errors = [sum(d for d, _ in a) for a in at]
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{k:02x}" for _, k in a), e, sum(f for f, r in zip(errors, rows, strict=True) if r[2] == label), digest) for (i, _, label), a, e in zip(rows, at, errors, strict=True)),
        key=repr,
    )


def codes(spark, rows):
    return sorted((tuple(r) for r in vector_codes(frame(spark, rows)).collect()), key=repr)


def test_codes_equal_plain_rounds(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), list(map(float, v)), [None, 0, 1][i % 3]) for i, v in enumerate(rng.normal(size=(400, 32)))]
    assert codes(spark, rows) == coded(rows)
    # Many ties: few different values, repeated rows and keys.
    coarse = [(i % 150, list(map(float, v)), 1) for i, v in enumerate(rng.integers(-1, 2, size=(300, 16)) / 128)]
    assert codes(spark, coarse) == coded(coarse)


def test_codes_of_few_vectors_unsound_ones_and_none(spark):
    rows = [(3, [0.5] * 16, None), (None, [0.25] * 16, 1), (3, [0.5] * 16, None), (1, None, 1), (2, [float("nan")] * 16, 1), (0, [1.0] * 15 + [None], 0), (4, [], 0)]
    assert codes(spark, rows) == coded([r for r in rows if sound(r[1])])
    assert codes(spark, []) == []
    assert codes(spark, [(1, [0.5] * 16, 0), (2, [0.5] * 32, 0), (3, [0.5] * 15, 0)]) == coded([(1, [0.5] * 16, 0)])
    with pytest.raises(Exception, match="not supported"):
        codes(spark, [(1, [1e30] * 16, 0)])


def test_parts_of_entries_that_stayed_are_compared_with_moved_ones_only():
    rng = np.random.default_rng(9)
    ints = rng.integers(-3, 4, size=(500, 2, 2))
    before = Books(rng.integers(-3, 4, size=(2, 8, 2)), np.ones((2, 8), bool))
    at, far = assigned(ints, before)
    after = Books(before.entries.copy(), np.zeros((2, 8), bool))
    after.entries[:, 2:4] += 1
    after.moved[:, 2:4] = True
    want = assigned(ints, Books(after.entries, np.ones((2, 8), bool)))
    got = assigned(ints, after, at, far)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def h(*values):
    return hashlib.sha256("".join(values).encode()).hexdigest()


def leaf(row):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def tree(nodes):
    """Root of a list of digests, and for each the siblings, level by level, as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for k in range(len(paths)):
            run, slot = runs[at[k] // 16], at[k] % 16
            paths[k].append((run[:slot], run[slot + 1 :]))
            at[k] //= 16
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        ordered = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = (ordered, *tree([leaf(r) for r in ordered]))
    root, tops = tree([trees[g][1] for g in names])
    out = []
    for g, top in zip(names, tops, strict=True):
        ordered, subroot, paths = trees[g]
        for row, path in zip(ordered, paths, strict=True):
            path = path + top
            text = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            digest = leaf((*row[:4], text))
            for left, right in path:
                digest = h(*left, digest, *right)
            out.append((row[0], leaf(row), subroot, root, h(*(x for p in path for side in p for x in side)), digest, digest == root))
    return sorted(out, key=repr)


DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, pos long, gid long, digest string, `left` string"


def documents(spark, path, rows):
    spark.createDataFrame([(*r, "x", 1, 2, "y", "z") for r in rows], DOCS).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 2, 300], [5] * 19, [257, 1, 16, 33]])
def test_manifest_equals_plain_trees(spark, tmp_path, sizes):
    rows = [(1000 * g + i, None if g == 1 else f"s{g}é", "en", i, f"Text {i} of G{g}") for g, n in enumerate(sizes) for i in range(n)]
    got = sorted((tuple(r) for r in op12_merkle_manifest(spark, documents(spark, str(tmp_path), rows)).collect()), key=repr)
    assert got == manifest(rows)


def test_manifest_of_nulls_repeated_rows_and_no_rows(spark, tmp_path):
    rows = [(1, "a", None, None, None), (1, "a", None, None, None), (1, "a", None, None, ""), (None, None, None, None, "ÄA"), (None, None, "x", 3, "B"), (20, "", "", 0, "Q" * 50_000)]
    rows += [(7, "a", "en", 1, "same")] * 40
    got = sorted((tuple(r) for r in op12_merkle_manifest(spark, documents(spark, f"{tmp_path}/some", rows)).collect()), key=repr)
    assert got == manifest(rows)
    empty = op12_merkle_manifest(spark, documents(spark, f"{tmp_path}/none", []))
    assert empty.collect() == []
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_proof_holds_the_siblings_themselves(spark):
    docs = spark.createDataFrame([(i, "a", "en", 1, str(i)) for i in range(20)], "doc_id long, source string, lang string, n_chars long, text string")
    rows = {r.doc_id: r for r in merkle_manifest(docs).collect()}
    assert all(r.verified and r.folded_root == r.root == r.subroot for r in rows.values())
    siblings = bytes(rows[17].proof).hex()
    assert siblings == "".join(rows[i].leaf for i in (16, 18, 19)) + h(*(rows[i].leaf for i in range(16)))
