"""The similarity join where very many documents share their passages, and the pipeline on documents with any column names."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brooklet.llm import jaccard_join
from brooklet.llm.jaccard_join import one_of_each, similar_components
from tests.llm import brute


def joined(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.doc_id, r.n_shingles, r.component_id) for r in similar_components(docs).orderBy("doc_id").collect()]


def crowd(n, common=30, own=4):
    """Texts that share a passage and differ in so many words that none links with another."""
    passage = " ".join(f"w{i}" for i in range(common))
    return [f"{passage} {' '.join(f'x{k}y{j}' for j in range(own))}" for k in range(n)]


def test_a_crowd_of_unlinked_classes_makes_no_row_for_each_pair(spark):
    texts = crowd(5000)
    texts += texts[:3] + [texts[7] + " z"]
    got = joined(spark, texts)
    assert [c for _, _, c in got] == [*range(5000), 0, 1, 2, 7]
    assert {n for _, n, _ in got[:5000]} == {30}


def test_crowds_of_several_sizes_and_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 600)
    texts = crowd(60) + [t + f" e{k} f{k}" for k, t in enumerate(crowd(40, own=5))] + crowd(50, common=38, own=3)
    # Near copies at all distances, so that groups join in blocks only.
    base = [f"b{i}" for i in range(60)]
    texts += [" ".join(base[: 30 + k % 31] + [f"c{k % 5}"] * (k % 3)) for k in range(90)]
    want = brute.near_components(list(enumerate(texts)))
    assert joined(spark, texts) == [(k, n, c) for k, n, c in want]


@pytest.fixture
def tables(monkeypatch):
    """Names and rows of the tables that the join writes."""
    seen, real = [], jaccard_join.written

    def noted(df, name):
        out = real(df, name)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(jaccard_join, "written", noted)
    return seen


def test_rows_without_a_partner_are_not_kept(spark, tables):
    """Of two texts one begins the other, and is too short to link with it."""
    base = [f"w{i}" for i in range(64)]
    assert joined(spark, [" ".join(base[:44]), " ".join(base)]) == [(0, 40, 0), (1, 60, 1)]
    assert dict(tables)["op2-buckets"] == 0


@pytest.mark.parametrize("seed", range(3))
def test_rows_kept_have_all_partners(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(60), c, n := rng.randrange(1, 60), rng.randrange(n - -(-80 * n // 100) + 1)) for c in range(300)]
    kept = {(r.shingle, r["class"]): r.c for r in jaccard_join._with_partners(spark.createDataFrame(rows, "shingle long, class long, n int, place int"), 80).collect()}

    def near(x, y):
        least = -(-80 * (x[2] + y[2]) // 180)
        return x[0] == y[0] and x[1] != y[1] and 100 * min(x[2], y[2]) >= 80 * max(x[2], y[2]) and min(x[2] - x[3], y[2] - y[3]) >= least

    assert {x[:2] for x in rows if any(near(x, y) for y in rows)} <= set(kept)
    assert len(kept) < len(rows)
    assert all(c == sum(s == t for t, _ in kept) > 1 for (s, _), c in kept.items())


def test_few_pairs_left_are_compared_at_once(spark, tables):
    rng = random.Random(5)
    blocks = [" ".join(f"b{i}w{j}" for j in range(50)) for i in range(20)]
    texts = [" ".join(b for i, b in enumerate(blocks) if i not in left_out) for left_out in (set(rng.sample(range(20), 4)) for _ in range(16))]
    want = brute.near_components(list(enumerate(texts)))
    assert joined(spark, texts) == [(k, n, c) for k, n, c in want]
    assert [name for name, _ in tables].count("op2-open") == 1


def test_sets_that_differ_by_little_more_than_a_link_allows_need_no_texts(spark, tables):
    base = [f"w{i}" for i in range(1200)]
    other = base[:900] + [f"x{i}" for i in range(300)]
    got = joined(spark, [" ".join(base), " ".join(other)])
    assert got == [(0, 1196, 0), (1, 1196, 1)]
    rows = dict(tables)
    assert rows["op2-pairs"] == 1 and rows["op2-candidates"] == 0


NAMES = "doc_id long, text string, lang string, source string, n_chars long, score string, ids string, rid string, _rid string, kept string, n_words string, spans string, candidates string, rest string, document string, row string, bare string"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *["own"] * 12) for i, t in rows], NAMES)


def test_one_of_each_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (3, None), (4, ""), (5, "other words")]
    got = one_of_each(clashing(spark, rows))
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 3, 4, 5]
    assert all(tuple(r)[5:] == ("own",) * 12 for r in got.collect())


@pytest.mark.parametrize("rows", [[], [(1, None), (1, None), (None, ""), (2, "one two three " * 30), (2, "one two three " * 30), (3, "password = hunter2hunter2 " + "w " * 5000)]])
def test_stages_take_nulls_repeated_rows_any_names_and_empty_tables(spark, tmp_path, rows):
    spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "no such passage")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = clashing(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, spark.createDataFrame(stage(spark, docs, str(tmp_path)).toArrow(), stage(spark, docs, str(tmp_path)).schema)
        if name != "sentencepiece":
            assert docs.columns == before.columns
    assert docs.columns[-2:] == ["ids", "n_ids"] and "ids_" in docs.columns
    assert docs.where("rid <> 'own' OR rest <> 'own' OR ids_ <> 'own'").isEmpty()
    ids = sorted((r.doc_id for r in docs.collect()), key=repr)
    assert ids == ([] if not rows else [1, 1, 2, 3, None])
    assert docs.where(F.col("n_ids") == 0).count() == (3 if rows else 0)
