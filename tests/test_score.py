import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from papertriage.config import FIXTURE_CONFIG, TriageConfig
from papertriage.operators import blocks as BL
from papertriage.operators import score as SC


def related(sims, mean_t, k, min_top, ind_t):
    """Independent statement of the two rules for NaN-free inputs."""
    if sum(sims) / len(sims) > mean_t:
        return True, "mean"
    best = sorted(sims, reverse=True)[:k]
    if len([x for x in best if x >= ind_t]) >= min_top:
        return True, "top_k"
    return False, None


def _refs(mat, titles=None):
    mat = np.asarray(mat, dtype=np.float64)
    ids = np.arange(len(mat), dtype=np.int64)
    norms = np.maximum(np.linalg.norm(mat, axis=1), 1e-12)
    return SC.ReferenceSet(ids, titles or [f"r{i}" for i in ids], mat / norms[:, None])


def _papers(spark, vecs):
    return spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None) for i, v in enumerate(vecs)],
                                 "paper_id bigint, embedding array<double>")


def _score(spark, vecs, refs, cfg, plan):
    out = SC.score_papers(_papers(spark, vecs), refs, cfg, plan=plan).orderBy("paper_id").collect()
    return [(r["is_related"], r["reason"], r["n_top_above"], r["mean_similarity"]) for r in out]


E = np.eye(4)


@pytest.mark.parametrize("plan", ["arrow", "sql"])
def test_rules_match_python_restatement(spark, plan):
    rng = np.random.default_rng(7)
    refs_m = rng.normal(size=(6, 4))
    vecs = rng.normal(size=(40, 4))
    cfg = TriageConfig(similarity_threshold=0.1, top_k=3, min_top_papers=2, individual_sim_threshold=0.4)
    refs = _refs(refs_m)
    got = _score(spark, vecs, refs, cfg, plan)
    for v, (rel, reason, _, mean) in zip(vecs, got):
        sims = (v / np.linalg.norm(v)) @ refs.matrix.T
        exp_rel, exp_reason = related(list(sims), 0.1, 3, 2, 0.4)
        assert rel == exp_rel and reason == exp_reason
        assert math.isclose(mean, sims.mean(), abs_tol=1e-12)


@pytest.mark.parametrize("plan", ["arrow", "sql"])
def test_threshold_edges(spark, plan):
    # references e0, e1; a paper equal to e0 has sims (1, 0): mean exactly 0.5
    refs = _refs(E[:2])
    cfg_mean = TriageConfig(similarity_threshold=0.5, top_k=3, min_top_papers=3, individual_sim_threshold=0.9)
    assert _score(spark, [E[0]], refs, cfg_mean, plan)[0][:2] == (False, None)  # mean rule is strict
    cfg_ind = TriageConfig(similarity_threshold=0.9, top_k=2, min_top_papers=1, individual_sim_threshold=1.0)
    assert _score(spark, [E[0]], refs, cfg_ind, plan)[0][:3] == (True, "top_k", 1)  # individual rule is >=


@pytest.mark.parametrize("plan", ["arrow", "sql"])
def test_fewer_references_than_k(spark, plan):
    refs = _refs(E[:2])
    cfg = TriageConfig(similarity_threshold=0.9, top_k=5, min_top_papers=2, individual_sim_threshold=0.5)
    v = E[0] + E[1]
    assert _score(spark, [v], refs, cfg, plan)[0][:3] == (True, "top_k", 2)


@pytest.mark.parametrize("plan", ["arrow", "sql"])
def test_nan_never_passes(spark, plan):
    refs = _refs(E[:3])
    cfg = TriageConfig(similarity_threshold=-1.0, top_k=3, min_top_papers=1, individual_sim_threshold=-1.0)
    got = _score(spark, [[float("nan"), 0, 0, 0]], refs, cfg, plan)[0]
    assert got[0] is False and got[2] == 0
    # null embedding -> no score, not related
    got = _score(spark, [None], refs, cfg, plan)[0]
    assert got[0] is False and got[3] is None


def test_strict_float32(spark):
    # sim = 0.9 exactly representable? float32(0.9) >= 0.9 is True in numpy>=2 style
    refs = _refs([[1.0, 0.0]])
    v = [0.9, math.sqrt(1 - 0.81)]
    loose = TriageConfig(similarity_threshold=2.0, top_k=1, min_top_papers=1, individual_sim_threshold=0.9)
    strict = loose.with_(strict_float32=True)
    s32 = np.float32(np.float64(v[0]))
    assert bool(s32 >= np.float32(0.9))
    assert _score(spark, [v], refs, strict, "arrow")[0][0] is True
    assert _score(spark, [v], refs, strict, "sql")[0][0] is True


def test_top_k_must_be_positive():
    with pytest.raises(ValueError):
        TriageConfig(top_k=0)


@pytest.mark.parametrize("block_rows,cell_rows", [(4, 8), (1000, 1000)])
@pytest.mark.parametrize("strict", [False, True])
def test_blocks_equal_single(spark, block_rows, cell_rows, strict):
    rng = np.random.default_rng(3)
    refs_m = np.concatenate([rng.normal(size=(30, 8)), np.zeros((1, 8))])
    vecs = list(rng.normal(size=(60, 8))) + [None, [float("nan")] * 8, [0.0] * 8]
    cfg = TriageConfig(similarity_threshold=0.05, top_k=3, min_top_papers=2, individual_sim_threshold=0.3, strict_float32=strict)
    single = _score(spark, vecs, _refs(refs_m), cfg, "arrow")
    # reference ids repeat and are null; every paper id stands twice
    refs_df = spark.createDataFrame([(None if i % 5 == 0 else i // 2, [float(x) for x in r]) for i, r in enumerate(refs_m)],
                                    "ref_id bigint, embedding array<double>").repartition(3)
    twice = _papers(spark, vecs).withColumn("n", F.lit(1)).union(_papers(spark, vecs).withColumn("n", F.lit(2))).repartition(5)
    size = 8 * 8
    out = BL.score_blocks(twice, refs_df, cfg, block_bytes=block_rows * size, cell_bytes=cell_rows * size)
    assert out.columns == ["paper_id", "embedding", "n", "mean_similarity", "n_top_above", "top_sims", "is_related", "reason"]
    got = [(r["is_related"], r["reason"], r["n_top_above"], r["mean_similarity"]) for r in out.orderBy("paper_id", "n").collect()]
    assert len(got) == 2 * len(single)
    for a, x, y in zip(single, got[::2], got[1::2]):
        for b in (x, y):
            assert a[:3] == b[:3]
            assert a[3] is b[3] or (math.isnan(a[3]) and math.isnan(b[3])) or math.isclose(a[3], b[3], abs_tol=1e-6 if strict else 1e-12)


def test_blocks_refuse_what_cannot_be_compared(spark):
    papers = _papers(spark, [E[0]])
    for rows, text in (([(0, None)], "must have an embedding"), ([], "empty reference set"), ([(0, [1.0, 2.0])], "cannot be compared")):
        with pytest.raises(ValueError, match=text):
            BL.score_blocks(papers, spark.createDataFrame(rows, "ref_id long, embedding array<double>"), FIXTURE_CONFIG)


def test_related_detail_equals_sorted_detail(spark):
    rng = np.random.default_rng(4)
    refs_m, vecs = rng.normal(size=(7, 4)), rng.normal(size=(9, 4))
    refs_m[3] = refs_m[1]  # a tie
    refs = _refs(refs_m)
    refs_df = spark.createDataFrame([(i, f"r{i}", [float(x) for x in r]) for i, r in enumerate(refs_m)], "ref_id long, title string, embedding array<double>")
    want = SC.sorted_detail(SC.score_papers(_papers(spark, vecs), refs, FIXTURE_CONFIG), refs).orderBy("paper_id").collect()
    got = BL.related_detail(BL.with_row_key(_papers(spark, vecs)), refs_df, FIXTURE_CONFIG, block_bytes=64, cell_bytes=128).orderBy("paper_id").collect()
    for a, b in zip(want, got):
        assert [(d["ref_id"], f"r{d['ref_id']}") for d in a["detail"]] == [(d["ref_id"], d["ref_title"]) for d in b["detail"]]
        assert np.allclose([d["similarity"] for d in a["detail"]], [d["similarity"] for d in b["detail"]])


def test_reference_size_check(spark):
    refs_df = spark.createDataFrame([(i, [1.0] * 8) for i in range(10)], "ref_id bigint, embedding array<double>")
    with pytest.raises(SC.ReferenceSetTooLarge):
        SC.collect_reference_set(refs_df, max_bytes=100)


def test_centroid_mean_equals_mean(spark):
    rng = np.random.default_rng(5)
    refs_m = rng.normal(size=(7, 6))
    vecs = rng.normal(size=(20, 6))
    refs_df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(refs_m)],
                                    "ref_id bigint, embedding array<double>")
    c = SC.reference_centroid(refs_df)
    got = [r[0] for r in _papers(spark, vecs).select(SC.centroid_mean("embedding", c)).collect()]
    refs = _refs(refs_m)
    for v, g in zip(vecs, got):
        assert math.isclose(g, ((v / np.linalg.norm(v)) @ refs.matrix.T).mean(), abs_tol=1e-9)


def test_sorted_detail_order(spark):
    refs = _refs([[1, 0], [1, 0], [0, 1]])
    scored = SC.score_papers(_papers(spark, [[1.0, 0.0]]), refs, FIXTURE_CONFIG)
    d = SC.sorted_detail(scored, refs).first()["detail"]
    assert [x["ref_id"] for x in d] == [0, 1, 2]  # ties by ref id


def test_exclude_reference_papers(spark):
    refs = _refs([[1, 0], [0, 1]], titles=["Robust \\textbf{M}odels", "Other"])
    papers = spark.createDataFrame([(1, "robust models"), (2, "Robust  Models "), (3, "new"), (4, None)],
                                   "paper_id long, title string")
    got = sorted(r[0] for r in SC.exclude_reference_papers(papers, refs).collect())
    assert got == [3, 4]


def test_row_blocks_and_partial_top_k(spark, monkeypatch):
    # force several row blocks and the partial-selection path for top-k
    monkeypatch.setattr(SC, "BLOCK_ELEMS", 40)
    rng = np.random.default_rng(11)
    refs_m = rng.normal(size=(20, 5))
    vecs = list(rng.normal(size=(30, 5))) + [None, [float("nan")] * 5]
    cfg = TriageConfig(similarity_threshold=0.05, top_k=3, min_top_papers=2, individual_sim_threshold=0.3)
    refs = _refs(refs_m)
    got = _score(spark, vecs, refs, cfg, "arrow")
    ref = _score(spark, vecs, refs, cfg, "sql")
    for a, b in zip(got, ref):
        assert a[:3] == b[:3]
        assert (a[3] is None and b[3] is None) or math.isnan(a[3]) and math.isnan(b[3]) or math.isclose(a[3], b[3], abs_tol=1e-12)
    out = SC.score_papers(_papers(spark, vecs[:3]), refs, cfg, keep_sims=False).first()
    assert out["sims"] == []


def test_collapse_reference_titles(spark):
    refs = spark.createDataFrame(
        [(0, "Robust  Models", "a0"), (1, "Other", "b"), (2, "robust models", "a2")],
        "ref_id long, title string, abstract string",
    )
    got = sorted(tuple(r) for r in SC.collapse_reference_titles(refs).select("ref_id", "title", "abstract").collect())
    assert got == [(0, "Robust  Models", "a2"), (1, "Other", "b")]


def test_reference_collect(spark):
    for n in (23, 3000):
        df = spark.createDataFrame([(i, [float(i % 7), 1.0], f"t{i}") for i in range(n)],
                                   "ref_id long, embedding array<double>, title string")
        refs = SC.collect_reference_set(df.repartition(3), "ref_id", "embedding", "title")
        assert refs.size == n and list(refs.ref_ids) == list(range(n))
        assert refs.titles[5] == "t5"
    wide = spark.createDataFrame([(0, [1.0] * 5000)], "ref_id long, embedding array<double>")
    assert SC.collect_reference_set(wide).dim == 5000
    null = spark.createDataFrame([(0, [1.0]), (1, None)], "ref_id long, embedding array<double>")
    with pytest.raises(ValueError, match="no embedding"):
        SC.collect_reference_set(null)


def test_wide_similarity_rows_come_in_slices(spark, monkeypatch):
    rng = np.random.default_rng(6)
    vecs, refs = list(rng.normal(size=(40, 4))) + [None], _refs(rng.normal(size=(30, 4)))
    want = SC.score_papers(_papers(spark, vecs), refs, FIXTURE_CONFIG).orderBy("paper_id").collect()
    monkeypatch.setattr(SC, "MAX_SIMS_BATCH_BYTES", 1000)  # four rows at a time
    assert SC.score_papers(_papers(spark, vecs), refs, FIXTURE_CONFIG).orderBy("paper_id").collect() == want
