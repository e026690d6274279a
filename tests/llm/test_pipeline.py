"""The pipeline, stage by stage, each on what its predecessor kept."""

import collections

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from hirelens.llm import queries  # noqa: E402

from .conftest import EDGE_ROWS  # noqa: E402
from .test_documents import WORD, brute_join, brute_passages  # noqa: E402
from .test_tokens import expected_bpe  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("pipeline")
    frames = [queries.table(spark, SF, "documents")]
    for name, f in corpus_pipeline.STAGES:
        path = str(top / name)
        f(spark, frames[-1], SF).write.parquet(path)
        frames.append(spark.read.parquet(path))
    return frames


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns(stages):
    assert all(f.columns == stages[0].columns and f.dtypes == stages[0].dtypes for f in stages[1:-1])


def test_quality_stage(spark, stages):
    before, after = dict(pairs(stages[0])), dict(pairs(stages[1]))
    predicted = {r.doc_id: r.predicted for r in queries.op8_quality_classifier(spark, SF).collect()}
    assert after == {d: t for d, t in before.items() if predicted[d] == 1}
    labels = {r.doc_id: r.quality for r in queries.table(spark, SF, "labels").collect()}
    clean = [d for d, q in labels.items() if q == 1 and d in before]
    assert sum(d in after for d in clean) >= 0.98 * len(clean)


def test_line_stage(stages):
    assert dict(pairs(stages[2])) == brute_passages(pairs(stages[1]))
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_near_dedup_stage(stages):
    rows = pairs(stages[2])
    keep = [d for d, _, c in map(eval, brute_join(rows)) if d == c]
    assert sorted(pairs(stages[3])) == sorted((d, t) for d, t in rows if d in set(keep))


def test_mixing_stage(stages):
    from hirelens.llm.mixing import targets
    texts, sources = dict(pairs(stages[3])), {r.doc_id: r.source for r in stages[3].collect()}
    size, taken, by_doc = collections.Counter(), collections.Counter(), collections.Counter()
    for d, t in texts.items():
        size[sources[d]] += len(WORD.findall(t))
    for r in stages[4].collect():
        assert r.text in texts[r.doc_id] and r.source == sources[r.doc_id]
        taken[r.source] += len(WORD.findall(r.text))
        by_doc[r.doc_id] += len(WORD.findall(r.text))
    names = sorted(size)
    want = targets([size[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(size.values()))
    assert all(abs(taken[s] - w) <= 0.5 for s, w in zip(names, want))
    assert all(n <= 2 * len(WORD.findall(texts[d])) for d, n in by_doc.items())


def test_bpe_stage(stages):
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in stages[5].collect())
    assert got == expected_bpe(pairs(stages[4]))


def test_run_is_the_stages_in_order(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages[5].collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_edge_rows_and_empty_tables(spark, edge, empty, tmp_path):
    for k, docs in enumerate((edge, empty)):
        for name, f in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{k}{name}")
            f(spark, docs, SF).write.parquet(path)
            out = spark.read.parquet(path)
            if name != "byte_bpe":
                assert out.columns == docs.columns
            if name in ("line_dedup", "byte_bpe"):
                assert out.count() == (len(EDGE_ROWS) if k == 0 else 0)
