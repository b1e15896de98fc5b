"""The pipeline stage by stage, each against a plain version on its own input."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from prefloom.llm import pieces
from test_lines import brute as brute_lines
from test_mixing import shared
from test_near import brute as brute_near


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Every stage's rows; the first entry is the input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, out[-1], sf_dir).write.parquet(folder)
        out.append(spark.read.parquet(folder))
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes
    assert stages[-1].columns == [*stages[0].columns, "ids"]


def test_quality_keeps_rows_as_they_are(spark, sf_dir, stages):
    before, after = Counter(rows(stages[0])), Counter(rows(stages[1]))
    assert not after - before
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r[0] for r in after}
    good = [i for i, q in label.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)


def test_lines(stages):
    before, after = rows(stages[1]), {r[0]: r for r in rows(stages[2])}
    gone = brute_lines([r[:2] for r in before])
    for i, text, lang, source, _ in before:
        kept = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone[i, text])
        if gone[i, text] and not kept.split():
            assert i not in after
        else:
            assert after[i] == (i, kept, lang, source, len(kept))


def test_near(stages):
    before, after = rows(stages[2]), rows(stages[3])
    first = {i for i, name, _ in brute_near([r[:2] for r in before]) if i == name}
    assert Counter(r for r in before if str(r[0]) in first) == Counter(after)


def test_mix(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(after) <= set(before)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r[3]] += len(r[1].split())
        largest[r[3]] = max(largest[r[3]], len(r[1].split()))
    for r in after:
        taken[r[3]] += len(r[1].split())
    assert max(Counter(after).values()) <= 3
    for source, target in shared(sizes).items():
        assert abs(taken[source] - target) <= largest[source]


def test_pieces(spark, stages):
    before, after = Counter(rows(stages[4])), Counter(rows(stages[5]))
    assert before == after
    back = pieces.decode(stages[5], pieces.load(), "text")
    assert all(r.text == r.decoded for r in back.collect())


def test_run(spark, sf_dir, stages):
    got = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == Counter((r.doc_id, tuple(r.ids)) for r in stages[5].collect())
    assert corpus_pipeline.run.__doc__


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0
