import random

import numpy as np
import pyarrow as pa
import pytest

from tapflow.llm import toxicity as X, words as W
from tests.llm.helpers import DATA, DOCS, odd_docs, prose

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark):
    """Toxic documents hold a word of a stem of their language, often with an ending not seen before."""
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        lang, toxic = rnd.choice(["en", "de"]), int(rnd.random() < 0.3)
        words = prose(i, rnd.randrange(5, 120)).split()
        if toxic:
            words[rnd.randrange(len(words))] = "moron" if lang == "en" else f"lowei{rnd.randrange(10**6)}x"
        rows.append((i, " ".join(words), lang, "a", 1, 0.5, 1))
        labels.append((i, 1, toxic))
    labels += [(None, 1, 1), (1, None, None), (10**6, 0, 1)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    model = X.train(docs, labels)
    rows = X.score(docs, model).withColumnRenamed("toxic", "found").join(labels, "doc_id").where(X.held_out()).where("toxic IS NOT NULL").collect()
    assert len(rows) > 200
    assert np.mean([r.found == bool(r.toxic) for r in rows]) > 0.95
    assert np.mean([(r.score >= 0.7) == bool(r.toxic) for r in rows]) > 0.93
    again = X.train(docs.repartition(5), labels.repartition(3))
    assert (again.table == model.table).all() and again.thresholds == model.thresholds
    kept = {r.doc_id for r in X.without_toxic(docs, model).collect()}
    assert kept == {r.doc_id for r in X.score(docs, model).where("NOT toxic").collect()}


def test_score_sees_the_whole_text_and_nothing_else(tables):
    model = X.train(*tables)
    texts = ["moron", prose(1, 30_000), prose(1, 30_000) + " moron", "", prose(2, 10), prose(2, 10)]
    together = X.scores(model, W.flat(pa.array(texts)))
    alone = np.array([X.scores(model, W.flat(pa.array([t])))[0] for t in texts])
    assert together == pytest.approx(alone, abs=1e-6)
    assert together[0] > 0.7 and together[2] > 0.7 > together[1] and together[4] == together[5]


def test_gradients_lower_the_loss():
    texts = W.flat(pa.array(["good words here", "bad words here"] * 30))
    ids, first = X.word_ids(texts)
    examples = [ids[:, a:b] for a, b in zip(first, first[1:])]
    model = X.fit(examples, np.array([0, 1] * 30), 0.5)
    found = X.scores(model, texts)
    assert (found[1::2] > 0.9).all() and (found[::2] < 0.1).all()


def test_odd_rows_and_empty_tables(spark):
    odd = odd_docs(spark)
    none = spark.createDataFrame([], LABELS)
    model = X.train(odd, none)
    rows = X.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score < 0.01 and not r.toxic for r in rows)
    one_class = X.train(odd, spark.createDataFrame([(2, 1, 1), (3, 1, 1)], LABELS))
    assert all(0 <= r.score <= 1 for r in X.score(odd, one_class).collect())
    assert X.without_toxic(odd, model).columns == odd.columns
    assert X.score(odd.limit(0), X.train(odd.limit(0), none)).count() == 0
    assert spark.read.parquet(f"{DATA}/labels.parquet").columns == ["doc_id", "quality", "toxic"]


def test_thresholds_see_all_labelled_rows_that_the_fit_has_not_seen(spark, tables):
    docs, labels = tables
    model = X.train(docs, labels, 20)
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~X.held_out())
    by_hash = [X.F.xxhash64(X.F.col("doc_id").cast("string")), "doc_id"]
    sample = sorted(str(r.doc_id) for c in (0, 1) for r in known.where(f"toxic = {c}").orderBy(*by_hash).limit(20).collect() if r.doc_id < 900)
    fitted = {x for n, x in enumerate(sample) if n % X.CALIBRATE != X.CALIBRATE - 1}
    rows = [r for r in docs.join(known, "doc_id").collect() if str(r.doc_id) not in fitted]
    assert len(rows) > 500
    found = X.scores(model, W.flat(pa.array([r.text for r in rows])))
    middles = (np.minimum((found * X.BINS).astype(int), X.BINS - 1) + 0.5) / X.BINS
    marks, langs = np.array([r.toxic for r in rows]), np.array([r.lang for r in rows])
    assert model.threshold == pytest.approx(X.calibrated(middles, marks))
    for lang in ("en", "de"):
        assert model.thresholds[lang] == pytest.approx(X.calibrated(middles[langs == lang], marks[langs == lang], model.threshold))


def test_thresholds():
    assert X.calibrated(np.array([0.1, 0.2, 0.8, 0.9]), np.array([0, 0, 1, 1])) == pytest.approx(0.5)
    assert X.calibrated(np.array([0.1, 0.2]), np.array([0, 0]), 0.6) == 0.6
    assert X.calibrated(np.zeros(0), np.zeros(0, int)) == 0.5
