import random

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F

from amperline.llm import quality_classifier as classifier
from amperline.llm.bytetext import flat
from tests.llm.small import frame

def held():
    return F.col("doc_id") % 3 == 1


def test_learns_spelling_and_repetition(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(600):
        own = [rnd.choice(words) for _ in range(rnd.randint(20, 80))]
        bad = i % 4
        if bad == 1:
            own = [w + "###" for w in own]
        elif bad == 2:
            own = [w for w in own[:10] for _ in range(9)]
        docs.append((i, " ".join(own)))
        labels.append((i, int(bad in (0, 3))))
    marked = spark.createDataFrame([*labels, (0, 0), (None, 1)], "doc_id long, quality int")
    more = [(1000, None), (1001, ""), (1002, "x"), (None, "some text"), docs[5]]
    rows = classifier.scored(frame(spark, docs + more), marked, held()).collect()
    assert len(rows) == len(docs) + len(more) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    by = {r.doc_id: r for r in rows}
    apart = [i for i, _ in labels if i % 3 == 1]
    assert all(by[i].held_out for i in apart)
    assert sum(by[i].predicted == dict(labels)[i] for i in apart) / len(apart) > 0.97
    assert by[1000].score == by[1001].score


def test_one_label_or_none(spark):
    docs = [(i, f"text number {i}") for i in range(20)]
    for labels, low, high in (([], 0.4, 0.6), ([(i, 0) for i in range(20)], 0, 0.1), ([(i, 1) for i in range(20)], 0.9, 1)):
        rows = classifier.scored(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int"), held()).collect()
        assert len(rows) == 20 and all(low <= r.score <= high for r in rows)
    assert classifier.scored(frame(spark, docs).limit(0), spark.createDataFrame([(1, 1)], "doc_id long, quality int"), held()).count() == 0


def test_features_don_t_cross_texts():
    texts = ["ab ab cd", "", "cd", None, "cd cd"]
    together = list(classifier._features(*flat(pa.array(texts))))
    for row, text in enumerate(texts):
        alone = list(classifier._features(*flat(pa.array([text], pa.string()))))
        for (cells, bounds), (own, _) in zip(together, alone, strict=True):
            assert np.array_equal(cells[bounds[row] : bounds[row + 1]], own)


def test_sample_bounds_rows(spark, monkeypatch):
    """Repeated rows and labels without a document neither fill the sample nor grow it."""
    docs = [(i, f"text number {i}") for i in range(60)] + [(3, "text number 3")] * 2000 + [(3, "another text")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    sizes = []
    plain = classifier.train
    monkeypatch.setattr(classifier, "train", lambda cells, counts, marks: sizes.append(len(marks)) or plain(cells, counts, marks))
    for bound, want in ((4000, 41), (25, 25)):
        monkeypatch.setattr(classifier, "SAMPLE", bound)
        assert classifier.scored(frame(spark, docs), labels, held()).count() == len(docs)
        assert sizes.pop() == want
