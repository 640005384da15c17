import random

import pyspark.sql.functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from amperline.llm import toxicity
from tests.llm.small import frame

def held():
    return F.col("doc_id") % 5 == 0


@given(st.lists(st.sampled_from([0.0, 0.0, 0.0, 1.5, 4.0]), max_size=25))
@settings(max_examples=300, deadline=None)
def test_segments_against_their_definition(scores):
    """Maximal segments: the best segment of the whole, then those left and right of it, and so on."""
    drift = 1.0
    sequence = [s - drift for s in scores]

    def best(a, b):
        found = max(((sum(sequence[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if found[0] <= 0:
            return []
        i, j = -found[2], -found[2] - found[1]
        return [*best(a, i), found[0], *best(j, b)]

    at = [i for i, s in enumerate(scores) if s]
    got = toxicity.segments(at, [scores[i] for i in at], drift)
    assert [round(s, 6) for _, _, s in got] == [round(s, 6) for s in best(0, len(sequence))]
    assert all(round(sum(sequence[a:b]), 6) == round(s, 6) for a, b, s in got)


def toxic_corpus(size=900):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(size):
        own = [rnd.choice(words) for _ in range(rnd.randint(20, 120))]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                own[rnd.randrange(len(own))] = rnd.choice(["grobblewort", "zakknuff", "Fizzgigger"])
        docs.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    return docs, labels


def test_finds_toxic_texts_and_passages(spark):
    docs, labels = toxic_corpus()
    marked = spark.createDataFrame([*labels, (1, 1), (None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    more = [(2000, None), (2001, ""), (2002, "x"), (2003, "calm " * 3000 + "zakknuff zakknuff grobblewort " * 3), (None, "zakknuff zakknuff"), docs[4]]
    rows = toxicity.scored(frame(spark, docs + more), marked, held()).collect()
    assert len(rows) == len(docs) + len(more) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    by = {r.doc_id: r for r in rows}
    apart = [i for i, _ in labels if i % 5 == 0]
    assert sum(by[i].predicted == dict(labels)[i] for i in apart) / len(apart) > 0.97
    assert by[2000].score == by[2001].score == by[2002].score == 0 and by[2000].held_out and not by[2001].held_out
    assert by[2003].predicted and all(s.first >= 14_900 for s in by[2003].segments)


def test_one_label_or_none(spark):
    docs = [(i, f"text number {i}") for i in range(20)]
    for labels in ([], [(i, 0) for i in range(20)], [(i, 1) for i in range(20)]):
        rows = toxicity.scored(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int"), held()).collect()
        assert len(rows) == 20 and all(r.score == 0 and r.predicted == 0 for r in rows)
    assert toxicity.scored(frame(spark, docs).limit(0), spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), held()).count() == 0


def test_segments_are_linear_in_isolated_hits():
    """A text of tens of MB: single hits far apart, and hits that rise so slowly that none joins another."""
    count = 300_000
    far = toxicity.segments(list(range(0, 100 * count, 100)), [2.0] * count, 0.1)
    assert len(far) == count and far[0] == (0, 1, 1.9) and far[-1][0] == 100 * (count - 1)
    near = toxicity.segments(list(range(0, 20 * count, 20)), [2.1] * count, 0.1)
    assert near[0][0] == 0 and near[-1][1] == 20 * (count - 1) + 1
