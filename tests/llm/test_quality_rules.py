from amperline.llm import quality_rules
from tests.llm.small import corpus, frame, words


def base(text):
    own = words(text)
    grams = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts_against_plain_python(spark):
    docs = [(i, t) for i, t in corpus(2, 60) if len(t or "") < 3000]
    docs += [(900, "a b c d e f g h " * 5), (901, "x\x0b\x0cy z #|<>\n\nx\n x\nx"), (902, "one " * 40)]
    rows = quality_rules.verdicts(frame(spark, docs)).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == sorted((str(i), *base(t)) for i, t in docs)
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept in ((False,) if r.base_failed else (True, False))


def test_fence_follows_the_group(spark):
    """The same share of symbols is usual in one source and stands out in another."""
    plain = "some words follow one another in this text number {} and go on so that there are enough of them all here {}"
    docs = [(i, plain.format(i, i * 7), "en", "a") for i in range(80)]
    docs += [(100 + i, plain.format(i, i * 7) + " ###" * (i % 9), "en", "b") for i in range(80)]
    docs += [(300, plain.format(1, 2) + " ###" * 6, "en", "a"), (301, plain.format(1, 2) + " ###" * 6, "en", "b")]
    rows = quality_rules.verdicts(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert not kept[300] and kept[301] and all(kept[i] for i in range(80))


def test_keep_good_keeps_columns_and_repeated_rows(spark):
    docs = corpus(3, 40)
    df = frame(spark, docs)
    kept = quality_rules.keep_good(df)
    assert kept.columns == df.columns
    verdict = {(r.doc_id, r.text_hash): r.kept for r in quality_rules.verdicts(df).collect()}
    assert kept.count() == sum(verdict[r.doc_id, r.h] for r in df.selectExpr("doc_id", "xxhash64(text) AS h").collect())


def test_empty_table(spark):
    df = frame(spark, [(1, "a")]).limit(0)
    assert quality_rules.verdicts(df).count() == 0
    assert quality_rules.keep_good(df).count() == 0


def test_no_python_in_the_plan(spark):
    df = quality_rules.measured(frame(spark, corpus(4, 10)))
    assert "Python" not in df._jdf.queryExecution().toString()
