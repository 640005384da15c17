"""Quality rules with thresholds that follow the data.

Fixed cut-offs fit one language or source and fail for the next.  Here each document gets integer measures,
each (lang, source) gets a quantile sketch of every measure, and a document is rejected when a measure lies
beyond the fence that the sketch of its own group gives.  Everything is built from DataFrame and SQL functions.

*Sketch.*  A histogram with buckets of bounded relative width: a value keeps its 6 leading bits, so a
bucket is at most 1/32 of its values wide and a measure below 2**40 has at most 64 + 34 * 32 buckets,
whatever the number of documents.  Sketches merge by adding counts: the sketch of a language is the sum of
those of its sources, and that of the corpus the sum over languages.  A group with fewer than ``min_docs``
documents uses its language's sketch, and a small language the corpus's.

*Fence.*  ``middle + reach * (upper - middle) + slack`` with the quantiles ``middle`` (0.5) and ``upper`` (0.75); for a
measure whose small values are suspect, the mirror image with the quantile 0.25.  It scales with the spread of the
group and, unlike a quantile cut, rejects nothing where all documents are alike.

Null texts have no words and fail the base rules; null languages and sources are groups of their own.
Repeated rows are judged alike; an empty table gives an empty result; columns other than those read are carried
along or ignored, and names of the measures may clash with them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.store import written

WHITE = ("\\t", "\\n", "\\u000B", "\\u000C", "\\r")

SYMBOLS = "#*$%&|<>"

MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8


@dataclass(frozen=True)
class Measure:
    """``side`` is +1 if large values are suspect, -1 if small ones are.  Measures are shares in 1/10000 (distinct words: in 1/1000 of a power of all words)."""

    name: str
    side: int
    reach: int
    slack: int


MEASURES = (
    Measure("symbol_share", 1, 6, 100),
    Measure("capital_share", 1, 12, 600),
    Measure("mark_share", 1, 6, 100),
    Measure("dup_line_share", 1, 6, 3400),
    Measure("distinct_share", -1, 3, 500),
)
MIN_DOCS = 50


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct column ``m`` of base counts and measures (in 1/10000, integers)."""
    # A lambda over a one-element array binds a value, so that it is computed once per row.
    let = "transform(array({}), {} -> {})[0]".format
    spaced = "t"
    for mark in WHITE:
        spaced = f"replace({spaced}, '{mark}', ' ')"
    # Hashes of 8-word windows from those of 2 and 4 words: each step pairs a list with itself, moved on.
    windows = "v"
    for step in (4, 2, 1):
        kept = f"greatest(size(v) - {step}, 0)"
        paired = f"zip_with(slice(v, 1, {kept}), slice(v, {step + 1}, {kept}), (a, b) -> xxhash64(a, b))"
        windows = let(paired, "v", windows)
    windows = let("h", "v", windows)
    # Starts of windows found twice or more, in order; each covers 8 words or those before the next start.
    twice = "(j > 0 AND s[greatest(j - 1, 0)].x = e.x) OR (j < size(s) - 1 AND s[least(j + 1, size(s) - 1)].x = e.x)"
    starts = let("array_sort(transform(g, (x, i) -> struct(x AS x, i AS i)))", "s", f"array_sort(transform(filter(s, (e, j) -> {twice}), e -> e.i))")
    covered = f"CAST(IF(j = size(p) - 1, {WINDOW}, least({WINDOW}, p[least(j + 1, size(p) - 1)] - x)) AS BIGINT)"
    repeated = f"IF(size(g) = size(array_distinct(g)), 0L, {let(starts, 'p', f'aggregate(transform(p, (x, j) -> {covered}), 0L, (a, x) -> a + x)')})"
    without = "CAST(length(t) - length(regexp_replace(t, '[{}]+', '')) AS BIGINT)".format
    counts = f"""named_struct(
        'n_words', CAST(size(w) AS BIGINT),
        'word_chars', CAST(length(array_join(w, '')) AS BIGINT),
        'n_symbols', {without(SYMBOLS)},
        'n_dup_lines', CAST(size(l) - size(array_distinct(l)) AS BIGINT),
        'n_repeat_words', {let(windows, 'g', repeated)},
        'n_lines', CAST(size(l) AS BIGINT),
        'n_distinct', CAST(size(array_distinct(h)) AS BIGINT),
        'n_capitals', {without('A-Z')},
        'n_marks', {without('!?')})"""
    lines = "filter(split(t, '\\\\n'), x -> x RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"
    words = let(f"split({spaced}, ' ')", "x", "IF(array_contains(x, ''), filter(x, y -> y <> ''), x)")
    counted = let(words, "w", let("transform(w, x -> xxhash64(x))", "h", let(lines, "l", counts)))
    return docs.withColumn("m", F.expr(let("coalesce(text, '')", "t", counted)))


def statistics(docs: DataFrame) -> DataFrame:
    """One narrow row per document: keys, base counts, base verdict and measures."""
    share = "CAST(10000 * {} DIV greatest({}, 1L) AS BIGINT)"
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return (
        measured(docs.select("doc_id", "text", "lang", "source"))
        .select("doc_id", "lang", "source", F.xxhash64("text").alias("text_hash"), "m.*")
        .select(
            "doc_id", "lang", "source", "text_hash", *base,
            F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words").alias("base_failed"),
            F.expr(share.format("n_symbols", "word_chars")).alias("symbol_share"),
            F.expr(share.format("n_capitals", "word_chars")).alias("capital_share"),
            F.expr(share.format("n_marks", "word_chars")).alias("mark_share"),
            F.expr(share.format("n_dup_lines", "n_lines")).alias("dup_line_share"),
            # Distinct words grow more slowly than all words (Heaps' law): they are held against n_words ** 0.875.
            F.expr("1000 * n_distinct DIV greatest(CAST(floor(sqrt(n_words * sqrt(n_words * sqrt(n_words)))) AS BIGINT), 1L)").alias("distinct_share"),
        )
    )


BUCKET = "shiftleft(shiftright({0}, greatest(length(bin({0})) - 6, 0)), greatest(length(bin({0})) - 6, 0))"


def sketches(stats: DataFrame) -> DataFrame:
    """Counts by (lang, source, measure, bucket); a bucket is named by its lower bound.  Documents that fail the base rules don't count."""
    pairs = F.array(*(F.struct(F.lit(m.name).alias("measure"), F.expr(BUCKET.format(m.name)).alias("bucket")) for m in MEASURES))
    return (
        stats.where("NOT base_failed")
        .select("lang", "source", F.explode(pairs).alias("p"))
        .groupBy("lang", "source", "p.measure", "p.bucket")
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Add sketches up to coarser groups."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quantiles 0.25, 0.5, 0.75 of each group and measure from its sketch: arrays of at most some hundred buckets."""
    total = "aggregate(b, 0L, (a, x) -> a + x.n)"
    # Running count over the sorted buckets; the first bucket that reaches the rank is the quantile's.
    walk = """aggregate(b, named_struct('seen', 0L, 'at', CAST(NULL AS BIGINT)),
        (a, x) -> named_struct('seen', a.seen + x.n,
                               'at', CASE WHEN a.at IS NULL AND 100 * (a.seen + x.n) >= {q} * total THEN x.bucket ELSE a.at END),
        a -> a.at)"""
    return (
        sketch.groupBy(*keys, "measure")
        .agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("b"))
        .withColumn("total", F.expr(total))
        .select(*keys, "measure", "total", *(F.expr(walk.format(q=q)).alias(f"q{q}") for q in (25, 50, 75)))
    )


def thresholds(stats: DataFrame) -> DataFrame:
    """One row per (lang, source): the fence of every measure, as ``<measure>_fence``."""
    fine = sketches(stats)
    by_source = quantiles(fine, ["lang", "source"]).alias("s")
    language = merged(fine, ["lang"])
    by_language = quantiles(language, ["lang"]).alias("l")
    overall = quantiles(merged(language, []), []).alias("o")
    chosen = by_source.join(by_language, F.expr("s.lang <=> l.lang AND s.measure = l.measure")).join(overall, F.expr("s.measure = o.measure"))
    pick = "CASE WHEN s.total >= {n} THEN s.{q} WHEN l.total >= {n} THEN l.{q} ELSE o.{q} END"
    fences = chosen.select(
        "s.lang", "s.source", "s.measure", *(F.expr(pick.format(n=MIN_DOCS, q=q)).alias(q) for q in ("q25", "q50", "q75"))
    )
    cases = [
        F.max(
            F.when(
                F.col("measure") == m.name,
                F.col("q50") + m.reach * (F.col("q75") - F.col("q50")) + m.slack if m.side > 0 else F.col("q50") - m.reach * (F.col("q50") - F.col("q25")) - m.slack,
            )
        ).alias(f"{m.name}_fence")
        for m in MEASURES
    ]
    return fences.groupBy("lang", "source").agg(*cases)


def judged(stats: DataFrame) -> DataFrame:
    """Statistics with ``kept``: joined with the thresholds of the document's own group.

    The thresholds have a row per (lang, source); Spark broadcasts them while they are small and splits hot groups
    of the join otherwise.
    """
    fences = thresholds(stats).withColumnsRenamed({"lang": "its_lang", "source": "its_source"})
    within = " AND ".join(f"({m.name} {'<=' if m.side > 0 else '>='} coalesce({m.name}_fence, {m.name}))" for m in MEASURES)
    return (
        stats.join(fences, F.expr("lang <=> its_lang AND source <=> its_source"), "left")
        .withColumn("kept", F.expr(f"NOT base_failed AND {within}"))
        .drop("its_lang", "its_source", *(f"{m.name}_fence" for m in MEASURES))
    )


def verdicts(docs: DataFrame) -> DataFrame:
    """Base counts and verdict per document.  The statistics are stored, so texts are read once."""
    return judged(written(statistics(docs), "quality-statistics"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns."""
    bad = verdicts(docs).where("NOT kept").select("doc_id", "lang", "source", "text_hash").distinct().alias("b")
    match = "d.doc_id <=> b.doc_id AND d.lang <=> b.lang AND d.source <=> b.source AND xxhash64(d.text) = b.text_hash"
    return docs.alias("d").join(bad, F.expr(match), "left_anti")
