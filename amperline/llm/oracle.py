"""DuckDB SQL of the corpus queries, where SQL can express them."""

from __future__ import annotations

from amperline.llm.manifest import FAN
from amperline.llm.mixing import CYCLE, MAX_EPOCHS, SEED
from amperline.llm.quality_rules import MEASURES, MIN_DOCS, MIN_WORDS, REPEAT_PERCENT, WINDOW
from amperline.llm.spelling import DAMAGE_MOD, FORM_FACTOR, MIN_COUNT, MIN_LENGTH

WORD = r"[^\x20\x09-\x0D]"


def _bucket(v: str) -> str:
    shift = f"greatest(length(bin({v})) - 6, 0)"
    return f"(({v} >> {shift}) << {shift})"


def quality_rules() -> str:
    values = " UNION ALL ".join(f"SELECT lang, source, '{m.name}' AS measure, {_bucket(m.name)} AS bucket FROM stats WHERE NOT base_failed" for m in MEASURES)
    level = """
    {name} AS (
      SELECT {keys} measure, max(total) AS total, {picks}
      FROM (SELECT *, sum(n) OVER (PARTITION BY {keys} measure) AS total,
                   sum(n) OVER (PARTITION BY {keys} measure ORDER BY bucket) AS seen
            FROM (SELECT {keys} measure, bucket, sum(n) AS n FROM sketch GROUP BY {keys} measure, bucket))
      GROUP BY {keys} measure)"""
    picks = ", ".join(f"min(bucket) FILTER (100 * seen >= {q} * total) AS q{q}" for q in (25, 50, 75))
    levels = ",".join(level.format(name=n, keys=k, picks=picks) for n, k in (("by_source", "lang, source,"), ("by_language", "lang,"), ("overall", "")))
    pick = ", ".join(f"CASE WHEN s.total >= {MIN_DOCS} THEN s.{q} WHEN l.total >= {MIN_DOCS} THEN l.{q} ELSE o.{q} END AS {q}" for q in ("q25", "q50", "q75"))
    fences = ", ".join(
        f"max(q50 + {m.reach} * (q75 - q50) + {m.slack}) FILTER (measure = '{m.name}') AS {m.name}_fence"
        if m.side > 0
        else f"max(q50 - {m.reach} * (q50 - q25) - {m.slack}) FILTER (measure = '{m.name}') AS {m.name}_fence"
        for m in MEASURES
    )
    within = " AND ".join(f"t.{m.name} {'<=' if m.side > 0 else '>='} coalesce(f.{m.name}_fence, t.{m.name})" for m in MEASURES)
    return rf"""
    WITH words AS (
      SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '{WORD}+') AS w FROM documents),
    grams AS (
      SELECT r, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words)),
    starts AS (
      SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next
      FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
    repeats AS (SELECT r, sum(least({WINDOW}, coalesce(next - i, {WINDOW}))) AS n_repeat_words FROM starts GROUP BY r),
    counts AS (
      SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
             CAST(length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS BIGINT) AS n_marks,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l,
             CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct
      FROM words),
    stats AS (
      SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
             10000 * n_symbols // greatest(word_chars, 1) AS symbol_share,
             10000 * n_capitals // greatest(word_chars, 1) AS capital_share,
             10000 * n_marks // greatest(word_chars, 1) AS mark_share,
             10000 * n_dup_lines // greatest(n_lines, 1) AS dup_line_share,
             1000 * n_distinct // greatest(CAST(floor(sqrt(n_words * sqrt(n_words * sqrt(n_words)))) AS BIGINT), 1) AS distinct_share
      FROM (SELECT counts.*, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
                   CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines
            FROM counts LEFT JOIN repeats USING (r))),
    sketch AS (SELECT lang, source, measure, bucket, count(*) AS n FROM ({values}) GROUP BY ALL),
    {levels},
    chosen AS (
      SELECT s.lang, s.source, s.measure, {pick}
      FROM by_source s JOIN by_language l ON s.lang IS NOT DISTINCT FROM l.lang AND s.measure = l.measure JOIN overall o ON s.measure = o.measure),
    fences AS (SELECT lang, source, {fences} FROM chosen GROUP BY lang, source),
    judged AS (
      SELECT t.*, NOT base_failed AND {within} AS kept
      FROM stats t LEFT JOIN fences f ON t.lang IS NOT DISTINCT FROM f.lang AND t.source IS NOT DISTINCT FROM f.source)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""


REVISITS = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h, 1700000000 + (page_id * 7919) % 2592000 AS t, '"' || md5(coalesce(html, '')) || '"' AS tag FROM pages),
records AS (
  SELECT page_id * 8 AS record_id, url, t AS sec, 'response' AS kind, tag AS etag, CAST(t - 86400 AS VARCHAR) AS modified, md5(h) AS digest,
         CAST(strlen(h) AS VARCHAR) AS size FROM p
  UNION ALL SELECT page_id * 8 + 1, url || '#again', t + 60, 'revisit', 'W/' || tag, NULL, NULL, NULL FROM p WHERE page_id % 2 = 0
  UNION ALL SELECT page_id * 8 + 2, url, t + 90000, 'revisit', NULL, CAST(t - 86400 AS VARCHAR), md5(h), NULL FROM p WHERE page_id % 3 = 0
  UNION ALL SELECT page_id * 8 + 3, url, t - 30, 'revisit', tag, NULL, NULL, NULL FROM p WHERE page_id % 5 = 0
  UNION ALL SELECT page_id * 8 + 4, url, t + 7200, 'revisit', '"other"', NULL, NULL, NULL FROM p WHERE page_id % 7 = 0
  UNION ALL SELECT page_id * 8 + 5, url, t + 10, 'revisit', NULL, NULL, NULL, NULL FROM p WHERE page_id % 11 = 0),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', '') AS host,
         regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*[?](.*)$', 1), '&'),
                   lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)'))) AS query
  FROM (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM records)),
named AS (SELECT *, host || path || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS canonical_url FROM parts),
found AS (
  SELECT v.record_id, v.canonical_url, v.sec, v.etag, v.modified, v.digest, r.record_id AS response_id,
         r.etag AS its_etag, r.modified AS its_modified, r.digest AS its_digest, r.size
  FROM (SELECT * FROM named WHERE kind = 'revisit') v
  LEFT JOIN (SELECT * FROM named WHERE kind = 'response') r ON r.canonical_url = v.canonical_url AND r.sec < v.sec
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.sec DESC NULLS LAST, r.record_id DESC) = 1),
judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'no_response' WHEN digest <> its_digest THEN 'mismatch'
                 WHEN etag IS NOT NULL AND its_etag IS NOT NULL
                 THEN CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(its_etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
                 WHEN modified IS NOT NULL AND its_modified IS NOT NULL THEN CASE WHEN modified = its_modified THEN 'resolved' ELSE 'mismatch' END
                 WHEN digest = its_digest THEN 'resolved' ELSE 'no_validator' END AS outcome
  FROM found)
SELECT record_id, canonical_url, response_id, outcome,
       CASE WHEN outcome = 'resolved' THEN concat('cache-control: max-age=120', chr(10), 'content-length: ', size, chr(10), 'content-type: text/html', chr(10),
            'date: ', sec, chr(10), 'etag: ', its_etag, chr(10), 'last-modified: ', its_modified) END AS headers
FROM judged"""



def mixing_to_targets() -> str:
    """Water-filling in closed form: in the order of limit by weight, the clamped sources come first."""
    return rf"""
    WITH sized AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}+')) AS BIGINT) AS size,
             md5(concat('{SEED}', ':', coalesce(CAST(doc_id AS VARCHAR), '-'), ':', coalesce(text, ''))) AS draw
      FROM documents),
    sources AS (
      SELECT source, CAST(sum(size) AS HUGEINT) AS words,
             CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(CYCLE)} AS HUGEINT) AS weight
      FROM sized GROUP BY source),
    pools AS (
      SELECT *, sum(words) OVER () - {MAX_EPOCHS} * coalesce(sum(words) OVER before, 0) AS free_words,
             sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free_weight
      FROM sources WINDOW before AS (ORDER BY words / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (
      SELECT free_words, free_weight FROM pools WHERE {MAX_EPOCHS} * words * free_weight >= weight * free_words
      ORDER BY words / weight, source NULLS LAST LIMIT 1),
    targets AS (
      SELECT source, CAST(words AS BIGINT) AS source_size,
             CASE WHEN {MAX_EPOCHS} * words * free_weight < weight * free_words THEN CAST({MAX_EPOCHS} * words AS DOUBLE)
                  ELSE CAST(weight * free_words AS DOUBLE) / CAST(free_weight AS DOUBLE) END AS target
      FROM sources, (SELECT max(free_words) AS free_words, max(free_weight) AS free_weight FROM level)),
    plan AS (
      SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM targets),
    ordered AS (
      SELECT d.*, p.source_size, p.target, p.whole, CAST(floor(p.target) AS BIGINT) - p.whole * p.source_size AS rest,
             sum(size) OVER (PARTITION BY d.source ORDER BY draw ROWS UNBOUNDED PRECEDING) - size AS before
      FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
    SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM ordered"""


CRC_TABLE = """
crc_steps AS (
  SELECT list(c ORDER BY b) AS steps FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) t(b)))"""


def _crc32(text: str) -> str:
    """SQL of the unsigned crc32 of a text's UTF-8 bytes; needs ``CRC_TABLE``'s ``steps`` in scope."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda k: CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"


def merkle_manifest(levels: int = 12) -> str:
    """Each level of the languages' trees and of the tree above them, written out; a tree that is done stays as it is."""

    def climb(name: str, start: str, tree: str) -> str:
        """CTEs name0 .. name<levels>: node digests by tree and place, and the paths of the lowest nodes."""
        out = [f"{name}0 AS ({start})"]
        for k in range(levels):
            out.append(
                f"{name}{k + 1} AS (SELECT {tree}, n // {FAN} AS n, CASE WHEN max(size) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY n)) END AS digest, "
                f"CAST(ceil(max(size) / {FAN}) AS BIGINT) AS size FROM {name}{k} GROUP BY {tree}, n // {FAN})"
            )
            out.append(
                f"{name}_others{k} AS (SELECT {tree}, n, CASE WHEN size = 1 THEN '' ELSE coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l, "
                f"CASE WHEN size = 1 THEN '' ELSE coalesce(string_agg(digest, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r, size "
                f"FROM {name}{k} WINDOW r AS (PARTITION BY {tree}, n // {FAN} ORDER BY n))"
            )
        return ",\n".join(out)

    def fold(source: str, name: str, tree: str, place: str) -> str:
        steps, now = [], source
        for k in range(levels):
            step = f"{source}_{k}"
            steps.append(
                f"{step} AS (SELECT t.* REPLACE (t.proof || o.l || o.r AS proof, CASE WHEN o.size = 1 THEN t.fold ELSE sha256(o.l || t.fold || o.r) END AS fold) "
                f"FROM {now} t JOIN {name}_others{k} o ON t.{tree} = o.{tree} AND t.{place} // {FAN**k} = o.n)"
            )
            now = step
        return ",\n".join(steps)

    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    last = levels - 1
    return f"""
    WITH {CRC_TABLE},
    leaves AS (
      SELECT doc_id, lang, leaf, CASE WHEN hit THEN changed ELSE leaf END AS fold, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS n, count(*) OVER (PARTITION BY lang) AS size
      FROM (SELECT doc_id, lang, sha256({head} || {field('text')}) AS leaf, sha256({head} || {field(lowered)}) AS changed,
                   coalesce({_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0, false) AS hit FROM documents, crc_steps)),
    {climb("t", "SELECT tree, n, leaf AS digest, size FROM leaves", "tree")},
    {climb("top", f"SELECT 0 AS one, tree AS n, digest, count(*) OVER () AS size FROM t{levels}", "one")},
    low AS (SELECT doc_id, tree, n, leaf, fold, '' AS proof, 0 AS one FROM leaves),
    {fold("low", "t", "tree", "n")},
    high AS (SELECT * FROM low_{last}),
    {fold("high", "top", "one", "tree")}
    SELECT h.doc_id, h.leaf, s.digest AS subroot, r.digest AS root, sha256(h.proof) AS proof_sha256, h.fold AS folded_root, h.fold = r.digest AS verified
    FROM high_{last} h JOIN t{levels} s USING (tree) CROSS JOIN top{levels} r"""


def spelling_variants() -> str:
    """Near words by their code points: words that agree but for one place, and words that lack one place of another."""
    lowered = "translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    WITH RECURSIVE {CRC_TABLE},
    found AS (
      SELECT name, w, count(*) AS n
      FROM (SELECT name, {lowered} AS w
            FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS name, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents))
      GROUP BY ALL),
    drawn AS (SELECT w, n, {_crc32("name || ':' || w")} AS h FROM found, crc_steps),
    words AS (
      SELECT word, CAST(sum(n) AS BIGINT) AS n
      FROM (SELECT n, CASE WHEN h % {DAMAGE_MOD} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM drawn)
      WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
    gaps AS (
      SELECT word, k, substr(word, 1, k) AS l, substr(word, k + 2) AS r FROM (SELECT word, unnest(range(length(word))) AS k FROM words)),
    near AS (
      SELECT a.word, b.word AS other FROM gaps a JOIN gaps b USING (k, l, r) WHERE a.word <> b.word
      UNION SELECT g.word, w.word FROM gaps g JOIN words w ON w.word = g.l || g.r
      UNION SELECT w.word, g.word FROM gaps g JOIN words w ON w.word = g.l || g.r),
    best AS (
      SELECT near.word, count(*) AS n_near, arg_min(other, (-w.n, other)) AS other, max(w.n) AS other_n
      FROM near JOIN words w ON w.word = near.other GROUP BY near.word),
    forms AS (
      SELECT w.word, CASE WHEN other_n >= {FORM_FACTOR} * n THEN other END AS form, n, coalesce(n_near, 0) AS n_near,
             CASE WHEN other_n >= {FORM_FACTOR} * n THEN other_n END AS form_n
      FROM words w LEFT JOIN best b USING (word)),
    steps AS (
      SELECT word, word AS at FROM forms
      UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.at WHERE f.form IS NOT NULL)
    SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n
    FROM forms f JOIN steps s ON s.word = f.word JOIN forms e ON e.word = s.at AND e.form IS NULL"""


ORACLE = {
    "op1_quality_rules": quality_rules(),
    "op6_revisits": REVISITS,
    "op11_spelling_variants": spelling_variants(),
    "op12_mixing": mixing_to_targets(),
    "op13_manifest": merkle_manifest(),
}
