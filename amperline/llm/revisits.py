"""Resolve not-modified revisit records of web archives.

A crawler that is told "not modified" stores a revisit record without content.  It stands for the latest full response to
the same canonical URL that was captured before it: an as-of join.  No group of captures of one URL is sorted as a whole: captures
meet within blocks of time, and of earlier blocks only the latest response matters, a maximum that is combined before the
shuffle.

A revisit resolves if its validators agree with the response it found: its entity tag (compared weakly) where both have
one, or else its modification date, and its payload digest where both have one.  Its headers then update the stored ones,
except those that describe the stored content or one connection (``KEPT``).

Outcomes: ``resolved``, ``no_response`` (none before it), ``mismatch`` (validators disagree), ``no_validator`` (nothing to
compare).  Records without url or time resolve to nothing.  Of responses at the same time the one with the larger
record_id counts, of those with one time and id the one with the larger etag, modified, digest and headers; a response at
the revisit's own time is not earlier.  A response without record_id is no answer; a revisit without one resolves like any
other.  Repeated rows give repeated results.

Header names have no case: they are compared and given out in lower case.  Values of one name in several spellings are joined
by ", " in the order of the spellings; a null value is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amperline.llm.store import written

BLOCK_SECONDS = 3600
# Fields that RFC 9110 and RFC 9111 keep from updates, as they describe the stored content or a connection.
KEPT = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)


def canonical_url(url: str) -> F.Column:
    """Host in lower case without scheme, "www." and default port, path without a trailing slash, and the query without
    tracking parameters, sorted; no fragment."""
    bare = f"regexp_replace(regexp_replace({url}, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    host = f"regexp_replace(regexp_replace(lower(regexp_extract({bare}, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', '')"
    path = f"regexp_replace(regexp_extract({bare}, '^[^/?]*([^?]*)', 1), '/+$', '')"
    query = f"regexp_extract({bare}, '^[^?]*[?](.*)$', 1)"
    kept = f"array_sort(filter(split({query}, '&'), p -> p <> '' AND NOT p RLIKE '^(utm_[a-z]+|ref|gclid|fbclid)(=|$)'))"
    return F.expr(f"concat({host}, {path}, IF(size({kept}) > 0, concat('?', array_join({kept}, '&')), ''))")


def _weak(tag: str) -> str:
    return f"regexp_replace({tag}, '^W/', '')"


def _judged(records: DataFrame) -> DataFrame:
    """Per revisit its outcome, with the headers and url of its own and the id and time of the response."""
    own = F.when(F.col("kind") == "revisit", F.struct("url", "headers")).alias("own")
    rows = records.select("record_id", canonical_url("url").alias("canonical_url"), "at", "kind", "etag", "modified", "digest", own, F.expr(f"at DIV {BLOCK_SECONDS}").alias("block"))
    rows = written(rows, "captures")
    response = F.when((F.col("kind") == "response") & F.col("at").isNotNull() & F.col("record_id").isNotNull(), F.struct("at", "record_id", "etag", "modified", "digest"))
    # All responses of the same time count for none of that time: the frame ends before it.
    within = Window.partitionBy("canonical_url", "block").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    here = rows.withColumn("here", F.max(response).over(within)).where("kind = 'revisit'")
    blocks = rows.where("kind = 'response' AND at IS NOT NULL AND canonical_url IS NOT NULL").groupBy("canonical_url", "block").agg(F.max(response).alias("last"))
    wanted = here.where("here IS NULL AND block IS NOT NULL AND canonical_url IS NOT NULL").select("canonical_url", "block").distinct()
    # One row per URL and block that has a response or asks for one.
    steps = blocks.join(wanted.withColumn("asked", F.lit(True)), ["canonical_url", "block"], "full")
    before = Window.partitionBy("canonical_url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = written(steps.withColumn("carried", F.max("last").over(before)).where("asked AND carried IS NOT NULL").select("canonical_url", "block", "carried"), "carried")
    found = here.join(carried, ["canonical_url", "block"], "left").withColumn("r", F.coalesce("here", "carried"))
    same_tag = f"{_weak('etag')} = {_weak('r.etag')}"
    outcome = F.expr(f"""CASE WHEN r IS NULL THEN 'no_response'
        WHEN digest <> r.digest THEN 'mismatch'
        WHEN etag IS NOT NULL AND r.etag IS NOT NULL THEN IF({same_tag}, 'resolved', 'mismatch')
        WHEN modified IS NOT NULL AND r.modified IS NOT NULL THEN IF(modified = r.modified, 'resolved', 'mismatch')
        WHEN digest = r.digest THEN 'resolved' ELSE 'no_validator' END""")
    return found.select("record_id", "canonical_url", "at", "own", F.expr("r.record_id AS response_id"), F.expr("r.at AS response_at"), outcome.alias("outcome"))


def _one_case(entries: str) -> str:
    """A map with lower-case names from sorted header entries."""
    names = f"array_distinct(transform({entries}, e -> lower(e.key)))"
    return f"map_from_arrays({names}, transform({names}, n -> array_join(transform(filter({entries}, e -> lower(e.key) = n), e -> coalesce(e.value, '')), ', ')))"


def _with_answer(judged: DataFrame, records: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The resolved revisits with merged ``headers`` and the response's columns ``extra``; a response with very many revisits is
    split by the join's skew handling."""
    sorted_entries = "array_sort(map_entries(coalesce({}, map())))".format
    key = [canonical_url("url").alias("canonical_url"), F.col("record_id").alias("response_id"), F.col("at").alias("response_at")]
    answer = F.struct("etag", "modified", "digest", F.expr(sorted_entries("headers")).alias("stored"), *extra)
    stored = records.where("kind = 'response'").select(*key, answer.alias("answer")).groupBy("canonical_url", "response_id", "response_at").agg(F.max("answer").alias("answer"))
    done = judged.where("outcome = 'resolved'").join(stored, ["canonical_url", "response_id", "response_at"])
    done = done.withColumn("stored", F.expr(_one_case("answer.stored"))).withColumn("update", F.expr(_one_case(sorted_entries("own.headers"))))
    names = ", ".join(f"'{n}'" for n in KEPT)
    done = done.withColumn("update", F.expr(f"map_filter(update, (k, v) -> NOT array_contains(array({names}), k))"))
    return done.withColumn("headers", F.expr("map_concat(map_filter(stored, (k, v) -> NOT map_contains_key(update, k)), update)"))


def resolve(records: DataFrame) -> DataFrame:
    """Outcome of every revisit of ``records``: record_id, url, at (seconds), kind ('response' or 'revisit'), etag, modified, digest, headers.

    Returns record_id, canonical_url, response_id, outcome, headers (merged, null if not resolved).
    """
    judged = _judged(records)
    columns = ["record_id", "canonical_url", "response_id", "outcome", "headers"]
    rest = judged.where("outcome <> 'resolved'").withColumn("headers", F.lit(None).cast("map<string,string>"))
    return _with_answer(judged, records).select(columns).unionByName(rest.select(columns))


def resolved_records(records: DataFrame) -> DataFrame:
    """The revisits that resolve as full records: own id, url and time, merged headers, and the response's ``payload``."""
    return _with_answer(_judged(records), records, ("payload",)).select("record_id", "response_id", "own.url", "at", "headers", "answer.payload")


def captures(pages: DataFrame) -> DataFrame:
    """Capture records derived from ``pages``: each page is a full response; some are visited again in other spellings of
    the url, some before they were captured, some with validators that no longer agree.
    """
    at = "1700000000 + (page_id * 7919) % 2592000"
    tag = "concat('\"', md5(coalesce(html, '')), '\"')"
    headers = """map('content-type', 'text/html', 'content-length', CAST(octet_length(coalesce(html, '')) AS STRING), 'cache-control', 'max-age=60',
        'etag', {tag}, 'last-modified', CAST({at} - 86400 AS STRING), 'date', CAST({at} AS STRING))""".format(tag=tag, at=at)
    again = "map('Content-Length', '0', 'Connection', 'close', 'Cache-Control', 'max-age=120', 'date', CAST({when} AS STRING))".format
    kinds = [
        ("0", "TRUE", at, "url", "response", tag, f"CAST({at} - 86400 AS STRING)", "md5(coalesce(html, ''))", headers),
        ("1", "page_id % 2 = 0", f"{at} + 60", "concat(url, '#again')", "revisit", f"concat('W/', {tag})", "NULL", "NULL", again(when=f"{at} + 60")),
        ("2", "page_id % 3 = 0", f"{at} + 90000", "url", "revisit", "NULL", f"CAST({at} - 86400 AS STRING)", "md5(coalesce(html, ''))", again(when=f"{at} + 90000")),
        ("3", "page_id % 5 = 0", f"{at} - 30", "url", "revisit", tag, "NULL", "NULL", again(when=f"{at} - 30")),
        ("4", "page_id % 7 = 0", f"{at} + 7200", "url", "revisit", "'\"other\"'", "NULL", "NULL", again(when=f"{at} + 7200")),
        ("5", "page_id % 11 = 0", f"{at} + 10", "url", "revisit", "NULL", "NULL", "NULL", again(when=f"{at} + 10")),
    ]
    made = ", ".join(
        f"IF({when}, named_struct('record_id', page_id * 8 + {n}, 'url', {url}, 'at', CAST({time} AS BIGINT), 'kind', '{kind}', 'etag', CAST({etag} AS STRING),"
        f" 'modified', CAST({modified} AS STRING), 'digest', CAST({digest} AS STRING), 'headers', {fields}), NULL)"
        for n, when, time, url, kind, etag, modified, digest, fields in kinds
    )
    return pages.select(F.explode(F.expr(f"filter(array({made}), x -> x IS NOT NULL)")).alias("x")).select("x.*")
