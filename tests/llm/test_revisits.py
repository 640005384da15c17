from amperline.llm import revisits

SCHEMA = "record_id long, url string, at long, kind string, etag string, modified string, digest string, headers map<string,string>, payload string, block int"


def row(i, url, at, kind, etag=None, modified=None, digest=None, headers=None, payload=None):
    return (i, url, at, kind, etag, modified, digest, headers, payload, 1)


FULL = {"content-length": "9", "content-type": "text/html", "cache-control": "a", "etag": '"1"'}
RECORDS = [
    row(1, "http://www.A.example:80/p/?b=2&a=1&utm_source=x#f", 1000, "response", '"1"', "m", "d1", FULL, "one"),
    row(2, "https://a.example/p?a=1&b=2", 1500, "revisit", 'W/"1"', None, None, {"content-length": "0", "cache-control": "b", "date": "z"}),
    row(3, "https://a.example/p?a=1&b=2", 1000, "revisit", '"1"'),  # not later
    row(4, "https://a.example/p?a=1&b=2", 900_000, "revisit", None, "m"),  # blocks later
    row(5, "a.example/p?a=1&b=2", 900_001, "response", '"2"', None, "d2", None, "two"),
    row(6, "a.example/p?a=1&b=2", 900_002, "revisit", '"1"'),
    row(7, "a.example/p?a=1&b=2", 900_003, "revisit", None, None, "d2"),
    row(8, "a.example/p?a=1&b=2", 900_004, "revisit", None, "m"),
    row(9, "other", 5, "revisit", '"1"'),
    row(10, None, 5, "revisit", '"1"'),
    row(11, "a.example/p?a=1&b=2", None, "revisit", '"1"'),
    row(12, "a.example/p?a=1&b=2", 900_001, "response", '"3"', None, "d3", {}, "three"),  # ties: the larger id
    row(2, "https://a.example/p?a=1&b=2", 1500, "revisit", 'W/"1"', None, None, {"content-length": "0", "cache-control": "b", "date": "z"}),
]


def test_outcomes(spark):
    found = revisits.resolve(spark.createDataFrame(RECORDS, SCHEMA)).collect()
    assert sorted(r.record_id for r in found) == [2, 2, 3, 4, 6, 7, 8, 9, 10, 11]
    got = {r.record_id: (r.response_id, r.outcome) for r in found}
    assert got == {
        2: (1, "resolved"), 3: (None, "no_response"), 4: (1, "resolved"), 6: (12, "mismatch"), 7: (12, "mismatch"),
        8: (12, "no_validator"), 9: (None, "no_response"), 10: (None, "no_response"), 11: (None, "no_response"),
    }
    headers = {r.record_id: r.headers for r in found}
    assert headers[2] == {"content-length": "9", "content-type": "text/html", "cache-control": "b", "etag": '"1"', "date": "z"}
    assert headers[4] == FULL and headers[6] is None


def test_full_records(spark):
    found = {r.record_id: r.payload for r in revisits.resolved_records(spark.createDataFrame(RECORDS, SCHEMA)).collect()}
    assert found == {2: "one", 4: "one"}


def test_empty_table(spark):
    assert revisits.resolve(spark.createDataFrame([], SCHEMA)).count() == 0


def test_header_names_have_no_case(spark):
    stored = {"Content-Length": "9", "Cache-Control": "a", "ETag": "1", "Vary": "x", "vary": "y"}
    update = {"content-length": "0", "CONNECTION": "close", "cache-control": "b", "etag": None}
    records = [row(1, "u", 5, "response", '"1"', headers=stored), row(2, "u", 6, "revisit", '"1"', headers=update)]
    (found,) = revisits.resolve(spark.createDataFrame(records, SCHEMA)).collect()
    assert found.headers == {"content-length": "9", "cache-control": "b", "etag": "", "vary": "x, y"}


def test_null_ids_and_repeated_responses(spark):
    records = [
        row(1, "u", 5, "response", '"1"', headers={"a": "1"}, payload="p"),
        row(1, "u", 5, "response", '"1"', headers={"a": "2"}, payload="q"),  # the larger headers count
        row(1, "v", 7, "response", '"1"', headers={"a": "3"}, payload="r"),  # another url under the same id
        row(None, "u", 6, "response", '"1"', headers={"a": "4"}),  # no answer
        row(None, "u", 8, "revisit", '"1"', headers={"b": "1"}),
        row(None, "u", 9, "revisit", '"1"', headers={"b": "2"}),
        row(None, "v", 9, "revisit", '"2"'),
    ]
    df = spark.createDataFrame(records, SCHEMA)
    found = sorted((r.canonical_url, r.response_id, r.outcome, str(r.headers)) for r in revisits.resolve(df).collect())
    assert found == [
        ("u", 1, "resolved", "{'a': '2', 'b': '1'}"),
        ("u", 1, "resolved", "{'a': '2', 'b': '2'}"),
        ("v", 1, "mismatch", "None"),
    ]
    assert sorted((r.at, r.url, r.payload) for r in revisits.resolved_records(df).collect()) == [(8, "u", "q"), (9, "u", "q")]
