"""Record ids of revisits that repeat or are null."""

from cohortlens.llm import revisits

SCHEMA = "record_id long, url string, at long, kind string, etag string, last_modified string, digest string, length long, headers map<string,string>"


def test_revisits_with_null_and_repeated_ids(spark):
    def record(i, url, at, kind, length=None):
        return (i, url, at, kind, "e", None, None, length, None)

    rows = [record(1, "http://k/", 1, "response", 4)] * 3 + [record(2, "http://k/", 2, "revisit")] * 3
    rows += [record(3, "http://n/", 1, "response", 5), record(None, "http://n/", 2, "response", 6), record(None, "http://n/", 3, "revisit")]
    got = sorted((r.url, r.record_id, r.outcome, r.response_id, r.length) for r in revisits.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("k", 2, "resolved", 1, 4)] * 3 + [("n", None, "resolved", None, 6)]
