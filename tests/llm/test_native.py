"""URL reputation, source mixing and archives: edge cases, and the SQL of the queries."""

import hashlib
import os

import duckdb
import pytest

from tableferry.llm import mixing, queries, reputation, warc

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        db.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    want = db.sql(queries.ORACLES[name])
    order = sorted(want.columns)
    got = queries.registry()[name](spark, SF_DIR).select(*order).collect()
    mine = sorted(map(repr, map(tuple, got)))
    assert mine == sorted(map(repr, want.select(*order).fetchall()))


def test_hosts_paths_and_rules(spark, rows):
    urls = [
        ("HTTP://WWW.Example.ORG/en/1?x", "www.example.org", "/en/1", "example.org/en/1", "block"),
        ("http://example.org/es/a#f", "example.org", "/es/a", "example.org/es/", "block"),
        ("http://a.org/x://y", "a.org", "/x://y", "org/", "allow"),
        ("http://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"),
        ("http://a.com/fr", "a.com", "/fr", None, None),
        ("http://a.org", "a.org", "", None, None),
        ("http://Ä.com/de/1\n2?q", "Ä.com", "/de/1\n2", "com/de/", "block"),
        ("no scheme", "", "", None, None),
        ("://", "", "", None, None),
        (None, "", "", None, None),
    ]
    pages = spark.createDataFrame([(i, u[0], 1) for i, u in enumerate(urls)], "page_id bigint, url string, host int")
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (3, None)], "page_id bigint, good int")
    got = {r.page_id: r for r in reputation.judge_urls(pages, labels).collect()}
    assert len(got) == len(urls)
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert verdict in (None, got[i].verdict) and got[i].verdict in ("allow", "block")
    assert not reputation.judge_urls(pages.limit(0), labels).take(1)
    assert reputation.judge_urls(pages, labels.limit(0)).count() == len(urls)


def test_one_outcome_for_each_host(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.net/") for i in range(4)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(3)], "page_id bigint, good int")
    got = reputation.judge_urls(pages, labels).collect()
    assert len(got) == 4 and all(0 < r.bound + 1 < 2 for r in got)


def test_reputation_shrinks_towards_the_domain(spark):
    pages = [(i, f"http://{'good' if i < 60 else 'bad'}.site.net/") for i in range(120)] + [(200, "http://new.site.net/")]
    pages = spark.createDataFrame(pages, "page_id bigint, url string")
    labels = spark.createDataFrame([(i, int(i < 58)) for i in range(120)], "page_id bigint, good int")
    host, _ = reputation.host_and_path(pages.url)
    known = {r.host: r for r in reputation.host_reputation(pages.select("page_id", host.alias("host")), labels).collect()}
    assert known["good.site.net"].bound > 0.8 > 0.2 > known["bad.site.net"].mean
    assert known["bad.site.net"].mean < known["new.site.net"].mean < known["good.site.net"].mean
    assert known["new.site.net"].n == 0


def test_mix_of_odd_documents(spark, documents):
    rows = [(i, "w " * (50 + i), None, "abc"[i % 3]) for i in range(60)] + [
        (100, None, None, "a"), (101, " \t\x0b", None, None), (102, "x", None, None), (102, "x", None, None), (None, "y z", None, ""),
    ]
    got = mixing.mix_report(spark, documents(rows), shard_blocks=16)
    again = mixing.mix_report(spark, documents(rows[::-1]).repartition(3), shard_blocks=16)
    mine = sorted(map(repr, map(tuple, got.collect())))
    assert mine == sorted(map(repr, map(tuple, again.collect())))
    assert len(mine) == len(rows)
    by_source = {}
    for r in got.collect():
        assert 0 <= r.taken <= 3 * r.size
        by_source.setdefault(r.source, []).append(r)
    assert {s: by_source[s][0].source_size for s in ("", None)} == {"": 2, None: 2}
    # Two small sources stop at three times their size; the others share the rest 2:1 and 1 after the empty name.
    assert by_source[""][0].target == 6 and by_source[None][0].target == 6
    assert sum(rs[0].target for rs in by_source.values()) == pytest.approx(sum(rs[0].source_size for rs in by_source.values()))
    for s in "abc":
        assert sum(r.taken for r in by_source[s]) == pytest.approx(by_source[s][0].target, rel=0.2)
    assert not mixing.mix_report(spark, documents([])).take(1)
    assert [r.taken for r in mixing.mix_report(spark, documents([(1, "")])).collect()] == [0]


def test_mix_pieces_give_what_the_report_says(spark, documents):
    docs = documents([(i, "w " * (30 + 7 * i), None, f"s{i % 4}") for i in range(40)])
    taken = {}
    for r in mixing.mix_blocks(spark, docs).collect():
        assert r.words > 0 and r.first_word >= 0
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.words
    want = {r.doc_id: r.taken for r in mixing.mix_report(spark, docs).collect() if r.taken}
    assert taken == want


def test_archives_hold_every_page(spark, tmp_path):
    big, tricky = "<p>é</p>" * 200, "a\r\n\r\nWARC/1.1\r\n" * 90
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (3, None, tricky), (None, "u", tricky), (5, "u", None), (6, "u", ""),
            (7, "u", "short"), (8, "u", "short"), (2, "u", big), (None, "u", "n" * 1000), (None, "u", "n" * 1000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = sorted(map(tuple, warc.archived(spark, pages).select("page_id", "payload_bytes", "record_type", "refers_to").collect()), key=repr)
    want = [(1, 1800, "revisit", 2), (2, 1800, "response", None), (2, 1800, "response", None), (3, 1350, "response", None),
            (5, 0, "response", None), (6, 0, "response", None), (7, 5, "response", None), (8, 5, "response", None),
            (None, 1000, "response", None), (None, 1000, "response", None), (None, 1350, "revisit", 3)]
    assert got == sorted(want, key=repr)
    warc.write_archives(pages, str(tmp_path / "a"))
    back = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path / "a")).collect()}
    assert back[3].html == tricky and back[1].html is None and back[2].url in ("http://b/%20%20X:%20y", "u")
    assert not warc.archived(spark, pages.limit(0)).take(1)


def test_damaged_archive_is_an_error():
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parsed_records(record * 2)] == [b"abc"] * 2
    for bad in (record[:-1], b"x" + record, record.replace(b"3", b"4")):
        with pytest.raises((ValueError, KeyError)):
            list(warc.parsed_records(bad))


def test_archives_of_several_compressed_members(spark, tmp_path):
    import gzip

    payloads = {i: f"<p>{i}</p>".encode() * (i + 1) * 50 for i in range(5)}

    def record(i):
        body = payloads[i]
        block = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n%s" % (len(body), body)
        head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x:{i}>\r\nWARC-Payload-Digest: sha1:{hashlib.sha1(body).hexdigest()}"
        return f"{head}\r\nX-Page-Id: {i}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    members = [gzip.compress(record(i)) for i in range(5)]
    whole = b"".join(record(i) for i in range(5))
    for chunk in (1, 7, 1 << 20):
        assert warc.inflated(b"".join(members), chunk) == whole
    assert warc.inflated(b"") == b""
    with pytest.raises(ValueError, match="inside"):
        warc.inflated(b"".join(members)[:-3])
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.warc.gz").write_bytes(b"".join(members))
    back = {r.page_id: r.html for r in warc.read_archives(spark, str(tmp_path / "a")).collect()}
    assert back == {i: body.decode() for i, body in payloads.items()}
