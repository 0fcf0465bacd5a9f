import hashlib
import re

import pytest

from chatscope.llm import host_rules, syncmers, url_filter, warc
from tests.conftest import SF_ORACLE, SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------ host rules
def plain_stats(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(inside), len(lines))


@pytest.mark.parametrize("text", [
    None, "", " \n ", "a", "a a a a", "a b c a b c", "x y z x y", "a b\na b\n\na b \n", "é#$ ü|<>\x1c\x85 b", "a\x0bb\x0cc\rd",
    "1 2 3 4 1 2 3 9 9 9 9 9"])
def test_text_stats(text):
    assert host_rules.text_stats(text) == plain_stats(text)


def test_stats_of_documents(spark):
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).collect():
        if len(r.text) < 8000:
            assert host_rules.text_stats(r.text) == plain_stats(r.text)


def test_host_verdicts_and_odd_rows(spark, odd_docs, no_docs):
    good, bad = "w%d " * 60 % tuple(range(60)), "too short"
    rows = [(i, bad if i % 10 else good, "bad.host") for i in range(100)]
    rows += [(100 + i, good if i % 10 else bad, "good.host") for i in range(100)]
    rows += [(300, bad, "tiny.host"), (301, good, "tiny.host"), (302, good, None), (303, good, "lone.host")]
    got = {r.doc_id: r for r in host_rules.judge(spark.createDataFrame(rows, "doc_id int, text string, source string")).collect()}
    assert len(got) == len(rows)
    for i, text, host in rows:
        r = got[i]
        assert r.base_failed == (text == bad)
        assert r.kept == (text == good and host != "bad.host"), (i, host, r.shrunk_rate)
    assert got[302].shrunk_rate is None and 0 < got[303].shrunk_rate < 0.5  # shrunk towards the prior
    odd = host_rules.judge(odd_docs).collect()
    assert sorted(repr(r.doc_id) for r in odd) == sorted(repr(r.doc_id) for r in odd_docs.collect())
    assert all(r.kept is not None for r in odd)
    assert host_rules.judge(no_docs).collect() == []


# ------------------------------------------------------------------ URL filter
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.b", "", "block"), (None, "/", "block")]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):]).group()


def plain_verdict(url, listed):
    host, path = plain_parts(url)
    fits = [(h.lower() + p, a) for h, p, a in RULES if h is not None
            and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    if host and fits:
        rule, action = max(fits, key=lambda x: len(x[0]))
        return host, path, rule, action
    return host, path, None, "block" if host and url in listed else "allow"


URLS = [None, "", "no scheme/net/", "http://x.net", "http://X.NET/", "https://example.net/en/1", "http://notexample.net/en/1",
        "http://a.example.net/en", "ftp://q.example.com/de/x?y#z", "http://example.com.evil.io/de/", "x://org/fr/1", "http://a.b",
        "http://c.a.b?x=/net/", "http://net/", "http://h.io/p?b=2&a=1&utm_source=q", "http://www.h.io/p/?a=1&b=2#f", "http://h.io/q",
        "http://u@h.io:80/p", "http://ÀÉ.net/é", "http://é.io/a\nb", "http:///path", "a://b://c.net/x"]


@pytest.mark.parametrize("small", [url_filter.BROADCAST_BYTES, 0])
def test_urls_against_plain_rules(spark, small):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS * 2)], "page_id int, url string, host string, rule string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    listed = ["http://h.io/p/?b=2&a=1", "http://u@h.io:80/p", None, "http:///path"]
    got = url_filter.judge_urls(pages, spark.createDataFrame([(u,) for u in listed], "url string"), rules, broadcast_bytes=small)
    same = {"http://h.io/p?b=2&a=1&utm_source=q", "http://www.h.io/p/?a=1&b=2#f", "http://u@h.io:80/p"}
    rows = got.collect()
    assert len(rows) == 2 * len(URLS)
    assert {r.page_id: tuple(r)[1:] for r in rows} == {i: plain_verdict(u, same) for i, u in enumerate(URLS * 2)}
    none = url_filter.judge_urls(pages.limit(0), None, rules)
    assert none.collect() == [] and none.columns == ["page_id", "host", "path", "rule", "verdict"]
    free = url_filter.judge_urls(pages, spark.createDataFrame([], "url string"), None)
    assert {r.verdict for r in free.collect()} == {"allow"}


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) AS key")
    n = 5000 * url_filter.BITS_PER_KEY // 256
    bloom = url_filter.blocked_bloom(keys, n)
    assert url_filter.may_contain(keys, bloom, n, True).count() == 5000
    others = spark.range(20000).selectExpr("concat('other', id) AS key")
    assert url_filter.may_contain(others, bloom, n, False).count() < 0.02 * 20000


# ------------------------------------------------------------------ WARC
def test_warc_round_trip(spark, tmp_path):
    big = "é" + "x" * 1500 + "\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n"
    rows = [(1, "http://a/\r\nb", big), (2, None, big), (3, "u", big + "z"), (None, "n", big), (4, "s", "short"), (5, "s", "short"),
            (6, "e", None), (2, None, big), (7, "x", "")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.round_trip(pages, f"{tmp_path}/w").collect()
    want = []
    for p, _, h in rows:
        raw = (h or "").encode()
        again = h == big and p != 2
        want.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", 2 if again else None))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    full = warc.read_warc(spark, f"{tmp_path}/w").where("record_id = '<urn:page:1>'").first()
    assert full.target_uri == "http://a/%0D%0Ab" and full.headers["warc-type"] == "revisit" and full.payload == b""
    one = warc.read_warc(spark, f"{tmp_path}/w", record_id=["<urn:page:3>"], payload=True).collect()
    assert [bytes(r.payload).decode() for r in one] == [big + "z"]
    with pytest.raises(ValueError, match="no header column"):
        warc.read_warc(spark, f"{tmp_path}/w", payload_size=["1"])
    none = warc.round_trip(pages.limit(0), f"{tmp_path}/none")
    assert none.collect() == []


def test_warc_pushdown_skips_blocks(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i}" * 300) for i in range(20)], "page_id long, url string, html string")
    warc.write_warc(pages, f"{tmp_path}/w", records_per_file=3)
    before = spark.conf.get(warc.PUSHDOWN_CONF, "false")
    spark.conf.set(warc.PUSHDOWN_CONF, "true")
    try:
        df = warc.read_warc(spark, f"{tmp_path}/w", partition_bytes=1).where(
            "target_uri = 'http://h/7' AND record_type = 'response' AND content_length > 10 AND length(payload) > 1")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "target_uri" not in plan.split("Filter")[1].split("\n")[0]  # the source has taken it
        assert [r.record_id for r in df.collect()] == ["<urn:page:7>"]
    finally:
        spark.conf.set(warc.PUSHDOWN_CONF, before)


def test_warc_parser_skips_unwanted_blocks_and_reports_damage(tmp_path):
    import gzip
    import io

    class Watched(io.BytesIO):
        taken = 0

        def readinto(self, b):
            n = super().readinto(b)
            self.taken += n
            return n

    rec = lambda kind, body: (f"WARC/1.0\r\nwarc-type: {kind}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n")
    data = rec("request", b"q" * 10**6) + rec("resource", b"payload") + rec("request", b"r" * 10**6)
    raw = Watched(data)
    got = list(warc.parse_records(io.BufferedReader(raw, 4096), "f", [warc.Test("record_type", "eq", "resource")], True))
    assert [r["payload"] for r in got] == [b"payload"] and raw.taken < 40_000
    packed = gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(data[:1_000_100]) + gzip.compress(data[1_000_100:])))
    assert len(list(warc.parse_records(io.BufferedReader(packed), "f", [], False))) == 3
    for broken in (data[:50], b"junk\r\n", b"WARC/1.0\r\nno colon\r\n\r\n", b"WARC/1.0\r\nWARC-Type: x\r\n\r\n",
                   rec("x", b"abc")[:-6]):
        with pytest.raises(ValueError, match="f at 0"):
            list(warc.parse_records(io.BufferedReader(io.BytesIO(broken)), "f", [], True))


# ------------------------------------------------------------------ fingerprints
def edits(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1]))
    for (d, t), (_, n) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        yield d, t, t[:len(t) - half] + n[:half], n


def test_edit_query_against_brute_force(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for df in (docs, odd_docs):
        rows = [(r.doc_id, r.text or "") for r in df.collect()]
        got = syncmers.edit_with_next(df).collect()
        want = [(d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in edits(rows)]
        assert sorted(repr((r.doc_id, r.n_chars, r.edited_sha256)) for r in got) == sorted(map(repr, want))
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
        for r in got:  # likeness from the fingerprints themselves
            a = {r.fingerprint[i:i + 8] for i in range(0, len(r.fingerprint), 8)}
            b = {r.edited_fingerprint[i:i + 8] for i in range(0, len(r.edited_fingerprint), 8)}
            assert r.near_edited == pytest.approx(2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0)
    assert syncmers.edit_with_next(no_docs).collect() == []
    one = syncmers.edit_with_next(spark.createDataFrame([(1, "abcd")], "doc_id int, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one[0].near_next == 1.0


def test_near_next_equals_pairwise_likeness(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in syncmers.edit_with_next(docs).collect()}
    order = sorted(got)
    for a, b in zip(order, order[1:] + order[:1], strict=True):
        x, y = ({got[i].fingerprint[k:k + 8] for k in range(0, len(got[i].fingerprint), 8)} for i in (a, b))
        assert got[a].near_next == pytest.approx(2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0)
    long = [r for r in got.values() if r.n_chars > 500]
    assert sum(r.near_edited > 0.3 for r in long) >= 0.95 * len(long)


def test_anchors_are_closed_syncmers_and_context_free(spark):
    words = [f"w{i * 7919 % 61}" for i in range(200)]
    df = spark.createDataFrame([(0, " ".join(words)), (1, "x y z " + " ".join(words[50:150]) + " q r"), (2, "one"), (3, "")],
                               "doc_id int, text string")
    k, s = syncmers.K, syncmers.S
    got = {r.doc_id: r.anchors for r in syncmers.fingerprints(df).collect()}
    h = {r.w: r.h for r in spark.createDataFrame([(w,) for w in set(words)], "w string").selectExpr("w", "xxhash64(w) AS h").collect()}
    seq = [0] * (k - 1) + [h[w] for w in words] + [0] * (k - 1)
    runs = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(seq, seq[1:], strict=False))], "i int, a long, b long")
    run = [r.h for r in runs.selectExpr("i", "xxhash64(a, b) AS h").orderBy("i").collect()]
    inner = k - s + 1
    want = [i - (k - 1) for i in range(len(run) - inner + 1)
            if min(run[i], run[i + inner - 1]) == min(run[i:i + inner])]
    assert [a.pos for a in got[0]] == want
    inside = {a.hash for a in got[0] if 50 <= a.pos <= 150 - k}
    assert inside <= {a.hash for a in got[1]}  # the same passage elsewhere has the same anchors
    shift = {(p.left - p.right) for r in syncmers.fingerprints(df).alias("a").join(
        syncmers.fingerprints(df).alias("b")).where("a.doc_id = 0 AND b.doc_id = 1").select(
        syncmers.match_positions(syncmers.F.col("a.anchors"), syncmers.F.col("b.anchors")).alias("m")).collect() for p in r.m}
    assert 47 in shift
    assert got[2] and not got[3]


def test_texts_without_white_space_share_anchors(spark):
    chinese = "".join(chr(0x4E00 + i * 7919 % 5000) for i in range(300))
    astral = "".join(chr(0x1F300 + i * 31 % 250) for i in range(120))
    code = "".join(f"f{i}(x{i * 37 % 101});" for i in range(60))
    rows = [(0, chinese), (1, "ab"), (2, code), (3, "ab"), (4, astral), (5, "ab"), (6, "\u00a0".join(["one", "line"] * 40)), (7, "ab")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: r for r in syncmers.edit_with_next(df).collect()}
    assert all(got[i].near_edited > 0.3 for i in (0, 2, 4, 6))  # the edit keeps the first half
    prints = syncmers.fingerprints(spark.createDataFrame([(0, chinese), (1, "x " + chinese[100:200] + " y")], "doc_id int, text string"))
    a, b = ({x.hash for x in r.anchors} for r in prints.orderBy("doc_id").collect())
    assert len(a & b) > 20
    words = {r.t: r.w for r in spark.createDataFrame([("a" * 20 + " b",), ("c " + "d" * 21,), (astral[:21],), ("",), (None,)], "t string").select(
        "t", syncmers.words_of(syncmers.F.col("t")).alias("w")).collect()}
    assert words == {"a" * 20 + " b": ["a" * 20, "b"], "c " + "d" * 21: ["c", *"d" * 21], astral[:21]: list(astral[:21]), "": [], None: None}
