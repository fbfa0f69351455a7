"""URLs, robots rules, frontier, failures; batch and stream."""

import random
import re

import pytest
from pyspark.sql import functions as F

from textloom.functions import urls as U
from textloom.operators import failures as O
from textloom.operators import links as L
from textloom.operators.frontier import crawl_frontier
from textloom.session import work_path
from textloom.streaming import failures as SF
from textloom.streaming import pages as SP

CANONICAL = {
    "HTTP://Example.COM": "http://example.com/",
    "http://e.com/a?b=2&a=1#x": "http://e.com/a?a=1&b=2",
    "http://e.com/a?b&a=": "http://e.com/a?a=&b=",
    "http://e.com/a?x=2&x=1": "http://e.com/a?x=1&x=2",
    "http://e.com/?q=a+b%20c": "http://e.com/?q=a+b+c",
    "http://e.com/?q=%7e*é": "http://e.com/?q=~%2A%C3%A9",
    "http://e.com/é b/%7Eu/%2f?": "http://e.com/%C3%A9%20b/~u/%2F",
    "http://e.com/50%/ü": "http://e.com/50%/%C3%BC",
    "http://e.com/a+b;c=(d)": "http://e.com/a+b;c=(d)",
    "http://e.com/a?": "http://e.com/a",
    "http://e.com?a=1": "http://e.com/?a=1",
    "http://e.com/caf%e9": "http://e.com/caf%E9",
    "http://e.com/caf%E8?q=%e9": "http://e.com/caf%E8?q=%E9",
    "http://e.com:/a": "http://e.com/a",
    "http://BÜCHER.de/a": "http://xn--bcher-kva.de/a",
    "http://xn--bcher-kva.de/a?": "http://xn--bcher-kva.de/a",
    "http://faß.de:81": "http://fass.de:81/",
    "http://例え。テスト/": "http://xn--r8jz45g.xn--zckzah/",
    "http://é..com/": "http://é..com/",
    "mailto:a@b#c": "mailto:a@b",
}


def test_canonical_url(spark):
    rows = spark.createDataFrame([(u,) for u in CANONICAL], "u string").coalesce(1)
    got = {r.u: r.c for r in rows.select("u", U.canonical_url(F.col("u")).alias("c")).collect()}
    assert got == CANONICAL


def test_hosts_in_other_scripts(spark):
    """As the interpreter's own codec of 2003 has them."""
    rng = random.Random(3)
    letters = "aé-ßÄñ中文テスト한국прияαβγ0"
    hosts = [
        ".".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(3))
        for _ in range(300)
    ] + ["", "é" * 62, "a" * 70 + ".é", "é."]
    want = {}
    for h in hosts:
        try:
            want[h] = h.lower().encode("idna").decode().lower()
        except UnicodeError:
            want[h] = h.lower()
    want |= {"é@é.com:80": "é@xn--9ca.com:80", "É:": "xn--9ca", "a@b.com:1": "a@b.com:1"}
    rows = spark.createDataFrame([(h,) for h in want], "h string").coalesce(1)
    url = F.concat(F.lit("http://"), F.col("h"), F.lit("/x"))
    got = {r.h: r.a for r in rows.select("h", U.ascii_authority(url).alias("a")).collect()}
    assert got == want


def test_rules_of_many_stars_end(spark):
    rules = [
        ("a.com", False, "/" + "*a" * 30 + "*b"), ("a.com", False, "/x*y*y$"),
        ("a.com", False, "/*.é*?z=$"), ("a.com", False, "/q**$"),
    ]
    paths = {
        "/" + "a" * 2000: True, "/" + "a" * 2000 + "b": False, "/" + "a" * 29 + "b": True,
        "/xy": True, "/xyy": False, "/xyyz": True, "/x1y2y3y": False, "/n.éa?z=": False, "/n.é?z=1": True,
        "/q": False, "/q/any": False,
    }
    left = spark.createDataFrame([(i, "http://a.com" + p) for i, p in enumerate(paths)], "id long, url string")
    left = left.unionAll(spark.range(100, 3100).selectExpr("id", "concat('http://a.com/', repeat('a', 2000))"))
    right = spark.createDataFrame(rules, "host string, allow boolean, pattern string")
    kept = {r.id for r in L.robots_admission(left, right, "id").collect()}
    assert {p: i in kept for i, p in enumerate(paths)} == paths
    assert len(kept - set(range(100))) == 3000


def test_admission(spark):
    urls = {
        "http://e/robots.txt": False, "http://e/x/sitemap.xml": False, "http://e/sfuser/1": False,
        "http://e/faq": False, "http://e/faq/": True, "http://e/faq?x": True,
        "http://e/a.PDF": False, "http://e/a.pdf?x=1": False, "http://e/a?x=b.pdf": True,
        "http://e/a.png": True, "http://e/" + "a" * 2083: False,
    }
    rows = spark.createDataFrame([(u,) for u in urls], "u string").coalesce(1)
    got = {r.u: r.a for r in rows.select("u", U.admitted(F.col("u")).alias("a")).collect()}
    assert got == urls


def test_domains(spark):
    urls = {
        "http://E.com/": True, "http://www.e.com:80/x": True, "http://u@e.com/": True,
        "http://notE.com/": False, "http://e.com.org/": False,
    }
    rows = spark.createDataFrame([(u,) for u in urls], "u string").coalesce(1)
    got = {
        r.u: r.a for r in rows.select("u", U.in_domains(F.col("u"), ["e.com"]).alias("a")).collect()
    }
    assert got == urls
    assert rows.where(U.in_domains(F.col("u"))).count() == len(urls)


def test_robots_equals_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    hosts = ["a.com", "b.com", "c.com"]
    rules = [
        (rng.choice(hosts[:2]), rng.random() < 0.5,
         "/" + "".join(rng.choice("xy*/") for _ in range(rng.randint(0, 4))) + rng.choice(["", "$"]))
        for _ in range(40)
    ] + [("a.com", False, "")]
    urls = [
        (i, f"http://{rng.choice(hosts)}/" + "".join(rng.choice("xy/?.") for _ in range(5)) + "#f")
        for i in range(200)
    ]

    def allowed(url):
        host, path = re.match(r"http://([^/]+)([^#]*)", url).groups()
        best = None
        for rule_host, allow, pattern in rules:
            if rule_host != host or not pattern:
                continue
            end = pattern.endswith("$")
            body = re.escape(pattern[:-1] if end else pattern).replace(r"\*", ".*")
            if re.match(body + ("$" if end else ""), path):
                best = max(best or (-1, False), (len(pattern), allow))
        return best is None or best[1]

    want = sorted(i for i, url in urls if allowed(url))
    left = spark.createDataFrame(urls, "id long, url string")
    right = spark.createDataFrame(rules, "host string, allow boolean, pattern string")
    assert sorted(r.id for r in L.robots_admission(left, right, "id").collect()) == want
    monkeypatch.setattr(L, "BROADCAST_HOSTS", 0)
    assert sorted(r.id for r in L.robots_admission(left, right, "id").collect()) == want
    assert 0 < len(want) < len(urls)


def test_frontier(spark):
    edges = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("a", "c"), ("c", "a"), ("c", "d"), ("x", "y")],
        "src string, dst string",
    )
    starts = spark.createDataFrame([("a",), ("a",)], "url string")

    def depths(**options):
        return {r.url: r.depth for r in crawl_frontier(starts, edges, **options).collect()}

    assert depths() == {"a": 0, "b": 1, "c": 1, "d": 2}
    assert depths(max_depth=1) == {"a": 0, "b": 1, "c": 1}
    assert depths(max_depth=0) == {"a": 0}


def test_levels_do_not_shuffle_edges(spark):
    from textloom.operators import frontier

    edges = spark.range(5000).select(F.col("id").alias("src"), (F.col("id") * 7 % 5000).alias("dst"))
    bucketed, table, _ = frontier._bucketed(edges)
    level = spark.range(40).select(F.col("id").alias("url"))
    met = level.hint("merge").join(bucketed, F.col("url") == F.col("src"))
    plan = met._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE {table}")
    edge_side = plan[plan.index("Sort [src"):]
    assert "Exchange" not in edge_side and "Bucketed: true" in edge_side


def test_levels_move_targets_only(spark):
    from textloom.operators import frontier

    edges = spark.range(5000).select(F.col("id").alias("src"), (F.col("id") * 7 % 5000).alias("dst"))
    edges, edge_table, buckets = frontier._bucketed(edges)
    folder, table = work_path(spark, "reached"), "reached_of_test"
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for depth, to in enumerate((10, 40)):
            level = spark.range(10 * depth, to).select(F.col("id").alias("url"))
            frontier._add_level(level.repartition(buckets, "url"), depth, table, folder, buckets)
        reached = spark.table(table)
        fresh = frontier._next_level(reached.where("depth = 1"), edges, reached, buckets)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        got = {r.url for r in fresh.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name in (table, edge_table):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert got == {i * 7 % 5000 for i in range(10, 40)} - set(range(40))
    # Every scan is bucketed, and what is exchanged are targets alone: once, and once more
    # where the session's shuffles have another number of partitions than there are buckets.
    assert plan.count("Bucketed: true") == 3
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert 1 <= len(moved) <= 2 and all("hashpartitioning(url" in line for line in moved)
    reached_side = plan[plan.rindex("Sort [url"):]
    assert "FileScan" in reached_side and "Exchange" not in reached_side
    level_side = plan[plan.rindex("Exchange"):plan.rindex("Sort [url")]
    assert level_side.count("FileScan") == 2


def test_frontier_leaves_nulls_out_and_drops_its_tables(spark):
    edges = spark.createDataFrame([("a", None), (None, "b"), ("a", "c")], "src string, dst string")
    starts = spark.createDataFrame([("a",), (None,)], "url string")
    before = {t.name for t in spark.catalog.listTables()}
    assert {(r.url, r.depth) for r in crawl_frontier(starts, edges).collect()} == {("a", 0), ("c", 1)}
    assert crawl_frontier(starts.limit(0), edges).count() == 0
    assert {t.name for t in spark.catalog.listTables()} == before


def test_status_classes(spark):
    codes = {
        200: "ok", 400: "ok", 401: "ok", 410: "ok", 301: "ok", 501: "ok", 403: "fail",
        404: "fail", 406: "fail", 500: "retry", 502: "retry", 503: "retry", 504: "retry",
        408: "retry", 429: "retry",
    }
    rows = spark.createDataFrame([(c,) for c in codes], "c int").coalesce(1)
    got = {r.c: r.o for r in rows.select("c", O.classify_status(F.col("c")).alias("o")).collect()}
    assert got == codes


def attempts():
    rng = random.Random(2)
    rows, i = [], 0
    for url in ["hot"] * 400 + [f"u{n}" for n in range(30) for _ in range(n % 14)]:
        often = [(503, None), (429, None), (None, "TimeoutError"), (500, None)] * 5
        status, exception = rng.choice([*often, (None, "ValueError"), (404, None), (200, None)])
        rows.append((i, url, status, exception))
        i += 1
    rng.shuffle(rows)
    return rows


def brute_force(rows):
    """First spent budget of each URL; any other outcome ends a row of retries."""
    turns, out = {}, {}
    for _, url, status, exception in sorted(rows):
        retry = status in (503, 429, 500) or exception == "TimeoutError"
        turns[url] = turns.get(url, 0) + 1 if retry else 0
        if turns[url] == 6:
            out.setdefault(url, exception or str(status))
    return set(out.items())


LOG = "fetch_id long, url string, status int, exception string"


def test_retry_budget_batch_and_stream(spark, tmp_path):
    rows = attempts()
    want = brute_force(rows)
    log = spark.createDataFrame(rows, LOG)
    batch = O.retry_exhausted(log)
    assert {tuple(r) for r in batch.collect()} == want and len(want) > 3
    at_once = {(url, str(status)) for _, url, status, _ in rows if status == 404}
    assert {tuple(r) for r in O.failed_urls(log).collect()} == want | at_once

    # The same attempts over several micro-batches, with a restart in between.
    rows.sort()
    source, out = str(tmp_path / "log"), str(tmp_path / "out")
    for part in (rows[:150], rows[150:151], rows[151:]):
        frame = spark.createDataFrame(part, LOG)
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(source)
        SP.write_stream(
            SF.all_failures_stream(stream), out, str(tmp_path / "ckpt"),
            ["failed_url", "error_code"], "parquet",
        ).awaitTermination()
    got = spark.read.parquet(out).select("failed_url", "error_code").collect()
    assert sorted(map(tuple, got)) == sorted(want | at_once)


@pytest.mark.parametrize("size", [1, 3, 7, 50, 10_000])
def test_turns_do_not_depend_on_slices(spark, size):
    """A URL's attempts are counted in slices of the log, of whatever size."""
    log = spark.createDataFrame(attempts(), LOG)
    turned = O.with_turns(log, F.floor(F.col("fetch_id") / size))
    got = {r.fetch_id: r.turn for r in turned.collect() if r.outcome == "retry"}
    turns, want = {}, {}
    for i, url, status, exception in sorted(attempts()):
        retry = status in (503, 429, 500) or exception == "TimeoutError"
        turns[url] = turns.get(url, 0) + 1 if retry else 0
        if retry:
            want[i] = turns[url]
    assert got == want


def test_a_success_ends_a_row_of_retries(spark):
    rows = [(i, "u", 200 if i == 3 else 503, None) for i in range(7)]
    assert O.retry_exhausted(spark.createDataFrame(rows, LOG)).count() == 0


def test_dedup_stream_resumes(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    seen = spark.createDataFrame([("old",)], "url string")
    for part in (["a", "b", "a", "old"], ["b", "c"], ["a", "old", "d"]):
        spark.createDataFrame([(u,) for u in part], "url string").coalesce(1).write.mode(
            "append"
        ).parquet(source)
        stream = spark.readStream.schema("url string").parquet(source)
        SP.write_stream(
            SP.new_urls_stream(stream, seen), out, str(tmp_path / "ckpt"), ["url"], "json"
        ).awaitTermination()
    urls = [r.url for r in spark.read.schema("url string").json(out).collect()]
    assert sorted(urls) == ["a", "b", "c", "d"]


def test_bounded_dedup_keeps_late_rows(spark, tmp_path):
    """A URL never seen before passes, however old its own time is."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (["a"], ["c"], ["b", "a"]):
        spark.createDataFrame([(u,) for u in part], "url string").coalesce(1).write.mode(
            "append"
        ).parquet(source)
        stream = spark.readStream.schema("url string").parquet(source)
        once = SP.dedup_stream(stream, keep_for="1 day")
        SP.write_stream(once, out, str(tmp_path / "ckpt"), ["url"]).awaitTermination()
    urls = [r.url for r in spark.read.schema("url string").json(out).collect()]
    assert sorted(urls) == ["a", "b", "c"]


def test_long_robots_rules_hold(spark):
    long = "/" + "a" * 2500
    urls = spark.createDataFrame([(1, "http://e" + long), (2, "http://e/b")], "id int, url string")
    rules = spark.createDataFrame([("e", False, long)], "host string, allow boolean, pattern string")
    assert [r.id for r in L.robots_admission(urls, rules, "id").collect()] == [2]


def test_work_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from textloom import session

    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *a: None),
        sparkContext=SimpleNamespace(
            master="local-cluster[2,1,1024]", applicationId="x",
            _jsc=SimpleNamespace(
                sc=lambda: SimpleNamespace(
                    getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False)
                )
            ),
        ),
    )
    with pytest.raises(ValueError):
        session.work_root(cluster)
    written = session.stash(spark.range(3), "to-clear")
    assert session.bytes_of(written) > 0 and written.count() == 3
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    monkeypatch.setattr("textloom.session.F.broadcast", lambda df: pytest.fail("broadcast"))
    session.small_or_shuffled(spark.range(3), "large-by-bytes", 100)


def test_a_new_checkpoint_appends(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a",)], "url string").write.parquet(source)
    for name in ("one", "two"):
        stream = spark.readStream.schema("url string").parquet(source)
        SP.write_stream(stream, out, str(tmp_path / name), ["url"]).awaitTermination()
    assert [r.url for r in spark.read.schema("url string").json(out).collect()] == ["a", "a"]


def test_first_seen_limits_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("url"), F.col("id").alias("at"))
    first = L.first_seen(rows, "url", F.col("at"))
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(tuple(r) for r in first.collect()) == [(i, i) for i in range(7)]


def test_work_path_is_fresh(spark):
    assert work_path(spark, "x") != work_path(spark, "x")
