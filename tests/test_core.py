"""Operators against DuckDB on the driver's tables, and the cases that its data does not have."""

import io
import json
import math
import zipfile
from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from signalweave import plans
from signalweave.functions import dates, numbers, spans, text
from signalweave.operators import cells, context, gates, greedy, joins, provenance, reviews, scoring, select, series, similarity

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(float(f"{v:.11g}"))
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    return repr(v)


#: Queries that no SQL states, and the tests that compare what they call with plain loops or single cases.
TESTED = {
    "html_article_bodies": "test_pages_and_feeds", "html_listing_rows": "test_pages_and_feeds", "html_visible_text": "test_pages_and_feeds",
    "nearest_term_span": "test_spans", "table_digest": "test_provenance", "text_chunks": "test_chunks_by_offsets",
}


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted("|".join(norm(r[c]) for c in cols) for r in df.collect())
    if name not in plans.SQL:
        assert callable(globals().get(TESTED[name])), "neither SQL nor a test of its own"
        return
    rel = duck.execute(plans.SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = sorted("|".join(norm(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert got == want


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_numbers(spark):
    s = lambda x: F.lit(x).cast("string")
    assert tuple(one(spark, numbers.safe_number(s("1,234.5")), numbers.safe_number(s("n/a")), numbers.safe_number(s(None)), numbers.strict_number(s("x")))) == (1234.5, 0.0, 0.0, None)
    assert tuple(one(spark, numbers.code(s(" 123.0 ")), numbers.code(s("12.05")))) == ("123", "12.05")
    v = lambda x: F.lit(x).cast("double")
    assert tuple(one(spark, numbers.change_fraction(v(1), v(-2)), numbers.change_signed(v(1), v(-2)), numbers.change_percent(v(3), v(2)), numbers.change_fraction(v(1), v(0)), numbers.ratio(v(1), v(0)), numbers.share_or_zero(v(1), v(0)))) == (None, -1.5, 50.0, None, None, 0.0)


def test_exclusive_quartile_is_not_the_inclusive_one(spark):
    from statistics import quantiles

    for values in ([1, 2, 3, 4, 5, 6, 7], [5.0, 1.0], [3, 3, 3, 9], list(range(1, 30))):
        df = spark.createDataFrame([(float(v),) for v in [*values, 0, -3]], "v double")
        assert cells.exclusive_quartile(df, "v").first()["floor"] == pytest.approx(quantiles(values, n=4)[0])
    assert cells.exclusive_quartile(spark.createDataFrame([(1.0,)], "v double"), "v").first()["floor"] is None


def test_matched_cells_need_both_sides_of_both_sources(spark):
    rows = [("a", 1, "sales", 5), ("a", 1, "stores", 1), ("a", 2, "sales", 7), ("a", 2, "stores", 2), ("b", 1, "sales", 1), ("b", 2, "sales", 1), ("b", 2, "stores", 1), ("c", 2, "sales", 1)]
    df = spark.createDataFrame(rows, "k string, p int, src string, v int")
    got = cells.matched_cells(df, ["k"], "p", 2, 1, {"v": F.sum("v")}, [F.col("src") == "sales", F.col("src") == "stores"]).collect()
    assert [(r["k"], r["v_now"], r["v_then"]) for r in got] == [("a", 9, 6)]


def test_wins_by_ordinal(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 3, "x"), ("a", 2, "y"), (None, 1, "n")], "k string, o int, v string")
    assert sorted(map(tuple, cells.last_wins(df, ["k"], ["o"]).collect()), key=str) == [("a", 3, "x"), (None, 1, "n")]
    assert sorted(map(tuple, cells.first_wins(df, ["k"], ["o"]).collect()), key=str) == [("a", 1, None), (None, 1, "n")]
    got = select.best_wins(spark.createDataFrame([("k", 5, 2, "late"), ("k", 5, 1, "first"), ("k", 4, 0, "low")], "k string, s int, o int, v string"), ["k"], [F.col("s")], ["o"]).first()
    assert got["v"] == "first"


def test_weekday_balance(spark):
    rows = [(date(2024, 1, d), 10.0 if date(2024, 1, d).weekday() < 5 else 80.0) for d in range(1, 11)]
    df = spark.createDataFrame([("g", d, v) for d, v in rows], "g string, d date, v double")
    got = cells.weekday_balanced(df, ["g"], "d", "v").first()
    assert got["balanced_mean"] == pytest.approx((5 * 10 + 2 * 80) / 7) and got["weekdays"] == 7


def test_hours_outside_all_bands(spark):
    bands = {"a": (9, 17), "b": (18, 22), "c": (0, 5), "d": (16, 18)}
    got = {r["id"]: r["b"] for r in spark.range(24).select("id", dates.band(F.col("id"), bands).alias("b")).collect()}
    assert got[6] == got[8] == got[23] == [] and got[17] == ["a", "d"] and got[18] == ["b", "d"]


def test_dates(spark):
    s = lambda x: F.lit(x).cast("string")
    d = lambda x: F.lit(x).cast("date")
    assert tuple(one(spark, dates.day(s("20240229")), dates.day(s("2024-02-30")), dates.day(s(None)))) == (date(2024, 2, 29), None, None)
    got = one(spark, *[dates.freshness(s(c), F.lit(a)) for c, a in (("daily", 3), ("daily", 4), ("daily", 8), ("monthly", 45), ("x", 1), ("daily", -1))])
    assert tuple(got) == ("FRESH", "CARRY", "STALE", "FRESH", "FRESH", "FUTURE")
    as_of = date(2024, 3, 1)
    assert tuple(one(spark, dates.due_status(d(None), as_of), dates.due_status(d("2024-03-01"), as_of), dates.month_day(F.lit(3), F.lit(1), as_of), dates.month_day(F.lit(2), F.lit(29), as_of), dates.month_day(F.lit(2), F.lit(30), as_of))) == ("UNSCHEDULED", "DUE_TODAY", date(2023, 3, 1), date(2024, 2, 29), None)
    assert tuple(one(spark, dates.latest_date(s("in 2024-01 and 2024-03"), date(2024, 3, 5)), dates.latest_date(s("2024-03-08, 2024-03-09"), date(2024, 3, 5)), dates.latest_date(s("none"), as_of), dates.iso_seconds(s("PT1H2M3S")), dates.iso_seconds(s("x")))) == (date(2024, 3, 5), date(2024, 3, 8), None, 3723, None)


def test_text_functions(spark):
    s = lambda x: F.lit(x).cast("string")
    assert tuple(one(spark, text.squash(s("a  b　c\n")), text.squash(s(None)), text.key_of(s("A-b 가!9")), text.concise(s("abcdef"), 4), text.redact(s("x a.b@c.de 02-1234-5678")))) == ("a b c", "", "ab가9", "abc…", "x [EMAIL] [PHONE]")
    assert tuple(one(spark, text.relevant_reason(s("Rain in Seoul - Paper"), ["seoul"]), text.relevant_reason(s("Paper - Seoul"), ["seoul"]), text.relevant_reason(s("Seoul Bank up - x"), ["seoul"], ["seoul bank"]))) == ("seoul", None, None)
    assert tuple(one(spark, text.grounded(s("exact words here"), s("the exact  words\nhere.")), text.grounded(s("short"), s("short")))) == (True, False)
    assert tuple(one(spark, text.titles_match(s("a long headline about buses"), s("A long headline about buses!")), text.titles_match(s("abc"), s("abc")), text.jaccard(F.array(F.lit("a")), F.array().cast("array<string>")))) == (True, False, 0.0)
    assert one(spark, text.canonical_url(s("HTTPS://Ex.Org/A/?q=1#x")))[0] == "https://ex.org/A/?q=1"
    assert one(spark, text.copies_quote(s("new bus lines open"), s("the new bus lines open today")))[0] is True


def test_chunks_by_offsets(spark):
    import random

    def whole_and_chunks(t, size, overlap, least):
        """Chunks as pieces with what they repeat in front, one after the other."""
        lines = [" ".join(x.split()) for x in t.splitlines()]
        pieces = [x[i : i + size] for x in lines if x for i in range(0, len(x) if len(x) > size else 1, max(1, size - overlap))]
        out = []
        while pieces:
            front = (out[-1][-overlap:] if overlap else "") if out else ""
            take = 1
            text = lambda n: "\n".join([*([front] if front else []), *pieces[:n]])  # noqa: B023, E731
            while take < len(pieces) and len(text(take + 1)) + (not out) <= size:
                take += 1
            out.append(text(take))
            pieces = pieces[take:]
        return [c for c in out if len(" ".join(c.split())) >= least]

    rng = random.Random(2)
    texts = ["\n".join(f"paragraph {i} " + "x" * 80 for i in range(40)), "a" * 60 + "\n" + "b  b" * 20, "c" * 100, "short", "y" * 2000, None, "", " \n\t\n"]
    texts += ["".join(rng.choice(["ab", "c", " ", "\n", "\r\n", "é", "\u2028", "\x0b", "d" * 30]) for _ in range(rng.randrange(1, 200))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for size, overlap, least in ((500, 50, 20), (80, 20, 10), (50, 10, 1), (40, 0, 5), (30, 29, 1)):
        got = {r["i"]: r["c"] for r in df.select("i", spans.chunks(F.col("t"), size, overlap, least).alias("c")).collect()}
        for i, t in enumerate(texts):
            assert got[i] == whole_and_chunks(t or "", size, overlap, least), (i, size)
    plan = df.select(spans.chunks(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_spans():
    t = "fee is due. the long wait ... fee of wait"
    assert t[slice(*spans.nearest_span_of(t, ["fee"], ["wait"]))] == "fee of wait"
    assert spans.nearest_span_of("fee", ["fee"], ["wait"]) is None
    assert spans.excerpt_of("aaaaaaaaaaaaaaaaaa [PHONE] fee wait", (27, 35), 3) == "[PHONE] fee wait"
    assert spans.measurements_of("art. 5 paid $1,200 over 3 days, the 2nd time 3 days") == ["$1,200", "3 days"]


def test_state_machine(spark):
    mk = lambda rows: spark.createDataFrame(rows, "k string, first_seen date, last_seen date")
    prior = mk([("a", date(2024, 1, 1), date(2024, 1, 2)), ("b", date(2024, 1, 1), date(2024, 1, 1))])
    seen = spark.createDataFrame([("a",), ("c",)], "k string")
    got = {r["k"]: (r["first_seen"], r["last_seen"], r["status"]) for r in series.compare_state(prior, seen, ["k"], "2024-01-03").collect()}
    assert got == {"a": (date(2024, 1, 1), date(2024, 1, 3), "SEEN"), "b": (date(2024, 1, 1), date(2024, 1, 1), "ABSENT"), "c": (date(2024, 1, 3), date(2024, 1, 3), "NEW")}
    assert {r["status"] for r in series.compare_state(prior.limit(0), seen, ["k"], "2024-01-03", baseline=True).collect()} == {"BASELINE"}


def test_window_statuses(spark):
    old = spark.createDataFrame([("a", [1, 2], "r"), ("b", [1], "r"), ("c", [1], "r"), ("d", [1], "r")], "s string, keys array<int>, route string")
    now = spark.createDataFrame([("a", [2, 3], "r", False), ("b", [9], "r", False), ("c", [1, 4], "q", False), ("d", [], "r", True), ("e", [5], "r", False)], "s string, keys array<int>, route string, failed boolean")
    got = {r["s"]: (r["status"], r["n_new"], r["kept_keys"]) for r in series.window_diff(old, now, "s").collect()}
    assert got == {"a": ("NEW", 1, [2, 3]), "b": ("POSSIBLE_GAP", None, [9]), "c": ("BASELINE_ROUTE_CHANGED", None, [1, 4]), "d": ("FAILED", None, [1]), "e": ("BASELINE", None, [5])}


def test_gates_treat_nulls_as_failures(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "id int, v int")
    got = {r["id"]: r["gate"] for r in gates.cascade(df, [("HAS", F.col("v").isNotNull()), ("BIG", F.col("v") > 2)]).collect()}
    assert got == {1: "PASS", 2: "HAS", 3: "BIG"}
    assert {(r["id"], r["rule"]) for r in gates.violations(df, "id", {"BIG": F.col("v") > 2}).collect()} == {(2, "BIG"), (3, "BIG")}
    ok, bad = gates.partition_by_gate(df, F.col("v") > 2)
    assert (ok.count(), bad.count()) == (1, 2)


def test_sequential_selection(spark):
    rows = [("p", i, s, k, t) for i, s, k, t in [(1, 9.0, "abc", ["a", "b", "c"]), (2, 8.0, "abcd", ["q"]), (3, 7.0, "zzz", ["a", "b", "x"]), (4, 6.0, "yyy", ["m", "n"]), (5, 6.0, "", [])]]
    df = spark.createDataFrame(rows, "g string, id long, s double, k string, t array<string>")
    got = greedy.greedy_top(df, "g", "id", "s", {"key": F.col("k"), "tokens": F.col("t")}, 3).orderBy("position").collect()
    assert [(r["id"], r["position"]) for r in got] == [(1, 1), (4, 2), (5, 3)]
    lead = {r["id"]: r["leader"] for r in greedy.leader_clusters(df, "g", "id", [-F.col("s")], "t", 0.5).collect()}
    assert lead == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}
    turns = spark.createDataFrame([(1, p, float(s)) for p, s in enumerate([5, 9, 8, 1, 7])], "c long, p long, s double")
    assert [(r["p"], r["pick"]) for r in similarity.suppress_neighbours(turns, "c", "p", "s", 3).orderBy("pick").collect()] == [(1, 1), (4, 2)]
    cap = spark.createDataFrame([(1, "f", "i"), (2, "f", "j"), (3, "g", "i"), (4, "g", "j"), (5, "h", "k"), (6, "g", "z")], "id long, f string, i string")
    got = {r["id"]: r["outcome"] for r in similarity.unique_with_reasons(cap, ["id"], "f", "i", "id", 2).collect()}
    assert got == {1: "KEPT", 2: "DUPLICATE_FAMILY", 3: "DUPLICATE_ISSUE", 4: "KEPT", 5: "OVER_CAP", 6: "DUPLICATE_FAMILY"}


def test_joins(spark):
    a = spark.createDataFrame([("x", "", "n")], "k string, v string, w string")
    b = spark.createDataFrame([("x", "", "m")], "k string, v string, w string")
    assert tuple(joins.with_precedence(a, b, ["k"], ["v", "w"]).first()) == ("x", "", "m")
    left = spark.createDataFrame([(1, ["school", "bus", "late"])], "l int, t array<string>")
    right = spark.createDataFrame([(7, ["school", "bus"]), (8, ["school"]), (9, ["school", "bus", "late"])], "r int, t array<string>")
    got = joins.token_matches(left, right, "l", "r", "t").orderBy("rank").collect()
    assert [(r["r"], r["shared"], r["score"]) for r in got] == [(9, 3, 16), (7, 2, 11)]


def test_provenance(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 3)], "x int, lane string, y int")
    m = provenance.freeze(df, "lane")
    assert provenance.verify_frozen(df.repartition(3), "lane", m) == []
    assert provenance.verify_frozen(df.filter("x = 1"), "lane", m) == ["COUNTS", "ROWS", "DIGEST"]
    assert provenance.verify_frozen(df, "lane", m | {"rows": 9}) == ["SEAL", "ROWS"]
    for n in "ab":
        (tmp_path / f"{n}.txt").write_text(n)
    provenance.seal_files(spark, str(tmp_path), "*.txt").write.parquet(f"{tmp_path}/seal")
    sealed = spark.read.parquet(f"{tmp_path}/seal")
    assert sealed.count() == 2
    (tmp_path / "a.txt").write_text("changed")
    (tmp_path / "c.txt").write_text("c")
    got = {(r["name"], r["problem"]) for r in provenance.verify_seal(sealed, provenance.seal_files(spark, str(tmp_path), "*.txt")).collect()}
    assert got == {("a.txt", "CHANGED"), ("c.txt", "ADDED")}


def test_zipped_tables(spark, tmp_path):
    from signalweave.sources import files

    with zipfile.ZipFile(tmp_path / "m.zip", "w") as z:
        z.writestr("pop_202307.csv", "﻿day,n\n20230701,\"1,000\"\n".encode("utf-8"))
        z.writestr("pop_202308.csv", "day\tn\n20230801\t한\n".encode("cp949"))
        z.writestr("readme.txt", "no")
    rows = files.read_zipped_csv(spark, str(tmp_path / "m.zip"), ["day", "n"]).orderBy("day").collect()
    assert [(r["day"], r["n"]) for r in rows] == [("20230701", "1,000"), ("20230801", "한")]
    assert files.read_zipped_csv(spark, str(tmp_path / "m.zip"), ["day", "n"], member="202307").count() == 1
    with pytest.raises(ValueError):
        files.decode(b"\xff\xfe\xff", ("utf-8",))


def test_pages_and_feeds(spark):
    from signalweave.sources import html

    page = "<html><head><title>T</title><style>x{}</style><script>var a='<p>no</p>'</script></head><body><nav><a href='/v?sn=7'>seven</a></nav><p>One &amp; two<br>three</p><table><tr><th>h</th><td>c <b>d</b></td></tr></table><a href='https://evil.org/v?sn=8'>x</a><a href='/v?sn=7'>again</a></body></html>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "plain & <broken")], "page_id int, html string")
    rows = html.visible(df).filter("kind is not null").orderBy("page_id", "pos").collect()
    got = [(r["kind"], r["text"]) for r in rows if r["page_id"] == 1]
    assert ("chunk", "One & two") in got and ("cell", "c d") in got and ("anchor", "seven") in got and not any("no" == t for _, t in got)
    assert [(r["sn"], r["text"]) for r in html.listing(df, ["good.org"], r"sn=(\d+)").collect()] == [(7, "seven")]
    ld = '<script type="application/ld+json">' + json.dumps({"articleBody": "w " * 300}) + "</script><p>short</p>"
    graph = '<script type="application/ld+json">' + json.dumps({"@graph": [{"articleBody": "short"}, {"deep": {"articleBody": 'say "x" \n' + "é " * 9000}}]}) + "</script>"
    long = "<p>" + "long text here " * 5 + "</p><nav>menu</nav>"
    meta = lambda a: f"<meta {a}><p>tiny</p>"
    cases = [ld, graph, long, meta('property="og:description" content="' + "d " * 80 + '"'), meta("content='" + "e " * 80 + "' name='description'"), meta('name="description" content="brief"'), "", None, "<p>" + "x" * 40_000 + "</p>"]
    bodies = {r["page_id"]: (r["basis"], r["body"]) for r in html.article_bodies(spark.createDataFrame(list(enumerate(cases)), "page_id int, html string")).collect()}
    assert bodies[0] == ("STRUCTURED", ("w " * 300).strip()) and bodies[1] == ("STRUCTURED", 'say "x" ' + ("é " * 9000).strip())
    assert bodies[2] == ("PARAGRAPHS", ("long text here " * 5).strip()) and bodies[3] == ("DESCRIPTION", ("d " * 80).strip()) and bodies[4] == ("DESCRIPTION", ("e " * 80).strip())
    assert bodies[5] == ("TEXT", "tiny") and bodies[6] == bodies[7] == (None, None) and bodies[8] == ("PARAGRAPHS", "x" * 40_000)
    entry = lambda i, t: f"<entry><id>{i}</id><title>{t}</title></entry>"
    feeds = spark.createDataFrame([(1, f"<feed><channel>c</channel>{entry(1, 'a')}{entry(2, 'b')}</feed>"), (2, f"<feed><channel>c</channel>{entry(1, 'a')}{entry(1, 'a')}</feed>"), (3, "<feed><channel>z</channel></feed>")], "id int, xml string")
    assert {r["id"]: r["status"] for r in html.feed_status(feeds, "id", "xml", "c").collect()} == {1: "OK", 2: "PARTIAL_INVALID_ENTRIES", 3: "WRONG_CHANNEL"}


def test_paged_source(spark, tmp_path):
    from signalweave.sources.paged import PagedSource

    spark.dataSource.register(PagedSource)
    for period, total in (("20231", 5), ("20241", 3)):
        for page in range(1, 4):
            rows = [{"a": 10 * page + i, "b": None} for i in range(2) if (page - 1) * 2 + i < total]
            if rows and (period, page) != ("20231", 2):
                (tmp_path / f"sales-{period}-{page}.json").write_text(json.dumps({"total": total, "rows": rows}))
    df = spark.read.format("paged_api").options(path=str(tmp_path), keys="sales", periods="20231,20241", fields="a,b", pageSize="2", pagesPerPartition="1").load()
    got = [(r["period"], r["page"], r["status"], r["a"]) for r in df.orderBy("period", "page", "a").collect()]
    assert got == [("20231", 1, "ok", "10"), ("20231", 1, "ok", "11"), ("20231", 2, "error", None), ("20231", 3, "ok", "30"), ("20241", 1, "ok", "10"), ("20241", 1, "ok", "11"), ("20241", 2, "ok", "20")]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    pushed = spark.read.format("paged_api").options(path=str(tmp_path), keys="sales", periods="20231,20241", fields="a,b", pageSize="2", push="true").load().filter("period = '20241'")
    assert pushed.count() == 3 and "20231" not in str(pushed.select("period").distinct().collect())


def test_sinks(spark, tmp_path):
    from signalweave.sources import files, sinks

    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    sinks.write_once(df, f"{tmp_path}/once")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_once(df, f"{tmp_path}/once")
    sinks.write_ledger(df, f"{tmp_path}/ledger", ["v", "k", "note"])
    assert files.read_ledger(spark, f"{tmp_path}/ledger").columns == ["v", "k", "note"]
    assert sinks.append_lines(df, f"{tmp_path}/lines") and not sinks.append_lines(df.limit(0), f"{tmp_path}/lines")
    sinks.append_lines(spark.createDataFrame([("a", 9)], "k string, v int"), f"{tmp_path}/lines")
    assert {(r["k"], r["v"]) for r in files.read_line_archive(spark, f"{tmp_path}/lines", "k string, v int", ["k"], ["v"]).collect()} == {("a", 9), ("b", 2), ("c", 3)}
    sinks.write_retained(df, f"{tmp_path}/kept", [F.desc("v")], 2)
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 2
    sinks.write_latest_and_history(df, f"{tmp_path}/out", "2024-01-01", "r1")
    assert spark.read.parquet(f"{tmp_path}/out/history").filter("run_day = '2024-01-01'").count() == 3
    assert files.newest_file(spark, f"{tmp_path}/lines", "*.gz").count() == 1


def test_streams(spark, tmp_path):
    from signalweave.streaming import states

    schema = "k string, at timestamp, src string"
    batches = [[("a", datetime(2024, 1, 1, 1), "s"), ("a", datetime(2024, 1, 1, 2), "s"), ("b", datetime(2024, 1, 1, 3), "s")], [("a", datetime(2024, 1, 2, 1), "s"), ("c", datetime(2024, 1, 2, 1), "s")], [("z", datetime(2024, 1, 3, 1), "s")]]

    def run(make, name):
        src = tmp_path / name
        src.mkdir()
        out = make(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src)))
        q = out.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / f"{name}-ck")).start()
        try:
            for i, b in enumerate(batches):
                spark.createDataFrame(b, schema).coalesce(1).write.mode("append").json(str(src))
                q.processAllAvailable()
        finally:
            q.stop()
        return spark.table(name).collect()

    got = run(lambda s: states.keyed_events(s, "k", "at"), "keyed")
    assert sorted((r["key"], r["n"], r["status"]) for r in got) == [("a", 2, "NEW"), ("a", 3, "SEEN"), ("b", 1, "NEW"), ("c", 1, "NEW"), ("z", 1, "NEW")]
    got = run(lambda s: states.window_changes(s, "src", "k"), "windows")
    assert [(r["status"], r["n_new"]) for r in got] == [("BASELINE", None), ("NEW", 1), ("POSSIBLE_GAP", None)]
    got = run(lambda s: states.windowed_counts(s, "at", "src", "1 day", "1 hour"), "counts")
    assert {(r["start"].day, r["n"]) for r in got} >= {(1, 3)}


def test_context_operators(spark):
    turns = spark.createDataFrame([(1, 0, "a quote here"), (1, 1, "quote"), (1, 2, "end")], "c int, t int, x string")
    q = spark.createDataFrame([(1, "quote")], "c int, q string")
    r = context.quoted_turn(turns, q, "c", "t", "x", "q", 3, 2).first()
    assert (r["t"], r["found_at"], r["before"], r["after"]) == (0, 3, None, "qu")
    lines = spark.createDataFrame([(1, 0, "pre"), (1, 1, "1. a"), (1, 2, "b"), (1, 3, "2. c")], "k int, p int, l string")
    assert [r["line"] for r in context.joined_islands(lines, ["k"], "p", "l", F.col("l").rlike(r"^\d+\.")).orderBy("island").collect()] == ["1. a b", "2. c"]


def test_entry_point(spark):
    import __spark_entry__ as e

    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q) and len(q) > 100
    assert e.entry(spark).count() > 0


def expanded(links):
    """All pairs that the rows of near_duplicate_links state."""
    groups, out = {}, set()
    for r in links:
        if r["class"] is not None:
            groups.setdefault((r["branch"], r["class"]), set()).add(r["a"])
    for ids in groups.values():
        out |= {(a, b) for a in ids for b in ids if a < b}
    of = {"contained": "key", "overlap": "tokens"}
    for r in links:
        if r["class"] is None:
            x, y = (groups.get((of[r["branch"]], str(r[c])), {r[c]}) for c in "ab")
            out |= {(min(a, b), max(a, b)) for a in x for b in y}
    return out


def all_near_duplicates(df, i):
    fields = ["key", "tokens", "markers", "families", "page", "values"]
    x, y = (df.select(F.col(i).alias(p), *[F.col(c).alias(f"{p}_{c}") for c in fields]) for p in "ab")
    a, b = ({c: F.col(f"{p}_{c}") for c in fields} for p in "ab")
    return {(r["a"], r["b"]) for r in x.crossJoin(y).filter("a < b").filter(similarity.near_duplicate_pair(a, b)).select("a", "b").collect()}


def test_near_duplicate_predicate_against_all_pairs(spark):
    from signalweave.plans.texts import _near_duplicate_fields

    got = expanded(plans.QUERIES["near_duplicate_predicate"](spark, SF).collect())
    assert got == all_near_duplicates(_near_duplicate_fields(spark, SF), "doc_id")


def test_near_duplicate_links_of_each_branch(spark):
    import random

    rng = random.Random(3)
    keys = ["", "a", "ab", "cab", "abcab", "가나", "x가나다y", "q" * 15, "q" * 16, "q" * 17, "0123456789abcdefghij" * 3]
    keys += ["".join(rng.choice("ab가") for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    pick = lambda xs, n: [x for x in xs if rng.random() < n]
    rows = [(i, k, pick("abcdefghijkl", 0.2), pick(["m", "n", "o"], 0.2), pick(["f", "g"], 0.2), rng.choice("pqrs"), pick([1, 2, 3, 4], 0.2)) for i, k in enumerate([*keys, *keys[:20]])]
    df = spark.createDataFrame(rows, "id long, key string, tokens array<string>, markers array<string>, families array<string>, page string, values array<int>")
    links = similarity.near_duplicate_links(df, "id").collect()
    assert expanded(links) == all_near_duplicates(df, "id")
    assert {r["branch"] for r in links} == {"key", "tokens", "markers", "page", "value", "contained", "overlap"}
    for r in links:
        assert r["class"] is not None or r["a"] < r["b"]


def test_texts_behind_a_common_first_line_are_told_apart(spark, tmp_path):
    body = lambda i: " ".join(f"w{i}x{chr(97 + j)}" for j in range(20))
    rows = [(i, f"one common first line\n{body(i)}", "en", f"s{i % 2}", 2000 - i) for i in range(4)] + [(4, f"another beginning\n{body(0)}", "en", "s1", 1500)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda q: plans.QUERIES[q](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["leader"] for r in run("leader_clusters")} == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0}
    assert {r["doc_id"] for r in run("greedy_near_dup_top")} == {0, 1, 2, 3, 4}
    assert {r["doc_id"] for r in run("page_quota_selection")} == {0, 1, 2, 3, 4}
    assert {(r["a"], r["b"], r["same"]) for r in run("same_issue_pairs")} == {(0, 2, False), (1, 3, False), (0, 4, False)}
    assert {(r["a"], r["b"]) for r in run("near_duplicate_predicate") if r["class"] is None} == {(0, 4)}


def test_title_match_pairs_against_all_pairs(spark, tmp_path):
    titles = ["2024 1234 5678 90", "20241234567890", "2024-1234-5678-901", "new library opens", "newlibrary opens", "newlibraryopens now", "the new library opens", "far too short", "1 2 3", "123", "new library opens", "new library opens"]
    d = spark.createDataFrame([(i, f"{t}\nbody {i}") for i, t in enumerate(titles)], "doc_id long, text string")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = plans.QUERIES["title_match_pairs"](spark, str(tmp_path)).collect()
    # Pairs of titles hold for all rows of the titles; titles of one key match each other.
    key = lambda t: "".join(c for c in t if c.isalnum())
    title = lambda i: {j for j, t in enumerate(titles) if t == titles[i]}
    held = {(min(x, y), max(x, y)) for r in got if r["branch"] == "pair" for x in title(r["a"]) for y in title(r["b"])}
    members = {r["b"]: r["a"] for r in got if r["branch"] == "key"} | {r["b"]: r["a"] for r in got if r["branch"] == "title"}
    assert all(key(titles[a]) == key(titles[b]) for b, a in members.items())
    held |= {(a, b) for b in range(len(titles)) for a in range(b) if key(titles[a]) == key(titles[b]) and len(key(titles[a])) >= 12 and b in members}
    got = held
    t = spark.createDataFrame(list(enumerate(titles)), "id long, t string")
    x, y = (t.select(F.col("id").alias(p), F.col("t").alias(f"t{p}")) for p in "ab")
    want = {(r["a"], r["b"]) for r in x.crossJoin(y).filter("a < b").filter(text.titles_match(F.col("ta"), F.col("tb"))).collect()}
    assert sorted(got) == sorted(want) and {(0, 1), (0, 2), (3, 4)} <= want


def test_cascade_takes_the_first_class_and_nulls_do_not_hold(spark):
    names = sorted({n for _, _, need, never in scoring.CASCADE for n in (*need, *never)})
    rows = [(i, {n: True for n in need}, label, status) for i, (label, status, need, _) in enumerate(scoring.CASCADE)]
    rows += [(100, {n: True for n in names}, "CONTACT_BOILERPLATE", "FAIL"), (101, {}, "REPORTABLE_TEXT", "PASS"), (102, None, "REPORTABLE_TEXT", "PASS")]
    df = spark.createDataFrame(rows, "id int, m map<string,boolean>, label string, status string")
    out = scoring.analysed(df, {n: F.col("m")[n] for n in names})
    assert out.filter("content_class <> label or precheck <> status").count() == 0 and out.count() == len(rows)
    assert scoring.analysed(df.limit(0), {}).count() == 0


def test_scope_states(spark):
    rows = [("x", True, "SOURCE_TRUSTED"), (None, None, "UNBOUND"), ("area: here all", False, "COMPARISON_WITH_ROW"), ("area: here", False, "VALUE_BOUND"), ("all", False, "WIDER_ONLY"), ("event here 5 cost", False, "UNBOUND"), ("here 5 cost", False, "VALUE_BOUND"), ("here 5. cost", False, "UNBOUND")]
    df = spark.createDataFrame(rows, "t string, own boolean, want string")
    got = scoring.scope(F.col("t"), F.col("own"), "here", "all", "event here", "cost", "area: here")
    assert df.filter(got != F.col("want")).count() == 0


def test_capped_lanes_against_a_loop(spark):
    rows = [(i, i * 7 % 5, None if i % 11 == 0 else f"k{i % 13}", i % 3) for i in range(200)] + [(900, None, "n", None)]
    df = spark.createDataFrame(rows, "id long, score int, k string, lane int").withColumn("position", F.lit("own"))
    got = {(r["lane"], r["id"], r["position"]) for r in scoring.capped_lanes(df, {"a": (F.col("lane") == 0, 4), "b": (F.col("lane") >= 1, 7), "none": (F.lit(False), 2)}, "id", "score", "k").collect()}
    want = set()
    for lane, ok, cap in (("a", lambda r: r[3] == 0, 4), ("b", lambda r: r[3] is not None and r[3] >= 1, 7)):
        seen, n = set(), 0
        for r in sorted(filter(ok, rows), key=lambda r: (-r[1], r[0])):
            if (r[2] or "") not in seen and n < cap:
                seen.add(r[2] or "")
                n += 1
                want.add((lane, r[0], n))
    assert got == want


def test_keys_and_seed_rows_at_any_depth(spark):
    texts = ['{"a":{"b":[{"c\\u0041":1}]}, "x" : "y\\": z"}', None, "", "[1]", "{broken"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, j string")
    assert [r[0] for r in df.orderBy("id").select(scoring.keys_anywhere(F.col("j"))).collect()] == [["a", "b", "cA", "x"], [], [], [], []]
    deep = json.dumps({"p": [{"date": "2024-01-01", "url": "http://no", "u2": "https://yes", "t": "x" * 80}, {"date": "soon", "url": "https://yes", "t": "y" * 90}, {"date": "2024-01-01", "url": "https://yes", "t": "z"}]})
    df = df.union(spark.createDataFrame([(9, deep), (None, deep)], df.schema))
    got = scoring.seed_rows(df, "id", "j", ["date"], ["url", "u2"], ["t", "t"]).orderBy("id").collect()
    assert [(r["id"], r["path"], r["url"], len(r["text"])) for r in got] == [(None, "$.p[0]", "https://yes", 80), (9, "$.p[0]", "https://yes", 80)]


def test_ledger_keeps_labels_and_first_sight(spark):
    day = lambda n: datetime(2024, 1, n)
    schema = "id long, labels array<string>, published timestamp, first timestamp, last timestamp"
    old = spark.createDataFrame([(1, ["b"], day(1), day(2), day(3)), (2, None, day(1), day(2), day(3)), (3, ["x"], None, day(2), day(3))], schema)
    new = spark.createDataFrame([(1, ["a", "b"], day(9), None, None), (4, [], day(9), None, None), (4, ["q"], day(8), None, None)], schema)
    got = {r["id"]: (r["labels"], r["published"], r["first"], r["last"], r["is_new"]) for r in scoring.merged_ledger(old, new, F.lit(day(20)), 15).collect()}
    assert got == {1: (["a", "b"], day(9), day(2), day(20), False), 4: (["q"], day(9), day(20), day(20), True)}


def test_periods_in_texts(spark):
    as_of = date(2024, 3, 5)
    for text, want in (("2024.3.1 and 2024-02", (date(2024, 3, 1), "2024-03-01")), ("2024-03", (as_of, "2024-03")), ("'23.11", (date(2023, 11, 30), "2023-11")), ("in 2023", (date(2023, 12, 31), "2023")), ("2024", (as_of, "2024")), ("2024-02-31 or 12345 or 2030", None), (None, None), ("", None)):
        got = one(spark, dates.latest_period(F.lit(text).cast("string"), as_of))[0]
        assert (got and tuple(got)) == want, text


def test_contained_in_against_all_pairs(spark):
    texts = [(i, "".join(chr(97 + (i * k * k + k) % 3) for k in range(1, 40)) + "é" * (i % 2)) for i in range(60)] + [(90, None), (91, "")]
    needles = sorted({t[s : s + n] for _, t in texts[:20] for s, n in ((0, 3), (5, 9), (11, 20))} | {"é", "zzz"})
    n = spark.createDataFrame([(x, x) for x in needles] + [("empty", ""), ("null", None)], "name string, k string")
    got = {tuple(r) for r in similarity.contained_in(n, spark.createDataFrame(texts, "id long, k string"), "name", "id", "k").collect()}
    assert got == {(x, i) for x in needles for i, t in texts if t and x in t}


def test_states_of_assessments_and_reviews(spark):
    s = lambda x: F.lit(x).cast("string")
    state = lambda url="https://a", ev="x" * 15, ctx="y" * 12, ident="1": reviews.input_state([s(ident), s("f")], s(url), s(ev), [s(None), s(ctx)])
    got = one(spark, state(), state(ident=" "), state(ident=None), state(url="http://a"), state(url=None), state(ev="short"), state(ev=None), state(ctx="short"))
    assert tuple(got) == ("VALID", "NO_IDENTITY", "NO_IDENTITY", "NO_HTTPS", "NO_HTTPS", "NO_EVIDENCE", "NO_EVIDENCE", "NO_CONTEXT")

    base = dict(fit="HIGH", scale="SYSTEM", stage="ACTUAL", lane="NONE", public=None, basis="b" * 12)

    def review(verdict="KEEP", reason="r" * 12, **changed):
        return reviews.review_state(s(verdict), reviews.scale_checks(**{k: s(v) for k, v in {**base, **changed}.items()}), [s(reason)])

    risk = dict(stage="DOCUMENTED_RISK", lane="BOTH")
    got = one(spark, review(), review(verdict=None), review(verdict="NO"), review(fit=None), review(scale="ORDINARY_SINGLE_CASE"), review(stage="SPECULATIVE"), review(**{**risk, "lane": "X"}), review(**risk), review(**risk, public="p" * 20), review(basis="short"), review(reason=None))
    assert tuple(got) == ("KEEP", "UNREVIEWED", "HOLD", "NO_LOCAL_FIT", "SINGLE_CASE", "SPECULATIVE", "LANE_MISMATCH", "NO_PUBLIC_BASIS", "KEEP", "NO_SCALE_BASIS", "THIN_REASONS")

    def assess(verdict="PROPOSE", conflict=False, quote="words of the evidence", title="A title of its own", q1="Who pays?", q2="Who gains?", path="p" * 12):
        scale = reviews.scale_checks(**{k: s(v) for k, v in base.items()})
        return reviews.assessment_state(s(verdict), F.lit(conflict), s(quote), s("The  words of\nthe evidence."), s(title), s("The Headline!"), (s(q1), s(q2)), scale, [s(path)], ["what impact"])

    got = one(spark, assess(), assess(verdict=None), assess(verdict="HOLD"), assess(conflict=True), assess(quote="words not in the text"), assess(quote=None), assess(title="the headline"), assess(q1="what impact?"), assess(q2="Who pays?"), assess(q2="Who"), assess(path=None))
    assert tuple(got) == ("PROPOSE", "UNASSESSED", "HOLD", "CONTEXT_CONFLICT", "QUOTE", "QUOTE", "TITLE", "QUESTIONS", "QUESTIONS", "QUESTIONS", "NO_PATH")
    rules = [(["name", "works"], ["does not mean"], ["delay", "late"])]
    conflict = lambda c, p: reviews.denied_claim(s(c), s(p), rules)
    assert tuple(one(spark, conflict("name of works does not mean x", "a delay"), conflict("name of works", "a delay"), conflict("name of works does not mean x", None), conflict(None, "late"))) == (True, False, False, False)


def test_states_of_answers(spark):
    s = lambda x: F.lit(x).cast("string")
    body = "first turn here\nthe second turn says this\nsplit over\ntwo turns"

    def answer(complete=True, verdict="REVIEW", quote="second turn says", question="Which of the two offices pays?", field="f" * 15, check="c" * 12):
        return reviews.answer_state(F.lit(complete), s(verdict), s(quote), s(body), F.split(s(body), "\n"), s(question), [s(field)], s(check), ["any impact"])

    got = one(spark, answer(), answer(complete=None), answer(verdict=None), answer(verdict="NO_SIGNAL"), answer(verdict="HOLD"), answer(verdict="HOLD", check="no"), answer(quote="never said in here"), answer(quote=None), answer(question="short?"), answer(question="Has it any impact on citizens?"), answer(field=None))
    assert [tuple(x) for x in got] == [("REVIEW", 1), ("INVALID_SCHEMA", None), ("INVALID_VERDICT", None), ("NO_SIGNAL", None), ("HOLD", 1), ("HOLD", None), ("INVALID_QUOTE", None), ("INVALID_QUOTE", None), ("GENERIC_QUESTION", None), ("GENERIC_QUESTION", None), ("INCOMPLETE_REASONING", None)]
    across = reviews.answer_state(F.lit(True), s("REVIEW"), s("alpha beta gamma"), s("alpha beta gamma"), F.array(s("alpha"), s(None)), s("q" * 20), [], s(None), [])
    assert tuple(one(spark, across)[0]) == ("QUOTE_TURN_UNRESOLVED", None)


def test_question_parts_take_the_first_rule(spark):
    rules = [{"domain": "A", "all": ("x", "y"), "parts": ["{subject} 1"] * 5}, {"domain": "A", "evidence": ("z",), "parts": ["2"] * 5}, {"domain": "A", "parts": ["3"] * 5}]
    s = lambda x: F.lit(x).cast("string")
    q = lambda d, f, c, subject="S": reviews.question_parts(s(subject), s(d), s(f), s(c), rules, ["d {subject}"] * 5)["verification_question"]
    assert tuple(one(spark, q("A", "yx", None), q("A", "x", "z"), q("A", "x", None), q("B", "xy", "z"), q(None, None, None, None))) == ("S 1", "2", "3", "d S", "d ")


def test_clusters_count_rows_once(spark):
    cols = "c string, id int, ch string, q boolean, direct boolean, scene boolean, near boolean, at int"
    rows = [("a", 1, "x", True, True, True, True, 5), ("a", 1, "x", True, True, True, True, 5), ("a", 2, "y", True, False, True, None, 1), ("a", 3, None, False, True, True, True, 0), ("b", 4, "x", True, True, False, False, 1), (None, 5, "x", None, None, None, None, None)]
    df = spark.createDataFrame(rows, cols)
    c = F.col
    got = reviews.cluster_evidence(df, ["c"], "id", "ch", c("q"), c("direct"), c("scene"), c("near"), c("direct"), ~c("q"), c("near"), c("direct")).collect()
    assert {r["c"]: (r["channels"], r["non_media_channels"], r["scene"], r["advice"], r["readiness"], r["score"]) for r in got} == {"a": (2, 2, 2, 1, "CORROBORATED", 6 + 4 + 1 + 2 - 3 - 1), "b": (1, 1, 0, 0, "LEAD", 3 + 2), None: (1, 0, 0, 0, "HOLD", 0)}
    chosen = reviews.cluster_selection(df, ["c"], "id", "ch", c("q"), c("direct"), c("scene"), c("near"), c("at")).collect()
    assert sorted((r["c"], r["reasons"], r["sample"]) for r in chosen) == [("a", [], [1, 2]), ("b", ["CHANNELS", "SCENES", "PLACE"], None)]
    assert reviews.cluster_selection(df.limit(0), ["c"], "id", "ch", c("q"), c("direct"), c("scene"), c("near"), c("at")).count() == 0


def test_outcomes_need_every_bar(spark):
    names = ["days", "span_days", "documents", "reviews", "ready", "ready_reviews", "attempted", "extracted", "grounded", "startable", "angled", "right_angle", "generic", "critical", "complete"]
    good = dict(zip(names, (7, 7, 12, 10, 10, 10, 10, 8, 9, 6, 10, 9, 2, 0, 10)))
    cases = [{}, {"days": 6}, {"reviews": 9}, {"attempted": 0}, {"critical": 1}, {"complete": 9}, {"generic": 3}, {"ready": 0, "ready_reviews": 0}, {"documents": 0}]
    df = spark.createDataFrame([(i, *{**good, **x}.values()) for i, x in enumerate(cases)], ["i", *names])
    assert [r["outcome"] for r in reviews.outcome(df).orderBy("i").collect()] == ["ELIGIBLE", "COLLECTING", "AWAITING_REVIEW", "NOT_MET", "NOT_MET", "NOT_MET", "NOT_MET", "AWAITING_REVIEW", "COLLECTING"]


def test_rules_of_assessments(spark):
    enums = {"agent_role": ["A"], "loss_type": ["L"], "source_family": ["S"], "grounding": ["G0_UNGROUNDED", "G3_INDEPENDENT_CORROBORATION"], "verdict": ["PASS", "FAIL"], "lane": ["REJECT", "VERIFY_TODAY", "EDITORIAL_PROPOSAL"]}
    ref = {"quote_id": "q", "ref_id": "r", "source_id": "s", "url": "https://x", "exact_text": "t", "claim_status": "UNRESOLVED"}
    hypothesis, step = {"name": "n", "explanation": "e", "discriminating_evidence": "d"}, {"action": "a", "pass_signal": "p", "source_family": "S"}
    good = {n: "x" for n in reviews.TEXT_LIMITS} | {
        "snapshot_id": "0" * 64, "scope_warning": "", "agent_role": "A", "grounding": "G3_INDEPENDENT_CORROBORATION", "verdict": "PASS", "lane": "EDITORIAL_PROPOSAL", "score_total": 8, "scores": {"a": 2, "b": 2, "c": 2, "d": 2},
        "evidence": [ref], "stake": {"affected_group": "g", "consequence": "c", "loss_type": "L"}, "confirmed": [{"text": "t", "quote_ids": ["q"]}], "unverified": [], "hypotheses": [hypothesis, hypothesis], "plan": [step], "kill_criteria": ["k"],
    }
    cases = [
        ({}, set()),
        ({"issue_title": "x" * 161}, {"TEXTS"}),
        ({"snapshot_id": "A" * 64, "scope_warning": None}, {"SNAPSHOT", "SCOPE_WARNING"}),
        ({"evidence": [ref, ref]}, {"QUOTE_IDS"}),
        ({"evidence": []}, {"NO_EVIDENCE", "FACTS"}),
        ({"evidence": [{**ref, "url": "ftp://x"}]}, {"EVIDENCE"}),
        ({"confirmed": [{"text": "t", "quote_ids": ["none"]}]}, {"FACTS"}),
        ({"hypotheses": [hypothesis], "kill_criteria": []}, {"HYPOTHESES", "PASS_PLAN"}),
        ({"scores": {"a": 0, "b": 2, "c": 2, "d": 2}, "score_total": 6}, {"PASS_GATE"}),
        ({"scores": {"a": 2, "b": 2, "c": 2, "d": 3}, "score_total": 8}, {"SCORE_RANGE", "SCORE_TOTAL"}),
        ({"grounding": "G0_UNGROUNDED"}, {"CORROBORATION"}),
        ({"grounding": "G0_UNGROUNDED", "lane": "VERIFY_TODAY"}, {"UNGROUNDED"}),
        ({"lane": "REJECT"}, {"REJECT"}),
        ({"agent_role": None}, {"ENUMS"}),
    ]
    schema = ", ".join(f"{n} string" for n in [*reviews.TEXT_LIMITS, "snapshot_id", "scope_warning", "agent_role", "grounding", "verdict", "lane"])
    texts = lambda *names: "array<struct<" + ",".join(f"{n}:string" for n in names) + ">>"
    facts = "array<struct<text:string,quote_ids:array<string>>>"
    schema += f", id int, score_total int, scores struct<a:int,b:int,c:int,d:int>, evidence {texts(*ref)}, stake struct<affected_group:string,consequence:string,loss_type:string>, confirmed {facts}, unverified {facts}, hypotheses {texts(*hypothesis)}, plan {texts(*step)}, kill_criteria array<string>"
    df = spark.createDataFrame([{"id": i, **good, **x} for i, (x, _) in enumerate(cases)], schema)
    broken = {}
    for r in gates.violations(df, "id", reviews.assessment_rules(enums, ["a", "b", "c", "d"], ["a"])).collect():
        broken.setdefault(r["id"], set()).add(r["rule"])
    assert [broken.get(i, set()) for i in range(len(cases))] == [want for _, want in cases]


def test_recent_terms_across_texts(spark):
    import random

    rng = random.Random(5)
    rows = [(g, i, rng.choice([None, "", "a", "B", "a b", "ab" * rng.randint(0, 9), "b a c" * rng.randint(1, 5), "cca"])) for g in range(6) for i in range(40)]
    terms = {"x": "abca", "y": "ccab", "z": "bbb"}
    df = spark.createDataFrame(rows, "g int, i int, t string")
    got = {(r["g"], r["i"]): (r["x"], r["y"], r["z"]) for r in context.recent_terms(df, ["g"], ["i"], F.col("t"), terms, back=5).collect()}
    for g, i, _ in rows:
        near = "".join((t or "").lower().replace(" ", "") for h, j, t in rows if h == g and i - 5 <= j <= i)
        assert got[g, i] == tuple(t in near for t in terms.values())


def test_dispositions_and_subjects(spark):
    s = lambda x: F.lit(x).cast("string")
    late = "\n".join(["x"] * 25 + ["warned 9"])
    got = one(spark, *[context.disposition_counts(s(t), ["warned", "paid"]) for t in ("[warned (3)]\nwarned 2 then warned 4\r\npaid", "warned 700\n【warned 5】", late, None, "", "warned: 7", "x\n" * 30 + "[a [warned 3] [warned ( 8 )] [" + "y" * 200 + " warned 4] [paid no, paid  12]")])
    assert [dict(x) for x in got] == [{"warned": 2}, {"warned": 5}, {}, {}, {}, {}, {"warned": 8, "paid": 12}]
    rows = [("a", 1, "the road of the town", False), ("a", 2, "Mayor: the road", True), ("a", 3, None, False), ("a", 4, "pupils  pay", None), ("b", 1, "nothing", False), (None, 1, "a road " + "x" * 200, False)]
    df = spark.createDataFrame(rows, "k string, i int, t string, sp boolean")
    found = {r["k"]: r for r in context.subject_context(df, ["k"], "i", "t", F.col("sp"), "road", ["town"], ["pupils", "drivers"]).collect()}
    assert (found["a"]["subject"], found["a"]["affected"], found["a"]["context"]) == ("the road of the town", ["pupils"], "PASS")
    assert found["b"]["missing"] == ["subject", "scope", "affected"] and len(found[None]["subject"]) == 180
    assert context.subject_context(df.limit(0), ["k"], "i", "t", F.col("sp"), "road", ["town"], ["pupils"]).count() == 0


def test_rules_of_observations(spark):
    ok = {"id": "1", "url": "https://x.org/1", "date_state": "UNKNOWN", "published": None, "access": "OK", "body": "READ", "excerpt": None}
    good = {"registered": "L1", "maturity": "L1", "source_url": None, "access": "OK", "interpretation": "NOT_EVALUATED", "keys": ["records"], "records": [ok]}
    cases = [
        ({}, set()), ({"registered": None}, {"UNREGISTERED", "MATURITY", "PROBE_WITH_RECORDS"}), ({"maturity": "L2"}, {"MATURITY"}), ({"source_url": "https://u@x"}, {"SOURCE_URL"}), ({"access": "FAILED"}, {"FAILED_WITH_RECORDS"}), ({"access": "FAILED", "records": []}, set()),
        ({"interpretation": "DONE"}, {"INTERPRETED"}), ({"keys": ["score"]}, {"FORBIDDEN_KEYS"}), ({"records": [ok, ok]}, {"REPEATED_ID", "REPEATED_URL"}), ({"records": [{**ok, "id": " ", "url": "http://x"}]}, {"RECORD_ID", "RECORD_URL"}),
        ({"records": [{**ok, "date_state": "VERIFIED"}]}, {"DATE_STATE"}), ({"records": [{**ok, "body": None}]}, {"RECORD_STATE"}), ({"records": [{**ok, "excerpt": "x" * 261}]}, {"EXCERPT"}),
        ({"records": [{**ok, "id": str(i), "url": f"https://x.org/{i}"} for i in range(21)]}, {"TOO_MANY"}),
    ]
    schema = "n int, registered string, maturity string, source_url string, access string, interpretation string, keys array<string>, records array<struct<id:string,url:string,date_state:string,published:string,access:string,body:string,excerpt:string>>"
    df = spark.createDataFrame([{"n": i, **good, **x} for i, (x, _) in enumerate(cases)], schema)
    broken = {}
    for r in gates.violations(df, "n", reviews.observation_rules(["OK", "FAILED"], ["READ"], ["VERIFIED", "UNKNOWN"], ["score"])).collect():
        broken.setdefault(r["n"], set()).add(r["rule"])
    assert [broken.get(i, set()) for i in range(len(cases))] == [want for _, want in cases]
