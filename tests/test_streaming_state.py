"""Keyed state that survives a restart, ends by timers, and equals the batch form."""

from datetime import datetime

from pyspark.sql import functions as F

from signalweave.operators import series
from signalweave.streaming import states


class Feed:
    """A folder of JSON batches and queries on it that are stopped after each batch and started again from their checkpoint."""

    def __init__(self, spark, root, schema):
        self.spark, self.schema, self.root = spark, schema, root
        self.src = root / "src"
        self.src.mkdir()

    def batch(self, make, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").json(str(self.src))
        out = make(self.spark.readStream.schema(self.schema).json(str(self.src)))
        got = []
        q = out.writeStream.foreachBatch(lambda df, n: got.extend(df.collect())).outputMode("append").option("checkpointLocation", str(self.root / "ck")).trigger(availableNow=True).start()
        try:
            q.awaitTermination(120)
        finally:
            q.stop()
        return got


def test_window_changes_go_on_after_a_restart_and_equal_the_batch_form(spark, tmp_path):
    feed = Feed(spark, tmp_path, "src string, k string")
    windows = [[("s", "a"), ("s", "b\x1fc"), ("t", "1")], [("s", "b\x1fc"), ("s", "d"), ("s", "e")], [("s", "z"), ("t", "1")], [("s", "z"), ("s", "d")]]
    state, want, got = None, [], []
    for w in windows:
        got += [(r["source"], r["status"], r["n_new"]) for r in sorted(feed.batch(lambda s: states.window_changes(s, "src", "k", keep=3), w), key=lambda r: r["source"])]
        keys = F.transform(F.array_sort(F.collect_list(F.struct("i", "k"))), lambda x: x["k"]).alias("keys")
        rows = spark.createDataFrame([(i, *r) for i, r in enumerate(w)], "i int, src string, k string")
        seen = rows.groupBy("src").agg(keys).withColumns({"failed": F.lit(False), "route": F.lit("r")})
        prior = spark.createDataFrame(state or [], "src string, keys array<string>, route string")
        diff = series.window_diff(prior, seen, "src").collect()
        want += sorted((r["src"], r["status"], r["n_new"]) for r in diff)
        old = {s: k for s, k, _ in state or []}
        for s in {r[0] for r in w}:
            now = list(dict.fromkeys(k for x, k in w if x == s))
            old[s] = [*now, *[k for k in old.get(s, []) if k not in now]][: max(3, len(now))]
        state = [(s, k, "r") for s, k in old.items()]
    assert got == want
    assert [x for x in got if x[0] == "s"] == [("s", "BASELINE", None), ("s", "NEW", 2), ("s", "POSSIBLE_GAP", None), ("s", "NO_NEW", 0)]


def test_keyed_state_and_timers_survive_a_restart(spark, tmp_path):
    feed = Feed(spark, tmp_path, "k string, at timestamp")
    day = lambda d: datetime(2024, 1, d, 12)
    make = lambda s: states.keyed_events(s, "k", "at", ttl_days=5)
    batches = [[("a", day(1)), ("a", day(2)), ("b", day(1)), (None, None)], [("a", day(3)), ("c", day(3))], [("d", day(12))], [("d", day(13))], [("a", day(14))]]
    got = [[(r["key"], r["n"], r["status"]) for r in feed.batch(make, b)] for b in batches]
    flat = [x for b in got for x in b]
    assert sorted(got[0], key=str) == [("a", 2, "NEW"), ("b", 1, "NEW"), (None, 1, "NEW")] and set(got[1]) == {("a", 3, "SEEN"), ("c", 1, "NEW")}
    # Once the watermark is past the fifth day after a key's last row its state ends, and the key is new when it comes again.
    assert {("a", 3, "EXPIRED"), ("b", 1, "EXPIRED"), ("c", 1, "EXPIRED")} <= set(flat) and flat.count(("a", 3, "EXPIRED")) == 1
    assert ("a", 1, "NEW") in got[4] and not any(x[0] == "d" and x[2] == "EXPIRED" for x in flat)
