"""Keyed tables over many batches: what a batch opens, replays, crashes, snapshots."""

import re

from pyspark.sql import functions as F

from ledgerhawk.streaming import sinks as sk
from ledgerhawk.streaming.files import folders, marks, remove
from ledgerhawk.streaming.keyindex import KeyIndex
from ledgerhawk.streaming.levels import Serving


def _batch(spark, n, again=()):
    """20 new keys of a batch, and keys of earlier ones with other values."""
    rows = [(f"k{n}-{i}", n, "PASS") for i in range(20)] + [(k, 1000 + n, "PASS") for k in again]
    return spark.createDataFrame(rows, "idempotency_key string, value long, decision_action string")


def _gold(spark, path):
    return sorted((r["idempotency_key"], r["value"]) for r in sk.read_gold(spark, path).collect())


def test_merge_opens_few_files_over_many_batches(spark, tmp_path):
    path, want = str(tmp_path / "gold"), []
    for n in range(24):
        again = [f"k{n - 3}-1", f"k{n // 2}-2"] if n > 6 else []
        opened = sk.merge_insert_batch(spark, _batch(spark, n, again), path, n, "idempotency_key", (), buckets=32, fan=3)
        want += [(f"k{n}-{i}", n) for i in range(20)]
        # two keys are stored: their files, and now and then one that a filter takes for another
        assert (1 if n > 6 else 0) <= len(opened) <= 6, (n, opened)
        assert len(folders(spark, f"{path}/_keys/files")) <= 3 * 3       # merged runs are gone
        if n in (9, 23):                                   # a replay finds nothing of itself
            sk.merge_insert_batch(spark, _batch(spark, n, again), path, n, "idempotency_key", (), buckets=32, fan=3)
            assert _gold(spark, path) == sorted(want)
    assert _gold(spark, path) == sorted(want)


def test_merge_after_a_crash_before_the_keys(spark, tmp_path):
    path = str(tmp_path / "gold")
    sk.merge_insert_batch(spark, _batch(spark, 0), path, 0, "idempotency_key", ())
    for name in marks(spark, f"{path}/_keys/runs"):
        remove(spark, f"{path}/_keys/runs/{name}")             # rows are there, their keys are not committed
    sk.merge_insert_batch(spark, _batch(spark, 0), path, 0, "idempotency_key", ())
    remove(spark, f"{path}/_keys")                             # a table from before there were keys
    sk.merge_insert_batch(spark, _batch(spark, 1, ["k0-3"]), path, 1, "idempotency_key", ())
    assert _gold(spark, path) == sorted((f"k{n}-{i}", n) for n in (0, 1) for i in range(20))


def test_filters_know_every_key_and_few_others(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), spark.range(1).schema["id"].dataType)
    index.add(0, 0, spark.range(20_000).select(F.col("id").alias("k")))
    index.add(1, 1, spark.range(0).select(F.col("id").alias("k")))
    own = index.candidates(spark.range(20_000).select(F.col("id").alias("k")), 2)
    other = index.candidates(spark.range(10 ** 6, 10 ** 6 + 20_000).select(F.col("id").alias("k")), 2)
    assert own.select("k").distinct().count() == 20_000 and other.count() < 100
    known, opened = index.known(spark.range(19_990, 20_010).select(F.col("id").alias("k")), 2)
    assert sorted(r["k"] for r in known.collect()) == list(range(19_990, 20_000)) and len(opened) <= 16


def _rows(spark, n, keys):
    return spark.createDataFrame([(k, n, f"{k}:{n}") for k in keys], "row_key string, version_ts long, data string")


def _table(df):
    return {r["row_key"]: r["data"] for r in df.collect()}


def test_serving_levels_versions_and_lookup(spark, tmp_path):
    t, want, seen = Serving(spark, str(tmp_path / "t"), fan=3), {}, {}
    for n in range(8):
        keys = [f"k{i}" for i in (range(6 * n, 6 * n + 10) if n else range(60))]
        t.upsert(_rows(spark, n, keys), n)
        want.update({k: f"{k}:{n}" for k in keys})
        levels = [r["level"] for r in t.runs()]
        assert levels.count(1) <= 1 and levels.count(0) <= 3 and set(levels) <= {0, 1}
        seen[max(t.versions())] = dict(want)
    assert any(r["level"] == 1 for r in t.runs()) and _table(t.read()) == want
    old = min(seen)
    assert _table(t.read(old)) == seen[old]                    # a reader's version stays as it is
    t.upsert(_rows(spark, 99, ["k0"]), 7)                      # a replayed batch is already there
    assert _table(t.read()) == want
    assert _table(t.lookup(["k7", "k45", "none"])) == {k: want[k] for k in ("k7", "k45")}
    scans = re.findall("FileScan.*", t.lookup(["k7"])._jdf.queryExecution().executedPlan().toString())
    for scan in scans:                                          # its bucket is listed, its key pushed down
        assert re.search(r"PartitionFilters: [^]]*_bucket.*PushedFilters: .*EqualTo\(row_key,k7\)", scan), scan
    assert scans
    t.vacuum()
    assert len(t.versions()) == 2 and _table(t.read()) == want
    assert set(folders(spark, f"{t.path}/runs")) == {f"run={r['run']}" for v in t.versions() for r in t.runs(v)}


def test_serving_crash_between_data_and_version(spark, tmp_path, monkeypatch):
    t = Serving(spark, str(tmp_path / "t"), fan=2)
    t.upsert(_rows(spark, 0, ["a", "b"]), 0)

    def crash(runs):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(t, "_commit", crash)
        try:
            t.upsert(_rows(spark, 1, ["b", "c"]), 1)
        except RuntimeError:
            pass
    assert _table(t.read()) == {"a": "a:0", "b": "b:0"}          # the run is there, no version lists it
    t.upsert(_rows(spark, 1, ["b", "c"]), 1)
    assert _table(t.read()) == {"a": "a:0", "b": "b:1", "c": "c:1"}


def test_serving_takes_new_columns_and_no_rows(spark, tmp_path):
    t = Serving(spark, str(tmp_path / "t"), fan=3)
    assert t.read() is None and t.lookup(["a"]) is None
    t.upsert(_rows(spark, 0, []), 0)
    t.upsert(_rows(spark, 1, ["a"]), 1)
    t.upsert(_rows(spark, 2, ["b"]).withColumn("more", F.lit(1)), 2)
    t.upsert(_rows(spark, 3, ["a"]), 3)
    assert sorted(tuple(r) for r in t.read().select("row_key", "data", "more").collect()) == [("a", "a:3", None), ("b", "b:2", 1)]


def test_only_the_changed_day_is_written_again(spark, tmp_path):
    from ledgerhawk.operators import gold as gd
    days = [f"2024-01-0{d}" for d in range(1, 6)]
    rows = spark.createDataFrame([(i, i % 4, float(i), i % 3 == 0, days[i % 5]) for i in range(40)], "Trans_id long, Clt_id long, a double, s boolean, d string") \
        .select("Trans_id", "Clt_id", F.col("a").cast("decimal(12,2)").alias("Trans_amount"), F.col("s").cast("int").alias("suspect_flag"),
                F.concat("d", F.lit(" 10:00:00")).cast("timestamp").alias("Trans_ts"))
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")

    def files(table):
        return {p.parent.name: p.name for p in (tmp_path / "gold" / table).rglob("*.parquet")}

    def refresh(part):
        gd.write_by_day(part, silver, ts="Trans_ts")
        gd.refresh_gold(spark, silver, gold, gd.changed_days(part))

    late = F.to_date("Trans_ts") == F.lit(days[2]).cast("date")
    refresh(rows.where(~late | (F.col("Trans_id") < 20)))
    before = {t: files(t) for t in ("kpis", "clients", "trend")}
    refresh(rows.where(late))
    for t, old in before.items():
        new = files(t)
        changed = {d for d in new if new[d] != old[d]}
        assert changed == {f"day_of={d}" for d in (days[2:] if t == "trend" else days[2:3])}, t
    whole = gd.suspect_trend(rows).orderBy("period_start").collect()
    kept = spark.read.parquet(f"{gold}/trend").drop("day_of").orderBy("period_start").select(*whole[0].asDict()).collect()
    assert kept == whole
