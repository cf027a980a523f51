"""Monthly tables whose columns change, events appended once, bands from tables, the champion of a stream."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import alerts, joins, registry, scoring
from ledgerlight.sources import tables as T
from ledgerlight.streaming import scored_stream as stream

DAY = dt.datetime(2026, 1, 5)


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_months_with_other_columns_are_read_together(spark, tmp_path):
    path = str(tmp_path / "t")
    T.write_monthly(rows(spark, [(1, DAY, 10), (2, DAY.replace(month=2), 20)], "id int, at timestamp, n int"), path, "at")
    T.write_monthly(rows(spark, [(3, DAY.replace(month=2), 2**40, "x")], "id int, at timestamp, n long, note string"), path, "at")
    got = T.read_monthly(spark, path)
    assert got.columns == ["id", "at", "n", "note", "annee", "mois"] and got.schema["n"].dataType.simpleString() == "bigint"
    assert sorted((r["id"], r["n"], r["note"], r["mois"]) for r in got.collect()) == [(1, 10, None, 1), (3, 2**40, "x", 2)]
    # A column that a later write lacks stays, null there; an equal schema is kept once.
    T.write_monthly(rows(spark, [(4, DAY.replace(month=3), 1)], "id int, at timestamp, n int"), path, "at")
    assert [r["note"] for r in T.read_monthly(spark, path).orderBy("id").collect()] == [None, "x", None]
    assert spark.read.parquet(f"{path}/{T.SCHEMAS}").count() == 2
    assert T.month_range(T.read_monthly(spark, path), "at", "2026-02-01", "2026-02-28").count() == 1


def test_a_type_that_does_not_hold_the_old_values_needs_a_whole_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    T.write_monthly(rows(spark, [(1, DAY, "a")], "id int, at timestamp, n string"), path, "at")
    other = rows(spark, [(2, DAY.replace(month=2), 5)], "id int, at timestamp, n int")
    with pytest.raises(ValueError, match="overwrite the whole table"):
        T.write_monthly(other, path, "at")
    assert T.read_monthly(spark, path).count() == 1
    T.write_monthly(other, path, "at", whole=True)
    assert [(r["id"], r["n"]) for r in T.read_monthly(spark, path).collect()] == [(2, 5)]


SCHEMA = "log_id long, user_id int, action string, details string, created_at timestamp"


def test_lots_are_appended_once(spark, tmp_path):
    path = str(tmp_path / "log")
    log = lambda *ids, day=5: rows(spark, [(i, i % 3, "a", None, DAY.replace(day=day)) for i in ids], SCHEMA)
    read = lambda: sorted(r["log_id"] if r["log_id"] is not None else -1 for r in T.read_appended(spark, path, SCHEMA).collect())
    assert read() == []
    alerts.append_audit(log(1, 2, 2, 3), path, "a")
    for _ in range(2):
        alerts.append_audit(log(3, 4, 5), path, "b")              # 3 is known; the lot comes twice
        assert read() == [1, 2, 3, 4, 5]
    alerts.append_audit(log(1, 2, 3), path, "a")                  # the first lot again
    alerts.append_audit(log(9, 5, day=6), path, "c")              # another day is another event
    alerts.append_audit(log().limit(0), path, "d")
    assert read() == [1, 2, 3, 4, 5, 5, 9]
    alerts.append_audit(rows(spark, [(None, 1, "x", None, None), (None, 1, "x", None, None)], SCHEMA), path, "e")
    alerts.append_audit(rows(spark, [(None, 1, "x", None, None), (7, 1, "x", None, None)], SCHEMA), path, "f")
    assert read() == [-1, 1, 2, 3, 4, 5, 5, 7, 9]
    assert T.read_appended(spark, path, SCHEMA).columns == SCHEMA.replace(",", "").split()[::2]


def test_alert_states_fold_after_appends(spark, tmp_path):
    path = str(tmp_path / "states")
    schema = "alert_id long, user_id int, action string, at timestamp"
    for lot in ("a", "a", "b"):
        alerts.append_states(rows(spark, [(1, 7, alerts.READ, DAY), (None, 8, alerts.READ_ALL, DAY)], schema), path, lot)
    states = T.read_appended(spark, path, schema)
    assert states.count() == 2
    made = rows(spark, [(1, 7, DAY), (2, 7, DAY), (3, 8, DAY)], "alert_id long, user_id int, created_at timestamp")
    assert {r["alert_id"]: r["lu"] for r in alerts.fold_states(made, states).collect()} == {1: 1, 2: 0, 3: 1}


@pytest.mark.parametrize("block", [4096, 16, 3])
def test_bands_of_a_table_equal_brute_force(spark, block):
    rng = random.Random(block)
    lows = rng.sample(range(0, 2000), 120)
    bands = [(float(x), None if k % 40 == 0 else float(x + rng.choice([0, 3, 30])), f"b{k}") for k, x in enumerate(lows)]
    bands += [(bands[0][0], bands[0][0] - 1, "shorter"), (None, 5.0, "none")]
    values = [None, -1.0, 5000.0] + [rng.randrange(0, 2100) / 1.0 for _ in range(200)] + [float(x) for x in lows[:20]]
    facts = rows(spark, [(k, v) for k, v in enumerate(values)], "id int, v double").withColumn("low", F.lit("kept"))
    table = rows(spark, bands, "du double, au double, name string")
    got = {r["id"]: r["name"] for r in joins.band_join(facts, "v", table, "du", "au", ["name"], block).collect()}
    for k, v in enumerate(values):
        found = [(b[0], b[1] is None, b[1] or 0.0, b[2]) for b in bands if v is not None and b[0] is not None and b[0] <= v]
        best = max(found) if found else None
        assert got[k] == (best[3] if best and (best[1] or v <= best[2]) else None), (v, best)
    assert len(got) == len(values)
    assert joins.band_join(facts, "v", table.limit(0), "du", "au", ["name"], block).filter("name is not null").count() == 0


@pytest.mark.parametrize("small", [10**6, 0])
def test_no_row_meets_a_long_array_of_bands(spark, monkeypatch, small):
    taken = []
    search = joins._last_start
    monkeypatch.setattr(joins, "_last_start", lambda array, at, longest: taken.append(longest) or search(array, at, longest))
    monkeypatch.setattr(joins, "SMALL", small, raising=False)
    table = spark.range(700).select((F.col("id") * 3.0).alias("du"), (F.col("id") * 3.0 + 1).alias("au"), F.col("id").alias("k"))
    facts = spark.range(-5, 2200).select("id", F.col("id").cast("double").alias("v"))
    got = {r["id"]: r["k"] for r in joins.band_join(facts, "v", table, "du", "au", ["k"]).collect()}
    assert got == {v: v // 3 if 0 <= v < 2100 and v % 3 < 2 else None for v in range(-5, 2200)}
    assert max(taken) <= 64                            # every row carries a copy of the array it meets


def test_stream_batches_use_the_champion_of_their_time(spark, tmp_path):
    base = str(tmp_path)
    schema = "transaction_id int, montant double, type_transaction string, mode_paiement string, heure int, is_weekend int, est_international int"
    loads = []

    def scorer_of(version):
        loads.append(version)
        return lambda df: df.withColumn(scoring.SCORE, F.lit(version / 10))

    def champion():
        return registry.resolve_champion(T.read_history(spark, f"{base}/versions"), T.read_history_or_empty(spark, f"{base}/events", registry.EVENT_SCHEMA), "m")

    def run(ids):
        rows(spark, [(i, 5.0, "Paiement", "Carte", 3, 0, 0) for i in ids], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        arrived = stream.incoming(spark, f"{base}/in", rows(spark, [], schema).schema, files_per_batch=1)
        stream.score_with_champion(arrived, champion, scorer_of, f"{base}/out", f"{base}/progress").awaitTermination()

    for version in (3, 4):
        T.append_history(registry.version_row(spark, "m", version, f"r{version}", DAY), f"{base}/versions")
    T.append_history(registry.promotion_event(spark, "m", 3, DAY, 1), f"{base}/events")
    run([1, 2])
    run([3])
    T.append_history(registry.promotion_event(spark, "m", 4, DAY, 2), f"{base}/events")
    run([5])
    got = {r["transaction_id"]: (r["model_version"], r["fraud_proba"]) for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {1: (3, 0.3), 2: (3, 0.3), 3: (3, 0.3), 5: (4, 0.4)}
    assert loads[-1] == 4 and set(loads) == {3, 4}
