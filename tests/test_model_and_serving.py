"""Split, encoder, importance, registry, scoring, alerts and streams."""

import datetime as dt
import hashlib
import inspect
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import alerts, model, ranks, registry, scoring
from ledgerlight.operators.quality import require_encoder_match, unknown_codes
from ledgerlight.plans import star
from ledgerlight.streaming import scored_stream as stream

NOON = dt.datetime(2026, 1, 1, 12)


def test_split_sizes(spark):
    df = spark.range(1003).withColumn("y", (F.col("id") % 50 == 0).cast("int"))
    parts = model.stratified_split(df, "id", "y")
    got = {(r["y"], r["partie"]): r["count"] for r in parts.groupBy("y", "partie").count().collect()}
    assert got == {(0, "test"): 197, (0, "train"): 785, (1, "test"): 4, (1, "train"): 17}
    again = {r["id"] for r in model.stratified_split(df.repartition(7), "id", "y").filter("partie = 'test'").collect()}
    assert again == {r["id"] for r in parts.filter("partie = 'test'").collect()}


def test_split_counts_far_fewer_prefixes_than_rows(spark, monkeypatch):
    written = []
    monkeypatch.setattr(model, "materialise", lambda df, keep=model.materialise: written.append(keep(df)) or written[-1])
    df = spark.range(200_000).withColumn("y", F.lit(0))
    got = {r["id"] for r in model.stratified_split(df, "id", "y").filter("partie = 'test'").collect()}
    order = sorted(range(200_000), key=lambda k: (hashlib.md5(f"{k}:{model.SEED}".encode()).hexdigest(), k))
    assert got == set(order[:40_000])
    assert [w.count() <= most for w, most in zip(written, (16**4, 1), strict=True)] == [True, True]


def test_split_quota_is_exact():
    assert model.test_sizes({0: 98, 1: 2}) == {0: 20, 1: 0} or sum(model.test_sizes({0: 98, 1: 2}).values()) == 20
    assert sum(model.test_sizes({0: 7, 1: 4, 2: 2}).values()) == 3


def test_encoder(spark):
    train = spark.createDataFrame([("b",), ("é",), ("a",), (None,), ("b",)], "c string")
    encoder = model.fit_encoder(train, ["c"])
    assert [(r["modalite"], r["code"]) for r in model.encoder_values(encoder).collect()] == [("Inconnu", 0.0), ("a", 1.0), ("b", 2.0), ("é", 3.0)]
    new = spark.createDataFrame([(1, "b"), (2, "zz"), (3, None)], "i int, c string")
    coded = model.apply_encoder(new, encoder, ["c"])
    assert [r["c"] for r in coded.orderBy("i").collect()] == [2.0, -1.0, 0.0]
    assert unknown_codes(coded, ["c"]).first()["inconnues"] == 1
    with pytest.raises(ValueError):
        require_encoder_match(["c", "d"], ["c"])


def test_trees_beat_the_baseline(spark):
    rng = random.Random(1)
    rows = []
    for i in range(800):
        y = int(rng.random() < 0.15)
        rows.append((i, y, rng.gauss(2.0 * y, 1), rng.random(), None if i % 9 else 1.0))
    df = spark.createDataFrame(rows, "id int, y int, good double, noise double, gap double")
    fitted = model.fit_model(df, ["good", "noise", "gap"], "y", max_iter=3, max_depth=3)
    scored = model.add_probability(df, fitted)
    assert scored.filter("fraud_proba between 0 and 1").count() == 800
    assert scored.filter("gap is null").count() == df.filter("gap is null").count()
    got = ranks.curve_summary(ranks.score_curve(scored, "y", "fraud_proba")).first()
    assert got["lift"] > 2
    importance = model.permutation_importance(
        df.drop("gap").withColumn("gap", F.lit(0.0)), lambda d: model.add_probability(d, fitted), ["good", "noise", "gap"], "id", "y"
    ).collect()
    assert importance[0]["feature"] == "good" and importance[0]["importance_mean"] > 0.1
    assert {r["feature"]: r["importance_mean"] for r in importance}["gap"] == pytest.approx(0.0)


def test_queries_train_the_full_model(monkeypatch):
    from workload import models

    calls, given = [], inspect.signature(model.fit_model)
    monkeypatch.setattr(model, "fit_model", lambda *a, **b: calls.append(given.bind(*a, **b)))
    monkeypatch.setattr(model, "fit_encoder", lambda *a: None)
    monkeypatch.setattr(model, "apply_encoder", lambda df, *a: df)
    monkeypatch.setattr(scoring, "model_scorer", lambda *a: None)
    models.trained("rows")
    calls[0].apply_defaults()
    assert calls[0].arguments["max_iter"] == 300 and calls[0].arguments["max_depth"] == 6 and calls[0].arguments["train"] == "rows"


def test_importance_matches_brute_force(spark):
    """The same shuffle done by hand on a small table gives the same loss."""
    rng = random.Random(4)
    rows = [(i, rng.randrange(2), round(rng.random(), 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, y int, x double")
    got = model.permutation_importance(df, lambda d: d.withColumn("fraud_proba", F.col("x")), ["x"], "id", "y", repeats=3).first()

    def ap(pairs):
        pos = sum(y for y, _ in pairs)
        out = 0.0
        for t in {s for _, s in pairs}:
            hit = [y for y, s in pairs if s >= t]
            out += sum(y for y, s in pairs if s == t) / pos * sum(hit) / len(hit)
        return out

    losses = []
    for essai in range(3):
        number = model.permuted(F.col("i"), 40, F.lit(f"42:x:{essai}"))
        numbered = df.withColumn("h", model.shuffle_key("id")).orderBy("h", "id").select("y", "x").collect()
        to = [r[0] for r in spark.range(40).select(F.col("id").alias("i")).orderBy("i").select(number).collect()]
        losses.append(ap([tuple(r) for r in numbered]) - ap([(numbered[i]["y"], numbered[to[i]]["x"]) for i in range(40)]))
    mean = sum(losses) / 3
    assert got["importance_mean"] == pytest.approx(mean)
    assert got["importance_std"] == pytest.approx((sum((v - mean) ** 2 for v in losses) / 3) ** 0.5)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40, 97, 1000, 2503])
def test_permutations_are_bijections(spark, n):
    a, b = model.permutation_sides(n)
    assert n <= a * b
    one, two = (F.lit(k) for k in ("k", "l"))
    got = spark.range(n).orderBy("id").select(model.permuted(F.col("id"), n, one), model.permuted(F.col("id"), n, two)).collect()
    first = [r[0] for r in got]
    assert sorted(first) == list(range(n)) and sorted(r[1] for r in got) == list(range(n))
    if n >= 1000:
        steps = {(y - x) % n for x, y in zip(first, first[1:])}
        assert len(steps) > n / 3 and first != [r[1] for r in got]       # neighbours part, keys differ
        assert sum(x == y for x, y in enumerate(first)) < 10             # about one fixed point is expected


def test_registry(spark):
    versions = spark.createDataFrame(
        [("m", v, f"r{v}", None, None, dt.datetime(2026, 1, v)) for v in (2, 9, 10)],
        "model string, version int, run_id string, run_name string, user string, date timestamp",
    )
    metrics = spark.createDataFrame([("r2", 0.7, 0.9, 53.0), ("r9", 0.1, 0.5, 1.5), ("r10", 0.3, 0.6, 1.9)], "run_id string, pr_auc double, roc_auc double, lift double")
    events = registry.gate_events(versions, metrics)
    assert registry.resolve_champion(versions, events, "m") == 2
    rows = registry.version_list(versions, metrics, events).collect()
    assert [(r["version"], r["alias"], r["run_name"], r["user"]) for r in rows] == [(10, "challenger", "—", "inconnu"), (9, "—", "—", "inconnu"), (2, "champion", "—", "inconnu")]
    promoted = events.unionByName(registry.promotion_event(spark, "m", 9, dt.datetime(2026, 2, 1), 99))
    assert registry.resolve_champion(versions, promoted, "m") == 9
    no_champion = events.filter("alias <> 'champion'")
    assert registry.resolve_champion(versions, no_champion, "m") == 10
    gone = promoted.unionByName(registry.promotion_event(spark, "m", 77, dt.datetime(2026, 3, 1), 100))
    assert registry.resolve_champion(versions, gone, "m") == 10
    with pytest.raises(ValueError):
        registry.resolve_champion(versions, events, "other")


def test_bare_features(spark):
    df = spark.createDataFrame([(100.0, "Retrait", 3), (999.0, "Virement", 14), (1234.0, "Paiement", 23)], "montant double, type_transaction string, heure int")
    got = [r.asDict() for r in scoring.bare_features(df).collect()]
    assert [(g["is_night"], g["sens_operation"], g["tranche_horaire"]) for g in got] == [(1, "Débit", "Nuit"), (0, "Crédit", "Après-midi"), (1, "Débit", "Soir")]
    assert [g["frais_transaction"] for g in got] == [0.0, 0.0, 6.17]
    assert (got[0]["nb_transactions_client_30j"], got[0]["taux_utilisation_30j"], got[0]["montant_moyen_client_30j"]) == (5, 1.0, 100.0)


def scorer(rows):
    return rows.withColumn("fraud_proba", F.col("montant") / 1000)


def test_upload(spark):
    raw = spark.createDataFrame(
        [("950", "Retrait", None, "3"), ("80", "Virement", "Carte", ""), ("abc", "Paiement", "Carte", "12"), ("-1", "Paiement", "Carte", "25")],
        "montant string, type_transaction string, mode_paiement string, heure string",
    )
    got = {r["montant"]: r for r in scoring.score_upload(raw, scorer).collect()}
    assert (got["950"]["decision"], got["950"]["niveau_risque"], got["950"]["score"]) == ("FRAUDE", "Très élevé", 0.95)
    assert (got["80"]["decision"], got["80"]["niveau_risque"]) == ("NORMAL", "Faible")
    assert got["abc"]["decision"] == "ERREUR" and got["abc"]["score"] is None
    assert "négatif" in got["-1"]["niveau_risque"] and "Heure" in got["-1"]["erreurs"] and got["80"]["erreurs"] is None


def test_scores_above(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (2, 0.9, 0), (3, 0.4, 0), (4, 0.5, 1)], "transaction_id int, fraud_proba double, target int")
    got = scoring.scores_above(df, 0.5, 2).collect()
    assert [r["transaction_id"] for r in got] == [1, 2] and [r["actual_label"] for r in got] == [1, 0]
    for bad in ({"threshold": 1.2}, {"limit": 0}, {"limit": 100_001}):
        with pytest.raises(ValueError):
            scoring.scores_above(df, **bad)


def test_alert_states(spark):
    scored = spark.createDataFrame([(1, 7, NOON, 0.95), (2, 7, NOON, 0.6), (3, 8, NOON, 0.7), (4, 8, NOON, 0.1), (5, 9, NOON, 0.9)],
                                   "id int, user int, at timestamp, fraud_proba double")
    made = alerts.fraud_alerts(scored, "id", "user", "at", ["fraud_proba"])
    assert made.count() == 4 and json.loads(made.filter("alert_id = 1").first()["transaction_data"]) == {"fraud_proba": 0.95}
    states = spark.createDataFrame([(1, 7, "lu", NOON), (5, 9, "supprime", NOON)], "alert_id int, user_id int, action string, at timestamp")
    folded = alerts.fold_states(made, states)
    users = spark.createDataFrame([(1,), (1,), (0,)], "actif int")
    assert tuple(alerts.activity_stats(users, folded).first()) == (2, 3, 2, 3)
    everything = spark.createDataFrame([(None, 7, "tout_lu", NOON)], "alert_id int, user_id int, action string, at timestamp")
    counts = {r["user_id"]: r["non_lues"] for r in alerts.unread_counts(alerts.fold_states(made, everything)).collect()}
    assert counts == {7: 0, 8: 1, 9: 1}
    assert [r["alert_id"] for r in alerts.latest_alerts(folded, 1, user=7).collect()] == [2]


def test_imports(spark):
    results = json.dumps([{"montant": 1.0, "decision": "FRAUDE"}, {"montant": 2.0, "decision": "NORMAL"}])
    df = spark.createDataFrame([(1, 7, "a.csv", results, NOON), (2, 7, "b.csv", "pas du json", NOON)],
                               "import_id int, user_id int, filename string, results string, created_at timestamp")
    got = [(r["import_id"], r["lignes"], r["fraudes"]) for r in alerts.import_history(df).orderBy("rang").collect()]
    assert got == [(2, 0, 0), (1, 2, 1)]


def test_loan_join_adds_no_rows(spark):
    loan = {c: "x" for c in star.LOAN_COLUMNS if c not in ("date_key", "credit_id")}
    loans = spark.createDataFrame([{**loan, "credit_id": c, "date_octroi": dt.date(2024, 1, 2)} for c in ("A", "B")])
    row = {c: "1" for c in star.CLASSIFICATION_COLUMNS}
    versions = spark.createDataFrame(
        [{**row, "credit_id": "A", "classification_id": i, "date_classification": d, "categorie_reglementaire": k}
         for i, d, k in (("1", dt.date(2024, 1, 1), "old"), ("2", dt.date(2025, 1, 1), "new"))]
    )
    got = {r["credit_id"]: r["categorie_reglementaire"] for r in star.fact_credits(loans, versions).collect()}
    assert got == {"A": "new", "B": None}


def test_stream_restart_and_duplicates(spark, tmp_path):
    schema = "transaction_id long, user_id long, created_at timestamp, montant double, type_transaction string, mode_paiement string, heure int"
    folder, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def deliver(ids):
        rows = [(i, 1, NOON + dt.timedelta(seconds=i), 900.0 if i % 2 else 10.0, "Retrait", "Carte", 3) for i in ids]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(folder)

    def run():
        rows = stream.scored(stream.incoming(spark, folder, schema), scorer)
        made = stream.alert_stream(rows, "transaction_id", "user_id", "created_at", ["montant"])
        stream.write_stream(made, out, progress).awaitTermination()
        return sorted(r["alert_id"] for r in spark.read.parquet(out).collect())

    deliver(range(6))
    assert run() == [1, 3, 5]
    assert run() == [1, 3, 5]
    deliver([3, 5, 7])
    assert run() == [1, 3, 5, 7]
    deliver([-86399])          # a day before the others, and long after them
    assert run() == [-86399, 1, 3, 5, 7]


def test_rounds_as_columns_are_the_permutation(spark):
    for n in (1, 2, 40, 1001, 5000):
        rows = spark.range(n).withColumn("_n", F.concat(F.lit("42:x:"), (F.col("id") % 2).cast("string")))
        for key in ("_n", "fixed"):
            keyed = rows.withColumn("fixed", F.lit("42:y:0"))
            got = model.add_permuted(keyed, "to", "id", n, key)
            assert got.columns == [*keyed.columns, "to"]
            got = got.withColumn("want", model.permuted(F.col("id"), n, F.col(key))).collect()
            assert all(r["to"] == r["want"] for r in got) and len(got) == n
        assert sorted(r["to"] for r in got) == list(range(n))


def test_moves_by_tables_are_the_permutation(spark):
    for n in (1, 2, 40, 1001, 5000):
        moves = model.move_tables(n, ["42:x:0", "42:x:1"])
        got = [model.permuted_by(m, np.arange(n), n) for m in moves]
        rows = spark.range(n).orderBy("id").select(*[model.permuted(F.col("id"), n, F.lit(f"42:x:{k}")) for k in (0, 1)]).collect()
        assert [[r[k] for r in rows] for k in (0, 1)] == [g.tolist() for g in got]


@pytest.mark.parametrize("donor_bytes", [1 << 20, 800])
def test_trees_score_copies_as_the_scorer_scores_permuted_rows(spark, monkeypatch, donor_bytes):
    rng = random.Random(5)
    rows = [(i % 390, None if i % 50 == 7 else int(rng.random() < 0.3), None if i % 9 == 0 else rng.random(), rng.choice(["a", "b", None]), float(i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, y int, x double, c string, b double")
    encoder = model.fit_encoder(df, ["c"])
    trees = model.fit_model(model.apply_encoder(df, encoder, ["c"]), ["x", "c", "b"], "y", max_iter=8, min_rows=5)
    scorer = scoring.model_scorer(trees, encoder, ["c"])
    monkeypatch.setattr(model, "DONOR_BYTES", donor_bytes)        # all features at once, or two and one
    monkeypatch.setattr(model, "PACKED", 70)
    seen = []
    monkeypatch.setattr(model, "permuted_copies", lambda *a, f=model.permuted_copies: seen.append(a) or f(*a))
    one = {r["feature"]: r for r in model.permutation_importance(df, scorer, ["b", "x", "c"], "id", "y", repeats=3).collect()}
    assert not seen                                               # no row was copied as a row
    plain = lambda d: scorer(d)
    two = {r["feature"]: r for r in model.permutation_importance(df, plain, ["b", "x", "c"], "id", "y", repeats=3).collect()}
    assert len(seen) == 1 and one.keys() == two.keys() == {"x", "c", "b"}
    for f, r in two.items():
        assert one[f]["importance_mean"] == pytest.approx(r["importance_mean"], abs=1e-12)
        assert one[f]["importance_std"] == pytest.approx(r["importance_std"], abs=1e-12)
    assert max(r["importance_mean"] for r in one.values()) > 0.01
