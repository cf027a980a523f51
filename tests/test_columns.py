"""Column expressions: null rules, edges and fixed labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import dates as D
from ledgerlight.functions import scalars as S
from ledgerlight.operators import clean, joins, profile, quality, risk
from ledgerlight.plans import silver


def column(spark, values, type_, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r["out"] for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def test_income_band_null_is_the_last_one(spark):
    got = column(spark, [0.0, 5000.0, 14999.0, 30000.0, 50000.0, None], "double", S.income_band("v"))
    assert got == ["0-5k", "5k-15k", "5k-15k", "30k-50k", "50k+", "50k+"]


def test_scores(spark):
    got = column(spark, [0.08, 0.2, 0.5, 0.8, 0.95], "double", F.struct(S.decision("v"), S.score_level("v"), S.percent("v")))
    assert [tuple(g) for g in got] == [
        ("NORMAL", "Faible", 8.0), ("NORMAL", "Moyen", 20.0), ("FRAUDE", "Élevé", 50.0),
        ("FRAUDE", "Très élevé", 80.0), ("FRAUDE", "Très élevé", 95.0),
    ]


def test_effect_labels(spark):
    got = column(spark, [0.0, 0.03, 0.1, 0.3], "double", S.effect_label("v"))
    assert got == ["Négligeable", "Faible", "Modéré", "Fort"]


def test_safe_div_defaults(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "a double, b double")
    assert [r["q"] for r in df.select(S.safe_div("a", "b", 9.0).alias("q")).collect()] == [0.5, 9.0, 9.0, None]


def test_hours(spark):
    texts = ["", None, "14", "14.0", "14:32", "25", "12:75", "ab", "-1", " 7 ", "5:", "23:59:10", "nan"]
    got = column(spark, texts, "string", D.lenient_hour("v"))
    assert [g["hour"] for g in got] == [14, 14, 14, 14, 14, None, None, None, None, 7, None, 23, None]
    assert [g["error"] is None for g in got] == [g["hour"] is not None for g in got]
    assert got[5]["error"] == "Heure hors limites (0-23) : 25" and got[6]["error"] == "Minutes invalides : 12:75"


def test_clock_and_bands(spark):
    got = column(spark, ["03:10:00", "06:00:00", "12:00:00", "18:00:00", "22:00:00", "x", None], "string",
                 F.struct(D.hour_of_clock("v"), D.day_band(D.hour_of_clock("v")), D.is_night(D.hour_of_clock("v"))))
    assert [tuple(g) for g in got] == [
        (3, "Nuit", 1), (6, "Matin", 0), (12, "Après-midi", 0), (18, "Soir", 0), (22, "Soir", 1), (None, "Soir", 0), (None, "Soir", 0)
    ]


def test_direction_training_and_serving(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("a", "b"), (None, None)], "s string, t string")
    assert [r["d"] for r in df.select(S.direction("s", "t").alias("d")).collect()] == ["Débit", "Crédit", "Virement interne", "Autre"]
    assert column(spark, ["Retrait", "Virement"], "string", S.direction_by_type("v")) == ["Débit", "Crédit"]


def test_town_and_country_flags(spark):
    df = spark.createDataFrame([("A", "B"), ("A", "A"), (None, "A"), ("A", None)], "x string, y string")
    assert [r["f"] for r in df.select(S.elsewhere_flag("x", "y").alias("f")).collect()] == [1, 0, 0, 0]
    df = spark.createDataFrame([("MA", None), (None, "FR"), ("FR", "MA"), (None, None)], "x string, y string")
    assert [r["f"] for r in df.select(S.abroad_flag("x", "y").alias("f")).collect()] == [0, 1, 1, 0]


def test_mail_domain_is_literal(spark):
    got = column(spark, ["a@gmail.com", "a@gmailxcom", None], "string", S.replace_mail_domain("v", "gmail.com", "banque.com"))
    assert got == ["a@banque.com", "a@gmailxcom", None]


def test_json_rows_survive_bad_text(spark):
    fields = "decision string, score double"
    got = column(spark, ['[{"decision":"FRAUDE"},{"decision":"NORMAL","autre":1}]', "[]", "pas du json", None], "string",
                 F.struct(F.size(S.json_rows("v", fields)), S.decided_rows(S.json_rows("v", fields))))
    assert [tuple(g) for g in got] == [(2, 1), (0, 0), (0, 0), (0, 0)]


def test_ages(spark):
    as_of = F.lit(dt.date(2026, 1, 1))
    got = column(spark, [dt.date(2000, 1, 1), None], "date", F.struct(D.whole_years("v", as_of), D.months_since("v", as_of)))
    assert tuple(got[0]) == (26, 312.0) and tuple(got[1]) == (None, None)


def test_calendar_has_every_day(spark):
    bounds = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2026, 12, 31))], "start date, end date")
    days = D.calendar(bounds).withColumns(D.calendar_columns("date"))
    assert days.count() == 2557
    sunday = days.filter("date = date '2024-09-01'").first()
    assert (sunday["date_key"], sunday["trimestre"], sunday["jour_semaine"], sunday["nom_mois"], sunday["est_weekend"]) == (20240901, 3, 1, "September", 1)


def test_loan_bands(spark):
    days = [0, 30, 89, 90, 180, 181, 360, 361, 400, 9999]
    got = column(spark, days, "int", F.struct(risk.ifrs9_stage("v"), risk.regulatory_category("v"), risk.minimum_provision_rate("v"), risk.loan_status("v")))
    assert [g[1] for g in got] == ["Saine"] * 3 + ["Pré-douteuse"] * 2 + ["Douteuse"] * 2 + ["Compromise"] * 2 + ["Saine"]
    assert [g[0] for g in got][:5] == ["Stage 1", "Stage 2", "Stage 2", "Stage 2", "Stage 3"]
    assert [g[3] for g in got][:6] == ["En cours", "En cours (retard)", "En cours (retard)", "En cours (retard)", "Incident de paiement", "Contentieux"]


def test_liquidity_status_and_series(spark):
    df = spark.createDataFrame([(100.0, 99.0), (100.0, 100.0), (1.0, 1.0)], "a double, b double")
    ok = df.select(risk.global_status(risk.conforms("a"), risk.conforms("b")).alias("s"), risk.alert_colour(risk.conforms("a"), risk.conforms("b")).alias("c"))
    assert [tuple(r) for r in ok.collect()] == [("Surveillance", "Orange"), ("Conforme", "Vert"), ("Non conforme", "Rouge")]
    rows = [("BANQUE", None, 1, 100.0), ("AGENCE", "A", 1, 50.0), ("BANQUE", None, 2, 101.0), ("AGENCE", "A", 2, 50.0), ("AGENCE", "A", 3, 40.0)]
    series = spark.createDataFrame([(f"{n}{a}{d}", n, a, "LCR", d, v, v) for n, a, d, v in rows],
                                   "ratio_id string, niveau_consolidation string, agence_id string, type_ratio string, date_calcul int, lcr_ratio double, nsfr_ratio double")
    got = {(r["niveau_consolidation"], r["date_calcul"]): r["tendance_lcr"] for r in silver.liquidity(series).collect()}
    assert got == {("BANQUE", 1): "Stable", ("BANQUE", 2): "Amélioration", ("AGENCE", 1): "Stable", ("AGENCE", 2): "Stable", ("AGENCE", 3): "Détérioration"}


def test_ledger_is_one_timeline(spark):
    tx = spark.createDataFrame([(1, 1, "A", "B", 30.0), (2, 2, "B", None, 100.0), (3, 3, None, "A", 5.0), (4, 4, "A", "A", 1.0)],
                               "transaction_id int, date_transaction int, compte_source_id string, compte_destination_id string, montant double")
    accounts = spark.createDataFrame([("A", 10.0), ("B", 20.0)], "compte_id string, solde double")
    got = {(r["compte_id"], r["transaction_id"]): (r["solde_avant"], r["solde_apres"])
           for r in risk.running_balance(risk.account_moves(tx), accounts).collect()}
    assert got == {("A", 1): (10.0, -20.0), ("B", 1): (20.0, 50.0), ("B", 2): (50.0, -50.0), ("A", 3): (-20.0, -15.0), ("A", 4): (-15.0, -16.0)}
    assert column(spark, [-50.0, -50.0, 1.0], "double", risk.overdrawn_flag("v", F.lit(49.0))) == [1, 1, 0]


def test_quantile_labels_may_exceed_the_rate(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 2, 2]], "p double")
    got = sorted(r["fraud_flag"] for r in risk.label_by_quantile(df, "p", 0.2).collect())
    assert got == [0, 0, 0, 1, 1]


def test_cleaning(spark):
    df = spark.createDataFrame([(1, 10.0, None), (2, None, "x"), (3, 30.0, "y"), (None, 1.0, "z")], "id int, age double, c string")
    assert clean.drop_null_keys(df, ["id"]).count() == 3
    filled = clean.impute_medians(df.filter("id is not null"), ["age"], {"age": "age_manquant"})
    assert [(r["age"], r["age_manquant"]) for r in filled.orderBy("id").collect()] == [(10.0, 0), (20.0, 1), (30.0, 0)]
    with pytest.raises(ValueError, match="'c': 1"):
        clean.assert_no_nulls(filled)
    with pytest.raises(ValueError, match="banned"):
        clean.keep_columns(df, ["id", "c"], ["c"])
    with pytest.raises(ValueError, match="Colonnes manquantes : heure"):
        clean.require_columns(df, ["id", "heure"])


def test_dedup_is_repeatable(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    assert sorted(tuple(r) for r in clean.dedup(df, ["k"], ["v"]).collect()) == [(1, "a"), (2, "c")]


def test_orphans_agree(spark):
    fact = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    dim = spark.createDataFrame([("a",)], "k string")
    assert joins.orphans(fact, dim, "k").count() == joins.orphan_count_outer(fact, dim, "k").first()["orphelins"] == 2
    strict, lenient = (quality.integrity_check("f", fact, "d", dim, "k", nulls_allowed=n).first() for n in (False, True))
    assert (strict["total"], strict["orphelins"], strict["statut"]) == (4, 2, "À investiguer")
    assert (lenient["orphelins"], lenient["nuls_admis"]) == (1, 1)


def test_uniqueness_and_sanity(spark):
    df = spark.createDataFrame([(1, 0.0, 17.0), (1, 5.0, 50.0), (2, 1.0, 101.0)], "k int, a double, g double")
    got = profile.key_uniqueness(df, "k").first()
    assert (got["lignes"], got["distincts"], got["doublons"]) == (3, 2, 1)
    assert tuple(profile.sanity_counts(df, "k", "a", "g").first()) == (1, 1, 2)


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (9.0,), (None,)], "v double")
    got = profile.describe(df, ["v"]).first()
    assert (got["nombre"], got["moyenne"], got["minimum"], got["maximum"], got["mediane"]) == (4, 3.5, 1.0, 9.0, 2.0)
    assert got["ecart_type"] == pytest.approx(3.696846)
