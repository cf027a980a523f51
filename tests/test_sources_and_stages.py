"""CSV files, partitioned tables and the whole daily run on a small bank."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import registry, risk
from ledgerlight.plans import stages
from ledgerlight.sources import tables as T
from ledgerlight.sources.schemas import COLUMNS, KEYS, schema_of
from workload.cleaned import conform
from workload.tables import bank

SMALL = "/root/testdata/sf0.001"


def test_schemas_cover_all_entities(spark):
    assert set(COLUMNS) == set(KEYS)
    assert all(KEYS[e] in schema_of(e).names for e in COLUMNS)
    with pytest.raises(ValueError):
        schema_of("inconnu")


def test_csv_types_and_bad_rows(spark, tmp_path):
    path = tmp_path / "agences.csv"
    names = ",".join(schema_of("agences").names)
    good = 'AG-1,Agence,"7 rue X, Ville",Ville,20000,R,Maroc,0646913810,a@b.ma,D,2010-03-07,Standard,31.1,-2.6'
    path.write_text(f"{names}\n{good}\nAG-2,N,A,V,pas_un_nombre,R,M,06,e,D,2010-03-07,S,1,1\n", encoding="utf-8")
    ok, bad = T.split_bad_rows(T.read_csv(spark, str(path), "agences", keep_bad_rows=True))
    row = ok.first()
    assert (row["telephone"], row["adresse"], row["date_ouverture"]) == ("0646913810", "7 rue X, Ville", dt.date(2010, 3, 7))
    assert [r["agence_id"] for r in bad.collect()] == ["AG-2"]


def test_monthly_overwrite_keeps_other_months(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 5)), (2, dt.datetime(2024, 2, 5))], "id int, at timestamp")
    T.write_monthly(df, path, "at")
    T.write_monthly(df.filter("id = 2").withColumn("id", F.lit(9)), path, "at")
    assert sorted(r["id"] for r in T.read_table(spark, path).collect()) == [1, 9]
    january = T.month_range(T.read_table(spark, path), "at", "2024-01-01", "2024-01-31")
    assert [r["id"] for r in january.collect()] == [1]
    assert "PartitionFilters: [isnotnull" in january._jdf.queryExecution().toString() or "annee" in january._jdf.queryExecution().executedPlan().toString()


def test_csv_round_trip_keeps_every_character(spark, tmp_path):
    texts = ['Banque "Centre" Rabat', 'a, "b", c', "two\nlines\r\n", "back\\slash\\n", "\\", " edges ", "", None, "é漢"]
    row = {f.name: None for f in schema_of("agences")}
    rows = [row | {"agence_id": str(i), "nom_agence": t} for i, t in enumerate(texts)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema_of("agences"))
    T.export_csv(df, str(tmp_path / "x"))
    good, bad = T.split_bad_rows(T.read_csv(spark, str(tmp_path / "x"), "agences", keep_bad_rows=True, exported=True))
    assert bad.count() == 0 and {r.agence_id: r.nom_agence for r in good.collect()} == dict(zip(map(str, range(9)), texts))


def test_bad_rows_can_be_counted(spark, tmp_path):
    (tmp_path / "x.csv").write_text(",".join(f.name for f in schema_of("agences")) + "\nA,n,a,v,not_a_number,r,p,t,e,d,2020-13-45,Standard,1,2\nB,n,a,v,1,r,p,t,e,d,2020-01-02,Standard,1,2\n")
    good, bad = T.split_bad_rows(T.read_csv(spark, str(tmp_path / "x.csv"), "agences", keep_bad_rows=True))
    assert (good.count(), bad.count()) == (1, 1) and "not_a_number" in bad.first()[T.BAD_ROW]


def test_inventory_is_ordered(spark):
    got = T.inventory({"b": spark.range(3), "a": spark.range(2)}).collect()
    assert [tuple(r) for r in got] == [("a", 2), ("b", 3)]


def test_whole_run(spark, tmp_path):
    files = tmp_path / "files"
    for entity in COLUMNS:
        name = "ratios_bruts" if entity == "ratios_liquidite" else entity
        df = bank(spark, SMALL, name)
        if entity == "ratios_liquidite":
            df = df.withColumns({"lcr_ratio": risk.percent_ratio("hqla", "sorties"), "nsfr_ratio": risk.percent_ratio("stable", "requis"),
                                 "ratio_id": F.concat_ws("-", "agence_id", F.col("date_calcul").cast("string"))})
        T.export_csv(conform(df, entity), str(files / f"{entity}.csv"))
    run = stages.Run(spark, str(files), str(tmp_path / "base"), F.lit("2026-01-01").cast("date"), dt.datetime(2026, 1, 1), max_iter=2, exported=True, minimum_lift=0.0)
    stages.run_all(run)
    n = bank(spark, SMALL, "transactions").count()
    assert run.read("gold", "fact_transactions").count() == run.read("ml", "scores").count() == n
    assert run.read("gold", "fact_credits").count() == bank(spark, SMALL, "credits").count()
    assert run.read("ml", "scores").filter("fraud_proba is null").count() == 0
    assert not {"fraud_type", "fraud_rule_triggered"} & set(run.read("gold", "features").columns)
    assert not {"nom", "prenom"} & set(run.read("silver", "clients").columns)
    metrics = T.read_history(spark, run.path("ml", "metrics")).first()
    assert metrics["n_features"] == 16 and metrics["n_train"] + metrics["n_test"] == n

    # A weak run adds a version and leaves the champion; a stronger one replaces it.
    def scored_by(minimum_lift, day):
        run.minimum_lift, run.at = minimum_lift, dt.datetime(2026, 1, day)
        stages.train(run)
        stages.to_scores(run)
        return {r.model_version for r in run.read("ml", "scores").select("model_version").distinct().collect()}

    assert scored_by(1e9, 2) == {1} and scored_by(0.0, 3) == {3}
    aliases = {(r.alias, r.version) for r in registry.alias_holders(run.history("events", registry.EVENT_SCHEMA)).collect()}
    assert aliases == {("champion", 3), ("challenger", 2)}
