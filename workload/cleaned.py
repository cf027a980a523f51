"""Queries on sources, sinks, the cleaned layer and column expressions."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions import dates as D
from ledgerlight.functions import scalars as S
from ledgerlight.operators import clean, risk, scoring
from ledgerlight.operators.alerts import RESULT_FIELDS
from ledgerlight.plans import features as feat
from ledgerlight.plans import silver
from ledgerlight.session import materialise, scratch_root
from ledgerlight.sources import tables as T
from ledgerlight.sources.schemas import schema_of
from workload.registry import VIEWS, day, query, r, rs, tidy, ts
from workload.tables import bank, given

AS_OF_TEXT = "2026-01-01"


def as_of():
    return F.lit(AS_OF_TEXT).cast("date")


def clients_silver(spark, sf) -> DataFrame:
    return silver.clients(bank(spark, sf, "clients"), as_of())


def accounts_silver(spark, sf) -> DataFrame:
    return silver.accounts(bank(spark, sf, "comptes"), as_of())


#: Columns of the cleaned table for which the test tables have no source.
NO_SOURCE = {
    "categorie", "sous_categorie", "reference_transaction", "libelle", "merchant_id", "code_mcc", "nom_marchand",
    "numero_carte_masque", "terminal_id", "solde_avant", "solde_apres", "latitude", "longitude",
}
SILVER_COLUMNS = tuple(c for c in silver.TRANSACTION_COLUMNS if c not in NO_SOURCE)


def transactions_silver(spark, sf, columns=SILVER_COLUMNS) -> DataFrame:
    return silver.transactions(
        bank(spark, sf, "transactions"), clients_silver(spark, sf), accounts_silver(spark, sf), columns
    )


def features(spark, sf) -> DataFrame:
    rows = transactions_silver(spark, sf, (*SILVER_COLUMNS, *feat.CUSTOMER_COLUMNS))
    return feat.feature_table(rows, clients_silver(spark, sf))


def scratch(spark: SparkSession, what: str) -> str:
    return f"{scratch_root(spark)}/{what}-{uuid.uuid4().hex}"


def conform(df: DataFrame, entity: str) -> DataFrame:
    """All columns of a source file, in order; those the stand-in lacks are null."""
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema_of(entity).fields
        ]
    )


# --- derived tables of the check queries -------------------------------------

VIEWS["silver_clients"] = f"""
    select * exclude (nom, prenom),
        cast(floor(date_diff('day', date_naissance, date '{AS_OF_TEXT}') / 365.25) as bigint) as age,
        cast(floor(date_diff('day', date_premier_contact, date '{AS_OF_TEXT}') / 365.25) as bigint) as anciennete_annees,
        case when revenu_mensuel < 5000 then '0-5k' when revenu_mensuel < 15000 then '5k-15k'
            when revenu_mensuel < 30000 then '15k-30k' when revenu_mensuel < 50000 then '30k-50k' else '50k+' end as tranche_revenu,
        case when statut_client = 'Actif' then 1 else 0 end as statut_client_binaire,
        case when type_client = 'Particulier' then coalesce(civilite, '') || ' ' || coalesce(prenom, '') || ' ' || coalesce(nom, '')
            when type_client = 'Entreprise' then coalesce(raison_sociale, nom) else nom end as nom_complet
    from clients
"""
VIEWS["silver_comptes"] = f"""
    select *, date_diff('day', date_ouverture, date '{AS_OF_TEXT}') / 30.44 as mois_bruts,
        case when statut_compte = 'Actif' then 1 else 0 end as est_actif,
        case when type_compte = 'Compte épargne' then solde / 1000 else solde / 10000 end as solde_normalise
    from comptes
"""
VIEWS["behaviour"] = """
    select *,
        coalesce(avg(montant) over prev, 0.0) as montant_moyen_client_30j,
        coalesce(stddev_samp(montant) over prev, 0.0) as ecart_type_client_30j,
        count(transaction_id) over prev as nb_transactions_client_30j,
        sum(montant) over (partition by client_id order by date_transaction, transaction_id
            rows between unbounded preceding and current row) as montant_cumule_client
    from transactions
    window prev as (partition by client_id order by date_transaction, transaction_id rows between 30 preceding and 1 preceding)
"""
VIEWS["silver_transactions"] = """
    select b.*, case when montant_moyen_client_30j <> 0
            then (montant - montant_moyen_client_30j) / montant_moyen_client_30j else 0.0 end as ecart_relatif_montant,
        k.compte_id, k.type_compte, c.age, c.ville, c.segment_client, c.tranche_revenu, c.revenu_mensuel,
        cast(dayofweek(date_transaction) + 1 as int) as jour_semaine, strftime(date_transaction, '%Y-%m') as mois_annee,
        cast(substr(heure_transaction, 1, 2) as int) as heure,
        case when substr(heure_transaction, 1, 2) < '06' then 'Nuit' when substr(heure_transaction, 1, 2) < '12' then 'Matin'
            when substr(heure_transaction, 1, 2) < '18' then 'Après-midi' else 'Soir' end as tranche_horaire,
        case when pays_marchand <> 'MA' then 1 when pays_destination <> 'MA' then 1 else 0 end as est_international,
        case when ville_transaction <> c.ville then 1 else 0 end as hors_agence,
        coalesce(compte_source_id, compte_destination_id) as compte_touche,
        case when compte_source_id is not null and compte_destination_id is null then 'Débit'
            when compte_source_id is null and compte_destination_id is not null then 'Crédit'
            when compte_source_id is not null then 'Virement interne' else 'Autre' end as sens_operation
    from behaviour b left join silver_clients c on b.client_id = c.client_id
        left join silver_comptes k on b.compte_source_id = k.compte_id
"""
VIEWS["feature_rows"] = """
    select t.transaction_id, t.client_id, t.compte_touche, t.agence_id, t.heure, t.tranche_horaire, t.jour_semaine,
        t.is_weekend, t.is_night, t.montant, t.frais_transaction, t.type_transaction, t.canal, t.mode_paiement,
        t.est_international, t.hors_agence, t.sens_operation, t.device_id, t.ip_address, t.montant_moyen_client_30j,
        t.ecart_type_client_30j, t.nb_transactions_client_30j, t.ecart_relatif_montant, t.montant_cumule_client, t.age,
        t.segment_client, t.tranche_revenu, t.revenu_mensuel, c.score_credit, c.niveau_risque_client, t.fraud_flag,
        case when t.revenu_mensuel <> 0 then t.montant / t.revenu_mensuel else 0.0 end as ratio_montant_revenu,
        case when montant_moyen_client_30j <> 0 then montant / montant_moyen_client_30j else 1.0 end as taux_utilisation_30j
    from silver_transactions t left join clients c on t.client_id = c.client_id
"""
BEHAVIOUR_DOUBLES = (
    "montant_moyen_client_30j", "ecart_type_client_30j", "ecart_relatif_montant", "montant_cumule_client",
)


# --- sources and sinks -------------------------------------------------------

@query(
    "csv_round_trip",
    f"""select cast(transaction_id as varchar) as transaction_id, client_id, heure_transaction, montant, canal,
        mode_paiement, {ts('date_transaction')}, is_night, fraud_flag, fraud_type from transactions""",
)
def csv_round_trip(spark, sf):
    path = scratch(spark, "csv")
    T.export_csv(conform(bank(spark, sf, "transactions"), "transactions"), path)
    good, _ = T.split_bad_rows(T.read_csv(spark, path, "transactions", keep_bad_rows=True, exported=True))
    return tidy(
        good.select(
            "transaction_id", "client_id", "heure_transaction", "montant", "canal", "mode_paiement",
            "date_transaction", "is_night", "fraud_flag", "fraud_type",
        )
    )


@query(
    "schema_evolution",
    f"""select annee, mois, count(*) as nombre, {r('sum(montant)', 'montant', 2)}, count(canal) as canaux, cast(sum(jour) as bigint) as jours from (
        select cast(year(date_transaction) as int) as annee, cast(month(date_transaction) as int) as mois, montant,
            case when month(date_transaction) % 2 = 0 then canal end as canal, day(date_transaction) as jour from transactions) group by 1, 2""",
)
def schema_evolution(spark, sf):
    """Odd months written without the channel and with a narrower number, even months later with both; all read together."""
    path = scratch(spark, "evolved")
    rows = bank(spark, sf, "transactions").select("transaction_id", "date_transaction", "montant", "canal", F.dayofmonth("date_transaction").alias("jour"))
    rows, even = rows.drop("canal"), rows.withColumn("jour", F.col("jour").cast("long")).filter(F.month("date_transaction") % 2 == 0)
    T.write_monthly(rows, path, "date_transaction")
    T.write_monthly(even, path, "date_transaction")
    out = T.read_monthly(spark, path).groupBy("annee", "mois")
    return tidy(out.agg(F.count(F.lit(1)).alias("nombre"), F.sum("montant").alias("montant"), F.count("canal").alias("canaux"), F.sum("jour").alias("jours")), 2)


@query(
    "monthly_partitions",
    f"""select cast(year(date_transaction) as int) as annee, cast(month(date_transaction) as int) as mois,
        count(*) as nombre, {r('sum(montant)', 'montant', 2)}
        from transactions where date_transaction >= date '1997-02-10' and date_transaction < date '1999-11-06' group by 1, 2""",
)
def monthly_partitions(spark, sf):
    path = scratch(spark, "monthly")
    T.write_monthly(bank(spark, sf, "transactions"), path, "date_transaction")
    rows = T.month_range(T.read_table(spark, path), "date_transaction", "1997-02-10", "1999-11-05")
    return tidy(
        rows.groupBy("annee", "mois").agg(F.count(F.lit(1)).alias("nombre"), F.sum("montant").alias("montant")), 2
    )


@query(
    "metrics_history",
    """select count(*) as lignes, count(lift) as avec_lift, count(roc_auc) as avec_roc,
        cast(count(distinct run_id) as bigint) as runs
        from (select run_id, lift, null as roc_auc from metriques union all select run_id, null, roc_auc from metriques)""",
)
def metrics_history(spark, sf):
    path = scratch(spark, "history")
    rows = bank(spark, sf, "metriques")
    T.append_history(rows.select("run_id", "pr_auc", "lift"), path)
    T.append_history(rows.select("run_id", "pr_auc", "roc_auc"), path)
    # Counting per run first keeps a distinct count out of one task.
    return (
        T.read_history(spark, path)
        .groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count("lift").alias("a"), F.count("roc_auc").alias("b"))
        .agg(
            F.sum("n").alias("lignes"), F.sum("a").alias("avec_lift"), F.sum("b").alias("avec_roc"),
            F.count(F.lit(1)).alias("runs"),
        )
    )


@query("catalogue_copy", f"select agence_id, count(*) as clients, {r('avg(score_credit)', 'score_moyen')} from clients group by 1")
def catalogue_copy(spark, sf):
    database = f"ledger_{uuid.uuid4().hex[:12]}"
    path = scratch(spark, "clients")
    T.write_table(bank(spark, sf, "clients"), path)
    T.register_table(T.read_table(spark, path), database, "clients", scratch(spark, database))
    return tidy(
        T.read_catalogued(spark, f"{database}.clients")
        .groupBy("agence_id")
        .agg(F.count(F.lit(1)).alias("clients"), F.avg("score_credit").alias("score_moyen"))
    )


INVENTORY = ("agences", "clients", "comptes", "transactions", "credits", "classification_creances")


@query(
    "table_inventory",
    " union all ".join(f"select '{t}' as table_name, count(*) as nombre_lignes from {t}" for t in INVENTORY),
)
def table_inventory(spark, sf):
    return T.inventory({t: bank(spark, sf, t) for t in INVENTORY})


# --- cleaned tables ----------------------------------------------------------

@query(
    "silver_branches",
    f"""select agence_id, nom_agence, adresse, ville, code_postal, region, pays, telephone,
        replace(email, '@gmail.com', '@banque.com') as email, directeur, {day('date_ouverture')}, type_agence,
        latitude, longitude from agences""",
)
def silver_branches(spark, sf):
    twice = bank(spark, sf, "agences")
    nameless = twice.withColumn("agence_id", F.lit(None).cast("string"))
    return tidy(silver.branches(twice.unionByName(twice).unionByName(nameless)))


@query(
    "silver_clients",
    f"""select client_id, agence_id, type_client, civilite, raison_sociale, ville, region, {r('revenu_mensuel')},
        score_credit, segment_client, niveau_risque_client, statut_client, age, anciennete_annees, tranche_revenu,
        statut_client_binaire, nom_complet from silver_clients""",
)
def silver_clients_query(spark, sf):
    return tidy(clients_silver(spark, sf).drop("date_naissance", "date_premier_contact", "email"))


@query(
    "silver_accounts",
    f"""select compte_id, type_compte, est_actif, {r('mois_bruts', 'anciennete_compte_mois', 1)}, {r('solde_normalise')}
        from silver_comptes""",
)
def silver_accounts(spark, sf):
    return tidy(
        accounts_silver(spark, sf).select(
            "compte_id", "type_compte", "est_actif", "anciennete_compte_mois", "solde_normalise"
        )
    )


@query(
    "rolling_behaviour",
    f"""select transaction_id, client_id, {rs('montant_moyen_client_30j', 'ecart_type_client_30j')}, nb_transactions_client_30j,
        {r('case when montant_moyen_client_30j <> 0 then (montant - montant_moyen_client_30j) / montant_moyen_client_30j else 0.0 end', 'ecart_relatif_montant')},
        {r('montant_cumule_client', digits=2)} from behaviour""",
)
def rolling_behaviour(spark, sf):
    """Which transactions deviate from the customer's own history (flagship)."""
    narrow = bank(spark, sf, "transactions").select("transaction_id", "client_id", "date_transaction", "montant")
    out = silver.behaviour(narrow).drop("date_transaction", "montant")
    return tidy(out.withColumn("montant_cumule_client", F.round("montant_cumule_client", 2)))


def _days_sql(days: int) -> str:
    return f"""select *, coalesce(avg(montant) over prev, 0.0) as montant_moyen_client_30j,
        coalesce(stddev_samp(montant) over prev, 0.0) as ecart_type_client_30j, count(transaction_id) over prev as nb_transactions_client_30j
        from transactions window prev as (partition by client_id order by date_transaction
            range between interval {days} day preceding and interval 1 microsecond preceding)"""


def _by_days(spark, sf, days: int):
    narrow = bank(spark, sf, "transactions").select("transaction_id", "client_id", "date_transaction", "montant")
    out = silver.behaviour(narrow, days, mode="days").drop("date_transaction", "montant", "montant_cumule_client")
    return tidy(out, 4)


@query(
    "rolling_behaviour_days",
    f"""select transaction_id, client_id, {rs('montant_moyen_client_30j', 'ecart_type_client_30j', digits=4)}, nb_transactions_client_30j,
        {r('case when montant_moyen_client_30j <> 0 then (montant - montant_moyen_client_30j) / montant_moyen_client_30j else 0.0 end', 'ecart_relatif_montant', 4)}
        from ({_days_sql(30)})""",
)
def rolling_behaviour_days(spark, sf):
    """The same features over the 30 days before, as their names promise."""
    return _by_days(spark, sf, 30)


@query(
    "yearly_behaviour",
    f"""select transaction_id, client_id, {rs('montant_moyen_client_30j', 'ecart_type_client_30j', digits=4)}, nb_transactions_client_30j,
        {r('case when montant_moyen_client_30j <> 0 then (montant - montant_moyen_client_30j) / montant_moyen_client_30j else 0.0 end', 'ecart_relatif_montant', 4)}
        from ({_days_sql(365)})""",
)
def yearly_behaviour(spark, sf):
    """The same features over the year before."""
    return _by_days(spark, sf, 365)


@query(
    "silver_transactions",
    f"""select transaction_id, compte_id, client_id, agence_id, {ts('date_transaction')}, compte_touche, sens_operation,
        {ts('date_valeur')}, heure_transaction, heure, tranche_horaire, montant, devise, type_transaction, canal, mode_paiement,
        statut_transaction, pays_marchand, ville_transaction, pays_origine, pays_destination, {r('frais_transaction')},
        ip_address, device_id, is_international, est_international, is_weekend, is_night, fraud_flag, fraud_type,
        fraud_rule_triggered, jour_semaine, mois_annee, age, segment_client, tranche_revenu, {r('revenu_mensuel')}, type_compte,
        {rs('montant_moyen_client_30j', 'ecart_type_client_30j')}, nb_transactions_client_30j, {r('ecart_relatif_montant')},
        {r('montant_cumule_client', digits=2)}, hors_agence from silver_transactions""",
)
def silver_transactions(spark, sf):
    return tidy(
        transactions_silver(spark, sf).withColumn("montant_cumule_client", F.round("montant_cumule_client", 2))
    )


@query("no_nulls_left", "select count(*) as lignes, count(*) as completes from feature_rows")
def no_nulls_left(spark, sf):
    """The cleaned features pass the check that stops the daily run on a null."""
    wanted = [*feat.FEATURES, "score_credit", feat.LABEL]
    rows = clean.assert_no_nulls(materialise(feat.clean_features(features(spark, sf)).select(*wanted)), wanted)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in wanted])
    return rows.agg(F.count(F.lit(1)).alias("lignes"), F.count_if(whole).alias("completes"))


@query(
    "deduplicated_lines",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice from (
        select *, row_number() over (partition by l_orderkey, l_linenumber
            order by l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) as rn
        from lineitem) where rn = 1""",
)
def deduplicated_lines(spark, sf):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    return clean.dedup(
        given(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *order), ["l_orderkey", "l_linenumber"], order
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


VIEWS["heures_lues"] = """
    select *, case when coalesce(trim(heure), '') = '' then 14
        when contains(heure, ':') then try_cast(trim(split_part(trim(heure), ':', 1)) as int)
        else cast(trunc(try_cast(trim(heure) as double)) as int) end as h,
        try_cast(split_part(trim(heure), ':', 2) as int) as minute
    from saisies
"""
VIEWS["heures_jugees"] = """
    select *, case when coalesce(trim(heure), '') = '' then null
        when h is null or (contains(heure, ':') and minute is null) then 'Heure invalide : ' || trim(heure)
        when contains(heure, ':') and minute not between 0 and 59 then 'Minutes invalides : ' || trim(heure)
        when h not between 0 and 23 then 'Heure hors limites (0-23) : ' || trim(heure) end as raison
    from heures_lues
"""


@query("lenient_hours", "select ligne, case when raison is null then h end as heure_lue, raison from heures_jugees")
def lenient_hours(spark, sf):
    parsed = D.lenient_hour("heure")
    return bank(spark, sf, "saisies").select("ligne", parsed["hour"].alias("heure_lue"), parsed["error"].alias("raison"))


VIEWS["saisies_jugees"] = """
    select *, case when try_cast(montant as double) is null then 'Montant invalide : ' || montant
            when try_cast(montant as double) < 0 then 'Montant négatif : ' || montant end as e1,
        case when is_weekend not in ('0', '1') then 'is_weekend hors limites (0-1) : ' || is_weekend end as e3
    from heures_jugees
"""


@query(
    "validated_rows",
    f"""select ligne, {r("try_cast(montant as double)", 'montant')}, coalesce(mode_paiement, 'Carte') as mode_paiement,
        case when raison is null then h end as heure, cast(is_weekend as int) as is_weekend, 0 as est_international,
        concat_ws(' ; ', e1, raison, e3) as erreurs from saisies_jugees""",
)
def validated_rows(spark, sf):
    rows = clean.require_columns(bank(spark, sf, "saisies"), clean.REQUIRED_UPLOAD)
    return tidy(
        clean.validate_rows(rows).select(
            "ligne", "montant", "mode_paiement", "heure", "is_weekend", "est_international",
            F.array_join("errors", " ; ").alias("erreurs"),
        )
    )


# --- feature table -----------------------------------------------------------

FEATURE_SQL = f"""transaction_id, client_id, compte_touche, agence_id, heure, tranche_horaire, jour_semaine, is_weekend, is_night,
    montant, {r('frais_transaction')}, type_transaction, canal, est_international, hors_agence, sens_operation, device_id,
    ip_address, {rs('montant_moyen_client_30j', 'ecart_type_client_30j', 'ecart_relatif_montant')}, nb_transactions_client_30j,
    {r('montant_cumule_client', digits=2)}, segment_client, tranche_revenu, {r('revenu_mensuel')}, fraud_flag,
    {rs('ratio_montant_revenu', 'taux_utilisation_30j')}"""


def tidy_features(df: DataFrame) -> DataFrame:
    return tidy(
        df.drop("date_transaction").withColumn("montant_cumule_client", F.round("montant_cumule_client", 2))
    )


@query(
    "feature_table",
    f"select {FEATURE_SQL}, mode_paiement, age, score_credit, niveau_risque_client from feature_rows",
)
def feature_table(spark, sf):
    return tidy_features(features(spark, sf))


@query(
    "clean_features",
    f"""select {FEATURE_SQL}, coalesce(mode_paiement, 'Non_applicable') as mode_paiement,
        case when age is null then 1 else 0 end as age_manquant,
        {r('coalesce(age, (select quantile_cont(age, 0.5) from feature_rows))', 'age')}, cast(score_credit as double) as score_credit,
        coalesce(niveau_risque_client, 'Inconnu') as niveau_risque_client from feature_rows""",
)
def clean_features(spark, sf):
    # The medians are a pass of their own, so the joins and windows are written once.
    return tidy_features(feat.clean_features(materialise(features(spark, sf))))


@query(
    "payment_mode_by_type",
    """select type_transaction, count(*) filter (mode_paiement is null) as absent, count(mode_paiement) as renseigne
        from transactions group by 1""",
)
def payment_mode_by_type(spark, sf):
    return feat.missing_by_type(bank(spark, sf, "transactions"))


# --- column expressions ------------------------------------------------------

@query(
    "score_verdicts",
    f"""select transaction_id, {r('fraud_proba * 100', 'pourcentage', 2)},
        case when fraud_proba >= 0.5 then 'FRAUDE' else 'NORMAL' end as decision,
        case when fraud_proba >= 0.8 then 'Très élevé' when fraud_proba >= 0.5 then 'Élevé' when fraud_proba >= 0.2 then 'Moyen'
            else 'Faible' end as niveau_risque, fraud_proba >= 0.5 as est_fraude from scores""",
)
def score_verdicts(spark, sf):
    rows = scoring.verdict(bank(spark, sf, "scores"))
    return tidy(rows.select("transaction_id", "pourcentage", "decision", "niveau_risque", "est_fraude"), 2)


@query(
    "customer_bands",
    """select client_id, lower(trim(email)) as email,
        case when score_credit >= 750 then 'Faible' when score_credit >= 650 then 'Moyen' else 'Élevé' end as risque,
        case when type_client = 'Entreprise' then 'PME' when revenu_mensuel > 30000 then 'Particuliers aisés'
            else 'Particuliers standard' end as segment from clients""",
)
def customer_bands(spark, sf):
    return bank(spark, sf, "clients").select(
        "client_id", S.normalised("email").alias("email"), S.credit_risk_level("score_credit").alias("risque"),
        S.customer_segment("type_client", "revenu_mensuel").alias("segment"),
    )


@query(
    "bare_features",
    f"""select transaction_id, case when type_transaction = 'Paiement' then round(montant * 0.005, 2) else 0.0 end as frais_transaction,
        0.0::double as ecart_relatif_montant, 0.0::double as ratio_montant_revenu, 1.0::double as taux_utilisation_30j,
        montant as montant_moyen_client_30j, 0.0::double as ecart_type_client_30j, 5 as nb_transactions_client_30j,
        montant as montant_cumule_client,
        case when type_transaction in ('Paiement', 'Retrait', 'Prélèvement') then 'Débit' else 'Crédit' end as sens_operation,
        case when hour(created_at) < 6 then 'Nuit' when hour(created_at) < 12 then 'Matin' when hour(created_at) < 18
            then 'Après-midi' else 'Soir' end as tranche_horaire,
        case when hour(created_at) < 6 or hour(created_at) >= 22 then 1 else 0 end as is_night from scores""",
)
def bare_features(spark, sf):
    rows = bank(spark, sf, "scores").select(
        "transaction_id", "montant", "type_transaction", F.hour("created_at").alias("heure")
    )
    return scoring.bare_features(rows).drop("montant", "type_transaction", "heure")


@query(
    "annuities",
    f"""select credit_id,
        {r('montant_initial * taux_interet_nominal / 12 / (1 - pow(1 + taux_interet_nominal / 12, -duree_totale_mois))', 'mensualite', 2)},
        {r('greatest(0.0, montant_initial * (1 - nombre_echeances_payees / duree_totale_mois))', 'restant', 2)},
        greatest(0, duree_totale_mois - nombre_echeances_payees) as mois_restants from credits""",
)
def annuities(spark, sf):
    return tidy(
        bank(spark, sf, "credits").select(
            "credit_id",
            S.annuity("montant_initial", "taux_interet_nominal", "duree_totale_mois").alias("mensualite"),
            risk.remaining_principal("montant_initial", "nombre_echeances_payees", "duree_totale_mois").alias("restant"),
            risk.remaining_months("duree_totale_mois", "nombre_echeances_payees").alias("mois_restants"),
        ), 2,
    )


@query(
    "json_payloads",
    """select transaction_id, cast(props->>'$.k' as bigint) as k,
        '{"montant":' || cast(transaction_id as varchar) || ',"type_transaction":"' || type_transaction || '"}' as charge
        from scores""",
)
def json_payloads(spark, sf):
    return bank(spark, sf, "scores").select(
        "transaction_id", S.json_object("props", "k long")["k"].alias("k"),
        S.json_text(F.col("transaction_id").alias("montant"), "type_transaction").alias("charge"),
    )


@query(
    "import_counts",
    """select import_id,
        case when json_valid(results) then cast(json_array_length(results) as int) else 0 end as lignes,
        case when json_valid(results) then cast(len(list_filter(json_extract_string(results, '$[*].decision'),
            lambda d: d = 'FRAUDE')) as int) else 0 end as fraudes from imports""",
)
def import_counts(spark, sf):
    rows = S.json_rows("results", RESULT_FIELDS)
    return bank(spark, sf, "imports").select(
        "import_id", F.size(rows).alias("lignes"), S.decided_rows(rows).alias("fraudes")
    )
