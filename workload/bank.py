"""Queries on joins, aggregates, windows, quality, risk, star schema and measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions import dates as D
from ledgerlight.operators import alerts, joins, profile, quality, risk, scoring, sketches
from ledgerlight.operators.ordered import latest_n
from ledgerlight.plans import features as feat
from ledgerlight.plans import silver, star
from ledgerlight.session import materialise
from ledgerlight.sources import tables
from workload.cleaned import clients_silver, features, scratch, transactions_silver
from workload.registry import VIEWS, day, query, r, rs, tidy, ts
from workload.tables import bank, given


# --- joins -------------------------------------------------------------------

def some_customers(spark, sf) -> DataFrame:
    """All customers, those of one segment under other keys, so that orphans exist."""
    return renamed(bank(spark, sf, "clients"), "client_id", F.col("segment_client") == "BUILDING")


def renamed(df: DataFrame, key: str, rows) -> DataFrame:
    return df.withColumn(key, F.when(rows, F.concat(F.lit("ANCIEN-"), key)).otherwise(F.col(key)))


ORPHANS = """select count(*) as orphelins from transactions t
    where not exists (select 1 from clients c where c.client_id = t.client_id and segment_client <> 'BUILDING')"""


@query("orphans_anti_join", ORPHANS)
def orphans_anti_join(spark, sf):
    lost = joins.orphans(bank(spark, sf, "transactions"), some_customers(spark, sf), "client_id")
    return lost.agg(F.count(F.lit(1)).alias("orphelins"))


@query("orphans_outer_join", ORPHANS)
def orphans_outer_join(spark, sf):
    return joins.orphan_count_outer(bank(spark, sf, "transactions"), some_customers(spark, sf), "client_id")


@query(
    "accounts_with_clients",
    """select k.compte_id, c.client_id, c.type_client, k.type_compte from comptes k join clients c on k.client_id = c.client_id
        where c.segment_client <> 'BUILDING'""",
)
def accounts_with_clients(spark, sf):
    pair = joins.matched(
        bank(spark, sf, "comptes").select("client_id", "compte_id", "type_compte"),
        some_customers(spark, sf).select("client_id", "type_client"), "client_id",
    )
    return pair.select("compte_id", "client_id", "type_client", "type_compte")


@query(
    "overdraft_lookup",
    f"""select transaction_id, {r('coalesce(k.decouvert_autorise, 0)', 'decouvert_autorise')} from transactions t
        left join comptes k on t.compte_source_id = k.compte_id""",
)
def overdraft_lookup(spark, sf):
    rows = bank(spark, sf, "transactions").select("transaction_id", "compte_source_id")
    out = joins.lookup(rows, "compte_source_id", bank(spark, sf, "comptes"), "compte_id", "decouvert_autorise", 0.0)
    return out.select("transaction_id", "decouvert_autorise")


CATEGORY_SQL = """case when jours_retard between 0 and 89 then 'Saine' when jours_retard between 90 and 180 then 'Pré-douteuse'
    when jours_retard between 181 and 360 then 'Douteuse' when jours_retard between 361 and 3650 then 'Compromise' else 'Saine' end"""


@query(
    "banded_amounts",
    """select transaction_id, case when montant <= haut then palier end as palier, case when montant <= haut then palier end as par_blocs
        from transactions t asof left join (select c_custkey as palier, c_custkey * 300.0::double as bas, c_custkey * 300.0::double + 200 as haut
            from customer) p on t.montant >= p.bas""",
)
def banded_amounts(spark, sf):
    """Bands from a table with gaps, one per customer key; searched in one array and in blocks."""
    low = F.col("c_custkey") * F.lit(300.0)
    bands = given(spark, sf, "customer").select(F.col("c_custkey").alias("palier"), low.alias("bas"), (low + 200).alias("haut"))
    rows = bank(spark, sf, "transactions").select("transaction_id", "montant")
    out = joins.band_join(rows, "montant", bands, "bas", "haut", ["palier"])
    again = joins.band_join(out, "montant", bands.withColumnRenamed("palier", "par_blocs"), "bas", "haut", ["par_blocs"], block=64)
    return again.select("transaction_id", "palier", "par_blocs")


@query(
    "loan_categories",
    f"""select categorie, taux, count(*) as nombre, cast(min(jours_retard) as int) as du, cast(max(jours_retard) as int) as au from (
        select jours_retard, {CATEGORY_SQL} as categorie, case {CATEGORY_SQL} when 'Pré-douteuse' then 0.2::double
            when 'Douteuse' then 0.5::double when 'Compromise' then 1.0::double else 0.0::double end as taux
        from classification_creances) group by 1, 2""",
)
def loan_categories(spark, sf):
    days = bank(spark, sf, "classification_creances").select("jours_retard")
    return (
        days.groupBy(
            risk.regulatory_category("jours_retard").alias("categorie"),
            risk.minimum_provision_rate("jours_retard").alias("taux"),
        )
        .agg(F.count(F.lit(1)).alias("nombre"), F.min("jours_retard").alias("du"), F.max("jours_retard").alias("au"))
    )


@query(
    "missing_foreign_keys",
    """select lien, count(*) as cles from (
        select distinct 'source' as lien, compte_source_id as cle from transactions where compte_source_id is not null
            and compte_source_id not in (select compte_id from comptes)
        union all select distinct 'destination', compte_destination_id from transactions where compte_destination_id is not null
            and compte_destination_id not in (select compte_id from comptes)
        union all select distinct 'client', client_id from transactions where client_id not in (select client_id from clients
            where segment_client <> 'BUILDING')
        union all select distinct 'credit', credit_id from classification_creances where credit_id not in (select credit_id from credits)
        ) group by 1""",
)
def missing_foreign_keys(spark, sf):
    accounts = bank(spark, sf, "comptes")
    moves = joins.missing_links(
        bank(spark, sf, "transactions"),
        {
            "source": ("compte_source_id", accounts, "compte_id"),
            "destination": ("compte_destination_id", accounts, "compte_id"),
            "client": ("client_id", some_customers(spark, sf), "client_id"),
        },
    )
    loans = joins.missing_links(
        bank(spark, sf, "classification_creances"), {"credit": ("credit_id", bank(spark, sf, "credits"), "credit_id")}
    )
    return moves.unionByName(loans).groupBy("lien").agg(F.count(F.lit(1)).alias("cles"))


# --- aggregates --------------------------------------------------------------

@query(
    "busiest_towns",
    "select ville_transaction, count(*) as nombre from transactions group by 1 order by 2 desc, 1 limit 10",
)
def busiest_towns(spark, sf):
    return profile.top_groups(bank(spark, sf, "transactions"), "ville_transaction")


@query("transactions_by_status", "select canal, count(*) as nombre from transactions group by 1")
def transactions_by_status(spark, sf):
    return profile.group_count(bank(spark, sf, "transactions"), "canal")


@query(
    "balance_by_account_type",
    f"select type_compte, count(*) as nombre, {r('avg(solde)', 'moyenne')}, min(solde) as minimum, max(solde) as maximum from comptes group by 1",
)
def balance_by_account_type(spark, sf):
    return tidy(profile.group_stats(bank(spark, sf, "comptes"), "type_compte", "solde"))


@query(
    "fraud_rate_by_band",
    f"""select tranche_horaire, count(*) as total, cast(sum(fraud_flag) as bigint) as fraudes,
        {r('sum(fraud_flag) * 100.0::double / count(*)', 'taux_fraude_pct', 2)} from (select fraud_flag,
            case when substr(heure_transaction, 1, 2) < '06' then 'Nuit' when substr(heure_transaction, 1, 2) < '12' then 'Matin'
            when substr(heure_transaction, 1, 2) < '18' then 'Après-midi' else 'Soir' end as tranche_horaire from transactions)
        group by 1""",
)
def fraud_rate_by_band(spark, sf):
    hours = bank(spark, sf, "transactions").select(
        "fraud_flag", D.day_band(D.hour_of_clock("heure_transaction")).alias("tranche_horaire")
    )
    return profile.fraud_rate(hours, ["tranche_horaire"], "fraud_flag")


CATEGORIES = ("type_transaction", "canal", "mode_paiement", "ville_transaction", "is_night", "is_weekend", "is_international")


@query(
    "fraud_rate_per_category",
    " union all ".join(
        f"select '{c}' as variable, cast({c} as varchar) as modalite, count(*) as nb, {r('avg(fraud_flag)', 'taux_fraude')} "
        f"from transactions where {c} is not null group by 2" for c in CATEGORIES
    ),
)
def fraud_rate_per_category(spark, sf):
    return tidy(profile.rate_per_category(bank(spark, sf, "transactions"), CATEGORIES, "fraud_flag"))


STUDIED_CATEGORIES = (*feat.STUDIED_CATEGORICAL, *feat.STUDIED_BINARY)


@query(
    "fraud_rate_per_feature",
    " union all ".join(
        f"select '{c}' as variable, cast({c} as varchar) as modalite, count(*) as nb, {r('avg(fraud_flag)', 'taux_fraude')} "
        f"from feature_rows where {c} is not null group by 2" for c in STUDIED_CATEGORIES
    ),
)
def fraud_rate_per_feature(spark, sf):
    return tidy(profile.rate_per_category(features(spark, sf), STUDIED_CATEGORIES, "fraud_flag"))


KEYED = {
    "clients": "client_id", "comptes": "compte_id", "transactions": "transaction_id", "credits": "credit_id",
    "classification_creances": "classification_id",
}


@query(
    "key_uniqueness",
    " union all ".join(
        f"select '{t}' as table_name, '{k}' as cle, count(*) as lignes, count(distinct {k}) as distincts, "
        f"count(*) - count(distinct {k}) as doublons, case when count(*) = count(distinct {k}) then 'OK' "
        f"else 'À investiguer' end as statut from {t}" for t, k in {**KEYED, "lineitem": "l_orderkey"}.items()
    ),
)
def key_uniqueness(spark, sf):
    tables = {t: (bank(spark, sf, t), k) for t, k in KEYED.items()}
    tables["lineitem"] = (given(spark, sf, "lineitem"), "l_orderkey")
    return quality.uniqueness_report(tables)


PROFILED = (
    "transaction_id", "compte_source_id", "compte_destination_id", "client_id", "agence_id", "date_transaction", "date_valeur",
    "heure_transaction", "montant", "devise", "type_transaction", "canal", "mode_paiement", "statut_transaction", "pays_marchand",
    "ville_transaction", "pays_origine", "pays_destination", "frais_transaction", "ip_address", "device_id", "is_international",
    "is_weekend", "is_night", "fraud_flag", "fraud_type", "fraud_rule_triggered",
)


QUARTS = {"q25": 0.25, "mediane": 0.5, "q75": 0.75}


@query(
    "approximate_quartiles",
    " union all ".join(
        f"select '{c}' as variable, count({c}) as nombre, true as q25, true as mediane, true as q75 from feature_rows"
        for c in feat.STUDIED_NUMERIC
    ),
)
def approximate_quartiles(spark, sf):
    """Quartiles merged from monthly sketches: are their ranks within the error that the sketch promises?"""
    rows = materialise(features(spark, sf).select("date_transaction", *feat.STUDIED_NUMERIC))
    monthly = sketches.quantile_sketches(rows, feat.STUDIED_NUMERIC, [F.date_trunc("month", "date_transaction").alias("mois")])
    found = materialise(sketches.sketched_quantiles(monthly, QUARTS))
    gaps = sketches.rank_gaps(rows, found, QUARTS)
    return gaps.select("variable", "nombre", *[(F.col(q) <= sketches.RANK_ERROR).alias(q) for q in QUARTS])


KEYS = ("transaction_id", "client_id", "agence_id", "compte_source_id", "device_id")


@query(
    "approximate_key_counts",
    " union all ".join(
        f"select '{c}' as variable, count(*) as lignes, count(distinct {c}) as distincts, true as dans_la_borne from transactions" for c in KEYS
    ),
)
def approximate_key_counts(spark, sf):
    """Distinct keys merged from monthly sketches beside the exact counts, and whether the error is in its bound."""
    rows = bank(spark, sf, "transactions")
    monthly = sketches.distinct_sketches(rows, KEYS, [F.date_trunc("month", "date_transaction").alias("mois")])
    about = sketches.sketched_distincts(monthly).withColumnRenamed("distincts", "estimes")
    exact = reduce(DataFrame.unionByName, [profile.key_uniqueness(rows, c).select(F.lit(c).alias("variable"), "distincts") for c in KEYS])
    close = F.abs(F.col("estimes") - F.col("distincts")) <= F.greatest(F.lit(1.0), F.col("distincts") * sketches.DISTINCT_ERROR)
    return about.join(exact, "variable").select("variable", "lignes", "distincts", close.alias("dans_la_borne"))


@query(
    "null_profile",
    " union all ".join(
        f"select '{c}' as variable, count(*) filter ({c} is null) as nb_manquants, "
        f"{r(f'count(*) filter ({c} is null) * 100.0::double / count(*)', 'pct_manquants', 2)} from transactions" for c in PROFILED
    ),
)
def null_profile(spark, sf):
    return profile.null_profile(bank(spark, sf, "transactions"), PROFILED)


OVERVIEW = {
    "client_id": "string", "agence_id": "string", "type_client": "string", "civilite": "string", "nom": "string", "prenom": "string",
    "raison_sociale": "string", "date_naissance": "date", "email": "string", "ville": "string", "region": "string",
    "revenu_mensuel": "double", "score_credit": "int", "segment_client": "string", "niveau_risque_client": "string",
    "date_premier_contact": "date", "statut_client": "string",
}


@query(
    "column_overview",
    " union all ".join(
        f"select '{c}' as variable, '{t}' as type, count({c}) as non_nuls from clients" for c, t in OVERVIEW.items()
    ),
)
def column_overview(spark, sf):
    return profile.column_overview(bank(spark, sf, "clients").select(*OVERVIEW))


MEASURES = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "numeric_summary",
    " union all ".join(
        f"select '{c}' as variable, count({c}) as nombre, {r(f'avg({c})', 'moyenne')}, {r(f'stddev_samp({c})', 'ecart_type')}, "
        f"min({c}) as minimum, max({c}) as maximum, {r(f'quantile_cont({c}, 0.25)', 'q1')}, "
        f"{r(f'quantile_cont({c}, 0.5)', 'mediane')}, {r(f'quantile_cont({c}, 0.75)', 'q3')} from lineitem" for c in MEASURES
    ),
)
def numeric_summary(spark, sf):
    return tidy(profile.describe(given(spark, sf, "lineitem"), MEASURES))


COMPARED = feat.STUDIED_NUMERIC


@query(
    "class_comparison",
    " union all ".join(
        f"select '{c}' as variable, fraud_flag, {r(f'avg({c})', 'moyenne', 4)}, {r(f'quantile_cont({c}, 0.5)', 'mediane', 4)} "
        f"from feature_rows where {c} is not null group by 2" for c in COMPARED
    ),
)
def class_comparison(spark, sf):
    return tidy(profile.class_comparison(features(spark, sf), COMPARED, "fraud_flag"), 4)


@query(
    "class_balance",
    f"""select count(*) filter (fraud_flag = 0) as normales, count(*) filter (fraud_flag = 1) as fraudes,
        {r('avg(fraud_flag)', 'taux_fraude')},
        {r('count(*) filter (fraud_flag = 0) / count(*) filter (fraud_flag = 1)', 'ratio')} from transactions""",
)
def class_balance(spark, sf):
    return tidy(profile.class_balance(bank(spark, sf, "transactions"), "fraud_flag"))


@query(
    "loan_portfolio",
    f"""select {r('sum(probabilite_defaut_pd * e) / sum(e)', 'pd_pondere')}, {r('sum(perte_en_cas_defaut_lgd * e) / sum(e)', 'lgd_pondere')},
        {r('sum(el)', 'el_total', 2)}, {r('sum(pc)', 'provision_totale', 2)}, {r('sum(pc) - sum(el)', 'ecart', 2)},
        {r('(sum(pc) - sum(el)) * 100 / sum(el)', 'ecart_pct')} from (select *, exposition_en_cas_defaut_ead as e,
            perte_attendue_el as el, provision_constituee as pc from classification_creances)""",
)
def loan_portfolio(spark, sf):
    out = risk.portfolio_summary(bank(spark, sf, "classification_creances"))
    return tidy(out.withColumns({c: F.round(c, 2) for c in ("el_total", "provision_totale", "ecart")}))


@query(
    "category_shares",
    f"""select categorie_reglementaire, count(*) as nombre,
        {r('count(*) / (select count(*) from classification_creances)', 'part')} from classification_creances group by 1""",
)
def category_shares(spark, sf):
    return tidy(profile.category_shares(bank(spark, sf, "classification_creances"), "categorie_reglementaire"))


@query(
    "customer_z_scores",
    f"""select transaction_id, {rs('m', 's')}, {r('(montant - m) / (s + 1)', 'z')} from (
        select *, avg(montant) over (partition by client_id) as m,
            coalesce(stddev_samp(montant) over (partition by client_id), 0) as s from transactions)""",
)
def customer_z_scores(spark, sf):
    rows = bank(spark, sf, "transactions").select("transaction_id", "client_id", "montant")
    out = profile.with_group_stats(rows, ["client_id"], "montant")
    return tidy(
        out.select(
            "transaction_id", F.col("client_moyenne").alias("m"), F.col("client_ecart_type").alias("s"),
            F.col("client_z").alias("z"),
        )
    )


@query(
    "batch_summary",
    f"""select count(*) as total, count(*) filter (fraud_proba >= 0.5) as fraudes,
        {r('count(*) filter (fraud_proba >= 0.5) / count(*)', 'taux')}, count(*) filter (fraud_proba < 0.5) as normales from scores""",
)
def batch_summary(spark, sf):
    return tidy(profile.decision_summary(scoring.verdict(bank(spark, sf, "scores").select("fraud_proba")), "decision"))


@query(
    "sanity_counts",
    """select count(*) - count(distinct l_orderkey) as doublons, count(*) filter (l_extendedprice - 20000 <= 0) as montants_non_positifs,
        count(*) filter (l_quantity * 3 < 18 or l_quantity * 3 > 100) as ages_hors_plage from lineitem""",
)
def sanity_counts(spark, sf):
    rows = given(spark, sf, "lineitem").select(
        "l_orderkey", (F.col("l_extendedprice") - 20000).alias("montant"), (F.col("l_quantity") * 3).alias("age")
    )
    return profile.sanity_counts(rows, "l_orderkey", "montant", "age")


# --- windows -----------------------------------------------------------------

VIEWS["ratios"] = """
    select agence_id, niveau_consolidation, type_ratio, date_calcul, depot_total, credit_total, depot_vue,
        niveau_consolidation || '-' || agence_id || '-' || cast(date_calcul as varchar) as ratio_id,
        case when sorties <> 0 then round(hqla * 100 / sorties, 2) end as lcr_ratio,
        case when requis <> 0 then round(stable * 100 / requis, 2) end as nsfr_ratio,
        case when depot_total <> 0 then round(credit_total * 100 / depot_total, 2) end as ratio_credit_depot
    from ratios_bruts
"""


def ratios(spark, sf) -> DataFrame:
    raw = bank(spark, sf, "ratios_bruts")
    return raw.withColumns(
        {
            "ratio_id": F.concat_ws("-", "niveau_consolidation", "agence_id", F.col("date_calcul").cast("string")),
            "lcr_ratio": risk.percent_ratio("hqla", "sorties"),
            "nsfr_ratio": risk.percent_ratio("stable", "requis"),
            "ratio_credit_depot": risk.percent_ratio("credit_total", "depot_total"),
        }
    ).withColumns(
        {
            "lcr_conforme": risk.conforms("lcr_ratio"),
            "nsfr_conforme": risk.conforms("nsfr_ratio"),
        }
    ).withColumns(
        {
            "statut_global": risk.global_status("lcr_conforme", "nsfr_conforme"),
            "alerte_niveau": risk.alert_colour("lcr_conforme", "nsfr_conforme"),
        }
    )


STATUS_SQL = """lcr_ratio >= 100 as lcr_conforme, nsfr_ratio >= 100 as nsfr_conforme,
    case when lcr_ratio >= 100 and nsfr_ratio >= 100 then 'Conforme' when lcr_ratio >= 100 or nsfr_ratio >= 100 then 'Surveillance'
        else 'Non conforme' end as statut_global,
    case when lcr_ratio >= 100 and nsfr_ratio >= 100 then 'Vert' when lcr_ratio >= 100 or nsfr_ratio >= 100 then 'Orange'
        else 'Rouge' end as alerte_niveau"""


@query(
    "liquidity_ratios",
    f"""select ratio_id, {rs('lcr_ratio', 'nsfr_ratio', 'ratio_credit_depot')}, {STATUS_SQL},
        {r('depot_vue * 0.04', 'reserve_obligatoire', 2)}, {r('round(depot_vue * 0.04, 2) * 100 / depot_total', 'ratio_reserve', 4)},
        {r('depot_total - depot_vue', 'depot_terme', 2)}, {r('depot_vue / depot_total', 'ratio_depot_vue', 4)} from ratios""",
)
def liquidity_ratios(spark, sf):
    measured = ratios(spark, sf).withColumns(risk.reserve_measures("depot_vue", "depot_total", "depot_vue"))
    return tidy(
        measured.select(
            "ratio_id", "lcr_ratio", "nsfr_ratio", "ratio_credit_depot", "lcr_conforme", "nsfr_conforme", "statut_global",
            "alerte_niveau", "reserve_obligatoire", "ratio_reserve", F.round("depot_terme", 2).alias("depot_terme"),
            "ratio_depot_vue",
        )
    )


@query(
    "monthly_liquidity",
    f"""select ratio_id, {rs('lcr_ratio', 'nsfr_ratio', 'lv', 'nv')}, case when lv > 0 then 'Amélioration'
        when lv < 0 then 'Détérioration' else 'Stable' end as tendance_lcr from (select *,
            lcr_ratio - lag(lcr_ratio) over s as lv, nsfr_ratio - lag(nsfr_ratio) over s as nv from ratios
            window s as (partition by niveau_consolidation, agence_id, type_ratio order by date_calcul, ratio_id))""",
)
def monthly_liquidity(spark, sf):
    out = silver.liquidity(ratios(spark, sf))
    return tidy(
        out.select(
            "ratio_id", "lcr_ratio", "nsfr_ratio", F.col("lcr_variation_mensuelle").alias("lv"),
            F.col("nsfr_variation_mensuelle").alias("nv"), "tendance_lcr",
        )
    )


@query("liquidity_means", f"select {r('avg(lcr_ratio)', 'lcr_moyen')}, {r('avg(nsfr_ratio)', 'nsfr_moyen')} from ratios")
def liquidity_means(spark, sf):
    return tidy(ratios(spark, sf).agg(F.avg("lcr_ratio").alias("lcr_moyen"), F.avg("nsfr_ratio").alias("nsfr_moyen")))


VIEWS["mouvements"] = """
    select transaction_id, date_transaction, compte_source_id as compte_id, -montant as mouvement from transactions
        where compte_source_id is not null
    union all select transaction_id, date_transaction, compte_destination_id, montant from transactions
        where compte_destination_id is not null and compte_destination_id is distinct from compte_source_id
"""


@query(
    "account_ledger",
    f"""select compte_id, transaction_id, {r('o + c - mouvement', 'solde_avant', 2)}, {r('o + c', 'solde_apres', 2)},
        case when o + c < 0 and abs(o + c) > decouvert then 1 else 0 end as solde_negatif_anormal from (
        select m.*, coalesce(k.solde, 0) as o, coalesce(k.decouvert_autorise, 0) as decouvert, sum(mouvement) over (
            partition by m.compte_id order by date_transaction, transaction_id rows unbounded preceding) as c
        from mouvements m left join comptes k on m.compte_id = k.compte_id)""",
)
def account_ledger(spark, sf):
    accounts = bank(spark, sf, "comptes")
    ledger = risk.running_balance(risk.account_moves(bank(spark, sf, "transactions")), accounts, beside=["decouvert_autorise"])
    ledger = ledger.fillna({"decouvert_autorise": 0.0})
    return tidy(
        ledger.select(
            "compte_id", "transaction_id", "solde_avant", "solde_apres",
            risk.overdrawn_flag("solde_apres", "decouvert_autorise").alias("solde_negatif_anormal"),
        ), 2,
    )


@query(
    "device_occurrences",
    """select transaction_id, device_id, row_number() over (partition by client_id order by date_transaction, transaction_id) as rang,
        case when row_number() over (partition by client_id, device_id order by date_transaction, transaction_id) = 1 then 1
            else 0 end as premiere_vue from transactions""",
)
def device_occurrences(spark, sf):
    rows = bank(spark, sf, "transactions").select("transaction_id", "client_id", "device_id", "date_transaction")
    out = risk.occurrence_numbers(rows, "client_id", "device_id", ["date_transaction", "transaction_id"])
    return out.select("transaction_id", "device_id", "rang", "premiere_vue")


@query(
    "latest_events_per_user",
    """select user_id, log_id, cast(rang as int) as rang from (select *,
        row_number() over (partition by user_id order by created_at desc, log_id desc) as rang from journal) where rang <= 5""",
)
def latest_events_per_user(spark, sf):
    rows = bank(spark, sf, "journal").select("user_id", "log_id", "created_at")
    return latest_n(rows, ["user_id"], ["created_at", "log_id"], 5).select("user_id", "log_id", "rang")


# --- sorts and top-k ---------------------------------------------------------

@query(
    "top_scores",
    f"""select transaction_id, {r('fraud_proba')}, label as actual_label from scores where fraud_proba >= 0.5
        order by scores.fraud_proba desc, transaction_id limit 500""",
)
def top_scores(spark, sf):
    rows = bank(spark, sf, "scores").select("transaction_id", "fraud_proba", "label")
    return tidy(scoring.scores_above(rows, 0.5, 500).select("transaction_id", "fraud_proba", "actual_label"))


@query("first_rows", "select transaction_id, client_id, montant from transactions order by transaction_id limit 10")
def first_rows(spark, sf):
    return bank(spark, sf, "transactions").select("transaction_id", "client_id", "montant").orderBy("transaction_id").limit(10)


# --- quality -----------------------------------------------------------------

VIEWS["clients_gardes"] = "select * from clients where segment_client <> 'BUILDING'"
VIEWS["agences_gardees"] = "select * from agences where type_agence <> 'Digitale'"


def _check_sql(fact: str, name: str, dim: str, dim_name: str, key: str, nulls: bool) -> str:
    lost = f"{key} is not null and {key} not in (select {key} from {dim})"
    if not nulls:
        lost = f"({lost}) or {key} is null"
    return (
        f"select '{name}' as fait, '{dim_name}' as dimension, '{key}' as cle, count(*) as total, "
        f"count(*) filter ({lost}) as orphelins, {f'count(*) filter ({key} is null)' if nulls else '0::bigint'} as nuls_admis "
        f"from {fact}"
    )


@query(
    "integrity_report",
    "select *, case when orphelins = 0 then 'OK' else 'À investiguer' end as statut from ("
    + " union all ".join(
        [
            _check_sql("transactions", "fact_transactions", "clients_gardes", "dim_client", "client_id", False),
            _check_sql("transactions", "fact_transactions", "agences_gardees", "dim_agence", "agence_id", False),
            "select 'fact_transactions' as fait, 'dim_temps' as dimension, 'date_key' as cle, count(*) as total, "
            "count(*) filter (year(date_transaction) not between 2020 and 2026) as orphelins, 0::bigint as nuls_admis from transactions",
            _check_sql("credits", "fact_credits", "clients_gardes", "dim_client", "client_id", False),
            _check_sql("credits", "fact_credits", "agences_gardees", "dim_agence", "agence_id", False),
            _check_sql(
                "(select case when agence_id = '5-LOW' then null else 'AG-' || substr(agence_id, 1, 1) end as agence_id from ratios)",
                "fact_liquidite", "agences_gardees", "dim_agence", "agence_id", True,
            ),
        ]
    ) + ")",
)
def integrity_report(spark, sf):
    moves = bank(spark, sf, "transactions").select(
        "client_id", "agence_id", D.date_key("date_transaction").alias("date_key")
    )
    branch = F.when(F.col("agence_id") != "5-LOW", F.concat(F.lit("AG-"), F.substring("agence_id", 1, 1)))
    return star.integrity(
        moves, bank(spark, sf, "credits").select("client_id", "agence_id"), ratios(spark, sf).select(branch.alias("agence_id")),
        some_customers(spark, sf), renamed(bank(spark, sf, "agences"), "agence_id", F.col("type_agence") == "Digitale"),
        star.dim_temps(star.standard_bounds(spark)),
    )


@query(
    "rule_violations",
    """select regle, violations, case when violations = 0 then 'OK' else 'À investiguer' end as statut from (
        select 'ead_positive' as regle, count(*) filter (not exposition_en_cas_defaut_ead > 0) as violations from classification_creances
        union all select 'pd_entre_0_et_1', count(*) filter (not probabilite_defaut_pd between 0 and 1) from classification_creances
        union all select 'lgd_entre_0_et_1', count(*) filter (not perte_en_cas_defaut_lgd between 0 and 1) from classification_creances
        union all select 'pd_dans_sa_bande', count(*) filter (not probabilite_defaut_pd between
            case when jours_retard <= 0 then 0.005 when jours_retard <= 30 then 0.02 when jours_retard <= 90 then 0.05
                when jours_retard <= 180 then 0.15 when jours_retard <= 360 then 0.35 else 0.65 end and
            case when jours_retard <= 0 then 0.02 when jours_retard <= 30 then 0.05 when jours_retard <= 90 then 0.15
                when jours_retard <= 180 then 0.35 when jours_retard <= 360 then 0.65 else 0.95 end) from classification_creances)""",
)
def rule_violations(spark, sf):
    low, high = risk.pd_bounds("jours_retard")
    p, lgd = F.col("probabilite_defaut_pd"), F.col("perte_en_cas_defaut_lgd")
    return quality.rule_counts(
        bank(spark, sf, "classification_creances"),
        {
            "ead_positive": F.col("exposition_en_cas_defaut_ead") > 0,
            "pd_entre_0_et_1": p.between(0, 1),
            "lgd_entre_0_et_1": lgd.between(0, 1),
            "pd_dans_sa_bande": p.between(low, high),
        },
    )


@query("label_rate", f"select {r('avg(fraud_flag)', 'taux')}, 0.012::double as cible, {r('avg(fraud_flag) - 0.012', 'ecart')} from transactions")
def label_rate(spark, sf):
    return tidy(quality.label_rate(bank(spark, sf, "transactions"), "fraud_flag", risk.TARGET_RATE))


# --- loan risk and fraud rules -----------------------------------------------

@query(
    "loan_risk",
    f"""select credit_id, case when jours_retard = 0 then 'Stage 1' when jours_retard <= 90 then 'Stage 2' else 'Stage 3' end as stade,
        {CATEGORY_SQL} as categorie,
        case when score_risque_octroi >= 700 and jours_retard = 0 then 'A' when score_risque_octroi >= 600 and jours_retard <= 30
            then 'B' when jours_retard <= 90 then 'C' else 'D' end as note,
        case when jours_retard = 0 then 'En cours' when jours_retard <= 90 then 'En cours (retard)' when jours_retard <= 180
            then 'Incident de paiement' else 'Contentieux' end as statut,
        case when jours_retard > 180 then 1 else 0 end as contentieux,
        case when jours_retard > 30 then 'Retard de paiement' else 'Normal' end as motif,
        case when garantie = 'Hypothèque' then 0.2::double when garantie = 'Sans garantie' then 0.55::double else 0.35::double end as lgd_min,
        case when garantie = 'Hypothèque' then 0.35::double when garantie = 'Sans garantie' then 0.75::double else 0.55::double end as lgd_max,
        case when jours_retard = 0 then 0.02::double when jours_retard <= 30 then 0.05::double when jours_retard <= 90 then 0.15::double
            when jours_retard <= 180 then 0.35::double when jours_retard <= 360 then 0.65::double else 0.95::double end as pd_max
        from credits""",
)
def loan_risk(spark, sf):
    lgd_low, lgd_high = risk.lgd_bounds("garantie")
    _, pd_high = risk.pd_bounds("jours_retard")
    return bank(spark, sf, "credits").select(
        "credit_id", risk.ifrs9_stage("jours_retard").alias("stade"),
        risk.regulatory_category("jours_retard").alias("categorie"),
        risk.internal_grade("score_risque_octroi", "jours_retard").alias("note"),
        risk.loan_status("jours_retard").alias("statut"), risk.litigation_flag("jours_retard").alias("contentieux"),
        risk.late_reason("jours_retard").alias("motif"), lgd_low.alias("lgd_min"), lgd_high.alias("lgd_max"),
        pd_high.alias("pd_max"),
    )


@query(
    "expected_losses",
    f"""select classification_id, {r('probabilite_defaut_pd * perte_en_cas_defaut_lgd * exposition_en_cas_defaut_ead', 'el', 2)},
        {r('case when exposition_en_cas_defaut_ead <> 0 then perte_attendue_el / exposition_en_cas_defaut_ead else 0 end', 'taux_perte_attendue')},
        {r('case when exposition_en_cas_defaut_ead <> 0 then provision_constituee / exposition_en_cas_defaut_ead else 0 end', 'ratio_provision_exposition')}
        from classification_creances""",
)
def expected_losses(spark, sf):
    out = silver.classifications(bank(spark, sf, "classification_creances"))
    return tidy(
        out.select(
            "classification_id",
            risk.expected_loss(
                "probabilite_defaut_pd", "perte_en_cas_defaut_lgd", "exposition_en_cas_defaut_ead"
            ).alias("el"),
            "taux_perte_attendue", "ratio_provision_exposition",
        )
    )


@query(
    "loan_ratios",
    f"""select credit_id, {r('case when montant_initial <> 0 then montant_restant_du / montant_initial else 0 end', 'ratio_restant_initial')},
        {r('case when montant_restant_du <> 0 then provision_constituee / montant_restant_du else 0 end', 'provision_ratio')} from credits""",
)
def loan_ratios(spark, sf):
    return tidy(silver.loans(bank(spark, sf, "credits")).select("credit_id", "ratio_restant_initial", "provision_ratio"))


VIEWS["soldes_anormaux"] = """
    select transaction_id, max(case when o + c < 0 and abs(o + c) > decouvert then 1 else 0 end) as solde_negatif_anormal from (
        select m.*, coalesce(k.solde, 0) as o, coalesce(k.decouvert_autorise, 0) as decouvert, sum(mouvement) over (
            partition by m.compte_id order by date_transaction, transaction_id rows unbounded preceding) as c
        from mouvements m left join comptes k on m.compte_id = k.compte_id) group by 1
"""
VIEWS["regles"] = """
    select t.*, coalesce(a.solde_negatif_anormal, 0) as neg,
        (montant - avg(montant) over (partition by client_id)) / (coalesce(stddev_samp(montant) over (partition by client_id), 0) + 1) as z,
        row_number() over (partition by client_id order by date_transaction, t.transaction_id) as rang
    from transactions t left join soldes_anormaux a on t.transaction_id = a.transaction_id
"""
VIEWS["regles_notees"] = """
    select *, 0.001 + 0.45 * (case when z > 3 then 0.30::double else 0 end + case when is_night = 1 then 0.20::double else 0 end
        + case when is_international = 1 then 0.15::double else 0 end + case when rang = 1 then 0.10::double else 0 end
        + case when montant > 30000 then 0.15::double else 0 end
        + case when is_weekend = 1 and is_night = 1 then 0.10::double else 0 end
        + case when neg = 1 then 0.15::double else 0 end) as p from regles
"""


@query(
    "rule_labels",
    f"""select transaction_id, {r('p', 'prob')}, hit as fraud_flag, case when hit = 1 then concat_ws(' ',
        case when z > 3 then 'ecart_z' end, case when is_night = 1 then 'nuit' end, case when is_international = 1 then 'intl' end,
        case when rang = 1 then 'device' end, case when montant > 30000 then 'montant_eleve' end,
        case when neg = 1 then 'solde_neg' end) else '' end as fraud_rule_triggered,
        case when hit = 1 then 'Score de risque élevé' end as fraud_type
        from (select *, case when round(p, 9) >= (select round(quantile_cont(p, 0.988), 9) from regles_notees) then 1 else 0 end as hit
            from regles_notees)""",
)
def rule_labels(spark, sf):
    moves, accounts = bank(spark, sf, "transactions"), bank(spark, sf, "comptes")
    order = ["date_transaction", "transaction_id"]
    ledger = risk.running_balance(risk.account_moves(moves), accounts, beside=["decouvert_autorise"])
    ledger = ledger.fillna({"decouvert_autorise": 0.0})
    overdrawn = ledger.groupBy("transaction_id").agg(
        F.max(risk.overdrawn_flag("solde_apres", "decouvert_autorise")).alias("solde_negatif_anormal")
    )
    # Written twice, because the steps after each look at the rows several times.
    rows = materialise(
        moves.select(*order, "client_id", "device_id", "montant", "is_night", "is_weekend", "is_international")
        .join(overdrawn, "transaction_id", "left")
        .fillna({"solde_negatif_anormal": 0})
    )
    rows = risk.occurrence_numbers(rows, "client_id", "device_id", order)
    rows = profile.with_group_stats(rows, ["client_id"], "montant")
    rules = risk.fraud_rules(F.col("client_z"), F.col("rang"))
    scored = materialise(rows.withColumn("prob", F.round(risk.rule_probability(risk.rule_score(rules)), 9)))
    labelled = risk.label_by_quantile(scored, "prob")
    return tidy(
        labelled.withColumns(risk.rule_trail(rules)).select(
            "transaction_id", "prob", "fraud_flag", "fraud_rule_triggered", "fraud_type"
        )
    )


# --- star schema -------------------------------------------------------------

@query(
    "dim_client",
    f"""select client_id, type_client, civilite, nom_complet, age, ville, region, segment_client, tranche_revenu,
        {r('revenu_mensuel')}, score_credit, niveau_risque_client, statut_client, anciennete_annees, agence_id from silver_clients""",
)
def dim_client(spark, sf):
    rows = clients_silver(spark, sf)
    return tidy(star.dim_client(rows.unionByName(rows)))


@query("dim_agence", f"select agence_id, nom_agence, ville, region, type_agence, {day('date_ouverture')} from agences")
def dim_agence(spark, sf):
    return tidy(star.dim_agence(silver.branches(bank(spark, sf, "agences"))))


VIEWS["jours"] = """
    select cast(d as date) as date from (select unnest(generate_series(
        (select date_trunc('year', min(date_transaction)) from transactions),
        (select date_trunc('year', max(date_transaction)) + interval 1 year - interval 1 day from transactions), interval 1 day)) as d)
"""
VIEWS["dim_temps"] = """
    select date, cast(strftime(date, '%Y%m%d') as int) as date_key, cast(year(date) as int) as annee, cast(quarter(date) as int) as trimestre,
        cast(month(date) as int) as mois, cast(day(date) as int) as jour, cast(dayofweek(date) + 1 as int) as jour_semaine,
        strftime(date, '%B') as nom_mois, strftime(date, '%Y-%m') as mois_annee,
        case when dayofweek(date) in (0, 6) then 1 else 0 end as est_weekend from jours
"""


def temps(spark, sf) -> DataFrame:
    return star.dim_temps(star.bounds_of(bank(spark, sf, "transactions"), "date_transaction"))


@query("dim_temps", "select * replace (cast(date as varchar) as date) from dim_temps")
def dim_temps(spark, sf):
    return tidy(temps(spark, sf))


@query(
    "fact_transactions",
    f"""select transaction_id, client_id, agence_id, cast(strftime(date_transaction, '%Y%m%d') as int) as date_key,
        {ts('date_transaction')}, montant, {r('frais_transaction')}, canal, type_transaction, mode_paiement, sens_operation,
        est_international, is_weekend, is_night, hors_agence, fraud_flag, fraud_type, fraud_rule_triggered from silver_transactions""",
)
def fact_transactions(spark, sf):
    return tidy(star.fact_transactions(transactions_silver(spark, sf)))


VIEWS["derniere_classification"] = """
    select * from (select *, row_number() over (partition by credit_id order by date_classification desc, classification_id desc) as rn
        from classification_creances) where rn = 1
"""
VIEWS["fact_credits"] = """
    select c.credit_id, c.client_id, c.agence_id, cast(strftime(date_octroi, '%Y%m%d') as int) as date_key, type_credit, montant_initial,
        montant_restant_du, taux_interet_nominal, duree_totale_mois, duree_restante_mois, montant_mensualite, c.jours_retard,
        statut_credit, classification_bale, c.provision_constituee, categorie_reglementaire, categorie_bale_ii, categorie_ifrs9,
        probabilite_defaut_pd, perte_en_cas_defaut_lgd, exposition_en_cas_defaut_ead, perte_attendue_el, provision_requise,
        taux_provisionnement from credits c left join derniere_classification d on c.credit_id = d.credit_id
"""
LOAN_DOUBLES = (
    "montant_initial", "montant_restant_du", "taux_interet_nominal", "montant_mensualite", "provision_constituee",
    "probabilite_defaut_pd", "perte_en_cas_defaut_lgd", "exposition_en_cas_defaut_ead", "perte_attendue_el", "provision_requise",
)


def credits_fact(spark, sf) -> DataFrame:
    return star.fact_credits(
        silver.loans(bank(spark, sf, "credits")), silver.classifications(bank(spark, sf, "classification_creances"))
    )


@query(
    "fact_credits",
    f"select * replace ({rs(*LOAN_DOUBLES)}) from fact_credits",
)
def fact_credits(spark, sf):
    return tidy(credits_fact(spark, sf))


@query(
    "latest_classification",
    """select credit_id, classification_id, cast(date_classification as varchar) as date_classification from derniere_classification""",
)
def latest_classification(spark, sf):
    versions = bank(spark, sf, "classification_creances")
    out = joins.latest_join(
        versions.select("credit_id").distinct(), versions, "credit_id", ["date_classification", "classification_id"],
        ["classification_id", "date_classification"],
    )
    return tidy(out)


VIEWS["fact_liquidite"] = f"""
    select ratio_id, agence_id, cast(strftime(date_calcul, '%Y%m%d') as int) as date_key, niveau_consolidation, type_ratio, lcr_ratio,
        nsfr_ratio, depot_total, credit_total, ratio_credit_depot, {STATUS_SQL}, strftime(date_calcul, '%Y-%m') as mois_annee from ratios
"""


@query(
    "fact_liquidite",
    f"""select * exclude (mois_annee) replace ({rs('lcr_ratio', 'nsfr_ratio', 'ratio_credit_depot')},
        {rs('depot_total', 'credit_total', digits=4)}) from fact_liquidite""",
)
def fact_liquidite(spark, sf):
    facts = star.fact_liquidite(silver.liquidity(ratios(spark, sf)))
    return tidy(facts.withColumns({c: F.round(c, 4) for c in ("depot_total", "credit_total")}))


@query(
    "fraud_by_month",
    f"""select strftime(date_transaction, '%Y-%m') as mois_annee, count(*) as transactions, cast(sum(fraud_flag) as bigint) as fraudes,
        {r('sum(fraud_flag) / count(*)', 'taux_fraude')} from transactions group by 1""",
)
def fraud_by_month(spark, sf):
    rows = bank(spark, sf, "transactions").select("fraud_flag", D.date_key("date_transaction").alias("date_key"))
    return tidy(star.fraud_by_month(rows, temps(spark, sf)))


@query(
    "volume_by_channel",
    f"""select canal, count(*) as transactions, {r('sum(montant)', 'volume', 2)}, {r('avg(fraud_flag)', 'taux_fraude')}
        from transactions group by 1""",
)
def volume_by_channel(spark, sf):
    return tidy(star.volume_by_channel(bank(spark, sf, "transactions")).withColumn("volume", F.round("volume", 2)))


@query(
    "fraud_by_place",
    f"""select region, ville, count(*) as transactions, cast(sum(fraud_flag) as bigint) as fraudes, {r('sum(montant)', 'volume', 2)},
        {r('sum(fraud_flag) / count(*)', 'taux_fraude')} from transactions t join agences a on t.agence_id = a.agence_id group by 1, 2""",
)
def fraud_by_place(spark, sf):
    out = star.fraud_by_place(bank(spark, sf, "transactions"), bank(spark, sf, "agences"))
    return tidy(out.withColumn("volume", F.round("volume", 2)))


@query(
    "outstanding_by_category",
    f"""select categorie_reglementaire, count(*) as credits, {r('sum(montant_restant_du)', 'encours', 4)},
        {r('sum(perte_attendue_el)', 'perte_attendue', 4)} from fact_credits group by 1""",
)
def outstanding_by_category(spark, sf):
    return tidy(star.outstanding_by_category(credits_fact(spark, sf)), 4)


@query(
    "liquidity_by_month",
    f"""select mois_annee, {r('avg(lcr_ratio)', 'lcr_moyen')}, {r('avg(nsfr_ratio)', 'nsfr_moyen')},
        count(*) filter (lcr_conforme and nsfr_conforme) as series_conformes from fact_liquidite group by 1""",
)
def liquidity_by_month(spark, sf):
    return tidy(star.liquidity_by_month(star.fact_liquidite(ratios(spark, sf)), temps(spark, sf)))


# --- alerts, audit, imports --------------------------------------------------

VIEWS["alertes"] = """
    select transaction_id as alert_id, user_id, fraud_proba as score, created_at,
        '{"montant":' || montant || ',"type_transaction":"' || type_transaction || '"}' as transaction_data,
        case when fraud_proba >= 0.8 then 'Très élevé' else 'Élevé' end as niveau_risque
    from scores where fraud_proba >= 0.5
"""
VIEWS["alertes_lues"] = """
    select a.*, case when exists (select 1 from etats e where e.alert_id = a.alert_id and e.action = 'lu') or exists (
            select 1 from etats e where e.action = 'tout_lu' and e.user_id = a.user_id and a.created_at <= e.at) then 1 else 0 end as lu
    from alertes a where not exists (select 1 from etats e where e.alert_id = a.alert_id and e.action = 'supprime')
"""


def new_alerts(spark, sf) -> DataFrame:
    return alerts.fraud_alerts(
        bank(spark, sf, "scores"), "transaction_id", "user_id", "created_at", ["montant", "type_transaction"]
    )


def folded(spark, sf) -> DataFrame:
    return alerts.fold_states(new_alerts(spark, sf), bank(spark, sf, "etats"))


@query(
    "fraud_alerts",
    f"""select alert_id, user_id, transaction_data, {r('score')}, 'FRAUDE' as decision, niveau_risque, {ts('created_at')}
        from alertes""",
)
def fraud_alerts(spark, sf):
    return tidy(new_alerts(spark, sf))


@query("alert_states", "select alert_id, user_id, lu from alertes_lues")
def alert_states(spark, sf):
    return folded(spark, sf).select("alert_id", "user_id", "lu")


@query("unread_counts", "select user_id, count(*) filter (lu = 0) as non_lues from alertes_lues group by 1")
def unread_counts(spark, sf):
    return alerts.unread_counts(folded(spark, sf))


@query(
    "latest_unread_alerts",
    f"""select user_id, alert_id, {r('score')}, cast(rang as int) as rang from (select *, row_number() over (partition by user_id
        order by created_at desc, alert_id desc) as rang from alertes_lues where lu = 0) where rang <= 3""",
)
def latest_unread_alerts(spark, sf):
    out = alerts.latest_alerts(folded(spark, sf), 3, unread_only=True)
    return tidy(out.select("user_id", "alert_id", "score", "rang"))


@query(
    "activity_stats",
    """select (select count(*) from clients where statut_client = 'Actif') as n_users, count(*) as n_alerts,
        count(*) filter (lu = 0) as n_unread, count(*) as n_frauds from alertes_lues""",
)
def activity_stats(spark, sf):
    users = clients_silver(spark, sf).select(F.col("statut_client_binaire").alias("actif"))
    return alerts.activity_stats(users, folded(spark, sf))


@query(
    "appended_once",
    f"""select 'journal' as nom, user_id, count(*) as nombre, count(distinct log_id) as distincts, {ts('max(created_at)', 'dernier')} from journal group by 2
        union all select 'imports', user_id, count(*), count(distinct import_id), {ts('max(created_at)', 'dernier')} from imports group by 2""",
)
def appended_once(spark, sf):
    """Log rows and imports in three lots, the second delivered twice and the third with rows of the first."""
    out = []
    for name, key, append in (("journal", "log_id", alerts.append_audit), ("imports", "import_id", alerts.append_imports)):
        rows, path = bank(spark, sf, name), scratch(spark, name)
        part = F.pmod(F.col(key), F.lit(3))
        for lot, some in (("a", part == 0), ("b", part == 1), ("b", part == 1), ("c", (part == 2) | (F.col(key) % 6 == 0))):
            append(rows.filter(some), path, lot)
        read = tables.read_appended(spark, path, rows.schema)
        out.append(read.groupBy(F.lit(name).alias("nom"), "user_id").agg(
            F.count(F.lit(1)).alias("nombre"), F.count_distinct(key).alias("distincts"), F.max("created_at").alias("dernier")
        ))
    return tidy(out[0].unionByName(out[1]))


@query(
    "alerts_of_a_level",
    f"""select user_id, alert_id, {r('score')}, niveau_risque, cast(rang as int) as rang from (select *, row_number() over (partition by user_id
        order by created_at desc, alert_id desc) as rang from alertes_lues where niveau_risque = 'Élevé') where rang <= 5""",
)
def alerts_of_a_level(spark, sf):
    out = alerts.latest_alerts(folded(spark, sf), 5, decision="FRAUDE", level="Élevé")
    return tidy(out.select("user_id", "alert_id", "score", "niveau_risque", "rang"))


@query(
    "alerts_of_a_user",
    f"""select user_id, alert_id, {r('score')}, lu, cast(row_number() over (order by created_at desc, alert_id desc) as int) as rang from alertes_lues
        where user_id = (select min(user_id) from alertes_lues) order by rang limit 50""",
)
def alerts_of_a_user(spark, sf):
    rows = materialise(folded(spark, sf))
    first = rows.agg(F.min("user_id")).first()[0]
    return tidy(alerts.latest_alerts(rows, user=first).select("user_id", "alert_id", "score", "lu", "rang"))


@query(
    "audit_trail",
    f"select log_id, user_id, action, details, {ts('created_at')} from journal order by journal.created_at desc, log_id desc limit 100",
)
def audit_trail(spark, sf):
    return tidy(alerts.audit_trail(bank(spark, sf, "journal")))


@query(
    "audit_per_user",
    """select user_id, log_id, action, cast(rang as int) as rang from (select *, row_number() over (partition by user_id
        order by created_at desc, log_id desc) as rang from journal) where rang <= 10""",
)
def audit_per_user(spark, sf):
    return alerts.audit_per_user(bank(spark, sf, "journal"), 10).select("user_id", "log_id", "action", "rang")


@query(
    "import_history",
    """select import_id, user_id, filename, cast(rang as int) as rang,
        case when json_valid(results) then cast(json_array_length(results) as int) else 0 end as lignes,
        case when json_valid(results) then cast(len(list_filter(json_extract_string(results, '$[*].decision'),
            lambda d: d = 'FRAUDE')) as int) else 0 end as fraudes
        from (select *, row_number() over (partition by user_id order by created_at desc, import_id desc) as rang from imports)
        where rang <= 5""",
)
def import_history(spark, sf):
    return alerts.import_history(bank(spark, sf, "imports")).drop("created_at")
