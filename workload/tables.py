"""Bank tables derived from the given test tables.

Each text is a projection that Spark and DuckDB both read; the operators and
their check queries are written apart from each other on top of it.
``{name}`` stands for a given table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

STAND_INS = {
    "agences": """
        select 'AG-' || cast(n_nationkey as string) as agence_id, n_name as nom_agence,
            cast(n_nationkey as string) || ' rue de la Banque' as adresse,
            'VILLE_' || cast(n_nationkey as string) as ville, cast(10000 + n_nationkey as int) as code_postal,
            r_name as region, 'MA' as pays, '06' || lpad(cast(n_nationkey as string), 8, '0') as telephone,
            'agence' || cast(n_nationkey as string)
                || case when n_nationkey % 2 = 0 then '@gmail.com' else '@gmailxcom.ma' end as email,
            'Directeur ' || cast(n_nationkey as string) as directeur,
            date '2010-01-01' + cast(n_nationkey * 37 as int) as date_ouverture,
            case when n_nationkey % 3 = 0 then 'Standard' when n_nationkey % 3 = 1 then 'Premium'
                else 'Digitale' end as type_agence,
            cast(30 + n_nationkey * 0.25 as double) as latitude, cast(-5 - n_nationkey * 0.25 as double) as longitude
        from {nation} join {region} on n_regionkey = r_regionkey
    """,
    "clients": """
        select 'CLI-' || cast(c_custkey as string) as client_id,
            'AG-' || cast(c_nationkey as string) as agence_id,
            case when c_mktsegment = 'MACHINERY' then 'Entreprise' else 'Particulier' end as type_client,
            case when c_mktsegment <> 'MACHINERY' and c_custkey % 5 <> 0
                then case when c_custkey % 2 = 0 then 'M.' else 'Mme' end end as civilite,
            'Nom' || cast(c_custkey as string) as nom,
            case when c_mktsegment <> 'MACHINERY' then 'Prenom' || cast(c_custkey % 97 as string) end as prenom,
            case when c_mktsegment = 'MACHINERY' and c_custkey % 3 <> 0 then c_name end as raison_sociale,
            case when c_mktsegment <> 'MACHINERY'
                then date '1940-01-01' + cast((c_custkey * 131) % 24000 as int) end as date_naissance,
            ' Client' || cast(c_custkey as string) || '@Mail.MA ' as email,
            'VILLE_' || cast(c_nationkey as string) as ville,
            'REGION_' || cast(c_nationkey % 5 as string) as region,
            case when c_custkey % 37 <> 0
                then cast(case when c_acctbal > 0 then c_acctbal * 6 else 0 end as double) end as revenu_mensuel,
            cast(300 + (c_custkey * 17) % 551 as int) as score_credit,
            c_mktsegment as segment_client,
            case when c_custkey % 53 <> 0 then
                case when (c_custkey * 17) % 551 >= 450 then 'Faible' when (c_custkey * 17) % 551 >= 350 then 'Moyen'
                    else 'Élevé' end end as niveau_risque_client,
            date '2012-01-01' + cast((c_custkey * 13) % 4000 as int) as date_premier_contact,
            case when c_custkey % 7 = 0 then 'Fermé' when c_custkey % 3 = 0 then 'Inactif' else 'Actif' end as statut_client
        from {customer}
    """,
    "comptes": """
        select 'CPT-' || cast(c_custkey as string) as compte_id, 'CLI-' || cast(c_custkey as string) as client_id,
            'AG-' || cast(c_nationkey as string) as agence_id,
            case when c_custkey % 5 = 0 then 'Compte épargne' when c_custkey % 5 = 1 then 'Compte professionnel'
                when c_custkey % 5 = 2 then 'Compte entreprise' when c_custkey % 5 = 3 then 'Compte jeune'
                else 'Compte courant' end as type_compte,
            c_acctbal as solde, cast((c_custkey % 4) * 50000 as double) as decouvert_autorise,
            date '2014-01-01' + cast((c_custkey * 7) % 3000 as int) as date_ouverture,
            case when c_custkey % 11 = 0 then 'Fermé' else 'Actif' end as statut_compte
        from {customer}
    """,
    "transactions": """
        select o_orderkey as transaction_id,
            case when o_orderpriority <> '4-NOT SPECIFIED' then 'CPT-' || cast(o_custkey as string) end as compte_source_id,
            case when o_orderpriority = '1-URGENT' then 'CPT-' || cast(o_custkey + o_orderkey % 3 as string)
                when o_orderpriority = '4-NOT SPECIFIED' then 'CPT-' || cast(o_custkey as string) end as compte_destination_id,
            'CLI-' || cast(o_custkey as string) as client_id,
            'AG-' || cast((o_custkey * 7 + o_orderkey) % 25 as string) as agence_id,
            o_orderdate as date_transaction, o_orderdate as date_valeur,
            lpad(cast((o_orderkey * 7) % 24 as string), 2, '0') || ':'
                || lpad(cast(o_orderkey % 60 as string), 2, '0') || ':00' as heure_transaction,
            o_totalprice as montant, 'MAD' as devise,
            case o_orderpriority when '1-URGENT' then 'Virement' when '2-HIGH' then 'Paiement'
                when '3-MEDIUM' then 'Retrait' when '4-NOT SPECIFIED' then 'Dépôt' else 'Prélèvement' end as type_transaction,
            case o_orderstatus when 'F' then 'Agence' when 'O' then 'Mobile banking' else 'Carte bancaire' end as canal,
            case when o_orderpriority = '2-HIGH' then case o_orderkey % 3 when 0 then 'Carte' when 1 then 'Espèces'
                else 'Chèque' end end as mode_paiement,
            'Validée' as statut_transaction,
            case when o_orderpriority = '2-HIGH' then case when o_orderkey % 10 = 0 then 'FR' else 'MA' end end as pays_marchand,
            'VILLE_' || cast(o_orderkey % 25 as string) as ville_transaction, 'MA' as pays_origine,
            case when o_orderpriority = '1-URGENT' then case when o_orderkey % 8 = 0 then 'ES' else 'MA' end end as pays_destination,
            cast(case when o_orderpriority = '2-HIGH' then o_totalprice * 0.005 else 0 end as double) as frais_transaction,
            'IP-' || cast(o_custkey as string) || '-' || cast(o_orderkey % 5 as string) as ip_address,
            'DEV-' || cast(o_custkey as string) || '-' || cast(o_orderkey % 4 as string) as device_id,
            case when o_orderkey % 9 = 0 then 1 else 0 end as is_international,
            case when o_orderkey % 7 < 2 then 1 else 0 end as is_weekend,
            case when (o_orderkey * 7) % 24 < 6 or (o_orderkey * 7) % 24 >= 22 then 1 else 0 end as is_night,
            case when (o_totalprice > 420000 and o_orderkey % 3 <> 0)
                or (o_totalprice > 300000 and (o_orderkey * 7) % 24 < 6 and o_orderkey % 2 = 0) then 1 else 0 end as fraud_flag,
            case when o_totalprice > 420000 then 'Score de risque élevé' end as fraud_type,
            case when o_totalprice > 420000 then 'montant_eleve' end as fraud_rule_triggered
        from {orders}
    """,
    "credits": """
        select 'CRD-' || cast(o_orderkey as string) as credit_id, 'CLI-' || cast(o_custkey as string) as client_id,
            'AG-' || cast(o_custkey % 25 as string) as agence_id, o_orderpriority as type_credit,
            o_totalprice as montant_initial,
            cast(12 + 12 * (o_orderkey % 20) as int) as duree_totale_mois,
            cast((o_orderkey * 5) % (12 + 12 * (o_orderkey % 20) + 1) as int) as nombre_echeances_payees,
            cast(0.03 + (o_orderkey % 50) * 0.001 as double) as taux_interet_nominal,
            cast(case when o_orderkey % 10 < 7 then 0 else (o_orderkey * 13) % 401 end as int) as jours_retard,
            case o_orderkey % 5 when 0 then 'Hypothèque' when 1 then 'Nantissement' when 2 then 'Caution personnelle'
                when 3 then 'Garantie autonome' else 'Sans garantie' end as garantie,
            cast(300 + (o_custkey * 17 + o_orderkey) % 551 as int) as score_risque_octroi,
            cast(o_totalprice * 0.25 as double) as montant_restant_du,
            cast(o_totalprice * 0.0125 as double) as provision_constituee,
            cast(o_totalprice / 64 as double) as montant_mensualite,
            cast(6 as int) as duree_restante_mois, 'En cours' as statut_credit, o_orderstatus as classification_bale,
            cast(o_orderdate as date) as date_octroi
        from {orders}
    """,
    "classification_creances": """
        select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || cast(l_partkey as string) || '-'
                || cast(l_suppkey as string) || '-' || cast(l_extendedprice as string) as classification_id,
            'CRD-' || cast(l_orderkey as string) as credit_id, cast(l_shipdate as date) as date_classification,
            case l_returnflag when 'A' then 'Saine' when 'N' then 'Pré-douteuse' else 'Douteuse' end as categorie_reglementaire,
            l_linestatus as categorie_bale_ii, 'Stage 1' as categorie_ifrs9,
            cast((l_partkey * 3 + l_suppkey) % 400 as int) as jours_retard,
            cast(l_discount + 0.01 as double) as probabilite_defaut_pd,
            cast(0.2 + l_tax * 5 as double) as perte_en_cas_defaut_lgd,
            cast(case when l_linenumber = 7 then 0 else l_extendedprice end as double) as exposition_en_cas_defaut_ead,
            cast(l_extendedprice * 0.02 as double) as perte_attendue_el,
            cast(l_extendedprice * 0.025 as double) as provision_requise,
            cast(l_extendedprice * 0.0225 as double) as provision_constituee,
            cast(0.2 as double) as taux_provisionnement
        from {lineitem}
    """,
    "ratios_bruts": """
        select o_orderpriority as agence_id, 'AGENCE' as niveau_consolidation, 'LCR_NSFR' as type_ratio,
            cast(date_trunc('month', o_orderdate) as date) as date_calcul,
            sum(case when o_orderstatus = 'F' then o_totalprice else 0 end) as hqla,
            sum(case when o_orderstatus = 'O' then o_totalprice else 0 end) as sorties,
            sum(case when o_orderstatus <> 'P' then o_totalprice else 0 end) as stable,
            sum(case when o_orderstatus <> 'F' then o_totalprice else 0 end) as requis,
            sum(o_totalprice) as depot_total, sum(o_totalprice * 0.75) as credit_total,
            sum(case when o_orderkey % 3 = 0 then o_totalprice else 0 end) as depot_vue
        from {orders}
        group by o_orderpriority, cast(date_trunc('month', o_orderdate) as date)
    """,
    "scores": """
        select event_id as transaction_id, 'CLI-' || cast(user_id as string) as client_id, user_id, ts as created_at,
            value as montant, event_type, props, value / (value + 40.0) as fraud_proba,
            case event_type when 'purchase' then 'Paiement' when 'signup' then 'Virement' when 'error' then 'Retrait'
                when 'click' then 'Dépôt' else 'Prélèvement' end as type_transaction,
            case when event_id % 29 = 0 then null when (event_type = 'purchase' and value > 30) or value > 150 then 1
                else 0 end as label
        from {events}
    """,
    "saisies": """
        select event_id as ligne, user_id,
            case when event_id % 31 = 0 then 'abc' when event_id % 17 = 0 then '-5' else cast(event_id % 700 as string) end as montant,
            case event_type when 'purchase' then 'Paiement' when 'signup' then 'Virement' when 'error' then 'Retrait'
                when 'click' then 'Dépôt' else 'Prélèvement' end as type_transaction,
            case when event_id % 3 = 0 then 'Chèque' end as mode_paiement,
            case event_id % 11 when 0 then '' when 1 then '14' when 2 then '7.0' when 3 then '14:32' when 4 then '25'
                when 5 then '12:75' when 6 then 'ab' when 7 then null when 8 then ' 23:59 ' when 9 then '5:xx'
                else cast(event_id % 24 as string) end as heure,
            case when event_id % 41 = 0 then '3' else cast(event_id % 2 as string) end as is_weekend
        from {events}
    """,
    "versions": """
        select p_brand as model, cast(p_partkey as int) as version, 'run-' || cast(p_partkey as string) as run_id,
            p_name as run_name, case when p_partkey % 4 <> 0 then p_type end as user,
            date '2024-01-01' + cast(p_partkey % 300 as int) as date
        from {part}
    """,
    "metriques": """
        select case when p_partkey % 13 = 0 then 'essai-' else 'run-' end || cast(p_partkey as string) as run_id, cast(p_size / 64.0 as double) as pr_auc,
            cast(0.5 + p_size / 128.0 as double) as roc_auc, cast(p_size / 16.0 as double) as lift
        from {part}
    """,
    "etats": """
        select case when user_id % 5 = 0 and event_type = 'signup' then null
                when event_id % 3 = 0 then event_id else -event_id end as alert_id, user_id,
            case when user_id % 5 = 0 and event_type = 'signup' then 'tout_lu'
                when event_id % 9 = 0 then 'supprime' else 'lu' end as action, ts as at
        from {events}
    """,
    "journal": """
        select event_id as log_id, user_id, event_type as action, props as details, ts as created_at from {events}
    """,
    "imports": """
        select event_id as import_id, user_id, event_type as filename, ts as created_at,
            case when event_id % 19 = 0 then 'pas du json' when event_id % 23 = 0 then '[]'
                else '[' || repeat('{{"montant":1.5,"decision":"NORMAL","score":0.1}},', cast(event_id % 4 as int))
                    || '{{"montant":2.5,"decision":"' || case when value > 40 then 'FRAUDE' else 'NORMAL' end
                    || '","autre":1}}]' end as results
        from {events}
    """,
    "documents_notes": """
        select d.doc_id, d.lang, d.source, d.n_chars, l.toxic, l.quality
        from {documents} d join {labels} l on d.doc_id = l.doc_id
    """,
}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bank(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One bank table as a Spark plan over the given tables."""
    text = STAND_INS[name]
    used = set(re.findall(r"(?<!\{)\{(\w+)\}", text))
    return spark.sql(text, **{t: given(spark, sf_dir, t) for t in used})


def bank_sql(name: str) -> str:
    """The same projection as DuckDB text over the registered views."""
    return re.sub(r"(?<!\{)\{(\w+)\}", r"\1", STAND_INS[name]).replace("{{", "{").replace("}}", "}")
