"""Explicit schemas of the seven source files.

Inference is never used: it turns ``08:12:33`` into a timestamp of today,
drops the leading 0 of a phone number and reads a long account number as a
float.  Whole-number columns with gaps arrive as ``5411.0``, so they are
doubles here.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Column names and types of the source files.
COLUMNS = {
    "agences": """
        agence_id string, nom_agence string, adresse string, ville string, code_postal int,
        region string, pays string, telephone string, email string, directeur string,
        date_ouverture date, type_agence string, latitude double, longitude double
    """,
    "clients": """
        client_id string, agence_id string, type_client string, civilite string, nom string,
        prenom string, raison_sociale string, date_naissance date, lieu_naissance string,
        nationalite string, email string, telephone string, adresse string, ville string,
        code_postal int, region string, pays string, profession string,
        secteur_activite string, revenu_mensuel double, revenu_annuel double,
        situation_familiale string, nombre_personnes_charge double, ice string, rc string,
        identifiant_fiscal string, forme_juridique string, statut_kyc string,
        score_credit int, segment_client string, niveau_risque_client string,
        score_risque_client double, date_premier_contact date, conseiller_id string,
        statut_client string, date_creation timestamp, date_derniere_maj timestamp
    """,
    "comptes": """
        compte_id string, client_id string, agence_id string, numero_compte string,
        rib string, type_compte string, devise string, solde double,
        solde_disponible double, solde_moyen_30j double, solde_moyen_90j double,
        decouvert_autorise double, taux_interet double, frais_tenue_compte double,
        date_ouverture date, date_fermeture date, statut_compte string,
        plafond_retrait_jour int, plafond_paiement_jour int, nombre_cotitulaires int,
        carte_associee boolean, chequier boolean, date_derniere_operation timestamp,
        nombre_transactions_30j int, volume_transactions_30j double, niveau_risque string,
        indicateur_fraude boolean, date_creation timestamp, date_derniere_maj timestamp
    """,
    "transactions": """
        transaction_id string, compte_source_id string, compte_destination_id string,
        client_id string, agence_id string, date_transaction timestamp,
        date_valeur timestamp, heure_transaction string, montant double, devise string,
        type_transaction string, categorie string, sous_categorie string, canal string,
        mode_paiement string, statut_transaction string, reference_transaction string,
        libelle string, merchant_id string, code_mcc double, nom_marchand string,
        pays_marchand string, ville_transaction string, pays_origine string,
        pays_destination string, numero_carte_masque string, terminal_id string,
        frais_transaction double, taux_change double, solde_avant double,
        solde_apres double, latitude double, longitude double, ip_address string,
        device_id string, is_international int, is_weekend int, is_night int,
        fraud_flag int, fraud_type string, fraud_rule_triggered string,
        date_creation timestamp, decouvert_autorise double, solde_negatif_anormal int
    """,
    "credits": """
        credit_id string, client_id string, agence_id string, compte_id string,
        type_credit string, montant_initial double, montant_restant_du double,
        taux_interet_nominal double, taux_effectif_global double, duree_totale_mois int,
        duree_restante_mois int, montant_mensualite double, date_octroi date,
        date_premiere_echeance date, date_derniere_echeance date,
        date_derniere_mensualite_payee date, nombre_echeances_payees int,
        nombre_echeances_impayees int, jours_retard int, statut_credit string,
        garantie string, valeur_garantie double, objet_financement string,
        score_risque_octroi int, classification_bale string, provision_constituee double,
        date_dernier_incident date, nombre_incidents_paiement int,
        conseiller_credit_id string, date_creation timestamp, date_derniere_maj timestamp
    """,
    "classification_creances": """
        classification_id string, credit_id string, client_id string,
        date_classification date, categorie_reglementaire string, categorie_bale_ii string,
        categorie_ifrs9 string, jours_retard int, probabilite_defaut_pd double,
        perte_en_cas_defaut_lgd double, exposition_en_cas_defaut_ead double,
        perte_attendue_el double, provision_requise double, provision_constituee double,
        taux_provisionnement double, indicateur_forborne int, date_restructuration date,
        indicateur_contentieux int, date_entree_contentieux date,
        motif_classification string, observation string, validateur_id string,
        date_validation timestamp, date_prochaine_revue timestamp
    """,
    "ratios_liquidite": """
        ratio_id string, date_calcul date, periode string, agence_id string,
        niveau_consolidation string, type_ratio string, lcr_actifs_liquides double,
        lcr_sorties_nettes double, lcr_ratio double, lcr_conforme boolean,
        nsfr_financement_stable double, nsfr_financement_requis double, nsfr_ratio double,
        nsfr_conforme boolean, depot_total double, credit_total double,
        ratio_credit_depot double, tresorerie_disponible double, reserve_obligatoire double,
        ratio_reserve double, top_10_deposants_pct double, depot_vue double,
        depot_terme double, ratio_depot_vue double, ecart_liquidite_1_mois double,
        ecart_liquidite_3_mois double, ecart_liquidite_1_an double, statut_global string,
        alerte_niveau string, seuil_reglementaire_respecte int, commentaire string,
        analyste_id string, date_creation timestamp
    """,
}

# Primary key of each entity.
KEYS = {
    "agences": "agence_id",
    "clients": "client_id",
    "comptes": "compte_id",
    "transactions": "transaction_id",
    "credits": "credit_id",
    "classification_creances": "classification_id",
    "ratios_liquidite": "ratio_id",
}


def schema_of(entity: str) -> StructType:
    if entity not in COLUMNS:
        raise ValueError(f"unknown entity {entity!r}; one of {sorted(COLUMNS)}")
    return StructType.fromDDL(" ".join(COLUMNS[entity].split()))
