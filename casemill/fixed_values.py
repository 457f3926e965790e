"""Code lists, phrases and template names that results must carry exactly."""

from __future__ import annotations

# --- ICD-10 codes -----------------------------------------------------------------------------------

LYMPH_NODE_METASTASES = ["C770", "C771", "C772", "C773", "C774", "C775", "C778", "C779"]
DISTANT_METASTASES = [
    "C780", "C781", "C782", "C783", "C784", "C785", "C786", "C787", "C788",
    "C790", "C791", "C792", "C793", "C794", "C795", "C796", "C797", "C798",
]
INTRACTABLE_PAIN = ["R5210", "R5218"]
ASCITES = ["R18"]
PLEURAL_EFFUSION = ["J90", "J91", "J940", "J941", "J942", "J948", "J949"]
COSMETIC_SURGERY = ["Z410", "Z411"]
COMFORT_INTERVENTION = ["Z4180"]
PLASTIC_SURGERY = ["Z420", "Z421", "Z423", "Z424", "Z425", "Z426", "Z427", "Z428", "Z429"]
ENDOSCOPIC_TREATMENT = ["C186"]
DRUG_TREATMENT = ["Z512"]
NO_FLARE_PARENTS = ["E05", "J45", "K85"]
TREATED_CASE_TYPES = ["DP", "Z511"]

# --- Stay groups ------------------------------------------------------------------------------------

CHEMOTHERAPY_GROUPS = ["28Z07", "17M05", "17M06"]
RADIOTHERAPY_GROUPS = [
    "17K04", "17K05", "17K08", "17K09", "28Z10", "28Z11", "28Z18", "28Z19", "28Z20", "28Z21", "28Z22", "28Z23", "28Z24", "28Z25",
]
TRANSFUSION_GROUPS = ["28Z14"]
APHERESIS_GROUPS = ["28Z16"]
PALLIATIVE_GROUPS = ["23Z02"]
STOMA_GROUPS = ["06M17"]
DECEASED_GROUPS = ["04M24"]
VAGINAL_DELIVERY_GROUPS = ["14C03", "14Z09", "14Z10", "14Z11", "14Z12", "14Z13", "14Z14"]
CSECTION_GROUPS = ["14C06", "14C07", "14C08"]
DELIVERY_GROUPS = VAGINAL_DELIVERY_GROUPS + CSECTION_GROUPS

# --- Procedures -------------------------------------------------------------------------------------

CSECTION_PROCEDURES = ["JQGA002", "JQGA003", "JQGA004", "JQGA005"]

# --- Values that count as not given -----------------------------------------------------------------

NOT_GIVEN = ["Variable", "Non pertinent"]

# --- Phrases of the hospitalisation context (spelling and spacing as they stand) ----------------------

OUTPATIENT = " en hospitalisation ambulatoire"
INPATIENT = "en hospialisation complète"

SITUATION = {
    "cancer_care": "Hospitalisation pour prise en charge du cancer",
    "overnight": "Prise en charge pour exploration nocturne ou apparentée telle",
    "sensitization": "Prise en charge en hospitalistion de jour pour réalisation de test de réactivité allergiques",
    "care_for": "Prise en charge pour ",
    "ascites": "Prise en charge pour ponction d'ascite  ",
    "pleural": "Prise en charge pour ponction pleurale ",
    "toxin": "Prise en charge en hospitalisation ambulatoire pour injection de toxine botulique",
    "pain": "Prise en charge d'une douleur chronique rebelle ",
    "care": "Prise en charge ",
    "for": " pour ",
    "palliative": " pour soins palliatifs",
    "legal_abortion": "Prise en charge pour interruption volontaire de grossesse",
    "medical_abortion": "Prise en charge pour interruption médicale de grossesse",
    "csection": "Prise en charge pour accouchement par césarienne",
    "vaginal": "Prise en charge pour accouchement par voie basse",
    "deceased": "Hospitalisation au cours de laquelle le patient est décédé",
    "chemotherapy": "pour cure de chimiothérapie",
    "regimen": ". Le protocole actuellement suivi est : ",
    "drug": "pour administration d'un traitement médicamenteux nécessitant une hospitalisation",
    "radiotherapy": " pour réalisation du traitement par radiothérapie",
    "first_stay": "Première hospitalisation ",
    "discovery": " pour découverte de ",
    "stay": "Hospitalisation ",
    "work_up": " pour bilan initial pré-trérapeutique de ",
    "relapse": " pour rechutte après traitement de  ",
    "strategy": " pour changement de stratégie thérapeutique  ",
    "flare": " pour poussée aigue de la maladie  ",
    "supervision": "Surveillance ",
    "of": " de ",
    "main_diagnosis": "Pour prise en charge diagnostique et thérapeutique du diagnotic principal ",
    "other_care": "Pour prise en charge ",
}

# --- Lines of the long scenario -----------------------------------------------------------------------

PROMPT = {
    "title": "**SCÉNARIO DE DÉPART :**\n",
    "age": "- Âge du patient : ",
    "years": " ans\n",
    "sex": "- Sexe du patient : ",
    "entry": "- Date d'entrée : ",
    "discharge": "- Date de sortie : ",
    "birth": "- Date de naissance : ",
    "last_name": "- Nom du patient : ",
    "first_name": "- Prénom du patient : ",
    "site": "- Localisation anatomique de la tumeur primaire : ",
    "histology": "- Type anatomopathologique de la tumeur primaire : ",
    "histology_free": "Vous choisirez vous même un type histologique cohérent avec la localisation anatomique",
    "tnm": "- Score TNM : ",
    "tnm_free": "Si la notion de score de TNM est pertinente avec le type histologique et la localisation anatomique, "
    "vous choisirez un score TNM",
    "stage": "- Stade tumoral : ",
    "biomarkers": "- Biomarqueurs tumoraux : ",
    "biomarkers_free": "Vous choisirez des biomarqueurs tumoraux cohérents avec la localisation anatomique et l'histologie de la tumeur",
    "admission": "- Mode d'entrée' : ",
    "disposition": "- Mode de sortie' : ",
    "context": "- Contexte de l'hospitalisation : ",
    "coding": "- Codage CIM10 :\n",
    "main": "   * Diagnostic principal : ",
    "associated": "   * Diagnostic associés : \n",
    "procedure": "* Acte CCAM :\n",
    "physician": "- Nom du médecin / signataire : ",
    "department": "- Service : ",
    "hospital": "- Hôpital : ",
    "cancer_case": "Ce cas clinique concerne un patient présentant un cancer\n",
    "episode": "Vous choisirez un épisode de traitement sachant que les recommandations pour ce stade du cancer sont les suivantes :\n",
    "recommendation": "   - Schéma thérapeutique : ",
    "regimen": "   - Protocole de chimiothérapie : ",
    "precise": "Veillez à bien préciser le type histologique et la valeur des biomarqueurs si recherchés\n",
}

# --- Column names of the extracts -> names used here ----------------------------------------------------

PROFILE_NAMES = {
    "racine": "drg_parent_code",
    "diagnostic_associes": "icd_secondary_code",
    "diag2": "icd_primary_code",
    "mdp": "case_management_type",
    "n": "nb",
    "mode_entree": "admission_mode",
    "mode_sortie": "discharge_disposition",
    "mode_hospit": "admission_type",
    "duree": "los",
    "agean": "age2",
    "nbda": "nb_associated",
}
SECONDARY_NAMES = {
    "racine": "drg_parent_code",
    "das": "icd_secondary_code",
    "diag": "icd_primary_code",
    "categ_cim": "icd_primary_parent_code",
    "mdp": "case_management_type",
    "nb_situations": "nb",
    "acte": "procedure",
    "mode_entree": "admission_mode",
    "mode_sortie": "discharge_disposition",
    "mode_hospit": "admission_type",
}

# --- Files of the table cohort: name -> CSV file, and their columns ---------------------------------------

TABLE_FILES = {
    "dp": "PMSI_DP.csv",
    "ccam": "PMSI_CCAM_DP.csv",
    "das": "PMSI_DAS.csv",
    "dms": "PMSI_DMS.csv",
    "rghm": "ALL_CLASSIF_PMSI.csv",
    "cim10": "ALL_CIM10.csv",
    "ccam_ref": "ALL_CCAM.csv",
}
TABLE_SCHEMAS = {
    "dp": "AGE string, SEXE string, GHM5 string, DP string, P_DP double",
    "ccam": "GHM5 string, DP string, CCAM string, P_CCAM double",
    "das": "GHM5 string, AGE string, SEXE string, DP string, DAS string, P_DAS double",
    "dms": "GHM5 string, DMS_P25 double, DMS_P50 double, DMS_P75 double",
    "rghm": "champ string, version string, type_code string, code string, lib string",
    "cim10": "code string, liblong string, en_cours int",
    "ccam_ref": "code string, liblong string, en_cours int",
}

# --- Files of the profile cohort --------------------------------------------------------------------------

CODE_LIST_FILES = {
    "icd_codes_chronic_attack": "icd_codes_chronic_attack.csv",
    "procedure_botulic_toxin": "procedure_botulic_toxine.csv",
    "icd_codes_prophylactic_intervention": "icd_codes_prophylactic_intervention.csv",
    "attention_artificial_openings_external_prosthetic_device": "attention_artificial_openings_external_prosthetic_device.csv",
    "icd_codes_iron_deficiency_anemia": "icd_codes_iron_deficiency_anemia.csv",
    "icd_codes_sessions": "icd_codes_sessions.csv",
    "icd_codes_diabetes_chronic": "icd_codes_diabetes_chronic.csv",
    "icd_codes_spontaneous_vertex_delivery": "icd_codes_spontaneous_vertex_delivery.csv",
    "icd_codes_liveborn_infants": "icd_codes_liveborn_infants.csv",
    "icd_codes_medical_abortion": "icd_codes_medical_abortion.csv",
    "icd_codes_legal_abortion": "icd_codes_legal_abortion.csv",
    "icd_codes_supervision": "icd_codes_supervision.csv",
    "icd_codes_supervision_chronic_disease": "icd_codes_supervision_chronic_disease.csv",
    "icd_codes_surgical_followup": "icd_codes_surgical_followup.csv",
    "icd_codes_supervision_pregnancy": "icd_codes_supervision_pregnancy.csv",
    "icd_codes_supervision_post_partum": "icd_codes_supervision_post_partum.csv",
    "icd_codes_cardic_vascular_implants": "icd_codes_cardic_vascular_implants.csv",
    "icd_codes_overnight_study": "icd_codes_overnight_study.csv",
    "icd_codes_sensitization_tests": "icd_codes_sensitization_tests.csv",
    "icd_codes_preoperative_assessment": "icd_codes_preoperative_assessment.csv",
    "icd_codes_family_history": "icd_codes_family_history.csv",
    "icd_codes_personnel_history": "icd_codes_personnel_history.csv",
}
REFERENCE_PARQUET = {
    "icd_official": ("CIM_ATIH_2025/LIBCIM10MULTI.parquet", {}),
    "drg_statistics": ("stat_racines.parquet", {"racine": "drg_parent_code", "dms": "los_mean", "dsd": "los_sd"}),
    "drg_parents_groups": (
        "ghm_rghm_regroupement_2024.parquet",
        {"racine": "drg_parent_code", "libelle_racine": "drg_parent_description"},
    ),
    "chronic": ("Affections chroniques.parquet", {}),
    "specialty": (
        "dictionnaire_spe_racine.parquet",
        {"racine": "drg_parent_code", "lib_spe_uma": "specialty", "ratio_spe_racine": "ratio"},
    ),
    "procedure_official": ("ccam_actes_2024.parquet", {"code": "procedure", "libelle_long": "procedure_description"}),
    "cancer_codes": ("REFERENTIEL_METHODE_DIM_CANCER_20140411__CODES_CIM-10_CANCER.parquet", {}),
    "cancer_treatment": (
        "Tableau récapitulatif traitement cancer__Feuille_1.parquet",
        {
            "Code CIM": "icd_parent_code",
            "Localisation": "primary_site",
            "Type Histologique": "histological_type",
            "Stade": "stage",
            "Marqueurs Tumoraux": "biomarkers",
            "Traitement": "treatment_recommandation",
            "Protocole de Chimiothérapie": "chemotherapy_regimen",
        },
    ),
}
SYNONYM_FILE, SYNONYM_NAMES = "cim_synonymes.csv", {"dictionary_keys": "icd_code_description", "code": "icd_code"}
COMPLICATION_FILE, EXCLUSION_FILE = "cma.csv", "exclusions"
NAME_FILE, HOSPITAL_FILE = "prenoms_nom_sexe.csv", "chu"
WEIGHT_FILE, WEIGHT_NAMES = "ponderation_code_categ.csv", {"diag": "icd_code", "ponderation": "weight"}
EXTRACT_PATTERNS = {
    "profiles": ["scenarios_*.parquet", "scenarios_*"],
    "secondary_icd": ["bn_pmsi_related_diag_*.csv"],
    "procedures": ["bn_pmsi_procedures_*.csv"],
}
DICTIONARY_COLUMNS = ["icd_code", "aut_mco", "pos", "aut_ssr", "icd_code_description_short", "icd_code_description"]
RULE_FIELDS = {"list": "regles", "id": "id", "text": "clinical_coding_scenario", "criteria": "classification_profile_criteria"}
