"""Decode tables, code systems and names that results must reproduce exactly."""

# Decode tables.
SEX = {"F": "Female", "M": "Male"}
ETHNICITY = {"hispanic": "Hispanic or Latino", "nonhispanic": "Not Hispanic or Latino"}
MARITAL_STATUS = {"M": "Married", "S": "Single", "D": "Divorced", "W": "Widowed"}
CARE_SETTING = {
    "inpatient": "Inpatient",
    "emergency": "Emergency",
    "urgentcare": "Urgent Care",
    "ambulatory": "Outpatient",
    "outpatient": "Outpatient",
    "wellness": "Outpatient",
    "virtual": "Virtual",
    "snf": "Post-Acute",
    "hospice": "Post-Acute",
    "home": "Post-Acute",
}
FHIR_CARE_SETTING = (("%inpatient%", "Inpatient"), ("%emergency%", "Emergency"))
FHIR_DEFAULT_SETTING = "Outpatient"
CLAIM_TYPE = {"1": "Professional", "2": "Institutional"}
TRANSFER_TO = {"1": "Primary Insurance", "2": "Secondary Insurance", "p": "Patient"}
PAYMENT_METHOD = {"CC": "Credit Card", "ECHECK": "Electronic Check"}
PAYER_CATEGORY = {
    "medicare": "Medicare",
    "medicare_advantage": "Medicare Advantage",
    "medicaid": "Medicaid",
    "dual": "Dual Eligible",
    "commercial": "Commercial",
    "self_pay": "Self-Pay",
}
PAYER_NAME = {"NO_INSURANCE": "No Insurance"}
SEVERITY = (("SEVERE", "Severe"), ("MODERATE", "Moderate"), ("MILD", "Mild"))

# Codes and classes.
ADMINISTRATIVE_CODE = "308646001"
SIMULATION_CODES = ("QOLS", "QALY", "DALY")
TRANSACTION_TYPES = ("CHARGE", "PAYMENT", "ADJUSTMENT", "TRANSFERIN", "TRANSFEROUT")
CLINICAL_CLASSES = ("diagnosis", "symptom", "history", "pregnancy")
HRRP_GROUPS = ("AMI", "HF", "PNEUMONIA", "COPD")
EXCLUDED_STAY_CATEGORIES = ("cancer_treatment", "post_surgical_care")
EXCLUDED_REASON_PREFIX = "F"
ABNORMAL_FLAGS = ("low", "high", "critical_low", "critical_high")
SELF_PAY = "self_pay"
# (category not counted, category that overrides it, points taken off)
CHARLSON_OVERLAPS = (("diabetes_uncomplicated", "diabetes_complicated", 1),)
ED_ADMISSION_POINTS = 3
READMISSION_BENCHMARK = 0.14

# FHIR names.
SNOMED_SYSTEM = "http://snomed.info/sct"
ICD10CM_SYSTEM = "http://hl7.org/fhir/sid/icd-10-cm"
RACE_EXTENSION = "us-core-race"
ETHNICITY_EXTENSION = "us-core-ethnicity"
UNLANDED_RESOURCES = ("Claim", "ExplanationOfBenefit", "Provenance")

# Source systems and landing names.
CSV_SYSTEM = "synthea"
FHIR_SYSTEM = "epic_fhir_sandbox"
FHIR_SOURCES = {"epic_fhir_sandbox": "epic_fhir", "synthea": "synthea_fhir"}
CSV_ROOT = "synthea_csv"
CSV_TABLES = (
    "patients", "organizations", "providers", "payers", "payer_transitions", "encounters", "conditions",
    "procedures", "observations", "medications", "immunizations", "allergies", "claims", "claims_transactions",
)
LOOKUP_ROOT = "reference"
LOOKUPS = {
    "condition_map": "snomed_icd10cm_conditions",
    "procedure_map": "procedure_code_map",
    "procedure_rules": "procedure_category_rules",
    "vaccine_map": "immunization_cvx_cpt",
    "payer_profile": "payer_profile",
    "lab_panels": "lab_panels",
    "lab_ranges": "lab_reference_ranges",
    "charlson_weights": "charlson_weights",
    "lace_points": "lace_points",
    "planned_rules": "planned_admission_rules",
}

# Expectation failures that are known faults of the source data.
KNOWN_FAILURES = ("silver.claim.has_principal_diagnosis", "silver.medication.stop_not_before_start")
