"""Silver: one typed, deduplicated and code-mapped row per entity.

Each builder takes the raw tables by name and returns a DataFrame; nothing is written here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_lake import fixed
from care_lake.functions.clean import (
    decode,
    ilike_case,
    is_open,
    max_severity,
    money,
    null_if,
    ref_id,
    safe_cast,
    squeeze_ws,
    strip_digits,
    strip_suffix,
    surrogate_key,
    title,
    ts_to_date,
)
from care_lake.functions.fhir import coding_code, extension_text, jpath, with_doc
from care_lake.operators.dedup import latest_by, union_sources
from care_lake.operators.lookups import abnormal_flag, map_code, map_with_rules
from care_lake.session import staged

Tables = Mapping[str, DataFrame]


def _columns(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def _from_csv(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select the typed columns and add the source tag and lineage of a CSV row."""
    tags = {"source_system": F.lit(fixed.CSV_SYSTEM), "run_id": "_run_id", "bronze_ingested_at": "_ingested_at"}
    return _columns(df, {**columns, **tags})


def _newest(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Newest copy of each key. The visit goes first: it tells more rows apart than the patient, so sorts seldom compare the rest."""
    return latest_by(df, sorted(key, key="ENCOUNTER".__ne__))


def _resources(t: Tables, kind: str) -> DataFrame:
    """Newest copy of each resource of one kind, parsed once."""
    rows = t["fhir_resources"].filter(
        (F.col("source_system") == fixed.FHIR_SYSTEM) & (F.col("resource_type") == kind)
    )
    return with_doc(latest_by(rows, ["resource_id"]))


def _from_fhir(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    tags = {"source_system": F.lit(fixed.FHIR_SYSTEM), "run_id": "run_id", "bronze_ingested_at": "ingested_at"}
    return _columns(df, {**columns, **tags})


def build_patient(t: Tables) -> DataFrame:
    csv = _from_csv(latest_by(t["patients"], ["Id"]), {
        "patient_id": "Id",
        "first_name": strip_digits("FIRST"),
        "middle_name": strip_digits("MIDDLE"),
        "last_name": strip_digits("LAST"),
        "birth_date": safe_cast("BIRTHDATE", "date"),
        "death_date": safe_cast("DEATHDATE", "date"),
        "is_deceased": F.col("DEATHDATE").isNotNull(),
        "sex": decode("GENDER", fixed.SEX),
        "race": title("RACE"),
        "ethnicity": decode("ETHNICITY", fixed.ETHNICITY),
        "marital_status": decode("MARITAL", fixed.MARITAL_STATUS, F.lit("Unknown")),
        "address": "ADDRESS",
        "city": "CITY",
        "state": "STATE",
        "county": "COUNTY",
        "zip": "ZIP",
        "latitude": safe_cast("LAT", "double"),
        "longitude": safe_cast("LON", "double"),
        "household_income": safe_cast("INCOME", "int"),
    })
    fhir = _from_fhir(_resources(t, "Patient"), {
        "patient_id": "resource_id",
        "first_name": jpath("name[0].given[0]"),
        "middle_name": jpath("name[0].given[1]"),
        "last_name": jpath("name[0].family"),
        "birth_date": safe_cast(jpath("birthDate"), "date"),
        "death_date": safe_cast(jpath("deceasedDateTime"), "date"),
        "is_deceased": F.coalesce(jpath("deceasedBoolean", "boolean"), jpath("deceasedDateTime").isNotNull()),
        "sex": title(jpath("gender")),
        "race": extension_text(fixed.RACE_EXTENSION),
        "ethnicity": extension_text(fixed.ETHNICITY_EXTENSION),
        "marital_status": F.coalesce(jpath("maritalStatus.text"), F.lit("Unknown")),
        "address": jpath("address[0].line[0]"),
        "city": title(jpath("address[0].city")),
        "state": jpath("address[0].state"),
        "county": jpath("address[0].district"),
        "zip": jpath("address[0].postalCode"),
    })
    return union_sources(csv, fhir)


def build_encounter(t: Tables) -> DataFrame:
    raw = map_code(latest_by(t["encounters"], ["Id"]), t["condition_map"], "REASONCODE", "snomed_code", {
        "icd10cm_code": "reason_icd10cm_code",
        "condition_class": "reason_condition_class",
        "cohort": "reason_condition_group",
    })
    csv = _from_csv(raw, {
        "encounter_id": "Id",
        "patient_id": "PATIENT",
        "organization_id": "ORGANIZATION",
        "provider_id": "PROVIDER",
        "payer_id": "PAYER",
        "encounter_class": "ENCOUNTERCLASS",
        "care_setting": decode("ENCOUNTERCLASS", fixed.CARE_SETTING),
        "encounter_type_code": "CODE",
        "encounter_type": strip_suffix("DESCRIPTION"),
        "encounter_status": F.lit("finished"),
        "is_administrative": F.col("CODE") == fixed.ADMINISTRATIVE_CODE,
        "start_ts": safe_cast("START", "timestamp"),
        "end_ts": safe_cast("STOP", "timestamp"),
        "start_date": ts_to_date("START"),
        "end_date": ts_to_date("STOP"),
        "reason_snomed_code": "REASONCODE",
        "reason_description": strip_suffix("REASONDESCRIPTION"),
        "reason_icd10cm_code": "reason_icd10cm_code",
        "reason_condition_class": "reason_condition_class",
        "reason_condition_group": "reason_condition_group",
        "base_encounter_cost": money("BASE_ENCOUNTER_COST"),
        "total_claim_cost": money("TOTAL_CLAIM_COST"),
        "payer_coverage": money("PAYER_COVERAGE"),
    })
    start, end = jpath("period.start", "timestamp"), jpath("period.end", "timestamp")
    fhir = _from_fhir(_resources(t, "Encounter"), {
        "encounter_id": "resource_id",
        "patient_id": ref_id(jpath("subject.reference")),
        "organization_id": ref_id(jpath("serviceProvider.reference")),
        "provider_id": ref_id(jpath("participant[0].individual.reference")),
        "encounter_class": jpath("class.display"),
        "care_setting": ilike_case(
            jpath("class.display"), fixed.FHIR_CARE_SETTING, fixed.FHIR_DEFAULT_SETTING
        ),
        "encounter_type_code": jpath("type[0].coding[0].code"),
        "encounter_type": jpath("type[0].text"),
        "encounter_status": jpath("status"),
        "is_administrative": F.lit(False),
        "start_ts": start,
        "end_ts": end,
        "start_date": F.to_date(start),
        "end_date": F.to_date(end),
        "reason_description": jpath("reasonCode[0].text"),
    })
    return union_sources(csv, fhir)


def build_condition(t: Tables) -> DataFrame:
    mapping = {c: f"_ref_{c}" for c in (
        "snomed_code", "icd10cm_code", "condition_class", "cohort", "charlson_category", "chronic_yn",
        "sdoh_domain", "map_quality",
    )}
    from_map = {
        "condition_group": "_ref_cohort",
        "charlson_category": "_ref_charlson_category",
        "is_chronic": F.col("_ref_chronic_yn") == "Y",
        "sdoh_domain": "_ref_sdoh_domain",
    }
    key = ["PATIENT", "ENCOUNTER", "CODE", "START"]
    raw = map_code(_newest(t["conditions"], key), t["condition_map"], "CODE", "snomed_code", mapping)
    mapped = F.col("_ref_icd10cm_code")
    csv = _from_csv(raw, {
        "condition_id": surrogate_key(*key),
        "patient_id": "PATIENT",
        "encounter_id": "ENCOUNTER",
        "start_date": safe_cast("START", "date"),
        "stop_date": safe_cast("STOP", "date"),
        "is_active": is_open("STOP"),
        "snomed_code": "CODE",
        "description": strip_suffix("DESCRIPTION"),
        "icd10cm_code": mapped,
        "icd10_source": F.when(mapped.isNotNull(), "reference_map"),
        "condition_class": "_ref_condition_class",
        **from_map,
        "map_quality": "_ref_map_quality",
    })
    stop = safe_cast(jpath("abatementDateTime"), "date")
    parsed = _resources(t, "Condition").withColumns({
        "_stop": stop,
        "_snomed": coding_code(fixed.SNOMED_SYSTEM),
        "_icd10": coding_code(fixed.ICD10CM_SYSTEM),
    })
    coded = map_code(parsed, t["condition_map"], "_snomed", "snomed_code", mapping)
    given = F.col("_icd10").isNotNull()
    fhir = _from_fhir(coded, {
        "condition_id": "resource_id",
        "patient_id": ref_id(jpath("subject.reference")),
        "encounter_id": null_if(ref_id(jpath("encounter.reference")), ""),
        "start_date": F.coalesce(
            safe_cast(jpath("onsetDateTime"), "date"), safe_cast(jpath("recordedDate"), "date")
        ),
        "stop_date": "_stop",
        "is_active": F.coalesce(jpath("clinicalStatus.coding[0].code") == "active", is_open("_stop")),
        "snomed_code": "_snomed",
        "description": jpath("code.text"),
        "icd10cm_code": "_icd10",
        "icd10_source": F.when(given, "source"),
        "condition_class": F.coalesce(F.col("_ref_condition_class"), F.when(given, "diagnosis")),
        **from_map,
        "map_quality": F.when(F.col("_ref_snomed_code").isNull(), "source").otherwise(F.col("_ref_map_quality")),
    })
    return union_sources(csv, fhir)


def _texts_of_newest(rows: DataFrame, key: Sequence[str], code: str, text: str) -> DataFrame:
    """Distinct pairs of code and text among the newest copies, where the code is part of the key.

    A code that never had another text keeps it whatever copy is the newest, so copies are compared for the other codes alone.
    """
    pairs = staged(rows.select(code, text).distinct(), "procedures", "zstd")
    several = pairs.groupBy(F.col(code).alias("_several")).count().filter("count > 1").select("_several")
    changed = F.col(code) == F.col("_several")
    newest = _newest(rows.join(several, changed, "left_semi"), key).select(code, text).distinct()
    return pairs.join(several, changed, "left_anti").unionByName(newest)


def build_procedure(t: Tables) -> DataFrame:
    key = ["PATIENT", "ENCOUNTER", "CODE", "START"]
    known = F.col("CODE") == F.col("_known")
    unmapped = t["procedures"].join(t["procedure_map"].select(F.col("snomed_code").alias("_known")), known, "left_anti")
    billed = map_with_rules(
        _newest(t["procedures"], key), "CODE", "DESCRIPTION", t["procedure_map"], "snomed_code",
        t["procedure_rules"],
        {
            "cpt_hcpcs": "billing_code",
            "code_system": "billing_code_system",
            "service_category": "service_category",
            "billable_yn": "_billable",
        },
        texts=_texts_of_newest(unmapped, key, "CODE", "DESCRIPTION"),
    )
    raw = map_code(billed, t["condition_map"], "REASONCODE", "snomed_code", {"icd10cm_code": "reason_icd10cm_code"})
    return _from_csv(raw, {
        "procedure_id": surrogate_key(*key),
        "patient_id": "PATIENT",
        "encounter_id": "ENCOUNTER",
        "start_ts": safe_cast("START", "timestamp"),
        "end_ts": safe_cast("STOP", "timestamp"),
        "procedure_date": ts_to_date("START"),
        "snomed_code": "CODE",
        "description": strip_suffix("DESCRIPTION"),
        "billing_code": "billing_code",
        "billing_code_system": "billing_code_system",
        "service_category": "service_category",
        "is_billable": F.col("_billable") == "Y",
        "code_mapping": "code_mapping",
        "base_cost": money("BASE_COST"),
        "reason_snomed_code": "REASONCODE",
        "reason_description": strip_suffix("REASONDESCRIPTION"),
        "reason_icd10cm_code": "reason_icd10cm_code",
    })


def build_observation(t: Tables) -> DataFrame:
    key = ["PATIENT", "ENCOUNTER", "DATE", "CODE", "VALUE"]
    recorded = t["observations"].filter(~F.col("CODE").isin(*fixed.SIMULATION_CODES))
    is_lab = F.col("CATEGORY") == "laboratory"
    bounds = ["reference_low", "reference_high", "critical_low", "critical_high"]
    paneled = map_code(
        _newest(recorded, key), t["lab_panels"], "CODE", "loinc_code",
        {"panel_name": "lab_panel", "component_short_name": "lab_component"}, when=is_lab,
    )
    ranged = map_code(
        paneled, t["lab_ranges"], "CODE", "loinc_code", {"loinc_code": "_has_range", **{b: b for b in bounds}}
    )
    number = F.when(F.col("TYPE") == "numeric", safe_cast("VALUE", "double"))
    low, high, critical_low, critical_high = (safe_cast(b, "double") for b in bounds)
    applies = ~F.coalesce(F.col("CATEGORY") != "laboratory", F.lit(False)) & F.col("_has_range").isNotNull()
    return _from_csv(ranged, {
        "observation_id": surrogate_key(*key),
        "patient_id": "PATIENT",
        "encounter_id": "ENCOUNTER",
        "observation_ts": safe_cast("DATE", "timestamp"),
        "observation_date": ts_to_date("DATE"),
        "category": "CATEGORY",
        "loinc_code": "CODE",
        "description": "DESCRIPTION",
        "lab_panel": "lab_panel",
        "lab_component": "lab_component",
        "value_type": "TYPE",
        "value_text": "VALUE",
        "value_numeric": number,
        "units": "UNITS",
        "reference_low": low,
        "reference_high": high,
        "abnormal_flag": abnormal_flag(number, low, high, critical_low, critical_high, applies),
    })


def build_medication(t: Tables) -> DataFrame:
    key = ["PATIENT", "ENCOUNTER", "CODE", "START", "STOP"]
    raw = map_code(_newest(t["medications"], key), t["condition_map"], "REASONCODE", "snomed_code", {
        "icd10cm_code": "reason_icd10cm_code", "cohort": "reason_condition_group",
    })
    return _from_csv(raw, {
        "medication_order_id": surrogate_key(*key, null_as={"STOP": ""}),
        "patient_id": "PATIENT",
        "encounter_id": "ENCOUNTER",
        "payer_id": "PAYER",
        "start_ts": safe_cast("START", "timestamp"),
        "stop_ts": safe_cast("STOP", "timestamp"),
        "is_active": is_open("STOP"),
        "rxnorm_code": "CODE",
        "description": "DESCRIPTION",
        "dispenses": safe_cast("DISPENSES", "int"),
        "base_cost_per_dispense": money("BASE_COST"),
        "payer_coverage": money("PAYER_COVERAGE"),
        "total_cost": money("TOTALCOST"),
        "reason_snomed_code": "REASONCODE",
        "reason_description": strip_suffix("REASONDESCRIPTION"),
        "reason_icd10cm_code": "reason_icd10cm_code",
        "reason_condition_group": "reason_condition_group",
    })


def build_immunization(t: Tables) -> DataFrame:
    key = ["PATIENT", "ENCOUNTER", "CODE", "DATE"]
    raw = map_code(latest_by(t["immunizations"], key), t["vaccine_map"], "CODE", "cvx_code", {
        "cpt_code": "cpt_code", "short_name": "vaccine_short_name",
    })
    return _from_csv(raw, {
        "immunization_id": surrogate_key(*key),
        "patient_id": "PATIENT",
        "encounter_id": "ENCOUNTER",
        "administered_ts": safe_cast("DATE", "timestamp"),
        "administered_date": ts_to_date("DATE"),
        "cvx_code": "CODE",
        "description": squeeze_ws("DESCRIPTION"),
        "cpt_code": "cpt_code",
        "vaccine_short_name": "vaccine_short_name",
        "base_cost": money("BASE_COST"),
    })


def build_allergy(t: Tables) -> DataFrame:
    key = ["PATIENT", "ENCOUNTER", "CODE", "START"]
    return _from_csv(latest_by(t["allergies"], key), {
        "allergy_id": surrogate_key(*key),
        "patient_id": "PATIENT",
        "encounter_id": "ENCOUNTER",
        "start_date": safe_cast("START", "date"),
        "stop_date": safe_cast("STOP", "date"),
        "is_active": is_open("STOP"),
        "allergen_code": "CODE",
        "allergen_code_system": "SYSTEM",
        "allergen": strip_suffix("DESCRIPTION"),
        "allergy_type": title("TYPE"),
        "allergy_category": title("CATEGORY"),
        "reaction_1": strip_suffix("DESCRIPTION1"),
        "reaction_1_severity": title("SEVERITY1"),
        "reaction_2": strip_suffix("DESCRIPTION2"),
        "reaction_2_severity": title("SEVERITY2"),
        "highest_severity": max_severity(fixed.SEVERITY, "SEVERITY1", "SEVERITY2"),
    })


def build_provider(t: Tables) -> DataFrame:
    csv = _from_csv(latest_by(t["providers"], ["Id"]), {
        "provider_id": "Id",
        "provider_name": strip_digits("NAME"),
        "sex": decode("GENDER", fixed.SEX),
        "specialty": title("SPECIALITY"),
        "organization_id": "ORGANIZATION",
        "npi": "NPI",
        "address": "ADDRESS",
        "city": "CITY",
        "state": "STATE",
        "zip": "ZIP",
        "latitude": safe_cast("LAT", "double"),
        "longitude": safe_cast("LON", "double"),
    })
    fhir = _from_fhir(_resources(t, "Practitioner"), {
        "provider_id": "resource_id",
        "provider_name": F.coalesce(
            jpath("name[0].text"), F.concat_ws(" ", jpath("name[0].given[0]"), jpath("name[0].family"))
        ),
        "sex": title(jpath("gender")),
    })
    return union_sources(csv, fhir)


def build_organization(t: Tables) -> DataFrame:
    csv = _from_csv(latest_by(t["organizations"], ["Id"]), {
        "organization_id": "Id",
        "organization_name": title(F.trim("NAME")),
        "address": "ADDRESS",
        "city": "CITY",
        "state": "STATE",
        "zip": "ZIP",
        "phone": "PHONE",
        "npi": "NPI",
        "latitude": safe_cast("LAT", "double"),
        "longitude": safe_cast("LON", "double"),
    })
    fhir = _from_fhir(_resources(t, "Organization"), {
        "organization_id": "resource_id",
        "organization_name": jpath("name"),
        "address": jpath("address[0].line[0]"),
        "city": title(jpath("address[0].city")),
        "state": jpath("address[0].state"),
        "zip": jpath("address[0].postalCode"),
        "phone": jpath("telecom[0].value"),
    })
    return union_sources(csv, fhir)


def build_payer(t: Tables) -> DataFrame:
    raw = map_code(latest_by(t["payers"], ["Id"]), t["payer_profile"], "NAME", "payer_name", {
        "payer_type": "payer_type",
    })
    return _from_csv(raw, {
        "payer_id": "Id",
        "payer_name": decode("NAME", fixed.PAYER_NAME, F.col("NAME")),
        "payer_type": "payer_type",
        "payer_category": decode("payer_type", fixed.PAYER_CATEGORY),
        "ownership": title("OWNERSHIP"),
        "city": "CITY",
        "state_headquartered": "STATE_HEADQUARTERED",
        "phone": "PHONE",
    })


def build_coverage(t: Tables) -> DataFrame:
    """Payer types come from the payer table, so a payer that was loaded twice does not double its periods."""
    key = ["PATIENT", "PAYER", "START_DATE"]
    raw = map_code(latest_by(t["payer_transitions"], key), t["payer"], "PAYER", "payer_id", {
        "payer_type": "payer_type",
    })
    return _from_csv(raw, {
        "coverage_id": surrogate_key(*key),
        "patient_id": "PATIENT",
        "member_id": "MEMBERID",
        "payer_id": "PAYER",
        "secondary_payer_id": "SECONDARY_PAYER",
        "start_date": ts_to_date("START_DATE"),
        "end_date": ts_to_date("END_DATE"),
        "plan_ownership": F.coalesce(title("PLAN_OWNERSHIP"), F.lit("Unknown")),
        "policy_owner_name": strip_digits("OWNER_NAME"),
        "payer_type": "payer_type",
    })


def build_claim(t: Tables) -> DataFrame:
    """The eight diagnosis columns are mapped side by side, so a claim never leaves its row: with the
    map small enough to broadcast there is no shuffle beyond the one that removes copies."""
    positions = [f"DIAGNOSIS{i}" for i in range(1, 9)]
    raw = latest_by(t["claims"], ["Id"])
    reference = t["condition_map"].select(
        "snomed_code", F.struct("icd10cm_code", "snomed_description").alias("_found")
    )
    for p in positions:
        raw = map_code(raw, reference, p, "snomed_code", {"_found": f"_{p}"})
    icd10 = [F.col(f"_{p}.icd10cm_code") for p in positions]

    def first_where_mapped(values: list[Column]) -> Column:
        return F.coalesce(*[F.when(code.isNotNull(), value) for code, value in zip(icd10, values)])

    def listed(values: list[Column]) -> Column:
        """Values in order of position, each once; NULL for a claim without any diagnosis."""
        given = F.coalesce(*positions).isNotNull()
        return F.when(given, F.array_distinct(F.array_compact(F.array(*values))))

    return _from_csv(raw, {
        "claim_id": "Id",
        "patient_id": "PATIENTID",
        "encounter_id": "APPOINTMENTID",
        "provider_id": "PROVIDERID",
        "referring_provider_id": "REFERRINGPROVIDERID",
        "supervising_provider_id": "SUPERVISINGPROVIDERID",
        "primary_payer_id": null_if("PRIMARYPATIENTINSURANCEID", "0"),
        "secondary_payer_id": null_if("SECONDARYPATIENTINSURANCEID", "0"),
        "primary_claim_type": decode("HEALTHCARECLAIMTYPEID1", fixed.CLAIM_TYPE),
        "secondary_claim_type": decode("HEALTHCARECLAIMTYPEID2", fixed.CLAIM_TYPE),
        "service_date": ts_to_date("SERVICEDATE"),
        "current_illness_date": ts_to_date("CURRENTILLNESSDATE"),
        "principal_diagnosis_snomed_code": first_where_mapped([F.col(p) for p in positions]),
        "principal_diagnosis_icd10cm_code": F.coalesce(*icd10),
        "principal_diagnosis_description": first_where_mapped(
            [F.col(f"_{p}.snomed_description") for p in positions]
        ),
        "diagnosis_snomed_codes": listed([F.col(p) for p in positions]),
        "diagnosis_icd10cm_codes": listed(icd10),
        "primary_status": "STATUS1",
        "secondary_status": "STATUS2",
        "patient_status": "STATUSP",
        "primary_outstanding": money("OUTSTANDING1"),
        "secondary_outstanding": money("OUTSTANDING2"),
        "patient_outstanding": money("OUTSTANDINGP"),
        "primary_last_billed_date": ts_to_date("LASTBILLEDDATE1"),
        "patient_last_billed_date": ts_to_date("LASTBILLEDDATEP"),
    })


def build_claim_transaction(t: Tables) -> DataFrame:
    coded = map_code(
        latest_by(t["claims_transactions"], ["ID"]), t["procedure_map"], "PROCEDURECODE", "snomed_code",
        {"cpt_hcpcs": "_procedure_billing"},
    )
    raw = map_code(coded, t["vaccine_map"], "PROCEDURECODE", "cvx_code", {"cpt_code": "_vaccine_billing"})
    return _from_csv(raw, {
        "transaction_id": "ID",
        "claim_id": "CLAIMID",
        "charge_line_number": safe_cast("CHARGEID", "int"),
        "patient_id": "PATIENTID",
        "encounter_id": "APPOINTMENTID",
        "provider_id": "PROVIDERID",
        "place_of_service_organization_id": "PLACEOFSERVICE",
        "member_id": "PATIENTINSURANCEID",
        "transaction_type": "TYPE",
        "payment_method": decode("METHOD", fixed.PAYMENT_METHOD, title("METHOD")),
        "transfer_to": decode("TRANSFERTYPE", fixed.TRANSFER_TO),
        "from_date": ts_to_date("FROMDATE"),
        "to_date": ts_to_date("TODATE"),
        "service_code": "PROCEDURECODE",
        "billing_code": F.coalesce("_procedure_billing", "_vaccine_billing"),
        "modifier_1": "MODIFIER1",
        "modifier_2": "MODIFIER2",
        "units": safe_cast("UNITS", "int"),
        "unit_amount": money("UNITAMOUNT"),
        "charge_amount": F.when(F.col("TYPE") == "CHARGE", money("AMOUNT")),
        "payment_amount": money("PAYMENTS"),
        "adjustment_amount": money("ADJUSTMENTS"),
        "transfer_amount": money("TRANSFERS"),
        "outstanding_amount": money("OUTSTANDING"),
    })


BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    "patient": build_patient,
    "encounter": build_encounter,
    "condition": build_condition,
    "procedure": build_procedure,
    "observation": build_observation,
    "medication": build_medication,
    "immunization": build_immunization,
    "allergy": build_allergy,
    "provider": build_provider,
    "organization": build_organization,
    "payer": build_payer,
    "coverage": build_coverage,
    "claim": build_claim,
    "claim_transaction": build_claim_transaction,
}
