"""Raw care tables derived from the driver tables.

The driver tables hold trade data, so each raw table is a projection of one of them: customers stand
for patients, orders for encounters and claims, line items for procedures and claim transactions,
events for lab values and for FHIR resources. Everything is text, as in landed files, and holds the
faults the clean-up must deal with: copies, open and reversed intervals, unknown codes, bad numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from care_lake.plans.tables import StagedLake
from care_lake.settings import Period
from workload.lookups import LOOKUPS, lookup_table

PERIOD = Period(date(1996, 1, 1), date(2000, 12, 31))

ISO = "\"yyyy-MM-dd'T'HH:mm:ss'Z'\""
# events lie in January 2024; moved back they fall into the last weeks of the period
EVENT_TIME = "ts - make_dt_interval(8450)"
MONEY = "cast(cast({} as decimal(12,2)) as string)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _loads(df: DataFrame, again: str) -> DataFrame:
    """Add load 1 of every row, and load 2 of the rows that were sent again."""
    return df.selectExpr("*", f"explode(case when {again} then array(1, 2) else array(1) end) as load")


LINEAGE = [
    "concat('run', load) as _run_id",
    "concat('file-', load) as _source_file",
    "make_timestamp(2024, load, 1, 0, 0, 0) as _source_file_modified_at",
    "make_timestamp(2024, load, 2, 0, 0, 0) as _ingested_at",
    "cast(null as string) as _rescued_data",
]


def patients(customer: DataFrame) -> DataFrame:
    return _loads(customer, "c_mktsegment = 'BUILDING'").selectExpr(
        "cast(c_custkey as string) as Id",
        "c_name as FIRST",
        "cast(null as string) as MIDDLE",
        "concat(c_mktsegment, c_nationkey) as LAST",
        "cast(date_add(date'1925-01-01', cast(floor(c_acctbal * 3) as int)) as string) as BIRTHDATE",
        "case when c_nationkey >= 20 then cast(date_add(date'1996-06-01', cast(floor(c_acctbal / 6) as int))"
        " as string) end as DEATHDATE",
        "case when c_mktsegment in ('FURNITURE', 'HOUSEHOLD') then 'F'"
        " when c_mktsegment in ('MACHINERY', 'BUILDING') then 'M' else 'U' end as GENDER",
        "lower(c_mktsegment) as RACE",
        "case when c_nationkey < 10 then 'hispanic' when c_nationkey < 24 then 'nonhispanic' else 'other' end"
        " as ETHNICITY",
        "substr('MSDWX', c_nationkey % 5 + 1, 1) as MARITAL",
        "concat(c_custkey, ' Main St') as ADDRESS",
        "case when load = 2 then concat('City ', c_nationkey) else concat('Town ', c_nationkey) end as CITY",
        "concat('S', c_nationkey) as STATE",
        "concat('County ', c_nationkey % 3) as COUNTY",
        "lpad(cast(c_custkey as string), 7, '0') as ZIP",
        "case when c_nationkey = 3 then 'north' else concat(c_nationkey, '.5') end as LAT",
        "concat('-', c_nationkey, '.25') as LON",
        "case when c_acctbal < 500 then 'n/a' else cast(cast(floor(c_acctbal) as int) as string) end as INCOME",
        *LINEAGE,
    )


def organizations(nation: DataFrame) -> DataFrame:
    return _loads(nation, "false").selectExpr(
        "concat('org', n_nationkey) as Id",
        "concat('  ', lower(n_name), ' clinic ') as NAME",
        "cast(null as string) as ADDRESS",
        "concat('City ', n_regionkey) as CITY",
        "concat('S', n_regionkey) as STATE",
        "lpad(cast(n_nationkey as string), 5, '0') as ZIP",
        "cast(null as string) as PHONE",
        "concat('npi', n_nationkey) as NPI",
        "concat(n_nationkey, '.5') as LAT",
        "'x' as LON",
        *LINEAGE,
    )


def providers(supplier: DataFrame) -> DataFrame:
    return _loads(supplier, "s_nationkey < 5").selectExpr(
        "concat('prov', s_suppkey) as Id",
        "case when load = 2 then concat('New ', s_name) else s_name end as NAME",
        "case when s_nationkey < 12 then 'F' else 'M' end as GENDER",
        "'GENERAL PRACTICE' as SPECIALITY",
        "concat('org', s_nationkey) as ORGANIZATION",
        "concat('npi', s_suppkey) as NPI",
        "cast(null as string) as ADDRESS",
        "concat('City ', s_nationkey) as CITY",
        "concat('S', s_nationkey) as STATE",
        "'00000' as ZIP",
        "'1.5' as LAT",
        "'-1.5' as LON",
        *LINEAGE,
    )


def payers(region: DataFrame) -> DataFrame:
    return _loads(region, "true").selectExpr(
        "concat('pay', r_regionkey) as Id",
        "case when r_name = 'EUROPE' then 'NO_INSURANCE' else r_name end as NAME",
        "'PRIVATE' as OWNERSHIP",
        "concat('City ', load) as CITY",
        "cast(null as string) as STATE_HEADQUARTERED",
        "cast(null as string) as PHONE",
        *LINEAGE,
    )


PATIENT_OF_ORDER = "cast(cast(floor(o_custkey / 5) as bigint) as string)"


def payer_transitions(orders: DataFrame) -> DataFrame:
    return _loads(orders, "o_orderpriority = '2-HIGH'").selectExpr(
        f"{PATIENT_OF_ORDER} as PATIENT",
        "concat('pay', o_orderkey % 5) as PAYER",
        f"date_format(o_orderdate, {ISO}) as START_DATE",
        f"case when o_orderkey % 11 = 0 then null else"
        f" date_format(o_orderdate + make_dt_interval(cast(o_orderkey % 700 - 30 as int)), {ISO}) end as END_DATE",
        "concat('m', o_orderkey) as MEMBERID",
        "cast(null as string) as SECONDARY_PAYER",
        "case when o_orderkey % 2 = 0 then 'SELF' end as PLAN_OWNERSHIP",
        "concat('Owner', o_custkey) as OWNER_NAME",
        "concat('run', load) as _run_id",
        # periods of one patient and payer may start on the same day; the file tells their copies apart
        "concat('file-', load, '-', lpad(cast(o_orderkey as string), 12, '0')) as _source_file",
        *LINEAGE[2:],
    )


ENCOUNTER_START = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int))"
ENCOUNTER_STOP = (
    "case when o_orderkey % 17 = 0 then null"
    " when o_orderkey % 97 = 5 then o_orderdate - make_dt_interval(3)"
    " else o_orderdate + make_dt_interval(cast(o_orderkey % 9 as int), cast(o_orderkey % 24 + 1 as int)) end"
)


def encounters(orders: DataFrame) -> DataFrame:
    return _loads(orders, "o_orderpriority = '1-URGENT'").selectExpr(
        "cast(o_orderkey as string) as Id",
        f"{PATIENT_OF_ORDER} as PATIENT",
        "concat('org', o_orderkey % 25) as ORGANIZATION",
        "concat('prov', o_orderkey % 10) as PROVIDER",
        "concat('pay', o_orderkey % 5) as PAYER",
        f"date_format({ENCOUNTER_START}, {ISO}) as START",
        f"date_format({ENCOUNTER_STOP}, {ISO}) as STOP",
        "case o_orderstatus when 'P' then 'inpatient' when 'F' then 'emergency' else case o_orderpriority"
        " when '1-URGENT' then 'urgentcare' when '2-HIGH' then 'ambulatory' when '3-MEDIUM' then 'wellness'"
        " when '4-NOT SPECIFIED' then 'virtual' else 'snf' end end as ENCOUNTERCLASS",
        "case when o_orderstatus = 'O' and o_totalprice > 400000 then '308646001'"
        " else concat('E', substr(o_orderpriority, 1, 1)) end as CODE",
        "concat('Visit ', substr(o_orderpriority, 3), ' (procedure)') as DESCRIPTION",
        "concat('c', o_orderkey % 13) as REASONCODE",
        "case when o_orderkey % 3 = 0 then null else concat('Reason ', o_orderkey % 13, ' (disorder)') end"
        " as REASONDESCRIPTION",
        "'100.00' as BASE_ENCOUNTER_COST",
        f"case when load = 1 and o_orderpriority = '1-URGENT' then '0' else {MONEY.format('o_totalprice')} end"
        " as TOTAL_CLAIM_COST",
        "cast(cast(floor(o_totalprice / 2) as bigint) as string) as PAYER_COVERAGE",
        *LINEAGE,
    )


def conditions(orders: DataFrame) -> DataFrame:
    return _loads(orders, "o_orderpriority = '3-MEDIUM'").selectExpr(
        f"{PATIENT_OF_ORDER} as PATIENT",
        "cast(o_orderkey as string) as ENCOUNTER",
        "concat('c', o_orderkey % 13) as CODE",
        "cast(cast(o_orderdate as date) as string) as START",
        "case when o_orderkey % 4 = 0 then null else"
        " cast(date_add(cast(o_orderdate as date), cast(o_orderkey % 400 - 20 as int)) as string) end as STOP",
        "concat('Condition ', o_orderkey % 13, ' (disorder)') as DESCRIPTION",
        *LINEAGE,
    )


def procedures(lineitem: DataFrame) -> DataFrame:
    """The part number gives the code and one of a few descriptions; two texts can share a code."""
    return _loads(lineitem, "l_returnflag = 'R'").selectExpr(
        "cast(l_suppkey as string) as PATIENT",
        "cast(l_orderkey as string) as ENCOUNTER",
        "concat('p', l_partkey % 12) as CODE",
        f"date_format(l_shipdate + make_dt_interval(0, l_linenumber), {ISO}) as START",
        f"date_format(l_shipdate + make_dt_interval(0, l_linenumber, cast(l_quantity as int)), {ISO}) as STOP",
        "case l_partkey % 12 when 4 then 'red ring (procedure)' when 5 then 'blue widget (procedure)'"
        " when 6 then case when l_linenumber > 3 then 'small gear' else 'tiny gear' end"
        " when 7 then 'small thing' when 8 then 'plain thing' when 9 then 'Big Widget and bolt'"
        " else 'thing (regime/therapy)' end as DESCRIPTION",
        MONEY.format("l_extendedprice") + " as BASE_COST",
        "concat('c', l_linenumber) as REASONCODE",
        "concat('Reason ', l_linenumber, ' (disorder)') as REASONDESCRIPTION",
        "concat('run', load) as _run_id",
        # a part may be ordered twice with the same key columns; the file tells the copies apart
        "concat('file-', load, '-', lpad(cast(l_partkey as string), 12, '0'), '-',"
        " lpad(cast(cast(l_extendedprice * 100 as bigint) as string), 12, '0')) as _source_file",
        *LINEAGE[2:],
    )


def observations(events: DataFrame) -> DataFrame:
    return _loads(events, "event_type = 'view'").selectExpr(
        "cast(user_id as string) as PATIENT",
        "cast(event_id as string) as ENCOUNTER",
        f"date_format({EVENT_TIME}, {ISO}) as DATE",
        "case when value < 1 then 'QOLS' else event_type end as CODE",
        "cast(value as string) as VALUE",
        "case event_type when 'signup' then 'vital-signs' when 'error' then null else 'laboratory' end as CATEGORY",
        "concat('Result of ', event_type) as DESCRIPTION",
        "case when event_type = 'click' then 'mg/dL' end as UNITS",
        "case when event_type = 'error' then 'text' else 'numeric' end as TYPE",
        *LINEAGE,
    )


def medications(orders: DataFrame) -> DataFrame:
    return _loads(orders, "o_orderpriority = '5-LOW'").selectExpr(
        f"{PATIENT_OF_ORDER} as PATIENT",
        "cast(o_orderkey as string) as ENCOUNTER",
        "concat('rx', o_orderkey % 30) as CODE",
        f"date_format(o_orderdate, {ISO}) as START",
        f"case when o_orderkey % 3 = 0 then null else"
        f" date_format(o_orderdate + make_dt_interval(cast(o_orderkey % 500 - 10 as int)), {ISO}) end as STOP",
        "concat('pay', o_orderkey % 5) as PAYER",
        "concat('Drug ', o_orderkey % 30) as DESCRIPTION",
        "'10.5' as BASE_COST",
        "cast(o_orderkey % 50 as string) as PAYER_COVERAGE",
        "cast(o_orderkey % 7 as string) as DISPENSES",
        "concat(o_orderkey % 100, '.25') as TOTALCOST",
        "concat('c', o_orderkey % 14) as REASONCODE",
        "cast(null as string) as REASONDESCRIPTION",
        *LINEAGE,
    )


def immunizations(customer: DataFrame) -> DataFrame:
    return _loads(customer, "c_mktsegment = 'FURNITURE'").selectExpr(
        "cast(c_custkey as string) as PATIENT",
        "cast(null as string) as ENCOUNTER",
        "concat('v', c_nationkey % 4) as CODE",
        f"date_format(date_add(date'1999-01-01', c_nationkey), {ISO}) as DATE",
        "concat('Vaccine   no  ', c_nationkey % 4) as DESCRIPTION",
        "'140.52' as BASE_COST",
        *LINEAGE,
    )


def allergies(customer: DataFrame) -> DataFrame:
    return _loads(customer, "false").selectExpr(
        "cast(c_custkey as string) as PATIENT",
        "concat('e', c_custkey) as ENCOUNTER",
        "concat('a', c_nationkey) as CODE",
        "'1990-01-01' as START",
        "case when c_nationkey > 20 then '1995-01-01' end as STOP",
        "'RxNorm' as SYSTEM",
        "concat('Allergen ', c_nationkey, ' (substance)') as DESCRIPTION",
        "'allergy' as TYPE",
        "lower(c_mktsegment) as CATEGORY",
        "'Rash (finding)' as DESCRIPTION1",
        "cast(null as string) as DESCRIPTION2",
        "case when c_nationkey < 5 then 'MILD' when c_nationkey < 10 then 'MODERATE' end as SEVERITY1",
        "case when c_nationkey in (1, 6, 11) then 'SEVERE' when c_nationkey in (2, 12) then 'MODERATE' end"
        " as SEVERITY2",
        *LINEAGE,
    )


def claims(orders: DataFrame) -> DataFrame:
    return _loads(orders, "o_orderpriority = '4-NOT SPECIFIED'").selectExpr(
        "concat('cl', o_orderkey) as Id",
        f"{PATIENT_OF_ORDER} as PATIENTID",
        "cast(o_orderkey as string) as APPOINTMENTID",
        "concat('prov', o_orderkey % 10) as PROVIDERID",
        "cast(null as string) as REFERRINGPROVIDERID",
        "concat('prov', o_orderkey % 10) as SUPERVISINGPROVIDERID",
        "case when o_orderkey % 6 = 0 then '0' else concat('pay', o_orderkey % 5) end as PRIMARYPATIENTINSURANCEID",
        "'0' as SECONDARYPATIENTINSURANCEID",
        "cast(o_orderkey % 3 as string) as HEALTHCARECLAIMTYPEID1",
        "cast(null as string) as HEALTHCARECLAIMTYPEID2",
        f"date_format(o_orderdate, {ISO}) as SERVICEDATE",
        f"date_format(o_orderdate, {ISO}) as CURRENTILLNESSDATE",
        "case when o_orderkey % 10 = 9 then null when o_orderkey % 5 = 0 then 'c7'"
        " else concat('c', o_orderkey % 13) end as DIAGNOSIS1",
        "case when o_orderkey % 10 = 9 then null else concat('c', (o_orderkey + 3) % 13) end as DIAGNOSIS2",
        "case when o_orderkey % 2 = 0 then concat('c', (o_orderkey + 3) % 13) end as DIAGNOSIS3",
        "case when o_orderkey % 10 = 9 then null else concat('c', (o_orderkey + 9) % 13) end as DIAGNOSIS4",
        *[f"cast(null as string) as DIAGNOSIS{i}" for i in range(5, 9)],
        "case when o_orderkey % 4 = 0 then 'BILLED' else 'CLOSED' end as STATUS1",
        "cast(null as string) as STATUS2",
        "'CLOSED' as STATUSP",
        "cast(o_orderkey % 200 as string) as OUTSTANDING1",
        "cast(null as string) as OUTSTANDING2",
        "'12.5' as OUTSTANDINGP",
        "cast(null as string) as LASTBILLEDDATE1",
        "cast(null as string) as LASTBILLEDDATEP",
        *LINEAGE,
    )


def claims_transactions(lineitem: DataFrame) -> DataFrame:
    """Line items hold many copies of one (order, line); the ship date is their load time."""
    return lineitem.selectExpr(
        "concat(l_orderkey, '-', l_linenumber) as ID",
        "concat('cl', l_orderkey) as CLAIMID",
        "cast(l_linenumber as string) as CHARGEID",
        "cast(l_suppkey as string) as PATIENTID",
        "cast(l_orderkey as string) as APPOINTMENTID",
        "concat('prov', l_suppkey) as PROVIDERID",
        "concat('org', l_suppkey % 25) as PLACEOFSERVICE",
        "cast(null as string) as PATIENTINSURANCEID",
        "case l_returnflag when 'A' then 'CHARGE' when 'N' then 'PAYMENT' else 'TRANSFERIN' end as TYPE",
        "case l_linestatus when 'F' then 'ECHECK' else 'COPAY' end as METHOD",
        "case l_linenumber when 1 then '1' when 2 then '2' when 3 then 'p' else '9' end as TRANSFERTYPE",
        f"date_format(l_shipdate, {ISO}) as FROMDATE",
        f"date_format(l_shipdate, {ISO}) as TODATE",
        "concat('p', l_partkey % 12) as PROCEDURECODE",
        "cast(null as string) as MODIFIER1",
        "cast(null as string) as MODIFIER2",
        "cast(cast(l_quantity as int) as string) as UNITS",
        "'1.00' as UNITAMOUNT",
        MONEY.format("l_extendedprice") + " as AMOUNT",
        "case when l_returnflag = 'N' then " + MONEY.format("l_extendedprice") + " end as PAYMENTS",
        "cast(null as string) as ADJUSTMENTS",
        "cast(null as string) as TRANSFERS",
        "'0' as OUTSTANDING",
        "'run1' as _run_id",
        "concat('file-', lpad(cast(l_partkey as string), 12, '0'), '-', lpad(cast(l_suppkey as string), 12, '0'),"
        " '-', lpad(cast(cast(l_extendedprice * 100 as bigint) as string), 12, '0')) as _source_file",
        "cast(l_shipdate as timestamp) as _source_file_modified_at",
        "cast(l_shipdate as timestamp) as _ingested_at",
        "cast(null as string) as _rescued_data",
    )


US_CORE = "http://hl7.org/fhir/us/core/StructureDefinition/"


def _text_extension(kind: str, text: str) -> str:
    return (
        f"named_struct('url', '{US_CORE}{kind}', 'extension', array("
        f"named_struct('url', 'ombCategory', 'valueString', 'x'),"
        f" named_struct('url', 'text', 'valueString', {text})))"
    )


FHIR_PATIENT = f"""named_struct(
    'resourceType', 'Patient', 'id', concat('fp', s_suppkey),
    'name', array(named_struct('given', array(s_name, 'Q'), 'family', concat('Family', s_nationkey))),
    'birthDate', cast(date_add(date'1940-01-01', cast(s_nationkey * 300 as int)) as string),
    'deceasedDateTime', case when s_nationkey = 7 then '2000-06-01T08:00:00Z' end,
    'deceasedBoolean', case when s_nationkey = 8 then true end,
    'gender', case when s_nationkey < 12 then 'female' else 'male' end,
    'extension', case when s_nationkey % 4 <> 0 then array(
        {_text_extension('us-core-race', "concat('Race ', s_nationkey)")},
        {_text_extension('us-core-ethnicity', "'Not Hispanic'")}) end,
    'maritalStatus', case when s_nationkey > 10 then named_struct('text', 'Married') end,
    'address', array(named_struct('line', array(concat(s_suppkey, ' Oak St')), 'city', 'OLD TOWN', 'state', 'WI',
        'district', 'DANE', 'postalCode', '53703')))"""

FHIR_ENCOUNTER = f"""named_struct(
    'resourceType', 'Encounter', 'id', concat('fe', event_id),
    'subject', named_struct('reference', concat('Patient/fp', user_id % 10)),
    'serviceProvider', named_struct('reference', concat('Organization/fo', event_id % 5)),
    'participant', array(named_struct('individual',
        named_struct('reference', concat('Practitioner/fd', user_id % 10)))),
    'location', array(named_struct('location', named_struct('reference', concat('Location/fl', event_id % 7)))),
    'class', named_struct('display', case event_type when 'view' then 'HOV' when 'click' then 'Inpatient Stay'
        when 'purchase' then 'EMERGENCY room' when 'signup' then 'Preadmission'
        else 'Support OP Encounter' end),
    'type', array(named_struct('coding', array(named_struct('code', concat('T', event_id % 3))),
        'text', concat('Type ', event_type))),
    'status', 'finished',
    'period', named_struct('start', date_format({EVENT_TIME}, {ISO}),
        'end', date_format({EVENT_TIME} + make_dt_interval(cast(event_id % 4 as int)), {ISO})),
    'reasonCode', case when event_id % 2 = 0 then array(named_struct('text', concat('Why ', event_type))) end)"""

FHIR_CONDITION = f"""named_struct(
    'resourceType', 'Condition', 'id', concat('fc', event_id),
    'subject', named_struct('reference', concat('Patient/fp', user_id % 10)),
    'encounter', case when event_id % 3 <> 0 then named_struct('reference', concat('Encounter/fe', event_id)) end,
    'onsetDateTime', case when event_id % 5 <> 0 then date_format({EVENT_TIME}, {ISO}) end,
    'recordedDate', date_format({EVENT_TIME} + make_dt_interval(2), {ISO}),
    'abatementDateTime', case when event_id % 7 = 0 then
        date_format({EVENT_TIME} + make_dt_interval(10), {ISO}) end,
    'clinicalStatus', case when event_id % 4 <> 0 then named_struct('coding', array(named_struct('code',
        case when event_id % 4 = 1 then 'active' else 'resolved' end))) end,
    'code', named_struct(
        'coding', case event_id % 4
            when 0 then array(named_struct('system', 'http://snomed.info/sct',
                'code', concat('c', event_id % 13), 'display', 'd'))
            when 1 then array(named_struct('system', 'http://hl7.org/fhir/sid/icd-10-cm', 'code', 'Z99.9',
                'display', 'd'))
            when 2 then array(
                named_struct('system', 'http://hl7.org/fhir/sid/icd-10-cm', 'code', 'E11.9', 'display', 'd'),
                named_struct('system', 'http://snomed.info/sct', 'code', 'c2', 'display', 'd'))
            else array() end,
        'text', concat('Problem ', event_type)))"""

FHIR_PRACTITIONER = """named_struct(
    'resourceType', 'Practitioner', 'id', concat('fd', s_suppkey),
    'name', array(named_struct('text', case when s_nationkey < 12 then concat('Dr. ', s_name) end,
        'given', array('Ann'), 'family', concat('Family', s_nationkey))),
    'gender', 'female')"""

FHIR_ORGANIZATION = """named_struct(
    'resourceType', 'Organization', 'id', concat('fo', r_regionkey), 'name', r_name,
    'address', array(named_struct('line', array('1 Way'), 'city', 'NEW CITY', 'state', 'WI',
        'postalCode', '53704')),
    'telecom', array(named_struct('value', concat('555-', r_regionkey))))"""


def _resources(df: DataFrame, kind: str, key: str, body: str) -> DataFrame:
    return df.selectExpr(
        "'epic_fhir_sandbox' as source_system",
        f"'{kind}' as resource_type",
        f"{key} as resource_id",
        "cast(null as string) as source_last_updated",
        f"to_json({body}) as raw",
        "'run1' as run_id",
        "date'2024-01-01' as extract_date",
        "'resources.ndjson' as source_file",
        "timestamp'2024-01-01 00:00:00' as source_file_modified_at",
        "timestamp'2024-01-02 00:00:00' as ingested_at",
    )


def fhir_resources(supplier: DataFrame, events: DataFrame, region: DataFrame) -> DataFrame:
    return (
        _resources(supplier, "Patient", "concat('fp', s_suppkey)", FHIR_PATIENT)
        .unionByName(_resources(events, "Encounter", "concat('fe', event_id)", FHIR_ENCOUNTER))
        .unionByName(_resources(events, "Condition", "concat('fc', event_id)", FHIR_CONDITION))
        .unionByName(_resources(supplier, "Practitioner", "concat('fd', s_suppkey)", FHIR_PRACTITIONER))
        .unionByName(_resources(region, "Organization", "concat('fo', r_regionkey)", FHIR_ORGANIZATION))
    )


SOURCES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "patients": (patients, ("customer",)),
    "organizations": (organizations, ("nation",)),
    "providers": (providers, ("supplier",)),
    "payers": (payers, ("region",)),
    "payer_transitions": (payer_transitions, ("orders",)),
    "encounters": (encounters, ("orders",)),
    "conditions": (conditions, ("orders",)),
    "procedures": (procedures, ("lineitem",)),
    "observations": (observations, ("events",)),
    "medications": (medications, ("orders",)),
    "immunizations": (immunizations, ("customer",)),
    "allergies": (allergies, ("customer",)),
    "claims": (claims, ("orders",)),
    "claims_transactions": (claims_transactions, ("lineitem",)),
    "fhir_resources": (fhir_resources, ("supplier", "events", "region")),
}




class RawTables(Mapping[str, DataFrame]):
    """Raw tables and lookups, each defined when it is first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in SOURCES:
                make, inputs = SOURCES[name]
                self._made[name] = make(*[self._input(i) for i in inputs])
            else:
                self._made[name] = lookup_table(self._spark, name)
        return self._made[name]

    def _input(self, name: str) -> DataFrame:
        return read(self._spark, self._sf_dir, name)

    def __iter__(self):
        yield from SOURCES
        yield from LOOKUPS

    def __len__(self) -> int:
        return len(SOURCES) + len(LOOKUPS)

    def __contains__(self, name: object) -> bool:
        return name in SOURCES or name in LOOKUPS


_LAKES: dict[tuple[str, str], StagedLake] = {}


def lake(spark: SparkSession, sf_dir: str) -> StagedLake:
    """The lake over one set of driver tables; its written tables are shared by all queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        _LAKES[key] = StagedLake(RawTables(spark, sf_dir), PERIOD)
    return _LAKES[key]
