"""Reading fields out of FHIR resources kept as JSON text.

``with_doc`` parses the text once per row into a VARIANT; every path read then works on that value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOC = "_doc"

# Property names of FHIR resources.
ENVELOPE = "resourceType string, id string, meta struct<lastUpdated: string>"
EXTENSIONS = "array<struct<url:string,extension:array<struct<url:string,valueString:string>>>>"
CODINGS = "array<struct<system:string,code:string,display:string>>"
REFERENCES = (
    "struct<participant:array<struct<individual:struct<reference:string>>>,"
    "location:array<struct<location:struct<reference:string>>>,"
    "serviceProvider:struct<reference:string>>"
)


def with_doc(df: DataFrame, raw: str = "raw") -> DataFrame:
    return df.withColumn(DOC, F.try_parse_json(F.col(raw)))


def jpath(path: str, to: str = "string", doc: str = DOC) -> Column:
    """Typed read of a path such as ``name[0].given[1]``; missing or unfit values give NULL."""
    return F.try_variant_get(F.col(doc), f"$.{path}", to)


def extension_text(suffix: str, doc: str = DOC) -> Column:
    """Readable text of the extension whose url ends in ``suffix``."""
    outer = F.filter(jpath("extension", EXTENSIONS, doc), lambda e: e["url"].endswith(suffix))
    inner = F.filter(F.get(outer, F.lit(0))["extension"], lambda x: x["url"] == "text")
    return F.get(inner, F.lit(0))["valueString"]


def coding_code(system: str, path: str = "code.coding", doc: str = DOC) -> Column:
    """Code of the first coding that belongs to a code system."""
    matches = F.filter(jpath(path, CODINGS, doc), lambda c: c["system"] == system)
    return F.get(matches, F.lit(0))["code"]


def json_envelope(df: DataFrame, text: str = "value") -> DataFrame:
    """Type, id and update time of a resource beside its untouched text."""
    others = [c for c in df.columns if c != text]
    read = df.select(F.from_json(F.col(text), ENVELOPE).alias("_envelope"), F.col(text).alias("raw"), *others)
    return read.select(
        F.col("_envelope.resourceType").alias("resource_type"),
        F.col("_envelope.id").alias("resource_id"),
        F.col("_envelope.meta.lastUpdated").alias("source_last_updated"),
        "raw",
        *others,
    )


def fhir_references(encounters: DataFrame, raw: str = "raw") -> DataFrame:
    """Distinct ``Type/id`` references that encounters point to: people, places and organisation."""
    parsed = encounters.select(F.from_json(F.col(raw), REFERENCES).alias("r"))
    refs = F.concat(
        F.coalesce(F.transform("r.participant", lambda p: p["individual"]["reference"]), F.array()),
        F.coalesce(F.transform("r.location", lambda p: p["location"]["reference"]), F.array()),
        F.array(F.col("r.serviceProvider.reference")),
    )
    return parsed.select(F.explode(refs).alias("reference")).filter("reference is not null").distinct()
