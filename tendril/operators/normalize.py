"""Normalization: export cells and registry results into typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tendril.functions.text import compact_text, parse_date, parse_decimal, parse_flag, single_identifier

# Source headers and keys of each column.
EXPORT_TEXT = {
    "procurement_reference": "Numri_i_references", "contracting_authority": "Autoriteti_kontraktues", "procurement_subject": "Objekti_i_prokurimit",
    "procedure_type": "Lloji_i_procedures", "contract_type": "Tipi_i_kontrates", "winner_name": "Fituesi", "cpv_codes": "Kodet_CPV",
}
EXPORT_DATES = {"publication_date": "Data_e_publikimit", "opening_date": "Data_e_hapjes", "closing_date": "Data_e_mbylljes"}
EXPORT_FLAGS = {"is_cancelled": "Anulluar", "is_suspended": "Pezulluar"}
EXPORT_MONEY = {"budget_limit_amount": "Fondi_limit", "winner_value_amount": "Vlera_e_fituesit"}
EXPORT_KEY = "NIPT_i_fituesit"
REGISTRY_TEXT = {
    "business_nipt": "nipti", "business_name": "emriISubjektit", "trade_name": "emriTregtar", "legal_form": "formaLigjore", "city": "qyteti", "ownership_text": "shtetesia",
    "subject_status": "statusiISubjektit", "subject_type": "tipiISubjektit", "activity_text": "sektoriIVeprimtarise", "administrators_text": "adminOrtakAksionar",
}


def export_year(payload_year, external_key):
    """The payload's year, else the key's; null where neither is a number."""
    return F.coalesce(payload_year.try_cast("int"), external_key.try_cast("int"))


def normalize_export(rows: DataFrame) -> DataFrame:
    """rows with cells (a map by header) -> with the typed columns; the cells stay as source_payload."""
    cell = lambda h: F.try_element_at("cells", F.lit(h))
    typed = {n: compact_text(cell(h)) for n, h in EXPORT_TEXT.items()} | {n: parse_date(cell(h)) for n, h in EXPORT_DATES.items()} | {n: parse_flag(cell(h)) for n, h in EXPORT_FLAGS.items()} | {n: parse_decimal(cell(h)) for n, h in EXPORT_MONEY.items()}
    return rows.withColumns(typed | {"winner_nipt": single_identifier(cell(EXPORT_KEY))}).withColumnRenamed("cells", "source_payload")


def _fields(text, *names: str):
    """Some fields of a JSON object, as texts, by one parse."""
    return F.from_json(text, ", ".join(f"`{n}` string" for n in names))


def result_items(snapshots: DataFrame, payload: str = "payload") -> DataFrame:
    """Result objects of each snapshot: `response` if it is a list, else `response.data`. What isn't an object is
    dropped but keeps its ordinal; a snapshot without a list has no rows."""
    return _items(snapshots.withColumn("__own", _fields(F.col(payload), "response"))).drop("__own")


def _items(parsed: DataFrame) -> DataFrame:
    """Items of `__own.response`."""
    response = F.col("__own.response")
    listed = F.from_json(F.when(response.startswith("{"), _fields(response, "data")["data"]).otherwise(response), "array<string>")
    items = parsed.select("*", F.posexplode(listed).alias("pos", "item"))
    return items.where(F.col("item").startswith("{")).withColumn("result_ordinal", F.col("pos") + 1).drop("pos")


def normalize_registry(snapshots: DataFrame, payload: str = "payload") -> DataFrame:
    """snapshots -> typed registry rows, one per result object. A payload and an item are each parsed once."""
    own, item = F.col("__own"), F.col("__item")
    typed = {n: compact_text(item[k]) for n, k in REGISTRY_TEXT.items()} | {
        "registration_date": parse_date(item["dataERegjistrimit"]), "has_red_flags": parse_flag(item["showRedFlag"]), "search_nipt": compact_text(own["nipt"]),
        "search_date_from": parse_date(own["data_nga"]), "search_date_to": parse_date(own["data_ne"]), "raw_fetch_id": own["raw_fetch_id"].try_cast("bigint"),
    }
    parsed = snapshots.withColumn("__own", _fields(F.col(payload), "response", "nipt", "data_nga", "data_ne", "raw_fetch_id"))
    items = _items(parsed).withColumn("__item", _fields(F.col("item"), *REGISTRY_TEXT.values(), "dataERegjistrimit", "showRedFlag"))
    return items.withColumns(typed).withColumnRenamed("item", "source_payload").drop(payload, "__own", "__item")
