"""Column names and types of the raw, curated and rule layers."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql.types import StringType, StructField, StructType

# Raw names, curated names and curated types of a licence record.
COLUMNS = {
    "licencersn": ("licence_rsn", "bigint"),
    "licencenumber": ("licence_number", "string"),
    "licencerevisionnumber": ("licence_revision_number", "bigint"),
    "folderyear": ("folder_year", "bigint"),
    "businessname": ("business_name", "string"),
    "businesstradename": ("business_trade_name", "string"),
    "status": ("status", "string"),
    "issueddate": ("issued_date", "timestamp"),
    "expireddate": ("expired_date", "date"),
    "extractdate": ("extract_date", "timestamp"),
    "businesstype": ("business_type", "string"),
    "businesssubtype": ("business_subtype", "string"),
    "unit": ("unit", "string"),
    "unittype": ("unit_type", "string"),
    "house": ("house", "string"),
    "street": ("street", "string"),
    "city": ("city", "string"),
    "province": ("province", "string"),
    "country": ("country", "string"),
    "postalcode": ("postal_code", "string"),
    "localarea": ("local_area", "string"),
    "numberofemployees": ("number_of_employees", "bigint"),
    "feepaid": ("fee_paid", "double"),
}
GEO = ("geom", "geo_point_2d")
ADDRESS = ("house", "street", "unit", "unit_type", "postal_code", "city", "province", "local_area")
UNKNOWN = -1

RAW = StructType([StructField(c, StringType()) for c in (*COLUMNS, *GEO)])


@dataclass(frozen=True)
class Rules:
    """What the curated layer checks and how it breaks ties; every value can be replaced."""

    key: str = "licence_rsn"
    title_case: tuple[str, ...] = ("city", "street", "unit_type", "local_area")
    upper_case: tuple[str, ...] = ("province", "country")
    kept_case: tuple[str, ...] = ("business_name", "business_trade_name", "licence_number", "status", "business_type", "business_subtype")
    required: tuple[str, ...] = ("licence_rsn", "licence_number", "status", "folder_year")
    latitude: tuple[float, float] = (-90.0, 90.0)
    longitude: tuple[float, float] = (-180.0, 180.0)
    region_latitude: tuple[float, float] = (48.0, 60.0)
    region_longitude: tuple[float, float] = (-139.5, -114.0)
    known_status: tuple[str, ...] = ("Issued", "Pending", "Cancelled", "Inactive", "Gone Out of Business")
    shrink: float = 0.10
    null_drift: float = 0.05
    nullable: tuple[str, ...] = field(default=("businessname", "businesstradename", "issueddate", "expireddate", "businesssubtype", "unit", "unittype", "house", "street", "city", "province", "country", "postalcode", "localarea", "numberofemployees", "feepaid", "geom", "geo_point_2d"))


def resolve(*layers: dict, base: Rules | None = None) -> Rules:
    """Rules from layers of settings, later ones over earlier ones; null settings change nothing, unknown names raise."""
    out = base or Rules()
    for layer in layers:
        out = replace(out, **{k: tuple(v) if isinstance(v, list) else v for k, v in layer.items() if v is not None})
    return out
