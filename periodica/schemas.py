"""Schemas, keys and constraints of the sources and of the star schema."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable)


def _date(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.DateType(), nullable)


def _int(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.IntegerType(), nullable)


# Published files: one row per establishment, and one row per establishment and period.
STOCK_SOURCE = T.StructType(
    [
        _text("siret"),
        _text("codeCommuneEtablissement"),
        _text("libelleCommuneEtablissement"),
        _text("trancheEffectifsEtablissement"),
        _text("activitePrincipaleEtablissement"),
        _text("statutDiffusionEtablissement"),
    ]
)
HISTORY_SOURCE = T.StructType(
    [
        _text("siret"),
        _date("dateDebut"),
        _date("dateFin"),
        _text("etatAdministratifEtablissement"),
        _text("activitePrincipaleEtablissement"),
        _text("nomenclatureActivitePrincipaleEtablissement"),
    ]
)
# One-commune extract: history periods with the current stock attributes.
PERIODES = T.StructType(
    [
        _text("siret"),
        _date("dateDebut"),
        _date("dateFin"),
        _text("etat"),
        _text("code_ape"),
        _text("code_commune"),
        _text("libelle_commune"),
        _text("code_tranche"),
    ]
)

# Names used after the scan. `source name -> short name`
STOCK_NAMES = {
    "siret": "siret",
    "codeCommuneEtablissement": "code_commune",
    "trancheEffectifsEtablissement": "tranche_effectifs",
    "libelleCommuneEtablissement": "libelle_commune",
    "activitePrincipaleEtablissement": "code_ape",
    "statutDiffusionEtablissement": "statut_diffusion",
}
HISTORY_NAMES = {
    "siret": "siret",
    "dateDebut": "date_debut",
    "dateFin": "date_fin",
    "etatAdministratifEtablissement": "etat",
    "activitePrincipaleEtablissement": "code_ape",
    "nomenclatureActivitePrincipaleEtablissement": "nomenclature_ape",
}

DIM_COMMUNE = T.StructType(
    [
        _text("code_commune", False),
        _text("libelle_commune", False),
        _text("code_departement", False),
    ]
)
DIM_ACTIVITE = T.StructType([_text("code_ape", False), _text("nomenclature", False)])
DIM_DATE = T.StructType(
    [_date("date_id", False), _int("annee", False), _int("trimestre", False), _int("mois", False)]
)
DIM_TRANCHE = T.StructType([_text("code_tranche", False), _text("libelle", False)])
FAIT = T.StructType(
    [
        _text("siret", False),
        _date("valid_from", False),
        _date("valid_to"),
        T.StructField("is_current", T.BooleanType(), False),
        _text("code_commune"),
        _text("code_ape"),
        _text("code_tranche"),
        _text("etat"),
    ]
)

TABLES: dict[str, T.StructType] = {
    "dim_commune": DIM_COMMUNE,
    "dim_activite": DIM_ACTIVITE,
    "dim_date": DIM_DATE,
    "dim_tranche_effectifs": DIM_TRANCHE,
    "fait_etablissement_version": FAIT,
}
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_commune": ("code_commune",),
    "dim_activite": ("code_ape",),
    "dim_date": ("date_id",),
    "dim_tranche_effectifs": ("code_tranche",),
    "fait_etablissement_version": ("siret", "valid_from"),
}
# `fact column -> (dimension, key)`
FOREIGN_KEYS: dict[str, tuple[str, str]] = {
    "valid_from": ("dim_date", "date_id"),
    "code_commune": ("dim_commune", "code_commune"),
    "code_ape": ("dim_activite", "code_ape"),
    "code_tranche": ("dim_tranche_effectifs", "code_tranche"),
}
MAX_LENGTHS: dict[str, dict[str, int]] = {"dim_commune": {"code_commune": 5}}
# Directory partitioning of the stored tables; the column is derived from `code_commune`.
PARTITION_COLUMN = {"fait_etablissement_version": "code_departement"}


def required_columns(table: str) -> list[str]:
    return [f.name for f in TABLES[table].fields if not f.nullable]


def stored_schema(table: str) -> T.StructType:
    """Schema on disk: the logical columns, then the partition column as text."""
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in TABLES[table].fields]
    )
    if table in PARTITION_COLUMN:
        schema = schema.add(PARTITION_COLUMN[table], T.StringType(), True)
    return schema
