"""The eleven business questions on the star schema.

Facts are counted per key before a dimension is joined, so a join moves one row per commune or band,
not one per establishment.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from periodica.functions.dates import valid_at, year_between
from periodica.functions.members import estimated_jobs
from periodica.operators.filters import active_at, closing, current_active

YEARS = (2015, 2026)
PAST = dt.date(2020, 1, 1)


def _count_per(df: DataFrame, *keys, name: str = "nb_etablissements") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def active_now(fact: DataFrame) -> DataFrame:
    """Q1: active establishments today."""
    return current_active(fact).agg(F.count("*").alias("nb_actifs"))


def top_sectors(fact: DataFrame, n: int = 10) -> DataFrame:
    """Q2: sectors with most active establishments; a missing sector is a sector of its own."""
    counts = _count_per(current_active(fact), "code_ape")
    return counts.orderBy(F.desc("nb_etablissements"), F.asc_nulls_last("code_ape")).limit(n)


def top_communes(fact: DataFrame, dim_commune: DataFrame, n: int = 10) -> DataFrame:
    """Q3: commune labels with most active establishments; communes of one name count together."""
    per_code = _count_per(current_active(fact), "code_commune", name="nb")
    labelled = per_code.join(dim_commune.select("code_commune", "libelle_commune"), "code_commune")
    per_label = labelled.groupBy("libelle_commune").agg(F.sum("nb").alias("nb_etablissements"))
    order = [F.desc("nb_etablissements"), F.asc_nulls_last("libelle_commune")]
    return per_label.orderBy(*order).limit(n)


def active_by_band(fact: DataFrame, dim_tranche: DataFrame) -> DataFrame:
    """Q4: active establishments per headcount band; missing and unknown bands drop out."""
    per_band = _count_per(current_active(fact), "code_tranche")
    labelled = per_band.join(dim_tranche, "code_tranche")
    return labelled.select("code_tranche", "libelle", "nb_etablissements").orderBy(
        F.asc_nulls_last("code_tranche")
    )


def jobs_estimate(fact: DataFrame) -> DataFrame:
    """Q5: estimated jobs, from the midpoint of each band."""
    return current_active(fact).agg(
        F.sum(estimated_jobs("code_tranche")).alias("emplois_estimes")
    )


def active_on(fact: DataFrame, day: dt.date = PAST) -> DataFrame:
    """Q6: active establishments on a past date."""
    return active_at(fact, day).agg(F.count("*").alias("nb_actifs"))


def _two_sided(counts: DataFrame, left: str, right: str) -> DataFrame:
    """Per-sector counts of two sets, as a full outer join of the two counts would give them.

    Both counts come from one pass. The join never matches a missing sector with itself, so that
    one gets a row for each side.
    """

    def pair(a, b):
        return F.struct(a.alias(left), b.alias(right))

    none, a, b = F.lit(0).cast("long"), F.col(left), F.col(right)
    sides = F.filter(F.array(pair(a, none), pair(none, b)), lambda s: s[left] + s[right] > 0)
    rows = F.when(F.col("code_ape").isNull(), sides).otherwise(F.array(pair(a, b)))
    keys = [c for c in counts.columns if c not in (left, right)]
    return counts.select(*keys, F.inline(rows))


def sector_growth(fact: DataFrame, day: dt.date = PAST) -> DataFrame:
    """Q7: active establishments per sector on a past date and today."""
    before, after = valid_at(day), F.col("is_current")
    counts = (
        fact.filter((F.col("etat") == "A") & (before | after))
        .groupBy("code_ape")
        .agg(F.count_if(before).alias("nb_avant"), F.count_if(after).alias("nb_apres"))
    )
    both = _two_sided(counts, "nb_avant", "nb_apres")
    return both.withColumn("variation", F.col("nb_apres") - F.col("nb_avant")).orderBy(
        F.desc("variation"), F.asc_nulls_last("code_ape")
    )


def entity_history(fact: DataFrame, siret: str) -> DataFrame:
    """Q8: versions of one establishment."""
    return (
        fact.filter(F.col("siret") == siret)
        .select("siret", "valid_from", "valid_to", "is_current", "code_ape", "etat")
        .orderBy("valid_from")
    )


def _with_previous_state(fact: DataFrame) -> DataFrame:
    by_siret = W.partitionBy("siret").orderBy("valid_from")
    return fact.withColumn("etat_precedent", F.lag("etat").over(by_siret))


def creations_per_year(fact: DataFrame, first: int = YEARS[0], last: int = YEARS[1]) -> DataFrame:
    """Q9: establishments by the year of their first version."""
    created = fact.groupBy("siret").agg(F.min("valid_from").alias("date_creation"))
    created = created.filter(year_between("date_creation", first, last))
    return _count_per(created, F.year("date_creation").alias("annee"), name="nb_creations").orderBy(
        "annee"
    )


def closures_per_year(fact: DataFrame, first: int = YEARS[0], last: int = YEARS[1]) -> DataFrame:
    """Q10: transitions from active to closed by year."""
    closed = _with_previous_state(fact).filter(closing())
    closed = closed.filter(year_between("valid_from", first, last))
    return _count_per(closed, F.year("valid_from").alias("annee"), name="nb_fermetures").orderBy(
        "annee"
    )


def net_balance(fact: DataFrame, first: int = YEARS[0], last: int = YEARS[1]) -> DataFrame:
    """Q11: creations minus closures by sector and year.

    An establishment is created in a sector with its first version there. That version and a
    closing one are rows of the same fact, so one shuffle on siret serves both counts.
    """
    by_sector = W.partitionBy("siret", "code_ape").orderBy("valid_from")
    events = _with_previous_state(fact).select(
        "code_ape",
        F.year("valid_from").alias("annee"),
        (F.row_number().over(by_sector) == 1).alias("created"),
        F.coalesce(closing(), F.lit(False)).alias("closed"),
    )
    counts = (
        events.filter(F.col("annee").between(first, last) & (F.col("created") | F.col("closed")))
        .groupBy("code_ape", "annee")
        .agg(F.count_if("created").alias("creations"), F.count_if("closed").alias("fermetures"))
    )
    both = _two_sided(counts, "creations", "fermetures")
    return both.withColumn("solde", F.col("creations") - F.col("fermetures")).orderBy(
        "annee", F.desc("solde"), F.asc_nulls_last("code_ape")
    )


def all_questions(
    tables: Mapping[str, DataFrame],
    siret: str | None = None,
    past: dt.date = PAST,
    years: tuple[int, int] = YEARS,
) -> dict[str, DataFrame]:
    """Every question on a warehouse, by name; Q8 only for a given establishment."""
    fact = tables["fait_etablissement_version"]
    answers = {
        "q01_active": active_now(fact),
        "q02_top_sectors": top_sectors(fact),
        "q03_top_communes": top_communes(fact, tables["dim_commune"]),
        "q04_by_band": active_by_band(fact, tables["dim_tranche_effectifs"]),
        "q05_jobs": jobs_estimate(fact),
        "q06_active_past": active_on(fact, past),
        "q07_sector_growth": sector_growth(fact, past),
        "q09_creations": creations_per_year(fact, *years),
        "q10_closures": closures_per_year(fact, *years),
        "q11_net_balance": net_balance(fact, *years),
    }
    if siret is not None:
        answers["q08_entity"] = entity_history(fact, siret)
    return answers
