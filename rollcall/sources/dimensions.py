"""Dimension tables in the form the joins expect."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import number_text
from rollcall.operators.dimensions import left_lookup


def geography(municipalities: DataFrame, states: DataFrame) -> DataFrame:
    """Municipalities with the names of their states."""
    munis = municipalities.withColumnsRenamed(
        {"CVE_ENT": "cveent", "CVEGEO": "cvemuni", "NOMGEO": "nommuni"}
    ).select("cveent", "cvemuni", "nommuni")
    names = states.withColumnsRenamed({"CVE_ENT": "cveent", "NOM_ENT": "noment"}).select(
        "cveent", "noment"
    )
    return left_lookup(munis, names, ["cveent"])


def crosswalk(table: DataFrame) -> DataFrame:
    """Distinct complete pairs of the two key systems."""
    pairs = table.select(F.col("DGAIP").cast("string"), F.col("DGAE").cast("string"))
    return pairs.dropna("any").dropDuplicates()


def registry_catalogue(catalogue: DataFrame) -> DataFrame:
    """Programme names by unified id and delivery year, under the registry's names."""
    renamed = catalogue.withColumnsRenamed(
        {
            "nb_programa": "nombreprograma",
            "nb_subp1": "nombresubp1",
            "nb_dependencia": "nbdependencia",
            "nb_depen_corto": "nbdepencorto",
        }
    )
    return renamed.select(
        "iduni",
        number_text(F.col("anio")).try_cast("int").alias("file_year"),
        "nombresubp1",
        "nombreprograma",
        "nbdependencia",
        "nbdepencorto",
    )
