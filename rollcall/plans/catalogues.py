"""Programme catalogue and survey -> nested and listed feature catalogues."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions.lists import without_blanks
from rollcall.functions.text import blank_missing, keyword_field, number_text
from rollcall.labels import KEYWORD_FIELDS, MISSING
from rollcall.operators.checks import assert_columns
from rollcall.operators.dedupe import latest_per_key
from rollcall.operators.dimensions import (
    JOINED_BYTES,
    left_lookup,
    membership,
    outer_lookup,
    without_match,
)
from rollcall.operators.nesting import nest
from rollcall.operators.reshape import scrub_columns, string_columns
from rollcall.plans.survey import (
    FOLIO,
    listed_program_keys,
    program_keys,
    support_types,
    survey_features,
)
from rollcall.schemas import (
    LISTED_FEATURE_COLUMNS,
    MISSING_REPORT_COLUMNS,
    NESTED_FEATURE_COLUMNS,
    REGISTER_FIELDS,
)
from rollcall.scratch import materialised
from rollcall.sinks.text import as_text, bulk_lines, nested_nulls

#: Last year that counts as history in the listed catalogue.
LAST_HISTORY_YEAR = 2016
_KEYS = ["cd_programa", "anio"]
#: What names a document of the nested catalogue.
DOCUMENT_KEYS = ["cd_programa", "id_pub", "cuaps_folio", "anio"]


def normal_numbers(catalogue: DataFrame) -> DataFrame:
    """Year and agency as whole-number text."""
    return catalogue.withColumns(
        {c: number_text(F.col(c)) for c in ("anio", "cd_dependencia")}
    )


def fill_missing(df: DataFrame) -> DataFrame:
    """The missing-value text in every missing text column."""
    return df.fillna(MISSING, subset=string_columns(df))


def latest_catalogue(catalogue: DataFrame) -> DataFrame:
    """The latest row of each programme, cleaned."""
    year = F.col("anio").try_cast("double")
    latest = latest_per_key(catalogue, ["cd_programa"], year)
    return normal_numbers(scrub_columns(fill_missing(latest)))


def register_rows(catalogue: DataFrame) -> DataFrame:
    """The register of each catalogue row, cleaned, as a row of its own."""
    return normal_numbers(scrub_columns(fill_missing(catalogue))).select(REGISTER_FIELDS)


def nested_registers(catalogue: DataFrame) -> DataFrame:
    """All registers of each programme and year as one list of records."""
    clean = register_rows(catalogue)
    return nest(clean, _KEYS, {"padrones": F.struct(*REGISTER_FIELDS)}, distinct=True)


def catalogue_core(catalogue: DataFrame) -> DataFrame:
    """One row per programme with its names, subprogrammes and registers.

    The latest-row step has left one row per programme, so the lists are built in the row.
    """
    return latest_catalogue(catalogue).select(
        *_KEYS,
        without_blanks(F.array("nb_subp1")).alias("nb_subp1"),
        "nb_origen",
        "nb_programa",
        "origen",
        F.array(F.struct(*REGISTER_FIELDS)).alias("padrones"),
    )


def _default(data_type: T.DataType) -> Column:
    """A record of missing-value texts; its lists are empty and its numbers null."""
    if isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.StructType):
        return F.array(_default(data_type.elementType))
    if isinstance(data_type, T.StructType):
        return F.struct(*[_default(f.dataType).alias(f.name) for f in data_type])
    if isinstance(data_type, T.ArrayType):
        return F.array().cast(data_type)
    return F.lit(MISSING if isinstance(data_type, T.StringType) else None).cast(data_type)


def nested_catalogue(
    catalogue: DataFrame,
    programmes: DataFrame,
    pairs: DataFrame,
    criteria: DataFrame,
    components: DataFrame,
    profiles: DataFrame,
) -> DataFrame:
    """Catalogue programmes and surveyed programmes, matched where they can be."""
    core = catalogue_core(catalogue)
    surveyed = survey_features(program_keys(programmes, pairs), criteria, components)
    return _with_defaults(_matched(core, surveyed), profiles)


def _matched(core: DataFrame, surveyed: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Full outer match of ``cd_programa`` and ``id_pub``, the two columns kept apart.

    Both sides are written once, as the match reads them twice.  ``max_bytes``: of a wide core,
    see ``outer_lookup``.
    """
    left = materialised(core.withColumn("_key", F.col("cd_programa")), "core")
    right = materialised(surveyed.withColumn("_key", F.col("id_pub")), "surveyed")
    return outer_lookup(right, left, ["_key"], max_bytes).drop("_key")


def _with_defaults(matched: DataFrame, profiles: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in matched.schema}
    empty = F.array().cast("array<string>")
    names = {
        "cd_programa": F.coalesce("cd_programa", "id_pub"),
        "nb_programa": F.coalesce("nb_programa", "chr_nombre_programa_cuaps"),
        "padrones": F.coalesce("padrones", _default(types["padrones"])),
        "apoyos": F.coalesce("apoyos", _default(types["apoyos"])),
        "derechos_sociales": F.coalesce("derechos_sociales", empty),
        "criterios_focalizacion": F.coalesce("criterios_focalizacion", empty),
        "obj_gral_prog": blank_missing(F.coalesce("obj_gral_prog", F.lit(""))),
        "nb_subp1": F.coalesce("nb_subp1", F.array(F.lit(MISSING))),
    }
    profiled = profiles.select(F.col("cve_programa").alias("cd_programa"))
    flagged = membership(matched.withColumns(names), profiled, ["cd_programa"], "tiene_perfil")
    final = fill_missing(flagged.select(NESTED_FEATURE_COLUMNS))
    return assert_columns(final, NESTED_FEATURE_COLUMNS)


def feature_documents(features: DataFrame, index: str) -> DataFrame:
    """Bulk lines of the nested catalogue; missing texts inside nested values are nulls.

    The fields that are searched by exact value have a copy ``<name>_keyword``.  A document is
    named by its programme, survey key, folio and year.
    """
    present = nested_nulls(features.where(F.col("cd_programa") != ""))
    copies = {
        f"{c}_keyword": F.transform(c, lambda x: keyword_field(x))
        if isinstance(present.schema[c].dataType, T.ArrayType)
        else keyword_field(F.col(c))
        for c in KEYWORD_FIELDS
    }
    return bulk_lines(present.withColumns(copies), index, keys=DOCUMENT_KEYS)


def missing_in_survey(features: DataFrame, keyed: DataFrame) -> DataFrame:
    """Catalogue programmes that no survey covers, with missing texts blanked."""
    ids = keyed.select(F.col("id_pub").alias("cd_programa"))
    rows = features.where(F.col("cd_programa") != MISSING)
    report = without_match(rows, ids, ["cd_programa"]).select(MISSING_REPORT_COLUMNS)
    return report.withColumns({c: blank_missing(F.col(c)) for c in string_columns(report)})


def missing_in_catalog(keyed: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Surveyed programmes that the programme catalogue lacks."""
    ids = fill_missing(catalogue.select("cd_programa")).withColumnRenamed(
        "cd_programa", "id_pub"
    )
    rows = keyed.where(F.col("id_pub") != MISSING).select(
        "id_pub", FOLIO, "DGAE", "DGAIP", "chr_nombre_programa_cuaps"
    )
    return without_match(rows, ids, ["id_pub"])


_LISTED = [
    "cd_dependencia", "cd_padron", "iduni", "origen_dep", "nb_dependencia", "nb_depen_corto",
    "sector", "nb_subp1",
]
_NAMES = ["nb_origen", "nb_programa", "origen"]


def listed_catalogue_core(catalogue: DataFrame) -> DataFrame:
    """One row per programme and year: its names, and the fields of its registers as lists.

    Lists and names come from one grouping.  Every list is in the order of the registers, but
    blanks are left out of each list by itself, so entries of two lists belong to the same
    register only where neither has blanks.  Rows with several names take the first in order.
    """
    clean = fill_missing(normal_numbers(catalogue)).withColumns(
        {c: F.translate(c, "\u00a0", " ") for c in [*_NAMES, "nb_subp1"]}
    )
    grouped = nest(
        clean,
        _KEYS,
        {"_rows": F.struct(*_LISTED)},
        {"_names": F.struct(*_NAMES)},
        distinct=True,
    )
    lists = [without_blanks(F.col("_rows")[c]).alias(c) for c in _LISTED]
    return grouped.select(*_KEYS, *lists, "_names.*")


def listed_survey(
    programmes: DataFrame, pairs: DataFrame, components: DataFrame
) -> DataFrame:
    """Surveyed programmes with their rights and support types as lists."""
    keyed = listed_program_keys(programmes, pairs)
    joined = left_lookup(keyed, support_types(components), [FOLIO])
    empty = F.array().cast("array<string>")
    return joined.withColumn("tipos_apoyos", F.coalesce("tipos_apoyos", empty))


def listed_catalogue(
    catalogue: DataFrame,
    programmes: DataFrame,
    pairs: DataFrame,
    components: DataFrame,
    last_history_year: int = LAST_HISTORY_YEAR,
    text: bool = False,
    max_bytes: int = JOINED_BYTES,
) -> DataFrame:
    """Current programme years matched with the survey, and older years as they are.

    A programme whose year is missing or no number is current.  With ``text`` the lists are JSON
    text, written out once for each programme and year, not for each surveyed programme that
    has them.  ``max_bytes``: of a programme year's matched rows in a task, see ``wide_lookup``.
    """
    form = as_text if text else lambda df: df
    core = materialised(form(listed_catalogue_core(catalogue)), "listed-core")
    past = F.coalesce(F.col("anio").try_cast("int") <= last_history_year, F.lit(False))
    surveyed = form(listed_survey(programmes, pairs, components))
    matched = _matched(core.where(~past), surveyed, max_bytes)
    history = core.where(past)
    rows = matched.unionByName(history, allowMissingColumns=True)
    none, unknown = F.array().cast("array<string>"), F.array(F.lit(MISSING))
    if text:
        none, unknown = F.to_json(none), F.to_json(unknown)
    lists = {c: F.coalesce(c, none) for c in _LISTED}
    lists |= {c: F.coalesce(c, unknown) for c in ("derechos_sociales", "tipos_apoyos")}
    final = fill_missing(rows.withColumns(lists).select(LISTED_FEATURE_COLUMNS))
    return assert_columns(final, LISTED_FEATURE_COLUMNS)
