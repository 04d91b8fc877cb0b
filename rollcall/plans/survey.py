"""Survey tables -> programme keys, rights, focus groups and supports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import keys, text
from rollcall.functions.lists import dummies_to_array, focus_group, without_blanks
from rollcall.labels import (
    MISSING,
    RIGHTS,
    RIGHTS_PREFIX,
    SUPPORT_PREFIX,
    SUPPORT_TYPES,
    SURVEY_BOOKKEEPING,
)
from rollcall.operators.dimensions import left_lookup
from rollcall.operators.nesting import nest
from rollcall.operators.reshape import (
    dummy_sums,
    scrub_quotes_columns,
    string_columns,
    trim_strings,
    typed_fill,
)
from rollcall.sources.dimensions import crosswalk

FOLIO = "cuaps_folio"


def with_rights(programmes: DataFrame) -> DataFrame:
    """Add the list of social rights a programme serves."""
    rights = dummies_to_array(programmes.columns, RIGHTS_PREFIX, RIGHTS)
    return programmes.withColumn("derechos_sociales", rights)


def _budget_key() -> Column:
    folio = F.col(FOLIO)
    key = keys.level_key(F.col("orden_gob"), F.col("chr_clave_prespupuestal_pro"), folio)
    return keys.own_key_if_shared(key, folio)


def _with_registry_id(programmes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add ``id_pub``: the registry's key where the crosswalk has one, else the survey's."""
    joined = left_lookup(programmes, crosswalk(pairs), ["DGAE"])
    ids = joined.withColumn("id_pub", F.coalesce("DGAIP", "DGAE"))
    return scrub_quotes_columns(ids.fillna(MISSING, subset=string_columns(ids)))


def program_keys(programmes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Programmes with clean names and keys, as the nested catalogue needs them."""
    clean = trim_strings(programmes, "chr_nombre_programa_cuaps", "nom_entidad_federativa")
    folio = F.col(FOLIO)
    keyed = clean.withColumns(
        {
            "cve_entidad_federativa": text.pad_state(F.col("cve_entidad_federativa")),
            "DGAE": keys.abbreviate_states(keys.own_key_if_blank(_budget_key(), folio)),
        }
    )
    return _with_registry_id(with_rights(keyed), pairs)


def listed_program_keys(programmes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Programme keys as the listed catalogue needs them: trimmed, folios left unabbreviated."""
    keyed = with_rights(programmes).withColumn("DGAE", keys.abbreviate_states(_budget_key()))
    chosen = keyed.select("DGAE", FOLIO, "chr_clave_prespupuestal_pro", "derechos_sociales")
    clean = trim_strings(chosen, "DGAE", FOLIO, "chr_clave_prespupuestal_pro")
    filled = clean.withColumn("DGAE", keys.own_key_if_blank(F.col("DGAE"), F.col(FOLIO)))
    return _with_registry_id(filled, pairs)


def program_features(keyed: DataFrame) -> DataFrame:
    """The programme columns that reach the nested catalogue."""
    return keyed.withColumnsRenamed(
        {"nom_entidad_federativa": "nom_ent", "cve_entidad_federativa": "cve_ent"}
    ).select(
        "id_pub", FOLIO, "DGAE", "DGAIP", "derechos_sociales", "obj_gral_prog",
        "chr_nombre_programa_cuaps", "nom_ent", "cve_ent",
    )


def focus_criteria(criteria: DataFrame) -> DataFrame:
    """Folio and focus group of each criterion; unlisted codes have an empty group."""
    filled = scrub_quotes_columns(typed_fill(criteria))
    return filled.select(
        FOLIO, focus_group(F.col("csc_configuracion_foc")).alias("criterios_focalizacion")
    )


def supports(components: DataFrame) -> DataFrame:
    """Support rows with their composite key and the list of support types."""
    kept = scrub_quotes_columns(typed_fill(components.drop(*SURVEY_BOOKKEEPING)))
    return kept.withColumns(
        {
            "id_apoyo_index": F.concat_ws("-", FOLIO, "id_componente", "id_apoyo"),
            "tipos": dummies_to_array(kept.columns, SUPPORT_PREFIX, SUPPORT_TYPES),
        }
    )


def nested_supports(components: DataFrame) -> DataFrame:
    """Supports of each folio as one list of records."""
    rows = supports(components)
    return nest(rows, [FOLIO], {"apoyos": F.struct(*rows.columns)}, distinct=True)


def support_types(components: DataFrame) -> DataFrame:
    """Support types any of a folio's supports has."""
    filled = typed_fill(components.drop(*SURVEY_BOOKKEEPING))
    sums = dummy_sums(filled, FOLIO, SUPPORT_PREFIX)
    types = dummies_to_array(sums.columns, SUPPORT_PREFIX, SUPPORT_TYPES)
    return sums.select(FOLIO, types.alias("tipos_apoyos"))


def survey_features(keyed: DataFrame, criteria: DataFrame, components: DataFrame) -> DataFrame:
    """Programmes that have criteria, with their focus groups and supports as lists.

    Criteria and supports are gathered in one grouping by folio, so both lists need no join
    with each other.
    """
    groups = focus_criteria(criteria)
    records = supports(components)
    record = F.struct(*records.columns)
    entries = groups.unionByName(
        records.select(FOLIO, record.alias("apoyos")), allowMissingColumns=True
    )
    lists = nest(
        entries,
        [FOLIO],
        {c: F.col(c) for c in ("criterios_focalizacion", "apoyos")},
        distinct=True,
    )
    listed = lists.where(F.size("criterios_focalizacion") > 0).select(
        FOLIO,
        without_blanks(F.col("criterios_focalizacion")).alias("criterios_focalizacion"),
        "apoyos",
    )
    return program_features(keyed).join(listed, FOLIO)
