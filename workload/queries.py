"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions import codes, encoding, keys, lists, person, text
from rollcall.labels import (
    AGE_LABELS_PLURAL,
    RIGHTS,
    RIGHTS_PREFIX,
    SUPPORT_PREFIX,
)
from rollcall.operators.dimensions import membership
from rollcall.operators.nesting import nest
from rollcall.operators.reshape import dummy_sums, pivot_back, typed_fill, unpivot
from rollcall.operators.rules import amount_rules, exclude_rule
from rollcall.plans import catalogues, monthly, registry, survey
from rollcall.plans.registry import Edition
from rollcall.schemas import (
    FULL_COLUMNS,
    FULL_SCHEMA,
    PUBLIC_COLUMNS,
    PUBLIC_SCHEMA,
    RAW_COLUMNS,
)
from rollcall.scratch import materialised, scratch_folder
from rollcall.sinks.tables import (
    publish_years,
    published,
    published_figures,
    refresh_published,
    register_published,
    register_table,
    write_figures,
    write_partitioned,
    write_years,
)
from rollcall.sinks.text import as_text, write_pipe_csv
from rollcall.sources import dimensions as dims
from rollcall.sources import files
from rollcall.streaming.arrivals import ingest_arrivals
from workload.deliveries import write_deliveries
from workload.views import table, view

INDEX = "registry-monthly"
FEATURE_INDEX = "programme-features"
#: A split year inside the given tables' years; the default one lies after them.
SPLIT_YEAR = 1998
#: The year whose deliveries the stream query writes in Windows-1252.
CP1252_YEAR = 1995
OLDER = Edition(
    age_labels=AGE_LABELS_PLURAL,
    own_month=True,
    missing_origin=None,
    other_benefit=None,
    no_benefit=None,
)

#: Letters of the given texts, and the bytes they are made to stand for.
MISREAD_LETTERS = "abcdefghijklmnopqrstuvwxyzA"
MISREAD_BYTES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]

c = F.col
QUERIES = {}


def query(run):
    """Register a query under its name."""
    QUERIES[run.__name__.removesuffix("_query")] = run
    return run


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "raw_registry")


# --- Scalar cleaners, over every registry row or every text ---


@query
def trim_text(spark, sf_dir):
    rows = view(spark, sf_dir, "survey_programmes")
    return rows.select("cuaps_folio", text.trim_text(c("chr_nombre_programa_cuaps")).alias("name"))


@query
def strip_quotes(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "newid", text.strip_quotes(c("newid")).alias("id"), text.strip_quotes(c("anio")).alias("anio")
    )


@query
def clean_int(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "newid",
        *[text.clean_int(c(n)).alias(n) for n in ("anio", "numespago")],
        *[text.clean_long(c(n)).alias(f"{n}_long") for n in ("newid", "nuimpmonetario")],
    )


def _aged(spark, sf_dir):
    parts = {
        "born": person.birth_number(c("fhnacimiento")),
        "anio": text.clean_int(c("anio")),
        "month": codes.period_month(c("periodo")),
    }
    age = person.age_at_month(c("born"), c("anio"), c("month"))
    return _raw(spark, sf_dir).withColumns(parts).withColumn("age", age)


@query
def age_at_month(spark, sf_dir):
    return _aged(spark, sf_dir).select("newid", "age")


@query
def age_band(spark, sf_dir):
    return _aged(spark, sf_dir).select(
        "newid",
        person.age_band(c("age")).alias("band"),
        person.age_band(c("age"), AGE_LABELS_PLURAL).alias("older_band"),
    )


@query
def mask_minor_names(spark, sf_dir):
    names = ("nbprimerap", "nbsegundoap", "nbnombre")
    return _aged(spark, sf_dir).select(
        "newid", *[person.mask_minor_name(c(n), c("age")).alias(n) for n in names]
    )


@query
def muni_code(spark, sf_dir):
    code = codes.muni_code(c("cdmunpago"), codes.state_code(c("cdentpago")))
    return _raw(spark, sf_dir).select("newid", code.alias("cvemunipago"))


@query
def loc_code(spark, sf_dir):
    return _raw(spark, sf_dir).select("newid", codes.loc_code(c("cdlocpago")).alias("cvelocpago"))


@query
def state_code(spark, sf_dir):
    return _raw(spark, sf_dir).select("newid", codes.state_code(c("cdentpago")).alias("cveentpago"))


@query
def gender_code(spark, sf_dir):
    return _raw(spark, sf_dir).select("newid", codes.gender_code(c("cdsexo")).alias("cdsexo"))


@query
def origin_code(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "newid",
        codes.origin_code(c("nborigen")).alias("origen"),
        codes.origin_code(c("nborigen"), None).alias("older_origen"),
    )


@query
def period_month(spark, sf_dir):
    return _raw(spark, sf_dir).select("newid", codes.period_month(c("periodo")).alias("mescorresp"))


@query
def pay_month(spark, sf_dir):
    month = codes.pay_month(c("numespago"), codes.period_month(c("periodo")))
    return _raw(spark, sf_dir).select("newid", month.alias("numespago"))


@query
def pay_month_own(spark, sf_dir):
    return _raw(spark, sf_dir).select("newid", codes.pay_month_own(c("numespago")).alias("numespago"))


@query
def benefit_name(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "newid",
        codes.benefit_name(c("cdtipobeneficio")).alias("benefit"),
        codes.benefit_name(c("cdtipobeneficio"), None, None).alias("older_benefit"),
    )


@query
def program_type_key(spark, sf_dir):
    key = keys.program_type_key(
        c("cdprograma"), c("cdpadron"), codes.benefit_name(c("cdtipobeneficio"))
    )
    return _raw(spark, sf_dir).select("newid", key.alias("programatipo"))


@query
def unified_id(spark, sf_dir):
    key = keys.unified_id(
        codes.origin_code(c("nborigen")),
        c("cddependencia"),
        c("cdprograma"),
        c("cdpadron"),
        text.clean_int(c("anio")),
    )
    return _raw(spark, sf_dir).select("newid", key.alias("iduni"))


@query
def pad_state(spark, sf_dir):
    rows = view(spark, sf_dir, "survey_programmes")
    return rows.select("cuaps_folio", text.pad_state(c("cve_entidad_federativa")).alias("cve_ent"))


@query
def num_text(spark, sf_dir):
    rows = view(spark, sf_dir, "programme_catalogue")
    return rows.select(
        "iduni", *[text.number_text(c(n)).alias(n) for n in ("anio", "cd_dependencia")]
    )


@query
def gov_level(spark, sf_dir):
    rows = view(spark, sf_dir, "survey_programmes")
    return rows.select("cuaps_folio", codes.gov_level(c("orden_gob")).alias("nb_orden_gob"))


def _documents(spark, sf_dir, clean, name):
    return table(spark, sf_dir, "documents").select("doc_id", clean(c("text")).alias(name))


@query
def scrub_text(spark, sf_dir):
    return _documents(spark, sf_dir, text.scrub_text, "scrubbed")


@query
def strip_non_ascii(spark, sf_dir):
    return _documents(spark, sf_dir, encoding.strip_non_ascii, "ascii_text")


@query
def cp1252_fix(spark, sf_dir):
    """Texts in which 27 letters stand for the bytes 0x80 to 0x9F, repaired."""

    def misread(t):
        return F.translate(t, MISREAD_LETTERS, "".join(map(chr, MISREAD_BYTES)))

    return _documents(spark, sf_dir, lambda t: encoding.cp1252_fix(misread(t)), "repaired")


@query
def keyword_field(spark, sf_dir):
    return _documents(spark, sf_dir, text.keyword_field, "text_keyword")


# --- Registry pipeline ---


def _dimensions(spark, sf_dir):
    return [view(spark, sf_dir, n) for n in ("programme_catalogue", "municipalities", "states")]


def _enriched(spark, sf_dir):
    return registry.enriched_registry(_raw(spark, sf_dir), *_dimensions(spark, sf_dir))


def _public(spark, sf_dir):
    return registry.with_partition_year(_enriched(spark, sf_dir), PUBLIC_COLUMNS)


@query
def clean_registry(spark, sf_dir):
    return registry.clean_registry(_raw(spark, sf_dir))


@query
def clean_registry_older(spark, sf_dir):
    cleaned = registry.clean_registry(_raw(spark, sf_dir), OLDER)
    return cleaned.select(
        "newid", "categoriaedad", "numespago", "origen", "nombretipobeneficio", "programatipo",
        "iduni", "age",
    )


@query
def geo_dim(spark, sf_dir):
    _, municipalities, states = _dimensions(spark, sf_dir)
    return dims.geography(municipalities, states)


@query
def enrich_catalog(spark, sf_dir):
    catalogue, _, _ = _dimensions(spark, sf_dir)
    named = registry.enrich_catalogue(registry.clean_registry(_raw(spark, sf_dir)), catalogue)
    return named.select(
        "newid", "iduni", "file_year", "nombresubp1", "nombreprograma", "nbdependencia",
        "nbdepencorto",
    )


@query
def enrich_geo(spark, sf_dir):
    _, municipalities, states = _dimensions(spark, sf_dir)
    cleaned = registry.clean_registry(_raw(spark, sf_dir))
    placed = registry.enrich_geography(cleaned, municipalities, states)
    return placed.select("newid", "cvemuni", "cveent", "noment", "nommun")


@query
def amount_rules_query(spark, sf_dir):
    rows = _raw(spark, sf_dir).withColumn("nuimpmonetario", text.clean_long(c("nuimpmonetario")))
    return amount_rules(rows).select("newid", "nuimpmonetario")


@query
def exclude_rule_query(spark, sf_dir):
    return exclude_rule(_raw(spark, sf_dir)).select("newid", "cdprograma", "cdbeneficio")


@query
def publication(spark, sf_dir):
    return _public(spark, sf_dir)


@query
def cleaned(spark, sf_dir):
    return registry.with_partition_year(_enriched(spark, sf_dir), FULL_COLUMNS)


@query
def monthly_catalog(spark, sf_dir):
    return monthly.monthly_catalog(_public(spark, sf_dir))


@query
def bulk_docs(spark, sf_dir):
    return monthly.monthly_documents(monthly.monthly_catalog(_public(spark, sf_dir)), INDEX)


# --- Sources and sinks, through files in the scratch folder ---


@query
def read_raw(spark, sf_dir):
    folder = scratch_folder(spark, "deliveries")
    return files.read_registry(spark, write_deliveries(_raw(spark, sf_dir), folder)).select(
        *RAW_COLUMNS, "file_year"
    )


@query
def read_raw_gz(spark, sf_dir):
    """The same through compressed files, unpacked so that many tasks read on."""
    folder = scratch_folder(spark, "deliveries")
    path = write_deliveries(_raw(spark, sf_dir), folder, compression="gzip")
    return files.split_compressed(files.read_registry(spark, path)).select(*RAW_COLUMNS, "file_year")


@query
def read_catalog(spark, sf_dir):
    """The catalogue file under the registry's names and under its own header names."""
    rows = view(spark, sf_dir, "programme_catalogue")
    path = scratch_folder(spark, "catalogue")
    ordered = rows.select(
        F.lit("0").alias("index"), "cd_dependencia", "nb_origen", F.lit("1").alias("idadmin"),
        "cd_programa", "cd_padron", "anio", "nb_programa", "nb_subp1", "origen", "iduni",
        "origen_dep", "nb_dependencia", "nb_depen_corto", "sector",
    )
    write_pipe_csv(ordered, path)
    by_position = files.read_registry_catalogue(spark, path).select(
        F.lit("position").alias("read_by"), "iduni", "cdprograma", "cdpadron", "anio",
        "nombreprograma", "nbdependencia", F.lit(None).cast("string").alias("nombresubp1"),
        "nbdepencorto", "sector",
    )
    by_header = files.read_indexed(spark, path).select(
        F.lit("header"), "iduni", "cd_programa", "cd_padron", "anio", "nb_programa",
        "nb_dependencia", "nb_subp1", "nb_depen_corto", "sector",
    )
    return by_position.union(by_header)


@query
def sample_rows(spark, sf_dir):
    return files.sample_rows(_raw(spark, sf_dir).select(*RAW_COLUMNS), "newid", 0.1)


@query
def decode_text(spark, sf_dir):
    """Lines of all documents, their bytes read as Latin-1 and reduced to ASCII."""
    path = scratch_folder(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    decoded = files.decode_lines(spark, path, 2016)
    return decoded.groupBy("value").agg(F.count(F.lit(1)).alias("lines"))


@query
def roundtrip_partitioned(spark, sf_dir):
    root = scratch_folder(spark, "public")
    write_partitioned(_public(spark, sf_dir), root, ["anio", "numespago"])
    return spark.read.parquet(root)


@query
def append_rows(spark, sf_dir):
    """The public rows written in two runs, the second appended to the first."""
    root = scratch_folder(spark, "public")
    rows = _public(spark, sf_dir)
    first = c("newid") % 2 == 0
    write_partitioned(rows.where(first), root, ["anio", "numespago"])
    write_partitioned(rows.where(~first), root, ["anio", "numespago"], mode="append")
    return spark.read.parquet(root)


def _months(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and amounts by month of some tables."""
    sums = [
        materialised(
            df.groupBy(F.lit(kind).alias("kind"), "anio", "numespago")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("nuimpmonetario").alias("amount")),
            "months",
        )
        for kind, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, sums)


@query
def table_register(spark, sf_dir):
    """Rows and amounts by month in both external tables, which are dropped again."""
    full_root, public_root = scratch_folder(spark, "full"), scratch_folder(spark, "public")
    full = registry.with_partition_year(_enriched(spark, sf_dir), FULL_COLUMNS)
    write_years(full, full_root, public_root)
    year = [f for f in full.schema if f.name == "anio"]
    names = {kind: f"{kind}_{public_root.rsplit('-', 1)[1]}" for kind in ("public", "cleaned")}
    found = _months({
        "public": register_table(spark, names["public"], PUBLIC_SCHEMA.fields + year, public_root),
        "cleaned": register_table(spark, names["cleaned"], FULL_SCHEMA.fields + year, full_root),
    })
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")
    return found


def _published_twice(spark, sf_dir, between=lambda *_: None):
    """Roots of both tables: all years with half of their rows, then the even years whole, last
    the odd ones.  ``between`` is called with the roots and the years after each."""
    full_root, public_root = scratch_folder(spark, "full"), scratch_folder(spark, "public")
    rows = materialised(registry.with_partition_year(_enriched(spark, sf_dir), FULL_COLUMNS), "enriched")
    years = sorted(r.anio for r in rows.select("anio").distinct().collect())
    half = rows.where(c("newid") % 2 == 0)
    for df, some in ((half, years), (rows, [y for y in years if y % 2 == 0]), (rows, [y for y in years if y % 2])):
        publish_years(df.where(c("anio").isin(some)), full_root, public_root, some)
        between(full_root, public_root, some)
    return full_root, public_root


@query
def table_published(spark, sf_dir):
    """The same by month, from external tables over years that were published twice."""
    names = {}

    def follow(full_root, public_root, years):
        for kind, root, schema in (("public", public_root, PUBLIC_SCHEMA), ("cleaned", full_root, FULL_SCHEMA)):
            if kind in names:
                refresh_published(spark, names[kind], root, public_root, years)
            else:
                names[kind] = f"{kind}_{public_root.rsplit('-', 1)[1]}"
                register_published(spark, names[kind], schema, root, public_root)

    _published_twice(spark, sf_dir, follow)
    found = _months({kind: spark.table(name) for kind, name in names.items()})
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")
    return found


@query
def catalog_refresh(spark, sf_dir):
    """The monthly catalogue kept by years, each made anew when its year was published."""
    root = scratch_folder(spark, "catalogue")
    _published_twice(
        spark, sf_dir, lambda _, public_root, years: monthly.refresh_catalog(spark, public_root, root, years)
    )
    return monthly.kept_catalog(spark, root)


@query
def lookup_figures(spark, sf_dir):
    """How the rows of each year fared in the lookups, counted while they were published."""
    full_root, public_root = scratch_folder(spark, "full"), scratch_folder(spark, "public")
    years = [r.file_year for r in _raw(spark, sf_dir).select("file_year").distinct().collect()]
    figures = registry.LookupFigures(years)
    enriched = registry.enriched_registry(_raw(spark, sf_dir), *_dimensions(spark, sf_dir), figures=figures)
    full = registry.with_partition_year(enriched, FULL_COLUMNS)
    version = publish_years(full, full_root, public_root, years)
    write_figures(spark, public_root, version, figures.rows())
    return published_figures(spark, public_root)


@query
def stream_ingest(spark, sf_dir):
    """Deliveries in several files each, ingested as a stream.

    A first delivery of every year holds half of its rows; the second, with all of them, replaces
    it; a third run finds nothing new.  Names hold letters outside ASCII in Latin-1, those of one
    year in Windows-1252.
    """
    folder = scratch_folder(spark, "arrivals")
    full_root, public_root = scratch_folder(spark, "full"), scratch_folder(spark, "public")
    checkpoint = scratch_folder(spark, "progress")
    rows = _raw(spark, sf_dir)
    older = c("file_year") == CP1252_YEAR
    named = lambda mark: F.concat(c("nbprograma"), F.lit(mark))
    odd = F.regexp_extract("newid", "[0-9]+", 0).cast("bigint") % 2 == 1
    for name, chosen in (("first", odd), ("second", F.lit(True)), (None, None)):
        if name:
            latin = rows.where(chosen & ~older).withColumn("nbprograma", named(" ñ"))
            write_deliveries(latin, f"{folder}/{name}", files.ORIGINAL)
            # The bytes of Windows-1252, written as the Latin-1 letters they look like.
            windows = rows.where(chosen & older).withColumn(
                "nbprograma", encoding.cp1252_misread(named(" ñ€"))
            )
            write_deliveries(windows, f"{folder}/{name}", files.ORIGINAL)
        ingest_arrivals(
            spark, folder, full_root, public_root, checkpoint, *_dimensions(spark, sf_dir),
            cp1252_years=(CP1252_YEAR,),
        ).awaitTermination()
    return published(spark, public_root, public_root, PUBLIC_SCHEMA)


# --- Survey operators ---


def _survey(spark, sf_dir, *names):
    return [view(spark, sf_dir, n) for n in names]


def _keyed(spark, sf_dir):
    return survey.program_keys(*_survey(spark, sf_dir, "survey_programmes", "crosswalk"))


@query
def crosswalk(spark, sf_dir):
    return dims.crosswalk(view(spark, sf_dir, "crosswalk"))


@query
def program_keys(spark, sf_dir):
    return as_text(
        _keyed(spark, sf_dir).select(
            "cuaps_folio", "DGAE", "DGAIP", "id_pub", "chr_nombre_programa_cuaps",
            "nom_entidad_federativa", "cve_entidad_federativa", "obj_gral_prog",
            "derechos_sociales",
        )
    )


@query
def listed_program_keys(spark, sf_dir):
    programmes, pairs = _survey(spark, sf_dir, "survey_programmes", "crosswalk")
    return as_text(survey.listed_program_keys(programmes, pairs))


@query
def program_features(spark, sf_dir):
    criteria, components = _survey(spark, sf_dir, "survey_criteria", "survey_components")
    return as_text(survey.survey_features(_keyed(spark, sf_dir), criteria, components))


@query
def focus_groups(spark, sf_dir):
    rows = view(spark, sf_dir, "survey_criteria")
    code = F.coalesce("csc_configuracion_foc", F.lit(0))
    return rows.select("cuaps_folio", code.alias("code"), lists.focus_group(code).alias("focus"))


@query
def criterion_rows(spark, sf_dir):
    """One row per criterion, for folios whose list is too long for a row."""
    return survey.focus_criteria(view(spark, sf_dir, "survey_criteria"))


@query
def support_rows(spark, sf_dir):
    """One row per support."""
    return as_text(survey.supports(view(spark, sf_dir, "survey_components")))


@query
def register_rows(spark, sf_dir):
    """One row per register."""
    return catalogues.register_rows(view(spark, sf_dir, "programme_catalogue"))


@query
def nested_supports(spark, sf_dir):
    return as_text(survey.nested_supports(view(spark, sf_dir, "survey_components")))


@query
def nested_registers(spark, sf_dir):
    return as_text(catalogues.nested_registers(view(spark, sf_dir, "programme_catalogue")))


@query
def flatten_list(spark, sf_dir):
    rows = catalogues.fill_missing(view(spark, sf_dir, "programme_catalogue"))
    nested = nest(rows, ["cd_programa", "anio"], {"nb_subp1": c("nb_subp1")})
    names = lists.without_blanks(c("nb_subp1"))
    return nested.withColumn("nb_subp1", lists.list_text(names))


@query
def parse_list(spark, sf_dir):
    groups = survey.focus_criteria(view(spark, sf_dir, "survey_criteria"))
    nested = nest(groups, ["cuaps_folio"], {"items": c("criterios_focalizacion")})
    written = F.when(F.size("items") > 1, lists.list_text(c("items")))
    return as_text(nested.select("cuaps_folio", lists.parse_list(written).alias("items")))


@query
def dummies_to_array(spark, sf_dir):
    rows = view(spark, sf_dir, "survey_programmes")
    rights = lists.dummies_to_array(rows.columns, RIGHTS_PREFIX, RIGHTS)
    return as_text(rows.select("cuaps_folio", rights.alias("derechos_sociales")))


@query
def dummy_sums_query(spark, sf_dir):
    rows = typed_fill(view(spark, sf_dir, "survey_components"))
    return dummy_sums(rows, "cuaps_folio", SUPPORT_PREFIX)


@query
def support_types(spark, sf_dir):
    return as_text(survey.support_types(view(spark, sf_dir, "survey_components")))


@query
def typed_fill_query(spark, sf_dir):
    rows = view(spark, sf_dir, "survey_programmes")
    state = c("cve_entidad_federativa").cast("double") + 0.5
    return typed_fill(rows.withColumn("cve_entidad_federativa", state))


def _long(spark, sf_dir):
    rows = view(spark, sf_dir, "survey_programmes")
    return unpivot(rows, RIGHTS_PREFIX, ["cuaps_folio"], "derecho", "presente")


@query
def unpivot_query(spark, sf_dir):
    return _long(spark, sf_dir)


@query
def pivot_back_query(spark, sf_dir):
    labels = [f"{RIGHTS_PREFIX}{code}" for code in ("alim", "edu", "sal", "viv")]
    return pivot_back(_long(spark, sf_dir), ["cuaps_folio"], "derecho", "presente", labels)


# --- Feature catalogues ---


def _nested(spark, sf_dir):
    return catalogues.nested_catalogue(
        *_survey(
            spark, sf_dir, "programme_catalogue", "survey_programmes", "crosswalk",
            "survey_criteria", "survey_components", "profiles",
        )
    )


def _listed(spark, sf_dir, **options):
    return catalogues.listed_catalogue(
        *_survey(
            spark, sf_dir, "programme_catalogue", "survey_programmes", "crosswalk",
            "survey_components",
        ),
        text=True,
        **options,
    )


@query
def catalog_latest(spark, sf_dir):
    return catalogues.latest_catalogue(view(spark, sf_dir, "programme_catalogue"))


@query
def catalog_core(spark, sf_dir):
    return as_text(catalogues.listed_catalogue_core(view(spark, sf_dir, "programme_catalogue")))


@query
def has_profile(spark, sf_dir):
    catalogue, profiles = _survey(spark, sf_dir, "programme_catalogue", "profiles")
    known = profiles.withColumnRenamed("cve_programa", "cd_programa")
    rows = catalogue.select("iduni", "cd_programa")
    return membership(rows, known, ["cd_programa"], "tiene_perfil")


@query
def catalog_features(spark, sf_dir):
    return as_text(_nested(spark, sf_dir))


@query
def feature_docs(spark, sf_dir):
    return catalogues.feature_documents(_nested(spark, sf_dir), FEATURE_INDEX)


@query
def catalog_csv(spark, sf_dir):
    path = scratch_folder(spark, "features")
    write_pipe_csv(_nested(spark, sf_dir), path)
    return files.read_named(spark, path)


@query
def listed_csv(spark, sf_dir):
    path = scratch_folder(spark, "listed")
    write_pipe_csv(_listed(spark, sf_dir), path, compression="gzip")
    return files.read_named(spark, path)


@query
def missing_csv(spark, sf_dir):
    path = scratch_folder(spark, "missing")
    report = catalogues.missing_in_survey(_nested(spark, sf_dir), _keyed(spark, sf_dir))
    write_pipe_csv(report, path)
    return files.read_named(spark, path)


@query
def catalog_arrays(spark, sf_dir):
    return _listed(spark, sf_dir)


@query
def catalog_arrays_split(spark, sf_dir):
    return _listed(spark, sf_dir, last_history_year=SPLIT_YEAR)


@query
def missing_in_survey(spark, sf_dir):
    return catalogues.missing_in_survey(_nested(spark, sf_dir), _keyed(spark, sf_dir))


@query
def missing_in_catalog(spark, sf_dir):
    catalogue = view(spark, sf_dir, "programme_catalogue")
    return catalogues.missing_in_catalog(_keyed(spark, sf_dir), catalogue)


def registered():
    """All queries by name."""
    return dict(QUERIES)
