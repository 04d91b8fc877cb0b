"""Column lists of the tables the pipelines read and write."""

from pyspark.sql import types as T

# --- Fixed values: the column names and orders of the exchanged tables. ---

RAW_COLUMNS = """
    cddependencia nborigen idadmin cdprograma cdpadron anio tipobeneficiario nbprograma
    nbsubprograma1 periodo idregistro idhogar idcuisps idcuissedesol fechalevantamiento
    idpersona nbprimerap nbsegundoap nbnombre fhnacimiento cdsexo inhuella iniris
    cdinstitucion cdintraprograma nbsubprograma fechaalta cdestatusben cdestatushog
    cdentpago cdmunpago cdlocpago nbperiodocorresp cdtipobeneficio cdtipoexpedicion
    intitular cdparentesco nubeneficios cdbeneficio nuimpmonetario numespago cdmetpago
    idagrupador incorresp nomloc cveloc nommun cvemun noment cveent newid
""".split()

CATALOGUE_COLUMNS = """
    extra lcddependencia nborigen idadmin cdprograma cdpadron anio nombreprograma
    nombresubp1 origen iduni origendep nbdependencia nbdepencorto sector
""".split()

FULL_COLUMNS = """
    categoriaedad cdbeneficio cddependencia cdestatusben cdestatushog cdinstitucion
    cdintraprograma cdmetpago cdpadron cdparentesco cdprograma cdsexo cdtipobeneficio
    nombretipobeneficio cdtipoexpedicion cveent cveentpago cveloc cvelocpago cvemuni
    cvemunipago fechaalta fechalevantamiento fhnacimiento idadmin idagrupador idcuisps
    idcuissedesol idhogar idpersona idregistro incorresp inhuella iniris intitular
    mescorresp nbnombre nbperiodocorresp nbprimerap nbprograma nbsegundoap nbsubprograma
    nbsubprograma1 newid noment nomloc nommun nubeneficios nuimpmonetario numespago origen
    periodo tipobeneficiario programatipo iduni nombresubp1 nombreprograma nbdependencia
    nbdepencorto
""".split()

PUBLIC_COLUMNS = """
    categoriaedad cdbeneficio cddependencia cdinstitucion cdpadron cdprograma cdsexo
    cdtipobeneficio nombretipobeneficio cveent cveentpago cvemuni cvemunipago mescorresp
    nbnombre nbprimerap nbprograma nbsegundoap newid noment nommun nubeneficios
    nuimpmonetario numespago origen periodo programatipo nombresubp1 nombreprograma
    nbdependencia nbdepencorto
""".split()

MONTHLY_COLUMNS = """
    anio numespago cveent cvemuni origen cddependencia nbdependencia cdprograma nbprograma
""".split()

NESTED_FEATURE_COLUMNS = """
    cd_programa id_pub nb_programa DGAE DGAIP anio obj_gral_prog cuaps_folio
    derechos_sociales nb_origen nb_subp1 origen padrones apoyos criterios_focalizacion
    tiene_perfil nom_ent cve_ent
""".split()

LISTED_FEATURE_COLUMNS = """
    cd_programa id_pub nb_programa iduni DGAE DGAIP cd_dependencia nb_dependencia
    nb_depen_corto anio origen nb_origen origen_dep cd_padron cuaps_folio nb_subp1
    derechos_sociales tipos_apoyos
""".split()

REGISTER_FIELDS = """
    cd_programa anio iduni cd_dependencia cd_padron origen_dep nb_dependencia
    nb_depen_corto sector
""".split()

MISSING_REPORT_COLUMNS = """
    cuaps_folio cd_programa nb_programa anio obj_gral_prog nom_ent cve_ent
""".split()

# --- Types derived from the lists above. ---

#: Partition columns of both registry tables.
PARTITION_COLUMNS = ["anio", "numespago"]

_TYPES = {
    "newid": T.LongType(),
    "mescorresp": T.IntegerType(),
    "nuimpmonetario": T.LongType(),
    "numespago": T.IntegerType(),
    "anio": T.IntegerType(),
}


def _struct(names, types=None):
    types = types or {}
    return T.StructType([T.StructField(n, types.get(n, T.StringType()), True) for n in names])


RAW_SCHEMA = _struct(RAW_COLUMNS)
CATALOGUE_SCHEMA = _struct(CATALOGUE_COLUMNS, {"idadmin": T.IntegerType()})
FULL_SCHEMA = _struct(FULL_COLUMNS, _TYPES)
PUBLIC_SCHEMA = _struct(PUBLIC_COLUMNS, _TYPES)
