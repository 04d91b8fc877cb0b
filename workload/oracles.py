"""DuckDB statements that give the registered queries' results independently of Spark."""

import json

from rollcall.schemas import (
    FULL_COLUMNS,
    LISTED_FEATURE_COLUMNS,
    MISSING_REPORT_COLUMNS,
    MONTHLY_COLUMNS,
    NESTED_FEATURE_COLUMNS,
    PUBLIC_COLUMNS,
    RAW_COLUMNS,
    REGISTER_FIELDS,
)
from workload.queries import CP1252_YEAR, FEATURE_INDEX, INDEX, SPLIT_YEAR
from workload.views import with_views

#: What names a feature document.
FEATURE_KEYS = ["cd_programa", "id_pub", "cuaps_folio", "anio"]

# --- Expressions ---


def bare(x):
    return f"replace({x}, '\"', '')"


def number(x, kind="INTEGER"):
    text = f"trim({bare(x)})"
    return f"CASE WHEN regexp_full_match({text}, '[+-]?[0-9]+') THEN TRY_CAST({text} AS {kind}) END"


def padded(x, width):
    return f"lpad(CAST({x} AS VARCHAR), {width}, '0')"


def coded(n, end, width):
    return f"CASE WHEN {n} > 0 AND {n} < {end} THEN {padded(n, width)} END"


def state(x):
    return coded(f"({number(x)})", 33, 2)


def municipality(x, s):
    m, e = f"({number(x)})", f"TRY_CAST({s} AS INTEGER)"
    return (
        f"CASE WHEN {m} > 0 AND {m} < 999 AND {e} > 0 AND {e} <= 32 "
        f"THEN {padded(e, 2)} || {padded(m, 3)} END"
    )


def locality(x):
    return coded(f"({number(x)})", 9999, 4)


GENDER = "CASE WHEN contains(cdsexo, 'H') THEN 'H' WHEN contains(cdsexo, 'M') THEN 'M' END"


def origin(missing):
    return (
        f"CASE WHEN nborigen IS NULL THEN {missing} WHEN contains(nborigen, 'F') THEN 'F' "
        "WHEN contains(nborigen, 'E') THEN 'E' END"
    )


MARK = f"lower(substr({bare('periodo')}, 3, 1))"
MONTH = (
    f"CASE WHEN length({bare('periodo')}) < 3 THEN NULL "
    f"WHEN regexp_full_match({MARK}, '[0-9]') THEN CAST({MARK} AS INTEGER) "
    f"WHEN {MARK} = 'a' THEN 10 WHEN {MARK} = 'b' THEN 11 WHEN {MARK} = 'c' THEN 12 END"
)


def paid(month):
    return (
        f"CASE WHEN ({number('numespago', 'BIGINT')}) <> 0 AND {month} BETWEEN 1 AND 12 "
        f"THEN {month} END"
    )


OWN_MONTH = f"CASE WHEN ({number('numespago')}) BETWEEN 1 AND 12 THEN {number('numespago')} END"


def benefit(other, missing):
    n = f"({number('cdtipobeneficio', 'BIGINT')})"
    return (
        f"CASE {n} WHEN 1 THEN 'monetario' WHEN 2 THEN 'especie' WHEN 3 THEN 'servicio' "
        "WHEN 4 THEN 'mixto' WHEN 5 THEN 'subsidiado' WHEN 6 THEN 'indirecto' "
        f"ELSE CASE WHEN {n} IS NULL THEN {missing} ELSE {other} END END"
    )


BENEFIT = benefit("'otro'", "'no_disponible'")
BORN = (
    f"CASE WHEN regexp_full_match({bare('fhnacimiento')}, '[0-9]{{8}}') "
    f"THEN CAST(try_strptime({bare('fhnacimiento')}, '%Y%m%d') AS DATE) END"
)


def age(year, month, born):
    return (
        f"CASE WHEN {month} BETWEEN 1 AND 12 AND {year} BETWEEN 1 AND 9999 THEN "
        f"CAST({year} - year({born}) - CASE WHEN {month} < month({born}) OR "
        f"({month} = month({born}) AND 1 < day({born})) THEN 1 ELSE 0 END AS INTEGER) END"
    )


def band(a, teen="Adolescente", young="Joven", adult="Adulto"):
    return (
        f"CASE WHEN {a} > 60 THEN 'Adulto Mayor' WHEN {a} <= 11 THEN 'Infante' "
        f"WHEN {a} BETWEEN 12 AND 18 THEN '{teen}' WHEN {a} BETWEEN 19 AND 29 THEN '{young}' "
        f"WHEN {a} BETWEEN 30 AND 60 THEN '{adult}' END"
    )


OLDER_BAND = dict(teen="Adolescentes", young="Jóvenes", adult="Adultos")


def adult_name(name):
    return f"CASE WHEN age < 18 THEN NULL ELSE {name} END"


def joined(separator, *parts):
    return f" || '{separator}' || ".join(f"coalesce(CAST({p} AS VARCHAR), 'None')" for p in parts)


def whole(x):
    return f"CAST(CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS BIGINT) AS VARCHAR)"


ZERO = (
    "(cdprograma = 'S072' AND cdpadron = 'S072' AND cdbeneficio = '60' AND cdtipobeneficio = '6')"
    " OR (cdprograma = 'S072' AND cdpadron = '0377' AND cdbeneficio = '60')"
    " OR (cdprograma = 'S174' AND cdtipobeneficio = '3')"
    " OR (cdprograma = 'S241' AND cdbeneficio = '1')"
    " OR (cdprograma = 'S241' AND cdpadron = '0567' AND cdpadron = '0568')"
)
KEPT = "cdprograma NOT IN ('S052') OR cdprograma = 'S052' AND cdbeneficio <> '60'"


# --- Registry ---


def cleaned_ctes(month, origin_sql, benefit_sql, bands):
    """The cleaned registry as CTE ``clean``, every raw column in its cleaned form."""
    changed = {
        "newid": number("newid", "BIGINT"),
        "anio": number("anio"),
        "cdsexo": GENDER,
        "nuimpmonetario": number("nuimpmonetario", "BIGINT"),
        "cveent": state("cveent"),
        "cveloc": locality("cveloc"),
    }
    first = ", ".join(
        [f"{sql} AS {name}" for name, sql in changed.items()]
        + [
            f"{MONTH} AS mescorresp",
            f"{origin_sql} AS origen",
            f"{state('cdentpago')} AS cveentpago",
            f"{locality('cdlocpago')} AS cvelocpago",
            f"{benefit_sql} AS nombretipobeneficio",
            f"{BORN} AS born",
        ]
    )
    second = ", ".join(
        [
            f"{month} AS numespago",
            f"{age('anio', 'mescorresp', 'born')} AS age",
            f"{municipality('cdmunpago', 'cveentpago')} AS cvemunipago",
            f"{municipality('cvemun', 'cveent')} AS cvemuni",
            "cdprograma_key || '_' || coalesce(nombretipobeneficio, 'no_disponible') AS programatipo",
            f"{joined('-', 'origen', 'cddependencia', 'cdprograma', 'cdpadron', 'anio')} AS iduni",
        ]
    )
    key = joined("_", "cdprograma", "cdpadron")
    third = ", ".join(
        [f"{band('age', **bands)} AS categoriaedad"]
        + [f"{adult_name(n)} AS {n}" for n in ("nbprimerap", "nbsegundoap", "nbnombre")]
    )
    return (
        f", c1 AS (SELECT * EXCLUDE ({', '.join(changed)}), {key} AS cdprograma_key, {first}"
        " FROM raw_registry),"
        f" c2 AS (SELECT * EXCLUDE (numespago), {second} FROM c1),"
        " clean AS (SELECT * EXCLUDE (nbprimerap, nbsegundoap, nbnombre, born, cdprograma_key),"
        f" {third} FROM c2)"
    )


CLEAN = cleaned_ctes(paid("mescorresp"), origin("'F'"), BENEFIT, {})
OLDER_CLEAN = cleaned_ctes(OWN_MONTH, origin("NULL"), benefit("NULL", "NULL"), OLDER_BAND)
GEO = (
    ", geo AS (SELECT m.CVE_ENT AS cveent, CVEGEO AS cvemuni, NOMGEO AS nommuni, NOM_ENT AS noment"
    " FROM municipalities m LEFT JOIN states s ON m.CVE_ENT = s.CVE_ENT)"
)
NAMES = (
    ", names AS (SELECT iduni, CAST(TRY_CAST(anio AS DOUBLE) AS INTEGER) AS file_year,"
    " nb_subp1 AS nombresubp1, nb_programa AS nombreprograma, nb_dependencia AS nbdependencia,"
    " nb_depen_corto AS nbdepencorto FROM programme_catalogue)"
)
_FROM_CLEAN = [c for c in FULL_COLUMNS if c not in ("cveent", "noment", "nuimpmonetario",
               "nombresubp1", "nombreprograma", "nbdependencia", "nbdepencorto")]
ENRICHED = (
    with_views("raw_registry", "programme_catalogue", "municipalities", "states")
    + CLEAN + GEO + NAMES
    + ", enriched AS (SELECT "
    + ", ".join(f"r.{c}" for c in _FROM_CLEAN)
    + ", g.cveent, g.noment, n.nombresubp1, n.nombreprograma, n.nbdependencia, n.nbdepencorto,"
    f" CASE WHEN {ZERO} THEN 0 ELSE r.nuimpmonetario END AS nuimpmonetario, r.file_year AS anio"
    " FROM clean r LEFT JOIN names n ON r.iduni = n.iduni AND r.file_year = n.file_year"
    f" LEFT JOIN geo g ON r.cvemuni = g.cvemuni WHERE {KEPT})"
)
PUBLICATION = f"{ENRICHED} SELECT {', '.join(PUBLIC_COLUMNS)}, anio FROM enriched"
MONTHLY = f"{ENRICHED}, monthly AS (SELECT DISTINCT {', '.join(MONTHLY_COLUMNS)} FROM enriched)"


def action(index):
    return "'" + json.dumps({"index": {"_index": index, "_type": "catalogo"}}) + "' || chr(10) || "


def named_action(index, fields):
    """The action with an id made of the fields."""
    start = json.dumps({"index": {"_index": index, "_type": "catalogo"}})[:-2] + ', "_id": "'
    values = ", ".join(f"coalesce(CAST({x} AS VARCHAR), '')" for x in fields)
    return f"'{start}' || substr(sha256(concat_ws(chr(31), {values})), 1, 32) || '\"}}}}' || chr(10) || "


def document(fields):
    return "CAST(to_json(struct_pack(" + ", ".join(f"{n} := {x}" for n, x in fields) + ")) AS VARCHAR)"


MONTHLY_DOCUMENT = document(
    [(c, c if c in ("anio", "numespago") else f"coalesce({c}, '')") for c in MONTHLY_COLUMNS]
)


def raw(*columns):
    return f"{with_views('raw_registry')} SELECT newid, {', '.join(columns)} FROM raw_registry"


def aged(*columns):
    return (
        f"{with_views('raw_registry')}, aged AS (SELECT * EXCLUDE (anio), {number('anio')} AS anio,"
        f" {MONTH} AS mes, {BORN} AS born FROM raw_registry),"
        f" ages AS (SELECT *, {age('anio', 'mes', 'born')} AS age FROM aged)"
        f" SELECT newid, {', '.join(columns)} FROM ages"
    )


def documents(expression, name):
    return f"SELECT doc_id, {expression} AS {name} FROM documents"


ASCII = "regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')"

# --- Survey ---


def text_of(array):
    return f"CAST(to_json({array}) AS VARCHAR)"


def present(marks):
    cases = ", ".join(f"CASE WHEN {c} IS DISTINCT FROM 0 THEN '{label}' END" for c, label in marks)
    return f"list_filter([{cases}], lambda z: z IS NOT NULL)"


RIGHTS = present([
    ("der_social_alim", "Alimentación"), ("der_social_edu", "Educación"),
    ("der_social_sal", "Salud"), ("der_social_viv", "Vivienda"),
])
SUPPORTS = [("tipo_apoyo_mon", "Monetario"), ("tipo_apoyo_esp", "Especie"), ("tipo_apoyo_otro", "Otro")]
LEVEL_KEY = (
    "coalesce(CASE orden_gob WHEN 1 THEN chr_clave_prespupuestal_pro WHEN 2 THEN cuaps_folio END, '')"
)
UNSHARED = f"CASE WHEN contains({LEVEL_KEY}, '21111') THEN cuaps_folio ELSE {LEVEL_KEY} END"


def unblank(key, folio):
    return f"CASE WHEN {key} = '' THEN {folio} ELSE {key} END"


def abbreviated(key):
    for name, short in (("AGUASCALIENTES", "AGS"), ("JALISCO", "JAL"), ("OAXACA", "OAX"), ("TABASCO", "TAB")):
        key = f"replace({key}, '{name}', '{short}')"
    return key


def filled(x):
    return f"replace(coalesce({x}, 'null'), '\"', '')"


def padded_state(x):
    return (
        f"CASE WHEN coalesce({x}, 0) = 0 THEN 'null' WHEN length(CAST({x} AS VARCHAR)) >= 2 "
        f"THEN CAST({x} AS VARCHAR) ELSE {padded(x, 2)} END"
    )


PAIRS = (
    ", pairs AS (SELECT DISTINCT DGAIP, DGAE FROM crosswalk"
    " WHERE DGAIP IS NOT NULL AND DGAE IS NOT NULL)"
)
KEYED = (
    PAIRS
    + ", k1 AS (SELECT *, " + abbreviated("(" + unblank(f"({UNSHARED})", "cuaps_folio") + ")") + " AS DGAE"
    " FROM survey_programmes), keyed AS (SELECT "
    f"{filled('k1.cuaps_folio')} AS cuaps_folio, {filled('k1.DGAE')} AS DGAE,"
    f" {filled('DGAIP')} AS DGAIP, {filled('coalesce(DGAIP, k1.DGAE)')} AS id_pub,"
    f" {filled('trim(chr_nombre_programa_cuaps)')} AS chr_nombre_programa_cuaps,"
    f" {filled('trim(nom_entidad_federativa)')} AS nom_entidad_federativa,"
    f" {padded_state('cve_entidad_federativa')} AS cve_entidad_federativa,"
    f" {filled('obj_gral_prog')} AS obj_gral_prog, {RIGHTS} AS derechos_sociales"
    " FROM k1 LEFT JOIN pairs ON k1.DGAE = pairs.DGAE)"
)
LISTED_KEYED = (
    PAIRS
    + ", k1 AS (SELECT trim(cuaps_folio) AS cuaps_folio, trim(chr_clave_prespupuestal_pro) AS clave,"
    f" {RIGHTS} AS derechos_sociales, trim({abbreviated('(' + UNSHARED + ')')}) AS d0"
    f" FROM survey_programmes), k2 AS (SELECT *, {unblank('d0', 'cuaps_folio')} AS DGAE FROM k1),"
    f" keyed AS (SELECT {filled('k2.DGAE')} AS DGAE, {filled('k2.cuaps_folio')} AS cuaps_folio,"
    f" {filled('clave')} AS chr_clave_prespupuestal_pro, derechos_sociales,"
    f" {filled('DGAIP')} AS DGAIP, {filled('coalesce(DGAIP, k2.DGAE)')} AS id_pub"
    " FROM k2 LEFT JOIN pairs ON k2.DGAE = pairs.DGAE)"
)
FOCUS = (
    "CASE "
    "WHEN csc_configuracion_foc IN (36, 1754, 1755, 1756, 1757) THEN 'adultos mayores' "
    "WHEN csc_configuracion_foc IN (37) THEN 'migrantes' "
    "WHEN csc_configuracion_foc IN (38) THEN 'embarazadas' "
    "WHEN csc_configuracion_foc IN (39) THEN 'jefas de familia' "
    "WHEN csc_configuracion_foc IN (40) THEN 'padres o madres solos' "
    "WHEN csc_configuracion_foc IN (41) THEN 'enfermos cronicos' "
    "WHEN csc_configuracion_foc IN (43, 170, 171, 172, 173, 174, 175, 176) THEN 'personas con discapacidad' "
    "WHEN csc_configuracion_foc IN (42, 167, 168, 169) THEN 'poblacion indigena' "
    "WHEN csc_configuracion_foc IN (44) THEN 'otro grupo vulnerable' "
    "WHEN csc_configuracion_foc IN (31, 32, 33) THEN 'pobreza' "
    "WHEN csc_configuracion_foc IN (34, 35) THEN 'vulnerabilidad' "
    "WHEN csc_configuracion_foc IN (134, 135, 136, 137, 138, 139, 140, 141, 142, 143, 144, 145) THEN 'marginacion' "
    "ELSE '' END"
)
CRITERIA = (
    f", groups AS (SELECT cuaps_folio, {FOCUS} AS focus FROM survey_criteria), criteria AS (SELECT"
    " cuaps_folio, coalesce(list(focus ORDER BY focus) FILTER (focus <> ''), []) AS criterios"
    " FROM groups GROUP BY cuaps_folio)"
)
RECORD_FIELDS = [
    "cuaps_folio", "id_componente", "id_apoyo", "nombre_apoyo", "tipo_apoyo_mon",
    "tipo_apoyo_esp", "tipo_apoyo_otro", "id_apoyo_index", "tipos",
]
COMPONENTS = (
    ", components AS (SELECT cuaps_folio, id_componente, id_apoyo,"
    f" {filled('nombre_apoyo')} AS nombre_apoyo,"
    + ", ".join(f" coalesce({c}, 0) AS {c}" for c, _ in SUPPORTS)
    + ", cuaps_folio || '-' || id_componente || '-' || id_apoyo AS id_apoyo_index,"
    + f" {present([(f'coalesce({c}, 0)', label) for c, label in SUPPORTS])} AS tipos"
    " FROM survey_components), nested AS (SELECT cuaps_folio, list(struct_pack("
    + ", ".join(f"{f} := {f}" for f in RECORD_FIELDS)
    + ") ORDER BY id_componente, id_apoyo) AS apoyos FROM components GROUP BY cuaps_folio)"
)
SURVEY_VIEWS = ("survey_programmes", "crosswalk", "survey_criteria", "survey_components")
FEATURES = (
    KEYED + CRITERIA + COMPONENTS
    + ", surveyed AS (SELECT k.* RENAME (nom_entidad_federativa AS nom_ent,"
    " cve_entidad_federativa AS cve_ent), criterios AS criterios_focalizacion,"
    " coalesce(apoyos, []) AS apoyos"
    " FROM keyed k JOIN criteria c ON k.cuaps_folio = c.cuaps_folio"
    " LEFT JOIN nested n ON k.cuaps_folio = n.cuaps_folio)"
)
TYPE_SUMS = (
    ", sums AS (SELECT cuaps_folio, "
    + ", ".join(f"CAST(sum(coalesce({c}, 0)) AS BIGINT) AS {c}" for c, _ in SUPPORTS)
    + " FROM survey_components GROUP BY cuaps_folio),"
    f" types AS (SELECT cuaps_folio, {present(SUPPORTS)} AS tipos_apoyos FROM sums)"
)

# --- Programme catalogue ---

CATALOGUE_COLUMNS = [
    "iduni", "cd_dependencia", "cd_programa", "cd_padron", "anio", "nb_origen", "origen",
    "nb_programa", "nb_subp1", "origen_dep", "nb_dependencia", "nb_depen_corto", "sector",
]


def scrubbed(x):
    return f"replace(replace(coalesce({x}, 'null'), chr(160), ' '), '\"', '')"


def clean_catalogue(source):
    columns = ", ".join(
        f"{whole(c)} AS {c}" if c in ("anio", "cd_dependencia") else f"{scrubbed(c)} AS {c}"
        for c in CATALOGUE_COLUMNS
    )
    return f"SELECT {columns} FROM {source}"


LATEST = (
    ", ranked AS (SELECT *, row_number() OVER (PARTITION BY cd_programa ORDER BY"
    " TRY_CAST(anio AS DOUBLE) DESC NULLS LAST, "
    + ", ".join(f"{c} NULLS LAST" for c in CATALOGUE_COLUMNS if c != "cd_programa")
    + f") AS place FROM programme_catalogue), latest AS ({clean_catalogue('ranked')} WHERE place = 1)"
)
REGISTER = "struct_pack(" + ", ".join(f"{f} := {f}" for f in REGISTER_FIELDS) + ")"
NO_REGISTER = "[struct_pack(" + ", ".join(f"{f} := 'null'" for f in REGISTER_FIELDS) + ")]"
NO_SUPPORT = (
    "[struct_pack(cuaps_folio := 'null', id_componente := CAST(NULL AS BIGINT),"
    " id_apoyo := CAST(NULL AS INTEGER), nombre_apoyo := 'null',"
    + "".join(f" {c} := CAST(NULL AS INTEGER)," for c, _ in SUPPORTS)
    + " id_apoyo_index := 'null', tipos := CAST([] AS VARCHAR[]))]"
)
CORE = (
    ", core AS (SELECT cd_programa, anio, list_filter([nb_subp1], lambda z: z <> '') AS nb_subp1,"
    f" nb_origen, nb_programa, origen, [{REGISTER}] AS padrones FROM latest)"
)
NESTED = (
    with_views("programme_catalogue", "profiles", *SURVEY_VIEWS) + FEATURES + LATEST + CORE
    + ", matched AS (SELECT coalesce(cd_programa, id_pub) AS cd_programa,"
    " coalesce(id_pub, 'null') AS id_pub,"
    " coalesce(nb_programa, chr_nombre_programa_cuaps) AS nb_programa,"
    " coalesce(DGAE, 'null') AS DGAE, coalesce(DGAIP, 'null') AS DGAIP,"
    " coalesce(anio, 'null') AS anio,"
    " CASE WHEN coalesce(obj_gral_prog, '') = 'null' THEN '' ELSE coalesce(obj_gral_prog, '') END"
    " AS obj_gral_prog, coalesce(cuaps_folio, 'null') AS cuaps_folio,"
    " coalesce(derechos_sociales, []) AS derechos_sociales, coalesce(nb_origen, 'null') AS nb_origen,"
    " coalesce(nb_subp1, ['null']) AS nb_subp1, coalesce(origen, 'null') AS origen,"
    f" coalesce(padrones, {NO_REGISTER}) AS padrones, coalesce(apoyos, {NO_SUPPORT}) AS apoyos,"
    " coalesce(criterios_focalizacion, []) AS criterios_focalizacion,"
    " coalesce(nom_ent, 'null') AS nom_ent, coalesce(cve_ent, 'null') AS cve_ent"
    " FROM core FULL OUTER JOIN surveyed ON core.cd_programa = surveyed.id_pub),"
    " features AS (SELECT *, CASE WHEN cd_programa IN (SELECT cve_programa FROM profiles)"
    " THEN 1 ELSE 0 END AS tiene_perfil FROM matched)"
)
NESTED_LISTS = ("derechos_sociales", "nb_subp1", "padrones", "apoyos", "criterios_focalizacion")


def selected(columns, lists):
    return ", ".join(f"{text_of(c)} AS {c}" if c in lists else c for c in columns)


def nulled(record, names, plain=()):
    fields = ", ".join(
        f"{n} := {record}.{n}" if n in plain else f"{n} := nullif({record}.{n}, 'null')" for n in names
    )
    return f"struct_pack({fields})"


_PLAIN = ("id_componente", "id_apoyo", "tipos", *[c for c, _ in SUPPORTS])
DOCUMENT_FIELDS = {
    **{c: f"list_transform({c}, lambda z: nullif(z, 'null'))"
       for c in ("derechos_sociales", "nb_subp1", "criterios_focalizacion")},
    "padrones": f"list_transform(padrones, lambda z: {nulled('z', REGISTER_FIELDS)})",
    "apoyos": f"list_transform(apoyos, lambda z: {nulled('z', RECORD_FIELDS, _PLAIN)})",
}
_SHORT = "CASE WHEN length({0}) <= 256 THEN {0} END"
KEYWORDS = [
    (f"{c}_keyword", _SHORT.format(c)) if c in ("nb_programa", "nb_origen", "origen", "nom_ent")
    else (f"{c}_keyword", f"list_transform({DOCUMENT_FIELDS[c]}, lambda y: {_SHORT.format('y')})")
    for c in (
        "nb_programa", "derechos_sociales", "nb_origen", "nb_subp1", "origen",
        "criterios_focalizacion", "nom_ent",
    )
]
FEATURE_DOCUMENT = document([(c, DOCUMENT_FIELDS.get(c, c)) for c in NESTED_FEATURE_COLUMNS] + KEYWORDS)

LISTED_FIELDS = [
    "cd_dependencia", "cd_padron", "iduni", "origen_dep", "nb_dependencia", "nb_depen_corto",
    "sector", "nb_subp1",
]
LISTED_CLEAN = (
    ", listed AS (SELECT "
    + ", ".join(
        f"coalesce({whole(c)}, 'null') AS {c}" if c in ("anio", "cd_dependencia")
        else f"replace(coalesce({c}, 'null'), chr(160), ' ') AS {c}"
        for c in CATALOGUE_COLUMNS
    )
    + " FROM programme_catalogue)"
)
LISTED_CORE = (
    LISTED_CLEAN
    + ", chosen AS (SELECT cd_programa, anio, min(struct_pack(nb_origen := nb_origen,"
    " nb_programa := nb_programa, origen := origen)) AS n, "
    + ", ".join(
        f"coalesce(list({c} ORDER BY {', '.join(LISTED_FIELDS)}) FILTER ({c} <> ''), []) AS {c}"
        for c in LISTED_FIELDS
    )
    + " FROM listed GROUP BY cd_programa, anio), core AS (SELECT * EXCLUDE (n), n.nb_origen AS"
    " nb_origen, n.nb_programa AS nb_programa, n.origen AS origen FROM chosen)"
)
LISTED_OUTPUT = [
    f"{text_of(f'coalesce({c}, [])')} AS {c}" if c in LISTED_FIELDS
    else "{} AS {}".format(text_of(f"coalesce({c}, ['null'])"), c)
    if c in ("derechos_sociales", "tipos_apoyos")
    else f"coalesce({c}, 'null') AS {c}"
    for c in LISTED_FEATURE_COLUMNS
]


def listed_catalogue(last_history_year):
    views = with_views("programme_catalogue", "survey_programmes", "crosswalk", "survey_components")
    return (
        views + LISTED_KEYED + TYPE_SUMS + LISTED_CORE
        + ", surveyed AS (SELECT k.*, coalesce(tipos_apoyos, []) AS tipos_apoyos FROM keyed k"
        " LEFT JOIN types t ON k.cuaps_folio = t.cuaps_folio),"
        f" present AS (SELECT * FROM core WHERE coalesce(TRY_CAST(anio AS INTEGER) > {last_history_year}, true)),"
        f" past AS (SELECT * FROM core WHERE TRY_CAST(anio AS INTEGER) <= {last_history_year}),"
        " rows_ AS (SELECT * FROM present FULL OUTER JOIN surveyed ON cd_programa = id_pub"
        " UNION ALL BY NAME SELECT * FROM past)"
        f" SELECT {', '.join(LISTED_OUTPUT)} FROM rows_"
    )


NOT_SURVEYED = (
    f"{NESTED} SELECT "
    + ", ".join(f"CASE WHEN {c} = 'null' THEN '' ELSE {c} END AS {c}" for c in MISSING_REPORT_COLUMNS)
    + " FROM features WHERE cd_programa <> 'null'"
    " AND cd_programa NOT IN (SELECT id_pub FROM keyed)"
)


def _read_back(sql, columns):
    """A result written as text: an empty field is a missing value."""
    return f"SELECT {', '.join(f'nullif({c}, {chr(39) * 2}) AS {c}' for c in columns)} FROM ({sql})"


def _survey_rows(columns):
    return f"{with_views('survey_programmes')} SELECT cuaps_folio, {columns} FROM survey_programmes"


BLANK = (
    "[\\s\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}"
    "\\x{205f}\\x{3000}]"
)
DUMMIES = ("der_social_alim", "der_social_edu", "der_social_sal", "der_social_viv")


def statements() -> dict[str, str]:
    """One statement per query whose rows do not depend on the engine."""
    nested_columns = selected(NESTED_FEATURE_COLUMNS, NESTED_LISTS)
    return {
        "trim_text": _survey_rows(
            f"coalesce(regexp_replace(chr_nombre_programa_cuaps, '^{BLANK}+|{BLANK}+$', '', 'g'), '') AS name"
        ),
        "strip_quotes": raw(f"{bare('newid')} AS id", f"{bare('anio')} AS anio"),
        "clean_int": raw(
            *[f"{number(n)} AS {n}" for n in ("anio", "numespago")],
            *[f"{number(n, 'BIGINT')} AS {n}_long" for n in ("newid", "nuimpmonetario")],
        ),
        "age_at_month": aged("age"),
        "age_band": aged(f"{band('age')} AS band", f"{band('age', **OLDER_BAND)} AS older_band"),
        "mask_minor_names": aged(
            *[f"{adult_name(n)} AS {n}" for n in ("nbprimerap", "nbsegundoap", "nbnombre")]
        ),
        "muni_code": raw(f"{municipality('cdmunpago', '(' + state('cdentpago') + ')')} AS cvemunipago"),
        "loc_code": raw(f"{locality('cdlocpago')} AS cvelocpago"),
        "state_code": raw(f"{state('cdentpago')} AS cveentpago"),
        "gender_code": raw(f"{GENDER} AS cdsexo"),
        "origin_code": raw(f"{origin(chr(39) + 'F' + chr(39))} AS origen", f"{origin('NULL')} AS older_origen"),
        "period_month": raw(f"{MONTH} AS mescorresp"),
        "pay_month": raw(f"{paid('(' + MONTH + ')')} AS numespago"),
        "pay_month_own": raw(f"{OWN_MONTH} AS numespago"),
        "benefit_name": raw(f"{BENEFIT} AS benefit", f"{benefit('NULL', 'NULL')} AS older_benefit"),
        "program_type_key": raw(f"{joined('_', 'cdprograma', 'cdpadron', BENEFIT)} AS programatipo"),
        "unified_id": raw(
            joined("-", origin("'F'"), "cddependencia", "cdprograma", "cdpadron", number("anio"))
            + " AS iduni"
        ),
        "pad_state": _survey_rows(f"{padded_state('cve_entidad_federativa')} AS cve_ent"),
        "num_text": (
            f"{with_views('programme_catalogue')} SELECT iduni, {whole('anio')} AS anio,"
            f" {whole('cd_dependencia')} AS cd_dependencia FROM programme_catalogue"
        ),
        "gov_level": _survey_rows(
            "CASE orden_gob WHEN 1 THEN 'FEDERAL' WHEN 2 THEN 'ESTATAL' WHEN 3 THEN 'MUNICIPAL'"
            " ELSE CAST(orden_gob AS VARCHAR) END AS nb_orden_gob"
        ),
        "scrub_text": documents("replace(replace(text, chr(160), ' '), '\"', '')", "scrubbed"),
        "strip_non_ascii": documents(ASCII, "ascii_text"),
        "cp1252_fix": documents(
            "translate(text, 'abcdefghijklmnopqrstuvwxyzA', '€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ')", "repaired"
        ),
        "keyword_field": documents("CASE WHEN length(text) <= 256 THEN text END", "text_keyword"),
        "clean_registry": f"{with_views('raw_registry')}{CLEAN} SELECT * FROM clean",
        "clean_registry_older": (
            f"{with_views('raw_registry')}{OLDER_CLEAN} SELECT newid, categoriaedad, numespago,"
            " origen, nombretipobeneficio, programatipo, iduni, age FROM clean"
        ),
        "geo_dim": f"{with_views('municipalities', 'states')}{GEO} SELECT * FROM geo",
        "enrich_catalog": (
            f"{with_views('raw_registry', 'programme_catalogue')}{CLEAN}{NAMES} SELECT r.newid,"
            " r.iduni, r.file_year, nombresubp1, nombreprograma, nbdependencia, nbdepencorto FROM"
            " clean r LEFT JOIN names n ON r.iduni = n.iduni AND r.file_year = n.file_year"
        ),
        "enrich_geo": (
            f"{with_views('raw_registry', 'municipalities', 'states')}{CLEAN}{GEO} SELECT r.newid,"
            " r.cvemuni, g.cveent, g.noment, r.nommun FROM clean r LEFT JOIN geo g"
            " ON r.cvemuni = g.cvemuni"
        ),
        "amount_rules": raw(f"CASE WHEN {ZERO} THEN 0 ELSE {number('nuimpmonetario', 'BIGINT')} END AS nuimpmonetario"),
        "exclude_rule": raw("cdprograma", "cdbeneficio") + f" WHERE {KEPT}",
        "publication": PUBLICATION,
        "cleaned": f"{ENRICHED} SELECT {', '.join(FULL_COLUMNS)}, anio FROM enriched",
        "monthly_catalog": f"{MONTHLY} SELECT * FROM monthly",
        "bulk_docs": f"{MONTHLY} SELECT {named_action(INDEX, MONTHLY_COLUMNS)}{MONTHLY_DOCUMENT} AS value FROM monthly",
        "read_raw": (
            # An empty field of a text file is a missing value.
            f"{with_views('raw_registry')} SELECT "
            + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_COLUMNS)
            + ", file_year FROM raw_registry"
        ),
        "read_raw_gz": (
            # An empty field of a text file is a missing value.
            f"{with_views('raw_registry')} SELECT "
            + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW_COLUMNS)
            + ", file_year FROM raw_registry"
        ),
        "read_catalog": (
            f"{with_views('programme_catalogue')} SELECT read_by, iduni, cd_programa AS cdprograma,"
            " cd_padron AS cdpadron, anio, nb_programa AS nombreprograma, nb_dependencia AS"
            " nbdependencia, CASE WHEN read_by = 'header' THEN nullif(nb_subp1, '') END AS nombresubp1, nb_depen_corto AS nbdepencorto,"
            " nullif(sector, '') AS sector FROM programme_catalogue,"
            " (VALUES ('position'), ('header')) r(read_by)"
        ),
        "decode_text": (
            f"SELECT value, count(*) AS lines FROM (SELECT unnest(regexp_split_to_array({ASCII},"
            " '\\r\\n|\\r|\\n')) AS value FROM documents) GROUP BY value"
        ),
        "roundtrip_partitioned": PUBLICATION,
        "table_register": (
            f"{ENRICHED} SELECT kind, anio, numespago, count(*) AS rows,"
            " CAST(sum(nuimpmonetario) AS BIGINT) AS amount FROM enriched,"
            " (VALUES ('public'), ('cleaned')) t(kind) GROUP BY kind, anio, numespago"
        ),
        "table_published": (
            f"{ENRICHED} SELECT kind, anio, numespago, count(*) AS rows,"
            " CAST(sum(nuimpmonetario) AS BIGINT) AS amount FROM enriched,"
            " (VALUES ('public'), ('cleaned')) t(kind) GROUP BY kind, anio, numespago"
        ),
        "catalog_refresh": f"{MONTHLY} SELECT * FROM monthly",
        "lookup_figures": (
            with_views("raw_registry", "programme_catalogue", "municipalities", "states") + CLEAN + GEO + NAMES
            + f", kept AS (SELECT * FROM clean WHERE {KEPT}),"
            " met AS (SELECT r.file_year, r.iduni, r.cvemuni, n.file_year IS NOT NULL AS named,"
            " g.cvemuni IS NOT NULL AS placed FROM kept r"
            " LEFT JOIN names n ON r.iduni = n.iduni AND r.file_year = n.file_year"
            " LEFT JOIN geo g ON r.cvemuni = g.cvemuni),"
            " came AS (SELECT file_year, count(*) AS rows_in, count_if(iduni IS NULL) AS no_id,"
            " count_if(cvemuni IS NULL) AS no_place FROM kept GROUP BY file_year),"
            " went AS (SELECT file_year, count(*) AS rows_out,"
            " count_if(iduni IS NOT NULL AND NOT named) AS lone_id,"
            " count_if(cvemuni IS NOT NULL AND NOT placed) AS lone_place FROM met GROUP BY file_year)"
            " SELECT file_year AS anio, lookup, rows_in,"
            " CASE lookup WHEN 'catalogue' THEN no_id ELSE no_place END AS null_keys,"
            " CASE lookup WHEN 'catalogue' THEN lone_id ELSE lone_place END AS unmatched, rows_out"
            " FROM came JOIN went USING (file_year), (VALUES ('catalogue'), ('geography')) t(lookup)"
        ),
        "append_rows": PUBLICATION,
        "stream_ingest": (
            f"SELECT * REPLACE (nbprograma || CASE WHEN anio = {CP1252_YEAR} THEN ' ñ€' ELSE ' ' END"
            f" AS nbprograma) FROM ({PUBLICATION})"
        ),
        "sample_rows": (
            f"{with_views('raw_registry')} SELECT {', '.join(RAW_COLUMNS)} FROM raw_registry"
            " WHERE substr(md5(newid), 1, 8) < '19999999'"
        ),
        "crosswalk": f"{with_views('crosswalk')}{PAIRS} SELECT * FROM pairs",
        "program_keys": (
            f"{with_views('survey_programmes', 'crosswalk')}{KEYED} SELECT * REPLACE"
            f" ({text_of('derechos_sociales')} AS derechos_sociales) FROM keyed"
        ),
        "listed_program_keys": (
            f"{with_views('survey_programmes', 'crosswalk')}{LISTED_KEYED} SELECT * REPLACE"
            f" ({text_of('derechos_sociales')} AS derechos_sociales) FROM keyed"
        ),
        "program_features": (
            f"{with_views(*SURVEY_VIEWS)}{FEATURES} SELECT * REPLACE ("
            + ", ".join(
                f"{text_of(c)} AS {c}" for c in ("derechos_sociales", "criterios_focalizacion", "apoyos")
            )
            + ") FROM surveyed"
        ),
        "focus_groups": (
            f"{with_views('survey_criteria')} SELECT cuaps_folio, coalesce(csc_configuracion_foc, 0)"
            f" AS code, {FOCUS} AS focus FROM survey_criteria"
        ),
        "criterion_rows": (
            f"{with_views('survey_criteria')}{CRITERIA} SELECT cuaps_folio, focus AS"
            " criterios_focalizacion FROM groups"
        ),
        "support_rows": (
            f"{with_views('survey_components')}{COMPONENTS} SELECT * REPLACE ({text_of('tipos')} AS"
            " tipos) FROM components"
        ),
        "register_rows": (
            f"{with_views('programme_catalogue')}, cleaned AS ({clean_catalogue('programme_catalogue')})"
            f" SELECT {', '.join(REGISTER_FIELDS)} FROM cleaned"
        ),
        "nested_supports": (
            f"{with_views('survey_components')}{COMPONENTS} SELECT cuaps_folio,"
            f" {text_of('apoyos')} AS apoyos FROM nested"
        ),
        "nested_registers": (
            f"{with_views('programme_catalogue')}, cleaned AS ({clean_catalogue('programme_catalogue')}),"
            f" grouped AS (SELECT cd_programa, anio, list({REGISTER} ORDER BY"
            f" {', '.join(REGISTER_FIELDS)}) AS padrones FROM cleaned GROUP BY cd_programa, anio)"
            f" SELECT cd_programa, anio, {text_of('padrones')} AS padrones FROM grouped"
        ),
        "flatten_list": (
            f"{with_views('programme_catalogue')}, filled AS (SELECT cd_programa, coalesce(anio, 'null') AS anio,"
            " coalesce(nb_subp1, 'null') AS s FROM programme_catalogue)"
            f" SELECT cd_programa, anio, {text_of('list(s ORDER BY s)')} AS nb_subp1"
            " FROM filled WHERE s <> '' GROUP BY cd_programa, anio"
        ),
        "parse_list": (
            f"{with_views('survey_criteria')}, groups AS (SELECT cuaps_folio, {FOCUS} AS focus"
            " FROM survey_criteria), kept AS (SELECT cuaps_folio, CASE WHEN count(*) > 1 THEN"
            " coalesce(list(focus ORDER BY focus) FILTER (focus <> ''), []) ELSE [] END AS items"
            f" FROM groups GROUP BY cuaps_folio) SELECT cuaps_folio, {text_of('items')} AS items FROM kept"
        ),
        "dummies_to_array": _survey_rows(f"{text_of(RIGHTS)} AS derechos_sociales"),
        "dummy_sums": f"{with_views('survey_components')}{TYPE_SUMS} SELECT * FROM sums",
        "support_types": (
            f"{with_views('survey_components')}{TYPE_SUMS} SELECT cuaps_folio,"
            f" {text_of('tipos_apoyos')} AS tipos_apoyos FROM types"
        ),
        "typed_fill": _survey_rows(
            "orden_gob, coalesce(chr_clave_prespupuestal_pro, 'null') AS chr_clave_prespupuestal_pro,"
            " chr_nombre_programa_cuaps, coalesce(obj_gral_prog, 'null') AS obj_gral_prog,"
            " CAST(coalesce(cve_entidad_federativa, 0) AS BIGINT) AS cve_entidad_federativa,"
            " nom_entidad_federativa, "
            + ", ".join(f"coalesce({d}, 0) AS {d}" for d in DUMMIES)
        ),
        "unpivot": " UNION ALL ".join(
            (with_views("survey_programmes") if d == DUMMIES[0] else "")
            + f" SELECT cuaps_folio, '{d}' AS derecho, {d} AS presente FROM survey_programmes"
            for d in DUMMIES
        ),
        "pivot_back": _survey_rows(", ".join(f"CAST({d} AS BIGINT) AS {d}" for d in DUMMIES)),
        "catalog_latest": (
            f"{with_views('programme_catalogue')}{LATEST} SELECT * FROM latest"
        ),
        "catalog_core": (
            f"{with_views('programme_catalogue')}{LISTED_CORE} SELECT * REPLACE ("
            + ", ".join(f"{text_of(c)} AS {c}" for c in LISTED_FIELDS)
            + ") FROM core"
        ),
        "has_profile": (
            f"{with_views('programme_catalogue', 'profiles')} SELECT iduni, cd_programa, CASE WHEN"
            " cd_programa IN (SELECT cve_programa FROM profiles) THEN 1 ELSE 0 END AS tiene_perfil"
            " FROM programme_catalogue"
        ),
        "catalog_features": f"{NESTED} SELECT {nested_columns} FROM features",
        "feature_docs": (
            f"{NESTED} SELECT {named_action(FEATURE_INDEX, FEATURE_KEYS)}{FEATURE_DOCUMENT} AS value FROM features"
            " WHERE cd_programa <> ''"
        ),
        "catalog_csv": (
            f"{NESTED} SELECT * REPLACE (CAST(tiene_perfil AS VARCHAR) AS tiene_perfil,"
            " nullif(obj_gral_prog, '') AS obj_gral_prog)"
            f" FROM (SELECT {nested_columns} FROM features)"
        ),
        "listed_csv": _read_back(listed_catalogue(2016), LISTED_FEATURE_COLUMNS),
        "missing_csv": _read_back(NOT_SURVEYED, MISSING_REPORT_COLUMNS),
        "catalog_arrays": listed_catalogue(2016),
        "catalog_arrays_split": listed_catalogue(SPLIT_YEAR),
        "missing_in_survey": NOT_SURVEYED,
        "missing_in_catalog": (
            f"{with_views('programme_catalogue', 'survey_programmes', 'crosswalk')}{KEYED}"
            " SELECT id_pub, cuaps_folio, DGAE, DGAIP, chr_nombre_programa_cuaps FROM keyed"
            " WHERE id_pub <> 'null' AND id_pub NOT IN (SELECT coalesce(cd_programa, 'null')"
            " FROM programme_catalogue)"
        ),
    }
