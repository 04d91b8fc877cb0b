"""Code lists and labels that give the published names."""

AGE_LABELS = {
    "infant": "Infante",
    "teen": "Adolescente",
    "young": "Joven",
    "adult": "Adulto",
    "senior": "Adulto Mayor",
}

#: The plural labels of the older registry releases.
AGE_LABELS_PLURAL = {
    "infant": "Infante",
    "teen": "Adolescentes",
    "young": "Jóvenes",
    "adult": "Adultos",
    "senior": "Adulto Mayor",
}

BENEFIT_NAMES = {
    1: "monetario",
    2: "especie",
    3: "servicio",
    4: "mixto",
    5: "subsidiado",
    6: "indirecto",
}
OTHER_BENEFIT = "otro"
NO_BENEFIT = "no_disponible"

GOVERNMENT_LEVELS = {1: "FEDERAL", 2: "ESTATAL", 3: "MUNICIPAL"}

STATE_ABBREVIATIONS = {
    "AGUASCALIENTES": "AGS",
    "JALISCO": "JAL",
    "OAXACA": "OAX",
    "TABASCO": "TAB",
}

#: Budget keys containing this code are shared by many programmes.
SHARED_BUDGET_CODE = "21111"

RIGHTS = {
    "alim": "Alimentación",
    "edu": "Educación",
    "beco": "Bienestar Económico",
    "mam": "Medio Ambiente",
    "nodis": "No Discriminación",
    "sal": "Salud",
    "segsoc": "Seguridad Social",
    "tra": "Trabajo",
    "viv": "Vivienda",
    "ning": "Ninguno",
}
RIGHTS_PREFIX = "der_social_"

SUPPORT_TYPES = {
    "mon": "Monetario",
    "sub": "Subsidio",
    "esp": "Especie",
    "obra": "Obra",
    "serv": "Servicio",
    "cap": "Capacitación",
    "otro": "Otro",
}
SUPPORT_PREFIX = "tipo_apoyo_"

FOCUS_GROUPS = {
    "adultos mayores": [36, 1754, 1755, 1756, 1757],
    "migrantes": [37],
    "embarazadas": [38],
    "jefas de familia": [39],
    "padres o madres solos": [40],
    "enfermos cronicos": [41],
    "personas con discapacidad": [43, 170, 171, 172, 173, 174, 175, 176],
    "poblacion indigena": [42, 167, 168, 169],
    "otro grupo vulnerable": [44],
    "pobreza": [31, 32, 33],
    "vulnerabilidad": [34, 35],
    "marginacion": [134, 135, 136, 137, 138, 139, 140, 141, 142, 143, 144, 145],
}

#: Amounts are zeroed when every (column, raw value) pair of a rule holds.  The last rule
#: asks two values of one column, so it never fires; it is kept as published.
ZERO_AMOUNT_RULES = [
    [("cdprograma", "S072"), ("cdpadron", "S072"), ("cdbeneficio", "60"), ("cdtipobeneficio", "6")],
    [("cdprograma", "S072"), ("cdpadron", "0377"), ("cdbeneficio", "60")],
    [("cdprograma", "S174"), ("cdtipobeneficio", "3")],
    [("cdprograma", "S241"), ("cdbeneficio", "1")],
    [("cdprograma", "S241"), ("cdpadron", "0567"), ("cdpadron", "0568")],
]

#: Programme whose beneficiaries of this benefit are left out.
EXCLUDED_PROGRAMME = "S052"
EXCLUDED_BENEFIT = "60"

#: Survey bookkeeping columns that never reach the features.
SURVEY_BOOKKEEPING = [
    "csc_estatus_cuaps_fk",
    "chr_nombre_programa_cuaps",
    "actualizacion_sedesol",
    "data_date",
]

#: Text that stands for a missing value in the feature catalogues.
MISSING = "null"

DOCUMENT_TYPE = "catalogo"
KEYWORD_LIMIT = 256

#: Document fields with a copy for exact matches.
KEYWORD_FIELDS = [
    "nb_programa", "derechos_sociales", "nb_origen", "nb_subp1", "origen", "criterios_focalizacion",
    "nom_ent",
]
