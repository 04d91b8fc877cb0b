"""Registry, catalogue and survey inputs derived from the given tables.

Every view reads its whole tables.  Where an input needs rows without a partner, their keys are
changed instead of the rows being left out.  SQL without a variant reads the same in Spark and
DuckDB.
"""

from pyspark.sql import DataFrame, SparkSession

from rollcall.operators.nesting import dealt_by
from rollcall.schemas import RAW_COLUMNS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_RAW_EXPRESSIONS = {
    "cddependencia": "CAST(l.l_suppkey AS STRING)",
    "nborigen": "CASE l.l_orderkey % 5 WHEN 0 THEN 'FEDERAL' WHEN 1 THEN 'F' WHEN 2 THEN 'ESTATAL' WHEN 3 THEN 'X' END",
    "idadmin": "CAST(o.o_custkey AS STRING)",
    "cdprograma": "CASE WHEN l.l_partkey % 97 = 0 THEN NULL WHEN l.l_partkey % 5 = 0 THEN 'S072' WHEN l.l_partkey % 5 = 1 THEN 'S174' WHEN l.l_partkey % 5 = 2 THEN 'S241' WHEN l.l_partkey % 5 = 3 THEN 'S052' ELSE 'S176' END",
    "cdpadron": "CASE l.l_linenumber % 4 WHEN 0 THEN 'S072' WHEN 1 THEN '0377' WHEN 2 THEN '0567' ELSE '0568' END",
    "anio": "CASE WHEN l.l_orderkey % 101 = 0 THEN 'x' ELSE '\"' || CAST(year(l.l_shipdate) AS STRING) || '\"' END",
    "tipobeneficiario": "o.o_orderpriority",
    "nbprograma": "'programa ' || CAST(l.l_partkey % 5 AS STRING)",
    "periodo": "CASE WHEN l.l_orderkey % 53 = 0 THEN '17' WHEN l.l_orderkey % 59 = 0 THEN NULL ELSE '17' || substr('0123456789aBcX', CAST(1 + l.l_orderkey % 14 AS INT), 1) || '0' END",
    "nbprimerap": "'AP ' || CAST(o.o_custkey AS STRING)",
    "nbsegundoap": "'AM ' || CAST(o.o_custkey AS STRING)",
    "nbnombre": "'NB ' || CAST(o.o_custkey AS STRING)",
    "fhnacimiento": "CASE WHEN l.l_orderkey % 67 = 0 THEN NULL ELSE CAST(1915 + (o.o_custkey * 7 + l.l_linenumber) % 95 AS STRING) || lpad(CAST(1 + o.o_custkey % 13 AS STRING), 2, '0') || lpad(CAST(1 + l.l_orderkey % 31 AS STRING), 2, '0') END",
    "cdsexo": "CASE l.l_partkey % 6 WHEN 0 THEN 'H' WHEN 1 THEN 'M' WHEN 2 THEN 'MH' WHEN 3 THEN 'h' WHEN 4 THEN 'MUJER' END",
    "cdentpago": "CAST(l.l_orderkey % 41 AS STRING)",
    "cdmunpago": "CAST(l.l_partkey % 1001 AS STRING)",
    "cdlocpago": "CAST((l.l_orderkey * 13) % 10001 AS STRING)",
    "cdtipobeneficio": "CASE WHEN l.l_orderkey % 11 = 10 THEN 'x' ELSE CAST(l.l_orderkey % 9 AS STRING) END",
    "nubeneficios": "CAST(l.l_linenumber AS STRING)",
    "cdbeneficio": "CASE WHEN l.l_orderkey % 71 = 0 THEN NULL WHEN l.l_quantity < 20 THEN '60' WHEN l.l_quantity < 35 THEN '1' ELSE '2' END",
    "nuimpmonetario": "CASE WHEN l.l_partkey % 10 = 0 THEN '12.5' WHEN l.l_partkey % 10 = 1 THEN ' 7 ' WHEN l.l_partkey % 10 = 2 THEN '' WHEN l.l_partkey % 10 = 3 THEN '3000000000' ELSE CAST(CAST(l.l_quantity AS INT) * 100 AS STRING) END",
    "numespago": "CASE WHEN l.l_orderkey % 17 = 16 THEN 'n/d' ELSE CAST(l.l_orderkey % 16 AS STRING) END",
    "cveloc": "CAST((l.l_orderkey * 3) % 10001 AS STRING)",
    "nommun": "'muni raw ' || CAST(l.l_partkey % 20 AS STRING)",
    "cvemun": "CAST(l.l_partkey % 20 AS STRING)",
    "noment": "'edo raw'",
    "cveent": "CAST(o.o_custkey % 34 AS STRING)",
    "newid": "'\"' || CAST(l.l_orderkey * 10 + l.l_linenumber AS STRING) || '\"'",
}

# Every thirteenth order is delivered a year late.
RAW_REGISTRY = (
    "SELECT "
    + ", ".join(
        f"{_RAW_EXPRESSIONS.get(c, 'CAST(NULL AS STRING)')} AS {c}" for c in RAW_COLUMNS
    )
    + ", CAST(year(l.l_shipdate) + CASE WHEN l.l_orderkey % 13 = 0 THEN 1 ELSE 0 END AS INT) AS file_year"
    " FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey"
)

MUNICIPALITIES = """
SELECT DISTINCT lpad(CAST(1 + c_custkey % 27 AS STRING), 2, '0') AS CVE_ENT,
  lpad(CAST(1 + c_custkey % 27 AS STRING), 2, '0') || lpad(CAST(c_custkey % 16 AS STRING), 3, '0') AS CVEGEO,
  'M ' || CAST(c_custkey % 16 AS STRING) || ' of ' || CAST(1 + c_custkey % 27 AS STRING) AS NOMGEO
FROM {customer}"""

STATES = """
SELECT lpad(CAST(n_nationkey + 1 AS STRING), 2, '0') AS CVE_ENT, n_name AS NOM_ENT FROM {nation}"""

# One row per supplier, origin, programme, register and year; every seventh supplier's agency
# is one that no registry row names.  Every fifth supplier's ids of 1998 recur in 1999, every
# sixth's 1997 rows of one register come twice, every eleventh's 2000 rows have no year.
_CATALOGUE_SELECT = """
SELECT origen || '-' || dep || '-' || prog || '-' || padron || '-' || CAST(CASE WHEN yr = 1999 AND s_suppkey % 5 = 0 THEN 1998 ELSE yr END AS STRING) AS iduni,
  dep AS cd_dependencia, prog AS cd_programa, padron AS cd_padron,
  CASE WHEN yr = 2000 AND s_suppkey % 11 = 5 THEN NULL ELSE CAST(yr AS STRING) || '.0' END AS anio,
  CASE WHEN origen = 'F' THEN 'FEDERAL' ELSE 'ESTATAL' END AS nb_origen, origen,
  'Programa ' || prog AS nb_programa, CASE WHEN again = 1 THEN '' ELSE 'Sub "' || padron || '"' END AS nb_subp1,
  origen || dep AS origen_dep, s_name AS nb_dependencia, 'D' || dep AS nb_depen_corto,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL WHEN s_suppkey % 4 = 1 AND yr % 2 = 0 THEN '' ELSE 'sector ' || CAST(s_suppkey % 4 AS STRING) END AS sector
FROM ("""
_AGENCY = "CASE WHEN s_suppkey % 7 = 3 THEN '-' ELSE '' END || CAST(s_suppkey AS STRING) AS dep"
_ONCE = " WHERE again = 0 OR s_suppkey % 6 = 0 AND yr = 1997 AND padron = '0377'"
CATALOGUE_SPARK = (
    _CATALOGUE_SELECT
    + f"SELECT s_suppkey, s_name, {_AGENCY}, origen, prog, padron, yr, again FROM {{supplier}}"
    " LATERAL VIEW explode(array('F', 'E')) o AS origen"
    " LATERAL VIEW explode(array('S072', 'S174', 'S241', 'S052')) g AS prog"
    " LATERAL VIEW explode(array('0377', '0567', 'S072')) d AS padron"
    " LATERAL VIEW explode(sequence(1995, 2001)) y AS yr"
    " LATERAL VIEW explode(array(0, 1)) a AS again" + _ONCE + ")"
)
CATALOGUE_DUCKDB = (
    _CATALOGUE_SELECT
    + f"SELECT s_suppkey, s_name, {_AGENCY}, origen, prog, padron, yr, again FROM {{supplier}},"
    " (VALUES ('F'), ('E')) o(origen), (VALUES ('S072'), ('S174'), ('S241'), ('S052')) g(prog),"
    " (VALUES ('0377'), ('0567'), ('S072')) d(padron), range(1995, 2002) y(yr), (VALUES (0), (1)) a(again)" + _ONCE + ") x"
)

SURVEY_PROGRAMMES = """
SELECT CAST(p_partkey AS STRING) || '-F' AS cuaps_folio, 1 + p_size % 3 AS orden_gob,
  CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 1 THEN '21111-' || CAST(p_partkey AS STRING) WHEN p_partkey % 9 = 2 THEN 'S072' ELSE 'JALISCO' || CAST(p_partkey AS STRING) END AS chr_clave_prespupuestal_pro,
  '  ' || p_name || ' ' AS chr_nombre_programa_cuaps, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'obj "' || p_type || '"' END AS obj_gral_prog,
  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_size % 33 END AS cve_entidad_federativa, ' ' || p_brand || ' ' AS nom_entidad_federativa,
  p_partkey % 2 AS der_social_alim, p_size % 2 AS der_social_edu, p_partkey % 3 AS der_social_sal, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 0 END AS der_social_viv
FROM {part}"""

CROSSWALK = """
SELECT CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 13 < 5 THEN 'S174' ELSE 'S241' END AS DGAIP,
  CASE WHEN p_partkey % 2 = 0 THEN 'JAL' ELSE 'AGS' END || CAST(p_partkey AS STRING) AS DGAE FROM {part}
UNION ALL SELECT 'S052' AS DGAIP, CAST(NULL AS STRING) AS DGAE FROM {region}"""

SURVEY_CRITERIA = """
SELECT DISTINCT CAST(l_partkey AS STRING) || CASE WHEN l_partkey % 5 = 0 THEN '-G' ELSE '-F' END AS cuaps_folio,
  CASE WHEN l_suppkey % 8 = 0 THEN NULL ELSE 30 + l_suppkey % 16 END AS csc_configuracion_foc
FROM {lineitem}"""

SURVEY_COMPONENTS = """
SELECT CAST(l_partkey AS STRING) || CASE WHEN l_partkey % 4 = 1 THEN '-G' ELSE '-F' END AS cuaps_folio,
  l_suppkey AS id_componente, l_linenumber AS id_apoyo, max(CASE WHEN l_quantity > 40 THEN 'apoyo "x"' END) AS nombre_apoyo,
  max(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS tipo_apoyo_mon, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS tipo_apoyo_esp, max(CASE WHEN l_discount > 0.09 THEN 1 END) AS tipo_apoyo_otro
FROM {lineitem} GROUP BY l_partkey, l_suppkey, l_linenumber"""

PROFILES = """
SELECT CASE p_size % 7 WHEN 0 THEN 'S072' WHEN 1 THEN 'S241' WHEN 2 THEN NULL ELSE p_brand END AS cve_programa
FROM {part}"""

SPARK_VIEWS = {
    "raw_registry": RAW_REGISTRY,
    "municipalities": MUNICIPALITIES,
    "states": STATES,
    "programme_catalogue": CATALOGUE_SPARK,
    "survey_programmes": SURVEY_PROGRAMMES,
    "crosswalk": CROSSWALK,
    "survey_criteria": SURVEY_CRITERIA,
    "survey_components": SURVEY_COMPONENTS,
    "profiles": PROFILES,
}
#: The given tables each view reads.
SOURCES = {
    "raw_registry": ["lineitem", "orders"],
    "municipalities": ["customer"],
    "states": ["nation"],
    "programme_catalogue": ["supplier"],
    "survey_programmes": ["part"],
    "crosswalk": ["part", "region"],
    "survey_criteria": ["lineitem"],
    "survey_components": ["lineitem"],
    "profiles": ["part"],
}
#: Rows a task takes of the tables of a view that explodes them: a file of some kilobytes would
#: be one task, which makes millions of rows.
EXPLODED_ROWS = {"programme_catalogue": 500}
#: Columns by which a view groups all its rows: they are dealt by them first (``dealt_by``).
GROUPED_BY = {"survey_components": ["l_partkey", "l_suppkey", "l_linenumber"]}
DUCKDB_VIEWS = {
    name: sql.format(**{t: t for t in SOURCES[name]})
    for name, sql in {**SPARK_VIEWS, "programme_catalogue": CATALOGUE_DUCKDB}.items()
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def footer_rows(df: DataFrame) -> int:
    """Rows of a given table by the footers of its files, which hold its schema too: no job runs."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    rows = 0
    for name in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
        rows += reader.getRecordCount()
        reader.close()
    return rows


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """A small given table dealt over tasks of about ``rows`` rows, whatever its files are."""
    return df.repartition(max(1, -(-footer_rows(df) // rows)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input, over the tables in ``sf_dir``; the session gets no views."""
    tables = {t: table(spark, sf_dir, t) for t in SOURCES[name]}
    if name in EXPLODED_ROWS:
        tables = {t: dealt(df, EXPLODED_ROWS[name]) for t, df in tables.items()}
    if name in GROUPED_BY:
        tables = {t: dealt_by(df, *GROUPED_BY[name]) for t, df in tables.items()}
    return spark.sql(SPARK_VIEWS[name], **tables)


def with_views(*names: str) -> str:
    """The inputs as leading common table expressions of a DuckDB statement."""
    return "WITH " + ", ".join(f"{n} AS ({DUCKDB_VIEWS[n]})" for n in names)
