"""Plans, files, tables, the stream, and every registered query against its SQL."""

import gzip
import os
import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from rollcall.functions.encoding import strip_non_ascii
from rollcall.plans import catalogues, registry
from rollcall.plans.monthly import monthly_catalog
from rollcall.schemas import (
    FULL_COLUMNS,
    NESTED_FEATURE_COLUMNS,
    FULL_SCHEMA,
    PUBLIC_COLUMNS,
    PUBLIC_SCHEMA,
    RAW_COLUMNS,
    RAW_SCHEMA,
)
from rollcall.sinks.tables import published, register_table, write_partitioned
from rollcall.sinks.text import as_text, write_documents, write_pipe_csv
from rollcall.sources import files
from rollcall.sources.files import (
    decode_lines,
    read_named,
    read_registry,
    repair_text,
    sample_rows,
)
from rollcall.streaming.arrivals import ingest_arrivals
from tests.compare import difference, duckdb_tables
from workload.deliveries import OPEN_YEARS, write_deliveries
from workload.oracles import statements
from workload.queries import OLDER, registered
from workload.views import view

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def con():
    return duckdb_tables(SF)


def test_column_lists():
    assert (len(RAW_COLUMNS), len(FULL_COLUMNS), len(PUBLIC_COLUMNS)) == (51, 59, 31)
    assert set(PUBLIC_COLUMNS) < set(FULL_COLUMNS)
    assert len(NESTED_FEATURE_COLUMNS) == 18


@pytest.mark.parametrize("name", sorted(statements()))
def test_query_equals_its_sql(spark, con, name):
    assert difference(registered()[name](spark, SF), con, statements()[name]) is None


def test_every_query_has_sql():
    assert set(registered()) == set(statements())
    assert set(registered()) <= set(queries()) and set(statements()) <= set(oracle_sql())


def test_sample(spark):
    rows = view(spark, SF, "raw_registry")
    assert sample_rows(rows, "newid") is rows
    first, again = (queries()["sample_rows"](spark, SF).count() for _ in range(2))
    assert first == again and 0.05 < first / rows.count() < 0.15


@pytest.mark.parametrize("name", ["nested_registers", "nested_supports", "program_features"])
def test_nothing_runs_before_the_action(spark, name, monkeypatch):
    """Planning runs no job but the reading of the files' schemas."""

    def refuse(*_, **__):
        raise AssertionError("an action while planning")

    inputs = [view(spark, SF, v) for v in ("programme_catalogue", "survey_components")]
    for method in ("count", "collect", "first", "take", "isEmpty", "toPandas"):
        monkeypatch.setattr(type(inputs[0]), method, refuse)
    assert queries()[name](spark, SF).columns


@pytest.mark.parametrize("name", ["catalog_features", "feature_docs", "missing_in_survey"])
def test_facts_are_scanned_once(spark, name):
    text = plan(queries()[name](spark, SF))
    assert text.count("lineitem") <= 1


def test_queries_leave_the_session_alone(spark):
    before, tables = dict(spark.conf.getAll), {t.name for t in spark.catalog.listTables()}
    for name in ("publication", "table_register"):
        queries()[name](spark, SF)
    assert dict(spark.conf.getAll) == before
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_entry(spark):
    assert entry(spark).columns == [*PUBLIC_COLUMNS, "anio"]


@pytest.mark.parametrize("name", ["publication", "monthly_catalog", "catalog_features", "catalog_arrays"])
def test_no_python_in_plans(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "EvalPython" not in text and "InPandas" not in text and "CartesianProduct" not in text


def test_dimensions_are_broadcast_and_the_filter_is_below_the_joins(spark):
    lines = plan(queries()["publication"](spark, SF)).split("\n")
    joins = [i for i, line in enumerate(lines) if "BroadcastHashJoin" in line and "LeftOuter" in line]
    exclusion = [i for i, line in enumerate(lines) if "Filter" in line and "l_partkey" in line]
    assert len(joins) >= 2 and exclusion and min(exclusion) > joins[1]


def test_catalogue_of_one_small_file_is_made_by_many_tasks(spark, tmp_path):
    suppliers = spark.range(1, 1201, 1, 1).selectExpr("CAST(id AS INT) AS s_suppkey", "'S' AS s_name")
    suppliers.write.parquet(f"{tmp_path}/supplier.parquet")
    rows = view(spark, str(tmp_path), "programme_catalogue")
    assert rows.rdd.getNumPartitions() == 3
    # 2 origins, 4 programmes, 3 registers, 7 years; each sixth supplier has 8 rows more.
    assert rows.count() == 1200 * 168 + 200 * 8


def test_lists_are_written_out_once_for_all_surveyed_programmes(spark):
    """Not once for each, above the join; and files of large lists hold one list only."""
    assert "to_json" not in plan(queries()["catalog_arrays"](spark, SF))
    names = ("programme_catalogue", "survey_programmes", "crosswalk", "survey_components")
    tables = [view(spark, SF, name) for name in names]

    def listed(**options):
        return catalogues.listed_catalogue(*tables, **options)

    dealt = listed(text=True, max_bytes=5_000).withColumn("task", F.spark_partition_id())
    plain = as_text(listed())
    assert sorted(map(repr, dealt.drop("task").collect())) == sorted(map(repr, plain.collect()))
    tasks = dealt.where("cuaps_folio <> 'null' AND iduni <> '[]'").groupBy("task")
    assert tasks.agg(F.count_distinct("iduni").alias("n")).agg(F.max("n")).first()[0] == 1


def test_listed_csv_takes_a_fraction_of_its_text_on_disk(spark, tmp_path):
    """A programme's lists are in the file once for each surveyed programme that has them."""
    tables = {
        "supplier": ["CAST(id AS INT) AS s_suppkey", "'S ' || id AS s_name"],
        "part": [
            "id AS p_partkey", "CAST(id AS INT) AS p_size", "'p' AS p_name", "'t' AS p_type",
            "'b' AS p_brand",
        ],
        "lineitem": [
            "id AS l_partkey", "id AS l_suppkey", "1 AS l_linenumber", "30.0 AS l_quantity",
            "'R' AS l_returnflag", "0.0 AS l_discount",
        ],
        "region": ["id AS r_regionkey"],
    }
    for name, columns in tables.items():
        rows = spark.range(1, 601, 1, 1).selectExpr(*columns)
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    plain = f"{tmp_path}/plain"
    write_pipe_csv(queries()["catalog_arrays"](spark, str(tmp_path)), plain)
    read = queries()["listed_csv"](spark, str(tmp_path))
    assert sorted(map(repr, read.collect())) == sorted(map(repr, read_named(spark, plain).collect()))
    written = os.path.dirname(read.inputFiles()[0].removeprefix("file://"))
    text, disk = (
        sum(os.path.getsize(os.path.join(d, f)) for f in os.listdir(d) if f.startswith("part-"))
        for d in (plain, written)
    )
    assert text > 1_000_000 and disk * 5 < text


def test_deliveries_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    name, plain, seen = "spark.sql.maxConcurrentOutputFileWriters", DataFrameWriter.csv, []

    def csv(writer, *args, **options):
        seen.append(int(spark.conf.get(name)))
        plain(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "csv", csv)
    empty = [F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS if c != "newid"]
    rows = spark.range(0, 900, 1, 2).select(
        F.col("id").cast("string").alias("newid"), *empty, (F.col("id") % 9 + 1992).cast("int").alias("file_year")
    )
    before = spark.conf.get(name, None)
    read = read_registry(spark, write_deliveries(rows, str(tmp_path / "years")))
    assert seen == [OPEN_YEARS] and OPEN_YEARS > 9 and spark.conf.get(name, None) == before
    assert sorted((int(r.newid), r.file_year) for r in read.collect()) == [(i, i % 9 + 1992) for i in range(900)]


def test_monthly_scan_is_pruned(spark, tmp_path):
    root = str(tmp_path / "public")
    write_partitioned(queries()["publication"](spark, SF), root, ["anio", "numespago"])
    one_month = monthly_catalog(spark.read.parquet(root)).where("anio = 1996 and numespago = 3")
    text = plan(one_month)
    schema = text[text.index("ReadSchema") :].split("\n")[0]
    assert "nbnombre" not in schema and "cdprograma" in schema
    assert "anio" in text[text.index("PartitionFilters") :].split("PushedFilters")[0]


def test_editions(spark):
    rows = queries()["clean_registry_older"](spark, SF)
    assert rows.where("origen is null").count() > 0
    assert OLDER.own_month


def registry_lines(rows):
    def line(cells):
        return "|".join(cells.get(c, "") for c in RAW_COLUMNS)

    return "\n".join(["|".join(RAW_COLUMNS), *map(line, rows)]) + "\n"


ROW = {
    "cddependencia": "3", "nborigen": "FEDERAL", "cdprograma": "S072", "cdpadron": "0377",
    "periodo": "173", "numespago": "5", "cdbeneficio": "1", "nuimpmonetario": "100",
    "cvemun": "7", "cveent": "9", "nbnombre": "Ana", "fhnacimiento": "19700101",
}


def test_file_reading_and_repair(spark, tmp_path):
    path = tmp_path / "2020-01" / "registry_2015.txt"
    path.parent.mkdir()
    text = registry_lines([{**ROW, "anio": "2015", "nbnombre": "“Peña” €"}])
    path.write_bytes(text.replace("“", "").replace("”", "").encode("cp1252"))
    raw = read_registry(spark, str(path), encoding="ISO-8859-1")
    row = repair_text(raw, 2015, ["nbnombre"]).first()
    assert (row.nbnombre, row.file_year, row.idadmin) == ("Peña €", 2015, None)
    assert repair_text(raw, 2016, ["nbnombre"]).first().nbnombre == "Pea "
    lines = decode_lines(spark, str(path), 2015).collect()
    assert len(lines) == 2 and any("Peña €" in r.value for r in lines)


def deliver(folder, name, rows, stamp, encoding="latin-1"):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    data = registry_lines(rows).encode(encoding)
    path.write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
    os.utime(path, (stamp, stamp))


@pytest.fixture
def ingest(spark, tmp_path):
    """Run the stream over the inbox; the published public rows."""
    dims = [view(spark, SF, n) for n in ("programme_catalogue", "municipalities", "states")]
    folders = [str(tmp_path / n) for n in ("inbox", "full", "public", "progress")]

    def run():
        ingest_arrivals(spark, *folders, *dims).awaitTermination()
        table = published(spark, folders[2], folders[2], PUBLIC_SCHEMA)
        full = published(spark, folders[1], folders[2], FULL_SCHEMA)
        assert full.count() == table.count()
        return sorted(
            tuple(r) for r in table.select("anio", "numespago", "newid", "nbprograma").collect()
        )

    return run


def test_stream_replaces_years_and_repeats_nothing(ingest, tmp_path):
    inbox = tmp_path / "inbox"
    first = [{**ROW, "anio": "2011", "newid": str(i), "periodo": f"17{i}", "nbprograma": "Ana"} for i in (1, 2)]
    deliver(inbox / "a", "registry_2011.txt", first, 1_600_000_000)
    deliver(inbox / "a", "registry_2012.txt", [{**ROW, "anio": "2012", "newid": "9"}], 1_600_000_100)
    expected = [(2011, 1, 1, "Ana"), (2011, 2, 2, "Ana"), (2012, 3, 9, None)]
    assert ingest() == expected
    assert ingest() == expected
    # A later delivery of 2011 lacks a month, which then disappears; 2012 stays.
    deliver(inbox / "2020-b", "registry_2011.txt", first[1:], 1_600_000_200)
    assert ingest() == expected[1:]


def test_stream_takes_all_files_of_a_delivery(ingest, tmp_path):
    folder = tmp_path / "inbox" / "file_year=2011"
    row = {**ROW, "anio": "2011", "periodo": "171"}
    deliver(folder, "part-1.csv", [{**row, "newid": "1"}], 1_600_000_000)
    deliver(folder, "part-2.txt.gz", [{**row, "newid": "1000000000000000000"}], 1_600_000_001)
    assert [r[2] for r in ingest()] == [1, 10**18]
    # A part that comes later completes the delivery.
    deliver(folder, "part-3.csv", [{**row, "newid": "3"}], 1_600_000_002)
    assert [r[2] for r in ingest()] == [1, 3, 10**18]


def test_stream_repairs_text(ingest, tmp_path):
    row = {**ROW, "newid": "1", "periodo": "171"}
    deliver(tmp_path / "inbox", "registry_2011.txt", [{**row, "anio": "2011", "nbprograma": "Peña"}], 1_600_000_000)
    deliver(
        tmp_path / "inbox", "registry_2015.txt", [{**row, "anio": "2015", "nbprograma": "Peña €"}], 1_600_000_000, "cp1252"
    )
    assert [r[3] for r in ingest()] == ["Pea", "Peña €"]


def test_stream_refuses_empty_deliveries(ingest, tmp_path):
    inbox = tmp_path / "inbox"
    deliver(inbox / "a", "registry_2011.txt", [{**ROW, "anio": "2011", "newid": "1"}], 1_600_000_000)
    expected = ingest()
    assert len(expected) == 1
    deliver(inbox / "b", "registry_2011.txt", [], 1_600_000_100)
    with pytest.raises(Exception, match="have no row"):
        ingest()
    # What was published stays; once the delivery is complete the stream goes on.
    deliver(inbox / "b", "registry_2011.txt", [{**ROW, "anio": "2011", "newid": "2"}], 1_600_000_200)
    assert [r[2] for r in ingest()] == [2]


def test_missing_month_and_table_registration(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2011, 3), (2, 2011, None), (3, 2012, 3)], "newid int, anio int, numespago int")
    write_partitioned(df, root, ["anio", "numespago"])
    assert "numespago=__HIVE_DEFAULT_PARTITION__" in os.listdir(f"{root}/anio=2011")
    table = register_table(spark, "registered_months", df.schema, root)
    assert table.where("numespago is null").first().newid == 2
    assert table.count() == 3
    spark.sql("DROP TABLE registered_months")


def test_append_adds_and_overwrite_replaces(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 3), (2, 4)], "newid int, numespago int")
    for mode, count in (("overwrite", 2), ("append", 4), ("overwrite", 2)):
        write_partitioned(df, root, ["numespago"], mode=mode)
        assert spark.read.parquet(root).count() == count


def test_documents_are_line_pairs(spark, tmp_path):
    path = str(tmp_path / "docs")
    lines = queries()["bulk_docs"](spark, SF)
    write_documents(lines, path)
    assert spark.read.text(path).count() == 2 * lines.count()


def test_cleaning_is_compiled(spark):
    """No method of the cleaning step is larger than the JVM compiles."""
    raw = spark.createDataFrame([(None,) * len(RAW_COLUMNS)], RAW_SCHEMA).withColumn("file_year", F.lit(2016))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = registry.clean_registry(raw)._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert sizes and max(sizes) <= 8000


def method_sizes(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    return [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", plan)]


def test_repairing_is_compiled(spark, tmp_path):
    """Nor any of the repair of a delivery, which keeps missing values."""
    text = "|".join(RAW_COLUMNS) + "\n" + "|".join("" if c == "periodo" else f"{c} ñ" for c in RAW_COLUMNS) + "\n"
    (tmp_path / "registry_2016.txt").write_bytes(text.encode("latin-1"))
    raw = files.read_registry(spark, str(tmp_path / "registry_2016.txt"), files.ORIGINAL)
    found = files.repaired(raw, strip_non_ascii)
    sizes = method_sizes(spark, found)
    assert not sizes or max(sizes) <= 8000
    row = found.first()
    assert all(row[c] == (None if c == "periodo" else f"{c} ") for c in RAW_COLUMNS)
