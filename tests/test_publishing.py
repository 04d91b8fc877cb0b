"""Published years: versions, their log, external tables, the kept catalogue, files and documents."""

import gzip
import json
import os
import stat
import threading
import time
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from __spark_entry__ import queries
from rollcall.plans import monthly, registry
from rollcall.schemas import FULL_COLUMNS, FULL_SCHEMA, PUBLIC_SCHEMA, RAW_COLUMNS
from rollcall.scratch import materialised
from rollcall.sinks import tables
from rollcall.sinks.text import write_documents
from rollcall.sources.files import read_registry, split_compressed
from rollcall.streaming.arrivals import ingest_arrivals
from workload.views import view

SF = "/root/testdata/sf0.001"


def full_rows(spark, cells):
    """Full rows of ``(anio, numespago, newid)``."""
    df = spark.createDataFrame(cells, "anio int, numespago int, newid long")
    types = {f.name: f.dataType for f in FULL_SCHEMA}
    return df.withColumns({n: F.lit(None).cast(t) for n, t in types.items() if n not in df.columns}).select(
        *FULL_COLUMNS, "anio"
    )


@pytest.fixture
def roots(tmp_path):
    return [str(tmp_path / n) for n in ("full", "public")]


def publish(spark, roots, cells, years=None):
    return tables.publish_years(full_rows(spark, cells), *roots, years or sorted({c[0] for c in cells}))


def current(spark, roots, schema=PUBLIC_SCHEMA, root=1):
    df = tables.published(spark, roots[root], roots[1], schema)
    return sorted((r.anio, r.numespago or 0, r.newid) for r in df.select("anio", "numespago", "newid").collect())


def test_reading_writes_nothing(spark, roots):
    assert current(spark, roots) == [] and tables.current_versions(spark, roots[1]) == {}
    assert not os.path.exists(roots[1])
    publish(spark, roots, [(2011, 1, 1)])
    before = sorted(map(str, Path(roots[1]).rglob("*")))
    for folder in [Path(roots[1]), *Path(roots[1]).rglob("*")]:
        if folder.is_dir():
            folder.chmod(stat.S_IRUSR | stat.S_IXUSR)
    try:
        assert current(spark, roots) == [(2011, 1, 1)]
        assert sorted(map(str, Path(roots[1]).rglob("*"))) == before
    finally:
        for folder in [Path(roots[1]), *Path(roots[1]).rglob("*")]:
            if folder.is_dir():
                folder.chmod(0o755)


def test_two_writers_share_nothing(spark, roots):
    publish(spark, roots, [(2011, 1, 0), (2012, 1, 0)])
    ready, found, failed = threading.Barrier(2), [], []

    def write(newid):
        try:
            # Both take their version before either is published.
            df = full_rows(spark, [(2011, 1, newid), (2012, 2, newid), (2010 + 3 * newid, 1, newid)])
            found.append(tables.publish_years(df, *roots, [2011, 2012, 2010 + 3 * newid], lambda: ready.wait(120)))
        except Exception as error:  # noqa: BLE001 - reported below
            failed.append(str(error)[:3000])

    threads = [threading.Thread(target=write, args=(i,)) for i in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and len(set(found)) == 2 and len({v.split("-")[0] for v in found}) == 1
    winner = 1 if tables.current_versions(spark, roots[1])[2013] == max(found) else 2
    want = [(2011, 1, winner), (2012, 2, winner), (2013, 1, 1), (2016, 1, 2)]
    assert current(spark, roots) == current(spark, roots, FULL_SCHEMA, 0) == want


def test_tidy_leaves_running_readers_alone(spark, roots):
    first = publish(spark, roots, [(2011, 1, 1), (2012, 1, 1)])
    reader = tables.published(spark, roots[1], roots[1], PUBLIC_SCHEMA)
    second = publish(spark, roots, [(2011, 1, 2)])
    # The reader began before 2011 was replaced: within the time it keeps its files.
    assert tables.tidy(spark, roots, roots[1]) == []
    assert sorted(r.newid for r in reader.collect()) == [1, 1]
    orphan = Path(roots[0]) / "data" / "version=0000000009-lost" / "anio=2011"
    orphan.mkdir(parents=True)
    time.sleep(1.1)
    gone = tables.tidy(spark, roots, roots[1], keep_seconds=1)
    assert sorted(p.split("/data/")[1] for p in gone) == sorted(
        ["version=0000000009-lost", *[f"version={first}/anio=2011"] * 2]
    )
    assert current(spark, roots) == current(spark, roots, FULL_SCHEMA, 0) == [(2011, 1, 2), (2012, 1, 1)]
    # The log is one file now; the next version still comes behind all others.
    assert len(list(Path(roots[1], "_log").rglob("*.parquet"))) == 1
    assert publish(spark, roots, [(2012, 1, 3)]).split("-")[0] > second.split("-")[0]
    assert current(spark, roots) == [(2011, 1, 2), (2012, 1, 3)]


def test_external_table_follows_versions(spark, roots):
    publish(spark, roots, [(2011, 1, 1), (2011, 2, 2), (2012, 1, 3), (2012, None, 4)])
    table = tables.register_published(spark, "followed", PUBLIC_SCHEMA, roots[1], roots[1])

    def months():
        rows = spark.table("followed").select("anio", "numespago", "newid").collect()
        return sorted((r.anio, r.numespago or 0, r.newid) for r in rows)

    try:
        assert table.count() == 4 and months() == current(spark, roots)
        # A month goes, one comes, one moves.
        publish(spark, roots, [(2011, 2, 20), (2011, 3, 30)])
        tables.refresh_published(spark, "followed", roots[1], roots[1], [2011])
        assert months() == current(spark, roots) == [(2011, 2, 20), (2011, 3, 30), (2012, 0, 4), (2012, 1, 3)]
        publish(spark, roots, [(2012, 5, 5)])
        tables.refresh_published(spark, "followed", roots[1], roots[1])
        assert months() == current(spark, roots)
    finally:
        spark.sql("DROP TABLE followed")
    assert current(spark, roots) == [(2011, 2, 20), (2011, 3, 30), (2012, 5, 5)]


def test_catalogue_reads_changed_years_only(spark, roots, tmp_path, monkeypatch):
    root = str(tmp_path / "catalogue")
    publish(spark, roots, [(2011, 1, 1), (2011, 1, 2), (2012, 1, 3)])
    monthly.refresh_catalog(spark, roots[1], root, [2011, 2012])
    publish(spark, roots, [(2012, 2, 3), (2012, None, 9)])
    read = []
    plain = monthly.monthly_catalog
    monkeypatch.setattr(monthly, "monthly_catalog", lambda df: read.append(df) or plain(df))
    monthly.refresh_catalog(spark, roots[1], root, [2012])
    assert read and all("anio=2012" in name for name in read[0].inputFiles())
    public = tables.published(spark, roots[1], roots[1], PUBLIC_SCHEMA)
    want = sorted(map(repr, plain(public).collect()))
    assert sorted(map(repr, monthly.kept_catalog(spark, root).collect())) == want and len(want) == 3


def test_files_are_bounded_without_a_shuffle(spark, tmp_path):
    df = spark.range(0, 2000, 1, 60).selectExpr("id AS newid", "cast(id % 2 + 2011 as int) AS anio", "cast(id % 3 as int) AS numespago")
    counts = {}
    for name, size in (("split", None), ("packed", 100 << 20)):
        root = tmp_path / name
        tables.write_partitioned(df, str(root), ["anio", "numespago"], input_bytes=size, task_bytes=10 << 20)
        counts[name] = max(len(list(m.glob("*.parquet"))) for m in root.glob("anio=*/numespago=*"))
        assert spark.read.parquet(str(root)).count() == 2000
    assert counts["split"] == 60 and counts["packed"] <= 10
    packed = df.coalesce(10)
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()


def test_public_table_is_written_without_a_shuffle(spark, roots, monkeypatch):
    """Its files are bounded however many the full table has; no row moves."""
    plans, parquet = [], DataFrameWriter.parquet

    def seen(self, path, *args, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return parquet(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    cells = [(2011 + i % 2, i % 3 or None, i) for i in range(600)]
    tables.write_years(full_rows(spark, cells).repartition(30).sortWithinPartitions("newid"), *roots)
    assert len(plans) == 2 and "Exchange" not in plans[1]
    files = [[len(list(m.glob("*.parquet"))) for m in Path(r).glob("anio=*/numespago=*")] for r in roots]
    assert max(files[0]) > 4 >= max(files[1]) and len(files[1]) == 6
    public = spark.read.parquet(roots[1])
    assert sorted((r.anio, r.numespago, r.newid) for r in public.fillna(0, ["numespago"]).collect()) == sorted(
        (y, m or 0, i) for y, m, i in cells
    )


def test_compressed_deliveries_are_cleaned_by_many_tasks(spark, tmp_path):
    lines = ["|".join(RAW_COLUMNS)] + ["|".join(str(i) if c == "newid" else "x" for c in RAW_COLUMNS) for i in range(5000)]
    folder = tmp_path / "file_year=2011"
    folder.mkdir()
    (folder / "part.csv.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    raw = read_registry(spark, str(folder))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        split = split_compressed(raw, 500)
        cleaned = registry.clean_registry(split)
        assert raw.rdd.getNumPartitions() == 1 and cleaned.rdd.getNumPartitions() >= 4
        assert sorted(int(r.newid) for r in split.collect()) == list(range(5000))
        assert {r.file_year for r in split.select("file_year").distinct().collect()} == {2011}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_figures_need_no_job_of_their_own(spark, roots):
    dims = [view(spark, SF, n) for n in ("programme_catalogue", "municipalities", "states")]
    raw = view(spark, SF, "raw_registry")
    years = [r.file_year for r in raw.select("file_year").distinct().collect()]
    figures = registry.LookupFigures(years)
    once = [dims[0].dropDuplicates(["iduni", "anio"]), dims[1].dropDuplicates(["CVEGEO"]), dims[2].dropDuplicates(["CVE_ENT"])]
    full = registry.with_partition_year(registry.enriched_registry(raw, *once, figures=figures), FULL_COLUMNS)
    tables.publish_years(full, *roots, years, figures.assert_unique)
    got = {(r[0], r[1]): r for r in figures.rows()}
    assert len(got) == 2 * len(years) and sum(r[2] for r in got.values()) == 2 * full.count()
    assert any(r[4] for r in got.values())
    # A dimension that repeats a key is refused before anything is visible.
    twice = [once[0].union(once[0]), *once[1:]]
    figures = registry.LookupFigures(years)
    again = registry.with_partition_year(registry.enriched_registry(raw, *twice, figures=figures), FULL_COLUMNS)
    versions = tables.current_versions(spark, roots[1])
    with pytest.raises(ValueError, match="has a key twice"):
        tables.publish_years(again, *roots, years, figures.assert_unique)
    assert tables.current_versions(spark, roots[1]) == versions


def test_stream_keeps_catalogue_and_figures(spark, tmp_path):
    dims = [view(spark, SF, n) for n in ("programme_catalogue", "municipalities", "states")]
    folders = [str(tmp_path / n) for n in ("inbox", "full", "public", "progress")]
    catalogue = str(tmp_path / "catalogue")

    def deliver(name, rows, stamp):
        path = Path(folders[0]) / name
        path.parent.mkdir(parents=True, exist_ok=True)
        text = "\n".join(["|".join(RAW_COLUMNS), *["|".join(r.get(c, "") for c in RAW_COLUMNS) for r in rows]]) + "\n"
        path.write_bytes(gzip.compress(text.encode("latin-1")) if name.endswith("gz") else text.encode("latin-1"))
        os.utime(path, (stamp, stamp))
        ingest_arrivals(spark, *folders, *dims, catalog_root=catalogue).awaitTermination()
        public = tables.published(spark, folders[2], folders[2], PUBLIC_SCHEMA)
        kept = monthly.kept_catalog(spark, catalogue)
        assert sorted(map(repr, kept.collect())) == sorted(map(repr, monthly.monthly_catalog(public).collect()))
        return kept.count(), sorted(tables.published_figures(spark, folders[2]).select("anio", "rows_in").distinct().collect())

    row = {"cdprograma": "S072", "periodo": "171", "numespago": "1", "newid": "1"}
    # A folder name with a space and a plus sign is read like any other.
    assert deliver("a b+c/registry_2011.csv", [row, {**row, "periodo": "172"}], 1_600_000_000) == (2, [(2011, 2)])
    assert deliver("a b+c/registry_2012.csv.gz", [{**row, "periodo": "173"}], 1_600_000_001) == (3, [(2011, 2), (2012, 1)])
    assert deliver("d/registry_2011.csv", [row], 1_600_000_002) == (2, [(2011, 1), (2012, 1)])


@pytest.mark.parametrize("name", ["bulk_docs", "feature_docs"])
def test_documents_are_named_and_files_bounded(spark, tmp_path, name):
    lines = materialised(queries()[name](spark, SF), "lines")
    ids = [json.loads(r.value.split("\n")[0])["index"]["_id"] for r in lines.collect()]
    assert len(set(ids)) == len(ids) > 0
    longest = lines.agg(F.max(F.octet_length("value"))).first()[0]
    for size in (20_000, longest // 2):
        path = tmp_path / str(size)
        write_documents(lines, str(path), max_bytes=size)
        files = list(path.glob("part-*"))
        assert max(f.stat().st_size for f in files) <= max(size, longest + 1)
        assert spark.read.text(str(path)).count() == 2 * lines.count()
