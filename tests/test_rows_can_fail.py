"""Rows of the comparison turn red when the operator behind them does nothing or too little."""

import pytest
from pyspark.sql import functions as F

from rollcall.functions import encoding, lists
from rollcall.plans import catalogues, registry
from tests.compare import difference, duckdb_tables
from workload import queries
from workload.oracles import statements

SF = "/root/testdata/sf0.001"


def any_year(cleaned, names, on, **_):
    return cleaned.join(names.drop("file_year"), ["iduni"], "left")


def first_only(cleaned, names, on, **_):
    return cleaned.join(names.dropDuplicates(on), on, "left")


def narrow(c):
    return registry.text.strip_quotes(c).try_cast("int").cast("bigint")


@pytest.mark.parametrize(
    "name, module, function, instead",
    [
        ("cp1252_fix", encoding, "cp1252_fix", lambda c: c),
        ("enrich_catalog", registry, "given_lookup", any_year),
        ("enrich_catalog", registry, "given_lookup", first_only),
        ("has_profile", queries, "membership", lambda df, keys, on, flag: df.withColumn(flag, F.lit(0))),
        ("focus_groups", lists, "FOCUS_GROUPS", {"migrantes": [38]}),
        ("catalog_arrays", catalogues, "without_blanks", lambda c: c),
        ("clean_registry", registry.text, "clean_long", narrow),
    ],
)
def test_row_turns_red(spark, monkeypatch, name, module, function, instead):
    monkeypatch.setattr(module, function, instead)
    assert difference(queries.registered()[name](spark, SF), duckdb_tables(SF), statements()[name])
