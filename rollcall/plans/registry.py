"""Raw registry rows -> cleaned and public tables."""

from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rollcall.functions import codes, keys, person, text
from rollcall.labels import AGE_LABELS, NO_BENEFIT, OTHER_BENEFIT
from rollcall.operators.checks import assert_columns
from rollcall.operators.dimensions import given_lookup, given_lookups
from rollcall.operators.rules import amount_rules, exclude_rule
from rollcall.schemas import FULL_COLUMNS
from rollcall.sources.dimensions import geography, registry_catalogue


@dataclass(frozen=True)
class Edition:
    """Where registry editions differ.  The defaults are the current edition."""

    age_labels: dict[str, str] = field(default_factory=lambda: AGE_LABELS)
    own_month: bool = False
    missing_origin: str | None = "F"
    other_benefit: str | None = OTHER_BENEFIT
    no_benefit: str | None = NO_BENEFIT


CURRENT = Edition()


def clean_registry(raw: DataFrame, edition: Edition = CURRENT) -> DataFrame:
    """Clean every coded column.  Later layers read the cleaned values of earlier ones."""
    c = F.col
    base = raw.withColumns(
        {
            "newid": text.clean_long(c("newid")),
            "anio": text.clean_int(c("anio")),
            "mescorresp": codes.period_month(c("periodo")),
            "cdsexo": codes.gender_code(c("cdsexo")),
            "origen": codes.origin_code(c("nborigen"), edition.missing_origin),
            "nuimpmonetario": text.clean_long(c("nuimpmonetario")),
            "cveentpago": codes.state_code(c("cdentpago")),
            "cvelocpago": codes.loc_code(c("cdlocpago")),
            "cveent": codes.state_code(c("cveent")),
            "cveloc": codes.loc_code(c("cveloc")),
            "_born": person.birth_number(c("fhnacimiento")),
            "nombretipobeneficio": codes.benefit_name(
                c("cdtipobeneficio"), edition.other_benefit, edition.no_benefit
            ),
        }
    )
    month = (
        codes.pay_month_own(c("numespago"))
        if edition.own_month
        else codes.pay_month(c("numespago"), c("mescorresp"))
    )
    derived = base.withColumns(
        {
            "numespago": month,
            "age": person.age_at_month(c("_born"), c("anio"), c("mescorresp")),
            "cvemunipago": codes.muni_in_state(c("cdmunpago"), c("cveentpago")),
            "cvemuni": codes.muni_in_state(c("cvemun"), c("cveent")),
            "programatipo": keys.program_type_key(
                c("cdprograma"), c("cdpadron"), c("nombretipobeneficio")
            ),
            "iduni": keys.unified_id(
                c("origen"), c("cddependencia"), c("cdprograma"), c("cdpadron"), c("anio")
            ),
        }
    )
    return derived.withColumns(
        {
            "categoriaedad": person.age_band(c("age"), edition.age_labels),
            **{
                name: person.mask_minor_name(c(name), c("age"))
                for name in ("nbprimerap", "nbsegundoap", "nbnombre")
            },
        }
    ).drop("_born")


def enrich_catalogue(cleaned: DataFrame, catalogue: DataFrame, **limit) -> DataFrame:
    """Add programme names, by unified id within the delivery year's catalogue."""
    names = registry_catalogue(catalogue)
    return given_lookup(cleaned, names, ["iduni", "file_year"], **limit)


def enrich_geography(
    cleaned: DataFrame, municipalities: DataFrame, states: DataFrame, **limit
) -> DataFrame:
    """Add state code and name by municipality; they replace the registry's own."""
    places = geography(municipalities, states).select("cvemuni", "cveent", "noment")
    bare = cleaned.drop("cveent", "noment")
    return given_lookup(bare, places, ["cvemuni"], **limit)


class LookupFigures:
    """How the rows of each delivery year fared in the lookups, counted while they are written.

    The counts are observed in the pass that writes the rows: no job is run for them.
    """

    _KEYS = {"catalogue": ["iduni", "file_year"], "geography": ["cvemuni"]}

    def __init__(self, years: list[int]):
        self.years, self._before, self._after = sorted(years), Observation(), Observation()

    def _counts(self, of: str, rows: dict[str, Column]) -> list[Column]:
        year = F.col("file_year")
        return [
            F.count_if((year == y) & fits).alias(f"{of} {name} {y}")
            for name, fits in rows.items() for y in self.years
        ]

    def before(self, df: DataFrame) -> DataFrame:
        """Rows that go into the lookups, and those without a key."""
        null = {name: reduce(or_, (F.col(k).isNull() for k in on)) for name, on in self._KEYS.items()}
        return df.observe(self._before, *self._counts("in", {"rows": F.lit(True)}), *self._counts("null", null))

    @staticmethod
    def marked(dim: DataFrame, name: str) -> DataFrame:
        return dim.withColumn(f"_met_{name}", F.lit(True))

    def after(self, df: DataFrame) -> DataFrame:
        """Rows that come out, and those that have a key but no partner."""
        lone = {
            name: F.col(f"_met_{name}").isNull() & reduce(and_, (F.col(k).isNotNull() for k in on))
            for name, on in self._KEYS.items()
        }
        seen = df.observe(self._after, *self._counts("out", {"rows": F.lit(True)}), *self._counts("lone", lone))
        return seen.drop(*[f"_met_{name}" for name in self._KEYS])

    def rows(self) -> list[tuple]:
        """After the action: year, lookup, rows in, null keys, keys without partner, rows out."""
        before, after = self._before.get, self._after.get
        return [
            (y, name, before[f"in rows {y}"], before[f"null {name} {y}"], after[f"lone {name} {y}"], after[f"out rows {y}"])
            for y in self.years for name in self._KEYS
        ]

    def assert_unique(self) -> None:
        """An error if a dimension repeats a key, so that rows came out more than once."""
        more = [r[0] for r in self.rows() if r[5] > r[2]]
        if more:
            raise ValueError(f"lookups repeat rows of {sorted(set(more))}: a dimension has a key twice")


def enriched_registry(
    raw: DataFrame,
    catalogue: DataFrame,
    municipalities: DataFrame,
    states: DataFrame,
    edition: Edition = CURRENT,
    figures: LookupFigures | None = None,
    **limit,
) -> DataFrame:
    """Clean, enrich, apply the amount and exclusion rules.  Keeps ``file_year``."""
    bare = exclude_rule(clean_registry(raw, edition)).drop("cveent", "noment")
    names = registry_catalogue(catalogue)
    places = geography(municipalities, states).select("cvemuni", "cveent", "noment")
    if figures:
        bare, names, places = (
            figures.before(bare), figures.marked(names, "catalogue"), figures.marked(places, "geography")
        )
    met = given_lookups(bare, [(names, ["iduni", "file_year"]), (places, ["cvemuni"])], **limit)
    return amount_rules(figures.after(met) if figures else met)


def full_table(enriched: DataFrame) -> DataFrame:
    return assert_columns(enriched.select(FULL_COLUMNS), FULL_COLUMNS)


def with_partition_year(enriched: DataFrame, columns: list[str]) -> DataFrame:
    """The table's columns and its year partition, the year of the delivery."""
    return enriched.select(*columns, F.col("file_year").alias("anio"))
