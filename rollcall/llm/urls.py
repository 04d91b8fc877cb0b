"""URL filters: sorted sweeps of host and path keys over the intervals of nested rules."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from rollcall.llm.common import met_by_run, run_number, stored

#: Page keys of one host that a sweep takes together; hotter hosts are cut by a hash.
SWEEP_ROWS = 200_000
RULES = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("host", "path", "verdict")]
)


def host_of(url: str) -> Column:
    """The host after ``://``, lower case; empty where there is none."""
    return F.translate(
        F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )


def path_of(url: str) -> Column:
    """What follows the host up to ``?`` or ``#``; empty where there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: str) -> Column:
    """``m.example.net`` as ``net.example.m.``: a host's key begins those of its subdomains."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _outer_keys(key: str) -> Column:
    """A key cut after each label, the shortest first: the hosts around it, and itself."""
    labels = F.split(key, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda i: F.concat(F.array_join(F.slice(labels, 1, i), "."), F.lit(".")),
    )


def rules_over(hosts: DataFrame, rule_hosts: DataFrame) -> DataFrame:
    """``_host`` and ``_keys``: for each host key the rule hosts it lies under, itself included.

    ``hosts`` and ``rule_hosts`` have distinct keys.  A rule's host opens an interval, from its
    key to the last key that begins with it.  Rules and hosts are put in one order by ranges and
    swept: the interval opened last carries the stack of the intervals around it, and of those a
    host lies in the ones its key begins with.  Each range begins with the stack that the ranges
    before left open, which is one row for each of them.
    """
    around = rule_hosts.select("_key", F.explode(_outer_keys("_key")).alias("_outer"))
    known = rule_hosts.select(F.col("_key").alias("_outer"))
    opened = around.join(known, "_outer").groupBy("_key").agg(F.sort_array(F.collect_list("_outer")).alias("_stack"))
    events = opened.select(F.col("_key").alias("_at"), F.lit(0).alias("_kind"), "_stack").unionByName(
        hosts.select(
            F.col("_host").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("array<string>").alias("_stack")
        )
    )
    ranged = stored(
        events.repartitionByRange("_at", "_kind").withColumn("_part", F.spark_partition_id()), "host-sweep"
    )
    last = {
        r._part: r.stack
        for r in ranged.groupBy("_part").agg(F.max_by("_stack", F.when(F.col("_kind") == 0, F.col("_at"))).alias("stack")).collect()
    }
    carried, open_ = [], None
    for part in sorted(last):
        carried.append((part, open_))
        open_ = last[part] or open_
    left_open = ranged.sparkSession.createDataFrame(carried, "_part int, _open array<string>")
    sweep = W.partitionBy("_part").orderBy("_at", "_kind")
    swept = ranged.join(F.broadcast(left_open), "_part").withColumn(
        "_active", F.coalesce(F.last("_stack", ignorenulls=True).over(sweep), F.col("_open"))
    )
    inside = F.filter("_active", lambda key: F.startswith(F.col("_at"), key))
    return swept.where((F.col("_kind") == 1) & (F.size(inside) > 0)).select(
        F.col("_at").alias("_host"), inside.alias("_keys")
    )


def nested_rules(rules: DataFrame) -> DataFrame:
    """Each rule as the interval its path prefix opens, with the stack active inside it.

    The stack lists the rule and the rules around it on the same host, innermost first.  Equal
    rules count once; of contradicting ones ``block`` holds.
    """
    own = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(
            reversed_host("host").alias("_key"), F.col("path").alias("_path"),
            F.concat("host", "path").alias("rule"), "verdict",
        )
        .groupBy("_key", "_path", "rule")
        .agg(F.max("verdict").alias("verdict"))
    )
    opened = own.select(
        "_key",
        F.col("_path").alias("_inner"),
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.length("_path")), lambda n: F.left("_path", n)
            )
        ).alias("_path"),
    )
    around = F.struct(F.length("_path").alias("long"), "_path", "rule", "verdict")
    return (
        opened.join(own, ["_key", "_path"])
        .groupBy("_key", F.col("_inner").alias("_path"))
        .agg(F.sort_array(F.collect_list(around), asc=False).alias("_stack"))
    )


def judged(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url: str = "url",
    default: str = "allow",
    sweep_rows: int = SWEEP_ROWS,
) -> DataFrame:
    """One row per page: its id, ``host``, ``path``, the longest fitting ``rule``, ``verdict``.

    A rule ``(host, path, verdict)`` fits its host and subdomains if the path starts with its
    path.  Longest counts the letters of host and path together, then those of the host.  A
    page without a rule has a null rule and the ``default`` verdict.  Null or malformed urls
    have an empty host and path.  Repeated pages and null ids come as often as they are given;
    no pages give an empty result, no rules the default for all.

    One sweep over the reversed hosts finds the rule hosts around each page's; then each of
    these meets its rules' paths in a sweep sorted by path: the rule opened last carries the
    stack of active rules, and the first of them still open at the page's path is the innermost
    one.  Hosts with many pages are cut into slices by a hash, each swept over the same few
    rules, and meet their rule hosts once per run of the input.
    Urls of any length are read whole; other columns, whatever their names, do not matter.
    """
    flat = pages.select(
        F.col(id_column).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    page = ["_id", "host", "path"]
    distinct = stored(
        flat.groupBy(*page).agg(F.count(F.lit(1)).alias("_n"))
        .withColumns({"_host": reversed_host("host"), "_run": run_number()}),
        "page-keys",
    )
    stacks = stored(nested_rules(rules), "rules")
    over = rules_over(distinct.select("_host").distinct(), stacks.select("_key").distinct())
    met = met_by_run(distinct, over, ["_host"])
    keyed = met.select(*page, F.explode("_keys").alias("_key"))
    slices = keyed.groupBy("_key").agg(
        F.ceil(F.count(F.lit(1)) / sweep_rows).cast("int").alias("_slices")
    )
    swept_pages = keyed.join(slices, "_key").select(
        "_key", F.pmod(F.xxhash64(*page), F.col("_slices")).cast("int").alias("_slice"),
        F.col("path").alias("_path"), F.lit(1).alias("_kind"), *page,
        F.lit(None).cast(stacks.schema["_stack"].dataType).alias("_stack"),
    )
    swept_rules = stacks.join(slices, "_key").select(
        "_key", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"),
        "_path", F.lit(0).alias("_kind"), F.lit(None).cast(flat.schema["_id"].dataType).alias("_id"),
        *[F.lit(None).cast("string").alias(c) for c in page[1:]], "_stack",
    )
    sweep = W.partitionBy("_key", "_slice").orderBy("_path", "_kind")
    active = F.last("_stack", ignorenulls=True).over(sweep)
    found = (
        swept_pages.unionByName(swept_rules)
        .withColumn("_active", active)
        .where(F.col("_kind") == 1)
        .withColumn(
            "_rule",
            F.try_element_at(
                F.filter("_active", lambda r: F.startswith(F.col("_path"), r["_path"])), F.lit(1)
            ),
        )
        .where(F.col("_rule").isNotNull())
        .select(
            *page, F.lit(0).cast("bigint").alias("_n"),
            F.struct(
                F.length("_rule.rule").alias("long"), F.length("_key").alias("host_long"),
                F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("verdict"),
            ).alias("_best"),
        )
    )
    own = distinct.select(*page, "_n", F.lit(None).cast(found.schema["_best"].dataType).alias("_best"))
    best = own.unionByName(found).groupBy(*page).agg(
        F.max("_best").alias("_best"), F.sum("_n").alias("_n")
    )
    return best.select(
        F.col("_id").alias(id_column), "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_copy"),
    ).drop("_copy")
