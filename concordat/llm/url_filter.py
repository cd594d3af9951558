"""URL filter: fixed rules first, then a path-template tree with labelled purity.

Per host the paths form a tree. Segments that look variable (numbers, dates,
identifiers) become typed wildcards at once; a node with many children keeps
only wildcards and the frequent ones and folds the rest into ``*``. Sibling
branches whose labelled rates do not differ significantly are merged, with all
that lies below them. A template is rejected if its smoothed share of bad labels
is high, where each branch's smoothed share is the prior of those below it, the
host's that of its first branches and the corpus' share that of the hosts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordat.operators.joins import keyed_join
from concordat.storage import materialize, ship

MAX_DEPTH = 8
FAN_OUT = 16
FREQUENT = 0.05
SIMILAR_Z = 1.28
PRIOR_WEIGHT = 10.0
REJECT_PURITY = 0.5
MAX_RULES = 1000
WILDCARD = r"^\{(n|date|id)\}$"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null and without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules) -> Column:
    """(rule, verdict) of the longest rule that fits, else null; of equally long ones the first."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules are compiled into the plan")
    out = None
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def typed(path: Column) -> Column:
    """The path's segments, variable ones as typed wildcards; deeper ones than ``MAX_DEPTH`` are folded into ``**``."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")

    def one(s: Column) -> Column:
        stem = F.regexp_replace(s, r"\.[A-Za-z]{1,5}$", "")
        ending = F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)
        return (
            F.when(stem.rlike(r"^\d{4}-\d{1,2}(-\d{1,2})?$"), F.concat(F.lit("{date}"), ending))
            .when(stem.rlike(r"^\d+$"), F.concat(F.lit("{n}"), ending))
            .when(stem.rlike(r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$|^(?=.*\d)[0-9a-fA-F]{8,}$"), F.concat(F.lit("{id}"), ending))
            .when(stem.rlike(r"\d{3,}"), F.concat(F.regexp_replace(stem, r"\d+", "{n}"), ending))
            .otherwise(s)
        )

    deep = F.size(segments) > MAX_DEPTH
    return F.transform(F.when(deep, F.concat(F.slice(segments, 1, MAX_DEPTH), F.array(F.lit("**")))).otherwise(segments), one)


def fit(urls: DataFrame) -> DataFrame:
    """(host, shape, template, n, n_labelled, purity, rejected), one row for each typed path.

    ``urls`` has (host, path, n, bad): ``n`` is 0 for rows that only bring a
    label, bad is null without one. Counts come from all rows, pre-aggregated by
    typed path, so a host with a third of all rows is a few rows of counts.
    Null and empty hosts are not judged; null paths are empty ones.
    """
    spark = urls.sparkSession
    ship(spark)
    shaped = urls.where("host <> ''").select("host", typed(F.coalesce("path", F.lit(""))).alias("segs"), "n", F.col("bad").cast("int").alias("bad"))
    cur = shaped.withColumn("shape", F.array_join("segs", "/")).groupBy("host", "shape", "segs").agg(F.sum("n").alias("n"), F.count("bad").alias("k"), F.coalesce(F.sum("bad"), F.lit(0)).alias("b"))
    cur = materialize(cur, "url-shapes")
    total = cur.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("k"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"), F.coalesce(F.max(F.size("segs")), F.lit(0)).alias("depth")).first()
    hosts = cur.groupBy("host").agg(_smoothed(F.sum("b"), F.sum("k"), F.lit((total["b"] + 1.0) / (total["k"] + 2.0))).alias("rate"))
    # prefix: the path's own template so far; branch: the same with merged siblings as one.
    cur = keyed_join(cur, hosts, ["host"], "shape").withColumns({"prefix": F.lit(""), "branch": F.lit("")})
    at = ["host", "branch", "seg"]
    for d in range(total["depth"]):
        cur = materialize(cur.withColumn("seg", F.get(F.col("segs"), F.lit(d))), "url-level")
        level = _level(cur.where("seg is not null"))
        told = F.col("as").isNotNull()
        grown = lambda c, name: F.when(told, F.concat(c, F.lit("/"), name)).otherwise(F.col(c)).alias(c)
        cur = keyed_join(cur, materialize(level, "url-branches"), at, "shape", "left").select(
            "host", "shape", "segs", "n", "k", "b", grown("prefix", "as"), grown("branch", "group"), F.when(told, _smoothed(F.col("gb"), F.col("gk"), F.col("rate"))).otherwise(F.col("rate")).alias("rate")
        )
    return cur.select("host", "shape", F.col("prefix").alias("template"), "n", F.col("k").alias("n_labelled"), F.col("rate").alias("purity"), (F.col("rate") >= REJECT_PURITY).alias("rejected"))


def _smoothed(bad: Column, labelled: Column, prior: Column) -> Column:
    return (bad + PRIOR_WEIGHT * prior) / (labelled + PRIOR_WEIGHT)


def _level(live: DataFrame) -> DataFrame:
    """(host, branch, seg, as, group, gk, gb): what each child of a branch becomes, and the labels of the branch that it is merged into.

    Rare children of crowded nodes fold into ``*``; then siblings with labels are
    merged where their rates are similar. Children without labels have no rate
    to compare and stay by themselves. A node has at most ``FAN_OUT`` children
    or 1 / ``FREQUENT`` frequent ones, three wildcards and ``*`` besides, so a
    list of siblings is short.
    """
    node = ["host", "branch"]
    kids = live.groupBy(*node, "seg").agg(F.sum("n").alias("c"), F.sum("k").alias("k"), F.sum("b").alias("b"))
    nodes = kids.groupBy(*node).agg(F.sum("c").alias("t"), F.count("*").alias("f"))
    rare = (F.col("f") > FAN_OUT) & (F.col("c") < FREQUENT * F.col("t")) & ~F.col("seg").rlike(WILDCARD)
    kids = keyed_join(kids, nodes, node, "seg").withColumn("as", F.when(rare, "*").otherwise(F.col("seg")))
    folded = kids.groupBy(*node, "as").agg(F.sum("k").alias("k"), F.sum("b").alias("b"))
    siblings = folded.where("k > 0").groupBy(*node).agg(F.collect_list(F.struct("as", "k", "b")).alias("kids"))

    def merged(batches):
        for batch in batches:
            rows = []
            for host, branch, kids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for group, k, b in merge_similar([(x["as"], x["k"], x["b"]) for x in kids]):
                    rows += [(host, branch, t, min(group), k, b) for t in group]
            if rows:
                kinds = (*[pa.string()] * 4, pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["host", "branch", "as", "group", "gk", "gb"])

    pooled = siblings.select(*node, "kids").mapInArrow(merged, "host string, branch string, as string, group string, gk long, gb long")
    zero = F.lit(0).cast("long")
    return keyed_join(kids.select(*node, "seg", "as"), pooled, [*node, "as"], "seg", "left").select(*node, "seg", "as", F.coalesce("group", "as").alias("group"), F.coalesce("gk", zero).alias("gk"), F.coalesce("gb", zero).alias("gb"))


def merge_similar(kids: list[tuple[str, int, int]], z: float = SIMILAR_Z) -> list[tuple[list[str], int, int]]:
    """Merge labelled siblings (name, labels, bad), neighbours by rate first, while rates differ by less than ``z`` standard errors."""
    groups = [([t], k, b) for t, k, b in sorted(kids, key=lambda x: ((x[2] + 1) / (x[1] + 2), x[0]))]

    def gap(x, y) -> float:
        (_, k1, b1), (_, k2, b2) = x, y
        p = (b1 + b2 + 1) / (k1 + k2 + 2)
        return abs(b1 / k1 - b2 / k2) / (p * (1 - p) * (1 / k1 + 1 / k2)) ** 0.5

    while len(groups) > 1:
        gaps = [gap(a, b) for a, b in zip(groups, groups[1:], strict=False)]
        i = min(range(len(gaps)), key=gaps.__getitem__)
        if gaps[i] >= z:
            break
        (t1, k1, b1), (t2, k2, b2) = groups[i : i + 2]
        groups[i : i + 2] = [(t1 + t2, k1 + k2, b1 + b2)]
    return groups


def judge(pages: DataFrame, labelled: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row of ``pages`` (page_id, url).

    ``labelled`` has (url, bad); its null labels are ignored. A URL that fits a
    rule gets the rule's verdict, else its template's; without labels near it a
    template follows its host and the corpus, and empty hosts are allowed. Null
    ids and repeated rows are judged like any other; other columns are not read.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    known = labelled.select(labelled["url"].alias("url"), labelled["bad"].alias("bad")).where("bad is not null").select(host.alias("host"), path.alias("path"), "bad")
    tree = fit(rows.select("host", "path", F.lit(1).alias("n"), F.lit(None).cast("int").alias("bad")).unionByName(known.select("host", "path", F.lit(0).alias("n"), F.col("bad").cast("int").alias("bad"))))
    shape = F.array_join(typed(F.col("path")), "/")
    met = keyed_join(rows.withColumn("shape", shape), tree.select("host", "shape", "template", "purity", "rejected"), ["host", "shape"], "page_id, path", "left")
    fixed = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.coalesce("rejected", F.lit(False)), "block").otherwise("allow")
    return met.withColumn("fixed", fixed).select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), F.coalesce("fixed.verdict", method).alias("verdict"), "template", "purity")
