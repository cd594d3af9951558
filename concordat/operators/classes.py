"""Linkage by classes of equal records: all pairs of all blocks count, whatever the blocks' size, and none is stored.

Records with the same block keys and the same compared values are alike to every
other record. Counts come from sums over sets of fields, links from neighbours
in sorted order, so no block is squared. Where that doesn't fit (many sets, two
numbers compared at once, weights by which agreement counts against a link),
pairs of classes are judged and their numbers multiplied: as exact, but
quadratic inside a block. What a comparison needs of a value is made once a
record, not once a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations, product
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordat.config import Params
from concordat.functions import text as X
from concordat.operators import linkage as L
from concordat.operators import ranks
from concordat.storage import materialize

# Classes that meet in one step of a join, pairs of classes a task,
# and sets of rules and fields beyond which pairs of classes are judged one by one.
CELL = 256
TASK_PAIRS = 1_000_000
COUNT_SETS = 250
LINK_SETS = 1000


@dataclass(frozen=True)
class Classes:
    """``rows``: records with keys ``k0``.. and values ``f0``..; ``table``: classes with n, rep (least id), cid, and keys of the blocks that count ``b0``.."""

    rows: DataFrame
    table: DataFrame
    spec: list[L.Comparison]
    fields: list[int]
    n_rules: int
    group: list[str]

    @property
    def same(self) -> list[str]:
        return [f"k{i}" for i in range(self.n_rules)] + [f"f{j}" for j in self.fields]


def comparable(c: Column, how: str) -> Column:
    """What the comparison ``how`` looks at: null if the value is missing, NaN if it should be a number and is none."""
    v = X.stripped(c)
    v = F.when(v != "", v)
    kind, _, arg = how.partition(":")
    if kind == "numeric":
        return F.when(v.isNotNull(), F.coalesce(X.to_number(v), F.lit(float("nan"))))
    if kind == "prefix":
        v = F.left(v, F.lit(int(arg)))
    return v if kind == "exact" else F.lower(v)


def _level(a: Column, b: Column, how: str) -> Column:
    """The place of a level in ``LEVELS``."""
    kind, _, arg = how.partition(":")
    agree = F.abs(a - b) <= float(arg) if kind == "numeric" else a == b
    return F.when(a.isNull() | b.isNull(), 2).when(agree, 0).otherwise(1)


def classes(records: DataFrame, rules: list[L.Rule], spec: list[L.Comparison], max_block_size: int | None = None, outcomes: tuple[str, ...] = (), group: tuple[str, ...] = ("cohort_id",)) -> Classes:
    """Classes of the records of :func:`linkage.block`'s blocks, of any size; only a caller's own limit leaves blocks out, as there."""
    for r in rules:
        L.refuse_outcome([L.component(c)[0] for c in r.on], outcomes, f"blocking rule {r.id}")
    for c in spec:
        L.refuse_outcome([c.on], outcomes, f"comparison {c.name}")
    g = list(group)
    cols = [k.alias(f"k{i}") for i, (_, k) in enumerate(L.key_columns(records, rules))]
    n_rules = len(cols)
    fields = [j for j, c in enumerate(spec) if c.on in records.columns]
    cols += [comparable(F.col(f"`{spec[j].on}`"), spec[j].compare).alias(f"f{j}") for j in fields]
    rows = records.select(*g, "record_id", *cols)
    keys = [f"k{i}" for i in range(n_rules)]
    blocked = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in keys], F.lit(False))
    made = rows.where(blocked).groupBy(*g, *keys, *[f"f{j}" for j in fields]).agg(F.count("*").alias("n"), F.min("record_id").alias("rep"))
    table = materialize(made.withColumn("cid", F.monotonically_increasing_id()), "classes")
    for i, k in enumerate(keys):
        if max_block_size is None:
            table = table.withColumn(f"b{i}", F.col(k))
            continue
        over = table.where(F.col(k).isNotNull()).groupBy(*g, k).agg(F.sum("n").alias("m")).where(F.col("m") > max_block_size)
        if over.isEmpty():
            table = table.withColumn(f"b{i}", F.col(k))
        else:
            table = table.join(over.select(*g, k, F.lit(True).alias("over")), [*g, k], "left").withColumn(f"b{i}", F.when(F.col("over").isNull(), F.col(k))).drop("over")
    return Classes(rows, table, spec, fields, n_rules, g)


def _l(x: str) -> Column:
    return F.col(f"l.{x}")


def _r(x: str) -> Column:
    return F.col(f"r.{x}")


def _levels(c: Classes) -> list[Column]:
    return [_level(_l(f"f{j}"), _r(f"f{j}"), x.compare) if j in c.fields else F.lit(2) for j, x in enumerate(c.spec)]


def _code(levels: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [x.cast("long") * 3**j for j, x in enumerate(levels)])


def _weight(levels: list[Column], spec: list[L.Comparison], weights: dict) -> Column:
    """Summed in the spec's order, as in :func:`linkage.score`."""
    return reduce(lambda a, b: a + b, [F.when(x == 0, weights[s.name][L.LEVELS[0]]).when(x == 1, weights[s.name][L.LEVELS[1]]).otherwise(weights[s.name][L.LEVELS[2]]) for x, s in zip(levels, spec, strict=True)])


def _met(c: Classes, i: int, also: tuple[int, ...] = ()) -> DataFrame:
    """Pairs (l, r) of different classes in a block of rule ``i``, without those of earlier rules.

    Only classes that agree in the fields ``also`` meet. Blocks are cut into
    cells, and pairs of cells dealt over as many tasks as there are pairs for.
    """
    at = [*c.group, f"b{i}", *[f"f{j}" for j in also]]
    t = c.table.where(reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in at]))
    sizes = t.groupBy(*at).agg(F.count("*").alias("n")).where("n > 1")
    pairs = sizes.agg(F.sum(F.expr("n * (n - 1) div 2")).alias("p")).first()["p"] or 0
    tasks = max(1, -(-pairs // TASK_PAIRS))
    cells = t.join(sizes.select(*at, F.ceil(F.col("n") / CELL).cast("int").alias("cells")), at).withColumn("cell", F.expr("int(pmod(xxhash64(cid), cells))"))
    deal = [*at, "lo", "hi"]
    left = cells.withColumn("lo", F.col("cell")).withColumn("hi", F.explode(F.expr("sequence(cell, cells - 1)"))).repartition(tasks, *deal).alias("l")
    right = cells.withColumn("hi", F.col("cell")).withColumn("lo", F.explode(F.expr("sequence(0, cell)"))).repartition(tasks, *deal).alias("r")
    here = reduce(lambda a, b: a & b, [_l(x) == _r(x) for x in deal])
    new = reduce(lambda a, b: a & b, [~F.coalesce(_l(f"b{j}") == _r(f"b{j}"), F.lit(False)) for j in range(i)], F.lit(True))
    return left.join(right, here & ((_l("lo") < _l("hi")) | (_l("cid") < _r("cid"))) & new)


def _blocked(c: Classes) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"b{i}").isNotNull() for i in range(c.n_rules)], F.lit(False))


def _numeric(c: Classes, fields) -> list[int]:
    return [j for j in fields if c.spec[j].compare.startswith("numeric")]


def _tolerance(c: Classes, j: int) -> float:
    return float(c.spec[j].compare.partition(":")[2])


def _ordered(c: Classes, fields) -> bool:
    """Whether at most one of the fields is a number, with a tolerance that sorting can look up."""
    numbers = _numeric(c, fields)
    return len(numbers) < 2 and all(0 <= _tolerance(c, j) < inf for j in numbers)


def _countable(c: Classes) -> bool:
    return _ordered(c, c.fields) and (2**c.n_rules - 1) * 3 ** len(c.fields) <= COUNT_SETS


def _finite(x: str) -> Column:
    return F.abs(F.col(x)) < F.lit(inf)


def _of_set(c: Classes, keyed: list[Column], agree: list[Column]) -> list[Column]:
    """Columns ``at``, the key of those who share the rules ``keyed`` and the values that ``agree`` in a ``set``, and ``x``, the number to agree in."""
    numbers = _numeric(c, c.fields)
    parts = [F.when(u, F.col(f"b{i}")).alias(f"b{i}") for i, u in enumerate(keyed)]
    parts += [F.when(a, F.col(f"f{j}")).alias(f"f{j}") for j, a in zip(c.fields, agree, strict=True) if j not in numbers]
    x = [F.when(a & _finite(f"f{j}"), F.col(f"f{j}") + 0.0) for j, a in zip(c.fields, agree, strict=True) if j in numbers]
    return [F.to_json(F.struct("set", *c.group, *parts)).alias("at"), F.coalesce(*x, F.lit(None).cast("double")).alias("x")]


def _counted(c: Classes) -> dict[int, int]:
    """Pairs by code of their levels, from the numbers of classes' records.

    For each set of rules and fields: how many pairs share the rules' blocks,
    have the values of some fields and agree in some of those. Differences over
    the sets give pairs of any rule, and those that disagree or miss a value.
    """
    sets = [(r, s) for n in range(1, c.n_rules + 1) for r in combinations(range(c.n_rules), n) for s in product(range(3), repeat=len(c.fields))]
    if not sets:
        return {}
    # A field's state: 0 anything, 1 both values there, 2 they agree.
    names = [f"u{i}" for i in range(c.n_rules)] + [f"s{j}" for j in c.fields]
    table = c.table.sparkSession.createDataFrame([(k, *[int(i in r) for i in range(c.n_rules)], *s) for k, (r, s) in enumerate(sets)], "set int, " + ", ".join(f"{x} int" for x in names))
    there = [(F.col(f"u{i}") == 0) | F.col(f"b{i}").isNotNull() for i in range(c.n_rules)]
    there += [(F.col(f"s{j}") == 0) | F.col(f"f{j}").isNotNull() for j in c.fields]
    there += [(F.col(f"s{j}") < 2) | _finite(f"f{j}") for j in _numeric(c, c.fields)]
    there += [F.col(x).isNotNull() for x in c.group]
    rows = c.table.crossJoin(F.broadcast(table)).where(reduce(lambda a, b: a & b, there))
    cols = _of_set(c, [F.col(f"u{i}") == 1 for i in range(c.n_rules)], [F.col(f"s{j}") == 2 for j in c.fields])
    sums = materialize(rows.select("set", "n", *cols).groupBy("set", "at", "x").agg(F.sum("n").alias("n")), "class-sums")
    parts = [sums.select("set", F.expr("n * (n - 1) div 2").alias("p"))]
    for j in _numeric(c, c.fields):
        parts.append(_near(sums.where("x is not null"), _tolerance(c, j)))
    met = {r["set"]: r["p"] for r in reduce(DataFrame.unionByName, parts).groupBy("set").agg(F.sum("p").alias("p")).collect()}
    every: dict[tuple, int] = {}
    for k, (r, s) in enumerate(sets):
        every[s] = every.get(s, 0) + (1 if len(r) % 2 else -1) * (met.get(k) or 0)
    out = {}
    for levels in product(range(3), repeat=len(c.fields)):
        # Agree; disagree: there without agreeing; missing: any without those there.
        terms = [{0: [(2, 1)], 1: [(1, 1), (2, -1)], 2: [(0, 1), (1, -1)]}[x] for x in levels]
        n = 0
        for term in product(*terms):
            sign = 1
            for _, x in term:
                sign *= x
            n += sign * every[tuple(s for s, _ in term)]
        level = dict(zip(c.fields, levels, strict=True))
        out[sum(level.get(j, 2) * 3**j for j in range(len(c.spec)))] = n
    return out


def reach(x: np.ndarray, tolerance: float) -> np.ndarray:
    """The largest double whose difference to each finite ``x`` is within the tolerance, as rounding has it; by bisection over the doubles' order."""
    flip = lambda k: k ^ ((k >> 63) & np.int64(2**63 - 1))
    lo, hi = flip((x + 0.0).view(np.int64)), flip(np.full(len(x), inf).view(np.int64))
    with np.errstate(over="ignore"):
        for _ in range(64):
            mid = (lo >> 1) + (hi >> 1) + (lo & hi & 1)
            within = flip(mid).view(np.float64) - x <= tolerance
            lo, hi = np.where(within, mid, lo), np.where(within, hi, mid)
    return flip(lo).view(np.float64)


def _near(sums: DataFrame, tolerance: float) -> DataFrame:
    """(set, p): pairs of different numbers within the tolerance in a group ``at``, in parts to be summed."""

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, n, zero = b["x"].to_numpy(zero_copy_only=False), b["n"], pa.array(np.zeros(b.num_rows, np.int64))
            for y, kind, own, times in ((x, 0, n, pa.array(-n.to_numpy(zero_copy_only=False))), (reach(x, tolerance), 1, zero, n)):
                yield pa.RecordBatch.from_arrays([b["set"], b["at"], pa.array(y), pa.array(np.full(b.num_rows, kind, np.int32)), own, times], ["set", "at", "y", "kind", "n", "times"])

    # Those up to the end of a number's reach, without those up to itself.
    made = sums.select("set", "at", "x", "n").mapInArrow(points, "set int, at string, y double, kind int, n long, times long")
    return ranks.running(made, ["at"], ["y", "kind"], "n", "upto").select("set", F.expr("times * upto").alias("p"))


def vector_counts(c: Classes) -> dict[tuple[str, ...], int]:
    """How many pairs of records with different ids have each combination of levels; at most 3 to the number of fields reach the driver."""
    found: dict[int, int] = _counted(c) if _countable(c) else {}

    def add(pairs: DataFrame, n: Column, sign: int = 1) -> None:
        for x in pairs.select(_code(_levels(c)).alias("code"), n.alias("n")).groupBy("code").agg(F.sum("n").alias("n")).collect():
            found[x["code"]] = found.get(x["code"], 0) + sign * x["n"]

    twice = F.expr("l.n * (l.n - 1) div 2")
    if not _countable(c):
        for i in range(c.n_rules):
            add(_met(c, i), _l("n") * _r("n"))
        alone = c.table.where(_blocked(c) & (F.col("n") > 1))
        add(alone.alias("l").join(alone.select("cid", *[f"f{j}" for j in c.fields]).alias("r"), _l("cid") == _r("cid")), twice)
    # Records of one id are no pair.
    again = c.rows.groupBy(*c.group, "record_id").agg(F.count("*").alias("times")).where("times > 1").drop("times")
    if not again.isEmpty():
        own = _classed(c, c.rows.join(again, [*c.group, "record_id"], "left_semi"), c.table.drop("n", "rep")).groupBy(*c.group, "record_id", "cid", *[f"b{i}" for i in range(c.n_rules)], *[f"f{j}" for j in c.fields]).agg(F.count("*").alias("n"))
        share = reduce(lambda a, b: a | b, [F.coalesce(_l(f"b{i}") == _r(f"b{i}"), F.lit(False)) for i in range(c.n_rules)], F.lit(False))
        one = reduce(lambda a, b: a & b, [_l(x) == _r(x) for x in [*c.group, "record_id"]])
        add(own.alias("l").join(own.alias("r"), one & (_l("cid") <= _r("cid")) & share), F.when(_l("cid") < _r("cid"), _l("n") * _r("n")).otherwise(twice), -1)
    out = {}
    for code, n in found.items():
        if n:
            out[tuple(L.LEVELS[code // 3**j % 3] for j in range(len(c.spec)))] = n
    return out


def _classed(c: Classes, rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with what ``table`` says of their classes."""
    named = table.select(*[F.col(x).alias(f"t_{x}") if x in [*c.group, *c.same] else F.col(x) for x in table.columns])
    on = reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(f"t_{x}")) for x in [*c.group, *c.same]])
    return rows.join(named, on).drop(*[f"t_{x}" for x in [*c.group, *c.same]])


def _weight_of(c: Classes, weights: dict, agree: tuple[int, ...], there: list[int]) -> float:
    """The weight of a pair that agrees in some of the fields that are there."""
    return reduce(lambda a, b: a + b, [weights[x.name][L.LEVELS[0 if j in agree else 1 if j in there else 2]] for j, x in enumerate(c.spec)])


def _link_sets(c: Classes, weights: dict, threshold: float) -> list[tuple[int, int, int, tuple[int, ...]]] | None:
    """(rule, missing fields of one side and of the other as bits, fields): a pair of such classes links if it agrees in all of a set's fields; None if links can't be told that way."""
    if any(weights[c.spec[j].name][L.LEVELS[0]] < weights[c.spec[j].name][L.LEVELS[1]] for j in c.fields):
        return None
    found = [r["gone"] for r in c.table.where(_blocked(c)).select(_gone(c)).distinct().collect()]  # at most 2 to the number of fields
    out = []
    for p, q in [(p, q) for p in found for q in found if p <= q]:
        there = [j for j in c.fields if not (p | q) >> j & 1]
        least: list[tuple[int, ...]] = []
        for s in [s for n in range(len(there) + 1) for s in combinations(there, n)]:
            if not any(set(x) <= set(s) for x in least) and _weight_of(c, weights, s, there) >= threshold:
                least.append(s)
        if not all(_ordered(c, s) for s in least):
            return None
        out += [(i, p, q, s) for s in least for i in range(c.n_rules)]
        if len(out) > LINK_SETS:
            return None
    return out


def _gone(c: Classes) -> Column:
    return reduce(lambda a, b: a + b, [F.when(F.col(f"f{j}").isNull(), F.lit(1 << j)).otherwise(0) for j in c.fields], F.lit(0)).cast("long").alias("gone")


def _linked(c: Classes, sets: list[tuple[int, int, int, tuple[int, ...]]]) -> DataFrame:
    """(group, left_id, right_id, lc, rc): links of classes, enough to join all that link with each other.

    Classes that link by a set's fields alone link with the first of the other
    side. Where a number has to agree, each links with the next lower and the
    next higher of the other side: any other within the tolerance lies behind
    one that links with it or stands on its own side and links as it does.
    """
    numbers = _numeric(c, c.fields)
    rows = [(k, gone, side, i, *[int(j in s) for j in c.fields]) for k, (i, p, q, s) in enumerate(sets) for gone, side in ([(p, 2)] if p == q else [(p, 0), (q, 1)])]
    table = c.table.sparkSession.createDataFrame(rows, "set int, gone long, side int, rule int" + "".join(f", s{j} int" for j in c.fields))
    key = reduce(lambda a, b: a | b, [(F.col("rule") == i) & F.col(f"b{i}").isNotNull() for i in range(c.n_rules)])
    there = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in c.group] + [(F.col(f"s{j}") == 0) | _finite(f"f{j}") for j in numbers], key)
    cols = _of_set(c, [F.col("rule") == i for i in range(c.n_rules)], [F.col(f"s{j}") == 1 for j in c.fields])
    roles = c.table.withColumn("gone", _gone(c)).join(F.broadcast(table), "gone").where(there).select(*c.group, "side", "cid", "rep", *cols)
    plain = roles.where("x is null")
    this = F.struct("cid", "rep")
    heads = plain.groupBy("at").agg(F.min(F.when(F.col("side") != 1, this)).alias("h0"), F.min(F.when(F.col("side") != 0, this)).alias("h1"))
    out = [plain.join(heads, "at").select(*c.group, "cid", "rep", F.when(F.col("side") == 0, F.col("h1")).otherwise(F.col("h0")).alias("o"))]
    for j in numbers:
        # Cells a little wider than the tolerance: what links lies in one cell or in two that adjoin, which meet in the upper one.
        width = _tolerance(c, j) * 1.001
        cell = F.floor(F.greatest(F.least(F.col("x") / width, F.lit(2.0**40)), F.lit(-(2.0**40)))).cast("long") if width else F.lit(0).cast("long")
        cells = roles.where("x is not null").withColumn("cell", F.explode(F.array(cell, cell + 1)))
        of = lambda side: F.when(F.col("side") != side, F.struct("cid", "rep", "x"))
        for order in ([F.asc("x"), F.asc("cid")], [F.desc("x"), F.desc("cid")]):
            w = Window.partitionBy("at", "cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
            near = cells.withColumn("o", F.when(F.col("side") == 0, F.last(of(0), True).over(w)).otherwise(F.last(of(1), True).over(w)))
            out.append(near.where(F.abs(F.col("x") - F.col("o.x")) <= _tolerance(c, j)).select(*c.group, "cid", "rep", F.struct("o.cid", "o.rep").alias("o")))
    return reduce(DataFrame.unionByName, out).where("o is not null and cid <> o.cid").select(*c.group, F.col("rep").alias("left_id"), F.col("o.rep").alias("right_id"), F.col("cid").alias("lc"), F.col("o.cid").alias("rc")).distinct()


def _judged(c: Classes, weights: dict, threshold: float, enough) -> list[DataFrame]:
    """All links of classes; fields without whose agreement no pair reaches the threshold are join keys."""
    best = {x.name: max(weights[x.name].values()) for x in c.spec}
    short = lambda x: sum(best.values()) - best[x.name] + max(weights[x.name][k] for k in L.LEVELS[1:]) < threshold - 1e-6
    also = tuple(j for j in c.fields if not c.spec[j].compare.startswith("numeric") and short(c.spec[j]))
    return [enough(_met(c, i, also)).select(*[_l(x).alias(x) for x in c.group], _l("rep").alias("left_id"), _r("rep").alias("right_id"), _l("cid").alias("lc"), _r("cid").alias("rc")) for i in range(c.n_rules)]


def links(c: Classes, weights: dict, threshold: float) -> DataFrame:
    """(group, left_id, right_id): links enough to tell the persons that all pairs of that weight make.

    Linked classes by their least ids, and each record of a linked class with
    that of its own: whoever links with a class links with all its records.
    """
    enough = lambda df: df.where(_weight(_levels(c), c.spec, weights) >= threshold)
    none = c.rows.select(*c.group, F.col("record_id").alias("left_id"), F.col("record_id").alias("right_id")).where("false")
    if not c.n_rules:
        return none
    sets = _link_sets(c, weights, threshold)
    found = [_linked(c, sets)] if sets else _judged(c, weights, threshold, enough) if sets is None else []
    if not found:
        return none
    pairs = materialize(reduce(DataFrame.unionByName, found), "class-links")
    alone = c.table.where(_blocked(c) & (F.col("n") > 1))
    alike = enough(alone.alias("l").join(alone.select("cid", *[f"f{j}" for j in c.fields]).alias("r"), _l("cid") == _r("cid"))).select(_l("cid").alias("cid"))
    active = pairs.select(F.explode(F.array("lc", "rc")).alias("cid")).unionByName(alike).distinct()
    members = _classed(c, c.rows, c.table.join(active, "cid", "left_semi").select(*c.group, *c.same, "rep"))
    stars = members.where("record_id <> rep").select(*c.group, F.col("rep").alias("left_id"), F.col("record_id").alias("right_id"))
    return pairs.select(*c.group, "left_id", "right_id").unionByName(stars)


def bands(counts: dict[tuple[str, ...], int], spec: list[L.Comparison], weights: dict, p: Params) -> dict[str, int]:
    """Pairs of each band of :func:`linkage.banded`, from counts of level combinations."""
    out: dict[str, int] = {}
    for levels, n in counts.items():
        w = reduce(lambda a, b: a + b, [weights[s.name][k] for s, k in zip(spec, levels, strict=True)])
        band = "link" if w >= p.match_threshold else "clerical" if w >= p.clerical_threshold else "distinct"
        out[band] = out.get(band, 0) + n
    return out
