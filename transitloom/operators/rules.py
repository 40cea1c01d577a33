"""Licence patterns: exact numbers, ranges, prefixes and ``*``; their overlaps and the rule that applies to a number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXACT, RANGE, PREFIX = 3, 2, 1


def parse(rules: DataFrame, column: str = "licence") -> DataFrame:
    """Add ``kind, low, high, narrowness``; all null where the pattern is not valid."""
    c = F.trim(F.col(column))
    low, high = F.regexp_extract(c, "^([0-9]+)-([0-9]+)$", 1), F.regexp_extract(c, "^([0-9]+)-([0-9]+)$", 2)
    ranged = (low != "") & (F.length(low) == F.length(high)) & (low <= high)
    prefix = F.regexp_extract(c, r"^([0-9]*)\*$", 1)
    kind = F.when(c.rlike("^[0-9]+$"), EXACT).when(ranged, RANGE).when(c.rlike(r"^[0-9]*\*$"), PREFIX)
    pick = lambda exact, rng, pre: F.when(kind == EXACT, exact).when(kind == RANGE, rng).when(kind == PREFIX, pre)
    wide = pick(F.lit(0).cast("long"), -(high.cast("long") - low.cast("long")), F.length(prefix).cast("long"))
    return rules.withColumns({"kind": kind, "low": pick(c, low, prefix), "high": pick(c, high, prefix), "narrowness": wide})


def overlaps(a: str, b: str) -> Column:
    """Do two parsed patterns, under the aliases ``a`` and ``b``, share a number?"""
    la, ha, ka, lb, hb, kb = (F.col(f"{x}.{y}") for x in (a, b) for y in ("low", "high", "kind"))
    both = (ka != PREFIX) & (kb != PREFIX) & (F.length(la) == F.length(lb)) & (la <= hb) & (lb <= ha)
    nested = (ka == PREFIX) & (kb == PREFIX) & (la.startswith(lb) | lb.startswith(la))
    mixed = lambda p, low, high: (F.length(p) <= F.length(low)) & (F.rpad(p, F.length(low), F.lit("0")) <= high) & (F.rpad(p, F.length(low), F.lit("9")) >= low)
    return both | nested | ((ka == PREFIX) & (kb != PREFIX) & mixed(la, lb, hb)) | ((kb == PREFIX) & (ka != PREFIX) & mixed(lb, la, ha))


def _bucketed(p: DataFrame) -> DataFrame:
    """Parsed rules under each ``bucket`` in which an equally specific rule that overlaps must lie too.

    Exact numbers and prefixes of one length overlap only if equal; a range is
    listed under the leading pairs of digits that it spans.
    """
    ends = (F.substring(c, 1, 2).cast("int") for c in ("low", "high"))
    bands = F.transform(F.sequence(*ends), lambda d: F.concat(F.length("low").cast("string"), F.lit("/"), d.cast("string")))
    return p.withColumn("bucket", F.explode(F.when(F.col("kind") == RANGE, bands).otherwise(F.array("low"))))


def _same_bucket(agency: str) -> Column:
    return (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.kind") == F.col("b.kind")) & (F.col("a.narrowness") == F.col("b.narrowness")) & (F.col(f"a.{agency}") == F.col(f"b.{agency}")) & (F.col("a.id") < F.col("b.id"))


def conflicts(rules: DataFrame, value: str) -> DataFrame:
    """Pairs of equally specific rules of one agency that overlap and give different values."""
    p = _bucketed(parse(rules).filter("kind is not null"))
    hit = _same_bucket("agency") & (F.col(f"a.{value}") != F.col(f"b.{value}")) & overlaps("a", "b")
    return p.alias("a").join(p.alias("b"), hit).select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id")).distinct()


def line_guard(c: Column) -> Column:
    """``struct(low, high)`` of a guard like ``12`` or ``10-20``; null if blank or not valid."""
    low, high = (F.regexp_extract(c, "^([0-9]+)(?:-([0-9]+)?)?$", i) for i in (1, 2))
    ends = F.struct(F.nullif(low, F.lit("")).cast("long").alias("low"), F.coalesce(F.nullif(high, F.lit("")), F.nullif(low, F.lit(""))).cast("long").alias("high"))
    return F.when(ends["low"] <= ends["high"], ends)


def guards_disjoint(a: str, b: str) -> Column:
    """Can two rules with ``expected_mode, public_line`` never apply to one line? A guard that is not valid never applies."""
    left, right = (line_guard(F.col(f"{x}.public_line")) for x in (a, b))
    invalid = [(F.col(f"{x}.public_line") != "") & g.isNull() for x, g in ((a, left), (b, right))]
    apart = F.coalesce((left["high"] < right["low"]) | (right["high"] < left["low"]), F.lit(False))
    return (F.col(f"{a}.expected_mode") != F.col(f"{b}.expected_mode")) | invalid[0] | invalid[1] | apart


# Modes of a rule and the fields that a presentation rule sets.
MODES = "AETLMP"
PRESENTED = ("route_short_name", "route_color", "route_text_color")


def _row_errors(rows: DataFrame, checks: list[tuple[Column, str]]) -> DataFrame:
    found = F.array_compact(F.array(*[F.when(wrong, F.lit(text)) for wrong, text in checks]))
    return rows.select("id", F.explode(found).alias("error"))


def _common(rows: DataFrame) -> tuple[DataFrame, list[tuple[Column, str]]]:
    checks = [
        (F.col("kind").isNull(), "invalid licence"),
        ((F.col("agency_id") != "") & ~F.col("agency_id").rlike("^[0-9]+$"), "agency is not a number"),
        (F.col("reason") == "", "reason is required"),
    ]
    return parse(rows), checks


def _pair_errors(rows: DataFrame, differ: Column, apart: Column | None = None) -> DataFrame:
    """Overlapping pairs of equally specific rules; a rule for any agency differs in specificity from one with an agency."""
    p = _bucketed(parse(rows).filter("kind is not null"))
    hit = _same_bucket("agency_id") & differ & overlaps("a", "b")
    hit = hit if apart is None else hit & ~apart
    return p.alias("a").join(p.alias("b"), hit).select(F.col("b.id").alias("id"), F.concat(F.lit("conflicts with "), F.col("a.id").cast("string")).alias("error")).distinct()


def mode_errors(rows: DataFrame) -> DataFrame:
    """``(id, error)`` of rules (id, agency_id, licence, public_line, expected_mode, effective_mode, reason), all text but id."""
    p, checks = _common(rows)
    checks.append(((F.col("public_line") != "") & line_guard(F.col("public_line")).isNull(), "invalid line guard"))
    checks += [(~F.col(c).isin(*MODES), f"unknown {c}") for c in ("expected_mode", "effective_mode")]
    checks.append((F.col("expected_mode") == F.col("effective_mode"), "changes nothing"))
    return _row_errors(p, checks).unionByName(_pair_errors(rows, F.lit(True), guards_disjoint("a", "b")))


def presentation_errors(rows: DataFrame) -> DataFrame:
    """``(id, error)`` of rules (id, agency_id, licence, route_short_name, route_color, route_text_color, reason)."""
    p, checks = _common(rows)
    checks.append((F.concat(*PRESENTED) == "", "overrides nothing"))
    checks += [((F.col(c) != "") & ~F.col(c).rlike("^[0-9A-Fa-f]{6}$"), f"{c} is not six hex digits") for c in PRESENTED[1:]]
    both = [(F.col(f"a.{c}") != "") & (F.col(f"b.{c}") != "") for c in PRESENTED]
    return _row_errors(p, checks).unionByName(_pair_errors(rows, both[0] | both[1] | both[2]))


def directory_errors(tables: dict[str, DataFrame | Exception]) -> DataFrame:
    """``(table, id, error)`` of the ``modes`` and ``presentation`` rules of a directory; a table that could not be read is one error."""
    out = None
    for name, check in (("modes", mode_errors), ("presentation", presentation_errors)):
        rows = tables[name]
        if isinstance(rows, Exception):
            spark = next(t for t in tables.values() if isinstance(t, DataFrame)).sparkSession
            own = spark.range(1).select(F.lit(None).cast("string").alias("id"), F.lit(str(rows)).alias("error"))
        else:
            own = check(rows).select(F.col("id").cast("string").alias("id"), "error")
        own = own.select(F.lit(name).alias("table"), "id", "error")
        out = own if out is None else out.unionByName(own)
    return out


def resolve(numbers: DataFrame, rules: DataFrame, column: str = "licence", agency: str | None = None, fields: tuple[str, ...] = ()) -> DataFrame:
    """Every row of ``numbers`` with the most specific rule for its number: ``rule_id`` and ``kind``, null where none applies.

    Each distinct number is looked up once, by equality joins on the number, its
    prefixes, and its length and first digits for ranges. ``rules`` has id,
    licence; of equally specific rules the smallest id counts. With ``agency``, a column of
    both, rules with a blank one apply to all and those of the number's own come
    first. For each of ``fields``, columns of the rules, the most specific rule
    that is not blank there gives the value.
    """
    keys = [column, *([agency] if agency else [])]
    own = F.col(agency) if agency else F.lit("")
    p = parse(rules).filter("kind is not null").select("id", "kind", "low", "high", "narrowness", own.alias("agency__"), *fields)
    n = numbers.select(*keys).filter(F.col(column).isNotNull()).distinct().withColumn("size__", F.length(column))
    exact = n.join(p.filter(F.col("kind") == EXACT), F.col(column) == F.col("low"))
    # a range is listed under each leading pair of digits that it spans
    band = F.explode(F.sequence(F.substring("low", 1, 2).cast("int"), F.substring("high", 1, 2).cast("int")))
    ranged = p.filter(F.col("kind") == RANGE).withColumns({"band": band, "len": F.length("low")})
    hit = n.join(ranged, (F.substring(column, 1, 2).cast("int") == F.col("band")) & (F.col("size__") == F.col("len")) & F.col(column).between(F.col("low"), F.col("high"))).drop("band", "len")
    tops = n.withColumn("top", F.explode(F.transform(F.sequence(F.lit(0), F.col("size__")), lambda i: F.substring(F.col(column), F.lit(1), i))))
    pre = tops.join(p.filter(F.col("kind") == PREFIX), F.col("top") == F.col("low")).drop("top")
    every = exact.unionByName(hit).unionByName(pre)
    if agency:
        every = every.filter((F.col("agency__") == "") | (F.col("agency__") == F.col(agency)))
    rank = F.struct((F.col("agency__") != "").alias("a"), F.col("kind").alias("k"), F.col("narrowness").alias("w"), (-F.col("id")).alias("i"))
    best = every.groupBy(*keys).agg(F.max_by(F.struct(F.col("id").alias("rule_id"), "kind"), rank).alias("best"), *[F.max_by(f, F.when(F.coalesce(F.col(f), F.lit("")) != "", rank)).alias(f) for f in fields])
    return numbers.join(best, keys, "left").select(*numbers.columns, "best.rule_id", "best.kind", *fields)
