"""W20 constraint audit: report violations of the declared keys, unique, foreign-key,
not-null and domain rules of the schema, one finding row per violating key.

The reference leaves enforcement to the database at write time; here the rules
are data (taken from the DDL) and the audit is a union of set-based checks: bitmaps of
integer ids for keys and references (the ids of the spans that hit are looked at again),
``groupBy(key).count > 1`` and ``left_anti`` for other keys, filters for domains and nulls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.functions.sequence import materialize
from registrar.operators.reports import tbl
from registrar.schema import CLASS_TYPES, COURSE_CODE_MAX_LEN, FOREIGN_KEYS, PRIMARY_KEYS, ROLES, SCHEMAS

FINDING = "table_name string, rule string, detail string, n_rows long"

# Unique constraints beyond the primary keys.
UNIQUE = (
    ("users", ("username",)),
    ("degree_program", ("name",)),
    ("activity", ("name",)),
    ("course_edition", ("course_code", "year")),
)


def _domain_rules():
    """(table, rule name, column, condition that must hold when the column is not null)."""
    return (
        ("users", "check:role", "role", F.col("role").isin(list(ROLES))),
        ("class", "check:type", "type", F.trim(F.col("type")).isin(list(CLASS_TYPES))),
        ("course", "length:code", "code", F.length("code") <= COURSE_CODE_MAX_LEN),
        ("course_edition", "length:course_code", "course_code", F.length("course_code") <= COURSE_CODE_MAX_LEN),
        ("course_prerequisites", "length:course_code", "course_code", F.length("course_code") <= COURSE_CODE_MAX_LEN),
        ("course_prerequisites", "length:prerequisite_code", "prerequisite_code",
         F.length("prerequisite_code") <= COURSE_CODE_MAX_LEN),
        ("degree_courses", "length:course_code", "course_code", F.length("course_code") <= COURSE_CODE_MAX_LEN),
    )


def _key_text(cols) -> F.Column:
    """The key's values joined by ``|``; a backslash or bar inside a value is escaped and a
    null is ``\\N``, so different keys have different texts."""
    def part(c):
        text = F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\\N"))
    return F.concat_ws("|", *[part(c) for c in cols])


#: Ids that one bitmap of the built-in functions spans.
SPAN = 32_768
#: Below so many ids to a bitmap of 4 KB their values take less room.
DENSE = 64
_INTEGERS = ("bigint", "int", "smallint", "tinyint")


def _key_rules(names: list[str]):
    """(table, rule, columns, whether a null counts as a value) of every key to be unique."""
    for t in names:
        yield t, "primary_key", PRIMARY_KEYS[t], True
        for u, cols in UNIQUE:
            if u == t:
                yield t, "unique:" + ",".join(cols), cols, False


def _row_findings(T, name: str) -> DataFrame | None:
    """Not-null and domain rules: only the rows that break one leave the scan."""
    df = tbl(T, name)
    broken = [(f"not_null:{f.name}", F.col(f.name).isNull(), F.lit("")) for f in SCHEMAS[name].fields if not f.nullable and f.name in df.columns]
    broken += [(rule, F.col(col).isNotNull() & ~cond, F.col(col).cast("string")) for t, rule, col, cond in _domain_rules() if t == name]
    if not broken:
        return None
    bad = df.where(reduce(lambda a, b: a | b, [c for _, c, _ in broken]))
    facts = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(rule).alias("rule"), detail.alias("detail"))) for rule, c, detail in broken]))
    return (bad.select(F.explode(facts).alias("f")).groupBy(F.col("f.rule").alias("rule"), F.col("f.detail").alias("detail"))
               .agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "rule", "detail", "n_rows"))


def _spread(T, probes: list[tuple[str, str]]) -> dict[tuple[str, str], dict]:
    """Per integer column: rows, values that aren't null, least and largest value."""
    parts = []
    for t in sorted({t for t, _ in probes}):
        cols = [c for u, c in probes if u == t]
        one = tbl(T, t).agg(F.count("*").alias("rows"), *[f(c).cast("long").alias(f"{k}_{c}") for c in cols for k, f in (("n", F.count), ("lo", F.min), ("hi", F.max))])
        line = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), "rows", F.col(f"n_{c}").alias("n"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for c in cols]))
        parts.append(one.select(F.lit(t).alias("t"), line.alias("x")).select("t", "x.*"))
    return {(r["t"], r["col"]): r.asDict() for r in reduce(DataFrame.unionByName, parts).collect()} if parts else {}  # a row per column


def _bitmaps(T, probes: list[tuple[str, str]]) -> DataFrame:
    """probe (its place in the list), span, bits, n: the ids of each column as bitmaps, built in the
    scan of its table, so a row leaves it per span of ids and not per row."""
    parts = []
    for t in sorted({t for t, _ in probes}):
        ids = [F.struct(F.lit(i).alias("probe"), F.col(c).cast("long").alias("id")) for i, (u, c) in enumerate(probes) if u == t]
        parts.append(tbl(T, t).select(F.inline(F.array(*ids))))
    rows = reduce(DataFrame.unionByName, parts).where("id is not null")
    spans = rows.groupBy("probe", F.bitmap_bucket_number("id").alias("span"))
    return materialize(spans.agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"), F.count("*").alias("n")))


def _repeated(df: DataFrame, name: str, rule: str, cols, nulls: bool) -> DataFrame:
    """Keys on several rows, grouped as the values they are."""
    rows = df.select(*cols) if nulls else df.select(*cols).na.drop(subset=list(cols))
    found = rows.groupBy(*cols).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    return found.select(F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), _key_text(cols).alias("detail"), "n_rows")


def _orphans(child: DataFrame, name: str, col: str, parent: DataFrame, pcol: str) -> DataFrame:
    """Values of ``col`` that the parent lacks; the child's rows are counted before they meet it."""
    values = child.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count("*").alias("n_rows"))
    lacking = values.join(parent.select(F.col(pcol).alias("v")), "v", "left_anti")
    return lacking.select(F.lit(name).alias("table_name"), F.lit(f"foreign_key:{col}").alias("rule"), F.col("v").cast("string").alias("detail"), "n_rows")


def audit_constraints(T, tables=None) -> DataFrame:
    """All findings as (table_name, rule, detail, n_rows). Clean tables give none.

    Rules: ``primary_key`` / ``unique:<cols>`` (key text, number of rows with it),
    ``foreign_key:<col>`` (orphan value, rows), ``not_null:<col>`` (rows with null),
    ``check:*`` / ``length:*`` (offending value, rows), ``missing_table`` (a declared or
    named table that ``T`` lacks).

    Integer ids are probed by exact bitmaps: a span of ids holds a repeated key if it has more rows
    than bits, and a reference without its parent if the child's bits add some to the parent's.
    Only the ids of the spans that hit are looked at one by one, and columns without a hit not
    at all. Columns whose ids lie too far apart for bitmaps (by their measured range), texts and
    keys of several columns are grouped as values. Key texts are made for findings only.
    """
    asked = list(tables) if tables else list(SCHEMAS)
    names = [n for n in asked if _has(T, n)]
    if not names:
        raise ValueError("none of the tables to audit is there")
    kinds = {n: dict(tbl(T, n).dtypes) for n in names}
    is_id = lambda t, c: kinds[t].get(c) in _INTEGERS
    keys = list(_key_rules(names))
    foreign = [f for f in FOREIGN_KEYS if f[0] in names and f[2] in names]
    wanted = {(t, cols[0]) for t, _, cols, _ in keys if len(cols) == 1 and is_id(t, cols[0])}
    wanted |= {x for c, ccol, p, pcol in foreign for x in ((c, ccol), (p, pcol)) if is_id(c, ccol) and is_id(p, pcol)}
    spread = _spread(T, sorted(wanted))
    dense = [x for x in sorted(wanted) if spread[x]["n"] and (spread[x]["hi"] - spread[x]["lo"]) // SPAN * DENSE <= spread[x]["n"]]
    place = {x: i for i, x in enumerate(dense)}

    found = [f for f in (_row_findings(T, n) for n in names) if f is not None]
    by_bits_keys = [k for k in keys if len(k[2]) == 1 and (k[0], k[2][0]) in place]
    by_bits_refs = [f for f in foreign if f[:2] in place and f[2:] in place]
    if place:
        bits = _bitmaps(T, dense)
        # one row per probe and span that hits: probe (of the key, or of the reference less 1)
        twice = bits.where(F.col("probe").isin([place[t, c[0]] for t, _, c, _ in by_bits_keys]) & (F.bitmap_count("bits") < F.col("n"))).select(F.lit(-1).alias("ref"), "probe", "span")
        hits = twice
        if by_bits_refs:
            sides = [F.struct(F.lit(i).alias("ref"), F.lit(own).alias("parent")) for i, f in enumerate(by_bits_refs) for own in (False, True)]
            of = [place[f[2:]] if own else place[f[:2]] for f in by_bits_refs for own in (False, True)]
            side = F.explode(F.array_compact(F.array(*[F.when(F.col("probe") == p, x) for p, x in zip(of, sides)])))
            met = bits.select("span", "bits", side.alias("s")).groupBy(F.col("s.ref").alias("ref"), "span").agg(
                F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"),
                F.bitmap_count(F.bitmap_or_agg(F.when(F.col("s.parent"), F.col("bits")))).alias("parents"))
            hits = hits.unionByName(met.where("all > coalesce(parents, 0)").select("ref", F.lit(-1).alias("probe"), "span"))
        hits = materialize(hits)
        struck = {(r["ref"], r["probe"]) for r in hits.select("ref", "probe").distinct().collect()}  # a row per rule at most

        def struck_rows(t, c, ref, probe):
            spans = hits.where((F.col("ref") == ref) & (F.col("probe") == probe)).select("span")
            return tbl(T, t).where(F.col(c).isNotNull()).withColumn("span", F.bitmap_bucket_number(F.col(c).cast("long"))).join(spans, "span", "left_semi")

        for t, rule, (c,), nulls in by_bits_keys:
            if (-1, place[t, c]) in struck:
                found.append(_repeated(struck_rows(t, c, -1, place[t, c]), t, rule, [c], False))
            nil = spread[t, c]["rows"] - spread[t, c]["n"]
            if nulls and nil > 1:
                found.append(tbl(T, t).sparkSession.createDataFrame([(t, rule, "\\N", nil)], FINDING))
        for i, (c, ccol, p, pcol) in enumerate(by_bits_refs):
            if (i, -1) in struck:
                found.append(_orphans(struck_rows(c, ccol, i, -1), c, ccol, struck_rows(p, pcol, i, -1), pcol))
    found += [_repeated(tbl(T, t), t, rule, list(cols), nulls) for t, rule, cols, nulls in keys if (t, rule, cols, nulls) not in by_bits_keys]
    found += [_orphans(tbl(T, c), c, ccol, tbl(T, p), pcol) for c, ccol, p, pcol in foreign if (c, ccol, p, pcol) not in by_bits_refs]
    lacking = [n for n in asked if n not in names]
    if lacking:
        found.append(tbl(T, names[0]).sparkSession.createDataFrame([(n, "missing_table", "", 1) for n in lacking], FINDING))
    return reduce(DataFrame.unionByName, found).select("table_name", "rule", "detail", F.col("n_rows").cast("long").alias("n_rows"))


def _has(T, name: str) -> bool:
    if isinstance(T, dict):
        return name in T
    try:
        getattr(T, name)
        return True
    except AttributeError:
        return False


def inject_faults(T) -> dict[str, DataFrame]:
    """A copy of the core tables with faults of each kind: duplicated enrolment
    keys (``student_id % 97 = 0``), orphan enrolments (the negative offering less 1 when
    ``student_id % 89 = 1``) and bad class types (``class_id % 101 = 0``)."""
    ce = tbl(T, "course_enrollment")
    dup = ce.where(F.col("student_id") % 97 == 0)
    orphan = ce.where(F.col("student_id") % 89 == 1).withColumn("edition_id", -F.col("edition_id") - 1)
    cl = tbl(T, "class").withColumn("type", F.when(F.col("class_id") % 101 == 0, F.lit("X")).otherwise(F.col("type")))
    return {"course_enrollment": ce.unionByName(dup).unionByName(orphan), "class": cl}
