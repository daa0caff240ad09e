"""Academic tables and request tables derived from the driver's test data.

The test parquet holds no academic tables, so each domain table is derived from
the TPC-H-like tables and the ``events`` table by a fixed rule (FIXTURES.md §3).
These rules only shape rows into the domain schema; the operators never rely on
them. ``plans/oracle.py`` repeats every rule in SQL for the independent check.

Every row of every table takes part, whatever the scale. Base: ``enr0`` = lineitem ⋈
orders, course number ``cno = l_partkey``,
``year = year(o_orderdate)``, ``edition_id = cno*10 + (year - 1995)``,
``student_id = o_custkey``. Ids of other people follow the students' in steps of ``unit``, one more
than the largest customer, supplier or event user id: instructors from 1 unit on, coordinators
without an instructor row from 2, students that don't exist from 3, admins from 4. So they never
meet, whatever the size. (Orders of at most ten consecutive years and at most 99 lines each.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registrar.functions.columns import course_code, to_grade, to_money
from registrar.functions.sequence import materialize, running_count
from registrar.sources.tables import Source

# Fixed parameters of the derivation.
FIRST_YEAR = 1995
#: Line numbers that an offering's row lists as bits; rows with others are looked at one by one.
MASKED = 62


class Campus:
    """Lazily derived domain tables: ``campus.course_enrollment`` etc."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.src = Source(spark, sf_dir)
        self._memo: dict[str, DataFrame] = {}
        self._kept: set[str] = set()

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        builder = _BUILDERS.get(name)
        if builder is None:
            raise AttributeError(name)
        if name not in self._memo:
            self._memo[name] = builder(self)
        return self._memo[name]

    def keep(self, *names: str) -> Campus:
        """Derive these tables once and store them, in this order, for a query that reads them in
        several places; tables derived after them read the stored rows."""
        for name in names:
            if name not in self._kept:
                self._memo[name] = materialize(getattr(self, name))
                self._kept.add(name)
        return self

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in names}


def _unit(c: Campus):
    """More than any id of a customer, a supplier or an event's user."""
    largest = [t.select(F.max(k)).scalar() for t, k in
               ((c.src.customer, "c_custkey"), (c.src.supplier, "s_suppkey"), (c.src.events, "user_id"))]
    return F.greatest(*largest).cast("long") + 1


def _lines(c: Campus) -> DataFrame:
    """lineitem with what its order says; ``enr0`` has what follows from a row by itself on top."""
    li = c.src.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    o = c.src.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                      "l_quantity", "l_returnflag", F.to_date("o_orderdate").alias("ordered_on"),
                      F.col("o_custkey").alias("student_id")))


def _enr0(c: Campus) -> DataFrame:
    cno, yr = F.col("l_partkey"), F.year("ordered_on").cast("long")
    return c.lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "ordered_on",
                          cno.alias("cno"), yr.alias("yr"), (cno * 10 + (yr - FIRST_YEAR)).alias("edition_id"), "student_id")


def _student(c: Campus) -> DataFrame:
    cu = c.src.customer.select("c_custkey", "c_name", "c_nationkey")
    n = c.src.nation.select("n_nationkey", "n_name")
    return (cu.join(n, cu.c_nationkey == n.n_nationkey)
              .select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"),
                      F.lit(None).cast("date").alias("birth_date"), F.lit(None).cast("string").alias("address"),
                      F.when(F.col("c_custkey") % 40 != 0, F.col("n_name")).alias("district")))


def _instructor_ids(c: Campus) -> DataFrame:
    s = c.src.supplier.select("s_suppkey")
    return s.select((F.col("s_suppkey") + _unit(c)).alias("user_id"), "s_suppkey")


def _users(c: Campus) -> DataFrame:
    students = c.src.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username"))
    students = students.select("user_id", "username",
                               F.concat(F.lit("s"), F.col("user_id").cast("string"), F.lit("@uni.example")).alias("email"),
                               F.lit("student").alias("role"))
    sup = c.src.supplier.select("s_suppkey", "s_name")
    instr = sup.select((F.col("s_suppkey") + _unit(c)).alias("user_id"), F.col("s_name").alias("username"),
                       F.concat(F.lit("i"), F.col("s_suppkey").cast("string"), F.lit("@uni.example")).alias("email"),
                       F.lit("instructor").alias("role"))
    admins = c.src.nation.select((F.col("n_nationkey") + 4 * _unit(c)).alias("user_id"),
                                 F.concat(F.lit("admin-"), F.col("n_name")).alias("username"),
                                 F.lit(None).cast("string").alias("email"), F.lit("admin").alias("role"))
    return students.unionByName(instr).unionByName(admins)


def _instructor(c: Campus) -> DataFrame:
    return _instructor_ids(c).select("user_id", (F.col("s_suppkey") % 3 == 0).alias("is_coordinator"))


def _admin(c: Campus) -> DataFrame:
    return c.src.nation.select((F.col("n_nationkey") + 4 * _unit(c)).alias("user_id"))


def _course(c: Campus) -> DataFrame:
    p = c.src.part.select("p_partkey", "p_name")
    return p.select(course_code("p_partkey").alias("code"), F.col("p_name").alias("name"),
                    (F.lit(3) + F.col("p_partkey") % 10).cast("long").alias("credits"))


def _offering(c: Campus) -> DataFrame:
    """One row per offering: its coordinator, and the line numbers up to ``MASKED`` of its rows as
    bits, so that its grade batches are told without dealing all rows once more."""
    line = F.when(F.col("l_linenumber").between(0, MASKED), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("l_linenumber").cast("int")))
    g = c.enr0.groupBy("edition_id", "cno", "yr").agg(F.min("l_suppkey").alias("min_supp"), F.bit_or(line).alias("lines"))
    # every tenth course's coordinator has no instructor row
    coordinator = F.col("min_supp") + _unit(c) * F.when(F.col("cno") % 10 == 9, 2).otherwise(1)
    return g.select("edition_id", "cno", "yr", coordinator.cast("long").alias("coordinator_id"), F.coalesce("lines", F.lit(0).cast("long")).alias("lines"))


def _course_edition(c: Campus) -> DataFrame:
    return c.offering.select("edition_id", course_code("cno").alias("course_code"), F.col("yr").alias("year"),
                             (F.lit(2) + F.col("cno") % 8).cast("long").alias("capacity"),
                             F.lit(None).cast("string").alias("schedule"), "coordinator_id")


def _course_enrollment(c: Campus) -> DataFrame:
    graded = F.col("l_returnflag") != "N"
    # the larger of two names as a number: a text can't be kept in a hash aggregate
    period = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 2)
    g = c.enr0.groupBy("student_id", "edition_id").agg(
        F.max(F.when(graded, F.col("l_quantity"))).alias("q"),
        F.max("l_linenumber").alias("attendance"),
        F.max(period).alias("p"))
    return g.select("student_id", "edition_id", to_grade(F.col("q") * F.lit(0.4)).alias("grade"),
                    F.col("attendance").cast("long").alias("attendance"),
                    F.when(F.col("p") == 1, "Normal").when(F.col("p") == 2, "Recurso").alias("evaluation_period"))


def _instructor_assignment(c: Campus) -> DataFrame:
    ia = c.enr0.select((F.col("l_suppkey") + _unit(c)).alias("instructor_id"), "edition_id").distinct()
    ed = c.course_edition.select("edition_id", "coordinator_id")
    return (ia.join(ed, "edition_id")
              .select("instructor_id", "edition_id", (F.col("instructor_id") == F.col("coordinator_id")).alias("is_coordinator")))


def _degree_program(c: Campus) -> DataFrame:
    seg = c.src.customer.select(F.col("c_mktsegment").alias("name")).distinct()
    # A handful of segments: a window over the distinct list numbers them alphabetically.
    ranked = seg.select("name", F.row_number().over(Window.orderBy("name")).cast("long").alias("degree_id"))
    return ranked.select("degree_id", "name", to_money(F.lit(4000) + F.lit(500) * F.col("degree_id")).alias("tuition_fee"))


def _n_degrees(c: Campus):
    return c.src.customer.select(F.count_distinct("c_mktsegment")).scalar()


def _n_activities(c: Campus):
    return c.src.events.select(F.count_distinct("event_type")).scalar()


def _degree_enrollment(c: Campus) -> DataFrame:
    first = (c.src.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("first_order")))
    cu = c.src.customer.select("c_custkey", "c_mktsegment")
    dp = c.degree_program.select("degree_id", F.col("name").alias("c_mktsegment"))
    own = (cu.join(dp, "c_mktsegment").join(first, cu.c_custkey == first.o_custkey, "left")
             .select(F.col("c_custkey").alias("student_id"), "degree_id",
                     F.coalesce("first_order", F.lit("1995-01-01").cast("date")).alias("enrollment_date")))
    second = (own.where(F.col("student_id") % 10 == 0)
                 .select("student_id", (F.col("degree_id") % _n_degrees(c) + 1).alias("degree_id"), "enrollment_date"))
    return own.unionByName(second)


def _degree_courses(c: Campus) -> DataFrame:
    cno = c.src.part.select(F.col("p_partkey").alias("cno"))
    n = _n_degrees(c)
    first = cno.select((F.col("cno") % n + 1).alias("degree_id"), course_code("cno").alias("course_code"))
    extra = cno.where(F.col("cno") % 7 == 0).select(((F.col("cno") + 2) % n + 1).alias("degree_id"),
                                                    course_code("cno").alias("course_code"))
    return first.unionByName(extra)


def _course_prerequisites(c: Campus) -> DataFrame:
    cno = c.src.part.select(F.col("p_partkey").alias("cno"))
    return cno.where(F.col("cno") % 30 == 1).select(course_code("cno").alias("course_code"),
                                                    course_code(F.col("cno") - 1).alias("prerequisite_code"))


def _class(c: Campus) -> DataFrame:
    ed = c.course_edition.select("edition_id")
    t = ed.select((F.col("edition_id") * 2).alias("class_id"), "edition_id", F.lit("T").alias("type"),
                  F.lit("theory").alias("schedule"))
    pl = ed.select((F.col("edition_id") * 2 + 1).alias("class_id"), "edition_id", F.lit("PL").alias("type"),
                   F.lit("lab").alias("schedule"))
    return t.unionByName(pl)


def _activity(c: Campus) -> DataFrame:
    types = c.src.events.select(F.col("event_type").alias("name")).distinct()
    ranked = types.select("name", F.row_number().over(Window.orderBy("name")).alias("rk"))
    return ranked.select(F.col("name").alias("activity_id"), "name",
                         to_money(F.lit(20) + F.lit(5) * F.col("rk")).alias("fee"))


def _activity_rank(c: Campus) -> DataFrame:
    types = c.src.events.select(F.col("event_type").alias("activity_id")).distinct()
    return types.select("activity_id", F.row_number().over(Window.orderBy("activity_id")).cast("long").alias("rk"))


def _activity_participation(c: Campus) -> DataFrame:
    ev = c.src.events.select("user_id", "event_type", "ts")
    return (ev.groupBy("user_id", "event_type").agg(F.min("ts").alias("first"))
              .select(F.col("user_id").alias("student_id"), F.col("event_type").alias("activity_id"),
                      F.to_date("first").alias("registration_date")))


def _financial_account(c: Campus) -> DataFrame:
    de = c.degree_enrollment.select("student_id", "degree_id")
    dp = c.degree_program.select("degree_id", "tuition_fee")
    owed = de.join(dp, "degree_id").groupBy("student_id").agg(F.sum("tuition_fee").alias("owed"))
    return (owed.where(F.col("student_id") % 4 != 3)
                .select((F.col("student_id") + 1).alias("account_id"), "student_id",
                        to_money("owed").alias("balance"), F.lit(None).cast("timestamp_ntz").alias("last_update")))


def _charge(c: Campus) -> DataFrame:
    """Charges: one tuition row per degree enrolment, one fee row per activity
    participation. A student's ids are as many as there are degrees and activities."""
    n_degrees = _n_degrees(c)
    step = F.col("student_id") * (n_degrees + _n_activities(c))
    de = c.degree_enrollment.join(c.degree_program.select("degree_id", "tuition_fee"), "degree_id")
    tuition = de.select((step + F.col("degree_id") - 1).alias("charge_id"), "student_id",
                        F.col("tuition_fee").alias("amount"), F.lit("tuition").alias("kind"),
                        F.col("enrollment_date").alias("charge_date"))
    ap = (c.activity_participation.join(c.activity.select("activity_id", "fee"), "activity_id")
           .join(c.activity_rank, "activity_id"))
    fees = ap.select((step + n_degrees + F.col("rk") - 1).alias("charge_id"), "student_id",
                     F.col("fee").alias("amount"), F.lit("activity").alias("kind"),
                     F.col("registration_date").alias("charge_date"))
    return tuition.unionByName(fees)


def _financial_transaction(c: Campus) -> DataFrame:
    acc = c.financial_account.select("account_id", "student_id")
    ch = c.charge.join(acc, "student_id")
    return ch.select(F.col("charge_id").alias("transaction_id"), "account_id", "amount",
                     F.concat(F.lit("charge: "), F.col("kind")).alias("description"),
                     F.col("charge_date").cast("timestamp_ntz").alias("transaction_date"),
                     F.lit(None).cast("string").alias("activity_id"), F.lit(None).cast("long").alias("degree_id"))


def _student_class(c: Campus) -> DataFrame:
    ce = c.course_enrollment.select("student_id", "edition_id", "attendance")
    t = ce.select("student_id", (F.col("edition_id") * 2).alias("class_id"))
    pl = ce.where(F.col("attendance") % 2 == 1).select("student_id", (F.col("edition_id") * 2 + 1).alias("class_id"))
    return t.unionByName(pl)


def _academic_record(c: Campus) -> DataFrame:
    """An old record of every third student, opened before any grade was submitted."""
    de = c.degree_enrollment.where(F.col("student_id") % 3 == 0).groupBy("student_id").agg(F.min("degree_id").alias("degree_id"))
    return de.select(F.col("student_id").alias("record_id"), "student_id", to_grade(F.lit(10)).alias("average"),
                     F.lit(1).cast("long").alias("approved_courses"), F.lit(None).cast("long").alias("current_semester"),
                     "degree_id", F.lit("1995-01-01").cast("date").alias("enrollment_date"))


def _grade_date(c: Campus) -> DataFrame:
    """When an enrolment got its grade: the last order date of its graded rows."""
    g = c.enr0.where(F.col("l_returnflag") != "N")
    return g.groupBy("student_id", "edition_id").agg(F.max("ordered_on").alias("graded_on"))


def _cancellation(c: Campus) -> DataFrame:
    """Events with ``event_id % 6 = 5`` cancel their activity; those with ``% 12 = 11`` for a
    student seven ids on, who may not take part."""
    ev = c.src.events.select("event_id", "user_id", "event_type").where(F.col("event_id") % 6 == 5)
    return ev.select(F.col("event_id").alias("seq"), (F.col("user_id") + F.when(F.col("event_id") % 12 == 11, 7).otherwise(0)).alias("student_id"),
                     F.col("event_type").alias("activity_id"))


def _classroom(c: Campus) -> DataFrame:
    return c.src.nation.select(F.col("n_nationkey").cast("long").alias("room_id"), F.col("n_name").alias("building"),
                               F.lit(30).cast("long").alias("capacity"), F.lit("campus").alias("location"))


def _class_assignment(c: Campus) -> DataFrame:
    """Every class in a room; five of the thirty rooms named don't exist."""
    cl = getattr(c, "class")
    return cl.select("class_id", (F.col("class_id") % 30).alias("room_id"))


# ---------------------------------------------------------------- request tables

def _admission_request(c: Campus) -> DataFrame:
    """'signup' events in arrival order; course ``event_id*7 % (n + n div 30 + 1)`` of the
    n courses (larger numbers do not exist) in the year ``event_id % 7``; when
    ``event_id % 9 = 0`` a past enrolment of the order ``event_id`` asked for again; an
    unknown student when ``event_id % 31 = 0``; no classes when ``event_id % 13 = 0``; a
    class of the next offering when ``event_id % 11 = 0``."""
    ev = c.src.events.select("event_id", "user_id", "event_type").where(F.col("event_type") == "signup")
    past = c.enr0.groupBy(F.col("l_orderkey").alias("event_id")).agg(
        F.min("edition_id").alias("past_edition"), F.min("student_id").alias("past_student"))
    n = c.src.part.select(F.count("*")).scalar()
    again = (F.col("event_id") % 9 == 0) & F.col("past_edition").isNotNull()
    asked = (F.col("event_id") * 7 % (n + F.floor(n / 30) + 1)) * 10 + F.col("event_id") % 7
    student = (F.when(F.col("event_id") % 31 == 0, F.col("user_id") + 3 * _unit(c))
                .when(again, F.col("past_student")).otherwise(F.col("user_id")))
    ev = ev.join(past, "event_id", "left").select("event_id", student.alias("user_id"),
                                                  F.when(again, F.col("past_edition")).otherwise(asked).cast("long").alias("ed"))
    ed = F.col("ed")
    classes = (F.when(F.col("event_id") % 13 == 0, F.array().cast("array<bigint>"))
                .when(F.col("event_id") % 11 == 0, F.array(ed * 2, ed * 2 + 3))
                .otherwise(F.array(ed * 2, ed * 2 + 1)))
    return ev.select(F.col("event_id").alias("seq"), F.col("user_id").alias("student_id"),
                     ed.alias("edition_id"), classes.alias("classes"))


def _degree_request(c: Campus) -> DataFrame:
    """'click' events: degree ``event_id % (n + 2)`` of the n degrees (0 and n + 1 do not exist), no date when
    ``event_id % 19 = 0``, an unknown student when ``event_id % 23 = 0``."""
    ev = c.src.events.select("event_id", "user_id", "ts", "event_type").where(F.col("event_type") == "click")
    student = F.when(F.col("event_id") % 23 == 0, F.col("user_id") + 3 * _unit(c)).otherwise(F.col("user_id"))
    return ev.select(F.col("event_id").alias("seq"), student.alias("student_id"),
                     (F.col("event_id") % (_n_degrees(c) + 2)).alias("degree_id"),
                     F.when(F.col("event_id") % 19 != 0, F.to_date("ts")).alias("date"))


def _activity_request(c: Campus) -> DataFrame:
    ev = (c.src.events.select("event_id", "user_id", "event_type").where(F.col("event_type") == "purchase")
           .select("event_id", "user_id", (F.col("event_id") % (_n_activities(c) + 1)).alias("rk")))
    j = ev.join(c.activity_rank, "rk", "left")
    return j.select(F.col("event_id").alias("seq"), (F.col("user_id") * 13).alias("student_id"),
                    F.coalesce("activity_id", F.concat(F.lit("unknown-"), F.col("rk").cast("string"))).alias("activity_id"))


def _registration(c: Campus) -> DataFrame:
    n_cust = c.src.customer.select(F.count("*")).scalar()
    ev = c.src.events.select("event_id", "event_type").where(F.col("event_type") == "view")
    num = F.col("event_id") % (F.lit(2) * n_cust)
    username = F.when(F.col("event_id") % 17 != 0,
                      F.concat(F.lit("Customer#"), F.lpad(num.cast("string"), 9, "0")))
    return ev.select(F.col("event_id").alias("seq"), username.alias("username"),
                     F.when(F.col("event_id") % 23 != 0,
                            F.concat(F.lit("r"), F.col("event_id").cast("string"), F.lit("@mail.example"))).alias("email"),
                     (F.col("event_id") % 29 != 0).alias("password_present"),
                     F.when(F.col("event_id") % 3 == 0, F.lit(True)).alias("is_coordinator"))


def _grade_batch(c: Campus) -> DataFrame:
    """One batch per (offering, line number): submitter is the coordinator except for
    offerings with ``edition_id % 20 = 0``; period from the line number; no period
    when ``edition_id % 50 = 6``; the header names a missing offering (the negative id
    less 1) when ``edition_id % 50 = 3``."""
    listed = F.filter(F.sequence(F.lit(0), F.length(F.bin("lines")) - 1), lambda i: F.call_function("getbit", F.col("lines"), i) == 1)
    j = c.offering.where("edition_id is not null").select("edition_id", "coordinator_id", F.explode(listed).alias("l_linenumber"))
    j = j.withColumn("l_linenumber", F.col("l_linenumber").cast("long"))
    others = c.enr0.where(~F.coalesce(F.col("edition_id").isNotNull() & F.col("l_linenumber").between(0, MASKED), F.lit(False)))
    others = materialize(others.select("edition_id", "l_linenumber").distinct())
    if not others.isEmpty():
        j = j.unionByName(others.join(c.offering.select("edition_id", "coordinator_id"), "edition_id", "left"))
    j = j.withColumn("batch_id", F.col("edition_id") * 100 + F.col("l_linenumber"))
    submitter = F.when(F.col("edition_id") % 20 == 0, F.col("coordinator_id") + 1).otherwise(F.col("coordinator_id"))
    period = (F.when(F.col("edition_id") % 50 == 6, F.lit(None).cast("string"))
               .when(F.col("l_linenumber") % 2 == 1, F.lit("Normal")).otherwise(F.lit("Recurso")))
    named = F.when(F.col("edition_id") % 50 == 3, -F.col("edition_id") - 1).otherwise(F.col("edition_id"))
    return j.select("batch_id", named.alias("edition_id"), submitter.alias("submitter_id"), period.alias("period"))


def _grade_row(c: Campus) -> DataFrame:
    """Grade pairs [student, grade] as texts; position: the row's place in its batch by
    (order, part, supplier, quantity, return flag). Grade 25 when ``l_orderkey % 97 = 0``, not a
    number when ``l_orderkey % 79 = 0``, student -1 when ``l_orderkey % 89 = 0``, a malformed
    3-element entry when ``l_orderkey % 83 = 0``."""
    order = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]
    rows = c.enr0.select((F.col("edition_id") * 100 + F.col("l_linenumber")).alias("batch_id"), *order, "student_id")
    # a batch may hold any share of all rows: its rows are numbered without one task seeing them all
    e = running_count(rows, ["batch_id"], order, F.lit(True), "pos", stored=True)
    student = F.when(F.col("l_orderkey") % 89 == 0, F.lit(-1)).otherwise(F.col("student_id")).cast("string")
    grade = (F.when(F.col("l_orderkey") % 97 == 0, F.lit("25")).when(F.col("l_orderkey") % 79 == 0, F.lit("x"))
              .otherwise((F.col("l_quantity") * F.lit(0.4)).cast("string")))
    pair = F.when(F.col("l_orderkey") % 83 == 0, F.array(student, grade, F.lit("0"))).otherwise(F.array(student, grade))
    return e.select("batch_id", F.col("pos").cast("long").alias("pos"), pair.alias("pair"))


def _erasure_request(c: Campus) -> DataFrame:
    """Student ids ``% 50 = 0``, instructor ids ``% 10 = 5`` (to be refused) and
    unknown ids (``c_custkey % 500 = 7``, three units on)."""
    u = c.users.select("user_id")
    chosen = u.where((F.col("user_id") % 50 == 0) | ((F.col("user_id") >= _unit(c)) & (F.col("user_id") % 10 == 5)))
    unknown = (c.src.customer.select("c_custkey").where(F.col("c_custkey") % 500 == 7)
                .select((F.col("c_custkey") + 3 * _unit(c)).alias("user_id")))
    ids = chosen.unionByName(unknown)
    return ids.select(F.col("user_id").alias("seq"), F.col("user_id").alias("student_id"))


_BUILDERS = {
    "lines": _lines, "enr0": _enr0, "offering": _offering, "student": _student, "users": _users, "instructor": _instructor, "admin": _admin,
    "course": _course, "course_edition": _course_edition, "course_enrollment": _course_enrollment,
    "instructor_assignment": _instructor_assignment, "degree_program": _degree_program,
    "degree_enrollment": _degree_enrollment, "degree_courses": _degree_courses,
    "course_prerequisites": _course_prerequisites, "class": _class, "activity": _activity,
    "activity_rank": _activity_rank, "activity_participation": _activity_participation,
    "financial_account": _financial_account, "charge": _charge, "financial_transaction": _financial_transaction,
    "student_class": _student_class, "academic_record": _academic_record,
    "grade_date": _grade_date, "cancellation": _cancellation, "classroom": _classroom, "class_assignment": _class_assignment,
    "admission_request": _admission_request, "degree_request": _degree_request,
    "activity_request": _activity_request, "registration": _registration, "grade_batch": _grade_batch,
    "grade_row": _grade_row, "erasure_request": _erasure_request,
}
